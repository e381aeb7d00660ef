"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are put in a shuffled but repeatable order. A document's virtual finish
time is the number of words its source has served up to and with it, divided by the source's
target; a second pass over a source goes on from the first. All copies are then taken in the order
of their finish times until the budget is spent, so that every source comes near its target.

Null texts have size 0, null sources form a source of their own that sorts last, equal rows are
taken together, very long texts count whole, and an empty table gives an empty mix. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlake.llm.text import packed, row_key, word_count
from ledgerlake.llm.scratch import materialize

WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)  # of all sizes, as a fraction
PASSES = 2
CELLS = 1 << 12  # cells per level of the two-level running sums


def targets(sizes: DataFrame, weights: Sequence[int], budget: tuple[int, int], passes: int) -> DataFrame:
    """source, source_size -> with weight and target: one row per source.

    A target is ``level * weight`` but at most ``passes`` times the source's size. Sources sorted by the
    level at which they are full, the level is what the budget leaves to those not yet full.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    weighed = sizes.withColumn("weight", weight).withColumn(
        "cap", (F.col("source_size") * passes).cast("double")
    )
    by_level = W.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(0))
    spent = F.coalesce(F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_level.rowsBetween(W.currentRow, W.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    levels = (
        weighed.withColumn("budget", (total * budget[0] / budget[1]).cast("double"))
        .withColumn("level", (F.col("budget") - spent) / left)
        .withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    )
    # The level of the first source that is not full holds for all that follow.
    open_level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    return levels.withColumn("open", open_level["level"]).select(
        "source",
        "source_size",
        "weight",
        "budget",
        F.when(F.col("open").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("open") * F.col("weight")))
        .alias("target"),
    )


def served(rows: DataFrame) -> DataFrame:
    """Words served by the source up to and with each document, in shuffled order.

    The key's top bits cut every source into cells; cells are summed first, so that a source of
    any size is spread over many tasks. Equal rows are served together.
    """
    rows = rows.withColumn("cell", F.shiftright("key", 60 - 12))
    upto = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    before = (
        rows.groupBy("source", "cell").agg(F.sum("size").alias("n"))
        .select("source", "cell", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    )
    in_cell = W.partitionBy("source", "cell").orderBy("key", "doc_id").rangeBetween(W.unboundedPreceding, W.currentRow)
    same = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.cell") == F.col("b.cell"))
    return (
        rows.withColumn("in_cell", F.sum("size").over(in_cell)).alias("r")
        .join(before.alias("b"), same)
        .select("r.*", (F.col("b.before") + F.col("r.in_cell")).alias("served"))
        .drop("cell", "in_cell")
    )


def finish(n: int) -> Column:
    """Virtual finish time of a document's pass number ``n``; none for sources that get nothing."""
    when = (F.col("served") + n * F.col("source_size")) / F.col("target")
    return F.when(F.col("target") > 0, when)


def fair_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
    passes: int = PASSES,
) -> DataFrame:
    """doc_id, size, source, source_size, target, passes and taken of every document, and its row key."""
    rows = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), row_key(F.col("doc_id"), F.col("text")).alias("key")
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(sizes, weights, budget, passes)
    same = F.col("r.source").eqNullSafe(F.col("t.source"))
    queue = materialize(
        served(rows).alias("r").join(aims.alias("t"), same)
        .select("r.*", "t.source_size", "t.target", "t.budget")
    )
    rank = F.struct("at", F.col("source").isNull().alias("none"), "source", "key", "doc_id")
    copies = queue.select(
        "*", F.explode(F.filter(F.array(*[finish(n) for n in range(passes)]), lambda x: x.isNotNull())).alias("at")
    ).withColumn("cell", F.least(F.floor(F.col("at") * CELLS), F.lit(4 * CELLS)))

    def crossing(cells: DataFrame, spent: int) -> tuple[int, int] | None:
        """The cell in which the budget runs out, and what is spent before it."""
        before = F.coalesce(F.sum("n").over(W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + spent
        hit = (
            cells.withColumn("before", before).filter(F.col("before") + F.col("n") > F.col("budget"))
            .orderBy("cell").select("cell", "before").head()
        )
        return (hit[0], hit[1]) if hit else None

    per_cell = [F.sum("size").alias("n"), F.max("budget").alias("budget")]
    coarse = crossing(copies.groupBy("cell").agg(*per_cell), 0)
    cut = None
    if coarse:
        # Cells of the second level divide the one in which the budget runs out.
        inside = copies.filter(F.col("cell") == coarse[0]).withColumn("cell", F.floor(F.col("at") * CELLS * CELLS))
        fine = crossing(inside.groupBy("cell").agg(*per_cell), coarse[1])
        upto = W.orderBy(rank).rangeBetween(W.unboundedPreceding, W.currentRow)
        cut = (
            inside.filter(F.col("cell") == fine[0])
            .withColumn("rank", rank).withColumn("upto", F.sum("size").over(upto) + fine[1])
            .filter(F.col("upto") > F.col("budget")).agg(F.min("rank").alias("rank")).head()["rank"]
        )

    def taken(n: int) -> Column:
        """Whether pass ``n`` comes before the first copy that would overrun the budget."""
        inside = finish(n).isNotNull()
        if cut is None:
            return inside.cast("long")
        first = F.struct(
            F.lit(cut["at"]).cast("double"), F.lit(cut["none"]), F.lit(cut["source"]).cast("string"),
            F.lit(cut["key"]).cast("long"), F.lit(cut["doc_id"]).cast("long"),
        )
        mine = F.struct(finish(n), F.col("source").isNull(), "source", "key", "doc_id")
        return (inside & (mine < first)).cast("long")

    count = sum((taken(n) for n in range(passes)), F.lit(0).cast("long"))
    return queue.select(
        "doc_id", "size", "source", "source_size", "target", count.alias("passes"), (F.col("size") * count).alias("taken"), "key"
    )


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: every document as many times as it is taken."""
    queue = fair_mix(docs, **parameters).filter("passes > 0 and size > 0")
    taken = materialize(queue.groupBy("doc_id", "key").agg(F.max("passes").alias("passes")))
    rows = docs.select(packed(docs).alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("r.key") == F.col("t.key"))
    return (
        rows.alias("r").join(taken.alias("t"), same)
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int"))).alias("pass"))
        .select("doc.*")
    )
