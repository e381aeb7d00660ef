"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct word shingles, each a 64-bit number. The order of these
numbers is the global order of the n-grams; it is cut into ranges, the fragments.

1. Documents with the same set form one class, whose representative goes on alone.
2. Candidates: of linked sets at most so many shingles differ, so with one fragment more than that
   some fragment holds the same segment in both. Documents meet under the key of a segment. Where the
   similarity is so low that segments would be of few shingles, and so met by chance, the order is
   rarest first instead, by counters of fixed size over all documents, and documents meet under the
   shingles of a prefix of that order; linked sets share several of these whatever the order. The counters tell ever less
   of ever more documents, so documents that share fewer with all others, and pairs that do, are not looked at.
3. Each key has one pivot, the best that any of its documents meets under its keys, and they are
   compared with it only. The documents of a pivot have a center, the shingles of more than half of them. A linked pair
   either differs little from the center, and then links with the nearest document, too, or must share shingles in which both
   are apart from it. Such documents meet again under those shingles, and so on.
   No group's pairs are written out, and no link between different components is lost.
4. Verification: partial overlaps are counted per fragment and summed per pair. Pairs whose sizes are too far apart
   to link are not sent there, and pairs with too little in common in the first fragment not to the others.

Null and empty texts have empty sets and link with nothing; a text with fewer words than a shingle
is its whole sequence; repeated rows are copies of one class; null or repeated ids do not disturb
(nodes are then named by their sets). Very long texts are hashed whole, in pieces. Of pivots that tie
the smallest node is taken; it does not change the components. An empty table gives an empty result.
Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlake.llm.components import components
from ledgerlake.llm.rarity import levels, place
from ledgerlake.llm.shingles import Similarity, mix, shingle_set
from ledgerlake.llm.text import packed, row_key
from ledgerlake.llm.scratch import drop, materialize, noted, short_shuffles, small_batches

RANGES = 4  # fragments in which overlaps are counted
FEW = 4  # documents that met under one key and are compared one by one, at first
FEW_LATER = 32  # the same for keys around a center, where pairs must share several
SHARED = 4  # keys around a center that a pair must share, unless it needs fewer
SHRINKS = 0.98  # a level whose largest group is more of the one before than that compares all that is left
ROUNDS = 2  # documents that share too few keys to link are left out; then those that shared theirs with such ones
SENT_NODES = 200_000  # nodes whose ids (8 bytes each) may be broadcast to pick their texts


def set_columns(similarity: Similarity):
    """text -> n and a 128-bit fingerprint of the set."""

    @F.pandas_udf("n long, f1 long, f2 long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = np.zeros((len(texts), 3), np.int64)
            for i, text in enumerate(texts):
                s = shingle_set(text, similarity.words)
                with np.errstate(over="ignore"):
                    f1 = np.add.reduce(mix(s + np.uint64(0x1234567)), dtype=np.uint64)
                    f2 = np.add.reduce(mix(s ^ np.uint64(0x89ABCDEF89ABCDEF)), dtype=np.uint64)
                out[i] = len(s), np.uint64(f1).astype(np.int64), np.uint64(f2).astype(np.int64)
            yield pd.DataFrame(out, columns=["n", "f1", "f2"])

    return of


def key_column(similarity: Similarity, counted: Broadcast | None):
    """text -> keys of its segments, or its rarest shingles by the levels of their counters."""

    def keys(shingles: np.ndarray) -> np.ndarray:
        if counted is None:
            return similarity.keys(shingles)
        return similarity.prefix(shingles, counted.value[place(shingles)])

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([keys(shingle_set(t, similarity.words)).view(np.int64) for t in texts])

    return of


def range_column(similarity: Similarity):
    """text -> its shingles per range of the global order."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                s = shingle_set(t, similarity.words)
                at = (s >> np.uint64(32)) * np.uint64(RANGES) >> np.uint64(32)
                edges = np.searchsorted(at, np.arange(1, RANGES, dtype=np.uint64))
                out.append([x.view(np.int64) for x in np.split(s, edges)])
            yield pd.Series(out)

    return of


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """``pairs(a, b, ...)`` with ``common``: partial overlaps per range, summed per pair.

    ``seen_a`` and ``seen_b`` are how many shingles of either the given ranges hold.
    """
    left = segments.select(F.col("node").alias("a"), F.col("at").alias("at_a"), F.col("s").alias("s_a"))
    right = segments.select(F.col("node").alias("b"), F.col("at").alias("at_b"), F.col("s").alias("s_b"))
    partial = (
        pairs.join(left, "a").withColumnRenamed("at_a", "at")
        .join(right.withColumnRenamed("at_b", "at"), ["b", "at"])
        .select(
            *pairs.columns, F.size(F.array_intersect("s_a", "s_b")).alias("partial"),
            F.size("s_a").alias("in_a"), F.size("s_b").alias("in_b"),
        )
    )
    return partial.groupBy(*pairs.columns).agg(
        F.sum("partial").alias("common"), F.sum("in_a").alias("seen_a"), F.sum("in_b").alias("seen_b")
    )


def labeled(df: DataFrame, node: str, labels: DataFrame) -> DataFrame:
    """``label`` of the component that the node belongs to, or the node itself."""
    of = labels.select(F.col("node").alias("_of"), F.col("label").alias("_label"))
    return (
        df.join(of, F.col(node) == F.col("_of"), "left")
        .withColumn("label", F.coalesce("_label", node)).drop("_of", "_label")
    )


class Join:
    """The steps of one join over one table of documents."""

    def __init__(self, docs: DataFrame, similarity: Similarity):
        self.similarity = similarity
        source = docs.select("doc_id", "text")
        key, sets = row_key(F.col("doc_id"), F.col("text")), set_columns(similarity)
        self.rows = materialize(
            source.select("doc_id", key.alias("key"), sets("text").alias("x")).select("doc_id", "key", "x.*")
        )
        clash = self.rows.filter("n > 0").groupBy("doc_id").agg(
            F.count("*").alias("times")
        ).filter("doc_id is null or times > 1")
        # Ids name the nodes if each stands once; else the sets' fingerprints do.
        self.by_id = clash.isEmpty()
        node = F.col("doc_id") if self.by_id else F.col("f1")
        self.rows = self.rows.withColumn("node", node)
        self.copies = materialize(
            self.rows.filter("n > 0").groupBy("n", "f1", "f2")
            .agg(F.count("*").alias("members"), F.min("node").alias("rep"), F.min("doc_id").alias("first_id"))
            .filter("members > 1").drop("members")
        )
        self.source = source

    def texts(self) -> DataFrame:
        """node, text of every document that has words."""
        if self.by_id:
            return self.source.withColumnRenamed("doc_id", "node")
        return self.source.select(set_columns(self.similarity)("text")["f1"].alias("node"), "text")

    def shared(self) -> DataFrame:
        """(key, node) of the keys that two or more representatives share, or one and its copies."""
        counted = None
        if self.similarity.rare_first:
            # A byte for each of a fixed number of counters.
            counted = self.source.sparkSession.sparkContext.broadcast(levels(self.source, self.similarity.words))
        keys = self.texts().select("node", F.explode(key_column(self.similarity, counted)("text")).alias("key"))
        # Most keys are of one document, so that counting them before they are sent would only take memory beside Python.
        shared = materialize(
            keys.select("key").repartition("key").groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").select("key")
        )
        members = keys.join(shared, "key", "left_semi")
        members = members if self.by_id else members.distinct()
        others = materialize(
            self.rows.filter("n > 0").join(self.copies.select("n", "f1", "f2", "rep"), ["n", "f1", "f2"])
            .filter("rep <> node").select("node").distinct()
        )
        return members.join(others, "node", "left_anti").select("key", "node")

    def enough(self, met: DataFrame) -> DataFrame:
        """(key, node, least) of the keys that two or more documents share, of those documents that have enough of them."""
        again = met.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").select("key")
        met = materialize(met.join(again, "key", "left_semi"))
        least = self.rows.filter("n > 0").groupBy("node").agg(F.min(self.similarity.least_column(F.col("n"))).alias("least"))
        nodes = met.groupBy("node").agg(F.count("*").alias("keys")).join(least, "node").filter("keys >= least")
        return met.join(nodes.select("node", "least"), "node")

    def met(self) -> DataFrame:
        """(key, node, least) of the keys that two or more representatives share, where they share ``least`` or more."""
        with noted() as spent:
            met = self.shared().withColumn("least", F.lit(1).cast("long"))
            for _ in range(ROUNDS if self.similarity.rare_first else 0):
                met = self.enough(materialize(met.select("key", "node")))
        met = materialize(met)
        drop(self.source.sparkSession, spent)
        return met

    def segments(self, met: DataFrame) -> DataFrame:
        """(node, n, at, s): the sets of the documents that met any other, range by range."""
        texts = self.among(self.texts(), met.select("node"))
        parts = texts.select("node", F.posexplode(range_column(self.similarity)("text")).alias("at", "s"))
        return materialize(parts if self.by_id else parts.distinct())

    def level(self, met: DataFrame, sizes: DataFrame, segments: DataFrame, last: bool):
        """Compare the documents of each key: (links found, who was compared with which pivot in which family).

        ``met(key, node, label, w, extra, cut, early, cut_early, place)`` has the components found so far as labels; keys whose
        documents are all in one component have nothing more to tell. Before there are families, a ``cut`` below 0 stands for the keys
        beyond one that a pair must share. A pair of a family must share as many of
        the ``extra`` shingles in which they are apart from its center as their ``w`` ask for, and so as many of its keys, less
        those ``cut`` off, that are ``early`` ones of the document with the lower ``w``; if one of these is of a
        large group, the pivots there see to the pair. ``place`` is that of the key among the ``extra`` ones. A group is as large as its documents that have the key early, so
        no document of a small one meets more than that.
        """
        groups = materialize(
            met.join(sizes, "node").groupBy("key").agg(
                F.count_if("early").alias("members"),
                F.max(F.struct("met_keys", (-F.col("node")).alias("back"))).alias("top"),
                F.min("label").alias("lo"),
                F.max("label").alias("hi"),
            ).filter("lo <> hi and members > 0").select("key", "members", "top")
        )
        grouped = met.join(groups, "key")
        few = F.lit(True) if last else F.col("members") <= F.when(F.col("family").isNull(), FEW).otherwise(FEW_LATER)
        many = grouped.filter(~few)
        homes = many.groupBy("node").agg(F.max("top").alias("home"))
        # Any document will do as the pivot of a key, if all of the key's are compared with it. The best
        # pivot that any of them meets is most often the same for all keys of a group of copies, so that
        # each copy is compared once, not with a pivot for each of its keys.
        pivots = many.join(homes, "node").groupBy("key").agg(F.max("home").alias("best"))
        one_by_one = grouped.filter(few).select("key", "family", "node", "label", "w", "extra", "cut", "next", "early", "cut_early", "place")
        other = one_by_one.select("key", *[F.col(c).alias(f"{c}_b") for c in ("node", "label", "w", "extra", "cut", "next", "place")])
        asked = self.lack_column(F.col("w") + F.col("w_b"))
        small = (
            one_by_one.filter("early").join(other, "key")
            .filter("(w < w_b or w = w_b and node < node_b) and label <> label_b and not (next and next_b)")
            # What both have in common up to this key and after it.
            .filter(asked <= F.least("place", "place_b") + F.least(F.col("extra") - F.col("place"), F.col("extra_b") - F.col("place_b")))
            .groupBy("family", F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))
            .agg(F.count("*").alias("times"), F.max(asked - F.greatest("cut_early", "cut_b")).alias("shared"))
            .filter("times >= shared").select("a", "b")
        )
        stars = materialize(
            many.join(pivots, "key")
            .select(F.coalesce("family", F.lit(0)).alias("family"), (-F.col("best.back")).alias("a"), F.col("node").alias("b"))
            .filter("a <> b").distinct()
        )
        return self.linked(small.union(stars.select("a", "b")).distinct(), sizes, segments), stars

    def linked(self, pairs: DataFrame, sizes: DataFrame, segments: DataFrame) -> DataFrame:
        """The pairs (a, b) that link.

        A pair has no more in common than what was seen so far and the lesser rest; where that is not enough, its sets need
        not be sent further. Most pairs that met by chance end at their sizes or at the first range, so that
        about a quarter of their sets is moved at most.
        """
        def rest(of: str) -> Column:
            return F.col(f"n_{of}") - F.col(f"seen_{of}")

        enough = F.col("common") + F.least(rest("a"), rest("b")) >= self.similarity.needed_column(F.col("n_a"), F.col("n_b"))
        sized = (
            pairs.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
            .join(sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
            .filter(self.similarity.needed_column(F.col("n_a"), F.col("n_b")) <= F.least("n_a", "n_b"))
        )
        # Written, so that the planner knows how few they are and leaves the sets where they stand.
        left = materialize(sized)
        for part in (segments.filter("at = 0"), segments):
            sets = self.among(part, left.select(F.col("a").alias("node")).union(left.select("b")))
            left = materialize(overlaps(left, sets).filter(enough).select(*left.columns))
        return left.select("a", "b")

    @staticmethod
    def among(df: DataFrame, nodes: DataFrame) -> DataFrame:
        """The rows of the given nodes; a few of these are sent to where the rows are."""
        wanted = materialize(nodes.distinct())
        return df.join(F.broadcast(wanted) if wanted.count() <= SENT_NODES else wanted, "node", "left_semi")

    def lack_column(self, w: Column) -> Column:
        """Shingles that a pair must share of those that set it apart from a center, by the sum of its ``w``."""
        return F.greatest(F.lit(1), F.ceil(w / (2 * (self.similarity.part + self.similarity.whole))))

    def around_centers(self, stars: DataFrame, sizes: DataFrame, segments: DataFrame, labels: DataFrame):
        """The documents compared with one pivot, by what sets them apart from their center: (met for the next level, sure links).

        The center of a family is the set of shingles that more than half of its documents have; any set would do.
        Two documents differ in what either is apart from the center, less twice what they are apart in common. So with ``w``,
        the part that a document is apart less what its size may differ, a pair links if and only if ``w_a + w_b`` is at most so many
        times the shingles apart in common. Where that sum is not above 0 the pair links surely, and both link with the document
        of the lowest ``w``, too: these links alone keep the component. Every other linked pair shares at least ``lack``
        of the shingles in which it is apart, by its own ``w`` and the lowest, and ``lack`` is at least 1. A center has no shingle that only the half of its documents
        have, so that at most half of them meet under one. Ordered by how many of the family are apart in them, the first shingles are enough: with
        the last ``lack - SHARED`` of either cut off, a linked pair has that many fewer in common at most. The one with the lower ``w`` may be cut as if both had it; what it
        keeps is ``early``. The pivot is left out, as all were compared with it, and families with one component are done.
        """
        rule = self.similarity
        star = stars.join(sizes.select(F.col("node").alias("b"), F.col("n")), "b").withColumn("chain", F.xxhash64("family", "a"))
        family = materialize(labeled(star, "b", labels).select("chain", F.col("b").alias("node"), "n", "label"))
        mixed = family.groupBy("chain").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members")
        ).filter("lo <> hi").select("chain", "members")
        sets = family.join(mixed, "chain").join(segments, "node")
        center = materialize(
            sets.select("chain", "members", "at", F.explode("s").alias("x")).groupBy("chain", "members", "at", "x")
            .agg(F.count("*").alias("times")).filter("2 * times > members")
            .groupBy("chain", "at").agg(F.collect_list("x").alias("c"))
        )
        middle = F.coalesce("c", F.array().cast("array<long>"))
        apart = materialize(
            sets.join(center, ["chain", "at"], "left")
            .select("chain", "node", "n", "label", F.concat(F.array_except("s", middle), F.array_except(middle, "s")).alias("e"))
        )
        both, free = rule.part + rule.whole, rule.whole - rule.part  # linked sets differ in free / both of their sizes' sum
        far = apart.groupBy("chain", "node", "n", "label").agg(F.sum(F.size("e")).alias("extra")).withColumn("w", both * F.col("extra") - free * F.col("n"))
        nearest = far.groupBy("chain").agg(F.min(F.struct("w", "node", "label")).alias("nearest"))
        far = materialize(far.join(nearest, "chain").withColumn("sum", F.col("w") + F.col("nearest.w")))
        sure = materialize(
            far.filter("sum <= 0 and label <> nearest.label").select(F.col("nearest.node").alias("a"), F.col("node").alias("b")).distinct()
        )
        lacking = far.select(
            "chain", "node", "w", "extra", self.lack_column(F.col("sum")).alias("lack"), self.lack_column(2 * F.col("w")).alias("lack_early"),
            rule.band_column(F.col("n"), self.largest).alias("band"),
        ).filter("lack <= extra").withColumns({
            "cut": F.greatest(F.col("lack") - SHARED, F.lit(0)), "cut_early": F.greatest(F.col("lack_early") - SHARED, F.lit(0)),
        })
        each = apart.select("chain", "node", F.explode("e").alias("x")).join(lacking, ["chain", "node"])
        shared = each.groupBy("chain", "x").agg(F.count("*").alias("times")).filter("times > 1")
        rarest = each.join(shared, ["chain", "x"]).groupBy("chain", "node", "w", "lack", "cut", "cut_early", "band").agg(
            F.array_sort(F.collect_list(F.struct("times", "x"))).alias("xs")
        ).filter("lack <= size(xs)").withColumn("extra", F.size("xs").cast("long"))  # others have no part in a pair
        prefix = F.slice("xs", 1, F.greatest(F.size("xs") - F.col("cut"), F.lit(0)).cast("int"))
        # Sizes too far apart do not meet: a set has the keys of its band and of the next.
        named = F.transform(prefix, lambda x, place: F.array(*[
            F.struct(
                F.xxhash64("chain", x["x"], F.col("band") + i).alias("key"), F.lit(bool(i)).alias("next"),
                (place < F.size("xs") - F.col("cut_early")).alias("early"), place.cast("long").alias("place"),
            ) for i in (0, 1)]))
        met = rarest.select(F.explode(F.flatten(named)).alias("k"), F.col("chain").alias("family"), "node", "w", "extra", "cut", "cut_early")
        return met.select("k.*", "family", "node", "w", "extra", "cut", "cut_early"), sure

    def links(self) -> DataFrame:
        """Verified links (a, b) of representatives; their components are those of all links."""
        met = self.met()
        segments = self.segments(met)
        # Of a group of near copies, the least changed one shares most segments: a good pivot.
        sizes = materialize(
            segments.groupBy("node").agg(F.sum(F.size("s")).alias("n"))
            .join(met.groupBy("node").agg(F.count("*").alias("met_keys")), "node")
        )
        self.largest = sizes.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
        met = met.withColumns({
            "label": F.col("node"), "family": F.lit(None).cast("long"),
            "w": F.lit(0).cast("long"), "extra": F.lit(1 << 60), "cut": 1 - F.col("least"),
            "next": F.lit(False), "early": F.lit(True), "cut_early": 1 - F.col("least"), "place": F.lit(0).cast("long"),
        }).drop("least")
        found, before = None, None
        while True:
            largest = met.groupBy("key").agg(F.count_if("early").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
            stuck = before is not None and largest > SHRINKS * before
            new, stars = self.level(met, sizes, segments, stuck)
            found = new if found is None else found.union(new)
            if stars.isEmpty():
                break
            with noted() as spent:
                labels = components(found)
            beyond, sure = self.around_centers(stars, sizes, segments, labels)
            if not sure.isEmpty():
                found = found.union(sure)
                with noted() as more:
                    labels = components(found)
                spent += more
            met, before = materialize(labeled(beyond, "node", labels)), largest
            drop(met.sparkSession, spent)
        return found

    def classes(self) -> DataFrame:
        """doc_id, row key, n_shingles, component_id and group of every row.

        ``component_id`` is the smallest id of the row's component; ``group`` names the component
        itself and is null for empty sets.
        """
        with noted() as spent:
            found = self.links()
        links = materialize(found.distinct())
        drop(self.source.sparkSession, spent)
        labels = components(links)
        if self.by_id:
            named = labels.select("node", "label", F.col("label").alias("component"))
        else:
            ids = self.rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("id"))
            of = labels.join(ids, "node")
            named = of.join(of.groupBy("label").agg(F.min("id").alias("component")), "label")
            named = named.select("node", "label", "component")
        named = materialize(named)
        words = F.col("n") > 0
        return (
            self.rows.join(self.copies, ["n", "f1", "f2"], "left")
            .withColumn("at", F.coalesce("rep", "node"))
            .join(named.withColumnRenamed("node", "at"), "at", "left")
            .select(
                "doc_id", "key", F.col("n").alias("n_shingles"),
                F.when(words, F.coalesce("component", "first_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                F.when(words, F.coalesce("label", "at")).alias("group"),
            )
        )


def jaccard_classes(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """doc_id, row key, n_shingles, component_id and group of every document."""
    with small_batches(docs.sparkSession), short_shuffles(docs.sparkSession):  # all steps that run Python are written inside
        return Join(docs, similarity).classes()


def one_of_each(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """The documents without near copies: of each group the one with the smallest id stays.

    Null ids come after others; of repeated rows one stays; documents without words all stay.
    """
    with short_shuffles(docs.sparkSession):
        with noted() as spent:
            found = jaccard_classes(docs, similarity)
        classes = materialize(found)
        drop(docs.sparkSession, spent)
        repeated = (
            classes.filter(F.col("group").isNotNull()).groupBy("doc_id", "key").agg(F.count("*").alias("times"))
            .filter("times > 1").select("doc_id", "key")
        )
        unique = repeated.isEmpty()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = classes.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min(order).alias("first"))
    keep = first.select("first.doc_id", "first.key").union(
        classes.filter(F.col("group").isNull()).select("doc_id", "key").distinct()
    )
    rows = docs.select(packed(docs).alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("key"))

    def among(other: DataFrame, how: str) -> DataFrame:
        other = other.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
        return rows.join(other, F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), how)

    if unique:
        return among(keep, "left_semi").select("doc.*")
    both = repeated.join(keep, (repeated["doc_id"].eqNullSafe(keep["doc_id"])) & (repeated["key"] == keep["key"]), "left_semi")
    rows = among(keep, "left_semi")
    once = among(both, "left_semi")
    return among(both, "left_anti").select("doc.*").union(
        once.groupBy(F.col("doc.doc_id"), "key").agg(F.first("doc").alias("doc")).select("doc.*")
    )
