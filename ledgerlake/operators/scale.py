"""Building blocks that keep a hot key, a hot value or a huge group out of a single task."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ledgerlake.session import shared_dir

NO_BAND = -1_000_000  # below every band of a decimal amount


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` becomes a group limit before the shuffle, so a hot key sends at most one
    row per task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def value_band(value: Column) -> Column:
    """A monotone, finely graded band of a number: 1024 logarithmic bands per doubling.

    Ranks and medians are taken in two steps, band first. The distinct amounts of one band are
    few (0.07 % of the amount in cents), however many rows share them.
    """
    cents = value.cast("double") * 100
    band = F.floor(F.log2(F.abs(cents) + 1) * 1024)
    return F.when(value < 0, -band).otherwise(band)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median of a decimal or whole-number amount per key, whatever the size of a key.

    Equal values are counted first; the bands that hold the middle positions are found from the
    band counts; only those bands are then put in order. One way for all sizes: the result has one
    decimal more than the amount, which the mean of two amounts needs. Floating-point amounts are
    refused, as equal sums of them need not be equal.
    """
    kind = df.schema[value].dataType
    if not isinstance(kind, (T.DecimalType, T.IntegralType)):
        raise TypeError(f"exact_median needs a decimal or whole-number column, not {kind.simpleString()}")
    precision, scale = (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else (20, 0)
    result = T.DecimalType(min(38, precision + 1), scale + 1)
    df = df.filter(F.col(value).isNotNull())
    counted = df.groupBy(
        value_band(F.col(value)).alias("_band"), F.struct(*keys).alias("_key"), F.col(value).alias("_v")
    ).agg(F.count("*").alias("_n"))
    per_key = W.partitionBy("_key")
    bands = (
        counted.groupBy("_band", "_key")
        .agg(F.sum("_n").alias("_in_band"))
        .withColumn("_upto", F.sum("_in_band").over(per_key.orderBy("_band")))
        .withColumn("_total", F.sum("_in_band").over(per_key))
        .withColumn("_lo", F.expr("(_total + 1) div 2"))
        .withColumn("_hi", F.expr("_total div 2 + 1"))
        .filter("_upto >= _lo and _upto - _in_band < _hi")
        .select("_band", "_key", (F.col("_upto") - F.col("_in_band")).alias("_before"), "_lo", "_hi")
    )
    in_band = W.partitionBy("_band", "_key").orderBy("_v")
    middle = (
        counted.join(bands, ["_band", "_key"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(in_band))
        .filter("_upto >= _lo and _upto - _n < _hi")
    )
    # One or two values remain per key; their mean is the median.
    mean = ((F.min("_v").cast(result) + F.max("_v").cast(result)) / 2).cast(result)
    return middle.groupBy("_key").agg(mean.alias(name)).select("_key.*", name)


def dense_ranks_desc(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``dense_rank`` by descending value, as a table of (keys, value, rank).

    The distinct values are ranked band by band and the
    number of values in the bands above is added, so no group has to fit one task. Null ranks last.
    The distinct values are written once, as both steps read them.
    """
    # As a struct, null keys equal each other and the join below needs no second shuffle. The band
    # and the value lead the sort orders, where they tell rows apart sooner than the keys.
    band = F.coalesce(value_band(F.col(value)), F.lit(NO_BAND))
    distinct = materialize(df.select(band.alias("_band"), F.struct(*keys).alias("_key"), value).distinct())
    above = W.partitionBy("_key").orderBy(F.col("_band").desc()).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        distinct.groupBy("_band", "_key")
        .agg(F.count("*").alias("_n"))
        .select("_band", "_key", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    )
    in_band = W.partitionBy("_band", "_key").orderBy(F.col(value).desc_nulls_last())
    return (
        distinct.withColumn("_rank", F.row_number().over(in_band))
        .join(offsets, ["_band", "_key"])
        .select("_key.*", value, (F.col("_rank") + F.col("_above")).alias(name))
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join where null keys match each other; the keys come from the left side."""
    match = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    extra = [f"r.{c}" for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), match).select("l.*", *extra)


def with_position(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Global row numbers from 1 in the given total order.

    The sorted rows are checkpointed to the shared folder, which fixes their partitions; a row's
    number is its place in its partition plus the sizes of the partitions before it. This runs a
    job while the plan is built.
    """
    shared_dir(df.sparkSession)
    place = F.monotonically_increasing_id()
    fixed = (
        df.orderBy(*order).checkpoint()
        .withColumn("_id", place)
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition: small by construction.
    sizes = fixed.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        fixed.join(offsets, "_part")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_id", "_part", "_place", "_before")
    )


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be taken in two steps: ``first`` over rows, ``then`` over its results."""

    first: Column
    then: Callable[[Column], Column]


def added(column: Column) -> Measure:
    return Measure(column, F.sum)


def lowest(column: str) -> Measure:
    return Measure(F.min(column), F.min)


def highest(column: str) -> Measure:
    return Measure(F.max(column), F.max)


def mean_of(total: str, n: str, kind: str = "decimal(22,6)") -> Column:
    """Mean of a two-decimal amount from its sum and count, typed like the built-in average."""
    return (F.col(total) / F.nullif(F.col(n), F.lit(0))).cast(kind)


def aggregate_once(
    df: DataFrame, keys: Sequence[str], measures: dict[str, Measure], distinct: dict[str, str], drop_null_keys: bool = False
) -> DataFrame:
    """Measures and distinct counts (name -> column) from one scan.

    The rows are reduced once to the keys and the distinct columns, with the measures' first
    steps; everything is taken from that. Each distinct count beyond the first reads the same
    shuffle again and joins on the keys, so no row is copied per distinct column.
    """
    if drop_null_keys:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    columns = list(dict.fromkeys(distinct.values()))
    reduced = df.groupBy(*keys, *[c for c in columns if c not in keys]).agg(
        *[m.first.alias(f"_{name}") for name, m in measures.items()]
    )
    out = None
    for i, (name, column) in enumerate(distinct.items()):
        count = F.count_distinct(column).alias(name)
        more = [] if i else [m.then(F.col(f"_{n}")).alias(n) for n, m in measures.items()]
        part = reduced.groupBy(*keys).agg(*more, count)
        out = part if out is None else out.join(part, list(keys)) if drop_null_keys else join_null_safe(out, part, keys)
    return out


def aggregate_apart(
    df: DataFrame, keys: Sequence[str], measures: dict[str, Column], distinct: dict[str, str], drop_null_keys: bool = False
) -> DataFrame:
    """Measures, which shrink to a row per key and task before the shuffle, and each distinct count by itself.

    Where there are several distinct columns, no row then carries the measures once per value of them;
    each count reads its own column and the keys only.
    """
    if drop_null_keys:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    out = df.groupBy(*keys).agg(*[c.alias(name) for name, c in measures.items()])
    for name, column in distinct.items():
        part = df.groupBy(*keys).agg(F.count_distinct(column).alias(name))
        out = out.join(part, list(keys)) if drop_null_keys else join_null_safe(out, part, keys)
    return out


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back, for a result that several branches use.

    A lost executor then costs a re-read, not a second pass over the fact table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerlake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
