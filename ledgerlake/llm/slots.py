"""Sharding by fixed virtual slots.

Every record is hashed into one of a few thousand slots. Bytes are added up per slot, and a small
versioned map says which shard holds which slot. Rebalancing and growing edit the map, not the
hash, so only the rows of the moved slots change their shard.

The slot is drawn from id and text, so copies of a text under several ids go to several shards: the law is that
of equal bytes, and a group of copies with a third of all rows would break it. With a folder for maps the
result depends on the map that an earlier run left there: rows stay where they are while bytes drift little.
Run one job at a time on such a folder.

Null texts have no bytes, null ids are hashed like any value, repeated rows share a slot, very long texts count
whole, slots of equal size tie by their number, and an empty table gives empty results. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ledgerlake.llm.text import byte_size, packed, row_key
from ledgerlake.llm.scratch import materialize
from ledgerlake.sources.tables import latest_version, read_version, write_version

SLOTS = 4096
DRIFT = 0.1  # share of the mean by which a shard's bytes may be off before slots move
RECORD_OVERHEAD = 8  # bytes a record takes beside its text


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(row_key(doc_id, text), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every document."""
    doc_id, text = F.col("doc_id"), F.col("text")
    return docs.select(
        doc_id,
        (byte_size(text) + RECORD_OVERHEAD).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        virtual_slot(doc_id, text, slots).alias("virtual_slot"),
    )


def slot_totals(recs: DataFrame) -> DataFrame:
    """Bytes and rows per slot: at most ``slots`` rows, summed before the shuffle."""
    return recs.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def first_map(spark: SparkSession, totals: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map: slots from the largest to the smallest, each to the shard that is lightest so far.

    The fold runs over one row with an array of ``slots`` entries, a fixed number whatever the data.
    """
    every = (
        spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
        .join(totals, "virtual_slot", "left")
        .select(
            "virtual_slot",
            F.coalesce("slot_bytes", F.lit(0)).alias("slot_bytes"),
            F.coalesce("slot_rows", F.lit(0)).alias("slot_rows"),
        )
    )
    largest_first = F.array_sort(
        F.collect_list(F.struct((-F.col("slot_bytes")).alias("neg"), "virtual_slot", "slot_rows"))
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
        F.array().cast("array<int>").alias("shard"),
    )

    def place(state: Column, slot: Column) -> Column:
        lightest = (F.array_position(state["load"], F.array_min(state["load"])) - 1).cast("int")
        load = F.transform(state["load"], lambda x, i: F.when(i == lightest, x - slot["neg"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(state["shard"], F.array(lightest)).alias("shard"))

    return (
        every.agg(largest_first.alias("s"))
        .select("s", F.aggregate("s", start, place)["shard"].alias("shard"))
        .select(F.explode(F.arrays_zip("s", "shard")).alias("x"))
        .select(
            F.lit(1).alias("version"),
            "x.s.virtual_slot",
            "x.shard",
            (-F.col("x.s.neg")).alias("slot_bytes"),
            "x.s.slot_rows",
        )
    )


def grow_map(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for ``shards`` shards, one or more of them new.

    Each old shard keeps slots up to its new share of the bytes; the slots above it are dealt to
    the new shards, largest first. No slot moves between old shards.
    """
    everything = W.partitionBy(F.lit(0))  # a row per slot: a fixed number
    per_shard = W.partitionBy("shard").orderBy(F.col("slot_bytes").desc(), "virtual_slot")
    old = (
        slot_map.withColumn("_share", F.sum("slot_bytes").over(everything) / shards)
        .withColumn("_old", F.max("shard").over(everything) + 1)
        .withColumn("_upto", F.sum("slot_bytes").over(per_shard))
        .withColumn("_moves", F.col("_upto") > F.col("_share"))
    )
    moved = W.partitionBy("_moves").orderBy(F.col("slot_bytes").desc(), "virtual_slot")
    new = F.col("_old") + F.pmod(F.row_number().over(moved) - 1, F.lit(shards) - F.col("_old"))
    grows = F.col("_old") < shards
    return old.select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.when(F.col("_moves") & grows, new).otherwise(F.col("shard")).cast("int").alias("shard"),
        "slot_bytes",
        "slot_rows",
    )


def rebalanced(slot_map: DataFrame, totals: DataFrame, shards: int, drift: float = DRIFT) -> DataFrame:
    """A map with the present bytes and rows of its slots, and the next version of it if loads have drifted.

    They have if a shard's bytes are off the mean by more than ``drift`` of it. Then slots go from the
    heaviest shard to the lightest, the largest that narrows their distance first; all others stay. New
    shards begin empty, and slots of shards that are no more go to the lightest. The map has a fixed number
    of rows, so it is edited on the driver.
    """
    now = slot_map.select("version", "virtual_slot", "shard").join(totals, "virtual_slot", "left").na.fill(0, ["slot_bytes", "slot_rows"])
    rows = sorted(now.collect(), key=lambda r: (-r["slot_bytes"], r["virtual_slot"]))
    shard = {r["virtual_slot"]: r["shard"] for r in rows}
    size = {r["virtual_slot"]: r["slot_bytes"] for r in rows}
    load = [0] * shards
    for slot, of in shard.items():
        if of < shards:
            load[of] += size[slot]
    for slot, of in shard.items():
        if of >= shards:
            shard[slot] = load.index(min(load))
            load[shard[slot]] += size[slot]
    mean = sum(load) / shards
    if max(load) > (1 + drift) * mean or min(load) < (1 - drift) * mean:
        for _ in range(len(shard)):
            heavy, light = load.index(max(load)), load.index(min(load))
            fits = next((s for s, of in shard.items() if of == heavy and 0 < 2 * size[s] <= load[heavy] - load[light]), None)
            if fits is None or max(load) <= (1 + drift / 2) * mean and min(load) >= (1 - drift / 2) * mean:
                break
            shard[fits] = light
            load[heavy] -= size[fits]
            load[light] += size[fits]
    moved = any(shard[r["virtual_slot"]] != r["shard"] for r in rows)
    return now.sparkSession.createDataFrame(
        [(r["version"] + moved, r["virtual_slot"], shard[r["virtual_slot"]], r["slot_bytes"], r["slot_rows"]) for r in rows],
        "version int, virtual_slot int, shard int, slot_bytes long, slot_rows long",
    )


def stored_map(recs: DataFrame, maps: str | None, shards: int, slots: int = SLOTS, drift: float = DRIFT) -> DataFrame:
    """The map for these records, kept by version in the folder ``maps``; without one, a first map of its own.

    The first map is built only where none is stored; later ones are the stored one, edited where needed. An
    empty table has no map to keep.
    """
    spark, totals = recs.sparkSession, slot_totals(recs)
    if maps is None:
        return materialize(first_map(spark, totals, shards, slots))
    totals = materialize(totals)
    known = latest_version(spark, maps)
    if known is None:
        built = first_map(spark, totals, shards, slots)
        return materialize(built) if totals.isEmpty() else write_version(built, maps, 1)
    old = read_version(spark, maps, known).drop("v")
    if old.count() != slots:
        raise ValueError(f"the map in {maps} is not for {slots} slots")
    new = materialize(rebalanced(old, totals, shards, drift))
    version = new.first()["version"]
    return new if version == known else write_version(new, maps, version)


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Every record with its shard and its gapless position in the shard.

    The map has a fixed number of rows, so it is broadcast. Positions are numbered per virtual
    slot and moved by the rows of the shard's earlier slots, so no task holds a whole shard.
    """
    earlier = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    offsets = slot_map.select(
        "virtual_slot", "shard", F.coalesce(F.sum("slot_rows").over(earlier), F.lit(0)).alias("_before"), "version"
    )
    in_slot = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        recs.withColumn("_nth", F.row_number().over(in_slot) - 1)
        .join(F.broadcast(offsets), "virtual_slot")
        .withColumn("slot", (F.col("_before") + F.col("_nth")).cast("long"))
        .drop("_before", "_nth")
    )


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot and map version per document.

    The law is ``bytes``: the shards' sizes are near equal, as far as single slots allow. ``maps`` is the
    folder of the stored map; later calls with it move rows only where the bytes have drifted.
    """
    recs = records(docs, slots)
    slot_map = stored_map(recs, maps, shards, slots)
    return place(recs, slot_map).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )


def with_shard(docs: DataFrame, shards: int = 24, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """The documents with their virtual_slot and shard; columns of these names are replaced."""
    slot_map = stored_map(records(docs, slots), maps, shards, slots)
    others = docs.drop("virtual_slot", "shard")
    rows = docs.select(packed(others).alias("doc"), virtual_slot(F.col("doc_id"), F.col("text"), slots).alias("virtual_slot"))
    return rows.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot").select(
        "doc.*", "virtual_slot", "shard"
    )
