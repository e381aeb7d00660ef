"""Merkle fixity audit of web archives.

Pages become WARC response records in archive files; each record has its offset and length there.
The leaves of an archive's tree are record digests with their offset ranges, in offset order; each
node above hashes its ordered children, up to one root per archive.
Two replicas are compared from the roots down: only the children of branches that differ are
looked at, until the damaged records and their offset ranges are known.

Null urls and pages are empty, repeated pages are records of their own, ties in the order are broken
by the record's digest, very long pages are one record, and an empty table has no archives and no damage. Other columns are not
looked at. Group sizes are the fan-out, so no task holds an archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlake.llm.scratch import materialize

ARCHIVE_BYTES = 64 * 1024 * 1024
PARTS = 256  # parts in which an archive is laid out
FANOUT = 16
DRILL = 1009  # of the replica's records, one in so many is changed in the drill, and as many are lost


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC response record of a page."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def drawn(recs: DataFrame, archive_bytes: int) -> DataFrame:
    """With the archive and part of every record; archives hold about ``archive_bytes``.

    Both are drawn from page_id and url, so no host makes one large and a changed page stays in its place.
    """
    total = recs.agg(F.sum("length")).head()[0] or 0

    def draw(salt: int, of: int) -> Column:
        return F.pmod(F.xxhash64("page_id", "url_key", F.lit(salt)), F.lit(of))

    return recs.withColumn("archive", draw(1, total // archive_bytes + 1)).withColumn("part", draw(2, PARTS))


def archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """page_id, url_key, archive, part, length and digest of every page's record."""
    whole = record(F.col("page_id"), F.col("url"), F.col("html"))
    recs = pages.select(
        "page_id", F.xxhash64("url").alias("url_key"), F.sha2(whole, 256).alias("digest"),
        F.octet_length(whole).cast("long").alias("length"),
    )
    return drawn(recs, archive_bytes)


def laid_out(recs: DataFrame) -> DataFrame:
    """With ``seq`` and ``offset`` of every record in its archive.

    Records stand by part, then page_id and url; further columns are kept. Parts are summed first, so that no task holds an archive.
    """
    earlier = W.partitionBy("archive").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = recs.groupBy("archive", "part").agg(F.count("*").alias("n"), F.sum("length").alias("b")).select(
        "archive", "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b_before"),
    )
    order = W.partitionBy("archive", "part").orderBy("page_id", "url_key", "digest")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    further = [c for c in recs.columns if c not in ("page_id", "url_key", "archive", "part", "length", "digest")]
    return (
        recs.withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("b", F.coalesce(F.sum("length").over(before), F.lit(0)))
        .join(parts, ["archive", "part"])
        .select(
            "page_id", "archive", (F.col("n_before") + F.col("nth")).alias("seq"),
            (F.col("b_before") + F.col("b")).alias("offset"), "length", "digest", *further,
        )
    )


def leaves(records: DataFrame) -> DataFrame:
    """archive, pos, hash, start and end: a leaf per record, over its digest and offset range."""
    start, end = F.col("offset"), F.col("offset") + F.col("length")
    span = F.concat_ws(":", start, end, F.col("digest"))
    return records.select("archive", F.col("seq").cast("long").alias("pos"), F.sha2(span, 256).alias("hash"), start.alias("start"), end.alias("end"))


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: each node hashes its at most ``fanout`` children in order."""
    children = F.array_sort(F.collect_list(F.struct("pos", "hash")))
    return nodes.groupBy("archive", F.floor(F.col("pos") / fanout).alias("pos")).agg(
        F.sha2(F.array_join(F.transform(children, lambda c: c["hash"]), ""), 256).alias("hash"),
        F.min("start").alias("start"), F.max("end").alias("end"),
    )


def tree(records: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the leaves to the archives' roots; each is written, so comparing reads it again."""
    levels = [materialize(leaves(records))]
    while not levels[-1].filter("pos > 0").isEmpty():
        levels.append(materialize(parents(levels[-1], fanout)))
    return levels


def differing(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(archive, pos) of the leaves that differ, found from the roots down.

    Trees of different heights are brought to the same by hashing the lower one's root on.
    """
    while len(a) < len(b):
        a = [*a, materialize(parents(a[-1], fanout))]
    while len(b) < len(a):
        b = [*b, materialize(parents(b[-1], fanout))]
    suspects = None
    for left, right in zip(reversed(a), reversed(b)):
        if suspects is not None:
            parent = F.floor(F.col("pos") / fanout)
            above = suspects.select(F.col("archive").alias("in_archive"), F.col("pos").alias("under"))
            below = (F.col("archive") == F.col("in_archive")) & (parent == F.col("under"))
            left, right = (x.join(above, below, "left_semi") for x in (left, right))
        same = F.col("l.archive") == F.col("r.archive")
        suspects = materialize(
            left.alias("l").join(right.alias("r"), same & (F.col("l.pos") == F.col("r.pos")), "full")
            .filter(~F.col("l.hash").eqNullSafe(F.col("r.hash")))
            .select(F.coalesce("l.archive", "r.archive").alias("archive"), F.coalesce("l.pos", "r.pos").alias("pos"))
        )
        if suspects.isEmpty():
            break
    return suspects


def audit(records: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Every record of the first replica with its place and status: ok, changed or missing.

    ``records`` and ``replica`` have archive, seq, offset, length and digest. The audit's tree work
    is in ``differing``; the statuses of all others follow from equal hashes above them.
    """
    bad = differing(tree(records, fanout), tree(replica, fanout), fanout)
    there = replica.select(F.col("archive").alias("in"), F.col("seq").alias("at"), F.col("digest").alias("other"))
    suspects = (
        bad.join(there, (F.col("archive") == F.col("in")) & (F.col("pos") == F.col("at")), "left")
        .select(F.col("archive").alias("in"), F.col("pos").alias("at"), F.when(F.col("other").isNull(), "missing").otherwise("changed").alias("found"))
    )
    same = (F.col("archive") == F.col("in")) & (F.col("seq") == F.col("at"))
    return records.join(suspects, same, "left").select(
        *records.columns, F.coalesce("found", F.lit("ok")).alias("status")
    )


def stored(pages: DataFrame, one_in: int = DRILL, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Every page's record as a second copy holds it, written to the shared folder.

    row, page_id, url_key, digest and length are the original's; ``bytes`` is the copy's record. A byte in the
    middle is changed in one record in ``one_in``, drawn by digest, and in the lowest draw of every archive, so
    that each archive has damage to find; one record in ``one_in`` is lost (null).
    """
    whole = F.encode(record(F.col("page_id"), F.col("url"), F.col("html")), "UTF-8")
    recs = pages.select("page_id", F.xxhash64("url").alias("url_key"), whole.alias("whole")).select(
        "*", F.sha2("whole", 256).alias("digest"), F.octet_length("whole").cast("long").alias("length")
    )
    recs = drawn(recs, archive_bytes).withColumn("draw", F.conv(F.substring("digest", 13, 12), 16, 10).cast("long"))
    # Written, so that the planner knows how few they are; else the records are dealt by digest, which is even.
    first = recs.groupBy("archive").agg(F.min(F.struct("draw", "digest")).alias("first"))
    lowest = materialize(first.select(F.col("first.digest").alias("lowest")).distinct())
    drill = F.pmod("draw", F.lit(one_in))
    middle = F.floor(F.col("length") / 2).cast("int") + 1
    there = F.substr("whole", middle, F.lit(1))
    other = F.when(there == F.lit(b"#"), F.lit(b"*")).otherwise(F.lit(b"#"))
    damaged = F.overlay("whole", other, middle, F.lit(1))
    kept = F.when((drill == 0) | F.col("lowest").isNotNull(), damaged).when(drill != 1, F.col("whole"))
    return materialize(
        recs.join(lowest, F.col("digest") == F.col("lowest"), "left")
        .select(F.monotonically_increasing_id().alias("row"), "page_id", "url_key", "digest", "length", kept.alias("bytes"))
    )


def replica_of(copy: DataFrame, records: DataFrame) -> DataFrame:
    """archive, seq, offset, length and digest of the copy's records, hashed from the bytes stored.

    They have their places in the archives from the original's index (``records`` with ``row``).
    """
    read = copy.filter(F.col("bytes").isNotNull()).select(
        F.col("row").alias("at_row"), F.sha2("bytes", 256).alias("read"), F.octet_length("bytes").cast("long").alias("size")
    )
    return records.join(read, F.col("row") == F.col("at_row")).select(
        "page_id", "archive", "seq", "offset", F.col("size").alias("length"), F.col("read").alias("digest")
    )


def fixity_audit(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, one_in: int = DRILL) -> DataFrame:
    """page_id, archive, seq, offset, length, digest and status of every page's record in a drill."""
    copy = stored(pages, one_in, archive_bytes)
    records = materialize(laid_out(drawn(copy.drop("bytes"), archive_bytes)))
    return audit(records.drop("row"), materialize(replica_of(copy, records)))
