"""WARC fixity: Merkle trees over ordered offset ranges, compared between replicas.

A WARC file is a run of records at byte offsets. A leaf hashes a record with its
offset and length. A node of level 1 hashes the leaves whose records begin in one
range of ``RANGE_BYTES`` of a file, in order of offset; a node of level k + 1 hashes
the nodes of ``FANOUT`` neighbouring ranges of level k. The range of a node depends on
offsets alone, so damage in one place changes only the nodes above it. Above a file's
highest level stands its root.

Two replicas are compared root by root; from there only the children of nodes that
differ are looked at, level by level, down to the records. Records are never sorted
across the archive or gathered: a node gathers at most ``FANOUT`` children, or the
records that begin in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import stored

RANGE_BYTES = 1 << 18
FANOUT = 16
# Pages of a file, by page_id; pages without id are dealt to files by hash.
PAGES_PER_FILE = 512


def warc_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, file, length, digest, record): pages as WARC response records, the
    SHA-256 of each, and the file it goes to: ``PAGES_PER_FILE`` consecutive ids a file.

    Null url and html are empty. Pages without id go to files named by a hash of their
    content, as many as their number asks for; equal rows are several records.
    """
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    target = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    pid = F.col(f"`{page_id}`")
    name = F.coalesce(pid.cast("string"), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        name,
        F.lit(">\r\nWARC-Target-URI: "),
        target,
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )
    loose = max(1, -(-pages.where(pid.isNull()).count() // PAGES_PER_FILE))
    file = F.when(pid.isNotNull(), F.floor(pid / F.lit(PAGES_PER_FILE))).otherwise(
        -1 - F.pmod(F.xxhash64(target, body), F.lit(loose))
    )
    return pages.select(
        pid.alias("page_id"),
        file.cast("bigint").alias("file"),
        F.octet_length(record).cast("bigint").alias("length"),
        digest(record).alias("digest"),
        record.alias("record"),
    )


def digest(record: Column) -> Column:
    """SHA-256 of a record's bytes; null counts as empty."""
    return F.sha2(F.coalesce(record.cast("binary"), F.lit("").cast("binary")), 256)


def placed(records: DataFrame) -> DataFrame:
    """``records`` with ``offset``: in a file they stand in order of (page_id, digest). Only
    what is read of the result is shuffled, so ask for the digest, not the record."""
    order = Window.partitionBy("file").orderBy(F.col("page_id").asc_nulls_first(), "digest")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return records.withColumn("offset", F.coalesce(before, F.lit(0)))


def leaves(records: DataFrame) -> DataFrame:
    """(file, at, length, hash) of records with file, offset, length and digest (or the
    record itself): ``at`` is the offset. Rows that stand at one place of a file are one
    leaf over all their hashes."""
    content = F.col("digest") if "digest" in records.columns else digest(F.col("record"))
    place = F.concat_ws(":", F.lit("leaf"), F.col("offset").cast("string"), F.col("length").cast("string"), content)
    own = records.select("file", F.col("offset").alias("at"), "length", F.sha2(place, 256).alias("hash"))
    hashes = F.array_sort(F.collect_list("hash"))
    return own.groupBy("file", "at").agg(
        F.sum("length").alias("length"),
        F.when(F.count(F.lit(1)) == 1, F.first("hash")).otherwise(F.sha2(F.array_join(hashes, ","), 256)).alias("hash"),
    )


def _node(children: Column) -> Column:
    """Hash of children (place, hash), in order of place."""
    text = F.array_join(F.transform(F.array_sort(children), lambda c: F.concat_ws(":", c["at"].cast("string"), c["hash"])), ",")
    return F.sha2(F.concat(F.lit("node:"), text), 256)


def _level(below: DataFrame, place: Column) -> DataFrame:
    """(file, at, hash): nodes over ``below`` (file, at, hash), dealt by ``place``."""
    return (
        below.select("file", place.alias("up"), F.struct("at", "hash").alias("child"))
        .groupBy("file", "up")
        .agg(_node(F.collect_list("child")).alias("hash"))
        .select("file", F.col("up").alias("at"), "hash")
    )


def tree(leaf_rows: DataFrame, levels: int) -> list[DataFrame]:
    """Levels 1 to ``levels`` over leaves, each (file, at, hash); ``at`` numbers the ranges.
    The lowest is written once, the others are aggregates of a few nodes over it."""
    out = [stored(_level(leaf_rows, F.floor(F.col("at") / F.lit(RANGE_BYTES))))]
    for _ in range(1, levels):
        out.append(_level(out[-1], F.floor(F.col("at") / F.lit(FANOUT))))
    return out


def levels_for(size: int) -> int:
    """Levels so that the highest has one node for a file of ``size`` bytes."""
    n, span = 1, RANGE_BYTES
    while span < size:
        n, span = n + 1, span * FANOUT
    return n


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(file, at, ours, theirs): places whose hashes differ; null where a side has none,
    each side a struct of the columns it has beside file and at."""

    def side(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in ("file", "at")]
        return df.select(F.col("file").alias(f"f_{name}"), F.col("at").alias(f"at_{name}"), F.struct(*rest).alias(name))

    a, b = side(ours, "ours"), side(theirs, "theirs")
    same = F.col("f_ours").eqNullSafe(F.col("f_theirs")) & (F.col("at_ours") == F.col("at_theirs"))
    return (
        a.join(b, same, "full_outer")
        .where(~F.col("ours.hash").eqNullSafe(F.col("theirs.hash")))
        .select(
            F.when(F.col("ours").isNotNull(), F.col("f_ours")).otherwise(F.col("f_theirs")).alias("file"),
            F.coalesce("at_ours", "at_theirs").alias("at"),
            "ours",
            "theirs",
        )
    )


def _below(df: DataFrame, suspects: DataFrame, step: int) -> DataFrame:
    above = suspects.select(F.col("file").alias("_file"), F.col("at").alias("_at"))
    child = F.col("file").eqNullSafe(F.col("_file")) & (F.floor(F.col("at") / F.lit(step)) == F.col("_at"))
    return df.join(above, child, "left_semi")


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, offset, length, replica_length, damage): the records in which two replicas differ.

    Both have file, offset, length and digest or record; other columns are ignored. ``damage`` is
    ``changed``, ``missing`` (only the original has a record there) or ``extra`` (only the
    replica has). Null records are empty ones, a null file is a file; equal archives,
    empty ones among them, give no rows. The leaves and lowest nodes of both are written
    once to the shared folder; the comparison goes from the roots down.
    """
    ours, theirs = stored(leaves(original)), stored(leaves(replica))
    largest = max((x.agg(F.max(F.col("at") + F.col("length"))).first()[0] or 0) for x in (ours, theirs))
    levels = levels_for(largest)
    a, b = tree(ours, levels), tree(theirs, levels)
    suspects = stored(_differing(a[-1], b[-1]).select("file", "at"))
    for x, y in zip(a[-2::-1], b[-2::-1]):
        suspects = stored(_differing(_below(x, suspects, FANOUT), _below(y, suspects, FANOUT)).select("file", "at"))
    found = _differing(_below(ours, suspects, RANGE_BYTES), _below(theirs, suspects, RANGE_BYTES))
    return found.select(
        "file",
        F.col("at").alias("offset"),
        F.col("ours.length").alias("length"),
        F.col("theirs.length").alias("replica_length"),
        F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("changed").alias("damage"),
    )
