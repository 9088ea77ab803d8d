"""Join helpers: a broadcast that is taken only behind a size check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bound for a broadcast side. The relation is copied to every executor
# and built into a hash table there, so keep it well below executor memory.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Bytes per value as Spark's own size estimates count them (strings: 20).
_WIDTH = {
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.ShortType: 2,
    T.ByteType: 1,
    T.BooleanType: 1,
    T.StringType: 20,
}


def fixed_row_bytes(schema: T.StructType) -> int:
    """Bytes of an unsafe row without its string contents: null bits, one
    8-byte slot per field, fixed-width values, 8-byte alignment per string."""
    strings = sum(1 for f in schema.fields if isinstance(f.dataType, T.StringType))
    return (
        8 * len(schema.fields)
        + 8
        + sum(_WIDTH.get(type(f.dataType), 32) for f in schema.fields if not isinstance(f.dataType, T.StringType))
        + 8 * strings
    )


def bytes_aggregate(df: DataFrame) -> F.Column:
    """Aggregate: rows x fixed row bytes + actual bytes of every string."""
    total = F.count(F.lit(1)) * F.lit(fixed_row_bytes(df.schema))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            total = total + F.coalesce(F.sum(F.octet_length(F.col(f.name))), F.lit(0))
    return total.cast("bigint")


def measured_bytes_many(dfs: list[DataFrame]) -> list[int]:
    """Measured size of each frame (see ``measured_bytes``), all in one job:
    the one-row aggregates are unioned and collected together."""
    parts = [df.agg(F.lit(i).alias("_i"), bytes_aggregate(df).alias("_bytes")) for i, df in enumerate(dfs)]
    got = {r["_i"]: int(r["_bytes"]) for r in reduce(DataFrame.unionByName, parts).collect()}
    return [got[i] for i in range(len(dfs))]


def measured_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as unsafe rows, measured in one aggregate job: the row
    count times the fixed part of a row, plus the actual bytes of every string
    value (variable-length values are counted, not estimated)."""
    return measured_bytes_many([df])[0]


def broadcast_if_small(
    df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast when its measured size is under ``max_bytes``.

    The size is measured, not guessed from file sizes: one aggregate over the
    (small, pruned) dimension side counts its rows and string bytes. Beyond
    the bound the frame is returned unchanged and Spark plans a shuffle join,
    where AQE can still split skewed partitions or demote it to a broadcast
    from runtime statistics.
    """
    fits = measured_bytes(df) <= max_bytes
    return (F.broadcast(df) if fits else df), fits
