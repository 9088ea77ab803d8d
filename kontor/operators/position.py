"""Position of each row in a total order, without one task for all rows.

Rows are dealt to partitions by ranges of the order and sorted there; the result is
checkpointed, so partitions and places in them stay what they are. A partition's first
position is the sum of the sizes of those before it: one row a partition is counted, and
joined back. A row's place in its partition is part of Spark's own increasing id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontor.session import shared_folder

# Spark's increasing id holds the partition above this many bits.
PLACE_BITS = 33


def with_position(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with a column ``name``: 1, 2, ... in the order of ``order_by`` (NULLs first).

    Rows that are equal in ``order_by`` get their positions in any order among themselves.
    No rows give no rows.
    """
    shared_folder(df.sparkSession)
    order = [F.col(f"`{c}`").asc_nulls_first() for c in order_by]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    placed = ranged.withColumn("_place", F.monotonically_increasing_id())
    part = F.shiftright("_place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # As many rows as partitions: the one window without a key here.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    at = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    return placed.join(F.broadcast(starts), part == F.col("_part")).select(
        *[F.col(f"`{c}`") for c in df.columns if c != name], at.alias(name)
    )
