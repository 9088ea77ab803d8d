"""Exact discrete percentiles of whole numbers by counting.

Equal values are counted per group (partial sums on the map side), the counts are summed
along the values, and a percentile is the least value whose share of the rows up to it
reaches the rank. What a group keeps in order is its different values, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, str]) -> DataFrame:
    """(keys, one column for each ``name -> rank``), a rank being a decimal text such as
    "0.99": the least value that at least this share of the group's values doesn't exceed.
    NULL values don't count; a group without values has NULLs; NULL keys are a group."""
    keys = list(keys)
    counts = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count(value).alias("_count"))
    group = Window.partitionBy(*keys)
    along = group.orderBy(F.col("_value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.select(
        *keys, "_value", F.sum("_count").over(along).alias("_upto"), F.sum("_count").over(group).alias("_all")
    )

    def percentile(rank: str):
        # Whole numbers on both sides: the rank's decimals move to the left.
        digits = len(rank.partition(".")[2])
        needed = F.col("_all") * F.lit(int(rank.replace(".", "")))
        return F.min(F.when(F.col("_upto") * F.lit(10**digits) >= needed, F.col("_value")))

    return summed.groupBy(*keys).agg(*[percentile(r).alias(n) for n, r in ranks.items()])
