"""Cohort restriction: keep the ledger rows of a list of accounts.

The list stays a DataFrame and the restriction is a left-semi join: no list is
pulled to the driver or inlined into the plan as a literal IN set. Duplicates
in the cohort do not matter to a semi join, so no distinct (and no shuffle)
is needed on that side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from kontor.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, broadcast_if_small


def restrict_to_cohort(
    df: DataFrame,
    cohort: DataFrame,
    key: str = "account_id",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    side, _ = broadcast_if_small(cohort.select(key), max_broadcast_bytes)
    return df.join(side, key, "left_semi")
