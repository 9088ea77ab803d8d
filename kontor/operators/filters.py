"""Interval filters over the ledger and the raw feeds.

Two conventions exist and both are kept, by name:

* ``interval_closed``: ``event_date BETWEEN lo AND hi`` on the ledger's
  'yyyy-MM-dd' text, both ends included (the DataFrame reports).
* ``epoch_half_open``: ``lo <= instant < hi`` on raw epoch seconds (the SQL
  report). Written on the bare column, not on ``from_unixtime(column)``, so
  Parquet can skip row groups by their min/max statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.functions.columns import col_of, epoch_of


def interval_closed(
    df: DataFrame,
    lo: str,
    hi: str,
    date_col: str = "event_date",
    month_col: str | None = "month",
) -> DataFrame:
    """Rows with ``lo <= event_date <= hi`` (text comparison).

    The implied ``month`` range is added as well: on a ledger partitioned by
    month it prunes whole directories, elsewhere it is a cheap extra predicate.
    It never changes the result, since month is the 7-character prefix of
    event_date and prefixes keep the text order.
    """
    out = df.where(F.col(date_col).between(lo, hi))
    if month_col and month_col in df.columns:
        out = out.where(F.col(month_col).between(lo[:7], hi[:7]))
    return out


def epoch_half_open(instant: str | Column, lo_day: str, hi_day: str) -> Column:
    """``lo_day 00:00 UTC <= instant < hi_day 00:00 UTC`` on epoch seconds."""
    c = col_of(instant)
    return (c >= F.lit(epoch_of(lo_day))) & (c < F.lit(epoch_of(hi_day)))
