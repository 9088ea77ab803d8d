"""The rows of the ledger and of its instants are shuffled as seldom as can be."""

import re

import pytest
from pyspark.sql import functions as F

from kontor.functions.windows import account_sequence_window, account_trailing_window
from kontor.operators.sequence import sequence_columns, trailing_counts, txn_dimensions
from kontor.plans.reports import kpi_series

DAY = 86400
LONG = 2 << 24  # longer than a stretch


@pytest.fixture()
def fixed_plans(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _ledger(spark, n=600):
    """Rows of a join, as the transfers are; some ids, instants and accounts are NULL or twice."""
    i = F.col("id")
    moves = spark.range(n).select(
        (i % 50).alias("order"),
        F.when(i % 17 != 0, i - i % 3).alias("txn_id"),
        (i % 5).cast("double").alias("amount"),
        F.when(i % 41 != 0, (i % 90) * DAY * 20 + (i % 2) * 30).alias("txn_requested_at"),
        F.when(i % 4 != 0, (i * DAY).cast("string")).otherwise("None").alias("txn_completed_at"),
        F.when(i % 4 != 0, "completed").otherwise("failed").alias("status"),
        F.lit("in").alias("in_or_out"),
        F.lit("pix").alias("product"),
        F.concat(F.lit("2020-0"), i % 9).alias("month"),
        F.concat(F.lit("2020-0"), i % 9, F.lit("-01")).alias("event_date"),
    )
    owners = spark.range(50).select(F.col("id").alias("owned"), F.when(F.col("id") > 0, F.col("id") % 6).alias("account_id"))
    return moves.join(owners, F.col("order") == F.col("owned")).drop("order", "owned")


def _shuffles(df) -> list[str]:
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [x for x in lines if re.match(r"[\s:|+-]*Exchange hashpartitioning", x)]


def _points(df) -> int:
    """Exchanges of points by their stretch."""
    return sum("REPARTITION_BY_COL" in x and "_stretch" in x for x in _shuffles(df))


def test_trailing_counts_are_counted_where_the_points_are(spark, fixed_plans):
    # the feed's two sides, rows, instants, points, numbers
    assert len(_shuffles(trailing_counts(_ledger(spark), {"day": DAY, "long": LONG}))) <= 6


def test_dimensions_share_the_points_and_the_feed(spark, fixed_plans):
    df = txn_dimensions(_ledger(spark))
    assert _points(df) == 1
    assert sum("(owned" in x or "(order" in x for x in _shuffles(df)) == 2


@pytest.mark.parametrize("metric", ["total_first_txn_orders", "avg_recency"])
def test_series_share_the_points_and_the_feed(spark, fixed_plans, metric):
    df = kpi_series(_ledger(spark), [metric])
    assert _points(df) == 1
    assert sum("(owned" in x or "(order" in x for x in _shuffles(df)) == 2
    assert "event_date" not in df._jdf.queryExecution().optimizedPlan().toString().split("Range (")[0]


def test_frames_over_the_ends_of_stretches_equal_plain_windows(spark):
    df = _ledger(spark)
    windows = {"none": 0, "day": DAY, "stretch": (1 << 24) - 1, "whole": 1 << 24, "long": LONG, "longer": 5 << 24}
    plain = df.select("*", *[F.count(F.lit(1)).over(account_trailing_window(s)).alias(n) for n, s in windows.items()])
    got = trailing_counts(df, windows).select(*plain.columns)
    assert got.count() == plain.count()
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_first_of_an_instant_equals_plain_windows(spark):
    df = _ledger(spark)
    plain = df.withColumn("last_txn_date", F.lag("txn_requested_at").over(account_sequence_window()))
    got = sequence_columns(df).select(*plain.columns)
    # Rows that are equal up to the tie-breakers change places in the plain window.
    kept = [c for c in plain.columns if c not in ("month", "event_date")]
    got, plain = got.select(*kept), plain.select(*kept)
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
