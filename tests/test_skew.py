"""A hot account (half of all rows) must not land in one window task."""

import pytest
from pyspark.sql import functions as F

from kontor.functions.windows import account_ever_window, account_sequence_window
from kontor.operators.sequence import sequence_columns, trailing_count
from kontor.schemas import LEDGER

N = 20000
T0 = 1_577_836_800  # 2020-01-01


@pytest.fixture()
def no_coalesce(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _hot_ledger(spark):
    # account 0 holds every second row; rows spread over ~23 days of instants
    return spark.range(N).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).cast("bigint").alias("account_id"),
        F.lit(1.0).alias("amount"),
        (F.lit(T0) + F.col("id") * 100).alias("txn_requested_at"),
        F.lit(None).cast("string").alias("txn_completed_at"),
        F.lit("completed").alias("status"),
        F.lit("in").alias("in_or_out"),
        F.lit("pix").alias("product"),
        F.lit(None).cast("string").alias("country_name"),
        F.lit(1).alias("day"),
        F.lit("2020-01").alias("month"),
        F.lit("2020-01-01").alias("event_date"),
        F.col("id").alias("txn_id"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields])


def _max_task_share(df, *used):
    """Largest share of rows in one partition of the stage computing ``used``
    (the columns are aggregated too, so the optimizer cannot prune them)."""
    probe = df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(c) for c in used]
    )
    return max(r["n"] for r in probe.collect()) / N


def test_plain_window_puts_hot_account_in_one_task(spark, no_coalesce):
    df = _hot_ledger(spark)
    plain = df.select(
        "*",
        F.count(F.lit(1)).over(account_ever_window()).alias("ever"),
        F.lag("txn_requested_at").over(account_sequence_window()).alias("prev"),
    )
    assert _max_task_share(plain, "ever", "prev") >= 0.5


def _spread(spark, df):
    """Largest share of rows of one task for both window families, and the results' checks."""
    seq = sequence_columns(df)
    assert _max_task_share(seq, "count_txns_orders_per_account_ever", "last_txn_date") < 0.4
    trail = trailing_count(df, 86400)
    assert _max_task_share(trail, "count_txns_last_86400s") < 0.4
    return seq, trail


@pytest.fixture()
def split_joins(spark, no_coalesce):
    """Join partitions above a few KB are split, as large ones are on a cluster."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_account_is_spread(spark, split_joins):
    seq, _ = _spread(spark, _hot_ledger(spark))
    hot = seq.where("account_id = 0").agg(F.max("count_txns_orders_per_account_ever")).first()[0]
    assert hot == N // 2


def test_burst_after_quiet_years_is_spread(spark, split_joins):
    """Ten rows over earlier years, the rest of the hot account within 50 minutes."""
    quiet = F.lit(T0) - F.col("txn_id") * 20_000_000
    burst = F.lit(T0) + F.pmod(F.col("txn_id"), F.lit(3000))
    df = _hot_ledger(spark).withColumn(
        "txn_requested_at",
        F.when(F.col("account_id") == 0, F.when(F.col("txn_id") < 20, quiet).otherwise(burst)).otherwise(
            F.col("txn_requested_at")
        ),
    )
    seq, trail = _spread(spark, df)
    assert seq.where("account_id = 0").agg(F.max("count_txns_orders_per_account_ever")).first()[0] == N // 2
    assert trail.where("account_id = 0").agg(F.max("count_txns_last_86400s")).first()[0] == N // 2 - 9


def test_single_second_is_spread(spark, split_joins):
    df = _hot_ledger(spark).withColumn(
        "txn_requested_at", F.when(F.col("account_id") == 0, F.lit(T0)).otherwise(F.col("txn_requested_at"))
    )
    seq, trail = _spread(spark, df)
    row = seq.where("account_id = 0").agg(
        F.min("count_txns_orders_per_account_ever"), F.count("last_txn_date"), F.count(F.lit(1))
    ).first()
    assert tuple(row) == (N // 2, N // 2 - 1, N // 2)  # one row is the first
    assert trail.where("account_id = 0").agg(F.min("count_txns_last_86400s")).first()[0] == N // 2


def test_copies_of_one_row_have_one_first(spark, split_joins):
    df = _hot_ledger(spark).withColumn(
        "txn_requested_at", F.when(F.col("account_id") == 0, F.lit(T0)).otherwise(F.col("txn_requested_at"))
    ).withColumn("txn_id", F.when(F.col("account_id") == 0, F.lit(1)).otherwise(F.col("txn_id")))
    seq = sequence_columns(df)
    assert tuple(seq.where("account_id = 0").agg(F.count(F.lit(1)), F.count("last_txn_date")).first()) == (
        N // 2, N // 2 - 1,
    )


def test_no_window_runs_over_transactions(spark):
    """Every window is over per-instant or per-day aggregates: an aggregate lies below each."""
    plan = sequence_columns(_hot_ledger(spark))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Window [" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = [x for x in lines[i + 1 :] if len(x) - len(x.lstrip(" :+-")) > depth]
            assert any("Aggregate [" in x for x in below)
