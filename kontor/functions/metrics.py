"""Aggregate metrics over ledger rows, as named Column factories.

Each factory returns a fresh aliased aggregate ``Column``; ``METRICS`` is the
ordered registry. All are algebraic or sketch aggregates (sum, count, avg,
percentile_approx), so Spark evaluates them partially before the shuffle and
merges partial states after it: a group's size never has to fit one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor.functions.columns import (
    DIRECTION_IN,
    DIRECTION_OUT,
    SECONDS_PER_DAY,
    STATUS_COMPLETED,
    STATUS_FAILED,
    try_long,
)


# -- row predicates (F8) --------------------------------------------------------------------
def is_completed() -> Column:
    return F.col("status") == STATUS_COMPLETED


def is_failed() -> Column:
    return F.col("status") == STATUS_FAILED


def is_first_txn() -> Column:
    """The account's unique earliest transaction (needs the txn dimensions)."""
    return F.col("count_txns_orders_per_account_ever") == 1


def _amount_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("amount")).otherwise(0))


# -- amounts (G5-G10, G20-G22) ---------------------------------------------------------------
def total_amount() -> Column:
    return F.sum("amount").alias("total_amount")


def total_amount_completed() -> Column:
    return _amount_if(is_completed()).alias("total_amount_completed")


def total_amount_failed() -> Column:
    return _amount_if(is_failed()).alias("total_amount_failed")


def total_transfer_in() -> Column:
    return _amount_if(F.col("in_or_out") == DIRECTION_IN).alias("total_transfer_in")


def total_transfer_out() -> Column:
    return _amount_if(F.col("in_or_out") == DIRECTION_OUT).alias("total_transfer_out")


def account_monthly_balance() -> Column:
    return (
        _amount_if(F.col("in_or_out") == DIRECTION_IN)
        - _amount_if(F.col("in_or_out") == DIRECTION_OUT)
    ).alias("account_monthly_balance")


def deposit() -> Column:
    return _amount_if(F.col("in_or_out") == DIRECTION_IN).alias("deposit")


def withdrawal() -> Column:
    return _amount_if(F.col("in_or_out") == DIRECTION_OUT).alias("withdrawal")


def daily_balance() -> Column:
    return (
        _amount_if(F.col("in_or_out") == DIRECTION_IN)
        - _amount_if(F.col("in_or_out") == DIRECTION_OUT)
    ).alias("balance")


# -- rates (G11, G12): by amount, rounded to 2; a zero divisor gives NULL -------------------
def fail_rate() -> Column:
    """Failed amount over *completed* amount (not over the total)."""
    return F.round(F.try_divide(_amount_if(is_failed()), _amount_if(is_completed())), 2).alias(
        "fail_rate"
    )


def completed_rate() -> Column:
    return F.round(F.try_divide(_amount_if(is_completed()), F.sum("amount")), 2).alias(
        "completed_rate"
    )


# -- time, recency, counts, ticket (G13-G19) -------------------------------------------------
def avg_time_to_completed() -> Column:
    return F.avg("time_to_complete_in_seconds").alias("avg_time_to_completed")


def avg_recency() -> Column:
    """Average days from the previous transaction's request to this one's completion:
    whole seconds are summed, so the result does not depend on the order of rows."""
    seconds = try_long("txn_completed_at") - F.col("last_txn_date").cast("bigint")
    days = F.try_divide(F.sum(seconds).cast("double"), F.count(seconds)) / F.lit(SECONDS_PER_DAY)
    return days.alias("avg_recency")


def total_orders() -> Column:
    return F.count(F.lit(1)).alias("total_orders")


def total_first_txn_orders() -> Column:
    return F.sum(F.when(is_first_txn(), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(
        "total_first_txn_orders"
    )


def atv() -> Column:
    """Average ticket value over all statuses: the exact sum of the amounts (to six
    decimals) over their count, whatever the order of rows."""
    exact = F.sum(F.col("amount").try_cast("decimal(32,6)")).cast("double")
    return F.try_divide(exact, F.count("amount")).alias("atv")


def p99_time_to_completed(accuracy: int = 10000) -> Column:
    return F.percentile_approx("time_to_complete_in_seconds", 0.99, accuracy).alias("p99")


def p90_time_to_completed(accuracy: int = 10000) -> Column:
    return F.percentile_approx("time_to_complete_in_seconds", 0.90, accuracy).alias("p90")


METRICS: dict[str, Callable[[], Column]] = {
    "total_amount": total_amount,
    "total_amount_completed": total_amount_completed,
    "total_amount_failed": total_amount_failed,
    "total_transfer_in": total_transfer_in,
    "total_transfer_out": total_transfer_out,
    "account_monthly_balance": account_monthly_balance,
    "fail_rate": fail_rate,
    "completed_rate": completed_rate,
    "avg_time_to_completed": avg_time_to_completed,
    "avg_recency": avg_recency,
    "total_orders": total_orders,
    "total_first_txn_orders": total_first_txn_orders,
    "atv": atv,
    "p99": p99_time_to_completed,
    "p90": p90_time_to_completed,
    "deposit": deposit,
    "withdrawal": withdrawal,
    "balance": daily_balance,
}

# Percentiles that can be counted exactly (``kontor.operators.percentiles``), as decimal texts.
RANKS = {"p99": "0.99", "p90": "0.90"}

# The KPI set of the monthly series, in report order (12 metrics).
KPI_METRICS = [
    "total_amount",
    "total_amount_completed",
    "total_amount_failed",
    "fail_rate",
    "completed_rate",
    "avg_time_to_completed",
    "avg_recency",
    "total_orders",
    "total_first_txn_orders",
    "atv",
    "p99",
    "p90",
]

# Metrics that read the transaction dimensions: row-level ones only, or the
# per-account sequence windows as well.
NEEDS_ROW_DIMENSIONS = {"avg_time_to_completed", "p99", "p90"}
NEEDS_SEQUENCE = {"avg_recency", "total_first_txn_orders"}


def metric_columns(names: list[str]) -> list[Column]:
    unknown = [n for n in names if n not in METRICS]
    if unknown:
        raise KeyError(f"unknown metrics: {unknown}")
    return [METRICS[n]() for n in names]
