"""Reports over the event ledger.

* ``account_monthly_balance``: money in, out and net per account and month.
* ``investments_daily_ledger`` / ``investments_daily_balance``: per account
  and active day, deposits, withdrawals, running movements and a
  non-compounding daily yield.
* ``monthly_metrics``: a KPI series per month (optionally per product).

Every function takes and returns DataFrames. The only actions taken while a
plan is built are measurements returning one row per measured frame: the size of a
broadcast candidate (cohort, dimension).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.functions import metrics as M
from kontor.functions.columns import STATUS_COMPLETED
from kontor.functions.windows import ACCOUNT_KEYS, TIE_BREAKERS, daily_cumulative_window, daily_lag_window
from kontor.operators import percentiles
from kontor.operators.filters import interval_closed
from kontor.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, broadcast_if_small
from kontor.operators.normalize import PRODUCT_INVESTMENTS, PRODUCT_NON_PIX, PRODUCT_PIX
from kontor.operators.sequence import row_dimensions, txn_dimensions

# Fixed value: daily yield on the running investment movements.
FIXED_RATE = 0.0001
DEFAULT_PRODUCTS = (PRODUCT_NON_PIX, PRODUCT_PIX)
MONTHLY_BALANCE_METRICS = ("total_transfer_in", "total_transfer_out", "account_monthly_balance")
DAILY_BALANCE_COLUMNS = (
    "day",
    "month",
    "account_id",
    "deposit",
    "withdrawal",
    "end_of_day_income",
    "account_daily_balance",
)


def completed_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == STATUS_COMPLETED)


# -- account monthly balance (DataFrame form, closed interval) -----------------------------------
def account_monthly_balance(
    ledger: DataFrame,
    interval: tuple[str, str],
    products: Sequence[str] = DEFAULT_PRODUCTS,
    metrics: Sequence[str] = MONTHLY_BALANCE_METRICS,
) -> DataFrame:
    """month, account_id and the named metrics (by default total_transfer_in,
    total_transfer_out, account_monthly_balance) over completed rows of the products.

    One shuffle on (month, account_id) after map-side partial sums; the
    filters reach the scan (and prune product/month partitions of a stored
    ledger).
    """
    return (
        completed_only(interval_closed(ledger, *interval))
        .where(F.col("product").isin(*products))
        .groupBy("month", "account_id")
        .agg(*M.metric_columns(list(metrics)))
    )


# -- investments daily balance --------------------------------------------------------------------
def _daily_movements(ledger: DataFrame, interval: tuple[str, str]) -> DataFrame:
    """(account_id, event_date) -> deposit, withdrawal of completed investments."""
    return (
        completed_only(interval_closed(ledger, *interval))
        .where(F.col("product") == PRODUCT_INVESTMENTS)
        .groupBy("account_id", "event_date")
        .agg(M.deposit(), M.withdrawal())
    )


def investments_daily_ledger(
    ledger: DataFrame,
    interval: tuple[str, str],
    rate: float = FIXED_RATE,
    cohort: DataFrame | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Every daily column: event_date, day, month, account_id, deposit,
    withdrawal, balance, previous_day_balance, movements, end_of_day_income,
    account_daily_balance.

    * balance: the day's net movement (deposit - withdrawal);
    * previous_day_balance: net movement of the account's previous *active*
      day, 0 on its first one;
    * movements: running sum of the net movements since the interval start.
      Earlier income is not added back, so the yield does not compound;
    * end_of_day_income: movements x rate, floored at 0 (a negative balance
      earns nothing);
    * account_daily_balance: movements + end_of_day_income.

    Only days with a completed movement appear. Plan: filter at the scan,
    partial + final aggregate per (account, day), then one window per account
    over the daily rows (bounded by the number of active days, whatever the
    account's transaction count). ``movements`` is computed once and reused.

    ``cohort`` (a DataFrame with account_id) restricts the accounts: before the
    aggregation as a broadcast semi join when the cohort's measured size
    allows; otherwise after it, on the much smaller daily rows, where the
    semi join's shuffle on account_id also serves the window.
    """
    raw = ledger
    late_cohort = None
    if cohort is not None:
        side, fits = broadcast_if_small(cohort.select("account_id"), max_broadcast_bytes)
        if fits:
            raw = raw.join(side, "account_id", "left_semi")
        else:
            late_cohort = side
    daily = _daily_movements(raw, interval)
    if late_cohort is not None:
        daily = daily.join(late_cohort, "account_id", "left_semi")

    lag_w, cum_w = daily_lag_window(), daily_cumulative_window()
    staged = daily.select(
        "event_date",
        F.substring("event_date", 9, 2).cast("int").alias("day"),
        F.substring("event_date", 1, 7).alias("month"),
        "account_id",
        "deposit",
        "withdrawal",
        (F.col("deposit") - F.col("withdrawal")).alias("balance"),
    ).select(
        "*",
        F.lag("balance", 1, 0.0).over(lag_w).alias("previous_day_balance"),
        F.sum("balance").over(cum_w).alias("movements"),
    )
    income = F.col("movements") * F.lit(rate)
    return staged.select(
        "*", F.when(income < 0, F.lit(0.0)).otherwise(income).alias("end_of_day_income")
    ).withColumn("account_daily_balance", F.col("movements") + F.col("end_of_day_income"))


def investments_daily_balance(
    ledger: DataFrame,
    interval: tuple[str, str],
    rate: float = FIXED_RATE,
    cohort: DataFrame | None = None,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    columns: Sequence[str] = DAILY_BALANCE_COLUMNS,
) -> DataFrame:
    """The published report: the named daily columns, by default day, month,
    account_id, deposit, withdrawal, end_of_day_income, account_daily_balance."""
    return investments_daily_ledger(ledger, interval, rate, cohort, max_broadcast_bytes).select(*columns)


def investments_for_cohort(
    ledger: DataFrame,
    cohort: DataFrame,
    interval: tuple[str, str],
    rate: float = FIXED_RATE,
) -> DataFrame:
    """The investments job: the daily balance of the accounts to send."""
    return investments_daily_balance(ledger, interval, rate, cohort=cohort)


# -- monthly KPI series ---------------------------------------------------------------------------
def with_dimensions(
    ledger: DataFrame,
    products: Sequence[str] | None = (PRODUCT_PIX,),
    by_product: bool = False,
) -> DataFrame:
    """Ledger rows of ``products`` (all when None) with the six transaction
    dimensions. Windows run per account within the selected rows; with
    ``by_product`` per (product, account), i.e. as if each product were
    selected on its own."""
    df = ledger if products is None else ledger.where(F.col("product").isin(*products))
    keys = ("product", "account_id") if by_product else ("account_id",)
    return txn_dimensions(df, keys)


def monthly_metrics(
    df: DataFrame,
    metrics: Sequence[str] = tuple(M.KPI_METRICS),
    by_product: bool = False,
    exact_percentiles: bool = False,
) -> DataFrame:
    """Group by month (and product) and compute the named metrics, ordered by
    month. ``df`` must carry the dimensions when a metric needs them.

    p90 and p99 come from a sketch, exact for up to 10,000 rows a group, in the one
    aggregation of all metrics; with ``exact_percentiles`` from counted values, exact for
    any group, in an aggregation of their own.
    """
    keys = ["product", "month"] if by_product else ["month"]
    counted = {m: M.RANKS[m] for m in metrics if m in M.RANKS} if exact_percentiles else {}
    others = [m for m in metrics if m not in counted]
    if not counted:
        return df.groupBy(*keys).agg(*M.metric_columns(others)).orderBy(*keys)
    out = percentiles.exact_percentiles(df, keys, "time_to_complete_in_seconds", counted)
    if others:  # both sides have one row a group
        plain = df.groupBy(*keys).agg(*M.metric_columns(others))
        of = out.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
        out = plain.join(of, same).drop(*[f"_of_{k}" for k in keys])
    return out.select(*keys, *metrics).orderBy(*keys)


def kpi_series(
    ledger: DataFrame,
    metrics: Sequence[str] = tuple(M.KPI_METRICS),
    products: Sequence[str] | None = None,
    by_product: bool = True,
    exact_percentiles: bool = False,
) -> DataFrame:
    """Ledger -> (dimensions when needed) -> monthly metrics, in one plan.

    All requested metrics share one aggregation, so the ledger is scanned and
    the windows run once for the whole KPI set.
    """
    names = list(metrics)
    if set(names) & M.NEEDS_SEQUENCE:
        # The columns that order transactions and those of the series: no others are shuffled.
        needed = {*ACCOUNT_KEYS, "product", "month", "txn_requested_at", *TIE_BREAKERS}
        df = with_dimensions(ledger.select(*[c for c in ledger.columns if c in needed]), products, by_product)
    else:
        df = ledger if products is None else ledger.where(F.col("product").isin(*products))
        if set(names) & M.NEEDS_ROW_DIMENSIONS:
            df = row_dimensions(df)
    return monthly_metrics(df, names, by_product, exact_percentiles)
