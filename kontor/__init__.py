"""kontor: account-transaction ledger analytics on Spark DataFrames.

Subpackages:

* ``sources``   feed readers (CSV, nested JSON, tables), sinks, test-data adapter
* ``functions`` Column factories: row-level expressions, windows, metrics
* ``operators`` DataFrame -> DataFrame building blocks (normalise, unnest,
  cohort, interval filters, sequence dimensions, sized broadcast)
* ``plans``     reports composed from the operators (DataFrame and SQL)

The names below are the user-level API; importing them touches no session.
"""

from kontor.functions.metrics import KPI_METRICS, METRICS
from kontor.operators.cohort import restrict_to_cohort
from kontor.operators.normalize import (
    INVESTMENTS_SPEC,
    PIX_SPEC,
    TRANSFER_IN_SPEC,
    TRANSFER_OUT_SPEC,
    FeedSpec,
    build_ledger,
    normalize,
    normalize_feed,
)
from kontor.operators.sequence import trailing_count, trailing_counts, txn_dimensions
from kontor.operators.unnest import unnest_investments
from kontor.plans.reports import (
    account_monthly_balance,
    investments_daily_balance,
    investments_daily_ledger,
    kpi_series,
    monthly_metrics,
    with_dimensions,
)
from kontor.plans.sql_reports import account_monthly_balance_sql, raw_union_all
from kontor.session import build_session
from kontor.sources.files import load_investments, read_feed_csv, read_nested_investments, register_feeds
from kontor.sources.sinks import write_ledger, write_report_csv

__version__ = "0.1.0"

__all__ = [
    "FeedSpec",
    "INVESTMENTS_SPEC",
    "KPI_METRICS",
    "METRICS",
    "PIX_SPEC",
    "TRANSFER_IN_SPEC",
    "TRANSFER_OUT_SPEC",
    "account_monthly_balance",
    "account_monthly_balance_sql",
    "build_ledger",
    "build_session",
    "investments_daily_balance",
    "investments_daily_ledger",
    "kpi_series",
    "load_investments",
    "monthly_metrics",
    "normalize",
    "normalize_feed",
    "raw_union_all",
    "read_feed_csv",
    "read_nested_investments",
    "register_feeds",
    "restrict_to_cohort",
    "trailing_count",
    "trailing_counts",
    "txn_dimensions",
    "unnest_investments",
    "with_dimensions",
    "write_ledger",
    "write_report_csv",
]
