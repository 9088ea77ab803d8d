"""Compute one report from the stored ledger and write it.

    spark-submit jobs/run_report.py investments_daily_balance \\
        --ledger-path /data/ledger --interval 2020-01-01 2021-01-01 \\
        --cohort-table investment_accounts_to_send --out /data/reports/idb --csv
    spark-submit jobs/run_report.py investments_daily_balance --ledger-path /data/ledger \
        --cohort-path /data/investment_accounts_to_send --cohort-format parquet --out /data/reports/idb
    spark-submit jobs/run_report.py account_monthly_balance --ledger-table products_daily_events \\
        --interval 2020-01-01 2021-01-01 --products non_pix pix --out /data/reports/amb
    spark-submit jobs/run_report.py account_monthly_balance_sql --feeds /data/feeds --format parquet \\
        --year 2020 --out ...
    spark-submit jobs/run_report.py kpis --ledger-path /data/ledger --products pix --by-month --out ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from kontor.functions.metrics import KPI_METRICS, METRICS
from kontor.plans import reports as R
from kontor.plans.sql_reports import account_monthly_balance_sql
from kontor.session import build_session
from kontor.schemas import INVESTMENT_ACCOUNTS_TO_SEND
from kontor.sources.files import read_feed_csv, register_feeds
from kontor.sources.sinks import write_report_csv

REPORT_ORDER = {
    "investments_daily_balance": ("account_id", "month", "day"),
    "account_monthly_balance": ("month", "account_id"),
    "account_monthly_balance_sql": ("Month", "Customer"),
    "kpis": ("product", "month"),
}


def read_cohort(spark, path: str, fmt: str = "csv"):
    """Cohort account ids from a folder (header CSV or Parquet), as bigint."""
    if fmt == "csv":
        return read_feed_csv(spark, path, INVESTMENT_ACCOUNTS_TO_SEND)
    return spark.read.format(fmt).load(path).select(F.col("account_id").cast("bigint").alias("account_id"))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("report", choices=sorted(REPORT_ORDER))
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--ledger-path")
    src.add_argument("--ledger-table")
    src.add_argument("--feeds", help="feed root (SQL report only)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "json", "orc"], help="of the feeds")
    ap.add_argument("--interval", nargs=2, default=["2020-01-01", "2021-01-01"])
    ap.add_argument("--year", type=int, default=2020)
    ap.add_argument("--products", nargs="*")
    ap.add_argument("--metrics", nargs="*", choices=sorted(METRICS), help="of the monthly balance or the KPIs")
    ap.add_argument("--by-month", action="store_true", help="KPIs per month instead of per product and month")
    cohort_src = ap.add_mutually_exclusive_group()
    cohort_src.add_argument("--cohort-table")
    cohort_src.add_argument("--cohort-path", help="folder of account ids")
    ap.add_argument("--cohort-format", default="csv", choices=["csv", "parquet", "orc"])
    ap.add_argument("--rate", type=float, default=R.FIXED_RATE)
    ap.add_argument("--out", required=True)
    ap.add_argument("--csv", action="store_true", help="header CSV, ordered part files")
    ap.add_argument("--single-file", action="store_true", help="with --csv: one file, written by one task")
    ap.add_argument("--preview", type=int, default=0, help="also print the first N rows")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    if (args.report == "account_monthly_balance_sql") != bool(args.feeds):
        ap.error("account_monthly_balance_sql reads --feeds, every other report a ledger")
    order = [c for c in REPORT_ORDER[args.report] if not (args.by_month and c == "product")]

    spark = build_session(args.master, app_name=f"kontor-{args.report}")
    interval = tuple(args.interval)
    if args.report == "account_monthly_balance_sql":
        f = register_feeds(spark, args.feeds, ["transfer_ins", "transfer_outs", "pix_movements"], args.format)
        out = account_monthly_balance_sql(
            spark, f["transfer_ins"], f["transfer_outs"], f["pix_movements"], args.year
        )
    else:
        ledger = (
            spark.read.parquet(args.ledger_path) if args.ledger_path else spark.table(args.ledger_table)
        )
        if args.report == "investments_daily_balance":
            cohort = None
            if args.cohort_table:
                cohort = spark.table(args.cohort_table)
            elif args.cohort_path:
                cohort = read_cohort(spark, args.cohort_path, args.cohort_format)
            out = R.investments_daily_balance(ledger, interval, args.rate, cohort=cohort)
        elif args.report == "account_monthly_balance":
            out = R.account_monthly_balance(
                ledger, interval, args.products or R.DEFAULT_PRODUCTS, args.metrics or R.MONTHLY_BALANCE_METRICS
            )
        else:
            out = R.kpi_series(
                ledger, args.metrics or KPI_METRICS, products=args.products or None, by_product=not args.by_month
            )
    if args.csv:
        write_report_csv(out, args.out, order_by=order, single_file=args.single_file)
    else:
        out.write.mode("overwrite").parquet(args.out)
    if args.preview:
        # a bounded look at the written report, in report order and with its types
        written = spark.read.schema(out.schema)
        stored = written.option("header", True).csv(args.out) if args.csv else written.parquet(args.out)
        stored.orderBy(*order).show(args.preview, truncate=False)


if __name__ == "__main__":
    main()
