"""Build the event ledger from the four feeds and write it, partitioned.

    spark-submit jobs/build_ledger.py --feeds /data/feeds --ledger-path /data/ledger
    spark-submit jobs/build_ledger.py --feeds /data/feeds --format parquet \\
        --nested-investments /data/investments_json --ledger-table products_daily_events

Feeds are directories named after the feed (accounts, customers, pix_movements,
transfer_ins, transfer_outs, investments). With ``--nested-investments`` the
investments feed is read from nested JSON documents instead.
"""

from __future__ import annotations

import argparse

from kontor.operators.normalize import (
    INVESTMENTS_SPEC,
    PIX_SPEC,
    TRANSFER_IN_SPEC,
    TRANSFER_OUT_SPEC,
    build_ledger,
)
from kontor.session import build_session
from kontor.sources.files import load_investments, register_feeds
from kontor.sources.sinks import LEDGER_MODES, write_ledger

FEEDS = ["accounts", "customers", "pix_movements", "transfer_ins", "transfer_outs", "investments"]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--feeds", required=True, help="root folder of the feed directories")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "json", "orc"])
    ap.add_argument("--nested-investments", help="nested investments JSON (one array per file)")
    ap.add_argument("--json-lines", action="store_true", help="nested JSON is one document per line")
    dest = ap.add_mutually_exclusive_group(required=True)
    dest.add_argument("--ledger-path")
    dest.add_argument("--ledger-table")
    ap.add_argument("--mode", default="overwrite", choices=LEDGER_MODES)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master, app_name="kontor-build-ledger")
    names = [n for n in FEEDS if not (args.nested_investments and n == "investments")]
    feeds = register_feeds(spark, args.feeds, names, fmt=args.format)
    if args.nested_investments:
        feeds["investments"] = load_investments(spark, args.nested_investments, not args.json_lines)
    ledger = build_ledger(
        [
            (feeds["pix_movements"], PIX_SPEC),
            (feeds["transfer_ins"], TRANSFER_IN_SPEC),
            (feeds["transfer_outs"], TRANSFER_OUT_SPEC),
            (feeds["investments"], INVESTMENTS_SPEC),
        ],
        feeds["accounts"],
        feeds["customers"],
    )
    write_ledger(ledger, path=args.ledger_path, table=args.ledger_table, mode=args.mode)


if __name__ == "__main__":
    main()
