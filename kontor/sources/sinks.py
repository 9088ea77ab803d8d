"""Sinks: the partitioned ledger and report files.

The ledger is written once per build, all feeds together (a union), so a
reader never sees a half-loaded ledger; it is partitioned by product and
month, which the reports filter on, so their scans skip whole directories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

LEDGER_PARTITIONS = ("product", "month")
BUCKET_BY = "account_id"
DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000
LEDGER_MODES = ("overwrite", "append", "replace_partitions")


def write_ledger(
    ledger: DataFrame,
    path: str | None = None,
    table: str | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = LEDGER_PARTITIONS,
    max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
    rebalance: bool = True,
    buckets: int | None = None,
) -> None:
    """Write the ledger as Parquet, to a path or a managed table.

    ``overwrite`` replaces the whole ledger, whatever the session's setting;
    ``append`` adds rows; ``replace_partitions`` (paths only) replaces the
    (product, month) partitions that ``ledger`` has and leaves the others.

    ``rebalance`` adds a REBALANCE hint on the partition columns: one exchange
    after which AQE splits oversized (hot month) partitions and merges small
    ones, so each (product, month) directory gets a few evenly sized files.

    ``buckets`` (tables only) keeps the rows of each partition in that many buckets by
    account, sorted by account: windows and aggregates per account, and joins on it with
    another side in as many parts, then read the table without an exchange. A bucket is
    read by one task, so an account with a large share of all rows is better left without.
    """
    if buckets is not None and table is None:
        raise ValueError("buckets need a table: files alone do not say how they are kept")
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    if mode not in LEDGER_MODES or (mode == "replace_partitions" and table):
        raise ValueError(f"mode {mode!r} is none of {LEDGER_MODES}, or not for a table")
    if buckets:  # one task holds a bucket: a file for each bucket and partition
        ledger = ledger.repartition(buckets, BUCKET_BY)
    elif rebalance:
        ledger = ledger.hint("rebalance", *partition_by)
    writer = (
        ledger.write.mode("append" if mode == "append" else "overwrite")
        .format("parquet")
        .partitionBy(*partition_by)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("partitionOverwriteMode", "dynamic" if mode == "replace_partitions" else "static")
    )
    if buckets:
        writer = writer.bucketBy(buckets, BUCKET_BY).sortBy(BUCKET_BY)
    if table:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def write_report_csv(
    report: DataFrame,
    path: str,
    order_by: Sequence[str] = (),
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """Header CSV of a report, sorted by ``order_by``: ordered part files, or with
    ``single_file`` one file written by one task (for reports known to be small)."""
    df = report.orderBy(*order_by) if order_by else report
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).option("header", True).csv(path)
