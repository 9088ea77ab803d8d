"""The job entry points run end to end on CSV feeds."""

import csv
import glob

import pytest
from test_sources_sinks import _csv_feeds

from jobs import build_ledger, run_report
from kontor.sources.files import register_feeds


def test_build_then_reports(spark, scratch):
    _csv_feeds(scratch)
    ledger = f"{scratch}/ledger"
    build_ledger.main(["--feeds", scratch, "--ledger-path", ledger])
    assert spark.read.parquet(ledger).count() == 6
    spark.read.option("header", True).csv(f"{scratch}/investment_accounts_to_send").createOrReplaceTempView(
        "cohort_accounts"
    )
    out = f"{scratch}/idb"
    run_report.main(
        ["investments_daily_balance", "--ledger-path", ledger, "--interval", "2020-01-01", "2021-01-01",
         "--cohort-table", "cohort_accounts", "--out", out, "--csv", "--single-file"]
    )
    (part,) = glob.glob(f"{out}/part-*.csv")
    rows = list(csv.DictReader(open(part)))
    assert [r["day"] for r in rows] == ["1", "2"]
    assert list(rows[0]) == [
        "day", "month", "account_id", "deposit", "withdrawal", "end_of_day_income", "account_daily_balance",
    ]
    run_report.main(
        ["investments_daily_balance", "--ledger-path", ledger, "--interval", "2020-01-01", "2021-01-01",
         "--cohort-path", f"{scratch}/investment_accounts_to_send", "--out", f"{scratch}/idb2"]
    )
    assert sorted(r.day for r in spark.read.parquet(f"{scratch}/idb2").collect()) == [1, 2]
    run_report.main(["kpis", "--ledger-path", ledger, "--out", f"{scratch}/kpis", "--preview", "2"])
    assert spark.read.parquet(f"{scratch}/kpis").count() == 3  # one month x three products
    run_report.main(["account_monthly_balance_sql", "--feeds", scratch, "--out", f"{scratch}/sql"])
    got = spark.read.parquet(f"{scratch}/sql").collect()
    assert sorted((r.Customer, r.AccountMonthlyBalance) for r in got) == [(1, 110.5), (2, -40.0)]


def test_build_with_nested_investments(spark, scratch):
    import json
    import os

    _csv_feeds(scratch)
    docs = [
        {"account_id": "1", "transactions": [
            {"transaction_id": "9", "status": "completed", "amount": "70.0",
             "investment_requested_at": "1585699200", "investment_completed_at": "1585699201",
             "type": "investment_transfer_in"}]},
        {"account_id": "2", "transactions": []},
    ]
    os.makedirs(f"{scratch}/nested")
    with open(f"{scratch}/nested/investments_json.txt", "w") as fh:
        json.dump(docs, fh)
    ledger = f"{scratch}/ledger_nested"
    build_ledger.main(["--feeds", scratch, "--nested-investments", f"{scratch}/nested", "--ledger-path", ledger])
    got = spark.read.parquet(ledger)
    assert got.count() == 5  # 2 pix + 1 in + 1 out + 1 nested investment (the CSV investments are replaced)
    inv = got.where("product = 'investments'").collect()
    assert [(r.account_id, r.amount, r.in_or_out, r.country_name) for r in inv] == [(1, 70.0, "in", "Brazil")]


def test_jobs_through_a_catalog_table(spark, scratch):
    _csv_feeds(scratch)
    spark.sql("DROP TABLE IF EXISTS ledger_job_table")
    build_ledger.main(["--feeds", scratch, "--ledger-table", "ledger_job_table"])
    assert spark.table("ledger_job_table").count() == 6
    out = f"{scratch}/amb"
    run_report.main(
        ["account_monthly_balance", "--ledger-table", "ledger_job_table", "--interval", "2020-01-01",
         "2020-12-31", "--products", "non_pix", "pix", "--out", out]
    )
    got = {(r.account_id, r.month): r.account_monthly_balance for r in spark.read.parquet(out).collect()}
    assert got == {(1, "2020-04"): 110.5, (2, "2020-04"): -40.0}


def test_kpis_per_month_and_chosen_metrics(spark, scratch):
    _csv_feeds(scratch)
    ledger = f"{scratch}/ledger"
    build_ledger.main(["--feeds", scratch, "--ledger-path", ledger])
    run_report.main(
        ["kpis", "--ledger-path", ledger, "--by-month", "--metrics", "fail_rate", "p99", "--products", "pix", "--out", f"{scratch}/k"]
    )
    got = spark.read.parquet(f"{scratch}/k")
    assert got.columns == ["month", "fail_rate", "p99"] and got.count() == 1
    run_report.main(
        ["account_monthly_balance", "--ledger-path", ledger, "--metrics", "total_amount", "--out", f"{scratch}/m"]
    )
    assert spark.read.parquet(f"{scratch}/m").columns == ["month", "account_id", "total_amount"]


def test_sql_report_over_parquet_feeds(spark, scratch):
    _csv_feeds(scratch)
    for name, df in register_feeds(spark, scratch).items():
        df.write.parquet(f"{scratch}/pq/{name}")
    run_report.main(
        ["account_monthly_balance_sql", "--feeds", f"{scratch}/pq", "--format", "parquet", "--out", f"{scratch}/sql"]
    )
    got = spark.read.parquet(f"{scratch}/sql").collect()
    assert sorted((r.Customer, r.AccountMonthlyBalance) for r in got) == [(1, 110.5), (2, -40.0)]


@pytest.mark.parametrize(
    "argv", [["kpis", "--feeds", "x"], ["account_monthly_balance_sql", "--ledger-path", "x"], ["kpis"]]
)
def test_wrong_sources_are_refused(argv):
    with pytest.raises(SystemExit):
        run_report.main([*argv, "--out", "y"])


def test_csv_preview_orders_numbers(spark, scratch, capsys):
    _csv_feeds(scratch)
    day = 86400
    t = 1585699200
    rows = "".join(f"{i},{a},5.0,{t + d * day},{t + d * day},completed,investment_transfer_in\n" for i, a, d in ((7, 10, 0), (8, 9, 8), (9, 9, 9)))
    with open(f"{scratch}/investments/part-0.csv", "w") as fh:
        fh.write("id,account_id,amount,investment_requested_at,investment_completed_at,status,type\n" + rows)
    ledger = f"{scratch}/ledger"
    build_ledger.main(["--feeds", scratch, "--ledger-path", ledger])
    run_report.main(
        ["investments_daily_balance", "--ledger-path", ledger, "--out", f"{scratch}/r", "--csv", "--preview", "3"]
    )
    shown = [line.split("|")[1:4] for line in capsys.readouterr().out.split("\n") if "|2020-04|" in line]
    assert [(d.strip(), a.strip()) for d, _, a in shown] == [("9", "9"), ("10", "9"), ("1", "10")]
