"""Hand-made edge rows: one test per semantic rule of the ledger and reports."""

import pytest
from helpers import epoch, ledger_df, ledger_row

from kontor.functions.columns import direction
from kontor.operators.normalize import (
    INVESTMENTS_SPEC,
    PIX_SPEC,
    TRANSFER_IN_SPEC,
    TRANSFER_OUT_SPEC,
    build_ledger,
)
from kontor.operators.unnest import unnest_investments
from kontor.plans import reports as R
from kontor.plans.sql_reports import account_monthly_balance_sql
from kontor.schemas import ACCOUNTS, CUSTOMERS, INVESTMENTS, PIX_MOVEMENTS, TRANSFERS


def test_direction_classifier(spark):
    raw = ["pix_in", "in", "pix_out", "investment_transfer_out", "investment_transfer_in", None, "non_pix_in"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    got = [r[0] for r in df.select(direction("raw")).collect()]
    assert got == ["in", "out", "out", "out", "in", "out", "in"]


def _dims(spark):
    accounts = spark.createDataFrame([(1, 101), (2, 102), (3, 103)], ACCOUNTS)
    customers = spark.createDataFrame([(101, "BR"), (102, "MX")], CUSTOMERS)  # 103 unknown
    return accounts, customers


def _feeds(spark):
    t = epoch("2020-03-10")
    pix = spark.createDataFrame(
        [(1, 1, "pix_in", 5.0, t, str(t + 3), "completed"), (2, 9, "pix_out", 7.0, t, "None", "failed")],
        PIX_MOVEMENTS,
    )
    tin = spark.createDataFrame([(3, 2, 11.0, t, str(t + 60), "completed")], TRANSFERS)
    tout = spark.createDataFrame([(4, 3, 4.0, t, str(t + 60), "completed")], TRANSFERS)
    inv = spark.createDataFrame(
        [(5, 1, 100.0, t, "", "pending", "investment_transfer_in")], INVESTMENTS
    )
    return pix, tin, tout, inv


def test_ledger_keeps_unknown_accounts_and_customers(spark):
    accounts, customers = _dims(spark)
    pix, tin, tout, inv = _feeds(spark)
    ledger = build_ledger(
        [(pix, PIX_SPEC), (tin, TRANSFER_IN_SPEC), (tout, TRANSFER_OUT_SPEC), (inv, INVESTMENTS_SPEC)],
        accounts,
        customers,
    )
    rows = {r.txn_id: r for r in ledger.collect()}
    assert len(rows) == 5  # = sum of feed rows
    assert rows[1].country_name == "BR" and rows[1].in_or_out == "in" and rows[1].product == "pix"
    assert rows[2].country_name is None  # account 9 unknown
    assert rows[4].country_name is None  # account 3 -> customer 103 unknown
    assert (rows[3].in_or_out, rows[3].product) == ("in", "non_pix")
    assert (rows[4].in_or_out, rows[4].product) == ("out", "non_pix")
    assert (rows[5].in_or_out, rows[5].product, rows[5].txn_completed_at) == ("in", "investments", "")
    assert (rows[1].day, rows[1].month, rows[1].event_date) == (10, "2020-03", "2020-03-10")
    assert ledger.columns[:11] == [
        "account_id", "amount", "txn_requested_at", "txn_completed_at", "status", "in_or_out",
        "product", "country_name", "day", "month", "event_date",
    ]


def test_interval_end_closed_vs_half_open(spark):
    t_end = epoch("2021-01-01", 8)
    rows = [
        ledger_row(1, 10.0, ts=t_end, product="pix", in_or_out="in"),
        ledger_row(1, 3.0, ts=epoch("2020-05-01"), product="pix", in_or_out="out"),
    ]
    closed = R.account_monthly_balance(ledger_df(spark, rows), ("2020-01-01", "2021-01-01"))
    assert {r.month for r in closed.collect()} == {"2021-01", "2020-05"}

    pix = spark.createDataFrame(
        [(1, 1, "pix_in", 10.0, t_end, str(t_end + 1), "completed"),
         (2, 1, "pix_out", 3.0, epoch("2020-05-01"), "x", "completed")],
        PIX_MOVEMENTS,
    )
    empty = spark.createDataFrame([], TRANSFERS)
    half_open = account_monthly_balance_sql(spark, empty, empty, pix, year=2020).collect()
    assert [(r.Month, r.Customer, r.TotalTransferIn, r.TotalTransferOut) for r in half_open] == [
        (5, 1, 0.0, 3.0)
    ]


def test_sql_union_aligns_by_name(spark):
    """pix has in_or_out third, transfers amount third: the union lines up by name."""
    t = epoch("2020-02-02")
    pix = spark.createDataFrame([(1, 7, "pix_out", 2.5, t, str(t), "completed")], PIX_MOVEMENTS)
    tin = spark.createDataFrame([(2, 7, 10.0, t, str(t), "completed")], TRANSFERS)
    tout = spark.createDataFrame([(3, 7, 4.0, t, str(t), "completed"), (4, 7, 1.0, t, "", "failed")], TRANSFERS)
    r = account_monthly_balance_sql(spark, tin, tout, pix, year=2020).collect()
    assert [(x.Month, x.Customer, x.TotalTransferIn, x.TotalTransferOut, x.AccountMonthlyBalance) for x in r] == [
        (2, 7, 10.0, 6.5, 3.5)
    ]


def test_tie_on_first_instant_is_not_a_first_transaction(spark):
    t = epoch("2020-01-05")
    rows = [
        ledger_row(1, 1.0, ts=t, product="pix", txn_id=1),
        ledger_row(1, 2.0, ts=t, product="pix", txn_id=2),
        ledger_row(1, 3.0, ts=t + 100, product="pix", txn_id=3),
        ledger_row(2, 4.0, ts=t, product="pix", txn_id=4),
    ]
    dims = R.with_dimensions(ledger_df(spark, rows))
    counts = {r.txn_id: r.count_txns_orders_per_account_ever for r in dims.collect()}
    assert counts == {1: 2, 2: 2, 3: 3, 4: 1}
    kpi = R.monthly_metrics(dims, ["total_first_txn_orders", "total_orders"]).collect()
    assert [(k.month, k.total_first_txn_orders, k.total_orders) for k in kpi] == [("2020-01", 1, 4)]


def test_fail_rate_null_without_completed_amount(spark):
    rows = [
        ledger_row(1, 5.0, day="2020-01-03", status="failed", product="pix"),
        ledger_row(1, 5.0, day="2020-02-03", status="failed", product="pix"),
        ledger_row(1, 15.0, day="2020-02-04", status="completed", product="pix"),
    ]
    out = R.monthly_metrics(ledger_df(spark, rows), ["fail_rate", "completed_rate", "total_amount"])
    got = {r.month: (r.fail_rate, r.completed_rate, r.total_amount) for r in out.collect()}
    assert got == {"2020-01": (None, 0.0, 5.0), "2020-02": (0.33, 0.75, 20.0)}


def test_text_completion_gives_null_time_and_keeps_row(spark):
    t = epoch("2020-01-05")
    rows = [
        ledger_row(1, 1.0, ts=t, completed_at="None", status="failed", product="pix", txn_id=1),
        ledger_row(1, 1.0, ts=t + 10, completed_at="", status="failed", product="pix", txn_id=2),
        ledger_row(1, 1.0, ts=t + 20, completed_at=None, status="pending", product="pix", txn_id=3),
        ledger_row(1, 1.0, ts=t + 30, completed_at=str(t + 90), product="pix", txn_id=4),
    ]
    dims = R.with_dimensions(ledger_df(spark, rows)).orderBy("txn_id").collect()
    assert len(dims) == 4
    assert [d.time_to_complete_in_seconds for d in dims] == [None, None, None, 60]
    assert [d.txn_completed_at_ts for d in dims][:3] == [None, None, None]
    assert dims[3].txn_requested_at_ts == "2020-01-05 12:00:30"
    # recency: completion of this row minus request of the previous row, days
    assert dims[3].last_txn_date == t + 20
    assert dims[3].time_from_last_txn_in_days == 70 / 86400
    assert dims[0].last_txn_date is None


def test_empty_and_null_arrays_emit_nothing(spark):
    nested = spark.createDataFrame(
        [
            ("11", [("1", "completed", "10.5", "1577880000", "1577880005", None, "investment_transfer_in")]),
            ("12", []),
            ("13", None),
            ("14", [("2", "failed", "x", "1577880000", "None", None, "investment_transfer_out"),
                    ("3", "completed", "7", "1577880000", "1577880001", None, "investment_transfer_out")]),
        ],
        "account_id string, transactions array<struct<transaction_id:string, status:string, amount:string,"
        " investment_requested_at:string, investment_completed_at:string,"
        " investment_completed_at_timestamp:date, type:string>>",
    )
    flat = unnest_investments(nested)
    assert flat.schema == INVESTMENTS
    got = sorted(tuple(r) for r in flat.collect())
    assert got == [
        (1, 11, 10.5, 1577880000, "1577880005", "completed", "investment_transfer_in"),
        (2, 14, None, 1577880000, "None", "failed", "investment_transfer_out"),
        (3, 14, 7.0, 1577880000, "1577880001", "completed", "investment_transfer_out"),
    ]


def test_previous_day_value_and_no_gap_filling(spark):
    rows = [
        ledger_row(1, 100.0, day="2020-01-02", in_or_out="in"),
        ledger_row(1, 30.0, day="2020-01-02", in_or_out="out"),
        ledger_row(1, 50.0, day="2020-03-09", in_or_out="out"),
        ledger_row(1, 999.0, day="2020-03-10", in_or_out="out", status="failed"),
        ledger_row(1, 999.0, day="2020-03-11", in_or_out="in", product="pix"),
    ]
    out = R.investments_daily_ledger(ledger_df(spark, rows), ("2020-01-01", "2021-01-01"))
    got = [(r.event_date, r.balance, r.previous_day_balance, r.movements, r.end_of_day_income)
           for r in out.orderBy("event_date").collect()]
    assert got == [
        ("2020-01-02", 70.0, 0.0, 70.0, 70.0 * 0.0001),
        ("2020-03-09", -50.0, 70.0, 20.0, 20.0 * 0.0001),
    ]


def test_negative_balance_earns_nothing_and_income_does_not_compound(spark):
    rows = [
        ledger_row(1, 100.0, day="2020-01-02", in_or_out="out"),
        ledger_row(1, 300.0, day="2020-01-03", in_or_out="in"),
        ledger_row(1, 1.0, day="2020-01-04", in_or_out="in"),
    ]
    out = R.investments_daily_balance(ledger_df(spark, rows), ("2020-01-01", "2020-12-31"), rate=0.5)
    got = [(r.day, r.end_of_day_income, r.account_daily_balance) for r in out.orderBy("day").collect()]
    assert got == [(2, 0.0, -100.0), (3, 100.0, 300.0), (4, 100.5, 301.5)]


def test_cohort_restricts_accounts_both_ways(spark):
    rows = [ledger_row(a, 10.0, day="2020-01-02") for a in (1, 2, 3)]
    cohort = spark.createDataFrame([(1,), (3,), (3,), (99,)], "account_id long")
    led = ledger_df(spark, rows)
    early = R.investments_daily_balance(led, ("2020-01-01", "2020-12-31"), cohort=cohort)
    late = R.investments_daily_balance(
        led, ("2020-01-01", "2020-12-31"), cohort=cohort, max_broadcast_bytes=0
    )
    assert sorted(r.account_id for r in early.collect()) == [1, 3]
    assert sorted(r.account_id for r in late.collect()) == [1, 3]


@pytest.mark.parametrize("bad", ["None", "", "abc", None])
def test_ansi_mode_text_numbers_do_not_fail(spark, bad):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", "True")
    rows = [ledger_row(1, 1.0, completed_at=bad, status="failed", product="pix")]
    out = R.kpi_series(ledger_df(spark, rows), ["avg_time_to_completed", "fail_rate", "p90"], products=["pix"])
    r = out.collect()[0]
    assert (r.avg_time_to_completed, r.fail_rate, r.p90) == (None, None, None)


def test_status_other_than_completed_or_failed(spark):
    rows = [
        ledger_row(1, 10.0, day="2020-01-02", status="pending", product="pix"),
        ledger_row(1, 30.0, day="2020-01-02", status="completed", product="pix"),
        ledger_row(1, 5.0, day="2020-01-03", status="failed", product="pix"),
    ]
    out = R.monthly_metrics(
        ledger_df(spark, rows),
        ["total_amount", "total_amount_completed", "total_amount_failed", "fail_rate", "completed_rate", "atv"],
    ).collect()[0]
    assert (out.total_amount, out.total_amount_completed, out.total_amount_failed) == (45.0, 30.0, 5.0)
    assert (out.fail_rate, out.completed_rate, out.atv) == (0.17, 0.67, 15.0)
    monthly = R.account_monthly_balance(ledger_df(spark, rows), ("2020-01-01", "2020-12-31")).collect()
    assert [(m.total_transfer_in, m.account_monthly_balance) for m in monthly] == [(30.0, 30.0)]


def test_products_filter_of_monthly_balance(spark):
    rows = [
        ledger_row(1, 10.0, product="pix"),
        ledger_row(1, 20.0, product="non_pix", in_or_out="out"),
        ledger_row(1, 40.0, product="investments"),
    ]
    out = R.account_monthly_balance(ledger_df(spark, rows), ("2020-01-01", "2020-12-31")).collect()
    assert [(r.total_transfer_in, r.total_transfer_out, r.account_monthly_balance) for r in out] == [
        (10.0, 20.0, -10.0)
    ]
    only_pix = R.account_monthly_balance(ledger_df(spark, rows), ("2020-01-01", "2020-12-31"), ["pix"])
    assert [r.account_monthly_balance for r in only_pix.collect()] == [10.0]


def test_zone_independent_calendar(spark):
    from kontor.operators.normalize import normalize

    t = epoch("2020-12-31", 23, 30)
    pix = spark.createDataFrame([(1, 1, "pix_in", 1.0, t, str(t), "completed")], PIX_MOVEMENTS)
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        r = normalize(pix, PIX_SPEC).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.day, r.month, r.event_date) == (31, "2020-12", "2020-12-31")


def test_broadcast_check_measures_string_bytes(spark):
    from kontor.operators.joins import broadcast_if_small, measured_bytes

    df = spark.createDataFrame([(1, "a" * 1000), (2, None), (3, "bc")], "k long, s string")
    b = measured_bytes(df)
    assert b >= 1002 and b < 1002 + 3 * 64
    assert broadcast_if_small(df, max_bytes=b)[1] is True
    assert broadcast_if_small(df, max_bytes=b - 1)[1] is False
    empty = spark.createDataFrame([], "k long, s string")
    assert measured_bytes(empty) == 0


def test_large_dimension_is_joined_by_shuffle(spark):
    accounts, customers = _dims(spark)
    pix, tin, tout, inv = _feeds(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ledger = build_ledger(
            [(pix, PIX_SPEC), (tin, TRANSFER_IN_SPEC), (tout, TRANSFER_OUT_SPEC), (inv, INVESTMENTS_SPEC)],
            accounts,
            customers,
            max_broadcast_bytes=10,
        )
        plan = ledger._jdf.queryExecution().executedPlan().toString()
        rows = {r.txn_id: r.country_name for r in ledger.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert rows == {1: "BR", 2: None, 3: "MX", 4: None, 5: "BR"}


def test_duplicate_customer_ids_fan_out_like_chained_left_joins(spark):
    accounts = spark.createDataFrame([(1, 101), (2, 102)], ACCOUNTS)
    customers = spark.createDataFrame([(101, "BR"), (101, "AR"), (102, "MX")], CUSTOMERS)
    pix, _, _, _ = _feeds(spark)  # account 1 and unknown account 9
    ledger = build_ledger([(pix, PIX_SPEC)], accounts, customers)
    got = sorted((r.txn_id, r.country_name) for r in ledger.collect())
    assert got == [(1, "AR"), (1, "BR"), (2, None)]
    assert "BroadcastHashJoin" in ledger._jdf.queryExecution().executedPlan().toString()
