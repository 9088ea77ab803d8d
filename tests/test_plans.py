"""Plan shape checks: what the optimizer must (not) do at scale."""

from helpers import ledger_df, ledger_row

import __spark_entry__ as E
from conftest import SF_SMALL
from kontor.plans import reports as R


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_daily_balance_runs_one_running_sum(spark):
    rows = [ledger_row(1, 10.0, day="2020-01-02"), ledger_row(1, 5.0, day="2020-01-03", in_or_out="out")]
    out = R.investments_daily_balance(ledger_df(spark, rows), ("2020-01-01", "2020-12-31"))
    opt = _optimized(out)
    window_lines = [l for l in opt.split("\n") if "Window [" in l]
    assert len(window_lines) == 1
    assert window_lines[0].count("sum(balance") == 1


def test_ledger_dimension_join_is_broadcast_when_small(spark):
    df = E.queries()["product_daily_events"](spark, SF_SMALL)
    p = _plan(df)
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert "SortMergeJoin" not in p


def test_sql_report_filter_reaches_scan(spark):
    df = E.queries()["account_monthly_balance_sql"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "from_unixtime" not in p
    # the epoch range is applied per feed below the union, before any aggregate
    final = p.split("== Initial Plan ==")[0]
    union_at = final.index("Union")
    assert final.index("HashAggregate") < union_at
    assert final.count("1609459200") == 0 and final.count("820454400") >= 3  # year 1996 lower bound, 3 feeds


def test_kpis_share_one_aggregation(spark):
    df = E.queries()["kpi_all"](spark, SF_SMALL)
    opt = _optimized(df)
    kpis = [line for line in opt.split("\n") if "Aggregate [" in line and "percentile_approx" in line]
    assert len(kpis) == 1 and "total_amount" in kpis[0] and "total_orders" in kpis[0]


def test_no_python_udfs_anywhere(spark):
    for name, q in E.ledger_queries().items():
        p = _plan(q(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_large_cohort_semi_join_shuffle_serves_the_window(spark):
    from kontor.sources import testdata as td

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = R.investments_daily_balance(
            E._ledger(spark, SF_SMALL), E.INTERVAL, cohort=td.investment_accounts_to_send(spark, SF_SMALL),
            max_broadcast_bytes=0,
        )
        out.collect()
        lines = _plan(out).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    w = next(i for i, l in enumerate(lines) if "Window [" in l)
    semi = next(i for i, l in enumerate(lines) if "LeftSemi" in l)
    assert w < semi
    assert not any("Exchange" in l for l in lines[w:semi])
    # the semi join sits above the final aggregate: it filters daily rows, not raw rows
    assert any("HashAggregate" in l for l in lines[semi:])


def test_sql_report_year_filter_pushed_to_parquet_feeds(spark, scratch):
    from helpers import epoch

    from kontor.plans.sql_reports import account_monthly_balance_sql
    from kontor.schemas import PIX_MOVEMENTS, TRANSFERS

    t = epoch("2020-05-05")
    spark.createDataFrame([(1, 1, 5.0, t, str(t), "completed")], TRANSFERS).write.parquet(f"{scratch}/tin")
    spark.createDataFrame([(2, 1, 3.0, t, str(t), "completed")], TRANSFERS).write.parquet(f"{scratch}/tout")
    spark.createDataFrame([(3, 1, "pix_in", 1.0, t, str(t), "completed")], PIX_MOVEMENTS).write.parquet(
        f"{scratch}/pix"
    )
    out = account_monthly_balance_sql(
        spark,
        spark.read.parquet(f"{scratch}/tin"),
        spark.read.parquet(f"{scratch}/tout"),
        spark.read.parquet(f"{scratch}/pix"),
        year=2020,
    )
    assert [tuple(r) for r in out.collect()] == [(5, 1, 6.0, 3.0, 3.0)]
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("formatted")
    plan = buf.getvalue()
    lo = "GreaterThanOrEqual(transaction_requested_at,1577836800)"
    hi = "LessThan(transaction_requested_at,1609459200)"
    assert plan.count(lo) == 2 and plan.count(hi) == 2
    assert "GreaterThanOrEqual(pix_requested_at,1577836800)" in plan
    assert "EqualTo(status,completed)" in plan


def test_monthly_balance_shares_its_two_sums(spark):
    rows = [ledger_row(1, 10.0, product="pix"), ledger_row(1, 4.0, product="pix", in_or_out="out")]
    out = R.account_monthly_balance(ledger_df(spark, rows), ("2020-01-01", "2020-12-31"))
    partial = next(l for l in _plan(out).split("\n") if "HashAggregate" in l and "partial_" in l)
    assert partial.count("partial_sum") == 2  # balance reuses the in and out sums
    assert [r.account_monthly_balance for r in out.collect()] == [6.0]


def _jobs_while(spark, build):
    """Spark jobs that building a query starts."""
    sc, group = spark.sparkContext, "plan-build"
    sc.setJobGroup(group, group)
    try:
        build()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_building_a_query_takes_few_jobs(spark):
    q = E.ledger_queries()
    for name in ("raw_union_all", "account_monthly_balance", "kpi_all", "unnest_investments", "txn_count_trailing"):
        assert _jobs_while(spark, lambda name=name: q[name](spark, SF_SMALL)) == 0, name
    assert _jobs_while(spark, lambda: q["product_daily_events"](spark, SF_SMALL)) <= 8  # two measurements


def test_reports_without_country_read_no_dimension(spark):
    for name in ("kpi_amounts", "account_monthly_balance", "txn_count_trailing"):
        assert "c_custkey" not in _optimized(E.queries()[name](spark, SF_SMALL))


def test_payments_read_the_transfers_once(spark):
    for name in ("raw_union_all", "account_monthly_balance_sql"):
        opt = _optimized(E.queries()[name](spark, SF_SMALL))
        assert opt.count("l_shipdate") and opt.count("Join Inner") == 1, name


def test_sequence_dimensions_pass_over_the_ledger_twice(spark):
    out = E.queries()["txn_dimensions"](spark, SF_SMALL)
    out.collect()
    final = _plan(out).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") <= 2 * 4 + 2  # four feeds' tables twice, customer and nation once
