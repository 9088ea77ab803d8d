"""Properties across reports, on the smallest benchmark tables and on random ledgers."""

import datetime as dt

from helpers import epoch, ledger_df, ledger_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from kontor.plans import reports as R
from kontor.plans.sql_reports import account_monthly_balance_sql
from kontor.sources import testdata as td


def test_sql_and_dataframe_monthly_balance_agree(spark):
    """Same year, same products: the half-open SQL report over the raw feeds
    equals the closed-interval report over the ledger ending the day before."""
    f = td.load_feeds(spark, SF_SMALL)
    sql = account_monthly_balance_sql(spark, f.transfer_ins, f.transfer_outs, f.pix_movements, year=1996)
    df = R.account_monthly_balance(E._ledger(spark, SF_SMALL), ("1996-01-01", "1996-12-31"))
    a = {(r.Month, r.Customer): (r.TotalTransferIn, r.TotalTransferOut, r.AccountMonthlyBalance) for r in sql.collect()}
    b = {
        (int(r.month[5:]), r.account_id): (r.total_transfer_in, r.total_transfer_out, r.account_monthly_balance)
        for r in df.collect()
    }
    assert a.keys() == b.keys() and len(a) > 0
    for k in a:
        assert all(abs(x - y) < 1e-6 for x, y in zip(a[k], b[k])), k


def test_balances_add_up_to_total_flows(spark):
    led = E._ledger(spark, SF_SMALL)
    interval = ("1995-01-01", "2002-01-01")
    monthly = R.account_monthly_balance(led, interval).agg(F.sum("account_monthly_balance")).first()[0]
    flows = (
        led.where("status = 'completed' AND product IN ('pix', 'non_pix')")
        .agg(F.sum(F.when(F.col("in_or_out") == "in", F.col("amount")).otherwise(-F.col("amount"))))
        .first()[0]
    )
    assert abs(monthly - flows) < 1e-3
    daily = R.investments_daily_ledger(led, interval)
    last = daily.groupBy("account_id").agg(F.max_by("movements", "event_date").alias("m"))
    net = daily.groupBy("account_id").agg(F.sum("balance").alias("n"))
    diff = last.join(net, "account_id").where(F.abs(F.col("m") - F.col("n")) > 1e-6).count()
    assert diff == 0
    assert daily.where("end_of_day_income < 0").count() == 0


def test_ledger_rows_equal_feed_rows(spark):
    f = td.load_feeds(spark, SF_SMALL)
    want = f.pix_movements.count() + f.transfers.count() + f.investments.count()
    assert E._ledger(spark, SF_SMALL).count() == want


def _brute_daily(rows, lo, hi, rate):
    per = {}
    for r in rows:
        acc, amount, _, _, status, direction, product, _, _, _, day = r[:11]
        if status != "completed" or product != "investments" or not (lo <= day <= hi):
            continue
        d = per.setdefault(acc, {}).setdefault(day, [0.0, 0.0])
        d[0 if direction == "in" else 1] += amount
    out = {}
    for acc, days in per.items():
        mov, prev = 0.0, 0.0
        for day in sorted(days):
            dep, wd = days[day]
            bal = dep - wd
            mov += bal
            inc = max(mov * rate, 0.0)
            out[(acc, day)] = (dep, wd, bal, prev, mov, inc, mov + inc)
            prev = bal
    return out


_row = st.tuples(
    st.integers(1, 4),
    st.sampled_from([1.25, 10.0, 99.99, 250.5, 0.01]),
    st.integers(0, 40),
    st.sampled_from(["completed", "completed", "failed"]),
    st.sampled_from(["in", "out"]),
    st.sampled_from(["investments", "investments", "pix"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_row, min_size=1, max_size=40))
def test_daily_ledger_matches_brute_force(spark, raw):
    base = dt.date(2020, 12, 10)
    rows = [
        ledger_row(acc, amt, ts=epoch((base + dt.timedelta(days=d)).isoformat(), 10), status=s,
                   in_or_out=io, product=p, txn_id=i)
        for i, (acc, amt, d, s, io, p) in enumerate(raw)
    ]
    lo, hi = "2020-12-15", "2021-01-10"
    got = {
        (r.account_id, r.event_date): (r.deposit, r.withdrawal, r.balance, r.previous_day_balance,
                                       r.movements, r.end_of_day_income, r.account_daily_balance)
        for r in R.investments_daily_ledger(ledger_df(spark, rows), (lo, hi), rate=0.001).collect()
    }
    want = _brute_daily(rows, lo, hi, 0.001)
    assert got.keys() == want.keys()
    for k in got:
        assert all(abs(x - y) < 1e-9 for x, y in zip(got[k], want[k])), (k, got[k], want[k])


def test_kpis_by_product_equal_one_product_at_a_time(spark):
    from kontor.functions.metrics import KPI_METRICS

    led = E._ledger(spark, SF_SMALL)
    together = {
        (r["product"], r["month"]): r.asDict()
        for r in R.kpi_series(led, KPI_METRICS, products=None, by_product=True).collect()
    }
    for product in ("pix", "non_pix", "investments"):
        alone = R.kpi_series(led, KPI_METRICS, products=[product], by_product=False).collect()
        assert alone, product
        for r in alone:
            t = together[(product, r["month"])]
            for k, v in r.asDict().items():
                if isinstance(v, float):
                    assert abs(t[k] - v) <= 1e-6 * max(1.0, abs(v)), (product, r["month"], k)
                else:
                    assert t[k] == v, (product, r["month"], k)


def test_reports_over_stored_ledger_equal_in_memory(spark, scratch):
    from kontor.functions.metrics import KPI_METRICS
    from kontor.sources.sinks import write_ledger

    led = E._ledger(spark, SF_SMALL)
    write_ledger(led, path=f"{scratch}/ledger")
    stored = spark.read.parquet(f"{scratch}/ledger")
    assert dict(stored.dtypes)["month"] == "string" and stored.count() == led.count()
    interval = ("1995-01-01", "2002-01-01")
    pairs = [
        (R.account_monthly_balance(led, interval), R.account_monthly_balance(stored, interval)),
        (R.investments_daily_ledger(led, interval), R.investments_daily_ledger(stored, interval)),
        (R.kpi_series(led, KPI_METRICS), R.kpi_series(stored, KPI_METRICS)),
    ]
    for mem, disk in pairs:
        a = E._round(mem, {c: 6 for c, t in mem.dtypes if t == "double"})
        b = E._round(disk.select(*mem.columns), {c: 6 for c, t in mem.dtypes if t == "double"})
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
