"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.oracle_check import compare, duck_connection


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(E.ledger_queries()) == set(E.ledger_oracle_sql())
    assert set(E.ledger_queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.ledger_queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, con)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["spark_rows"] > 0, r
    assert r["types_match"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [
        "day", "month", "account_id", "deposit", "withdrawal", "end_of_day_income", "account_daily_balance",
    ]
    assert df.count() > 0


def test_checks_can_fail(spark):
    """The registered inputs hold the cases that tell a right operator from a wrong one."""
    from pyspark.sql import functions as F

    from kontor.sources import testdata as td

    q = E.queries()
    events = E._events(spark, SF_SMALL)
    last = E.INTERVAL[1]
    days = {r[0] for r in events.select("event_date").distinct().collect()}
    assert last in days and min(d for d in days if d > last) and max(days) > last
    docs = td.nested_investments(spark, SF_SMALL)
    kinds = docs.groupBy(F.col("transactions").isNull().alias("null"), (F.size("transactions") == 0).alias("empty"))
    assert {(r["null"], bool(r["empty"])) for r in kinds.count().collect()} == {(True, False), (False, True), (False, False)}
    assert q["kpi_pix"](spark, SF_SMALL).count() > 6
    rates = q["kpi_rates"](spark, SF_SMALL)
    assert rates.where("fail_rate IS NULL").count() > 0 and rates.where("fail_rate IS NOT NULL").count() > 0
    ledger = q["product_daily_events"](spark, SF_SMALL)
    assert ledger.count() == events.count()
    assert 0 < ledger.where("country_name IS NULL").count() < ledger.count()


def test_month_order_of_the_kpi_series(spark):
    rows = [(r["product"], r["month"]) for r in E.queries()["kpi_all"](spark, SF_SMALL).collect()]
    assert rows == sorted(rows)
