"""CSV headers by file, JSON texts, counted percentiles, positions, bucketed ledger, shared folder."""

import math
import os
import random

import pytest
from helpers import ledger_df, ledger_row
from pyspark.sql import functions as F

from kontor.operators.percentiles import exact_percentiles
from kontor.operators.position import with_position
from kontor.operators.unnest import unnest_investments
from kontor.plans import reports as R
from kontor.schemas import ACCOUNTS
from kontor.sources.files import parse_nested_investments, read_feed_csv
from kontor.sources.sinks import write_ledger


def _files(folder, **texts):
    os.makedirs(folder)
    for name, text in texts.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)


# -- CSV ----------------------------------------------------------------------------------------
def test_each_csv_file_has_its_own_column_order(spark, scratch):
    folder = f"{scratch}/of [all] {{years}}"
    _files(
        folder, **{"a 1%": "account_id,customer_id,extra\n10,1,x\n", "b": "customer_id,account_id\n2,20\n,21\n"},
        c="extra,customer_id,more,account_id\ny,3,z,30\n", d="", e="customer_id,account_id\n", f="account_id,customer_id,extra\n40,4,x\n",
    )
    got = read_feed_csv(spark, folder.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}"), ACCOUNTS)
    assert sorted(map(tuple, got.collect()), key=str) == [(10, 1), (20, 2), (21, None), (30, 3), (40, 4)]
    assert got.schema.names == ["account_id", "customer_id"]


def test_csv_file_without_a_column_is_named(spark, scratch):
    _files(f"{scratch}/x", a="account_id,customer_id\n1,2\n", b="account_id,client\n3,4\n")
    with pytest.raises(ValueError, match=r"b\.csv.*customer_id"):
        read_feed_csv(spark, f"{scratch}/x", ACCOUNTS)


def test_csv_without_schema_has_every_column(spark, scratch):
    _files(f"{scratch}/x", a="p,q\n1,2\n", b="r,p\n3,4\n")
    got = read_feed_csv(spark, f"{scratch}/x")
    assert sorted(map(str, ((r.p, r.q, r.r) for r in got.collect()))) == ["('1', '2', None)", "('4', None, '3')"]


def test_csv_folder_without_lines(spark, scratch):
    _files(f"{scratch}/x", a="")
    got = read_feed_csv(spark, f"{scratch}/x", ACCOUNTS)
    assert got.collect() == [] and got.schema.names == ["account_id", "customer_id"]


# -- JSON texts ---------------------------------------------------------------------------------
def test_malformed_documents_are_kept_apart(spark):
    good = '{"account_id":"1","transactions":[{"transaction_id":"5","amount":"2.5","status":"completed"}]}'
    texts = [good, good[:-3], "[]x", "", " ", None, '{"account_id":"2"}', '{"account_id":"3","transactions":[]}', '"word"', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, document string")
    got = {r.n: r for r in parse_nested_investments(df).collect()}
    assert {n for n, r in got.items() if r.malformed is not None} == {1, 2, 3, 4, 5, 8}
    assert got[1].malformed == good[:-3] and got[1].account_id is None and got[1].transactions is None
    assert got[5].malformed == "" and got[6].account_id == "2" and got[3].malformed == ""
    flat = unnest_investments(parse_nested_investments(df)).collect()
    assert [(r.id, r.account_id, r.amount, r.status, r.type) for r in flat] == [(5, 1, 2.5, "completed", None)]


# -- percentiles --------------------------------------------------------------------------------
def test_percentiles_of_many_different_values_are_exact(spark):
    rnd = random.Random(1)
    groups = {"many": [rnd.randint(0, 10**9) for _ in range(30_000)], "one": [7], "ten": list(range(10)), None: [3, 3, 3, 8]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("ten", None), ("void", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {r.g: (r.p90, r.p99) for r in exact_percentiles(df, ["g"], "v", {"p90": "0.90", "p99": "0.99"}).collect()}
    want = {g: tuple(sorted(vs)[math.ceil(len(vs) * p / 100) - 1] for p in (90, 99)) for g, vs in groups.items()}
    assert got == want | {"void": (None, None)}
    assert len(set(groups["many"])) > 10_000


def test_series_with_counted_percentiles_has_the_same_columns(spark):
    rows = [ledger_row(1, 10.0, day="2020-01-02"), ledger_row(2, 5.0, day="2020-02-03", status="failed", completed_at="None")]
    names = ["p99", "total_amount", "avg_time_to_completed", "p90"]
    sketch, exact = (R.kpi_series(ledger_df(spark, rows), names, exact_percentiles=e) for e in (False, True))
    assert exact.schema.names == sketch.schema.names and exact.collect() == sketch.collect()
    only = R.kpi_series(ledger_df(spark, rows), ["p90"], exact_percentiles=True)
    assert only.schema.names == ["product", "month", "p90"]


# -- positions ----------------------------------------------------------------------------------
def test_positions_equal_a_sort(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.randint(0, 10**6), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(7)
    got = {r.i: r.at for r in with_position(df, ["k", "v", "i"], "at").collect()}
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert got == {r[2]: n for n, r in enumerate(want, 1)}
    assert with_position(df.where("i < 0"), ["k"]).collect() == []


def test_rows_equal_in_the_order_get_every_position_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit("x").alias("position"))
    got = with_position(df, ["k"]).collect()
    assert sorted(r.position for r in got) == list(range(1, 1001))
    assert [r.k for r in sorted(got, key=lambda r: r.position)] == sorted(r.k for r in got)


# -- bucketed ledger ----------------------------------------------------------------------------
@pytest.fixture()
def bucketed(spark):
    rnd = random.Random(3)
    rows = [
        ledger_row(rnd.randint(1, 40), float(rnd.randint(1, 9)), day=f"2020-{1 + i % 3:02d}-{1 + i % 28:02d}", in_or_out=rnd.choice(["in", "out"]))
        for i in range(400)
    ]
    spark.sql("DROP TABLE IF EXISTS bucketed_ledger")
    write_ledger(ledger_df(spark, rows), table="bucketed_ledger", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield ledger_df(spark, rows), spark.table("bucketed_ledger")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    spark.sql("DROP TABLE bucketed_ledger")


def _exchanges_over_the_ledger(df):
    """Exchanges that the ledger's rows go through in the plan that ran."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    scan = next(i for i, line in enumerate(final) if "bucketed_ledger" in line and "Scan" in line)
    depth, above = len(final[scan]) - len(final[scan].lstrip(" :+-*()0123456789")), 0
    for line in reversed(final[:scan]):
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if own < depth:
            depth, above = own, above + ("Exchange" in line)
    return above


def test_bucketed_ledger_needs_no_exchange_for_daily_windows(spark, bucketed):
    ledger, table = bucketed
    interval = ("2020-01-01", "2020-12-31")
    daily = R.investments_daily_ledger(table, interval)
    assert sorted(daily.drop("x").collect()) == sorted(R.investments_daily_ledger(ledger, interval).collect())
    assert _exchanges_over_the_ledger(daily) == 0


def test_bucketed_ledger_needs_no_exchange_for_the_cohort_join(spark, bucketed):
    ledger, table = bucketed
    cohort = spark.range(5, 20).select(F.col("id").alias("account_id"))
    joined = table.join(cohort, "account_id", "left_semi")
    assert joined.count() == ledger.join(cohort, "account_id", "left_semi").count()
    assert _exchanges_over_the_ledger(joined) == 0


def test_buckets_need_a_table(spark, scratch):
    with pytest.raises(ValueError):
        write_ledger(ledger_df(spark, [ledger_row(1, 1.0)]), path=f"{scratch}/l", buckets=4)
