import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from kontor.llm import decontaminate, mixing, pii, simhash
from kontor.llm import queries as registered
from tools.oracle_check import compare

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_queries_are_registered():
    assert {n.split("_")[0] for n in registered.queries()} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(registered.queries()) <= set(entry.queries())
    assert set(registered.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, registered.queries()[name], registered.oracle_sql()[name], SF_SMALL, con)
    assert r["spark_rows"] == r["oracle_rows"] > 0 and r["types_match"] and r["values_match"], r


def test_every_stage_takes_effect(spark, con):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    columns, before = docs.columns, docs.count()
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL).checkpoint()
        assert docs.columns == columns
        rows = {r.doc_id: r.text for r in docs.collect()}
        assert len(rows) <= before
        before = len(rows)
        if name == "quality":
            good = [i for i, q in labels.items() if q]
            assert sum(i in rows for i in good) >= 0.95 * len(good)
        if name == "near_duplicates":
            prints = [simhash.fingerprint(t) % 2**64 for t in rows.values()]
            assert all((a ^ b).bit_count() > 4 for k, a in enumerate(prints) for b in prints[:k])
        if name == "decontaminate":
            assert decontaminate.contaminated(docs, benchmark).count() == 0
        if name == "pii":
            assert not any(pii.base_spans(t or "") for t in rows.values())
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert sorted(r.doc_id for r in mixed) == sorted(rows)
    assert all(0 <= r.taken <= mixing.MAX_REPEATS * r["size"] for r in mixed)
    assert {r.doc_id: r.text for r in mixed} == rows
    assert all(sum(p.past_word - p.first_word for p in r.pieces) == r.taken for r in mixed)
