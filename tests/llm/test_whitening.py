import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kontor.llm import whitening
from kontor.llm.queries import op12_whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def by_hand(vectors):
    """(x, exact deviations, eigenvalues and -vectors by falling eigenvalue) with plain products."""
    d = max(map(len, vectors))
    x = np.floor(1024 * np.array([v + [0.0] * (d - len(v)) for v in vectors])).astype(int) + 100_000
    y = len(x) * x.astype(object) - x.sum(axis=0).astype(object)
    centred = x - x.mean(axis=0)
    values, columns = np.linalg.eigh(centred.T @ centred / len(x))
    return centred, (y * y).sum(axis=1), values[::-1], columns[:, ::-1]


def test_query_equals_plain_covariances(spark, scratch):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(300, 12)) * np.linspace(0.2, 1.5, 12)
    vectors = [v.tolist() for v in base] + [base[0].tolist()] * 40 + [[0.0] * 12]
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    odd = [(-1, None, 0), (-2, [None] + [1.0] * 11, 0), (-3, [float("nan")] * 12, 0), (-4, [float("-inf")] + [0.0] * 11, 0)]
    spark.createDataFrame(rows + odd, SCHEMA).write.parquet(f"{scratch}/embeddings.parquet")
    got = op12_whitening(spark, scratch).toPandas()
    centred, deviation, values, columns = by_hand(vectors)
    assert len(got) == 8 * len(vectors) and set(got.n) == {len(vectors)}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[range(len(vectors))].to_numpy()
    want = centred @ columns[:, :8] / np.sqrt(values[:8])
    signs = np.sign((wide * want).sum(axis=0))
    assert np.abs(wide * signs - want).max() < 1e-9
    first = got[got.component == 1].set_index("vec_id")
    assert [int(first.deviation[i]) for i in range(len(vectors))] == [int(v) for v in deviation]
    share = got.groupby("component").explained.agg(["min", "max"])
    assert (share["min"] == share["max"]).all()
    assert np.abs(share["min"].to_numpy() - values[:8] / values.sum()).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_sums_of_squares_are_exact():
    rnd = random.Random(2)
    for top in (3, 10**6, 10**12, 10**17):
        w = np.array([[rnd.randint(-top, top) for _ in range(4)] for _ in range(500)], np.int64)
        assert whitening.square_sums(w) == [sum(int(v) ** 2 for v in w[:, c]) for c in range(4)]
        assert whitening.square_sums(w.astype(object)) == whitening.square_sums(w)
    assert whitening.square_sums(np.zeros((0, 2), np.int64)) == [0, 0]


def test_centred_values_leave_64_bits_only_as_python_integers():
    x = np.array([[1 << 40], [-(1 << 40)]], np.int64)
    assert whitening.centred(x, 1 << 30, (5,)).tolist() == [[(1 << 70) - 5], [-(1 << 70) - 5]]
    assert whitening.centred(x, 2, (0,)).dtype == np.int64


def test_covariances_come_from_differences_of_variances(spark):
    rows = [([100_000 + a, 100_000 + b, 100_000 - a],) for a, b in [(1, 2), (3, 5), (-7, 11), (0, 0)]]
    x = spark.createDataFrame(rows, "x array<bigint>")
    n, totals = whitening.sums(x)
    squares = whitening.pair_squares(x, n, totals)
    assert set(squares) == {(i, j) for i in range(3) for j in range(i, 3)}
    dense = np.array([r[0] for r in rows], float)
    dense -= dense.mean(axis=0)
    assert np.allclose(whitening.covariance(n, 3, squares), dense.T @ dense / 4, rtol=1e-15)


@pytest.mark.parametrize(
    ("vectors", "whitened"),
    [
        ([], []),
        ([[]], []),
        ([[1.0, 2.0]], [None, None]),
        ([[1.0, 1.0], [1.0, 2.0]], [-1.0, None, 1.0, None]),
        ([[1.0], [1.0, 1.0]], [-1.0, None, 1.0, None]),  # the shorter one ends in zeros
    ],
)
def test_few_and_flat_vectors(spark, vectors, whitened):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)
    rows = sorted(whitening.whitened_components(df).collect(), key=lambda r: (r.vec_id, r.component))
    found = [r.whitened for r in rows]
    assert found == whitened or found == [v and -v for v in whitened]


def test_other_columns_and_repeated_rows_stay(spark):
    rows = [(1, [1.0, 0.0], 7), (1, [1.0, 0.0], 7), (None, [0.0, 1.0], None), (3, [0.5, 2.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("y") for c in ("x", "at", "n", "component", "value")})
    out = whitening.whitened_components(df, components=1)
    assert [r.component for r in out.collect()] == [1] * 4
    assert sorted(str(r.vec_id) for r in out.collect()) == ["1", "1", "3", "None"]
    assert {(r.x, r.at, r.value, r.n) for r in out.collect()} == {("y", "y", "y", 4)}
