import numpy as np
import pytest

from kontor.llm import embeddings as E

SCHEMA = "vec_id bigint, embedding array<float>, label int, home string, key string"


def brute(rows, threshold):
    usable = {}
    dims = [len(v) for _, v in rows if v is not None]
    most = max(set(dims), key=dims.count) if dims else 0
    for k, (i, v) in enumerate(rows):
        if i is not None and v is not None and len(v) == most and None not in v:
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and (x != 0).any():
                x = x / np.abs(x).max()
                usable[k] = x / np.linalg.norm(x)
    keys = sorted(usable)
    x = np.array([usable[k] for k in keys]).reshape(len(keys), -1)
    near = x @ x.T >= threshold if len(keys) else np.zeros((0, 0), bool)
    comp = {k: {k} for k in range(len(rows))}
    links = dict.fromkeys(range(len(rows)), 0)
    for a, ka in enumerate(keys):
        for b in np.nonzero(near[a])[0]:
            if b != a:
                links[ka] += 1
                joined = comp[ka] | comp[keys[b]]
                for k in joined:
                    comp[k] = joined
    out = []
    for k, (i, _) in enumerate(rows):
        named = [rows[j][0] for j in comp[k] if rows[j][0] is not None]
        out.append((i, links[k], min(named) if named else None))
    return out


def table(spark, rows):
    typed = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], 0, "x", "y") for i, v in rows]
    return spark.createDataFrame(typed, SCHEMA), [(i, v) for i, v, *_ in typed]


def as_rows(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize("blocks", [None, 40])
def test_links_equal_brute_force(spark, monkeypatch, blocks):
    if blocks:  # several blocks of members and queries in each list
        monkeypatch.setattr(E, "MEMBER_BLOCK", blocks)
        monkeypatch.setattr(E, "QUERY_BLOCK", blocks)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16))
    rows = [(int(i) + 10, list(centres[i % 40] + rng.standard_normal(16) * rng.choice([0.1, 0.25, 0.4]))) for i in range(500)]
    rows += [(5, rows[0][1]), (6, rows[0][1]), (7, rows[1][1]), (900, [2 * c for c in rows[2][1]])]
    rows += [(901, None), (902, [0.0] * 16), (903, [float("nan")] * 16), (907, [float("-inf")] + [1.0] * 15), (908, [1e-40] * 16), (909, [1e-41] * 16), (904, [None] * 16), (905, [1.0] * 3), (None, rows[3][1]), (906, [])]
    df, stored = table(spark, rows)
    want = brute(stored, E.THRESHOLD)
    got = as_rows(E.near_duplicates(df))
    total = sum(n for _, n, _ in want)
    assert total > 500
    found = sum(n for _, n, _ in got)
    assert 0.99 * total <= found <= total
    if found == total:
        assert got == sorted((str(i), n, str(c)) for i, n, c in want)


def test_one_large_group(spark):
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(8)
    rows = [(i, list(centre + rng.standard_normal(8) * 0.02)) for i in range(300)] + [(i, list(centre)) for i in range(300, 400)]
    df, _ = table(spark, rows)
    got = E.near_duplicates(df).collect()
    assert {(r.n_links, r.component_id, r.kept) for r in got} == {(399, 0, True), (399, 0, False)}
    assert sum(r.kept for r in got) == 1


def test_nothing_to_compare(spark):
    df, _ = table(spark, [])
    assert E.near_duplicates(df).collect() == []
    df, _ = table(spark, [(1, None), (2, [0.0, 0.0])])
    assert as_rows(E.near_duplicates(df)) == [("1", 0, "1"), ("2", 0, "2")]
    df, _ = table(spark, [(4, [1.0, 2.0])])
    assert as_rows(E.near_duplicates(df)) == [("4", 0, "4")]


def test_each_length_is_compared_with_itself(spark):
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.1, 0.0]), (3, [0.0, 0.0, 1.0]),
        (4, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [2.0, 4.1]), (7, [-1.0, 2.0]),
        (8, [1.0]), (9, [3.0]), (10, [-1.0]), (11, [1.0, 0.0, 0.0, 0.0]), (12, []),
    ]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(df).collect()}
    assert got == {
        1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (2, 4), 5: (2, 4), 6: (2, 4), 7: (0, 7),
        8: (1, 8), 9: (1, 8), 10: (0, 10), 11: (0, 11), 12: (0, 12),
    }
