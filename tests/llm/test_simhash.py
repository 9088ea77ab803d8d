import numpy as np
import pytest
import xxhash
from helpers_llm import clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from kontor.llm import simhash
from kontor.llm.components import connected_components


def plain_fingerprint(text, words=4):
    tokens = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        tokens = tokens.replace(c, " ")
    tokens = [t for t in tokens.split(" ") if t]
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(tokens[i : i + words]).encode(), seed=42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(prints, ids, distance=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = []
    for i in range(len(prints)):
        named = [ids[j] for j in range(len(prints)) if find(j) == find(i) and ids[j] is not None]
        out.append(min(named) if named else None)
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAB éß\t\n\x0b\x0c\x1c\x85 ", max_size=60))
def test_fingerprint_equals_the_plain_form(text):
    assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == whole


def test_segments_lose_no_link():
    rng = np.random.default_rng(1)
    for distance in (0, 1, 3, 4, 5, 8):
        for count in range(2, max(3, distance + 2)):
            parts = simhash.segments(distance, count)
            for _ in range(300):
                flips = rng.choice(64, int(rng.integers(0, distance + 1)), replace=False)
                diff = sum(1 << int(f) for f in flips)
                assert any(((diff >> s) & ((1 << w) - 1)).bit_count() <= r for s, w, r in parts)


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 50, 120)) for _ in range(6)]
    rows = []
    for i in range(60):
        words = base[i % 6].split()
        for k in rng.integers(0, 120, int(rng.integers(0, 4))):
            words[k] = f"x{rng.integers(0, 9)}"
        rows.append((i + 3, " ".join(words)))
    rows += [(100, None), (101, ""), (102, " \n "), (5, "short"), (5, "short"), (None, base[0]), (None, "alone here"), (7, "Short")]
    got = simhash.near_duplicates(clashing(documents(spark, rows)).drop("fingerprint")).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    want = sorted(
        (str(i), format(f, "016x"), str(c)) for (i, _), f, c in zip(rows, prints, plain_components(prints, [r[0] for r in rows]))
    )
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def family(size, base=0x8123456789ABCDEF, first=4):
    """Different fingerprints, each with at most two bits other than ``base``."""
    flips = [1 << a | 1 << b for a in range(first, 64) for b in range(first, a + 1)]
    return [base, *[base ^ f for f in flips[: size - 1]]]


@pytest.mark.parametrize("crowd, block", [(256, 1024), (8, 16), (8, 1024)])
def test_families_give_links_in_the_order_of_their_size(spark, monkeypatch, crowd, block):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "CROWD_BLOCK", block)
    rng = np.random.default_rng(3)
    prints = family(460) + [int(x) for x in rng.integers(0, 2**63, 80)] + family(60, base=0, first=20)
    prints += [prints[-1] ^ 0xF0000, prints[-1] ^ 0xFF0000]  # a chain out of the family
    prints = list(dict.fromkeys(prints))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    links = simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in signed], "f bigint")).collect()
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    want = plain_components(prints, list(range(len(prints))))
    least: dict = {}
    for p, c in zip(signed, want):
        least.setdefault(c, []).append(p)
    for members in least.values():
        assert {got.get(p, p) for p in members} == {min(members)} if len(members) > 1 else members[0] not in got
    if crowd == 8 and block == 1024:  # no more than one pair a fingerprint and crowded cell, few others
        all_pairs = sum((a ^ b).bit_count() <= 4 for i, a in enumerate(prints) for b in prints[:i])
        assert all_pairs > 100_000 and len(links) < 20 * len(prints)


def test_a_common_fingerprint_stays_spread(spark, monkeypatch):
    from kontor.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rows = [(i, "the same text in many documents of all") for i in range(9, 60)] + [(i, None) for i in range(100, 120)]
    rows += [(i, f"number {i} stands alone here with {i * i} and {i * 7}") for i in range(200, 230)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    want = plain_components([plain_fingerprint(t) for _, t in rows], [i for i, _ in rows])
    assert got == {i: c for (i, _), c in zip(rows, want)}


def test_no_documents(spark):
    empty = documents(spark, [])
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_first(empty).collect() == []


def test_keep_first_keeps_one_row_of_each_group(spark):
    text = "one two three four five six seven"
    rows = [(9, text), (2, text), (2, text), (None, text), (4, "quite other words stand here"), (None, "named by nobody at all"), (None, "named by nobody at all"), (6, None), (7, "")]
    df = clashing(documents(spark, rows))
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        [("2", text), ("4", "quite other words stand here"), ("None", "named by nobody at all"), ("6", "None")]
    )


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
    none = spark.createDataFrame([], "x bigint, y bigint")
    assert connected_components(none).collect() == []
