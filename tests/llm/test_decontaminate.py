import time

import numpy as np
from helpers_llm import clashing, documents

from kontor.llm import decontaminate as D


def words(rng, n):
    return [f"w{int(x)}" for x in rng.integers(0, 400, n)]


def bench(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, score string")


def plain(docs, items):
    """Every part of every item aligned with every whole document."""
    block = D.Block.of(items)
    out = set()
    for i, text in docs:
        ids = block.ids([text], D._Ids(block.vocabulary))[0][:-1]
        for p, part in enumerate(block.parts):
            score, matched, _, _ = D.align(part, ids)
            if score >= D.MIN_SCORE * D.MATCH * len(part) and matched >= min(D.MIN_WORDS, len(part)):
                out.add((i, block.items[p]))
    return out


def case(rng):
    items = [(k, " ".join(words(rng, int(rng.integers(12, 60))))) for k in range(12)]
    docs = []
    for i in range(150):
        body = words(rng, int(rng.integers(5, 300)))
        if i % 3 == 0:
            item = items[i % 12][1].split()
            if i % 2:  # edited: words replaced, dropped and added
                for at in rng.integers(0, len(item), len(item) // 8):
                    item[at] = "edited"
                item.insert(int(rng.integers(0, len(item))), "added")
            at = int(rng.integers(0, len(body)))
            body[at:at] = [w.upper() + "," if k % 5 == 0 else w for k, w in enumerate(item)]
        docs.append((i, " ".join(body)))
    return docs, items


def test_leaks_equal_alignment_of_everything(spark):
    docs, items = case(np.random.default_rng(8))
    got = D.contaminated(clashing(documents(spark, docs)), bench(spark, items)).collect()
    want = plain(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) >= 45
    texts = dict(docs)
    for r in got:
        held = D.words_of(texts[r.doc_id])[r.start_word : r.end_word]
        assert len(held) >= r.words and 0.5 <= r.score <= 1


def test_a_passage_in_most_documents_is_found_in_all(spark):
    rng = np.random.default_rng(2)
    item = " ".join(words(rng, 30))
    docs = [(i, " ".join(words(rng, 20)) + " " + item) for i in range(120)] + [(500, " ".join(words(rng, 50)))]
    got = D.contaminated(documents(spark, docs), bench(spark, [(1, item)])).collect()
    assert {r.doc_id for r in got} == set(range(120))


def test_groups_of_texts_change_nothing(spark, monkeypatch):
    docs, items = case(np.random.default_rng(6))
    one = D.contaminated(documents(spark, docs), bench(spark, items)).collect()
    block = D.Block.of(items)
    cache = D._Ids(block.vocabulary)
    alone = [(i, leak["item_id"], leak["score"]) for i, t in docs for leak in block.find(*block.ids([t], cache))[0]]
    assert sorted(alone) == sorted((r.doc_id, r.item_id, r.score) for r in one)


def test_benchmark_in_several_blocks(spark, monkeypatch):
    docs, items = case(np.random.default_rng(5))
    one = {(r.doc_id, r.item_id) for r in D.contaminated(documents(spark, docs), bench(spark, items)).collect()}
    monkeypatch.setattr(D, "MAX_BLOCK_BYTES", 900)
    several = {(r.doc_id, r.item_id) for r in D.contaminated(documents(spark, docs), bench(spark, items)).collect()}
    assert one == several


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    long = words(rng, 700)
    docs = [(1, None), (2, ""), (3, " ".join(long[250:450])), (3, " ".join(long[250:450])), (None, " ".join(long[:220])), (5, "w1 w2 w3")]
    items = [(7, " ".join(long)), (7, " ".join(long)), (None, None), (8, ""), (9, "w1 w2 w3")]
    df = clashing(documents(spark, docs))
    got = sorted(str((r.doc_id, r.item_id)) for r in D.contaminated(df, bench(spark, items)).collect())
    assert got == ["(3, 7)", "(3, 7)", "(5, 9)", "(None, 7)"]
    kept = D.keep_uncontaminated(df, bench(spark, items))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert D.contaminated(df, bench(spark, [])).collect() == []
    assert D.contaminated(documents(spark, []), bench(spark, items)).collect() == []


def test_copies_with_every_few_words_changed(spark):
    rng = np.random.default_rng(3)
    items, docs = [], []
    for k, n in enumerate((4, 5, 6)):
        for beside in (False, True):
            i = 2 * k + beside
            text = [f"i{i}w{j}" for j in range(48)]
            items.append((i, " ".join(text)))
            edited = ["changed" if j % n == n - 1 else w for j, w in enumerate(text)]
            docs.append((i, " ".join(words(rng, 30) + edited + words(rng, 30))))
            if beside:
                docs.append((100 + i, " ".join(words(rng, 30) + text)))
    got = D.contaminated(documents(spark, docs), bench(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain(docs, items) == {(d, d % 100) for d, _ in docs}


def leaks_of(items, texts):
    """The item ids that each text holds."""
    block = D.Block.of(items)
    found = block.find(*block.ids(texts, D._Ids(block.vocabulary)))
    return [[leak["item_id"] for leak in own] for own in found]


def test_passages_of_long_items():
    rng = np.random.default_rng(4)
    long = {n: [f"l{n}w{j}" for j in range(n)] for n in (59, 200, 390)}
    items = [(n, " ".join(text)) for n, text in long.items()]
    edited = [w if j != 12 else "changed" for j, w in enumerate(long[59][20:45])]
    passages = [long[59][20:45], long[200][60:150], long[200][:13], long[390][185:205], edited]
    texts = [" ".join(words(rng, 40) + p + words(rng, 40)) for p in passages]
    assert leaks_of(items, texts) == [[59], [200], [200], [390], [59]]
    # Fewer words, and scattered ones, are no passage.
    assert leaks_of(items, [" ".join(long[200][:12]), " ".join(long[200][j] for j in range(200) if j % 8 < 3)]) == [[], []]


def test_short_items_and_texts_without_spaces():
    line = "月が昇り静かな湖の上を白い鳥が渡って行った。"
    other = "海辺の町では朝から市が立ち人々が集まる"
    items = [(1, "who wrote the old song?"), (2, line), (3, "天空为什么是蓝色"), (4, "名前は何")]
    texts = [
        "So: who wrote, the old song and why", "who wrote the new old song", "前文" + line[:10] + line[11:] + other,
        "问题:天空为什么是蓝色的", "君の名前は何ですか", other, "名前は彼何",
    ]
    assert leaks_of(items, texts) == [[1], [], [2], [3], [4], [], []]


def test_items_of_one_to_three_words():
    items = [(1, "Ja"), (2, "so so"), (3, "so so"), (4, "one two three"), (None, "ja!"), (5, "?"), (1, "quite other")]
    texts = ["one two, three", "so, so so what", "Ja so", None, "two three one", "so quite other ja", "one jax", "?"]
    assert leaks_of(items, texts) == [[4], [2, 3], [1, None], [], [], [1, None], [], []]
    block = D.Block.of(items)
    leak = block.find(*block.ids(["a b", "c so so"], D._Ids(block.vocabulary)))[1][0]
    assert (leak["item_id"], leak["start_word"], leak["end_word"], leak["score"]) == (2, 1, 3, 1.0)


def test_a_phrase_that_thousands_of_items_share():
    rng = np.random.default_rng(7)
    stem = ["what", "is", "the"]
    many = [(i, " ".join([*stem, *(f"i{i}w{j}" for j in range(15))])) for i in range(3000)]
    text = [w for _ in range(1000) for w in [*stem, *words(rng, 14)]]
    text[9000:9000] = many[17][1].split()
    text[3000:3000] = [w if j % 5 else "x" for j, w in enumerate(many[2999][1].split())]
    start = time.process_time()
    assert leaks_of(many, [" ".join(text)]) == [[17, 2999]]
    assert time.process_time() - start < 10
    # Items of common words: no part can be left out by its words alone.
    close = [(i, " ".join([*stem, *words(rng, 15)])) for i in range(300)]
    text[5000:5000] = close[123][1].split()
    start = time.process_time()
    assert 123 in leaks_of(close, [" ".join(text)])[0]
    assert time.process_time() - start < 20


def test_seeds_laid_out_in_runs_change_nothing(monkeypatch):
    docs, items = case(np.random.default_rng(11))
    whole = leaks_of(items, [t for _, t in docs])
    monkeypatch.setattr(D, "EXPANSION", 3)
    assert leaks_of(items, [t for _, t in docs]) == whole


def test_a_long_text_of_one_item_over_and_over():
    item = [f"i{j}" for j in range(150)]
    start = time.process_time()
    block = D.Block.of([(1, " ".join(item))])
    (leak,) = block.find(*block.ids([" ".join(item * 400)], D._Ids(block.vocabulary)))[0]
    assert (leak["score"], leak["words"], leak["end_word"] - leak["start_word"]) == (1.0, 150, 150)
    assert time.process_time() - start < 20
