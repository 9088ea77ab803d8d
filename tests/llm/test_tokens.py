import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers_llm import clashing, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from kontor.llm import tokens

PATH = public_tokenizers.path(tokens.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


PARTS = [" ", "  ", "▁", "\n", "é", "ß", "中", "文", "日本", "😀", "\x00", "<s>", "</s>", "<0x0A>", "a", "aa", "the", "ing", "0", "--", "ﬁ", "represent", "ation"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=60))
def test_counts_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert tokens.count_tokens([text], PATH) == [len(sp.encode(text))]


def test_texts_longer_than_chunks_and_batches(library, monkeypatch):
    texts = ["a" * 3001, "-" * 2000, "中" * 1500, " " * 999, "abc" * 1500, "word " * 2000, None, "", "x"]
    want = [len(library.encode(t or "")) for t in texts]
    assert tokens.count_tokens(texts, PATH) == want
    monkeypatch.setattr(tokens, "CHUNK", 7)
    monkeypatch.setattr(tokens, "BATCH_CHARS", 500)
    assert tokens.count_tokens(texts, PATH) == want


LONG_RUNS = ["a" * 3001, " " * 2999, "-" * 2003, "ab" * 900, "x" + "a" * 700, "errstonerson" * 90, "aabaa" * 300, "word " * 50, "中" * 300, None, ""]


@pytest.mark.parametrize("chunk", [1, 3, 16, 61])
def test_composed_maps_of_long_runs(library, monkeypatch, chunk):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    assert tokens.count_tokens(LONG_RUNS, PATH) == [len(library.encode(t or "")) for t in LONG_RUNS]


@pytest.mark.parametrize("bound", [1, 64])
def test_states_that_no_guess_names_are_added(library, monkeypatch, bound):
    none = np.zeros(0, np.int64)
    monkeypatch.setattr(tokens, "CHUNK", 50)
    monkeypatch.setattr(tokens, "MAX_ENTRIES", bound)
    monkeypatch.setattr(tokens.Transducer, "entry_guesses", lambda self, text, begins: (none, none))
    assert tokens.count_tokens(LONG_RUNS, PATH) == [len(library.encode(t or "")) for t in LONG_RUNS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "ab", " ", "-", "er", "the", "0", "x "]), st.integers(1, 90)), max_size=6), st.integers(1, 9))
def test_mixed_runs_equal_the_library(runs, chunk):
    text, before = "".join(p * n for p, n in runs), tokens.CHUNK
    tokens.CHUNK = chunk
    try:
        assert tokens.count_tokens([text], PATH) == [len(sentencepiece.SentencePieceProcessor(model_file=PATH).encode(text))]
    finally:
        tokens.CHUNK = before


@pytest.mark.parametrize("unit", ["a", " ", "-"])
def test_a_run_of_one_character_is_not_worked_off_serially(library, monkeypatch, unit):
    rounds, maps = [], tokens.Transducer._maps
    monkeypatch.setattr(tokens.Transducer, "_maps", lambda self, *a: rounds.append(len(a[-1])) or maps(self, *a))
    text = unit * 400_000
    begun = time.time()
    assert tokens.count_tokens([text], PATH) == [len(library.encode(text))]
    assert time.time() - begun < 5 and len(rounds) <= 3


def test_states_are_dropped_beyond_the_bound(library, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_STATES", 50)
    automaton = tokens.Transducer(tokens.compiled(PATH).scores)
    for text in ["the quick brown fox", "jumps over the lazy dog", "some other words entirely"] * 3:
        assert automaton.count([text]) == [len(library.encode(text))]


def test_models_with_other_rules_are_refused(tmp_path):
    with pytest.raises(Exception):
        tokens.compiled(str(tmp_path / "none.model"))


def test_query_columns(spark, library):
    rows = [(1, "hello world"), (1, "hello world"), (None, "é"), (3, None), (4, ""), (5, "word " * 5000)]
    got = tokens.with_token_counts(clashing(documents(spark, rows)).select("doc_id", "text", "n_tokens")).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t in rows]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got))) == sorted(map(str, want))
    assert tokens.with_token_counts(documents(spark, [])).collect() == []
