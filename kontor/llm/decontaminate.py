"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are compared in lower case without punctuation; in scripts without spaces between
words each character is one. Items are cut into parts of at most ``PART_WORDS`` words.
Items of fewer than ``MIN_WORDS`` words are leaks only as whole word sequences. Every
n-gram of a part is a seed, however common: an edited copy may hold no rare one, but an
unedited run of ``NGRAM`` words always holds one. What common seeds cost is bounded: where
a text's seeds are many, parts of whose words it holds too few are left out at once, the
others are worked off ``EXPANSION`` seeds at a time. Where the words around the hits could
reach the score (an upper bound, so nothing is lost), the document is aligned with the
part; a local alignment that reaches ``MIN_SCORE`` of the part's full score is a leak. So
is a passage of an item, however long the item: ``PASSAGE_WORDS`` words in a row (twice as
many characters without spaces), or longer runs with ``PASSAGE_EDIT`` more words for each
edit. Items of several parts also have parts across their cuts, so a passage of up to half
a part lies whole in one.

The benchmark is measured and worked off in blocks of at most ``MAX_BLOCK_BYTES`` of
text, so what is sent to the executors is bounded at any size. Documents stay where
they are and are read once a block: no document text is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import fresh, per_row, settle

NGRAM = 3
PART_WORDS = 200
MIN_WORDS = 8
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, 1
PASSAGE_WORDS = 13
PASSAGE_EDIT = 3
SLACK = 0.25
MAX_BLOCK_BYTES = 16 << 20
CACHE_WORDS = 100_000
# Seeds of a text laid out at a time.
EXPANSION = 1 << 18
# Texts worked on at a time.
GROUP_ROWS = 512
GROUP_CHARS = 1 << 20

_PUNCTUATION = re.compile(r"\W+")
# Thai, Lao, Tibetan, Burmese, Khmer, kana, Bopomofo, Han.
_UNSPACED = re.compile(
    "([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])"
)

LEAKS = (
    "array<struct<item_id: bigint, score: double, words: int, start_word: int, end_word: int>>"
)


def _raw_words(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (text if text.isascii() else _UNSPACED.sub(r" \1 ", text)).split()


def words_of(text: str | None) -> list[str]:
    """The words compared: cut at white space and around characters of scripts without it,
    lower case, without punctuation; words of punctuation alone don't count."""
    return [w for w in (_PUNCTUATION.sub("", x) for x in _raw_words(text)) if w]


def parts_of(words: list[str]) -> list[list[str]]:
    """Equal parts of at most ``PART_WORDS`` words, then those from middle to middle of
    neighbours."""
    if not words:
        return []
    n = -(-len(words) // PART_WORDS)
    cuts = [len(words) * i // n for i in range(n + 1)]
    middles = [(a + b) // 2 for a, b in zip(cuts, cuts[1:])]
    return [words[a:b] for ends in (cuts, middles) for a, b in zip(ends, ends[1:])]


class _Ids(dict):
    """Raw word -> id in the benchmark's vocabulary, -1 for other words, -2 for mere
    punctuation, -3 for the empty word (which ends a text here); remembers what it has
    normalised, up to ``CACHE_WORDS`` words."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, raw: str) -> int:
        word = _PUNCTUATION.sub("", raw)
        found = self.vocabulary.get(word, -1) if word else -2 if raw else -3
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[raw] = found
        return found


@dataclass
class Block:
    """A block of the benchmark: parts as word ids, n-gram codes in order, seeds."""

    vocabulary: dict[str, int]
    items: list[int | None]
    parts: list[np.ndarray]
    passages: list[int]
    # Items below NGRAM words, by length: the codes of their words in order, the items of each.
    short: dict[int, tuple[np.ndarray, list[list[int | None]]]]

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]]) -> Block:
        block = Block({}, [], [], [], {})
        short: list[tuple[int | None, np.ndarray]] = []
        for item, text in sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
            for part in parts_of(words_of(text)):
                ids = np.array([block.vocabulary.setdefault(w, len(block.vocabulary)) for w in part], np.int64)
                if len(ids) < NGRAM:
                    short.append((item, ids))
                    continue
                single = sum(_UNSPACED.fullmatch(w) is not None for w in part)
                block.items.append(item)
                block.passages.append(PASSAGE_WORDS * (2 if 2 * single > len(part) else 1))
                block.parts.append(ids)
        for n in range(1, NGRAM):
            own: dict[int, list[int | None]] = {}
            for item, ids in short:
                if len(ids) == n:
                    own.setdefault(int(block.grams(ids, n)[0]), []).append(item)
            if own:
                block.short[n] = np.array(sorted(own)), [own[c] for c in sorted(own)]
        block.lay_seeds()
        return block

    def lay_seeds(self) -> None:
        """The n-grams' codes in order, and of n-gram c the seeds [starts[c], starts[c + 1]):
        part and place in it, by part."""
        none = [np.zeros(0, np.int64)]
        self.lengths = np.array([len(p) for p in self.parts], np.int64)
        sizes = self.lengths - NGRAM + 1
        self.words = np.concatenate([*none, *self.parts])
        self.codes, index = np.unique(np.concatenate([*none, *map(self.grams, self.parts)]), return_inverse=True)
        part = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(part)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = np.argsort(index, kind="stable")
        self.starts = np.searchsorted(index[order], np.arange(len(self.codes) + 1))
        self.seed_part, self.seed_place = part[order], place[order]
        self.seed_key = index[order] * len(self.parts) + self.seed_part
        # Matching words that a leak of the part has at least.
        full = [len(p) / 2 if len(p) >= MIN_WORDS else len(p) for p in self.parts]
        self.needed = np.minimum(full, self.passages) if full else np.zeros(0)

    def grams(self, ids: np.ndarray, size: int = NGRAM) -> np.ndarray:
        """The code of the n-gram at each place; -1 where a word is not in the vocabulary."""
        n = len(ids) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        code, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(size):
            at = ids[k : k + n]
            code, known = code * max(1, len(self.vocabulary)) + at, known & (at >= 0)
        return np.where(known, code, -1)

    def ids(self, texts: list[str | None], cache: _Ids) -> tuple[np.ndarray, np.ndarray]:
        """(word ids of the texts one after another, each ended by -3; places of the ends)."""
        raw: list[str] = []
        for text in texts:
            raw += _raw_words(text)
            raw.append("")
        ids = np.fromiter(map(cache.__getitem__, raw), np.int64, len(raw))
        ids = ids[ids != -2]
        return ids, np.nonzero(ids == -3)[0]

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, indices into ``codes``) of the benchmark's n-grams in a text."""
        return _found(self.codes, self.grams(ids))

    def find(self, ids: np.ndarray, ends: np.ndarray) -> list[list[dict]]:
        """The leaks of each text: the best of each item, by item."""
        best: list[dict[int | None, dict]] = [{} for _ in ends]
        for n, (codes, items) in self.short.items():
            places, index = _found(codes, self.grams(ids, n))
            text = np.searchsorted(ends, places)
            _, first = np.unique(text * len(codes) + index, return_index=True)
            for t, at, code in zip(text[first].tolist(), places[first].tolist(), index[first].tolist()):
                start = at - (int(ends[t - 1]) + 1 if t else 0)
                for item in items[code]:
                    best[t][item] = _leak(item, 1.0, n, start, start + n)
        places, index = self.hits(ids)
        text = np.searchsorted(ends, places)
        cuts = np.nonzero(np.diff(text))[0] + 1
        for at, grams in zip(np.split(places, cuts), np.split(index, cuts)):
            if len(at):
                t = int(np.searchsorted(ends, at[0]))
                start = int(ends[t - 1]) + 1 if t else 0
                self.align_all(ids[start : ends[t]], at - start, grams, best[t])
        return [[own[i] for i in sorted(own, key=lambda i: (i is None, i or 0))] for own in best]

    def seeds(self, ids: np.ndarray, places: np.ndarray, grams: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(part, place in it, place in the text) of the seeds for n-grams at places of a text,
        in runs of parts: about ``EXPANSION`` at a time, more only where one part has more."""
        live = None
        if (self.starts[grams + 1] - self.starts[grams]).sum() > len(self.words):
            held = np.zeros(len(self.vocabulary), bool)
            held[ids[ids >= 0]] = True
            live = np.add.reduceat(held[self.words], np.cumsum(self.lengths) - self.lengths, dtype=np.int64) >= self.needed
        n = len(self.parts)
        ranges = [(0, n)]
        while ranges:
            a, b = ranges.pop()
            low, high = (np.searchsorted(self.seed_key, grams * n + p) for p in (a, b))
            many = high - low
            total = int(many.sum())
            if total > EXPANSION and b - a > 1:
                ranges += [((a + b) // 2, b), (a, (a + b) // 2)]
            elif total:
                seed = np.repeat(low - np.cumsum(many) + many, many) + np.arange(total)
                of, inside, at = self.seed_part[seed], self.seed_place[seed], np.repeat(places, many)
                yield (of, inside, at) if live is None else tuple(x[live[of]] for x in (of, inside, at))

    def windows(
        self, ids: np.ndarray, places: np.ndarray, grams: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(part, lows, highs, seeds) of the stretches of a text around the seeds at places.
        Those of a part that overlap are one; where it is long, stretches of four times the
        part that overlap by half: no leak is longer than twice the part, so each lies whole in one."""
        for part, inside, at in self.seeds(ids, places, grams):
            order = np.lexsort((at - inside, part))
            part, at, begin = part[order], at[order], (at - inside)[order]
            length = self.lengths[part]
            slack = (length * SLACK).astype(np.int64) + 2
            low, high = np.maximum(0, begin - slack), np.minimum(len(ids), begin + length + slack)
            for of in np.split(np.arange(len(part)), np.nonzero(np.diff(part))[0] + 1):
                if not len(of):
                    continue
                p, step = int(part[of[0]]), 2 * int(length[of[0]])
                first = np.r_[True, low[of[1:]] > high[of[:-1]]]
                lows, highs = low[of[first]], high[of[np.r_[first[1:], True]]]
                cuts = np.maximum(1, -(-(highs - lows) // step) - 1)
                lows = np.repeat(lows - step * (np.cumsum(cuts) - cuts), cuts) + step * np.arange(cuts.sum())
                highs = np.minimum(np.repeat(highs, cuts), lows + 2 * step)
                own = np.sort(at[of])
                yield p, lows, highs, np.searchsorted(own, highs - NGRAM, "right") - np.searchsorted(own, lows)

    def align_all(
        self, ids: np.ndarray, places: np.ndarray, grams: np.ndarray, best: dict[int | None, dict]
    ) -> None:
        """Put the alignments that are leaks of a text with n-grams at places into ``best``."""
        for p, lows, highs, seeds in self.windows(ids, places, grams):
            part, passage, item = self.parts[p], self.passages[p], self.items[p]
            near = np.nonzero(seeds)[0]
            if len(near) * 1000 > len(ids):  # as ``reachable``, for all stretches at once
                held = np.cumsum(np.r_[0, np.isin(ids, part)])
                near = near[held[highs[near]] - held[lows[near]] >= self.needed[p]]
            if len(near) > len(part):  # a word matches no more often than the part holds it
                most = np.zeros(len(near), np.int64)
                for word, count in zip(*np.unique(part, return_counts=True)):
                    own = np.nonzero(ids == word)[0]
                    most += np.minimum(count, np.searchsorted(own, highs[near]) - np.searchsorted(own, lows[near]))
                near = near[most >= self.needed[p]]
            lows, highs, seeds = lows[near], highs[near], seeds[near]
            for low, high, count in zip(lows.tolist(), highs.tolist(), seeds.tolist()):
                found = leak_of(part, ids[low:high], count, passage)
                old = best.get(item)
                if found and (old is None or found[0] > old["score"]):
                    score, matched, start, end = found
                    best[item] = _leak(item, score, matched, low + start, low + end)


def _found(codes: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, indices into ``codes``, which are in order) of the grams that are codes."""
    places = np.nonzero(grams >= 0)[0] if len(codes) else np.zeros(0, np.int64)
    index = np.minimum(np.searchsorted(codes, grams[places]), len(codes) - 1)
    real = codes[index] == grams[places]
    return places[real], index[real]


def _leak(item: int | None, score: float, matched: int, start: int, end: int) -> dict:
    return {"item_id": item, "score": score, "words": matched, "start_word": start, "end_word": end}


def reachable(part: np.ndarray, text: np.ndarray, least: float) -> bool:
    """Whether an alignment can reach a score of at least ``MIN_SCORE`` of the full: it spans at most twice the part's
    words, as more gaps than matches beyond half the part cost too much."""
    held = np.cumsum(np.r_[0, np.isin(text, part)])
    span = min(len(text), 2 * len(part))
    return MATCH * (held[span:] - held[: len(held) - span]).max() >= least


def leak_of(
    part: np.ndarray, text: np.ndarray, seeds: int, passage: int = PASSAGE_WORDS
) -> tuple[float, int, int, int] | None:
    """(share of the part's full score, matched words, start, end) of the leak in a text
    that holds so many seeds of the part: the whole part, edited or not (as it is below
    ``MIN_WORDS``), else a passage of at least so many words."""
    full = MATCH * len(part)
    least = full * (MIN_SCORE if len(part) >= MIN_WORDS else 1)
    if reachable(part, text, least):
        score, matched, start, end = align(part, text)
        if score >= least and matched >= min(MIN_WORDS, len(part)):
            return score / full, matched, start, end
    # A passage has PASSAGE_EDIT words more for each edit, which parts it into one run more.
    if seeds >= passage - NGRAM + 1:
        score, matched, start, end = align(part, text, 1, -PASSAGE_EDIT, PASSAGE_EDIT)
        if score >= passage:
            edits = (matched - score) / PASSAGE_EDIT
            return (MATCH * matched - GAP * edits) / full, matched, start, end
    return None


def align(
    part: np.ndarray, text: np.ndarray, match: int = MATCH, mismatch: int = MISMATCH, gap: int = GAP
) -> tuple[float, int, int, int]:
    """Smith-Waterman with linear gaps: (score, matched words, start, end) of the best
    local alignment in ``text``. A row is one vector step: the gaps along it are a
    running maximum."""
    n, m = len(part), len(text)
    slope = gap * np.arange(m + 1)
    h = np.zeros((n + 1, m + 1), np.int32)
    for i in range(1, n + 1):
        row = np.zeros(m + 1, np.int32)
        pair = np.where(text == part[i - 1], match, mismatch)
        row[1:] = np.maximum(0, np.maximum(h[i - 1, :-1] + pair, h[i - 1, 1:] - gap))
        h[i] = np.maximum.accumulate(row + slope) - slope
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    score, end, matched = int(h[i, j]), int(j), 0
    while i and j and h[i, j] > 0:
        same = part[i - 1] == text[j - 1]
        if h[i, j] == h[i - 1, j - 1] + (match if same else mismatch):
            matched += bool(same)
            i, j = i - 1, j - 1
        elif h[i, j] == h[i - 1, j] - gap:
            i -= 1
        else:
            j -= 1
    return float(score), matched, int(j), end


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in groups of about ``GROUP_CHARS``."""
    group, chars = [], 0
    for t in texts:
        group.append(t)
        chars += len(t or "")
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks of about ``MAX_BLOCK_BYTES`` of text, dealt by hash of the text."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = -(-size // MAX_BLOCK_BYTES)
    if count > 1:
        rows = settle(rows)
    for i in range(count):
        own = rows.where(F.pmod(F.xxhash64("text"), F.lit(count)) == i) if count > 1 else rows
        block = Block.of([(r["item_id"], r["text"]) for r in own.collect()])
        if block.parts or block.short:
            yield block


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "leaks", keep_text: bool = False
) -> DataFrame:
    """``docs`` with the array ``name`` of the items that each text holds: item_id, score
    (share of the full alignment score), matching words, first and past-the-last word.

    Null and empty texts and items match nothing; an item of one or few words is held
    wherever they stand in a row (keep such items out of ``benchmark`` where they are mere answers); a repeated item counts once, several texts of one item_id are one item with the best
    score. Without benchmark all arrays are empty; without documents there are no rows.
    """
    out = docs
    columns = []
    for i, block in enumerate(_blocks(benchmark)):
        held = docs.sparkSession.sparkContext.broadcast(block)
        own = fresh(out, f"{name}_{i}")
        out = per_row(out, [text], _finder(held, text, own), f"`{own}` {LEAKS}", keep_inputs=True)
        columns.append(F.col(f"`{own}`"))
    found = F.concat(*columns) if columns else F.array().cast(LEAKS)
    kept = [c for c in docs.columns if c != name and (keep_text or c != text)]
    return out.select(*[F.col(f"`{c}`") for c in kept], found.alias(name))


def _finder(held, text: str, name: str):
    def find(c: dict[str, list]) -> dict[str, list]:
        block = held.value
        cache = block.__dict__.setdefault("cache", _Ids(block.vocabulary))  # one for each worker
        return {name: [found for texts in _groups(c[text]) for found in block.find(*block.ids(texts, cache))]}

    return find


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, words, start_word, end_word): a row for each document
    (row of ``docs``) and each benchmark item whose text it holds, whole or edited."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.inline("leaks"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark, columns as they are."""
    name = fresh(docs, "leaks")
    found = with_leaks(docs, benchmark, name=name, keep_text=True)
    return found.where(F.size(name) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
