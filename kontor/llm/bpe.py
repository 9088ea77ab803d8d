"""Byte-pair encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be
joined, whatever stands around it: between the two there is a cut for certain. A table
of 65,536 flags, made from the vocabulary, marks these pairs. A text is cut at them by
one vectorised look-up, its fragments are encoded independently, and the ids are
concatenated.

Two kinds of cuts are used:

* between fragments of a text, where the vocabulary's pre-tokenising pattern may also
  start afresh. The pattern looks ahead over white space and gives an apostrophe a
  meaning of its own, so a cut behind white space, before an apostrophe or inside a
  character is not used there (those cuts are only left out, nothing else changes);
* between the pieces of a fragment, once the pattern has been applied to it: every
  forced pair, within characters too.

Most fragments are a word with the space before it and come back again and again. Their
ids are kept in a table with a bound by parameter. A piece without forced pairs, say a
long run of one character, is merged with a heap in n log n steps.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from kontor.llm.common import per_row

MODEL = "byte_bpe_50k.json"
# Fragments remembered by a worker (twice as many for a moment), and the longest of them in bytes.
MAX_KNOWN = 300_000
MAX_KNOWN_BYTES = 64
# Bytes of a text that are cut at a time.
WINDOW = 1 << 20
# Pieces up to this length are merged by plain scans, longer ones with a heap.
SHORT = 48
ID_BITS = 24
NO_JOIN = 1 << 62

# The pre-tokenising pattern of the byte-level models read here (a fixed value of theirs).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Letters and digits newer than the character tables behind the models' pattern (Unicode 16),
# which are neither there. First and last code point of each run: fixed values.
NEWER = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""


def newer_class() -> str:
    """The characters of ``NEWER`` as a class of a pattern."""
    runs = [[f"\\U{int(x, 16):08X}" for x in run.split("-")] for run in NEWER.split()]
    return "[" + "".join("-".join(run) for run in runs) + "]"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the model's file: printable bytes stand for
    themselves, the others for U+0100 and on in their order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Codec(dict):
    """Ids of the fragments met so far, by their bytes; a fragment not met is encoded."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_rules(spec)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        tokens = {t: bytes(byte_of[c] for c in t) for t in spec["model"]["vocab"]}
        ids = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = {b: ids[t] for t, b in tokens.items()}
        self.text_of = {i: b for b, i in self.id_of.items()} | {i: s.encode() for s, i in self.specials.items()}
        # Rank above the id of the joined token, by pair.
        self.joins: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.joins.setdefault((ids[left], ids[right]), (rank << ID_BITS) | ids[left + right])
        self.first = [self.id_of[bytes([b])] for b in range(256)]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.words = regex.compile(PATTERN)
        newer = newer_class()
        self.newer = regex.compile(newer)
        # The same pattern where a newer character occurs: neither letter nor digit.
        letter, digit = rf"(?:(?!{newer})\p{{L}})", rf"(?:(?!{newer})\p{{N}})"
        other = rf"(?:{newer}|[^\s\p{{L}}\p{{N}}])"
        self.words_newer = regex.compile(
            PATTERN.replace(r"[^\s\p{L}\p{N}]", other).replace(r" ?\p{L}", " ?" + letter).replace(r" ?\p{N}", " ?" + digit)
        )
        self.forced, self.cuts, self.blanks = cut_tables(tokens.values())
        self.forced_flags = self.forced.tobytes()
        self.older: dict[bytes, tuple[int, ...]] = {}

    # -- encoding ------------------------------------------------------------------------
    def __missing__(self, fragment: bytes) -> tuple[int, ...]:
        ids = self.older.pop(fragment, None) or self._encoded(fragment)
        if len(fragment) <= MAX_KNOWN_BYTES:
            if len(self) >= MAX_KNOWN:  # the fragments in use move on, the others are forgotten
                self.older = dict(self)
                self.clear()
            self[fragment] = ids
        return ids

    def _encoded(self, fragment: bytes) -> tuple[int, ...]:
        out: list[int] = []
        text = fragment.decode()
        words = self.words if text.isascii() or not self.newer.search(text) else self.words_newer
        for word in words.findall(text):
            raw = word.encode()
            if len(raw) > SHORT:
                parts = pieces(raw, self.forced)
            else:
                at = [0, *[i for i in range(1, len(raw)) if self.forced_flags[raw[i - 1] << 8 | raw[i]]], len(raw)]
                parts = [raw[i:j] for i, j in zip(at, at[1:])]
            for piece in parts:
                out += self.merged(piece) if len(piece) > 1 else [self.first[piece[0]]]
        return tuple(out)

    def merged(self, piece: bytes) -> list[int]:
        """The model's rule: join the pair of the lowest rank, the leftmost of equals."""
        ids = [self.first[b] for b in piece]
        if len(ids) > SHORT:
            return self._merged_long(ids)
        get = self.joins.get
        best = [get(pair, NO_JOIN) for pair in zip(ids, ids[1:])]
        while best and (least := min(best)) != NO_JOIN:
            i = best.index(least)
            ids[i : i + 2] = [least & ((1 << ID_BITS) - 1)]
            del best[i]
            if i:
                best[i - 1] = get((ids[i - 1], ids[i]), NO_JOIN)
            if i < len(best):
                best[i] = get((ids[i], ids[i + 1]), NO_JOIN)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with linked places and a heap, for pieces of any length."""
        n, get = len(ids), self.joins.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(x, i, ids[i], ids[i + 1]) for i in range(n - 1) if (x := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            x, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two was joined meanwhile
            ids[i], ids[j] = x & ((1 << ID_BITS) - 1), -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (x := get((ids[a], ids[b]))):
                    heapq.heappush(heap, (x, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; null counts as empty. A special token's string in a text is that token."""
        parts = []
        at = 0
        for found in self.split.finditer(text or ""):
            parts += [self._plain(text[at : found.start()]), np.array([self.specials[found[0]]], np.int32)]
            at = found.end()
        parts.append(self._plain((text or "")[at:]))
        return np.concatenate(parts)

    def _plain(self, text: str) -> np.ndarray:
        raw = text.encode()
        out, held = [], b""
        for at in range(0, len(raw), WINDOW):
            # The last fragment of a window goes on in the next, which begins with it.
            window = held + raw[at : at + WINDOW]
            fragments = pieces(window, self.cuts, self.blanks)
            if at + WINDOW < len(raw):
                held = fragments.pop()
            out.append(np.fromiter(chain.from_iterable(map(self.__getitem__, fragments)), np.int32))
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    # -- decoding ------------------------------------------------------------------------
    def decode(self, ids: list[int] | np.ndarray | None) -> str:
        """The text of ids, special tokens as their strings; bytes that are no UTF-8 become
        U+FFFD; ids of no token say nothing; null counts as none."""
        if ids is None:
            return ""
        known = self.text_of
        return b"".join([known.get(i, b"") for i in np.asarray(ids, np.int64).tolist()]).decode(errors="replace")


def check_rules(spec: dict) -> None:
    """Refuse models with rules other than those read here."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
    odd += [k for k in ("byte_fallback", "ignore_merges") if model.get(k)]
    bound = [t["content"] for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if spec.get("normalizer") or model.get("type") != "BPE" or not plain or odd or bound:
        raise ValueError(f"no plain byte-level byte-pair model: {odd or bound or pre}")


def cut_tables(tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flags by pair: forced; forced and a place where a text may be cut, unless white space
    of several bytes ends there; the last two bytes of such white space."""
    inside = np.zeros(1 << 16, bool)
    for t in tokens:
        b = np.frombuffer(t, np.uint8).astype(np.int32)
        inside[(b[:-1] << 8) | b[1:]] = True
    forced = ~inside
    left, right = np.divmod(np.arange(1 << 16), 256)
    blank = [c.encode() for c in map(chr, range(0x3001)) if c.isspace()]
    starts = (right < 0x80) | (right >= 0xC0)
    cuts = forced & starts & (right != ord("'")) & ~np.isin(left, [c[0] for c in blank if len(c) == 1])
    blanks = np.zeros(1 << 16, bool)
    blanks[[c[-2] << 8 | c[-1] for c in blank if len(c) > 1]] = True
    return forced, cuts, blanks


def pieces(raw: bytes, table: np.ndarray, not_after: np.ndarray | None = None) -> list[bytes]:
    """``raw`` cut at the pairs that ``table`` marks, unless the pair before is in ``not_after``."""
    b = np.frombuffer(raw, np.uint8).astype(np.int32)
    pairs = (b[:-1] << 8) | b[1:]
    cut = table[pairs]
    if not_after is not None:
        cut[1:] &= ~not_after[pairs[:-1]]
    at = (np.flatnonzero(cut) + 1).tolist()
    return [raw[i:j] for i, j in zip([0, *at], [*at, len(raw)])] if raw else []


@lru_cache(maxsize=2)
def codec(path: str | None = None) -> Codec:
    """The codec of a model's file (by default ``MODEL`` of the public tokenizers), one for
    each worker."""
    import public_tokenizers

    return Codec(path or public_tokenizers.path(MODEL))


def with_ids(
    docs: DataFrame, text: str = "text", model: str | None = None, ids: str = "ids", keep_text: bool = False
) -> DataFrame:
    """``docs`` with the token ids of the whole text (array<int>) in place of or beside it.

    No begin, end or other special tokens are added; a special token's string inside a
    text is that token. Null and empty texts have no ids (an empty array); rows, ids and
    other columns stay as they are (a column of the output's name is replaced); repeated
    rows stay repeated; no rows give no rows.
    """

    def encode(c: dict[str, list]) -> dict[str, list]:
        own = codec(model)
        return {ids: [own.encode(t) for t in c[text]]}

    return per_row(docs, [text], encode, f"`{ids}` array<int>", keep_inputs=keep_text, slice_rows=256)


def with_texts(
    encoded: DataFrame, ids: str = "ids", model: str | None = None, text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """``encoded`` with the text of the ids in place of or beside them. Null ids count as
    none (an empty text); null entries and numbers of no token say nothing."""

    def decode(c: dict[str, list]) -> dict[str, list]:
        own = codec(model)
        return {text: [own.decode([i for i in x if i is not None] if isinstance(x, list) else x) for x in c[ids]]}

    return per_row(encoded, [ids], decode, f"`{text}` string", keep_inputs=keep_ids, slice_rows=256)
