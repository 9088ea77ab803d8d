"""Token counts by a compiled finite-state tokenizer.

A byte-pair model with ranked merges is compiled to a deterministic transducer over
characters. What decides how a prefix of a text is tokenised is bounded: the longest
suffix that can still grow into a piece, and for each place in it the last token of the
prefix that ends there. That is a state. Reading a character, exactly one piece that
ends there fits the token before it (two tokens stand side by side if merging their
text gives the two again), which names the new last token; the transition is annotated
with the change in the number of tokens (it is negative where a merge reaches back).
Summed along a text, the annotations give the count that the library gives.

States are compiled as texts need them (as lazy automata of regular expressions are)
and dropped when the table outgrows its bound, so memory is bounded by parameters.

A text is cut into chunks. The state map of a chunk is what it does to an entry state:
from the first place that no piece spans on, it is constant (one exit state, one
count). A chunk without such a place has a map over the few states that may enter it:
those that reading the characters before it from each of several places leads to, and
what the maps before it lead to. Maps compose associatively; a prefix scan composes
them by doubling, in as many rounds as the logarithm of the longest run of such chunks,
and gives each chunk its entry state. Where a state enters that a map does not have,
the maps are widened and scanned again, so guesses never touch the result. Within a
round all chunks step together as vectors.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import per_row

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MAX_TOKENS = 4096
CHUNK = 256
# Characters worked on at a time; states and remembered pairs before they are dropped.
BATCH_CHARS = 1 << 21
MAX_STATES = 300_000
# Entry states of a chunk's map before only those that are sure to enter are added.
MAX_ENTRIES = 64
# A transition holds the next state above the annotation, which is kept off zero.
SHIFT, BIAS = 8, 128
# A transition's key is the state above the class; keys are spread by a multiplication.
KEY_SHIFT, SPREAD = 16, np.uint64(0x9E3779B97F4A7C15)

State = tuple[str, tuple, tuple]
#: No suffix, nothing before it: the state at the start of a text.
START: State = ("", (None,), (0,))


class Transducer:
    """The lazily compiled automaton of a table of pieces and scores."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.prefixes = {p[:i] for p in scores for i in range(len(p))}
        self.touching = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}
        self.alphabet = {c for p in scores for c in p}
        self.fits_known: dict[tuple[str, str], bool] = {}
        # Classes 1 to 4: characters of no piece, by their bytes. Others as they come.
        self.chars: list[str | None] = [None] * 5
        self.class_of = np.zeros(0x110000, np.uint16)
        self.spans = np.zeros((64, 64), bool)
        self.reset()

    def reset(self) -> None:
        self.fits_known.clear()
        self.states: list[State] = [START]
        self.number: dict[State, int] = {START: 0}
        self._table(12)
        self.transitions = 0

    def _table(self, bits: int) -> None:
        """An empty hash table of transitions (open addressing, at most half full)."""
        self.bits = bits
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int64)

    # -- compilation ---------------------------------------------------------------------
    def merged(self, text: str) -> list[str]:
        """The model's own rule: merge the best-scored pair, the leftmost of equals."""
        symbols = list(text)
        while True:
            best, at = -np.inf, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1], -np.inf)
                if score > best:
                    best, at = score, i
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, left: str | None, right: str) -> bool:
        if left is None:
            return True
        key = (left, right)
        if key not in self.fits_known:
            if len(self.fits_known) >= MAX_STATES:
                self.fits_known.clear()
            self.fits_known[key] = self.merged(left + right) == [left, right]
        return self.fits_known[key]

    def cost(self, token: str) -> int:
        """Tokens that a symbol stands for: itself, or its bytes if it is no piece."""
        return 1 if token in self.scores else len(token.encode())

    def step(self, state: State, char: str | None, size: int) -> tuple[State, int]:
        if char is None:  # of no piece: its bytes, and nothing spans it
            return START, size
        suffix, tokens, counts = state
        grown = suffix + char
        if suffix and suffix[-1] + char not in self.touching:
            grown, tokens, counts = char, (None,), (counts[0],)
        for size in range(len(grown), 0, -1):
            token = grown[-size:]
            if (size == 1 or token in self.scores) and self.fits(tokens[size - 1], token):
                break
        else:
            raise AssertionError("no token ends here")
        change = counts[size - 1] + self.cost(token)
        # Places where a piece to come may start; what ends at others is forgotten.
        open_ = [n == 0 or grown[len(grown) - n :] in self.prefixes for n in range(len(grown) + 1)]
        kept = max(n for n, x in enumerate(open_) if x)
        return (
            grown[len(grown) - kept :],
            (token, *[t if x else None for t, x in zip(tokens[:kept], open_[1:])]),
            (0, *[c - change if x else 0 for c, x in zip(counts[:kept], open_[1:])]),
        ), change

    # -- tables --------------------------------------------------------------------------
    def classes(self, points: np.ndarray) -> np.ndarray:
        """Class of each code point; characters not met before get one."""
        found = self.class_of[points]
        if (found == 0).any():
            for point in np.unique(points[found == 0]).tolist():
                char = chr(point)
                if char in self.alphabet:
                    self.class_of[point] = len(self.chars)
                    self._add(char)
                else:
                    self.class_of[point] = 1 if point < 0x80 else 2 if point < 0x800 else 3 if point < 0x10000 else 4
            found = self.class_of[points]
        return found

    def _add(self, char: str) -> None:
        k = len(self.chars)
        self.chars.append(char)
        if k >= len(self.spans):
            self.spans = np.pad(self.spans, ((0, k), (0, k)))
        for i, other in enumerate(self.chars):
            if other is not None:
                self.spans[i, k] = other + char in self.touching
                self.spans[k, i] = char + other in self.touching

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _store(self, keys: list[int], values: list[int]) -> None:
        if 2 * (self.transitions + len(keys)) > len(self.keys):
            old = self.keys >= 0
            before = (self.keys[old].tolist(), self.values[old].tolist())
            self._table(max(self.bits + 1, (2 * (self.transitions + len(keys))).bit_length()))
            self.transitions = 0
            self._store(*before)
        last = len(self.keys) - 1
        for at, key, value in zip(self._slots(np.array(keys, np.int64)).tolist(), keys, values):
            while self.keys[at] >= 0:
                at = (at + 1) & last
            self.keys[at], self.values[at] = key, value
        self.transitions += len(keys)

    def _compile(self, keys: np.ndarray) -> None:
        """Add the missing transitions."""
        new, values = np.unique(keys).tolist(), []
        for key in new:
            s, k = divmod(key, 1 << KEY_SHIFT)
            target, change = self.step(self.states[s], self.chars[k], k)
            n = self.number.setdefault(target, len(self.states))
            if n == len(self.states):
                self.states.append(target)
            values.append((n << SHIFT) + change + BIAS)
        self._store(new, values)

    def follow(self, keys: np.ndarray) -> np.ndarray:
        """The transitions of these keys; those not met before are compiled."""
        at = self._slots(keys)
        found = self.keys[at]
        out = self.values[at]
        left = np.nonzero(found != keys)[0]
        at = at[left]
        while len(left):
            empty = self.keys[at] < 0
            if empty.any():
                self._compile(keys[left[empty]])
                out[left] = self.follow(keys[left])
                break
            at = (at + 1) & (len(self.keys) - 1)
            hit = self.keys[at] == keys[left]
            out[left[hit]] = self.values[at[hit]]
            left, at = left[~hit], at[~hit]
        return out

    def run(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exit state, count) of each piece of ``text`` (classes) from its entry state, all in step."""
        order = np.argsort(starts - ends, kind="stable")
        at, size, now = starts[order], (ends - starts)[order], states[order].astype(np.int64)
        count = np.zeros(len(at), np.int64)
        active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for j, n in enumerate(active.tolist()):
            got = self.follow((now[:n] << KEY_SHIFT) + text[at[:n] + j])
            count[:n] += (got & ((1 << SHIFT) - 1)) - BIAS
            now[:n] = got >> SHIFT
        out_state, out_count = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        out_state[order], out_count[order] = now, count
        return out_state, out_count

    def entry_guesses(self, text: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``begins``, state) of states that may enter there: those that the
        characters before lead to when a token begins at any of the places in reach."""
        reach = max(map(len, self.scores), default=1)
        starts = (begins[:, None] - reach - np.arange(reach)).clip(0).ravel()
        rows = np.repeat(np.arange(len(begins)), reach)
        return rows, self.run(text, starts, begins[rows], np.zeros(len(rows), np.int64))[0]

    def scan(
        self, text: np.ndarray, begins: np.ndarray, ends: np.ndarray, through: np.ndarray, exits: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(exit state, count) of the chunks ``through``, none of which has a constant map.
        ``exits`` holds the exit states of the chunks before their runs."""
        n = len(through)
        heads = np.concatenate([[True], np.diff(through) > 1])  # a run's first chunk
        first = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
        known = exits[through[heads] - 1]
        rows, states = self.entry_guesses(text, begins[through])
        rows, states = rows[~heads[rows]], states[~heads[rows]]  # what enters a run's head is known
        entry = np.unique(np.concatenate([rows, np.nonzero(heads)[0]]) << 32 | np.concatenate([states, known]))
        out, size = self._maps(text, begins, ends, through, entry)
        while True:
            row = entry >> 32
            place = np.arange(len(entry)) - np.searchsorted(row, row)  # of an entry in its chunk's map
            width = int(place.max()) + 1
            # Where each entry's exit stands in the next chunk's map; ``width`` where it doesn't.
            wanted = (row + 1) << 32 | out
            at = np.minimum(np.searchsorted(entry, wanted), len(entry) - 1)
            maps = np.full((n, width + 1), width)
            maps[row, place] = np.where(entry[at] == wanted, place[at], width)
            # Compose: after the round of d, a map holds its chunk and up to 2d - 1 before it.
            composed, d, longest = maps.copy(), 1, int((np.arange(n) - first).max()) + 1
            while d < longest:
                late = np.nonzero(np.arange(n) - first >= d)[0]
                composed[late] = composed[late[:, None], composed[late - d]]
                d *= 2
            start = np.searchsorted(row, first)  # a run's one known entry is the only one of its head
            entered = np.zeros(n, np.int64)
            inner = np.nonzero(~heads)[0]
            entered[inner] = composed[inner - 1, place[start[inner]]]
            lost = np.nonzero(entered == width)[0]
            own = np.searchsorted(row, np.arange(n)) + np.where(entered == width, 0, entered)
            if not len(lost):
                return out[own], size[own]
            # Widen: the state that enters a run's first lost chunk, and what the maps before lead to.
            broken = lost[np.unique(first[lost], return_index=True)[1]]
            more = [broken << 32 | out[own[broken - 1]]]
            if width < MAX_ENTRIES:
                is_lost = np.zeros(n + 1, bool)
                is_lost[lost] = True
                more.append(wanted[is_lost[row + 1]])
            new = np.setdiff1d(np.concatenate(more), entry)
            new_out, new_size = self._maps(text, begins, ends, through, new)
            both = np.concatenate([entry, new])
            order = np.argsort(both, kind="stable")
            entry, out, size = both[order], np.concatenate([out, new_out])[order], np.concatenate([size, new_size])[order]

    def _maps(
        self, text: np.ndarray, begins: np.ndarray, ends: np.ndarray, through: np.ndarray, entry: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(exit state, count) of entries (place in ``through`` above the state)."""
        chunk = through[entry >> 32]
        return self.run(text, begins[chunk], ends[chunk], entry & 0xFFFFFFFF)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. A text begins with a space mark, spaces are space marks."""
        if len(self.states) > MAX_STATES:
            self.reset()
        used = [i for i, t in enumerate(texts) if t]
        if not used:
            return [0] * len(texts)
        raw = SPACE + SPACE.join(texts[i] for i in used)
        points = np.frombuffer(raw.encode("utf-32-le"), np.uint32)
        points = np.where(points == 0x20, ord(SPACE), points)
        text = self.classes(points).astype(np.int64)
        size = np.array([len(texts[i]) + 1 for i in used])
        first = np.cumsum(size) - size
        # Places where a chunk's map becomes constant: nothing spans the one before it.
        free = np.concatenate([[True], ~self.spans[text[:-1], text[1:]]])
        free[first] = True
        places = np.nonzero(free)[0]
        begins = np.unique(np.concatenate([first, np.arange(0, len(text), CHUNK)]))
        ends = np.append(begins[1:], len(text))
        fixed = np.append(places, len(text))[np.searchsorted(places, begins)]  # the first free place of each chunk
        constant = fixed < ends
        exits, counts = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
        exits[constant], counts[constant] = self.run(
            text, fixed[constant], ends[constant], np.zeros(int(constant.sum()), np.int64)
        )
        through = np.nonzero(~constant)[0]
        if len(through):
            exits[through], counts[through] = self.scan(text, begins, ends, through, exits)
        heads = np.nonzero(constant & (fixed > begins))[0]
        counts[heads] += self.run(text, begins[heads], fixed[heads], exits[heads - 1])[1]
        sums = np.add.reduceat(counts, np.searchsorted(begins, first))
        out = [0] * len(texts)
        for i, n in zip(used, sums.tolist()):
            out[i] = n
        return out


@lru_cache(maxsize=2)
def compiled(path: str) -> Transducer:
    """The transducer of a sentencepiece byte-pair model with byte fallback, one for each
    worker. Models that normalise texts beyond marking spaces, or with pieces given by
    the user, are refused: their rules are not those compiled here."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "  Äﬁ x\t"
    if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("the model normalises texts; only space marks are compiled")
    special = [i for i in range(sp.get_piece_size()) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)]
    if sum(map(sp.is_byte, special)) != 256 or any(map(sp.is_unused, range(sp.get_piece_size()))):
        raise ValueError("the model has no byte fallback, or unused pieces")
    skip = set(special)
    pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if i not in skip}
    return Transducer(pieces)


def count_tokens(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text; null counts as empty, empty has none."""
    out: list[int] = []
    part: list[str] = []
    chars = 0
    for t in texts:
        part.append(t or "")
        chars += len(t or "")
        if chars >= BATCH_CHARS:
            out += compiled(path).count(part)
            part, chars = [], 0
    return out + compiled(path).count(part)


def with_token_counts(
    docs: DataFrame, text: str = "text", model: str | None = None, max_tokens: int = MAX_TOKENS, keep_text: bool = False
) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit beside or in place of the text.

    ``model`` is the path of a sentencepiece model, by default that of ``MODEL`` among the
    public tokenizers. No begin, end or special tokens are added; strings that look like
    some are text. Null texts count as empty; rows, ids and other columns stay as they
    are (columns of the three names are replaced); no rows give no rows.
    """

    def count(c: dict[str, list]) -> dict[str, list]:
        import public_tokenizers

        n = count_tokens(c[text], model or public_tokenizers.path(MODEL))
        return {"n_tokens": n, "over_limit": [x > max_tokens for x in n]}

    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("bigint"))
    return per_row(sized, [text], count, "n_tokens bigint, over_limit boolean", keep_inputs=keep_text, slice_rows=2048)
