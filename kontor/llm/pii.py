"""Personal data: high-recall candidates, boosted trees, calibrated thresholds.

Base spans are the strict formats (with their checks: octets, Luhn, digit counts);
they are always selected. Around them generators propose looser, overlapping
candidates: obfuscated or non-ASCII mail addresses, numbers with any separators and
the neighbouring groups of digits inside them as phones or cards, spaced or hexadecimal
addresses. Gradient boosted trees judge each
candidate by its format and its context; per kind, the lowest calibrated probability
that reaches ``PRECISION`` on held-back rows is the threshold. Of overlapping
candidates the most probable is selected; none that meets a base span.

The trees learn from the corpus itself, without labels: from a bounded sample of
documents, drawn for each kind from those that show its signs, base spans and loosened copies of them in their own context are positive,
candidates that fail their kind's check, spoiled copies and candidates that cut a
loosened copy or reach into the number beside it are negative. Without any
base span in the sample nothing is added.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm import boosting
from kontor.llm.common import fresh, per_row

KINDS = ("email", "ip", "card", "phone")
FIT_DOCS = 10_000
FIT_ROWS = 40_000
PRECISION = 0.98
MIN_HELD_BACK = 10
CONTEXT = 24
# Signs that a text may hold a base span of each kind, in the order of KINDS.
SIGNS = ("[A-Za-z0-9._%+-]@[A-Za-z0-9-]", r"[0-9](\.[0-9]+){3}", r"[0-9]([ -]?[0-9]){15}", r"\+[0-9][ ().0-9-]+[0-9]")
# Wrong cuts of one example that are learnt from.
CUTS = 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_GROUP = re.compile(r"[0-9]+")
# A digit beside a span, behind separators of numbers.
_DIGIT_BEFORE = re.compile(r"[0-9][ ().\-/+]{0,3}\Z")
_DIGIT_AFTER = re.compile(r"[ ().\-/+]{0,3}[0-9]")
# The first digit of a run starts a match if any digit of it does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT = re.compile(r"(?i)\s?(?:@|[(\[{]\s?at\s?[)\]}]|\sat(?=\s))\s?")
# A domain name has at most 127 labels.
_LOOSE_DOMAIN = re.compile(r"(?i)[a-z0-9-]+(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}]|\sdot\s)\s?[a-z0-9-]+){1,126}")
_BRACKETED_AT = re.compile(r"(?i)[(\[{]\s?at\s?[)\]}]")
_SPELLED_DOT = re.compile(r"(?i)\bdot\b")
_ANY_MAIL = re.compile(r"[^\s@<>\"'(),;:]+@[^\s@<>\"'(),;:]+")
_NUMBER = re.compile(r"(?<![0-9])[0-9][0-9 ().\-/]{5,}[0-9]")
_SPACED_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?[.]\s?[0-9]{1,3}){3}(?![0-9])")
_HEX_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")

CUES = {
    "email": ("mail", "e-mail", "email", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
}
REJECTS = ("password", "token", "key", "secret", "id", "version", "isbn", "sha", "page", "http")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    d = _digits(text)
    if kind == "card":
        return 16 <= len(d) <= 19 and luhn(d)
    return 8 <= len(d) <= 15


def _refuted(kind: str, text: str) -> bool:
    """A candidate that its kind's check rules out (mail and hexadecimal forms have none)."""
    return kind != "email" and ":" not in text and not _valid(kind, re.sub(r"\s", "", text))


def _emails(text: str) -> Iterator[Span]:
    """Every ``@`` in turn: the local characters before it, back to the last match."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield ("email", start, end)
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """The strict spans by kind, then start; leftmost non-overlapping within a kind,
    failing matches dropped without another try."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            if kind == "phone" and "+" not in text:
                continue
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _valid(kind, m[0])]
    return out


def _numbers(text: str, begin: int, end: int) -> Iterator[Span]:
    """Every run of neighbouring groups of digits that has as many as a phone or a card."""
    groups = [m.span() for m in _GROUP.finditer(text, begin, end)]
    for i, (first, _) in enumerate(groups):
        start = first - (first > 0 and text[first - 1] in "+(")
        start -= start > 0 and text[start - 1] == "+"
        n = 0
        for a, b in groups[i:]:
            n += b - a
            if n > 19:
                break
            if 7 <= n <= 15:
                yield ("phone", start, b)
            if n >= 13:
                yield ("card", first, b)


def _loose_emails(text: str) -> Iterator[Span]:
    """Every ``@``, bracketed or spaced "at" between local characters and a domain."""
    for m in _AT.finditer(text):
        start = m.start()
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        domain = _LOOSE_DOMAIN.match(text, m.end()) if start < m.start() else None
        if domain:
            yield ("email", start, domain.end())


def candidates(text: str) -> list[Span]:
    """Loose spans of every kind; they overlap each other and the base spans."""
    out: set[Span] = set()
    if "@" in text:
        out |= {("email", *m.span()) for m in _ANY_MAIL.finditer(text)}
    out.update(_loose_emails(text))
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            out.update(_numbers(text, m.start(), m.end()))
        out |= {("ip", *m.span()) for m in _SPACED_IP.finditer(text)}
        if ":" in text:
            out |= {("ip", *m.span()) for m in _HEX_IP.finditer(text)}
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate; the strict checks are features, not rules."""
    kind, a, b = span
    body, before, after = text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    digits, groups = _digits(body), re.findall(r"[0-9]+", body)
    words = re.findall(r"\w+", before.lower())
    last = body.rpartition(".")[2]
    return [
        *[float(kind == k) for k in KINDS],
        float(len(body)),
        float(len(digits)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(bool(digits) and luhn(digits)),
        float(max((min(int(g), 9999) for g in groups if len(g) < 9), default=0)),
        float(len(set(digits))),
        float(body.startswith("+")),
        float(body.count("(") - body.count(")")),
        float(body.count(" ")),
        float(body.count("-")),
        float(body.count(".")),
        float(body.count("/")),
        float(body.count(":")),
        float("@" in body),
        float(bool(re.search(r"(?i)\bat\b|[(\[{]at", body))),
        float(last.isalpha() and 2 <= len(last) <= 24),
        float(bool(before[-1:]) and (before[-1:].isalnum() or before[-1:] in "_=/#$%&\"'")),
        float(bool(after[:1]) and (after[:1].isalnum() or after[:1] in "_=/#$%&\"'")),
        float(any(c in words[-3:] for c in CUES[kind])),
        float(any(c in words[-3:] for c in REJECTS)),
        float("=" in before[-3:] or '"' in before[-3:]),
        float(bool(_DIGIT_BEFORE.search(before))),
        float(bool(_DIGIT_AFTER.match(after))),
        float(bool(_BRACKETED_AT.search(body))),
        float(bool(_SPELLED_DOT.search(body))),
        float(any(not c.isalpha() for c in re.split(r"[\s@(\[{]", body, maxsplit=1)[0])),
    ]


def _letters(mail: str) -> str:
    """A mail address without its digits, which addresses of one corpus often share."""
    return _DIGIT.sub("", mail)


def _loosened(kind: str, body: str) -> list[str]:
    """Forms of a base span that the strict patterns miss."""
    d = _digits(body)
    if kind == "email":
        local, _, domain = body.partition("@")
        spelled = domain.replace(".", " dot ")
        # Names of letters alone, at a domain of two labels.
        word, short = re.sub("[^A-Za-z]", "", local) or "x", ".".join(domain.split(".")[-2:])
        plain = [f"{w}{at}{short}" for w in (word, f"{word[:3]}.{word}") for at in ("[at]", " [at] ", " (at) ")]
        return [
            *plain,
            f"{local} (at) {spelled}", f"{local}[at]{domain}", f"{local} [at] {domain}", f"{local} (at) {domain}",
            f"{local}@ {domain}", f"{local} at {spelled}", *(_letters(f) for f in (
                f"{local}[at]{domain}", f"{local} [at] {domain}", f"{local} (at) {domain}", f"{local}@ {domain}",
                f"{local} at {spelled}")),
        ]
    if kind == "ip":
        return [body.replace(".", " . ")]
    if kind == "card":
        return [".".join(d[i : i + 4] for i in range(0, len(d), 4))]
    return [f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}"] if len(d) >= 10 else []


def _spoiled(kind: str, body: str) -> list[str]:
    """Look-alikes that are no personal data: failed checks, dates, versions, codes."""
    d = _digits(body)
    if kind == "email":
        local, _, domain = body.partition("@")
        prose = [f"look at {domain}", f"us at {_letters(domain)}", "meet at noon. Then"]
        return [body.replace("@", "@ ").replace(".", " "), "@" + local, *prose]
    if kind == "ip":
        return [re.sub(r"^[0-9]+", "999", body), re.sub(r"[0-9]+$", "0-2", body)]
    if kind == "card":
        wrong = d[:-1] + str((int(d[-1]) + 5) % 10)
        return [wrong, ".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), "0" * len(d)]
    return [f"20{d[-2:]}-0{d[-3]}-1{d[-4]}", f"{d[:2]}/{d[2:4]}/{d[4:8]}", f"{d[-8:]}", f"{d[-7:-4]}.{d[-4:]}"]


class Taken:
    """Places of a text that spans cover: disjoint intervals in order, found by bisection."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        """Whether a character of [a, b) is covered."""
        i = bisect_right(self.ends, a)
        return i < len(self.starts) and self.starts[i] < b

    def add(self, a: int, b: int) -> None:
        """Cover [a, b), which meets nothing yet."""
        i = bisect_right(self.ends, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def examples(text: str) -> list[tuple[list[float], int]]:
    """Labelled candidates of one text (see the module's head)."""
    base = base_spans(text)
    known, out, strict = set(base), [], Taken((a, b) for _, a, b in base)
    for span in candidates(text):
        if span in known:
            out.append((features(text, span), 1))
        elif not strict.meets(span[1], span[2]):
            if _refuted(span[0], text[span[1] : span[2]]):
                out.append((features(text, span), 0))
    for kind, a, b in base:
        low, high = max(0, a - CONTEXT), b + CONTEXT
        for label, forms in ((1, _loosened(kind, text[a:b])), (0, _spoiled(kind, text[a:b]))):
            for form in forms:
                made = text[low:a] + form + text[b:high]
                out.append((features(made, (kind, a - low, a - low + len(form))), label))
        if kind in ("card", "phone"):
            for form in (text[a:b], *_loosened(kind, text[a:b])):
                out += _beside(kind, text[low:a], form, base, text, text[b:high])
    return out


def _beside(kind: str, before: str, form: str, base: list[Span], text: str, after: str) -> Iterator[tuple[list[float], int]]:
    """A number alone, and before and behind another of its text or a date, with the
    candidates that cut it wrong; its digits within a code."""
    others = [text[a:b] for k, a, b in base if k != "email" and text[a:b] != form][:1]
    for left, right in (("", ""), *[x for o in (*others, "2024-05-17") for x in ((o + " ", ""), ("", " " + o))]):
        made, start = before + left + form + right + after, len(before) + len(left)
        own = (kind, start, start + len(form))
        yield features(made, own), 1
        wrong = [s for s in candidates(made) if s != own and s[1] < own[2] and own[1] < s[2]]
        # The same number of another kind's length is left to that kind.
        wrong = [s for s in wrong if _digits(made[s[1] : s[2]]) != _digits(form)]
        for s in wrong[:: -(-len(wrong) // CUTS) or 1]:
            yield features(made, s), 0
    for digits in (_digits(form), _digits(form)[-10:]):  # within a code of digits and letters
        made, start = f"{before}5c9b{digits}e04d{after}", len(before) + 4
        yield features(made, (kind, start, start + len(digits))), 0


@dataclass(frozen=True)
class Model:
    boosted: boosting.Boosted | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def spans(self, text: str | None) -> list[dict]:
        """All selected spans by kind, then start: the base spans and what the trees add."""
        text = text or ""
        base = base_spans(text)
        chosen = [(*s, True) for s in base]
        if self.thresholds:
            loose = [s for s in candidates(text) if s[0] in self.thresholds]
            strict, added = Taken((a, b) for _, a, b in base), Taken()
            loose = [s for s in loose if not strict.meets(s[1], s[2])]
            if loose:
                p = self.boosted.probability(np.array([features(text, s) for s in loose]))
                for i in sorted(range(len(loose)), key=lambda i: (-p[i], loose[i])):
                    kind, a, b = loose[i]
                    if p[i] >= self.thresholds[kind] and not added.meets(a, b):
                        added.add(a, b)
                        chosen.append((kind, a, b, False))
        chosen.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        return [dict(zip(("kind", "start", "end", "base"), s)) for s in chosen]


def _signs(body: Column) -> list[Column]:
    """Whether a text may hold base spans of each kind; the last is true of every text."""
    return [F.coalesce(body.rlike(sign), F.lit(False)) for sign in SIGNS] + [F.lit(True)]


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", fit_docs: int = FIT_DOCS) -> Model:
    """Trees and thresholds from about ``fit_docs`` documents, drawn by hash of id and text:
    an equal part for each kind from those that show its signs, and one from all. Of each
    kind at most ``FIT_ROWS`` / 4 labelled candidates are used, so that no kind, source or
    size of the table leaves another without examples."""
    body = F.col(f"`{text}`")
    signs = _signs(body)
    sizes = docs.agg(*[F.count(F.when(s, 1)).alias(f"n{i}") for i, s in enumerate(signs)]).first()
    # A group's draws are the hashes below its share of their range.
    shares = [min(1.0, fit_docs / len(signs) / max(1, n)) for n in sizes]
    limits = [min(int(share * 2**64) - 2**63, 2**63 - 1) for share in shares]
    tagged = docs.select(body.alias("text"), F.xxhash64(F.col(f"`{doc_id}`"), F.length(body)).alias("draw"))
    wanted = [s & (F.col("draw") <= F.lit(limit)) for s, limit in zip(_signs(F.col("text")), limits)]
    drawn = tagged.where(reduce(Column.__or__, wanted))

    def label(c: dict[str, list]) -> dict[str, list]:
        return {"found": [[{"x": x, "y": y} for x, y in examples(t or "")] for t in c["text"]]}

    by_kind = Window.partitionBy("kind").orderBy(F.xxhash64("draw", "i"), "draw", "i", "f.x")
    rows = (
        per_row(drawn, ["text"], label, "found array<struct<x: array<double>, y: int>>")
        .select("draw", F.posexplode("found").alias("i", "f"))
        .withColumn("kind", F.array_position(F.slice("f.x", 1, len(KINDS)), F.lit(1.0)))
        .withColumn("place", F.row_number().over(by_kind))
        .where(F.col("place") <= FIT_ROWS // len(KINDS))
        .select("place", "kind", "f.x", "f.y")
        .collect()
    )
    rows.sort(key=lambda r: (r["place"], r["kind"]))
    y = np.array([r["y"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Model()
    x = np.array([r["x"] for r in rows])
    back = np.array([r["place"] % 3 == 0 for r in rows])
    if not (0 < y[back].sum() < back.sum() and 0 < y[~back].sum() < (~back).sum()):
        return Model()
    model = boosting.calibrated(boosting.fit(x[~back], y[~back]), x[back], y[back])
    p, limits = model.probability(x[back]), {}
    for i, kind in enumerate(KINDS):
        own = x[back][:, i] == 1
        order = np.argsort(-p[own], kind="stable")
        truth, scores = y[back][own][order], p[own][order]
        precise = np.cumsum(truth) / np.arange(1, len(truth) + 1) >= PRECISION
        enough = precise & (np.cumsum(truth) >= MIN_HELD_BACK)
        # A cut between equal probabilities would split what the trees can't tell apart.
        enough &= np.r_[scores[1:] != scores[:-1], True] if len(scores) else enough
        if enough.any():
            limits[kind] = float(max(scores[np.nonzero(enough)[0][-1]], 0.5))
    return Model(model, limits)


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def with_spans(
    docs: DataFrame, model: Model, text: str = "text", name: str = "spans", keep_text: bool = False
) -> DataFrame:
    """``docs`` with the selected spans of each text (code points, end exclusive) as the
    array ``name``, beside or in place of the text. Null and empty texts have none."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few dozen small trees

    def find(c: dict[str, list]) -> dict[str, list]:
        return {name: [held.value.spans(t) for t in c[text]]}

    return per_row(docs, [text], find, f"`{name}` {SPANS}", keep_inputs=keep_text)


def joined(spans: Column, only_base: bool = False) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    wanted = F.filter(spans, lambda s: s["base"]) if only_base else spans
    return F.array_join(
        F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """(doc_id, spans), one row for each row of ``docs``; nulls and repeats of doc_id are
    rows like others, other columns are ignored, no rows give no rows."""
    return with_spans(docs.select("doc_id", "text"), fit(docs, fit_docs=fit_docs))


def _masked(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= done:
            out += [text[done : s["start"]], f"[{s['kind'].upper()}]"]
        done = max(done, s["end"])
    return "".join(out) + text[done:]


def redact(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """``docs`` with every selected span in ``text`` replaced by its kind in brackets
    (overlapping spans by the first) and ``n_chars``, where there is one, the length of
    the new text. All rows stay, null texts stay null, columns stay as they are."""
    model, name = fit(docs, fit_docs=fit_docs), fresh(docs, "redacted")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def mask(c: dict[str, list]) -> dict[str, list]:
        return {name: [_masked(t, held.value.spans(t)) for t in c["text"]]}

    new = per_row(docs, ["text"], mask, f"`{name}` string")
    text = F.col(name)
    return new.select(
        *[
            text.alias(c)
            if c == "text"
            else F.coalesce(F.length(text).cast(docs.schema[c].dataType), F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
