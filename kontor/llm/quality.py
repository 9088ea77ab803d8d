"""Quality classifier by compression: two zstandard dictionaries, one calibrated score.

One dictionary is trained on good, one on bad labelled text. A text is compressed
with either, block by block so that the dictionaries count over its whole length;
d = (bad - good) / (bad + good) of the compressed sizes is positive where good text
explains it better. A logistic calibration, fitted on labelled texts that trained no
dictionary, turns d into a probability; it also sees the compression ratio and the
length, since the same difference says less about text that compresses to nothing
(one word repeated) or is very short; values beyond those it was fitted on count as
the outermost ones. Both classes weigh the same in the fit: the score is the
probability of label 1 where both labels are equally common.

Only the fit is bounded (``docs_per_class`` texts of at most ``max_fit_bytes`` for
each class and use, together at most ``max_group_bytes``, drawn by hash from all labelled rows); every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import fresh, per_row

BLOCK_BYTES = 4096
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
DOCS_PER_CLASS = 1500
MAX_FIT_BYTES = 1 << 17
# For each class and use: texts in hash order up to this many bytes.
MAX_GROUP_BYTES = 16 << 20
FOLDS = 3
HELD_OUT_FOLD = 1
DICTIONARY_FOLD = 0
THRESHOLD = 0.5
RIDGE = 0.1


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; null for null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]


def train_dictionary(texts: Iterable[str]) -> bytes:
    """A zstandard dictionary of the texts' blocks; where they are too few to train
    one, the texts themselves (their last bytes) are the dictionary."""
    parts = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(dictionary)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False
    )


def features(text: str | None, good: bytes, bad: bytes) -> tuple[float, float, float]:
    """(d, ratio, log length): normalised size difference, compressed size over size, length.

    The ratio is that of the bad dictionary: a good text that a small dictionary holds
    whole would else look like one that repeats itself."""
    by_good, by_bad = _compressor(good), _compressor(bad)
    g = b = n = 0
    for block in blocks(text):
        g += len(by_good.compress(block))
        b += len(by_bad.compress(block))
        n += len(block)
    return ((b - g) / max(1, b + g), b / max(1, n), float(np.log1p(n)))


def _terms(x: np.ndarray) -> np.ndarray:
    d, r, n = x.T
    return np.stack([np.ones(len(d)), d, r, n, d * d, r * r, n * n, d * r, d * n, r * n], axis=1)


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; ``weights`` None (no labels of both classes) scores 0.5."""

    good: bytes
    bad: bytes
    low: tuple[float, ...] = ()
    high: tuple[float, ...] = ()
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] | None = None

    def score(self, texts: list[str | None]) -> list[float]:
        if self.weights is None or not texts:
            return [0.5] * len(texts)
        x = np.array([features(t, self.good, self.bad) for t in texts])
        x = _terms(np.clip(x, np.array(self.low), np.array(self.high)))
        z = (x - np.array(self.centre)) / np.array(self.scale) @ np.array(self.weights)
        return (1 / (1 + np.exp(-np.clip(z, -40, 40)))).tolist()


def calibrate(good: bytes, bad: bytes, texts: list[str], labels: np.ndarray) -> Model:
    """Logistic regression by Newton steps, both classes of equal weight."""
    seen = np.array([features(t, good, bad) for t in texts])
    low, high = seen.min(axis=0), seen.max(axis=0)
    x = _terms(seen)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    centre[0], scale[0] = 0.0, 1.0
    a = (x - centre) / scale
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + RIDGE * np.eye(len(w))
        w = w + np.linalg.solve(hessian, a.T @ (weight * (labels - p)) - RIDGE * w)
    return Model(good, bad, *(tuple(v.tolist()) for v in (low, high, centre, scale, w)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    docs_per_class: int = DOCS_PER_CLASS,
    max_fit_bytes: int = MAX_FIT_BYTES,
    max_group_bytes: int = MAX_GROUP_BYTES,
) -> Model:
    """Fit on the labelled rows outside the held-out fold.

    A doc_id labelled both 0 and 1, or whose label or text is null, teaches nothing.
    At most 4 * ``docs_per_class`` texts of up to ``max_fit_bytes``, and 4 *
    ``max_group_bytes`` in all, reach the driver.
    """
    f = fold(F.col("doc_id"))
    clean = (
        labels.where(F.col("quality").isin(0, 1) & (f != HELD_OUT_FOLD))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select("doc_id", "quality", (f == DICTIONARY_FOLD).alias("teaches"))
    )
    texts = docs.select("doc_id", "text").where(F.octet_length("text").between(1, max_fit_bytes))
    found = clean.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {(r["quality"], r["teaches"]): r["count"] for r in found.groupBy("quality", "teaches").count().collect()}
    if not all(sum(n for (k, _), n in counts.items() if k == q) for q in (0, 1)):
        return Model(b"", b"")
    chosen = None
    for q in (0, 1):
        for t in (True, False):
            part = (
                found.where((F.col("quality") == q) & (F.col("teaches") == t))
                .orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(docs_per_class)
            )
            chosen = part if chosen is None else chosen.unionByName(part)
    # At most 4 * docs_per_class ids: a broadcast and windows of bounded size.
    of_use = Window.partitionBy("quality", "teaches").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality", "teaches")
        .agg(F.min("text").alias("text"))
        .withColumn("bytes", F.sum(F.octet_length("text")).over(of_use))
        .where(F.col("bytes") <= max_group_bytes)
        .select("doc_id", "quality", "teaches", "text")
        .collect()
    )
    if len({r["quality"] for r in rows}) < 2:
        return Model(b"", b"")
    rows.sort(key=lambda r: r["doc_id"])
    taught = {q: [r["text"] for r in rows if r["quality"] == q and r["teaches"]] for q in (0, 1)}
    if not all(taught.values()):  # too few labels to hold some back from the dictionaries
        taught = {q: [r["text"] for r in rows if r["quality"] == q] for q in (0, 1)}
    judged = [r for r in rows if not r["teaches"]]
    if len({r["quality"] for r in judged}) < 2:
        judged = rows
    good, bad = train_dictionary(taught[1]), train_dictionary(taught[0])
    y = np.array([r["quality"] for r in judged], float)
    return calibrate(good, bad, [r["text"] for r in judged], y)


def with_score(
    docs: DataFrame, model: Model, text: str = "text", name: str = "score", keep_text: bool = False
) -> DataFrame:
    """``docs`` with a column ``name`` (0 to 1, higher: better) beside or in place of the
    text. Null texts score as empty ones; every row is scored by its text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES at most

    def score(columns: dict[str, list]) -> dict[str, list]:
        return {name: held.value.score(columns[text])}

    return per_row(docs, [text], score, f"`{name}` double", keep_inputs=keep_text)


def classify(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    ``held_out`` marks the fold whose labels the fit never sees (a null doc_id is in
    no fold: false); ``predicted`` is 1 from a score of 0.5. Without labels of both
    classes every score is 0.5. No rows give no rows; other columns are ignored.
    """
    model = fit(docs, labels, **bounds)
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, columns as they are."""
    name = fresh(docs, "quality_score")
    scored = with_score(docs, fit(docs, labels, **bounds), name=name, keep_text=True)
    return scored.where(F.col(name) >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
