"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; two texts are linked when their fingerprints differ
in at most ``distance`` bits. The bits are cut into m segments. With
distance = m * a + b (b < m), two linked fingerprints agree up to a bits in one
of the first b + 1 segments or up to a - 1 bits in one of the others (else they
would differ in more than ``distance`` bits). So each fingerprint enumerates the
Hamming ball of that radius around each of its segments, fetches the
fingerprints stored under those values, and keeps those whose complete distance
is small enough: no link is lost, none is false.

Equal fingerprints are joined first, so a group of copies is one entry. The
number of segments follows the number of fingerprints (it balances probes
against the chance matches they fetch) and never changes the result.

Where very many fingerprints share a segment's value (a family of near copies), the
ones stored there and those that probe there are cut into blocks by hash; each pair of
blocks is compared whole and returns a spanning set of its links, not all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import MAX_BROADCAST_BYTES, fresh, join_spread, per_row, settle
from kontor.llm.components import connected_components

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
# Shingles whose bits are counted at a time.
BLOCK = 1 << 13
# Fingerprints stored under one value of a segment beyond which they are worked off in
# blocks, and fingerprints of a block.
CROWD = 256
CROWD_BLOCK = 1024
# Bytes of a crowded cell as a row.
CELL_BYTES = 40


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text as a signed integer. Words are cut at white space
    after A-Z became lower case; a shingle is ``words`` words joined by spaces
    (all words where there are fewer), hashed by XXH64; a bit is set when more
    than half the shingles' hashes set it. No words, or null: zero."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(size + 1) - 1
    k = min(words, len(tokens))
    starts, ends = (ends - size)[: len(tokens) - k + 1], ends[k - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        cut = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in cut], repeat(SEED)), np.uint64
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(packed.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the text replaced by ``fingerprint`` (bigint)."""
    return per_row(
        docs, [text], lambda c: {"fingerprint": [fingerprint(t, words) for t in c[text]]}, "fingerprint bigint"
    )


def segments(distance: int, count: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each of ``count`` segments for a distance."""
    base, longer = divmod(BITS, count)
    a, b = divmod(distance, count)
    out, shift = [], 0
    for i in range(count):
        width = base + (1 if i >= count - longer else 0)
        radius = a if i <= b else a - 1
        if radius >= 0:
            out.append((shift, width, radius))
        shift += width
    return out


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << p for p in flips) for r in range(radius + 1) for flips in combinations(range(width), r)]


def choose_segments(distance: int, fingerprints: int) -> list[tuple[int, int, int]]:
    """The cut with the least probes plus expected chance matches for each fingerprint."""

    def cost(parts: list[tuple[int, int, int]]) -> float:
        return sum(len(_ball(w, r)) * (1 + fingerprints / 2.0**w) for _, w, r in parts)

    return min((segments(distance, m) for m in range(2, max(3, distance + 2))), key=cost)


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _probes(masks: Column, part: Column, value: Column) -> Column:
    return F.transform(masks, lambda mask: F.struct(part, value.bitwiseXOR(mask).alias("value")))


def _spanning(xs: np.ndarray, ys: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join what the links between two blocks of fingerprints join, at most
    one for each fingerprint."""
    differ = (xs[:, None] ^ ys[None, :]).view(np.uint64)  # bits of signed numbers are those of their size
    near = np.bitwise_count(differ) <= distance
    i, j = np.nonzero(near & (xs[:, None] != ys[None, :]))
    j += len(xs)
    every = np.concatenate([xs, ys])
    label = np.arange(len(every))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, new[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    tied = every[label] != every
    return every[tied], every[label[tied]]


def _crowded_links(asked: DataFrame, index: DataFrame, crowded: DataFrame, distance: int) -> DataFrame:
    """Spanning links (x, y) of the cells ``crowded`` (part, value, stored)."""
    cell = ["part", "value"]

    def blocks(name: str, count: str) -> Column:
        parts = F.ceil(F.col(count) / F.lit(CROWD_BLOCK)).cast("int")
        return F.pmod(F.xxhash64(name), parts).cast("int")

    here = asked.join(crowded, cell)
    sized = here.groupBy(*cell).agg(F.count(F.lit(1)).alias("asking"))
    probes = here.join(sized, cell).withColumn("xb", blocks("x", "asking"))
    stored = index.join(crowded, cell).withColumn("yb", blocks("y", "stored"))
    last = F.ceil(F.col("stored") / F.lit(CROWD_BLOCK)).cast("int") - 1
    probe_blocks = probes.groupBy(*cell, "xb", "stored").agg(F.collect_list("x").alias("xs"))
    spread = probe_blocks.select(*cell, "xs", F.explode(F.sequence(F.lit(0), last)).alias("yb"))
    stored_blocks = stored.groupBy(*cell, "yb").agg(F.collect_list("y").alias("ys"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                xs, ys = (batch.column(k)[row].values.to_numpy() for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _spanning(xs, ys, distance)], names=["x", "y"])

    units = spread.join(stored_blocks, [*cell, "yb"]).select("xs", "ys")
    return units.mapInArrow(work, "x bigint, y bigint")


def linked_fingerprints(fingerprints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``fingerprints``: one bigint column of different values. Returns pairs (x, y),
    each once, as the links of a graph with the same components as that of all pairs
    that differ in 1 to ``distance`` bits: those pairs themselves, but for segment values
    that more than ``CROWD`` fingerprints share a spanning set for each pair of blocks."""
    fp = fingerprints.select(F.col(fingerprints.columns[0]).alias("fp"))
    parts = choose_segments(distance, fp.count())
    # A set number of partitions: each fingerprint becomes dozens of probes.
    fp = fp.repartition(int(fp.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    asked_at, stored_at = [], []
    for part, (shift, width, radius) in enumerate(parts):
        tag, value = F.lit(part).cast("tinyint").alias("part"), _segment(F.col("fp"), shift, width)
        masks = F.array(*[F.lit(m).cast("bigint") for m in _ball(width, radius)])
        stored_at.append(F.struct(tag, value.alias("value")))
        asked_at.append(_probes(masks, tag, value))
    index = fp.select(F.col("fp").alias("y"), F.inline(F.array(*stored_at)))
    asked = fp.select(F.col("fp").alias("x"), F.inline(F.concat(*asked_at)))
    crowded = settle(
        index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("stored")).where(F.col("stored") > CROWD)
    )
    cells = crowded.count()
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance
    apart = (F.col("x") < F.col("y")) & near
    if not cells:
        return asked.join(index, ["part", "value"]).where(apart).select("x", "y").distinct()
    if cells * CELL_BYTES <= MAX_BROADCAST_BYTES:
        crowded = F.broadcast(crowded)
    others = index.join(crowded, ["part", "value"], "left_anti")
    links = asked.join(others, ["part", "value"]).where(apart).select("x", "y")
    return links.unionByName(_crowded_links(asked, index, crowded, distance)).distinct()


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """(fingerprint, component, component_id) of rows with doc_id and fingerprint."""
    smallest = settle(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    linked = connected_components(linked_fingerprints(smallest.select("fingerprint"), distance))
    named = settle(
        smallest.join(linked, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", F.coalesce("component", "fingerprint").alias("component"), "first_id"
        )
    )
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return settle(join_spread(named.drop("first_id"), ids, "component"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``.

    ``fingerprint`` has 16 lower-case hex digits; ``component_id`` is the smallest
    doc_id that links reach, the document's own included. Null and empty texts
    have fingerprint zero and are linked like others. A repeated doc_id is one
    document with several texts: each of its rows keeps the component of its own
    fingerprint. A row without doc_id takes part as a text; ``component_id`` is
    null only where no row of the component has a doc_id. No rows give no rows;
    other columns are ignored.
    """
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = settle(with_fingerprint(slim, "text", words))
    return join_spread(prints, _classes(prints, distance), "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (rows
    without one come last), of rows that repeat a doc_id the one whose content hash
    is smallest, of equal rows one. The columns stay as they are."""
    content = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    prints = settle(
        with_fingerprint(docs.select("doc_id", "text", content.alias("content")), "text", words)
    )
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "content")
    first = (
        prints.groupBy("fingerprint")
        .agg(F.min(order).alias("first"))
        .join(_classes(prints, distance), "fingerprint")
        .groupBy("component")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("_id"), F.col("first.content").alias("_content"))
    )
    rows = prints.groupBy(F.col("doc_id").alias("_id"), F.col("content").alias("_content")).count()
    one = (F.col("f._content") == F.col("r._content")) & F.col("f._id").eqNullSafe(F.col("r._id"))
    first = settle(first.alias("f").join(rows.alias("r"), one).select("f._id", "f._content", "r.count"))
    name = fresh(docs, "_content")
    tagged = docs.withColumn(name, content)

    def of(chosen: DataFrame) -> DataFrame:
        match = (tagged[name] == chosen["_content"]) & tagged["doc_id"].eqNullSafe(chosen["_id"])
        return tagged.join(chosen, match, "left_semi")

    once = of(first.where(F.col("count") == 1))
    repeated = of(first.where(F.col("count") > 1)).dropDuplicates(["doc_id", name])
    return once.unionByName(repeated).drop(name)
