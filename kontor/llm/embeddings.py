"""Embedding near-duplicates by product quantisation.

Vectors go to inverted lists by their nearest coarse centroid; what the centroid
leaves (the residual) is coded by one small codebook for each subspace. A query looks
into its nearest lists, scores their vectors by table look-ups (its inner products
with all codewords, computed once) and compares the exact cosine only where the
estimate allows the threshold: each stored vector keeps the length of its coding
error, so estimate + error bounds the cosine from above and the look-ups lose nothing.

Every different vector is a query (equal vectors are one entry with a count) and every
one is indexed; a pair is found if either side probes the other's list. The number of
probes is measured at the fit: vectors are turned by noise to exactly the threshold,
and so many lists are probed that ``PROBE_SHARE`` of them find their origin's list.

Centroids and codebooks come from a bounded sample (``FIT_BYTES``); lists are worked
off in blocks of bounded size, members against queries, so a list or a cluster that
holds a third of all vectors is spread over tasks. A task returns counts and a
spanning set of links for each block, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import settle, stored
from kontor.llm.components import connected_components

THRESHOLD = 0.9
FIT_BYTES = 8 << 20
MAX_LISTS = 2048
SUBSPACE_DIMS = 8
CODES = 256
ROUNDS = 8
PROBE_SHARE = 0.995
PROBE_TRIALS = 2000
MIN_PROBES = 8
MEMBER_BLOCK = 2048
QUERY_BLOCK = 4096
QUERY_ROWS = 256
SEED = 7


def _nearest(x: np.ndarray, centres: np.ndarray, rows: int = 4096) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    parts = [(x[i : i + rows] @ centres.T - half).argmax(axis=1) for i in range(0, len(x), rows)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        home = _nearest(x, centres)
        order = np.argsort(home, kind="stable")
        at, first = np.unique(home[order], return_index=True)
        centres[at] = np.add.reduceat(x[order], first, axis=0) / np.diff([*first, len(x)])[:, None]
    return centres


@dataclass
class Index:
    """Coarse centroids, codebooks (subspace, code, dimensions), lists to probe."""

    centres: np.ndarray
    books: list[np.ndarray]
    probes: int

    def cuts(self) -> list[int]:
        return np.cumsum([b.shape[1] for b in self.books])[:-1].tolist()

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of the coding error) of unit vectors."""
        home = _nearest(unit, self.centres)
        rest = unit - self.centres[home]
        codes = np.empty((len(unit), len(self.books)), np.uint8)
        for j, part in enumerate(np.split(rest, self.cuts(), axis=1)):
            codes[:, j] = _nearest(part, self.books[j])
            part -= self.books[j][codes[:, j]]  # a view: ``rest`` becomes the error
        return home, codes, np.sqrt((rest**2).sum(axis=1))

    def lists(self, unit: np.ndarray) -> np.ndarray:
        """The lists that each vector probes, its own first."""
        score = unit @ self.centres.T - (self.centres**2).sum(axis=1) / 2
        return np.argsort(-score, axis=1, kind="stable")[:, : self.probes]

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        return [q @ b.T for q, b in zip(np.split(queries, self.cuts(), axis=1), self.books)]


def train(sample: np.ndarray, vectors: int, threshold: float) -> Index:
    """Fit on unit vectors; ``vectors`` is the number to be indexed."""
    rng = np.random.default_rng(SEED)
    lists = int(np.clip(round(vectors**0.5), 1, min(MAX_LISTS, max(1, len(sample) // 8))))
    centres = _kmeans(sample, lists, rng)
    rest = sample - centres[_nearest(sample, centres)]
    dims = sample.shape[1]
    parts = np.array_split(rest, max(1, -(-dims // SUBSPACE_DIMS)), axis=1)
    index = Index(centres, [_kmeans(p, CODES, rng) for p in parts], len(centres))
    # How many lists must a query at the threshold probe to meet its partner's?
    x = sample[rng.choice(len(sample), min(PROBE_TRIALS, len(sample)), replace=False)]
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    size = np.linalg.norm(noise, axis=1, keepdims=True)
    turned = threshold * x + np.sqrt(1 - threshold**2) * noise / np.where(size > 0, size, 1)
    ranks = (index.lists(turned) == _nearest(x, centres)[:, None]).argmax(axis=1)
    need = int(np.quantile(ranks, PROBE_SHARE, method="higher")) + 1
    index.probes = min(len(centres), max(MIN_PROBES, need))
    return index


def normalised(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _unit(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return normalised(values.reshape(len(column), -1))


def _classes(rows: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """(rows with vec_id and key, classes (key, rep, copies, embedding)): vectors that can
    be compared, those of one content under one key."""
    vector = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(vector, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))  # NaN is above infinity
    usable = F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))
    tagged = rows.select(
        F.col(f"`{vec_id}`").alias("vec_id"),
        F.when(usable & F.col(f"`{vec_id}`").isNotNull(), vector).alias("embedding"),
    )
    classes = (
        tagged.where("embedding IS NOT NULL")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .withColumn("key", F.struct("rep", F.xxhash64("embedding").alias("hash")))
    )
    return tagged, classes


MEMBER = "rep bigint, hash bigint, copies bigint, embedding array<double>, home int, codes binary, error double, probes array<int>"


def _encoded(classes: DataFrame, index: Index) -> DataFrame:
    held = classes.sparkSession.sparkContext.broadcast(index)  # of bounded size: FIT_BYTES and MAX_LISTS

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                unit = _unit(part.column("embedding"))
                home, codes, error = held.value.encode(unit)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("rep"),
                        part.column("hash"),
                        part.column("copies"),
                        part.column("embedding"),
                        pa.array(home.astype(np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(error),
                        pa.array(list(held.value.lists(unit).astype(np.int32)), pa.list_(pa.int32())),
                    ],
                    names=["rep", "hash", "copies", "embedding", "home", "codes", "error", "probes"],
                )

    return classes.select("key.rep", "key.hash", "copies", "embedding").mapInArrow(work, MEMBER)


FOUND = "rep bigint, hash bigint, links bigint, to_rep bigint, to_hash bigint"


def _matcher(held, threshold: float):
    """For one block: members of one list against queries that probe it."""

    def one(t: pa.Table, name: str) -> pa.Array:
        column = t.column(name).combine_chunks()
        return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column

    def match(queries: pa.Table, members: pa.Table) -> pa.Table:
        index: Index = held.value
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("rep", "hash", "links", "to_rep", "to_hash")})
        if not (queries.num_rows and members.num_rows):
            return empty
        qc, mc = queries, members
        q, m = _unit(one(qc, "embedding")), _unit(one(mc, "embedding"))
        ids = lambda t: np.stack([one(t, n).to_numpy() for n in ("rep", "hash")], axis=1)
        q_id, m_id = ids(qc), ids(mc)
        q_home, q_copies = one(qc, "home").to_numpy(), one(qc, "copies").to_numpy()
        m_copies, error = one(mc, "copies").to_numpy(), one(mc, "error").to_numpy()
        codes = np.frombuffer(b"".join(one(mc, "codes").to_pylist()), np.uint8).reshape(len(m), -1)
        probes = one(mc, "probes").flatten().to_numpy().reshape(len(m), -1)
        centre = index.centres[int(one(mc, "home")[0].as_py())]
        q_links, m_links = np.zeros(len(q), np.int64), np.zeros(len(m), np.int64)
        pairs = []
        for at in range(0, len(q), QUERY_ROWS):
            own = q[at : at + QUERY_ROWS]
            bound = (own @ centre)[:, None] + error
            for table, code in zip(index.tables(own), codes.T):
                bound += table[:, code]
            i, j = np.nonzero(bound >= threshold - 1e-9)
            near = np.einsum("ij,ij->i", own[i], m[j]) >= threshold
            i, j = i[near] + at, j[near]
            other = (q_id[i] != m_id[j]).any(axis=1)
            i, j = i[other], j[other]
            q_links += np.bincount(i, m_copies[j], len(q)).astype(np.int64)
            # A member that does not probe the query's list will not meet it as a query.
            alone = ~(probes[j] == q_home[i][:, None]).any(axis=1)
            m_links += np.bincount(j[alone], q_copies[i[alone]], len(m)).astype(np.int64)
            pairs.append((i, j))
        i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        if not len(i):
            return empty
        # Components of the block's links: each vertex takes the least label it sees.
        label = np.arange(len(q) + len(m))
        while True:
            new = label.copy()
            np.minimum.at(new, i, label[len(q) + j])
            np.minimum.at(new, len(q) + j, new[i])
            new = new[new]
            if (new == label).all():
                break
            label = new
        every = np.concatenate([q_id, m_id])
        links = np.concatenate([q_links, m_links])
        seen = np.zeros(len(every), bool)
        seen[i] = seen[len(q) + j] = True
        keep, to = every[seen], every[label[seen]]
        return pa.table(
            {"rep": keep[:, 0], "hash": keep[:, 1], "links": links[seen], "to_rep": to[:, 0], "to_hash": to[:, 1]}
        )

    return match


def _linked(classes: DataFrame, dims: int, total: int, threshold: float) -> DataFrame:
    """Links (``FOUND``) among ``total`` classes of vectors of length ``dims``."""
    fit_rows = max(256, FIT_BYTES // (8 * dims))
    drawn = classes.orderBy(F.xxhash64(F.col("key.hash")), "key").limit(fit_rows).select("embedding").collect()
    index = train(normalised(np.array([r[0] for r in drawn])), total, threshold)
    entries = stored(_encoded(classes, index))

    # Blocks of each list, members by queries: one row a list, at most MAX_LISTS.
    count = lambda df, name, size: df.groupBy("list").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias(name)
    )
    members = entries.withColumn("list", F.col("home"))
    asking = entries.select("rep", "hash", "copies", "embedding", "home", F.explode("probes").alias("list"))
    blocks = F.broadcast(
        count(members.select("list"), "mbs", MEMBER_BLOCK).join(count(asking.select("list"), "qbs", QUERY_BLOCK), "list")
    )
    lot = F.xxhash64("hash", "rep")
    own = members.join(blocks, "list").select(
        *members.columns,
        F.pmod(lot, F.col("mbs")).cast("int").alias("mb"),
        F.explode(F.sequence(F.lit(0), F.col("qbs") - 1)).alias("qb"),
    )
    asking = asking.join(blocks, "list").select(
        *asking.columns,
        F.explode(F.sequence(F.lit(0), F.col("mbs") - 1)).alias("mb"),
        F.pmod(lot, F.col("qbs")).cast("int").alias("qb"),
    )
    asking = asking.toDF(*asking.columns)  # columns of its own beside those of ``own``
    cells = ["list", "mb", "qb"]
    held = classes.sparkSession.sparkContext.broadcast(index)
    return settle(
        asking.groupBy(*cells).cogroup(own.groupBy(*cells)).applyInArrow(_matcher(held, threshold), FOUND)
    )


def near_duplicates(
    rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``rows``.

    Cosines are taken in double precision. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest vec_id that links reach. Vectors that are
    null, zero, or hold a null or non-finite component, and rows without vec_id, link with
    nothing: no links, their own component. Vectors of different lengths have no cosine;
    those of each length are compared with one another, by an index of their own. A vec_id
    that names several vectors is several rows; each is linked for itself. Equal vectors
    are linked with each other. No rows give no rows; other columns are ignored.
    """
    tagged, classes = _classes(rows, vec_id, embedding)
    classes = stored(classes)
    # One row for each length that vectors have.
    lengths = classes.groupBy(F.size("embedding").alias("n")).count().orderBy("n").collect()
    several = [_linked(classes.where(F.size("embedding") == r.n), r.n, r["count"], threshold) for r in lengths if r["count"] > 1]
    found = reduce(DataFrame.unionByName, several) if several else rows.sparkSession.createDataFrame([], FOUND)
    node, to = F.struct("rep", "hash"), F.struct(F.col("to_rep").alias("rep"), F.col("to_hash").alias("hash"))
    components = connected_components(found.select(node.alias("a"), to.alias("b")))
    links = found.groupBy("rep", "hash").agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "copies", "embedding")
        .join(components, F.col("key") == F.col("node"), "left")
        .join(links, (F.col("key.rep") == F.col("rep")) & (F.col("key.hash") == F.col("hash")), "left")
        .select(
            F.col("embedding").alias("_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce(F.col("component.rep"), F.col("key.rep")).alias("component"),
        )
    )
    return tagged.join(named, F.col("embedding") == F.col("_embedding"), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id").eqNullSafe(F.col("vec_id")) & F.col("vec_id").isNotNull()).alias("kept"),
    )
