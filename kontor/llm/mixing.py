"""Mixing sources to target weights: packed blocks, drawn shards, permuted indices.

1. Sizes and targets: words of each source; the weights share out the words of
   all, no source gets more than ``max_repeats`` times its own, what it cannot
   take goes to the others by weight (closed form over the sources in the order
   of their limit, so no loop).
2. Packing: the documents of a source, in a fixed pseudorandom order, are one
   stream of words, cut into blocks of ``block_words``. A document's place is a
   prefix sum in two steps (within a bucket of documents, then over buckets), so
   a source that holds most documents is summed by many tasks.
3. Draws: a source has as many slots as its target asks for. Each slot draws one
   of the output shards; the sources' counts in a shard are multinomial with the
   target shares as probabilities, given that the whole mix meets its targets.
4. Permutation: slot number k of a source is repeat k div n of block p(k mod n),
   where p is a swap-or-not shuffle of 0..n-1 (Hoang, Morris, Rogaway 2012), keyed
   by seed, source and repeat. Slots meet blocks by a join on (source, block).
5. Mix: a row of the join is a piece of a document in a slot of a shard. Each document
   gets its pieces (``mix_pieces``); the words taken of it, and its texts in the shards
   (``mixed_texts``), come from them.

Sources may be very many (domains): their ranks and running sums are prefix sums over
ranges, and their targets are broadcast only below a measured size.

Only DataFrame functions are used. Nothing depends on partitions or on the order
of rows: reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import WORD, settle, word_count
from kontor.operators.joins import broadcast_if_small

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 128
SLOTS_PER_SHARD = 4096
SEED = 20240607
ROUNDS = 10
# Documents of a bucket of the prefix sum, slots made by one row: sizes of units of work.
BUCKET_DOCS = 8192
SLOT_RUN = 1 << 14
PIECES = "array<struct<shard: bigint, slot: bigint, first_word: bigint, past_word: bigint>>"


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, content): the words of each text, 0 for null, and its hash."""
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.col(f"`{text}`")).alias("content"),
    )


def _running(df: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """``df`` with ``before_<c>`` for each column of ``sums``: its sum over the rows that come
    before in ``order``, by ranges of the order and the sums of the ranges before."""
    ranged = settle(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    total = ranged.groupBy("range").agg(*[F.sum(c).alias(f"all_{c}") for c in sums])
    # One row a partition: the window without a key is over those only.
    past = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = total.select(
        F.col("range").alias("_range"), *[F.coalesce(F.sum(f"all_{c}").over(past), F.lit(0)).alias(f"start_{c}") for c in sums]
    )
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"in_{c}") for c in sums])
        .join(F.broadcast(starts), F.col("range") == F.col("_range"))
        .select(*df.columns, *[(F.col(f"in_{c}") + F.col(f"start_{c}")).alias(f"before_{c}") for c in sums])
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(source, source_size, docs, target, blocks, slots), a row for each source.

    Sources in order of code points, null last, get the weights in turn, repeating.
    """
    by_name = F.col("source").asc_nulls_last()
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = _running(totals.withColumn("one", F.lit(1).cast("bigint")), [by_name], ["one"])
    turn = F.pmod(F.col("before_one"), F.lit(len(weights)))
    # Long integers, so that sums are the same in every order.
    weighed = ranked.select(
        "source",
        "source_size",
        "docs",
        F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (turn + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(max_repeats)).alias("limit"),
    )
    # A source is held at its limit if its share of what the ones before it (by
    # limit for each unit of weight) leave is at least that.
    running = settle(_running(weighed, [F.col("limit") / F.col("weight"), by_name], ["limit", "weight"]))
    # One row of sums reaches the driver, twice.
    words, every = running.agg(F.sum("source_size"), F.sum("weight")).first()
    share = (F.lit(words) - F.col("before_limit")).cast("double") / (F.lit(every) - F.col("before_weight"))
    held = running.withColumn("held", F.col("weight") * share >= F.col("limit"))
    taken, free = held.agg(F.sum(F.when(F.col("held"), F.col("limit"))), F.sum(F.when(~F.col("held"), F.col("weight")))).first()
    each = float((words or 0) - (taken or 0)) / free if free else 0.0
    target = F.when(F.col("held"), F.col("limit")).otherwise(F.col("weight") * F.lit(each))
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("bigint")
    return held.withColumn("target", target.cast("double")).select(
        "source",
        "source_size",
        "docs",
        "target",
        blocks.alias("blocks"),
        F.coalesce(
            F.least(
                F.round(F.try_divide(F.col("target") * blocks, F.col("source_size"))).cast("bigint"),
                blocks * max_repeats,
            ),
            F.lit(0),
        ).alias("slots"),
    )


def shuffled(x: Column, n: Column, *key: Column) -> Column:
    """Place of x (0 <= x < n) in the permutation of 0..n-1 that ``key`` names."""

    def swap(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        return F.element_at(
            F.transform(
                F.array(partner),
                lambda p: F.when(
                    F.xxhash64(*key, r, F.greatest(at, p)).bitwiseAND(F.lit(1)) == 1, p
                ).otherwise(at),
            ),
            1,
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("bigint"), swap)


def mixed_slots(targets: DataFrame, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """(shard, source, slot, repeat, block): every slot of the mix with the block it takes."""
    total = targets.agg(F.sum("slots")).first()[0] or 0
    shards = F.lit(max(1, -(-total // slots_per_shard))).cast("bigint")
    runs = targets.where("slots > 0").select(
        "source",
        "blocks",
        "slots",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / F.lit(SLOT_RUN)))).alias("run"),
    )
    first = F.col("run") * SLOT_RUN
    # A set number of partitions, so that the few run rows are not put into one task.
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = runs.repartition(tasks, "source", "run").select(
        "source",
        "blocks",
        F.explode(F.sequence(first, F.least(first + SLOT_RUN, F.col("slots")) - 1)).alias("slot"),
    )
    repeat = F.floor(F.col("slot") / F.col("blocks")).cast("bigint")
    place = F.pmod("slot", "blocks")
    return slots.select(
        F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "source", "slot"), shards).alias("shard"),
        "source",
        "slot",
        repeat.alias("repeat"),
        shuffled(place, F.col("blocks"), F.lit(seed), F.col("source"), repeat).alias("block"),
    )


def placed(sizes: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, content, start, copy): the first word of each row in its source's stream.

    Equal rows are counted first and laid out side by side.
    """
    groups = sizes.groupBy("source", "doc_id", "size", "content").agg(F.count(F.lit(1)).alias("copies"))
    t = targets.select(F.col("source").alias("_source"), "docs")
    buckets = F.ceil(F.col("docs") / F.lit(BUCKET_DOCS)).cast("bigint")
    t, _ = broadcast_if_small(t)
    dealt = groups.join(t, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source",
        "doc_id",
        "size",
        "content",
        "copies",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "content"), buckets).alias("bucket"),
    )
    words = F.col("size") * F.col("copies")
    sums = dealt.groupBy("source", "bucket").agg(F.sum(words).alias("words"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("words").over(over), F.lit(0)).alias("offset"),
    )
    within = (
        Window.partitionBy("source", "bucket")
        .orderBy(F.xxhash64(F.lit(seed), F.lit("order"), "doc_id"), "doc_id", "size", "content")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    laid = dealt.withColumn("inside", F.coalesce(F.sum(words).over(within), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    return laid.join(offsets.hint("merge"), same).select(
        "doc_id",
        "source",
        "size",
        "content",
        (F.col("offset") + F.col("inside")).alias("group_start"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"),
    ).select(
        "doc_id",
        "source",
        "size",
        "content",
        (F.col("group_start") + F.col("copy") * F.col("size")).alias("start"),
        "copy",
    )


def pieces(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``placed`` rows cut at block bounds: (.., block, first_word, past_word), the words counted
    from 0 in the row's text; block null and no words for empty rows."""
    first = F.floor(F.col("start") / F.lit(block_words))
    last = F.floor((F.col("start") + F.col("size") - 1) / F.lit(block_words))
    cut = places.withColumn(
        "block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last)))
    )
    low = F.greatest(F.col("start"), F.col("block") * block_words) - F.col("start")
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.col("start")
    return cut.withColumn("first_word", F.coalesce(low, F.lit(0))).withColumn("past_word", F.coalesce(high, F.lit(0)))


def mix_pieces(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(doc_id, source, size, content, source_size, target, pieces), a row for each row of ``docs``.

    ``content`` is the hash of the text. ``pieces`` lists where the row's words are in the
    mix: output shard, slot of the source, first and past-the-last word (from 0), in this
    order, one entry for each block it has words in and each slot that took the block.
    Null texts have no words and no pieces; rows without source are the last source; a
    null or repeated doc_id is a row like others (equal rows share their places among
    them). No rows give no rows. Other columns are ignored.
    """
    sizes = settle(sized(docs, doc_id, text, source))
    targets = settle(source_targets(sizes, weights, max_repeats, block_words))
    slots = mixed_slots(targets, seed=seed).select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "shard", "slot"
    )
    parts = pieces(placed(sizes, targets, seed), block_words)
    hit = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    piece = F.struct("shard", "slot", "first_word", "past_word")
    rows = (
        parts.join(slots.hint("merge"), hit, "left")  # both sides grow: never broadcast
        .groupBy("doc_id", "source", "size", "content", "start", "copy")
        .agg(F.array_sort(F.collect_list(F.when(F.col("slot").isNotNull(), piece))).cast(PIECES).alias("pieces"))
    )
    t, _ = broadcast_if_small(targets.select(F.col("source").alias("_source"), "source_size", "target"))
    return rows.join(t, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "content", "source_size", "target", "pieces"
    )


def _columns() -> list[Column]:
    taken = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda n, p: n + p["past_word"] - p["first_word"])
    shards = F.size(F.array_distinct(F.col("pieces.shard"))).cast("bigint")
    own = [F.col(c) for c in ("doc_id", "source", "size", "source_size", "target")]
    return [*own, taken.alias("taken"), shards.alias("shards")]


def mix(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, shards), a row for each row of ``docs``.

    ``taken`` counts the words of the row that the mix takes, repeats included, ``shards``
    the output shards that hold some; both from the row's pieces. Settings, null, empty
    and repeated rows: see ``mix_pieces``.
    """
    return mix_pieces(docs, **settings).select(*_columns())


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **settings
) -> DataFrame:
    """``mix`` with the columns ``pieces`` (see ``mix_pieces``) and ``text``, the row's text:
    the mix, with each text held once however often the mix takes it.

    A text meets its row by doc_id, source and content hash, nulls like values; of equal
    rows one is on the texts' side.
    """
    cut = mix_pieces(docs, doc_id=doc_id, text=text, source=source, **settings)
    texts = docs.select(
        F.col(f"`{doc_id}`").alias("_doc_id"),
        F.col(f"`{source}`").alias("_source"),
        F.xxhash64(F.col(f"`{text}`")).alias("_content"),
        F.col(f"`{text}`").alias("text"),
    ).dropDuplicates(["_doc_id", "_source", "_content"])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "source", "content")]
    return cut.join(texts.hint("merge"), same).select(*_columns(), "pieces", "text")


def mixed_texts(docs: DataFrame, **settings) -> DataFrame:
    """(shard, source, slot, doc_id, first_word, text): the mix as the shards hold it, a row
    for each piece, its words joined by single spaces. Empty rows have none."""

    def cut(words: Column) -> Column:
        return F.transform(
            "pieces",
            lambda p: F.struct(
                p["shard"].alias("shard"),
                p["slot"].alias("slot"),
                p["first_word"].alias("first_word"),
                F.array_join(
                    F.slice(words, (p["first_word"] + 1).cast("int"), (p["past_word"] - p["first_word"]).cast("int")), " "
                ).alias("text"),
            ),
        )

    # Inside a one-element array, so that a text is cut into words once, not for each piece.
    words = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return (
        mixed_documents(docs, **settings)
        .where(F.size("pieces") > 0)
        .select("doc_id", "source", F.inline(F.element_at(F.transform(words, cut), 1)))
        .select("shard", "source", "slot", "doc_id", "first_word", "text")
    )
