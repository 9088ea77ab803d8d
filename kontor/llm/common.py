"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.session import shared_folder

# Characters that separate words: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
# A side that is proven to have at most this size may be broadcast.
MAX_BROADCAST_BYTES = 32 << 20
# Rows of a key from which ``join_spread`` leaves them where they are, and the most such keys.
HOT_ROWS = 10_000
MAX_HOT_KEYS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (columnar,
    so a later pass reads only the columns it needs)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_spread(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key`` of ``many`` with ``one``, which has one row of a few fixed-width
    columns for each key. A key of very many rows is not brought together: its row of
    ``one`` is broadcast. There are at most ``MAX_HOT_KEYS`` such keys, whatever the size
    of ``many``, since each holds at least that share of its rows. Both sides are read
    several times. Null keys match nothing."""
    least = max(HOT_ROWS, -(-many.count() // MAX_HOT_KEYS))
    hot = settle(many.groupBy(key).count().where(F.col("count") >= least).select(key))
    if not hot.count():
        return many.join(one, key)
    hot = F.broadcast(hot)
    crowded = many.join(F.broadcast(one.join(hot, key, "left_semi")), key)
    return crowded.unionByName(many.join(hot, key, "left_anti").join(one, key))


def word_count(text: Column) -> Column:
    """Number of words of a text as bigint; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or where ``df`` has such a column, a longer one that it hasn't."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def values(column: pa.Array) -> list:
    """A column as Python values; lists of numbers or booleans as numpy arrays."""
    if not pa.types.is_list(column.type) or pa.types.is_nested(column.type.value_type) or column.null_count:
        return column.to_pylist()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(flat, ends[:-1]) if len(ends) else []


def per_row(
    df: DataFrame,
    inputs: list[str],
    fn: Callable[[dict[str, list]], dict[str, list]],
    outputs: str,
    keep_inputs: bool = False,
    slice_rows: int = 512,
) -> DataFrame:
    """Replace the columns ``inputs`` by the columns ``outputs`` (a DDL string), or
    add them beside the inputs with ``keep_inputs``.

    ``fn`` gets lists of the inputs' values (see ``values``) and returns lists of the
    outputs' values, one for each row. All other columns pass through Arrow untouched,
    whatever their names; an output replaces a column of its name. A batch is
    worked off in slices, so that Python objects of few texts live at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(outputs)
    drop = {c.lower() for c in [*([] if keep_inputs else inputs), *added.names]}
    kept = [f for f in df.schema.fields if f.name.lower() not in drop]
    sent = [*kept, *[df.schema[c] for c in inputs]]
    schema = StructType([*kept, *added.fields])
    types = to_arrow_schema(added)
    n_kept, names = len(kept), schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                got = fn({c: values(part.column(n_kept + i)) for i, c in enumerate(inputs)})
                new = [pa.array(got[f.name], f.type) for f in types]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *new], names=names)
        pa.default_memory_pool().release_unused()  # workers live on between tasks

    columns = [F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(sent)]
    return df.select(*columns).mapInArrow(work, schema)
