"""Readers for the service feeds.

* CSV directories with a header. Columns are taken by their header names, in any
  order, beside any others. Each file has a header of its own: files of one header
  are read together, and a column that a file lacks is an error that names the file;
* nested investment documents (JSON), either one JSON array per file
  (``multiLine``: each top-level element becomes a row, no driver-side
  rewriting) or one document per line, or as texts of a column, where malformed
  documents are kept apart and can be counted;
* catalog registration: each table directory as a temp view.

Empty CSV fields read as NULL, and so do values that do not fit their type.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.unnest import unnest_investments
from kontor.schemas import FEED_SCHEMAS, NESTED_INVESTMENTS_DDL


# Headers read at a time.
HEADER_THREADS = 16


def _typed(df: DataFrame, schema: T.StructType, where: str) -> DataFrame:
    """The schema's columns of ``df``, by name."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{where}: no column {', '.join(missing)} (found {', '.join(df.columns)})")
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a CSV folder by their header; files without a line are left out.

    The driver gets names of files and columns only, a header a file by Spark's reader,
    several at a time. File names are names here, not patterns.
    """
    names = [unquote(f) for f in spark.read.text(path).inputFiles()]
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", n) for n in names]

    def header(name: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).csv(name).columns)

    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        found = list(pool.map(header, plain))
    groups: dict[tuple[str, ...], list[str]] = {}
    for columns, name in sorted(zip(found, plain)):
        if columns:
            groups.setdefault(columns, []).append(name)
    return groups


def read_feed_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV directory; with a schema its columns by name, without one every
    column of any file as text (NULL where a file lacks it)."""
    parts = []
    for columns, names in _headers(spark, path).items():
        texts = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        # enforceSchema off: a file whose header is not this one any more stops the read.
        df = spark.read.schema(texts).option("header", True).option("enforceSchema", False).csv(names)
        parts.append(df if schema is None else _typed(df, schema, names[0]))
    if not parts:
        return spark.createDataFrame([], schema or T.StructType())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=schema is None), parts)


def register_feeds(
    spark: SparkSession, root: str, names: Iterable[str] | None = None, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Read ``root/<name>`` for each name and register it as temp view ``name``.

    Known feeds get the columns and types of their schema; any other table
    directory is registered as it is stored (CSV columns as text).
    """
    out = {}
    for name in names or FEED_SCHEMAS:
        schema, path = FEED_SCHEMAS.get(name), f"{root}/{name}"
        if fmt == "csv":
            df = read_feed_csv(spark, path, schema)
        elif fmt == "json" and schema is not None:  # by name; a field that no row has is NULL
            df = spark.read.schema(schema).json(path)
        else:
            stored = spark.read.format(fmt).load(path)
            df = stored if schema is None else _typed(stored, schema, path)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


def read_nested_investments(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """account_id + transactions array, all leaves text, with the fixed DDL.

    ``multiline=True`` reads files that each hold one JSON array (or one
    object); a file is then parsed by one task, so many files scale out and one
    huge file does not. ``multiline=False`` reads JSON lines, splittable.
    """
    return spark.read.schema(NESTED_INVESTMENTS_DDL).option("multiLine", multiline).json(path)


def parse_nested_investments(documents: DataFrame, column: str = "document") -> DataFrame:
    """Documents as JSON texts -> their columns, ``malformed`` (the text of a document that
    is no such JSON object, else NULL) and the other columns of ``documents``.

    A malformed document has no account and no transactions: nothing of it is guessed. A
    NULL or blank text holds no document and is malformed as well.
    """
    kept = [F.col(f"`{c}`") for c in documents.columns if c != column]
    with_bad = f"{NESTED_INVESTMENTS_DDL}, _bad STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    read = documents.select(
        *kept, F.col(f"`{column}`").alias("_text"), F.from_json(F.col(f"`{column}`"), with_bad, options).alias("_read")
    )
    broken = F.col("_read").isNull() | F.col("_read._bad").isNotNull() | (F.trim(F.col("_text")) == "")
    fields = [f for f in T.StructType.fromDDL(NESTED_INVESTMENTS_DDL).names]
    return read.select(
        *kept,
        *[F.when(~broken, F.col(f"_read.{f}")).alias(f) for f in fields],
        F.when(broken, F.coalesce("_text", F.lit(""))).alias("malformed"),
    )


def load_investments(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Nested documents -> flat investments feed (one row per transaction)."""
    return unnest_investments(read_nested_investments(spark, path, multiline))
