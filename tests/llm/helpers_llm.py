"""Small tables for the operators' tests."""

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows, schema=DOC_SCHEMA):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else None) for r in rows]
    return spark.createDataFrame(full, schema)


def clashing(df):
    """With extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["score", "fingerprint", "component", "spans", "leaks", "n_tokens", "taken", "size", "start", "block", "_content", "file", "hash", "kind", "key"]
    return df.select("*", *[F.lit("x").alias(n) for n in names if n not in df.columns])
