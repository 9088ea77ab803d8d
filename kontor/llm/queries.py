"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from kontor.llm import bpe, chat, decontaminate, embeddings, merkle, mixing, pii, quality, repair, simhash, tokens, urls, whitening
from kontor.llm.common import table


def damaged(records: DataFrame) -> DataFrame:
    """A replica of placed WARC records with damage of every kind in known places: by the
    digest, one record in 16 is lost, in one in 16 the first byte is changed, and after
    one in 16 stands another (it begins at the last byte of the first)."""
    kept = records.where("digest >= '1'")
    changed = F.when(F.col("digest").between("4", "4g"), F.col("flipped")).otherwise(F.col("digest"))
    extra = kept.where(F.col("digest").between("8", "8g")).withColumn("offset", F.col("offset") + F.col("length") - 1)
    return kept.withColumn("digest", changed).unionByName(extra)


def op1_merkle_audit(spark: SparkSession, d: str) -> DataFrame:
    records = merkle.warc_records(table(spark, d, "pages"))
    flipped = merkle.digest(F.concat(F.lit("w"), F.substr("record", F.lit(2))))
    records = merkle.placed(records.withColumn("flipped", flipped).drop("record"))
    return merkle.audit(records, damaged(records))


OP1_SQL = r"""
WITH r AS (
    SELECT page_id, CAST(floor(page_id / 512) AS BIGINT) AS file,
           'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
           || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
           || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
    FROM pages),
s AS (SELECT *, sha256(record) AS digest FROM r),
p AS (
    SELECT *, CAST(strlen(record) AS BIGINT) AS length,
           CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id, digest
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
    FROM s),
c AS (SELECT *, digest AS lot FROM p)
SELECT file, "offset", length, CAST(NULL AS BIGINT) AS replica_length, 'missing' AS damage FROM c WHERE lot < '1'
UNION ALL SELECT file, "offset", length, length, 'changed' FROM c WHERE lot BETWEEN '4' AND '4g'
UNION ALL SELECT file, "offset" + length - 1, NULL, length, 'extra' FROM c WHERE lot BETWEEN '8' AND '8g'
"""


def op2_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def op3_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokens.with_token_counts(table(spark, d, "documents").select("doc_id", "text"))


def op4_pii(spark: SparkSession, d: str) -> DataFrame:
    found = pii.find(table(spark, d, "documents"))

    def count(kind: str):
        own = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.joined(spans, only_base=True), 256).alias("base_sha256"),
        pii.joined(spans).alias("spans"),
    )


# A conversation that holds what templates use as marks.
MARKS = "\\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], own.schema)
    return chat.read_back(chat.format_conversations(own.unionByName(marks)))


OP5_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
    SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS escaped,
           length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS escaped_role
    FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text))
           AS loss_sha256,
       CAST(sum(escaped + escaped_role + 17) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op6_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"))


def op8_embeddings(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, d, "embeddings"))


def op9_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def block_list(pages: DataFrame) -> DataFrame:
    """Canonical URLs to block: those seen on a spam host or with a ``ref`` parameter."""
    url = F.col("url")
    seen = urls.host_of(url).contains("spam") | url.contains("ref=")
    return pages.where(seen).select(urls.canonical(url).alias("url"))


def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    return urls.judge(pages, block_list(pages))


OP10_SQL = r"""
WITH p AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
q AS (
    SELECT *, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path,
           list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '(?s)^(utm_[^=]*|ref)(=|$)'))) AS asked
    FROM p),
r AS (
    SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
              || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS canon
    FROM q),
listed AS (
    SELECT DISTINCT canon AS c FROM r WHERE url IS NOT NULL AND (contains(host, 'spam') OR contains(url, 'ref='))),
ruled AS (
    SELECT r.page_id, r.host, r.path, l.c IS NOT NULL AND r.url IS NOT NULL AS listed,
        CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
             WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
             WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
             WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
             WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
    FROM r LEFT JOIN listed l ON r.canon = l.c)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM ruled
"""


def op11_bpe(spark: SparkSession, d: str) -> DataFrame:
    encoded = bpe.with_ids(table(spark, d, "documents").select("doc_id", "text"))
    read = bpe.with_texts(encoded, text="decoded", keep_ids=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return read.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    return whitening.whitened_components(vectors).withColumn("deviation", F.col("deviation").cast("bigint"))


def faulty(conversations: DataFrame) -> DataFrame:
    """Conversations with damage in known places, by the CRC-32 of id and turn: in one row of
    20 each, the row is gone, its text is empty, its ends of sentences are missing, it is
    there twice, or its role is user. Nulls become a space; ``gone`` marks what was dropped."""
    space = F.lit(" ")
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    lot = F.crc32(named) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    bare = F.translate(text, ".!?", "")
    copies = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(lot == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(lot == 1, F.lit("")).when(lot == 2, bare).otherwise(text).alias("text"),
        (lot == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def op13_repair(spark: SparkSession, d: str) -> DataFrame:
    return repair.audits(faulty(table(spark, d, "conversations")), gone=F.col("gone"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_merkle_audit": op1_merkle_audit,
        "op2_simhash": op2_simhash,
        "op3_token_counts": op3_token_counts,
        "op4_pii": op4_pii,
        "op5_chat_format": op5_chat_format,
        "op6_quality": op6_quality,
        "op7_mixing": op7_mixing,
        "op8_embeddings": op8_embeddings,
        "op9_decontaminate": op9_decontaminate,
        "op10_url_filter": op10_url_filter,
        "op11_bpe": op11_bpe,
        "op12_whitening": op12_whitening,
        "op13_repair": op13_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {"op1_merkle_audit": OP1_SQL, "op5_chat_format": OP5_SQL, "op10_url_filter": OP10_SQL}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
