"""URL filter: path rules first, then a list of canonical URLs behind a blocked Bloom filter.

The list is hashed into a blocked Bloom filter (split blocks: a URL picks one
block of eight 32-bit words and sets one bit in each). The filter is a table of
one row per block, built by one aggregation, so it grows with the list and no
task ever holds it whole. A page's URL is looked up in its block; the few that
pass (every listed URL and about one in a thousand others) meet the list itself
in an exact hash join, which removes the false positives. Pages that fail the
filter, or have no URL, never reach that join.

Only DataFrame functions are used. The filter is broadcast up to a checked size,
so pages are not shuffled for the look-up. The sides that pages meet in a join
hold each block or URL once, so where one listed URL is that of very many pages
AQE may split its partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Odd multipliers, one for each word of a block (those of the Parquet format).
SALTS = (
    0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D,
    0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31,
)
BITS_PER_URL = 16
BLOCK_BITS = 32 * len(SALTS)
# A filter up to this many bytes is broadcast; a larger one is joined by a shuffle.
MAX_BROADCAST_BYTES = 32 << 20
# Bytes of one block as a row.
BLOCK_BYTES = 8 * (len(SALTS) + 2)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for URLs whose host is ``host`` or a subdomain of it and whose path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one, or for null."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without a leading ``www.``, path without trailing slashes, query
    without ``utm_`` and ``ref`` parameters, no scheme, no fragment. Null for null."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_after_scheme(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"(?s)^(utm_[^=]*|ref)(=|$)"))
    asked = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit("")))
    return F.when(url.isNotNull(), whole)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def _by_rule(rules: Sequence[Rule], host: Column, path: Column, of: str) -> Column:
    """Attribute ``of`` of the longest rule that fits; of equally long ones the first by name."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        out = F.when(_fits(rule, host, path), F.lit(getattr(rule, of))).otherwise(out)
    return out


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(key, 32), F.lit(blocks)).cast("bigint")


def _bit(key: Column, salt: int) -> Column:
    """The one bit that a key sets in the word of a salt."""
    low = key.bitwiseAND(F.lit(0x7FFFFFFF))  # the product stays below 2^63
    place = F.shiftright((low * F.lit(salt)).bitwiseAND(F.lit(0xFFFFFFFF)), 27)
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _key(url: Column) -> Column:
    return F.xxhash64(url)


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the different values of ``listed``'s column ``url``."""
    key = _key(F.col("url"))
    return listed.groupBy(_block(key, blocks).alias("block")).agg(
        *[F.bit_or(_bit(key, salt)).alias(f"w{i}") for i, salt in enumerate(SALTS)]
    )


def blocks_for(listed: int) -> int:
    return max(1, -(-listed * BITS_PER_URL // BLOCK_BITS))


def with_possible_hit(urls: DataFrame, listed: DataFrame, blocks: int, flag: str = "possible") -> DataFrame:
    """``urls`` (column ``url``) with a flag: whether the URL passes the filter of ``listed``."""
    bloom = bloom_filter(listed, blocks)
    if blocks * BLOCK_BYTES <= MAX_BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    key = _key(F.col("url"))
    held = F.lit(True)
    for i, salt in enumerate(SALTS):
        held = held & (F.col(f"w{i}").bitwiseAND(_bit(key, salt)) != 0)
    looked_up = urls.withColumn("block", _block(key, blocks)).join(bloom, "block", "left")
    return looked_up.select(*urls.columns, F.coalesce(held, F.lit(False)).alias(flag))


def possible_hits(urls: DataFrame, listed: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``urls`` (column ``url``) that pass the filter of ``listed``."""
    return with_possible_hit(urls, listed, blocks).where("possible").select(*urls.columns)


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule] = RULES,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed), one row for each row of ``pages``.

    ``listed`` has a column ``url`` of canonical URLs to block (nulls and repeats
    change nothing). The verdict is that of the longest fitting rule, else
    ``block`` for a listed URL and ``allow`` for any other. A null URL or one
    without ``://`` has an empty host and path; a null URL is never listed. Other
    columns of ``pages`` are ignored; no pages give no rows.
    """
    wanted = listed.select(F.col("url")).where(F.col("url").isNotNull()).distinct()
    blocks = blocks_for(wanted.count())
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("raw"), canonical(F.col(f"`{url}`")).alias("url")
    )
    known = with_possible_hit(rows.where(F.col("url").isNotNull()), wanted, blocks)
    hits = wanted.withColumn("hit", F.lit(True))
    found = known.where("possible").drop("possible").join(hits, "url", "left")
    others = known.where(~F.col("possible")).drop("possible").unionByName(rows.where(F.col("url").isNull()))
    host, path = host_of(F.col("raw")), path_of(F.col("raw"))
    return (
        found.unionByName(others.withColumn("hit", F.lit(False)))
        .select(
            "page_id",
            host.alias("host"),
            path.alias("path"),
            F.coalesce("hit", F.lit(False)).alias("listed"),
        )
        .withColumn("rule", _by_rule(rules, F.col("host"), F.col("path"), "name"))
        .withColumn("by_rule", _by_rule(rules, F.col("host"), F.col("path"), "verdict"))
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("by_rule", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
            "listed",
        )
    )
