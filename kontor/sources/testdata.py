"""Adapter from the generated star-schema tables to the ledger's source feeds.

The benchmark tables (customer, nation, orders, lineitem, events) stand in for
the service databases. Every feed is derived from whole tables, column by
column; nothing is sampled. The same derivation is written in DuckDB SQL in
``__spark_entry__.oracle_sql`` for the correctness check.

| feed                         | derived from                                   |
| ---------------------------- | ---------------------------------------------- |
| accounts                     | customer (HOUSEHOLD ones under other ids)       |
| customers                    | customer x nation (region 4 under other ids)    |
| pix_movements                | events, from 1996-01 on, spread over 12 months  |
| transfer_ins / transfer_outs | lineitem x orders, return flag R goes out       |
| investments                  | orders                                          |
| nested investments           | accounts x investments, one document an account |
| investment_accounts_to_send  | customer, segment AUTOMOBILE                    |

Rows under other ids (offset by ``UNKNOWN_OFFSET``) give events of unknown accounts
and accounts of unknown customers, whose ledger rows keep a NULL country. The moved
accounts have no transactions: their documents have an empty array, or none at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.functions.columns import STATUS_COMPLETED, STATUS_FAILED, seconds_of

# Fixed values of the adapter.
CUSTOMER_ID_OFFSET = 1000000
PIX_SHIFT_SECONDS = 883612800  # 10,227 days: 2024-01-01 -> 1996-01-01
COMPLETION_LAG_MODULUS = 997  # completion delay in seconds = key % 997
UNKNOWN_OFFSET = 1000000000
ACCOUNTLESS_SEGMENT = "HOUSEHOLD"
CUSTOMERLESS_REGION = 4
PIX_MONTHS = 12
PIX_MONTH_SECONDS = 2592000  # 30 days
PIX_FAILED_MONTH = 11  # nothing completes in the last month
COHORT_SEGMENT = "AUTOMOBILE"
PIX_IN_EVENT_TYPES = ("view", "signup")
PIX_FAILED_EVENT_TYPE = "error"
PIX_PENDING_EVENT_TYPE = "signup"
TRANSFER_OUT_RETURNFLAG = "R"
INVESTMENT_IN_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")
RAW_INVESTMENT_IN = "investment_transfer_in"
RAW_INVESTMENT_OUT = "investment_transfer_out"
STATUS_PENDING = "pending"
NOT_COMPLETED_TEXT = "None"


# The columns read here; with a schema given, opening a table takes no job.
SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string,"
    " l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _completed_text(status: F.Column, requested: F.Column, key: F.Column, otherwise: F.Column):
    """Completion instant as text: requested + key % 997 once completed."""
    return F.when(
        status == STATUS_COMPLETED,
        (requested + key % COMPLETION_LAG_MODULUS).cast("string"),
    ).otherwise(otherwise)


@dataclass(frozen=True)
class Feeds:
    """The feeds of a folder; each is opened when it is asked for."""

    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name not in _FEEDS:
            raise AttributeError(name)
        return _FEEDS[name](self.spark, self.sf_dir)

    @property
    def transfer_ins(self) -> DataFrame:
        return self.transfers.where(F.col("in_or_out") == "non_pix_in").drop("in_or_out")

    @property
    def transfer_outs(self) -> DataFrame:
        return self.transfers.where(F.col("in_or_out") == "non_pix_out").drop("in_or_out")


def _moved(unknown: F.Column, key: F.Column) -> F.Column:
    return key + F.when(unknown, F.lit(UNKNOWN_OFFSET)).otherwise(F.lit(0))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        _moved(F.col("c_mktsegment") == ACCOUNTLESS_SEGMENT, F.col("c_custkey")).alias("account_id"),
        (F.col("c_custkey") + CUSTOMER_ID_OFFSET).alias("customer_id"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        _moved(F.col("n_regionkey") == CUSTOMERLESS_REGION, F.col("c_custkey") + CUSTOMER_ID_OFFSET).alias(
            "customer_id"
        ),
        F.col("n_name").alias("country_name"),
    )


def pix_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    month = F.col("event_id") % PIX_MONTHS
    requested = seconds_of("ts") - F.lit(PIX_SHIFT_SECONDS) + month * F.lit(PIX_MONTH_SECONDS)
    status = (
        F.when((F.col("event_type") == PIX_FAILED_EVENT_TYPE) | (month == PIX_FAILED_MONTH), F.lit(STATUS_FAILED))
        .when(F.col("event_type") == PIX_PENDING_EVENT_TYPE, F.lit(STATUS_PENDING))
        .otherwise(F.lit(STATUS_COMPLETED))
    )
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("account_id"),
        F.when(F.col("event_type").isin(*PIX_IN_EVENT_TYPES), F.lit("pix_in"))
        .otherwise(F.lit("pix_out"))
        .alias("in_or_out"),
        F.col("value").alias("pix_amount"),
        requested.alias("pix_requested_at"),
        _completed_text(
            status,
            requested,
            F.col("event_id"),
            F.when(status == STATUS_FAILED, F.lit(NOT_COMPLETED_TEXT)),
        ).alias("pix_completed_at"),
        status.alias("status"),
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    requested = seconds_of("l_shipdate")
    status = F.when(F.col("l_linestatus") == "F", F.lit(STATUS_COMPLETED)).otherwise(
        F.lit(STATUS_FAILED)
    )
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").alias("account_id"),
        F.col("l_extendedprice").alias("amount"),
        requested.alias("transaction_requested_at"),
        _completed_text(status, requested, F.col("l_orderkey"), F.lit(NOT_COMPLETED_TEXT)).alias(
            "transaction_completed_at"
        ),
        status.alias("status"),
        F.when(F.col("l_returnflag") == TRANSFER_OUT_RETURNFLAG, F.lit("non_pix_out"))
        .otherwise(F.lit("non_pix_in"))
        .alias("in_or_out"),
    )


def investments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    requested = seconds_of("o_orderdate")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit(STATUS_COMPLETED))
        .when(F.col("o_orderstatus") == "O", F.lit(STATUS_FAILED))
        .otherwise(F.lit(STATUS_PENDING))
    )
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_totalprice").alias("amount"),
        requested.cast("int").alias("investment_requested_at"),
        _completed_text(
            status,
            requested,
            F.col("o_orderkey"),
            F.when(status == STATUS_FAILED, F.lit(NOT_COMPLETED_TEXT)).otherwise(F.lit("")),
        ).alias("investment_completed_at"),
        status.alias("status"),
        F.when(F.col("o_orderpriority").isin(*INVESTMENT_IN_PRIORITIES), F.lit(RAW_INVESTMENT_IN))
        .otherwise(F.lit(RAW_INVESTMENT_OUT))
        .alias("type"),
    )


def nested_investments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Investments as nested documents: account_id + array of text structs.

    One document per account, as the source has them; accounts without a
    transaction have an empty array, or none (NULL) where their id is odd.
    """
    inv = investments(spark, sf_dir)
    txn = F.struct(
        F.col("id").cast("string").alias("transaction_id"),
        F.col("status").alias("status"),
        F.col("amount").cast("string").alias("amount"),
        F.col("investment_requested_at").cast("string").alias("investment_requested_at"),
        F.col("investment_completed_at").alias("investment_completed_at"),
        F.lit(None).cast("date").alias("investment_completed_at_timestamp"),
        F.col("type").alias("type"),
    )
    documents = inv.groupBy("account_id").agg(F.collect_list(txn).alias("transactions"))
    owners = accounts(spark, sf_dir).select(F.col("account_id").alias("owner"))
    empty = F.when(F.col("owner") % 2 == 0, F.array().cast(documents.schema["transactions"].dataType))
    return owners.join(documents, F.col("owner") == F.col("account_id"), "full_outer").select(
        F.coalesce("account_id", "owner").cast("string").alias("account_id"),
        F.coalesce("transactions", empty).alias("transactions"),
    )


def investment_accounts_to_send(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_mktsegment") == COHORT_SEGMENT).select(
        F.col("c_custkey").alias("account_id")
    )


_FEEDS = {
    "accounts": accounts,
    "customers": customers,
    "pix_movements": pix_movements,
    "transfers": transfers,
    "investments": investments,
    "investment_accounts_to_send": investment_accounts_to_send,
}


def load_feeds(spark: SparkSession, sf_dir: str) -> Feeds:
    return Feeds(spark, sf_dir)
