"""Explicit schemas of the source feeds, the dimension tables and the ledger.

Feeds are read with these schemas instead of inferring them: inference costs an
extra pass over every file and lets one stray value change a column's type.
Instants are epoch seconds. Completion instants are text, since failed rows
carry a non-number (``'None'``, empty or NULL); they are parsed with
``try_cast`` where they are used.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, I = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


ACCOUNTS = _struct(("account_id", L), ("customer_id", L))
CUSTOMERS = _struct(("customer_id", L), ("country_name", S))

TRANSFERS = _struct(
    ("id", L),
    ("account_id", L),
    ("amount", D),
    ("transaction_requested_at", L),
    ("transaction_completed_at", S),
    ("status", S),
)

PIX_MOVEMENTS = _struct(
    ("id", L),
    ("account_id", L),
    ("in_or_out", S),
    ("pix_amount", D),
    ("pix_requested_at", L),
    ("pix_completed_at", S),
    ("status", S),
)

INVESTMENTS = _struct(
    ("id", L),
    ("account_id", L),
    ("amount", D),
    ("investment_requested_at", I),
    ("investment_completed_at", S),
    ("status", S),
    ("type", S),
)

INVESTMENT_ACCOUNTS_TO_SEND = _struct(("account_id", L))

# Nested investments document: one account with an array of transactions whose
# leaves are all text (typing happens when the array is unnested).
NESTED_INVESTMENTS_DDL = """
    account_id STRING,
    transactions ARRAY<STRUCT<
        transaction_id: STRING,
        status: STRING,
        amount: STRING,
        investment_requested_at: STRING,
        investment_completed_at: STRING,
        investment_completed_at_timestamp: DATE,
        type: STRING
    >>
"""

FEED_SCHEMAS = {
    "accounts": ACCOUNTS,
    "customers": CUSTOMERS,
    "transfer_ins": TRANSFERS,
    "transfer_outs": TRANSFERS,
    "pix_movements": PIX_MOVEMENTS,
    "investments": INVESTMENTS,
    "investment_accounts_to_send": INVESTMENT_ACCOUNTS_TO_SEND,
}

# Column order of the normalised event ledger (products_daily_events).
LEDGER_COLUMNS = [
    "account_id",
    "amount",
    "txn_requested_at",
    "txn_completed_at",
    "status",
    "in_or_out",
    "product",
    "country_name",
    "day",
    "month",
    "event_date",
    "txn_id",
]

LEDGER = _struct(
    ("account_id", L),
    ("amount", D),
    ("txn_requested_at", L),
    ("txn_completed_at", S),
    ("status", S),
    ("in_or_out", S),
    ("product", S),
    ("country_name", S),
    ("day", I),
    ("month", S),
    ("event_date", S),
    ("txn_id", L),
)
