"""The payment feeds in one relation, and the account monthly balance, in Spark SQL.

The raw feeds are passed as DataFrame parameters of ``spark.sql`` (no global view
names). Columns are listed by name, so feeds with another column order line up. The
year filter compares the raw epoch column with two constants (half-open, UTC), so it
reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.functions.columns import STATUS_COMPLETED
from kontor.operators.filters import epoch_half_open

RAW_COLUMNS = ("id", "account_id", "amount", "transaction_requested_at", "transaction_completed_at", "status")

_TRANSFERS = "SELECT {columns}, '{tag}' AS in_or_out, 'non_pix' AS type FROM {{{feed}}}"
# One feed with both directions: its raw direction decides the tag.
_BOTH_WAYS = (
    "SELECT {columns}, CASE WHEN in_or_out = 'non_pix_in' THEN 'transfer_in' ELSE 'transfer_out' END AS in_or_out,"
    " 'non_pix' AS type FROM {{{feed}}}"
)
_PIX = (
    "SELECT id, account_id, pix_amount AS amount, pix_requested_at AS transaction_requested_at,"
    " pix_completed_at AS transaction_completed_at, status, in_or_out, 'pix' AS type FROM {pix_movements}"
)

# Month 1-12 of the request instant (UTC): unambiguous within one year. Both sums
# are taken once; the balance is their difference.
_BALANCE_SQL = """
SELECT month AS Month, account AS Customer, money_in AS TotalTransferIn, money_out AS TotalTransferOut,
       money_in - money_out AS AccountMonthlyBalance
FROM (
    SELECT month(date_from_unix_date(CAST(floor(transaction_requested_at / 86400) AS INT))) AS month,
           account_id AS account,
           sum(if(in_or_out LIKE '%in%', amount, 0)) AS money_in,
           sum(if(in_or_out LIKE '%out%', amount, 0)) AS money_out
    FROM {payments}
    GROUP BY ALL)
"""


def raw_union_all(
    spark: SparkSession,
    transfer_ins: DataFrame | None,
    transfer_outs: DataFrame | None,
    pix_movements: DataFrame,
    transfers: DataFrame | None = None,
) -> DataFrame:
    """The payment feeds in one relation, tagged with direction and type. Transfers come
    as two feeds, or as one (``transfers``) with the raw direction in ``in_or_out``, which
    is then read once."""
    columns = ", ".join(RAW_COLUMNS)
    feeds = {"pix_movements": pix_movements}
    if transfers is not None:
        parts = [_BOTH_WAYS.format(columns=columns, feed="transfers")]
        feeds["transfers"] = transfers
    else:
        parts = [
            _TRANSFERS.format(columns=columns, tag="transfer_in", feed="transfer_ins"),
            _TRANSFERS.format(columns=columns, tag="transfer_out", feed="transfer_outs"),
        ]
        feeds |= {"transfer_ins": transfer_ins, "transfer_outs": transfer_outs}
    return spark.sql(" UNION ALL ".join([*parts, _PIX]), **feeds)


def account_monthly_balance_sql(
    spark: SparkSession,
    transfer_ins: DataFrame | None,
    transfer_outs: DataFrame | None,
    pix_movements: DataFrame,
    year: int = 2020,
    transfers: DataFrame | None = None,
) -> DataFrame:
    """Month, Customer, TotalTransferIn, TotalTransferOut, AccountMonthlyBalance
    of completed payments requested in ``year`` (UTC, half-open year)."""
    payments = raw_union_all(spark, transfer_ins, transfer_outs, pix_movements, transfers)
    wanted = epoch_half_open("transaction_requested_at", f"{year}-01-01", f"{year + 1}-01-01")
    return spark.sql(_BALANCE_SQL, payments=payments.where(wanted & (F.col("status") == STATUS_COMPLETED)))
