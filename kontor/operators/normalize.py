"""Feed normalisation into the event ledger (``products_daily_events``).

Each service feed (pix movements, transfers in, transfers out, investments)
names its columns differently. A ``FeedSpec`` maps them onto the ledger's
names; ``normalize`` applies it, and ``build_ledger`` unions all feeds by name
and attaches the account's country with a single left join.

Plan shape: every feed is a narrow scan + projection; the union is narrow;
the one join to the pre-joined account dimension is a broadcast hash join when
the dimension's measured size allows it, else one shuffle join (AQE splits a
skewed account). Dimension joins are left joins, so events of unknown accounts
or customers stay in the ledger with a NULL country.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.functions.columns import calendar_columns, direction
from kontor.operators.joins import (
    DEFAULT_MAX_BROADCAST_BYTES,
    broadcast_if_small,
    measured_bytes_many,
)
from kontor.schemas import LEDGER_COLUMNS

# Product tags and the constant raw directions of the transfers.
PRODUCT_PIX = "pix"
PRODUCT_NON_PIX = "non_pix"
PRODUCT_INVESTMENTS = "investments"
RAW_TRANSFER_IN = "non_pix_in"
RAW_TRANSFER_OUT = "non_pix_out"


@dataclass(frozen=True)
class FeedSpec:
    """Column mapping of one feed onto the ledger. Strings only.

    ``direction`` names the column with the raw direction text; a feed
    without one (transfers) gives a constant ``direction_literal`` instead.
    ``txn_id`` is optional; it is carried as a deterministic tie-breaker.
    """

    product: str
    requested_at: str
    completed_at: str
    amount: str = "amount"
    account_id: str = "account_id"
    status: str = "status"
    direction: str | None = "in_or_out"
    direction_literal: str | None = None
    txn_id: str | None = "id"


PIX_SPEC = FeedSpec(
    product=PRODUCT_PIX,
    amount="pix_amount",
    requested_at="pix_requested_at",
    completed_at="pix_completed_at",
)
TRANSFER_IN_SPEC = FeedSpec(
    product=PRODUCT_NON_PIX,
    requested_at="transaction_requested_at",
    completed_at="transaction_completed_at",
    direction=None,
    direction_literal=RAW_TRANSFER_IN,
)
TRANSFER_OUT_SPEC = FeedSpec(
    product=PRODUCT_NON_PIX,
    requested_at="transaction_requested_at",
    completed_at="transaction_completed_at",
    direction=None,
    direction_literal=RAW_TRANSFER_OUT,
)
INVESTMENTS_SPEC = FeedSpec(
    product=PRODUCT_INVESTMENTS,
    requested_at="investment_requested_at",
    completed_at="investment_completed_at",
    direction="type",
)


def normalize(feed: DataFrame, spec: FeedSpec) -> DataFrame:
    """Project one feed onto the ledger columns (without the country)."""
    raw_direction = F.col(spec.direction) if spec.direction else F.lit(spec.direction_literal)
    requested = F.col(spec.requested_at).cast("bigint")
    return feed.select(
        F.col(spec.account_id).cast("bigint").alias("account_id"),
        F.col(spec.amount).cast("double").alias("amount"),
        requested.alias("txn_requested_at"),
        F.col(spec.completed_at).cast("string").alias("txn_completed_at"),
        F.col(spec.status).cast("string").alias("status"),
        direction(raw_direction).alias("in_or_out"),
        F.lit(spec.product).alias("product"),
        *[c.alias(n) for n, c in calendar_columns(requested).items()],
        (F.col(spec.txn_id).cast("bigint") if spec.txn_id else F.lit(None).cast("bigint")).alias(
            "txn_id"
        ),
    )


def account_dimension(
    accounts: DataFrame, customers: DataFrame, broadcast_customers: bool = False
) -> DataFrame:
    """account_id -> country_name, pre-joined once for all feeds.

    ``accounts LEFT JOIN customers`` keeps accounts whose customer is missing
    (country NULL), which is what the per-feed chain of two left joins gives.
    """
    cust = customers.select("customer_id", "country_name")
    return accounts.select("account_id", "customer_id").join(
        F.broadcast(cust) if broadcast_customers else cust, "customer_id", "left"
    ).select("account_id", "country_name")


def attach_country(
    events: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left join of the events to account -> country.

    One job sizes the account keys and the customers side. The customers side is
    broadcast into the dimension pre-join when it fits. The account keys are a lower
    bound of the dimension: only where they fit is it measured itself (a second job
    over the small sides) and broadcast if it fits too; beyond, the events join it by
    shuffle.
    """
    keys, sides = measured_bytes_many(
        [accounts.select("account_id"), customers.select("customer_id", "country_name")]
    )
    dims = account_dimension(accounts, customers, sides <= max_broadcast_bytes)
    if keys <= max_broadcast_bytes:
        dims, _ = broadcast_if_small(dims, max_broadcast_bytes)
    return events.join(dims, "account_id", "left")


def union_feeds(normalized: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, normalized)


def build_events(feeds: list[tuple[DataFrame, FeedSpec]]) -> DataFrame:
    """The ledger's rows without the country: what the reports that group by account,
    month or product need (no dimension is read)."""
    return union_feeds([normalize(df, spec) for df, spec in feeds])


def build_ledger(
    feeds: list[tuple[DataFrame, FeedSpec]],
    accounts: DataFrame,
    customers: DataFrame,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Union all feeds by name and attach the country: the whole ledger."""
    events = build_events(feeds)
    return attach_country(events, accounts, customers, max_broadcast_bytes).select(
        *LEDGER_COLUMNS
    )


def normalize_feed(
    feed: DataFrame,
    spec: FeedSpec,
    accounts: DataFrame,
    customers: DataFrame,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """One feed, normalised and enriched: the per-feed ledger slice."""
    return attach_country(normalize(feed, spec), accounts, customers, max_broadcast_bytes).select(
        *LEDGER_COLUMNS
    )
