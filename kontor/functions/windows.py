"""Window specifications over the ledger.

These are the plain per-account windows. They put all rows of an account into
one window partition; for transaction-level windows on data where one account
may hold a large share of all rows use ``kontor.operators.sequence`` instead,
which works on per-instant aggregates and gives the same results.
Windows over the daily aggregate (investments) are bounded by the number of
active days per account and stay plain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Window, WindowSpec
from pyspark.sql import functions as F

ACCOUNT_KEYS = ("account_id",)

# Ledger columns that make the transaction order total: rows equal on all of
# them are interchangeable in every output.
TIE_BREAKERS = ("txn_id", "amount", "txn_completed_at", "status", "in_or_out")


def account_window(keys: Sequence[str] = ACCOUNT_KEYS) -> WindowSpec:
    """Per account, ordered by request instant, default frame (W1)."""
    return Window.partitionBy(*keys).orderBy(F.col("txn_requested_at"))


def account_sequence_window(keys: Sequence[str] = ACCOUNT_KEYS) -> WindowSpec:
    """Per account, total order: request instant then every tie-breaker.

    Used by ``lag``: with ties on the instant the previous row must not depend
    on the physical row order.
    """
    order = [F.col("txn_requested_at").asc_nulls_first()] + [
        F.col(c).asc_nulls_first() for c in TIE_BREAKERS
    ]
    return Window.partitionBy(*keys).orderBy(*order)


def account_ever_window(keys: Sequence[str] = ACCOUNT_KEYS) -> WindowSpec:
    """RANGE unbounded preceding .. current row (W2): rows tied on the instant
    are peers and count each other."""
    return account_window(keys).rangeBetween(Window.unboundedPreceding, Window.currentRow)


def account_trailing_window(seconds: int, keys: Sequence[str] = ACCOUNT_KEYS) -> WindowSpec:
    """RANGE of the last ``seconds`` seconds up to the current row (W3)."""
    return (
        Window.partitionBy(*keys)
        .orderBy(F.col("txn_requested_at").cast("long"))
        .rangeBetween(-int(seconds), Window.currentRow)
    )


def daily_lag_window(keys: Sequence[str] = ACCOUNT_KEYS) -> WindowSpec:
    """Per account over daily rows, ordered by date (W6)."""
    return Window.partitionBy(*keys).orderBy(F.col("event_date"))


def daily_cumulative_window(keys: Sequence[str] = ACCOUNT_KEYS) -> WindowSpec:
    """Running frame over daily rows (W7)."""
    return daily_lag_window(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
