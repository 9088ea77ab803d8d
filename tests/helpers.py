"""Hand-made ledger and feed rows for tests."""

from __future__ import annotations

import calendar
import datetime as dt

from kontor.schemas import LEDGER


def epoch(day: str, hh: int = 12, mm: int = 0, ss: int = 0) -> int:
    d = dt.date.fromisoformat(day)
    return calendar.timegm(dt.datetime(d.year, d.month, d.day, hh, mm, ss).timetuple())


def ledger_row(
    account_id=1,
    amount=10.0,
    ts=None,
    day="2020-01-15",
    completed_at=None,
    status="completed",
    in_or_out="in",
    product="investments",
    country_name="BR",
    txn_id=None,
):
    t = epoch(day) if ts is None else ts
    d = dt.datetime.fromtimestamp(t, dt.timezone.utc).date()
    done = str(t + 5) if completed_at is None and status == "completed" else completed_at
    return (
        account_id,
        float(amount),
        t,
        done,
        status,
        in_or_out,
        product,
        country_name,
        d.day,
        d.strftime("%Y-%m"),
        d.isoformat(),
        txn_id,
    )


def ledger_df(spark, rows):
    return spark.createDataFrame(rows, LEDGER)
