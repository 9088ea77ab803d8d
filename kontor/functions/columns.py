"""Row-level Column expressions used by the ledger normalisation.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and can be pushed towards the scan where Catalyst allows.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the ledger model.
DIRECTION_IN = "in"
DIRECTION_OUT = "out"
# A raw direction counts as "in" when it matches this LIKE pattern: "in" with at
# least one character before it. "pix_in", "non_pix_in" and
# "investment_transfer_in" match; "investment_transfer_out" does not (its only
# "in" starts the word), and NULL falls to "out".
DIRECTION_IN_PATTERN = "%_in%"
STATUS_COMPLETED = "completed"
STATUS_FAILED = "failed"
SECONDS_PER_DAY = 86400


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def direction(raw: str | Column) -> Column:
    """Normalise a raw direction/type text to ``in`` / ``out``."""
    return F.when(col_of(raw).like(DIRECTION_IN_PATTERN), F.lit(DIRECTION_IN)).otherwise(
        F.lit(DIRECTION_OUT)
    )


def try_long(c: str | Column) -> Column:
    """Text or number to bigint; non-numeric text ('None', '') gives NULL.

    Equal to ``try_cast``, which signals a failed parse internally with an
    exception: that path costs ~20x a successful cast, and failed rows
    ('None' on every failed transaction) are common. Text without any digit
    can never parse, so it skips the cast.
    """
    x = col_of(c)
    return F.when(x.cast("string").rlike("[0-9]"), x.try_cast("bigint"))


def utc_date(epoch_seconds: str | Column) -> Column:
    """Calendar date (UTC) of an epoch-seconds instant: the floor of its days.

    Equal to the date part of ``from_unixtime`` in a UTC session, but neither
    formats a string per row nor depends on the session time zone.
    """
    return F.date_from_unix_date(F.floor(col_of(epoch_seconds) / F.lit(SECONDS_PER_DAY)).cast("int"))


def calendar_columns(epoch_seconds: str | Column) -> dict[str, Column]:
    """``day`` (int), ``month`` ('yyyy-MM') and ``event_date`` ('yyyy-MM-dd')."""
    d = utc_date(epoch_seconds)
    text = d.cast("string")  # yyyy-MM-dd
    return {"day": F.dayofmonth(d), "month": F.substring(text, 1, 7), "event_date": text}


def epoch_of(day: str) -> int:
    """Epoch seconds of 'yyyy-MM-dd' 00:00 UTC, computed on the driver once."""
    return calendar.timegm(dt.date.fromisoformat(day).timetuple())


def seconds_of(ts: str | Column) -> Column:
    """Epoch seconds (floor) of a timestamp / timestamp_ntz read as UTC."""
    return F.unix_timestamp(col_of(ts))
