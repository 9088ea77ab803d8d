"""Sequence dimensions against brute force and against plain windows.

Random ledgers with a hot account (half of all rows), many ties on the
request instant, instants on both sides of midnight, copies and NULLs.
"""

import random

import pytest
from helpers import ledger_df, ledger_row
from pyspark.sql import functions as F

from kontor.functions.windows import (
    account_ever_window,
    account_sequence_window,
    account_trailing_window,
)
from kontor.operators.sequence import sequence_columns, trailing_count

T0 = 1_600_041_600 - 2500  # midnight falls into the rows


def _random_rows(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        acc = 1 if rnd.random() < 0.5 else rnd.randint(2, 9)
        t = T0 + rnd.choice([rnd.randint(0, 5000), rnd.randint(0, 60) * 50])
        rows.append(
            ledger_row(
                acc,
                float(rnd.randint(1, 5)),
                ts=t,
                product=rnd.choice(["pix", "non_pix"]),
                txn_id=rnd.randint(0, 50),
                status=rnd.choice(["completed", "failed"]),
                completed_at=str(t + rnd.randint(0, 9)),
            )
        )
    return rows


def _brute(rows, keys_idx):
    """ever count, previous instant (total order) and trailing counts by loops."""
    out = {}
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(tuple(r[k] for k in keys_idx), []).append(i)
    for idx in groups.values():
        order = sorted(idx, key=lambda i: (rows[i][2], rows[i][11], rows[i][1], rows[i][3], rows[i][4], rows[i][5]))
        for pos, i in enumerate(order):
            t = rows[i][2]
            ever = sum(1 for j in idx if rows[j][2] <= t)
            prev = rows[order[pos - 1]][2] if pos else None
            t24 = sum(1 for j in idx if t - 24 <= rows[j][2] <= t)
            t900 = sum(1 for j in idx if t - 900 <= rows[j][2] <= t)
            out[i] = (ever, prev, t24, t900)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sequence_equals_brute_force(spark, seed):
    rows = _random_rows(seed)
    tagged = [r[:11] + (r[11] * 1000 + i,) for i, r in enumerate(rows)]
    df = ledger_df(spark, tagged)
    keys = ("product", "account_id")
    seq = sequence_columns(df, keys)
    seq = trailing_count(seq, 24, keys, name="c24")
    seq = trailing_count(seq, 900, keys, name="c900")
    got = {
        r.txn_id % 1000: (r.count_txns_orders_per_account_ever, r.last_txn_date, r.c24, r.c900)
        for r in seq.collect()
    }
    want = _brute(tagged, (6, 0))
    assert len(got) == len(rows)
    assert got == want


def test_sequence_equals_plain_windows(spark):
    rows = _random_rows(7, n=600)
    df = ledger_df(spark, rows)
    plain = df.select(
        "*",
        F.count(F.lit(1)).over(account_ever_window()).alias("ever"),
        F.lag("txn_requested_at").over(account_sequence_window()).alias("prev"),
        F.count(F.lit(1)).over(account_trailing_window(86400)).alias("day_count"),
    )
    split = trailing_count(
        sequence_columns(df),
        86400,
        name="day_count",
    ).select(
        *df.columns,
        F.col("count_txns_orders_per_account_ever").alias("ever"),
        F.col("last_txn_date").alias("prev"),
        "day_count",
    )
    assert plain.exceptAll(split).count() == 0
    assert split.exceptAll(plain).count() == 0


def test_copies_and_nulls_equal_plain_windows(spark):
    """Equal rows, equal first rows that differ elsewhere, NULL keys and NULL instants."""
    rows = [r for r in _random_rows(9, n=150)]
    rows = [(None if i % 11 == 0 else r[0], r[1], None if i % 7 == 0 else r[2], *r[3:]) for i, r in enumerate(rows)]
    rows = rows + rows[:60] + rows[:30]
    df = ledger_df(spark, rows)
    plain = df.select(
        "*",
        F.count(F.lit(1)).over(account_ever_window()).alias("ever"),
        F.lag("txn_requested_at").over(account_sequence_window()).alias("prev"),
        F.count(F.lit(1)).over(account_trailing_window(900)).alias("c900"),
    )
    split = trailing_count(sequence_columns(df), 900, name="c900").select(
        *df.columns,
        F.col("count_txns_orders_per_account_ever").alias("ever"),
        F.col("last_txn_date").alias("prev"),
        "c900",
    )
    assert split.count() == len(rows)
    assert plain.exceptAll(split).count() == 0
    assert split.exceptAll(plain).count() == 0
