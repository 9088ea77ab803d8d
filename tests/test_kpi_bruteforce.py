"""The monthly KPI series against a plain-Python computation on random ledgers."""

import math
import random

import pytest
from helpers import ledger_df, ledger_row

from kontor.functions.metrics import KPI_METRICS
from kontor.plans import reports as R

T0 = 1_590_969_600  # 2020-06-01


def _random(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(250):
        t = T0 + rnd.choice([rnd.randint(0, 90 * 86400), rnd.randint(0, 40) * 3600])
        status = rnd.choice(["completed", "completed", "failed", "pending"])
        done = {"completed": str(t + rnd.randint(0, 300)), "failed": rnd.choice(["None", "", None])}.get(status)
        rows.append(
            ledger_row(
                rnd.randint(1, 6), float(rnd.randint(1, 900)) / 4, ts=t, completed_at=done, status=status,
                in_or_out=rnd.choice(["in", "out"]), product="pix", txn_id=rnd.randint(0, 30),
            )
        )
    return rows


def _num(x):
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


def _brute(rows):
    by_acc = {}
    for i, r in enumerate(rows):
        by_acc.setdefault(r[0], []).append(i)
    ever, prev = {}, {}
    for idx in by_acc.values():
        order = sorted(idx, key=lambda i: (rows[i][2], rows[i][11], rows[i][1], rows[i][3] or "", rows[i][4], rows[i][5]))
        for pos, i in enumerate(order):
            ever[i] = sum(1 for j in idx if rows[j][2] <= rows[i][2])
            prev[i] = rows[order[pos - 1]][2] if pos else None
    months = {}
    for i, r in enumerate(rows):
        months.setdefault(r[9], []).append(i)
    out = {}
    for m, idx in months.items():
        amt = [rows[i][1] for i in idx]
        done = sum(rows[i][1] for i in idx if rows[i][4] == "completed")
        failed = sum(rows[i][1] for i in idx if rows[i][4] == "failed")
        ttc = [_num(rows[i][3]) - rows[i][2] for i in idx if _num(rows[i][3]) is not None]
        rec = [(_num(rows[i][3]) - prev[i]) / 86400 for i in idx if _num(rows[i][3]) is not None and prev[i] is not None]
        srt = sorted(ttc)

        def pct(p):
            return srt[max(0, math.ceil(p * len(srt)) - 1)] if srt else None

        out[m] = {
            "total_amount": sum(amt),
            "total_amount_completed": done,
            "total_amount_failed": failed,
            "fail_rate": round(failed / done, 2) if done else None,
            "completed_rate": round(done / sum(amt), 2) if sum(amt) else None,
            "avg_time_to_completed": sum(ttc) / len(ttc) if ttc else None,
            "avg_recency": sum(rec) / len(rec) if rec else None,
            "total_orders": len(idx),
            "total_first_txn_orders": sum(1 for i in idx if ever[i] == 1),
            "atv": sum(amt) / len(amt),
            "p99": pct(0.99),
            "p90": pct(0.90),
        }
    return out


def _close(a, b, name):
    if a is None or b is None:
        return a is None and b is None
    if name in ("fail_rate", "completed_rate"):
        return abs(a - b) <= 0.01 + 1e-9  # rounding of a double quotient at a half may differ
    return abs(a - b) <= 1e-6 * max(1.0, abs(b))


@pytest.mark.parametrize("seed", [11, 12])
def test_kpis_match_brute_force(spark, seed):
    rows = _random(seed)
    got = {
        r["month"]: r.asDict()
        for r in R.kpi_series(ledger_df(spark, rows), KPI_METRICS, products=["pix"], by_product=False).collect()
    }
    want = _brute(rows)
    assert got.keys() == want.keys()
    for m in want:
        for k, v in want[m].items():
            assert _close(got[m][k], v, k), (m, k, got[m][k], v)
