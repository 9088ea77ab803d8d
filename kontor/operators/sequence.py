"""Per-account transaction sequence dimensions from per-instant aggregates.

A plain ``Window.partitionBy("account_id")`` sends every row of an account to one
task. Here no window ever runs over transactions:

1. the rows are counted per (keys, instant) by hash aggregates over fixed-width values
   with partial sums on the map side, so a burst of one account, or a single second with
   very many rows, collapses before the shuffle. The aggregate also finds the least
   transaction id of an instant, which names its first row, and whether several rows may
   have it;
2. running counts over the instants, in two steps: within a stretch of 2^24 seconds (``STRETCH_BITS``)
   and over the stretches of an account. Both window partitions are bounded by the
   calendar, whatever the account's rows; they and the stretches' totals share one
   exchange. Trailing counts need no totals: a stretch also holds the instants before it
   that its frames can reach;
3. one join on (keys, instant) gives each row its numbers. Its small side has one
   row per key, so AQE can split the partition of an instant that holds very many
   rows.

Everything a row needs is a function of its instant: the ever count is the
running count, a trailing count is the difference of two running counts, and the previous
row's instant is the row's own instant unless the row is the first of its instant. The
further tie-breakers are looked at only where the least id may stand twice in an instant:
those rows, found before any join, are counted and laid out again, never ordered, and
exactly one copy is first. Where there are none, AQE drops that branch.

Keys and instants that are NULL are given stand-ins beside a mask of what was NULL, so
that all joins and groups are plain equalities on one partitioning. Results equal the
plain windows (``kontor.functions.windows``), ties and NULL instants (ordered first,
peers of each other) included.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from kontor.functions.columns import SECONDS_PER_DAY, try_long
from kontor.functions.windows import ACCOUNT_KEYS, TIE_BREAKERS

DIMENSION_COLUMNS = [
    "txn_requested_at_ts",
    "txn_completed_at_ts",
    "time_to_complete_in_seconds",
    "count_txns_orders_per_account_ever",
    "last_txn_date",
    "time_from_last_txn_in_days",
]

INSTANT = "txn_requested_at"


# A stretch has 2^24 seconds (194 days): a window partition holds as many instants at most.
STRETCH_BITS = 24
# Stands for a NULL instant: below every real one.
NO_INSTANT = -(1 << 62)


def _ordered(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Numbers before texts: sorting then compares few texts."""
    return sorted(keys, key=lambda k: not isinstance(df.schema[k].dataType, NumericType))


def _names(keys: Sequence[str]) -> list[str]:
    return [*[f"_k{i}" for i in range(len(keys))], "_nulls"]


def _reads(columns: Sequence[str]) -> Column:
    """0 in every row, after a look at all of ``columns``. Two uses of the same rows share
    their exchange only where both need the same columns of it; a count would not do, as that
    of a column that is never NULL reads nothing."""
    return F.pmod(F.xxhash64(*columns), F.lit(1))


def _place(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Keys, NULL mask and instant of a row as values that are never NULL."""

    def stand_in(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, NumericType):
            return F.coalesce(F.col(name), F.lit(0).cast(kind))
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    mask = reduce(lambda a, b: a + b, [F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)])
    columns = [*[stand_in(k) for k in keys], mask]
    instant = F.coalesce(F.col(INSTANT).cast("bigint"), F.lit(NO_INSTANT))
    return [c.alias(n) for c, n in zip([*columns, instant], [*_names(keys), "_t"])]


def _instants(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _t, _n): rows of each instant."""
    return df.where(_reads(df.columns) == 0).groupBy(*_place(df, keys)).agg(F.count(F.lit(1)).alias("_n"))


def _first_of_instants(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _t, _n, _id, _state): rows of each instant and which of them is the first.
    State 0: it stands alone; 1: the only row with ``_id``, the least id (NULL before all);
    2: several rows may have that id. One aggregate over fixed-width values; an id is
    carried on only where it decides."""
    own = F.col(TIE_BREAKERS[0])
    found = df.where(_reads(df.columns) == 0).groupBy(*_place(df, keys)).agg(
        F.count(F.lit(1)).alias("_n"), F.count(own).alias("_with"), F.min(own).alias("_low"), F.max(own).alias("_high")
    )
    alone, without = F.col("_n") == 1, F.col("_n") - F.col("_with")
    two = (F.col("_n") == 2) & (without == 0) & (F.col("_low") < F.col("_high"))
    state = F.when(alone, 0).when((without == 1) | two, 1).otherwise(2).cast("tinyint")
    least = F.when(~alone & (without == 0), F.col("_low"))
    return found.select(*_names(keys), "_t", "_n", least.alias("_id"), state.alias("_state"))


def _running(instants: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``instants`` with ``_ever`` (rows up to the instant) and ``_prev`` (the instant before)."""
    by = _names(keys)
    kept = [c for c in instants.columns if c not in (*by, "_t")]
    read = [c for c in kept if c != "_n"]
    points = instants.withColumn("_stretch", F.shiftright("_t", STRETCH_BITS)).repartition(*by, "_stretch")
    # Both uses of the points share one exchange: where the running counts are not asked for,
    # neither reads ``_n``.
    totals = points.groupBy(*by, "_stretch").agg(
        F.sum("_n").alias("_rows"), F.max("_t").alias("_last"), F.max(_reads(["_t", *read])).alias("_read")
    ).where("_read = 0")
    earlier = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *by,
        "_stretch",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.max("_last").over(earlier).alias("_last_before"),
    )
    order = Window.partitionBy(*by, "_stretch").orderBy("_t")
    placed = points.select(
        "*",
        F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_so_far"),
        F.max("_t").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev_here"),
    )
    return placed.join(totals, [*by, "_stretch"]).select(
        *by,
        "_t",
        *kept,
        (F.col("_rows_before") + F.col("_so_far")).alias("_ever"),
        F.coalesce("_prev_here", "_last_before").alias("_prev"),
    )


def _trailing(instants: DataFrame, keys: Sequence[str], windows: dict[str, int]) -> DataFrame:
    """(keys, _t) and one column per trailing window.

    A stretch is as long as the longest window at least, and also holds the instants of the
    one before that its own can reach back to: nothing else is needed to count there. Each
    number is the difference of two running counts, whose frames only grow.
    """
    by = _names(keys)
    reach = max(map(int, windows.values()), default=0)
    bits = max(STRETCH_BITS, reach.bit_length())
    stretch, place = F.shiftright("_t", bits), F.col("_t").bitwiseAND(F.lit((1 << bits) - 1))
    late = place + F.lit(reach) >= F.lit(1 << bits)
    stretches = F.when(late, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))
    held = instants.select("*", F.explode(stretches).alias("_stretch")).repartition(*by, "_stretch")
    order = Window.partitionBy(*by, "_stretch").orderBy("_t")

    def up_to(seconds: int) -> Column:
        return F.coalesce(F.sum("_n").over(order.rangeBetween(Window.unboundedPreceding, -seconds)), F.lit(0))

    counted = held.select(*by, "_t", "_stretch", *[(up_to(0) - up_to(int(s) + 1)).alias(n) for n, s in windows.items()])
    return counted.where(stretch == F.col("_stretch")).drop("_stretch")


def _with_instants(df: DataFrame, instants: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with the columns of its (keys, instant)."""
    by = [*_names(keys), "_t"]
    side = instants.withColumnsRenamed({c: f"_of{c}" for c in by})
    # The instant is the first key: it tells most rows apart when the join sorts them.
    pairs = list(zip(_place(df, keys), by))[::-1]
    same = reduce(lambda a, b: a & b, [c == F.col(f"_of{n}") for c, n in pairs])
    return df.join(side, same).drop(*[f"_of{c}" for c in by])


def sequence_columns(df: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS) -> DataFrame:
    """Add ``count_txns_orders_per_account_ever`` and ``last_txn_date``.

    * ever count: rows of the account with request instant <= this row's
      (RANGE frame: rows tied on the instant count each other);
    * last_txn_date: request instant of the previous row in the total order
      (instant, then the tie-breaker columns); NULL on the first row.
    """
    keys = _ordered(df, keys)
    ever, last = "count_txns_orders_per_account_ever", "last_txn_date"
    out = [*df.columns, ever, last]
    kind = df.schema[INSTANT].dataType
    instants = _first_of_instants(df, keys)
    numbers = _running(instants, keys).select(
        *_names(keys), "_t", "_id", "_state", F.col("_ever").alias(ever),
        F.when(F.col("_prev") > NO_INSTANT, F.col("_prev")).cast(kind).alias("_prev"),
    )
    # A row of the least id is the instant's first if it is the only one.
    least = (F.col("_state") == 0) | F.col(TIE_BREAKERS[0]).eqNullSafe(F.col("_id"))
    rows = _with_instants(df, numbers, keys)
    # Read whole after the join too, as the rows of doubtful instants below are: one exchange.
    single = rows.where((F.col("_state") + _reads(df.columns) < 2) | ~least).withColumn(
        last, F.when(least, F.col("_prev")).otherwise(F.col(INSTANT))
    )
    # Rows of the least id where it may stand more than once: the other tie-breakers decide,
    # and among equal rows one of them is the first. These instants are a stage of their own:
    # where AQE finds it empty, it drops all that follows.
    doubtful = instants.where("_state = 2").select(*_names(keys), "_t", "_id", "_state")
    doubtful = doubtful.repartition(F.length(F.col("_id").cast("string")), *_names(keys), "_t")
    equal = _with_instants(df, doubtful, keys).where(least).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    rank = Window.partitionBy(*keys, INSTANT).orderBy(
        *[F.col(c).asc_nulls_first() for c in (*TIE_BREAKERS, *sorted(set(df.columns) - {*keys, INSTANT, *TIE_BREAKERS}))]
    )
    ranked = equal.withColumn("_rank", F.row_number().over(rank)).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    )
    # The condition holds for all of them; it reads the columns that the rows above read, so
    # that both joins share the exchange of the instants.
    known = _with_instants(ranked, numbers, keys).where(least & (F.col("_state") == 2))
    tied = known.withColumn(
        last, F.when((F.col("_rank") == 1) & (F.col("_copy") == 1), F.col("_prev")).otherwise(F.col(INSTANT))
    )
    return single.select(*out).unionByName(tied.select(*out))


def row_dimensions(df: DataFrame) -> DataFrame:
    """Row-level dimensions (no window): txn_requested_at_ts,
    txn_completed_at_ts (text timestamps in the session zone) and
    time_to_complete_in_seconds (NULL unless the completion text is a number)."""
    completed = try_long("txn_completed_at")
    return df.select(
        "*",
        F.from_unixtime("txn_requested_at").alias("txn_requested_at_ts"),
        F.from_unixtime(completed).alias("txn_completed_at_ts"),
        (completed - F.col("txn_requested_at").cast("bigint")).alias("time_to_complete_in_seconds"),
    )


def txn_dimensions(df: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS) -> DataFrame:
    """All ledger columns plus the six transaction dimensions, in order:

    txn_requested_at_ts, txn_completed_at_ts (text timestamps in the session
    zone), time_to_complete_in_seconds (NULL unless completed), ever count,
    last_txn_date, time_from_last_txn_in_days (completion of this row minus
    request of the previous row, in days).
    """
    completed = try_long("txn_completed_at")
    return row_dimensions(sequence_columns(df, keys)).select(
        *df.columns,
        "txn_requested_at_ts",
        "txn_completed_at_ts",
        "time_to_complete_in_seconds",
        "count_txns_orders_per_account_ever",
        "last_txn_date",
        ((completed - F.col("last_txn_date").cast("bigint")) / F.lit(SECONDS_PER_DAY)).alias(
            "time_from_last_txn_in_days"
        ),
    )


def trailing_counts(df: DataFrame, windows: dict[str, int], keys: Sequence[str] = ACCOUNT_KEYS) -> DataFrame:
    """For each ``name -> seconds``: count of the account's rows with request
    instant in [t - seconds, t] (rows without instant count each other)."""
    keys = _ordered(df, keys)
    counts = _trailing(_instants(df, keys), keys, windows)
    return _with_instants(df, counts, keys).select(*df.columns, *windows)


def trailing_count(
    df: DataFrame, seconds: int, keys: Sequence[str] = ACCOUNT_KEYS, name: str | None = None
) -> DataFrame:
    """One trailing window (see ``trailing_counts``)."""
    return trailing_counts(df, {name or f"count_txns_last_{seconds}s": seconds}, keys)
