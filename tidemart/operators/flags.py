"""Batch forms of the keyed, order-dependent operators.

None of them ever puts all rows of a key into one task.  Two shapes are used:

* Where only the first rows matter (summaries), they are plain aggregates: each task
  reduces its own rows first and a hot key costs one row per task and day.
* Where every row needs an answer, rows are grouped by key *and time slot*.  What a row must
  know from earlier slots comes from a per-slot aggregate joined back on key and slot, or
  from the edge rows of the slots, chained over the key (two rows per slot).  A key holding
  a third of all rows is thus spread over its slots; `slot` sets their width in seconds.

Event order is the order of the time column, then of the `tie` columns; it should be total.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.operators.aggregates import first_per_key

SLOT_SECONDS = 600


def day_of(ts: str) -> Column:
    return F.to_date(F.col(ts))


def _slot(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / F.lit(seconds))


def _join_back(rows: DataFrame, extra: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on columns the rows are already partitioned and sorted by.

    Plain equality, so that a shuffle join reuses that partitioning; a null key or time
    matches nothing (`require_fields` drops such rows first).
    """
    return rows.join(extra, list(on), "left").select(
        *rows.columns, *(c for c in extra.columns if c not in on)
    )


# ---- first rows ------------------------------------------------------------------------

def _first_flag(df, groups, ts, tie, out, slot):
    rows = df.withColumn("_slot", _slot(ts, slot))
    first_slot = rows.groupBy(*groups).agg(F.min("_slot").alias("_slot")).withColumn("_hit", F.lit(True))
    w = Window.partitionBy(*groups, "_slot").orderBy(ts, *tie)
    numbered = rows.withColumn("_rn", F.row_number().over(w))
    joined = _join_back(numbered, first_slot, [*groups, "_slot"])
    is_first = (F.col("_rn") == 1) & F.col("_hit").isNotNull()
    return joined.withColumn(out, is_first.cast("bigint")).drop("_slot", "_rn", "_hit")


def first_of_day(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = (), out: str = "is_first",
    slot: int = SLOT_SECONDS,
) -> DataFrame:
    """Flag 1 on the first row of each key and day, else 0."""
    rows = df.withColumn("_day", day_of(ts))
    return _first_flag(rows, [*keys, "_day"], ts, tie, out, slot).drop("_day")


def first_ever(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = (), out: str = "is_first",
    slot: int = SLOT_SECONDS,
) -> DataFrame:
    """Flag 1 on the first row of each key, else 0."""
    return _first_flag(df, list(keys), ts, tie, out, slot)


def active_days(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """The first row of each key and day: keys, `day`, time, tie and kept columns."""
    keyed = df.withColumn("day", day_of(ts))
    return first_per_key(keyed, [*keys, "day"], [ts, *tie], keep)


def new_and_active(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """One row per key and day with `is_active` (always 1) and `is_first_day` (of the key)."""
    days = active_days(df, keys, ts)
    # one row per day in each group, whatever the number of events
    first_day = F.min("day").over(Window.partitionBy(*keys))
    return days.withColumn("is_active", F.lit(1).cast("bigint")).withColumn(
        "is_first_day", (F.col("day") == first_day).cast("bigint")
    )


def returning_user(
    df: DataFrame, keys: Sequence[str], ts: str, days: int = 7
) -> DataFrame:
    """One row per key and day; `back` is 1 after more than `days` whole days of absence.

    Absence runs from the midnight of the last active day to the first event of this one.
    """
    active = active_days(df, keys, ts)
    last = F.lag("day").over(Window.partitionBy(*keys).orderBy("day"))
    # whole days from that midnight to ts equal the difference of the two dates
    back = F.coalesce(F.datediff(F.col("day"), last) > days, F.lit(False))
    return active.withColumn("is_active", F.lit(1).cast("bigint")).withColumn(
        "back", back.cast("bigint")
    )


def page_first_of_day(
    df: DataFrame, key: str, page: str, ts: str, pages: Sequence[str] = ("home", "good_detail")
) -> DataFrame:
    """First view of each page by each key and day."""
    return active_days(df.where(F.col(page).isin(*pages)), [key, page], ts)


# ---- new-visitor repair ----------------------------------------------------------------

def repair_new_flag(
    df: DataFrame, key: str, ts: str, is_new: Column, tie: Sequence[str] = (),
    only_if_empty: bool = False, out: str = "is_new_fixed", slot: int = SLOT_SECONDS,
) -> DataFrame:
    """Correct the new-visitor flag per key from its first visit.

    The keyed rule is: a `1` stores its date if nothing is stored, and becomes `0` if an
    other date is; a `0` stores the day before its own.  In event order this means that a
    `1` stays `1` only on the date of the key's first `1` and before any `0`.  With
    `only_if_empty` a `0` stores nothing once a date is stored, so only a `0` before the
    first `1` matters.
    """
    at = F.struct(ts, *tie) if tie else F.col(ts)
    zero, one = is_new == "0", is_new == "1"
    rows = df.withColumn("_slot", _slot(ts, slot)).withColumn("_day", day_of(ts))
    per_slot = rows.groupBy(key, "_slot").agg(
        F.min(F.when(zero, at)).alias("_zero"),
        F.min(F.when(one, at)).alias("_one"),
        F.min(F.when(one, F.col("_day"))).alias("_one_day"),
    )
    whole = Window.partitionBy(key)
    per_key = per_slot.select(
        key, "_slot",
        F.min("_zero").over(whole).alias("_zero"),
        F.min("_one").over(whole).alias("_one"),
        F.min("_one_day").over(whole).alias("_one_day"),
    )
    joined = _join_back(rows, per_key, [key, "_slot"])
    before = F.col("_one") if only_if_empty else at
    stays = (F.col("_zero").isNull() | (before < F.col("_zero"))) & (F.col("_day") == F.col("_one_day"))
    fixed = F.when(one & ~stays, F.lit("0")).otherwise(is_new)
    return joined.withColumn(out, fixed).drop("_slot", "_day", "_zero", "_one", "_one_day")


# ---- deltas ----------------------------------------------------------------------------

def delta_by_key(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, str], ts: str,
    tie: Sequence[str] = (), ttl_seconds: int | None = None, slot: int = SLOT_SECONDS,
) -> DataFrame:
    """Each measure minus its previous value for the same key (0 before the first).

    `measures` maps new columns to measure columns; summing a new column counts re-sent rows
    once.  With `ttl_seconds` a previous value that old in event time is forgotten.
    """
    kept = {"_at": ts, **{f"_m{i}": m for i, m in enumerate(measures.values())}}
    rows = df.withColumn("_slot", _slot(ts, slot))
    w = Window.partitionBy(*keys, "_slot").orderBy(ts, *tie)
    local = rows.withColumns({
        "_first": F.row_number().over(w) == 1,
        "_last": F.lead(F.lit(1)).over(w).isNull(),
        **{f"{k}_prev": F.lag(c).over(w) for k, c in kept.items()},
    })
    # the edge rows of all slots of a key form one short group, other rows stay in their slot; slots are in time
    # order and have one first and one last row, so the tie columns need not be shuffled again
    inner = F.when(~(F.col("_first") | F.col("_last")), F.col("_slot"))
    edges = Window.partitionBy(*keys, "_inner").orderBy("_slot", F.col("_first").desc())
    chained = local.withColumn("_inner", inner).withColumns(
        {f"{k}_carry": F.lag(c).over(edges) for k, c in kept.items()}
    )
    prev = {
        k: F.when(F.col("_first"), F.col(f"{k}_carry")).otherwise(F.col(f"{k}_prev")) for k in kept
    }
    fresh = F.lit(True)
    if ttl_seconds is not None:
        fresh = F.col(ts) < prev["_at"] + F.expr(f"INTERVAL '{ttl_seconds}' SECOND")
    deltas = {
        out: F.col(m) - F.coalesce(F.when(fresh, prev[f"_m{i}"]), F.lit(0))
        for i, (out, m) in enumerate(measures.items())
    }
    return chained.select(*df.columns, *(d.alias(o) for o, d in deltas.items()))
