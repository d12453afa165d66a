"""Keyed state on streams.

Each operator here has a batch twin in `tidemart.operators.flags`.  Rows are ordered by event
time within a micro-batch.  State expires by event-time timers: processing-time expiry
would stop later windows from closing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MS, DAY = "_ms", "_day"
FLAGS = T.StructType([
    T.StructField("is_active", T.LongType()),
    T.StructField("is_first_day", T.LongType()),
    T.StructField("back", T.LongType()),
])


def _timed(df: DataFrame, ts: str) -> DataFrame:
    """Event time as plain numbers, so that Python needs no time zone."""
    at = F.col(ts).cast("timestamp")
    return df.withColumns({MS: F.unix_millis(at), DAY: F.unix_date(F.to_date(F.col(ts)))})


class _Timed(StatefulProcessor):
    """State with an optional event-time expiry after the last write."""

    def __init__(self, state: T.StructType, ttl_ms: int | None):
        self.state_schema = T.StructType([T.StructField("at", T.LongType()), *state.fields])
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", self.state_schema)

    def load(self) -> tuple | None:
        stored = self.value.get()
        return None if stored is None else tuple(stored)

    def store(self, state: tuple) -> None:
        self.value.update(state)
        if self.ttl_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(state[0] + self.ttl_ms)

    def expired(self, state: tuple | None, now: int) -> bool:
        return self.ttl_ms is not None and state is not None and now - state[0] >= self.ttl_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.value.clear()
        return iter(())

    def close(self) -> None:
        pass


class _FirstOfDay(_Timed):
    """The first row of each day per key, with its flags.

    One pass keeps the earliest row per day, so a hot key needs no memory for its rows.  The
    last two active days are remembered: a row can be late by the watermark delay only, so
    it belongs to one of them or is new.
    """

    def __init__(self, columns: Sequence[str], away_days: int, ttl_ms: int | None):
        super().__init__(T.StructType([
            T.StructField("day", T.IntegerType()), T.StructField("before", T.IntegerType()),
        ]), ttl_ms)
        self.columns, self.away_days = columns, away_days
        self.named = Row(*columns, *FLAGS.fieldNames())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first: dict[int, Row] = {}
        for row in rows:
            kept = first.get(row[DAY])
            if kept is None or row[MS] < kept[MS]:
                first[row[DAY]] = row
        state = self.load()
        changed = False
        for day in sorted(first):
            row = first[day]
            if self.expired(state, row[MS]):
                state = None
            if state is not None and day in state[1:]:
                continue
            last = state[1] if state is not None else None
            back = last is not None and day - last > self.away_days
            yield self.named(*(row[c] for c in self.columns), 1, int(last is None), int(back))
            changed = True
            if last is None:
                state = (row[MS], day, None)
            elif day > last:
                state = (row[MS], day, last)
            else:
                before = state[2]
                state = (state[0], last, day if before is None else max(day, before))
        if changed:
            self.store(state)


class _FirstEver(_Timed):
    """The earliest row of the first micro-batch a key appears in."""

    def __init__(self, columns: Sequence[str], ttl_ms: int | None):
        super().__init__(T.StructType([]), ttl_ms)
        self.columns, self.named = columns, Row(*columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.load() is not None:
            return
        first = min(rows, key=lambda r: r[MS])
        self.store((first[MS],))
        yield self.named(*(first[c] for c in self.columns))


VISIT, SESSION, VIEW = "visit", "session", "view"
KIND, BUCKET, KEY, US, LAST = "_kind", "_bucket", "_key", "_us", "_last"
TRAFFIC = ("uv_ct", "sv_ct", "pv_ct", "dur_sum")
#: Groups that visitors, and sessions, are dealt over by hash; a checkpoint keeps the number it began with.
BUCKETS = 256
#: Views have no state and need fewer.
VIEW_BUCKETS = 64
#: Lists of changes a bucket may have before they are merged.
CHANGES = 16


class _Traffic(StatefulProcessor):
    """What visitors, sessions and views add to a summary; the first key column tells them apart.

    A visitor counts once a day, a session once while its state lives (its last row refreshes it), and
    views need no state: their sums are only added up.  A group is a bucket of many visitors or sessions, so calls of the state
    store grow with the buckets, not with the keys.  The state is a list of changes: a micro-batch reads
    its buckets' lists and appends what it changed; a long list is merged.  A bucket has one timer while it has state.
    """

    def __init__(self, inputs: Sequence[str], ts: str, dims: Sequence[str], ttl_ms: int | None):
        self.inputs, self.ts, self.dims, self.ttl_ms = inputs, ts, list(dims), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.changes = handle.getListState("changes", T.StructType([
            T.StructField("key", T.ArrayType(T.StringType())), T.StructField("at", T.ArrayType(T.LongType())),
            T.StructField("day", T.ArrayType(T.IntegerType())), T.StructField("before", T.ArrayType(T.IntegerType()))]))

    def load(self) -> tuple[dict[str, tuple], int]:
        """State by key, and the length of the stored list."""
        held, n = {}, 0
        for keys, *values in self.changes.get():
            held.update(zip(keys, zip(*values)))
            n += 1
        return held, n

    @staticmethod
    def packed(states: Mapping[str, tuple]) -> tuple:
        return (list(states), *map(list, zip(*states.values())))

    def live(self, state: tuple | None, now: int) -> tuple | None:
        return None if state is None or self.ttl_ms is not None and now - state[0] >= self.ttl_ms else state

    def set_timer(self, states: Mapping[str, tuple], watermark: int) -> None:
        """For when the oldest state expires, in steps of an eighth of the lifetime."""
        if self.ttl_ms is not None and states:
            step = max(self.ttl_ms // 8, 1)
            at = max(min(state[0] for state in states.values()) + self.ttl_ms, watermark + 1)
            self.handle.registerTimer(-(-at // step) * step)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        states = {k: state for k, state in self.load()[0].items() if self.live(state, watermark)}
        if states:
            self.changes.put([self.packed(states)])
            self.set_timer(states, watermark)
        else:
            self.changes.clear()
        return iter(())

    def handleInputRows(self, key, frames, timerValues) -> Iterator[pd.DataFrame]:
        # named tuples on the way here lose names that begin with an underscore
        frames = (frame.set_axis(self.inputs, axis=1) for frame in frames)
        if key[0] == VIEW:
            rows = pd.concat(frames)
            sums = rows.groupby([US, *self.dims], dropna=False, sort=False)[["pv_ct", "dur_sum"]].sum().reset_index()
            yield self.result(sums, 0, 0)
            return
        frames = list(frames)
        rows = frames[0] if len(frames) == 1 else pd.concat(frames)
        firsts = self.firsts(zip(*(rows[c].tolist() for c in (KEY, US, DAY, LAST))), daily=key[0] == VISIT)
        states, n = self.load()
        changed, counted = {}, []
        for (name, day), (us, place, last) in sorted(firsts.items(), key=lambda item: item[1]):
            state = self.live(states.get(name), us // 1000)
            new = self.visit(state, us // 1000, day) if key[0] == VISIT else self.session(state, last)
            if new is not None:
                states[name] = changed[name] = new
                if key[0] == VISIT or state is None:
                    counted.append(place)
        if changed:
            if n == 0:
                self.set_timer(states, timerValues.getCurrentWatermarkInMs())
            if n < CHANGES:
                self.changes.appendValue(self.packed(changed))
            else:
                self.changes.put([self.packed(states)])
            if counted:
                yield self.result(rows.iloc[counted], int(key[0] == VISIT), int(key[0] == SESSION))

    @staticmethod
    def firsts(rows: Iterator[tuple], daily: bool) -> dict[tuple, tuple]:
        """Time and place of the earliest row of each key, or key and day, with the time of its last."""
        found = {}
        for place, (name, us, day, last) in enumerate(rows):
            slot = name, day if daily else None
            kept = found.get(slot)
            if kept is None:
                found[slot] = us, place, last
            elif us < kept[0] or last > kept[2]:
                found[slot] = *min(kept[:2], (us, place)), max(kept[2], last)
        return found

    @staticmethod
    def visit(state: tuple | None, now: int, day: int) -> tuple | None:
        """The new state if the row is the first of its day; the last two active days are remembered."""
        if state is None:
            return now, day, None
        at, newest, before = state
        if day in (newest, before):
            return None
        if day > newest:
            return now, day, newest
        return at, newest, day if before is None else max(day, before)

    def session(self, state: tuple | None, last: int) -> tuple | None:
        """The new state if there was none, or if it lives longer by these rows."""
        return (last, None, None) if state is None or self.ttl_ms is not None and last > state[0] else None

    def result(self, rows: pd.DataFrame, visitors: int, sessions: int) -> pd.DataFrame:
        return pd.DataFrame({
            self.ts: pd.to_datetime(rows[US], unit="us", utc=True), **{c: rows[c].astype(object) for c in self.dims},
            "uv_ct": visitors, "sv_ct": sessions, "pv_ct": rows["pv_ct"], "dur_sum": rows["dur_sum"]})

    def close(self) -> None:
        pass


class _Fold(_Timed):
    """User code per row: `step(state, row) -> (state, values)`; `None` state stores nothing."""

    def __init__(self, columns, added, step, state: T.StructType, order, ttl_ms):
        super().__init__(state, ttl_ms)
        self.columns, self.step, self.order = columns, step, order
        self.named = Row(*columns, *added)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.load()
        written = False
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            if self.expired(state, row[MS]):
                state = None
            new, values = self.step(state[1:] if state is not None else None, row)
            if new is not None:
                state, written = (row[MS], *new), True
            yield self.named(*(row[c] for c in self.columns), *values)
        if written:
            self.store(state)


def _apply(df, keys, processor, output, ts) -> DataFrame:
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="append",
        timeMode="EventTime", eventTimeColumnName=ts,
    )


def _fields(df: DataFrame, columns: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(c, df.schema[c].dataType) for c in columns]


def _ms(seconds: int | None) -> int | None:
    return None if seconds is None else seconds * 1000


def _reduced(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Keep the earliest row per group of each Arrow batch, before the shuffle.

    A hot key then sends one row per batch to the task that holds its state.  The schema
    passed on carries the watermark's mark on the event-time column.
    """
    group = list(group)

    def earliest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.sort_values(MS, kind="stable").drop_duplicates(group)

    return df.mapInPandas(earliest, df.schema)


def active_days(
    df: DataFrame, keys: Sequence[str], ts: str = "row_time", keep: Sequence[str] = (),
    away_days: int = 7, ttl_seconds: int | None = None,
) -> DataFrame:
    """First row per key and day with `is_active`, `is_first_day` and `back`."""
    columns = [*keys, ts, *keep]
    rows = _reduced(_timed(df, ts).select(*columns, MS, DAY), [*keys, DAY])
    output = T.StructType([*_fields(rows, columns), *FLAGS.fields])
    return _apply(rows, keys, _FirstOfDay(columns, away_days, _ms(ttl_seconds)), output, ts)


def first_ever(
    df: DataFrame, keys: Sequence[str], ts: str = "row_time", keep: Sequence[str] = (),
    ttl_seconds: int | None = None,
) -> DataFrame:
    """The first row per key."""
    columns = [*keys, ts, *keep]
    rows = _reduced(_timed(df, ts).select(*columns, MS), keys)
    output = T.StructType(_fields(rows, columns))
    return _apply(rows, keys, _FirstEver(columns, _ms(ttl_seconds)), output, ts)


#: Sums of views a task holds before it passes them on.
VIEW_SUMS = 1 << 18


def _reduced_traffic(schema: T.StructType, visitor: str, session: str, dims: Sequence[str], ts: str) -> Callable:
    """Per Arrow batch the earliest row per visitor and day and per session; the views' sums per window and dims.

    Sums are stamped with the end of their window, so a task may gather them over many batches; a row of a
    visitor that is late must not stand for others, so those are not gathered.
    """
    names = schema.fieldNames()
    group = [*dims, "_end", "_at_view"]

    def firsts(rows: pa.Table, kind: str, key: str, bucket: str, *more: str) -> pa.Table:
        rows = rows.filter(pc.is_valid(rows[key])).sort_by(US)
        rows = rows.append_column("_i", pa.array(range(len(rows)), pa.int64()))
        groups = rows.group_by([key, *more]).aggregate([("_i", "min"), (MS, "max")])
        none = pa.array([0] * len(groups), pa.int64())
        first = rows.take(groups["_i_min"])
        return pa.table({KIND: pa.array([kind] * len(groups)), BUCKET: first[bucket], KEY: first[key], LAST: groups[f"{MS}_max"],
                         "pv_ct": none, "dur_sum": none, **{c: first[c] for c in (ts, US, DAY, *dims)}}).select(names)

    def sums(rows: pa.Table) -> pa.Table:
        found = rows.group_by(group).aggregate([("pv_ct", "sum"), ("dur_sum", "sum")])
        return pa.table({**{c: found[c] for c in group}, "pv_ct": found["pv_ct_sum"], "dur_sum": found["dur_sum_sum"]})

    def views(found: pa.Table) -> pa.Table:
        none = pa.array([0] * len(found), pa.int64())
        return pa.table({KIND: pa.array([VIEW] * len(found)), BUCKET: found["_at_view"], KEY: pa.array([""] * len(found)), LAST: none,
                         "pv_ct": found["pv_ct"], "dur_sum": found["dur_sum"], ts: found["_end"], US: found["_end"].cast(pa.int64()),
                         DAY: none.cast(pa.int32()), **{c: found[c] for c in dims}}).select(names)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for part in (firsts(rows, VISIT, visitor, "_at_visitor", DAY), firsts(rows, SESSION, session, "_at_session")):
                yield from part.to_batches()
            held.append(sums(rows.append_column("pv_ct", pa.array([1] * len(rows), pa.int64()))))
            if sum(map(len, held)) > VIEW_SUMS:
                held = [sums(pa.concat_tables(held))]
                if len(held[0]) > VIEW_SUMS // 2:
                    yield from views(held.pop()).to_batches()
        if held:
            yield from views(sums(pa.concat_tables(held))).to_batches()

    return reduce


def traffic(
    df: DataFrame, visitor: str, session: str, dims: Sequence[str], duration: str, size: str,
    ts: str = "row_time", ttl_seconds: int | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """What rows add to windows of `size`: `uv_ct`, `sv_ct`, `pv_ct` and `dur_sum`, with time and `dims`.

    A visitor's first row of a day gives 1 to `uv_ct`, a session's first to `sv_ct`; views and their durations come
    as sums per window, stamped with its last microsecond.  Input is read once, and one operator holds both
    kinds of state, in `buckets` groups each, reduced per Arrow batch before the shuffle.  A null visitor or session counts
    as none, a null duration as 0.  State expires `ttl_seconds` after the visitor's last counted day began or the
    session's last row.  A task holds the keys of one bucket at a time
    and a bucket is the least a task can get: take some ten buckets per state partition, more for billions of keys.
    """
    last = F.window(F.col(ts), size)["end"] - F.expr("INTERVAL '0.000001' SECOND")
    bucket = lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
    rows = _timed(df, ts).select(
        F.col(visitor).cast("string").alias(visitor), F.col(session).cast("string").alias(session), *dims, ts, MS, DAY,
        F.unix_micros(F.col(ts).cast("timestamp")).alias(US),
        F.coalesce(F.col(duration).cast("long"), F.lit(0).cast("long")).alias("dur_sum"), last.alias("_end"),
    ).withColumns({"_at_visitor": bucket(visitor), "_at_session": bucket(session), "_at_view": bucket(*dims, "_end") % VIEW_BUCKETS})
    long = T.LongType()
    schema = T.StructType([
        T.StructField(KIND, T.StringType()), T.StructField(BUCKET, T.IntegerType()), T.StructField(KEY, T.StringType()),
        *_fields(rows, dims), rows.schema[ts],
        T.StructField(US, long), T.StructField(DAY, T.IntegerType()), T.StructField(LAST, long),
        T.StructField("pv_ct", long), T.StructField("dur_sum", long)])
    reduced = rows.mapInArrow(_reduced_traffic(schema, visitor, session, dims, ts), schema)
    output = T.StructType([*_fields(rows, [ts, *dims]), *(T.StructField(m, long) for m in TRAFFIC)])
    processor = _Traffic(schema.fieldNames(), ts, dims, _ms(ttl_seconds))
    return reduced.groupBy(KIND, BUCKET).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="append", timeMode="EventTime", eventTimeColumnName=ts)


def keyed_process(
    df: DataFrame, keys: Sequence[str], step: Callable, state: T.StructType, added: T.StructType,
    ts: str = "row_time", tie: Sequence[str] = (), ttl_seconds: int | None = None,
) -> DataFrame:
    """User code per key with state: every row passes on with the `added` columns.

    The rows of a key in one micro-batch are sorted in memory; the source's rate limit
    (`maxOffsetsPerTrigger`, `maxFilesPerTrigger`) bounds them.
    """
    columns = df.columns
    output = T.StructType([*_fields(df, columns), *added.fields])
    fold = _Fold(columns, added.fieldNames(), step, state, [MS, *tie], _ms(ttl_seconds))
    return _apply(_timed(df, ts), keys, fold, output, ts)


def delta_by_key(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, str], ts: str = "row_time",
    tie: Sequence[str] = (), ttl_seconds: int | None = None,
) -> DataFrame:
    """Each measure minus its previous value for the key (0 before the first)."""
    sources = list(measures.values())
    state = T.StructType([T.StructField(m, df.schema[m].dataType) for m in sources])
    added = T.StructType([T.StructField(o, df.schema[m].dataType) for o, m in measures.items()])

    def step(before, row):
        now = tuple(row[m] for m in sources)
        was = before or (None,) * len(now)
        return now, [None if n is None else n - (w or 0) for n, w in zip(now, was)]

    return keyed_process(df, keys, step, state, added, ts, tie, ttl_seconds)


def repair_new_flag(
    df: DataFrame, key: str, is_new: Column, ts: str = "row_time", tie: Sequence[str] = (),
    only_if_empty: bool = False, out: str = "is_new_fixed", ttl_seconds: int | None = None,
) -> DataFrame:
    """Correct the new-visitor flag per key from its stored first-visit date."""
    def step(stored, row):
        flag, day = row["_flag"], row[DAY]
        if flag == "1":
            if stored is None:
                return (day,), [flag]
            return None, ["0" if day != stored[0] else flag]
        if flag == "0" and not (only_if_empty and stored is not None):
            return (day - 1,), [flag]
        return None, [flag]

    state = T.StructType([T.StructField("day", T.IntegerType())])
    added = T.StructType([T.StructField(out, T.StringType())])
    return keyed_process(
        df.withColumn("_flag", is_new), [key], step, state, added, ts, tie, ttl_seconds
    ).drop("_flag")
