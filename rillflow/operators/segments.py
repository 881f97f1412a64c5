"""Time-outs as segments: each strategy adds a column ``segment`` to the records.

Aggregation is then ``aggregated(df, [*keys, "segment"], …)``, so time-outs
and functions are independent of each other. Where a rule can be told from
running maxima it is SQL; where a record's segment depends on the segment
before (anchored rules) it is a fold over a group in order, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import whole_seconds


#: Slices of the order: at least so many, of about so many records; more are joined by a shuffle.
LEAST_SLICES, SLICE_RECORDS, MOST_BROADCAST = 256, 1_000_000, 100_000
#: Records of a slice whose fold goes through Python.
IN_TIME_RECORDS = 2_000_000


def global_clock(df: DataFrame, order: str = "seq", time: str = "TIME_LAST") -> DataFrame:
    """``clock``: the latest time seen among all records up to this one, in whole seconds; ``clock_before``: without this one.

    In two levels: the maximum of each slice of the order, the running maximum
    over the slices, and the running maximum within a slice. No task sees all
    records; the slices' number and bounds come from one small aggregate.
    """
    low, high, n = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    slices = max(LEAST_SLICES, n // SLICE_RECORDS)
    width = max(1, ((high or 0) - (low or 0)) // slices + 1)
    rows = df.withColumn("_slice", F.floor((F.col(order) - F.lit(low or 0)) / width)).withColumn("_time", whole_seconds(F.col(time)))
    tops = rows.groupBy("_slice").agg(F.max("_time").alias("_top"))
    tops = tops.withColumn("_before", F.max("_top").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)))
    inner = Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    tops = tops.select("_slice", "_before")
    rows = rows.join(F.broadcast(tops) if slices <= MOST_BROADCAST else tops, "_slice")
    earlier = Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("clock", F.greatest("_before", F.max("_time").over(inner))).withColumn("clock_before", F.greatest("_before", F.max("_time").over(earlier)))
    return rows.drop("_slice", "_time", "_before")


def absolute_flush(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """Flush whenever the clock enters another span of n seconds: pure SQL."""
    return global_clock(df, order).withColumn("segment", F.floor(F.col("clock") / n)).drop("clock", "clock_before")


def gaps(df: DataFrame, keys: list[str], passive: int, order: str = "seq") -> DataFrame:
    """A new segment where nothing of the key was seen for ``passive`` seconds: gaps and islands."""
    w = Window.partitionBy(*keys).orderBy(order)
    seen = F.max(whole_seconds(F.col("TIME_LAST"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(whole_seconds(F.col("TIME_FIRST")) - seen > passive, 1).otherwise(0)
    return df.withColumn("_new", fresh).withColumn("segment", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def tumbling(df: DataFrame, n: int, time: str = "TIME_LAST") -> DataFrame:
    """A segment for each span of n seconds of event time."""
    return df.withColumn("segment", F.floor(whole_seconds(F.col(time)) / n))


def _folded(df: DataFrame, keys: list[str], order: str, extra: dict[str, Column], fold) -> DataFrame:
    """Add ``segment`` from a fold over each key's records in order (each record has an order of its own).

    Only keys, order and what the fold needs go through Python, sorted within
    a partition and streamed; the state is what ``fold`` keeps. The segment is
    joined back by key and order, so the records of a hot key stay spread.
    """
    n = len(extra)
    named = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(a) for k, a in zip(keys, named, strict=True)], F.col(order).alias("_o"), *[c.alias(f"_x{i}") for i, c in enumerate(extra.values())])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts if keys else 1, *named).sortWithinPartitions(*named, "_o")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, segment = object(), None, 0
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            values, keys_of = columns[len(columns) - n :], zip(*columns[: len(named)], strict=True) if named else [()] * b.num_rows
            out = []
            for key, *row in zip(keys_of, *values, strict=True):
                if key != at:
                    at, state, segment = key, None, 0
                state, new = fold(state, row)
                segment += new
                out.append(segment)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(columns) - n], pa.array(out, pa.int64())], [*b.schema.names[: len(columns) - n], "segment"])

    schema = T.StructType([*rows.schema.fields[: len(named) + 1], T.StructField("segment", T.LongType())])
    found = ordered.mapInArrow(run, schema)
    same = F.col(order) == F.col("_o")
    for k, a in zip(keys, named, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(a))
    return df.join(found, same).drop("_o", *named)


def active(df: DataFrame, keys: list[str], n: int, order: str = "seq") -> DataFrame:
    """A segment ends when a record begins more than n seconds after the segment's first record did."""

    def fold(start, row):
        return (row[0], 0) if start is None else ((row[0], 1) if start + n < row[0] else (start, 0))

    return _folded(df, keys, order, {"t": whole_seconds(F.col("TIME_FIRST"))}, fold)


def mixed(df: DataFrame, keys: list[str], active_s: int, passive_s: int, order: str = "seq") -> DataFrame:
    """Active and passive time-out together."""

    def fold(state, row):
        first, last = row
        if state is None:
            return (first, last), 0
        if state[0] + active_s < first or first - state[1] > passive_s:
            return (first, last), 1
        return (state[0], max(state[1], last)), 0

    return _folded(df, keys, order, {"a": whole_seconds(F.col("TIME_FIRST")), "b": whole_seconds(F.col("TIME_LAST"))}, fold)


def event_clock(df: DataFrame, keys: list[str], active_s: int = 40, passive_s: int = 20, order: str = "seq") -> DataFrame:
    """Time-outs by the global clock, the latest TIME_LAST seen among all records.

    A group ends before a record that begins at or after its passive deadline,
    or once the clock reached its active deadline. Deadlines: active is the
    first record's begin plus ``active_s``; passive is the last end plus
    ``passive_s``, not later than the active one after the first record.
    """
    clocked = global_clock(df, order)

    def fold(state, row):
        first, last, clock, before = row
        if state is not None:
            active_end, passive_end = state
            if not (before is not None and before >= passive_end) and first < passive_end and clock < active_end:
                active_end = min(active_end, first + active_s)
                return (active_end, min(last + passive_s, active_end)), 0
        return (first + active_s, last + passive_s), (0 if state is None else 1)

    extra = {"f": whole_seconds(F.col("TIME_FIRST")), "l": whole_seconds(F.col("TIME_LAST")), "c": F.col("clock"), "b": F.col("clock_before")}
    return _folded(clocked, keys, order, extra, fold).drop("clock", "clock_before")


#: Why an event was exported; 1 is added if it goes on from one exported before by the active time-out.
EXPORTS = {"passive": 2, "active": 4, "forced": 8}


def event_tracker(df: DataFrame, keys: list[str], active_s: int = 7200, passive_s: int = 150, least: int = 30, order: str = "seq") -> DataFrame:
    """Events of a key with an active and a passive time-out by the clock: keys, EXPORT, COUNT, TIME_FIRST, TIME_LAST.

    An event ends passively once the clock has moved past its end plus
    ``passive_s``; it is exported actively, and goes on anew, when a record
    comes with the clock past its begin plus ``active_s``; what is left at the
    end is forced. Events of fewer than ``least`` records aren't exported.
    """
    clocked = global_clock(df, order).select(*keys, order, "TIME_FIRST", "TIME_LAST", "clock")

    def fold(state, row):
        first, last, clock = row
        if state is None:
            return (first, last, clock, 0), 0
        low, high, seen, again = state
        # segments are numbered by twos, the odd ones go on from an active export
        if clock > seen and high + passive_s < clock:
            return (first, last, clock, 0), 2 - again
        if low + active_s < clock:
            return (first, last, clock, 1), 3 - again
        return (min(low, first), max(high, last), clock, again), 0

    extra = {"f": whole_seconds(F.col("TIME_FIRST")), "l": whole_seconds(F.col("TIME_LAST")), "c": F.col("clock")}
    events = _folded(clocked, keys, order, extra, fold).groupBy(*keys, "segment").agg(F.count(F.lit(1)).alias("COUNT"), F.min("TIME_FIRST").alias("TIME_FIRST"), F.max("TIME_LAST").alias("TIME_LAST"), F.max("clock").alias("_seen"))
    end = df.agg(F.max(whole_seconds(F.col("TIME_LAST")))).first()[0]
    after = F.lead("segment").over(Window.partitionBy(*keys).orderBy("segment"))
    last = F.when((F.col("_seen") < F.lit(end)) & (whole_seconds(F.col("TIME_LAST")) + passive_s < F.lit(end)), EXPORTS["passive"]).otherwise(EXPORTS["forced"])
    why = F.when(after % 2 == 1, EXPORTS["active"]).when(after.isNotNull(), EXPORTS["passive"]).otherwise(last)
    events = events.withColumn("EXPORT", (why + F.col("segment") % 2).cast("int"))
    return events.where(F.col("COUNT") >= least).select(*keys, "EXPORT", "COUNT", "TIME_FIRST", "TIME_LAST")


def in_time(df: DataFrame, late_s: int = 60, early_s: int = 30, reset_after: int = 1000, order: str = "seq", time: str = "TIME_LAST") -> DataFrame:
    """Records whose time lies near the clock, with ``epoch``: how often the clock was reset before.

    A record more than ``late_s`` before or ``early_s`` after the clock is
    skipped; after ``reset_after`` skipped ones in a row the clock starts anew
    at the last of them. The clock is a fold over all records, so slices of
    the order are folded in parallel, each from a guess of the state before
    it: at first the last time of the slice before. Where a slice's end isn't
    what the next one began with, that one is folded again, until all fit.
    """
    spark = df.sparkSession
    low, high, n = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    if not n:
        return df.withColumn("epoch", F.lit(0).cast("long"))
    slices = max(1, n // IN_TIME_RECORDS)
    width = (high - low) // slices + 1
    rows = df.select(F.floor((F.col(order) - F.lit(low)) / width).cast("long").alias("slice"), F.col(order).alias("o"), whole_seconds(F.col(time)).alias("t"))

    def folded(begin: dict[int, tuple], verdicts: bool) -> DataFrame:
        """Each slice from its state (clock, skipped in a row, resets): the records that pass, or the states at the ends."""
        shared = spark.sparkContext.broadcast(begin)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, state, ends = None, (None, 0, 0), {}
            for b in batches:
                keep, epoch = [], []
                for s, t in zip(b.column("slice").to_pylist(), b.column("t").to_pylist(), strict=True):
                    if s != at:
                        at, state = s, shared.value[s]
                    clock, skipped, resets = state
                    ok = clock is None or clock - late_s <= t <= clock + early_s
                    if ok:
                        state = (t if clock is None else max(clock, t), 0, resets)
                    else:
                        state = (t, 0, resets + 1) if skipped + 1 >= reset_after else (clock, skipped + 1, resets)
                    keep.append(ok)
                    epoch.append(resets)
                    ends[s] = state
                if verdicts:
                    yield pa.RecordBatch.from_arrays([b.column("o"), pa.array(epoch, pa.int64())], ["_o", "epoch"]).filter(pa.array(keep))
            if not verdicts:
                values = [(s, *e) for s, e in ends.items()]
                yield pa.RecordBatch.from_arrays([pa.array([v[i] for v in values], pa.int64()) for i in range(4)], ["slice", "clock", "skipped", "resets"])

        part = rows if len(begin) == len(names) else rows.where(F.col("slice").isin(list(begin)))
        kind = df.schema[order].dataType.simpleString()
        ordered = part.repartition(len(begin), "slice").sortWithinPartitions("slice", "o")
        return ordered.mapInArrow(run, f"_o {kind}, epoch long" if verdicts else "slice long, clock long, skipped long, resets long")

    tops = {r["slice"]: r["t"] for r in rows.groupBy("slice").agg(F.max("t").alias("t")).collect()}  # a number for each slice
    names = sorted(tops)
    begin = {s: (tops[names[i - 1]], 0) if i else (None, 0) for i, s in enumerate(names)}
    ends: dict[int, tuple] = {}
    again = names
    while again:
        for r in folded({s: (*begin[s], 0) for s in again}, False).collect():
            ends[r["slice"]] = (r["clock"], r["skipped"], r["resets"])
        again = [b for a, b in zip(names, names[1:], strict=False) if ends[a][:2] != begin[b]]
        begin |= {b: ends[a][:2] for a, b in zip(names, names[1:], strict=False)}
    before = dict(zip(names, [0, *accumulate(ends[s][2] for s in names)], strict=False))
    passed = folded({s: (*begin[s], before[s]) for s in names}, True)
    return df.join(passed, F.col(order) == F.col("_o")).drop("_o")


def relative_flush(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """Flush before a record when the clock is n seconds past the last flush.

    Only rises of the clock matter, at most one for each second, so the fold
    runs on the distinct clock values and the records join its result.
    """
    clocked = global_clock(df, order)
    ticks = clocked.select("clock").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, segment = None, 0
        for b in batches:
            out = []
            for c in b.column("clock").to_pylist():
                if last is None or c - last >= n:
                    segment += last is not None
                    last = c
                out.append(segment)
            yield pa.RecordBatch.from_arrays([b.column("clock"), pa.array(out, pa.int64())], ["clock", "segment"])

    spans = ticks.coalesce(1).sortWithinPartitions("clock").mapInArrow(run, "clock long, segment long")
    return clocked.join(spans, "clock").drop("clock", "clock_before")


def segmented(df: DataFrame, keys: list[str], spec: str, order: str = "seq") -> DataFrame:
    """By a text: ``A:n`` active, ``P:n`` passive, ``M:a,p`` both, ``G:n`` tumbling, ``E:a,p`` event clock, ``Nr`` / ``Na`` flush."""
    if spec[-1:] in "ra" and spec[:-1].isdigit():
        return (relative_flush if spec[-1] == "r" else absolute_flush)(df, int(spec[:-1]), order)
    kind, _, numbers = spec.partition(":")
    n = [int(x) for x in numbers.split(",")]
    if kind == "A":
        return active(df, keys, n[0], order)
    if kind == "P":
        return gaps(df, keys, n[0], order)
    if kind == "M":
        return mixed(df, keys, n[0], n[1], order)
    if kind == "G":
        return tumbling(df, n[0])
    if kind == "E":
        return event_clock(df, keys, n[0], n[1], order)
    raise ValueError(f"unknown time-out {spec}")
