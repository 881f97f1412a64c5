"""The same builders on streams. Filters, projections, tags and converters need nothing else: they take a
streaming DataFrame as they are. Here stands what keeps state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.aggregate import Agg, built
from ..operators.project import tagged_routes
from ..operators.timeseries import Rule, _column, stepped
from ..schema import required


def receive(spark: SparkSession, path: str, schema: T.StructType, needs: str = "", files_per_trigger: int | None = None) -> DataFrame:
    """A live interface on a folder of Parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.parquet(path)
    if needs:
        required(df, needs)
    return df


def windowed(df: DataFrame, keys: list[str], aggs: list[Agg], span: str, lateness: str, time: str = "TIME_LAST", slide: str | None = None) -> DataFrame:
    """Tumbling (or sliding) windows with a watermark; order-free aggregates."""
    rows = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return rows.groupBy(F.window(time, span, slide) if slide else F.window(time, span), *keys).agg(F.count(F.lit(1)).alias("COUNT"), *[built(a, df.schema, order=time) for a in aggs])


def sessions(df: DataFrame, keys: list[str], aggs: list[Agg], gap: str, lateness: str, time: str = "TIME_LAST") -> DataFrame:
    """Passive time-out: a group ends after a silence."""
    rows = df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    return rows.groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("COUNT"), *[built(a, df.schema, order=time) for a in aggs])


def series(df: DataFrame, rules: list[Rule], step: int, delay: str) -> DataFrame:
    """Time series with a watermark as the delay; distinct counts are approximate on streams."""
    rows = stepped(df.withColumn("TIME_LAST", F.col("TIME_LAST").cast("timestamp")).withWatermark("TIME_LAST", delay), step)
    exact = [r for r in rules if r.function != "COUNT_UNIQ"]
    about = [F.approx_count_distinct(r.field).alias(r.name) for r in rules if r.function == "COUNT_UNIQ"]
    return rows.groupBy(F.window("TIME_LAST", f"{step} seconds"), "TIME").agg(*[_column(r, df, step) for r in exact], *about)


def active_timeout(df: DataFrame, keys: list[str], active: int, passive: int, lateness: str = "0 seconds") -> DataFrame:
    """Active and passive time-out on a stream: keys, COUNT, PACKETS, BYTES, first and last time of each segment.

    The state of a key is its open segment. The event-time timer ends a silent
    one; a record that begins too late ends it at once.
    """
    schema = df.select(*keys).schema
    out = T.StructType([*schema.fields, *[T.StructField(n, T.LongType()) for n in ("COUNT", "PACKETS", "BYTES", "FIRST_US", "LAST_US")]])
    state_schema = "n long, packets long, bytes long, first long, last long"

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        if state.hasTimedOut:
            rows.append((*key, *state.get))
            state.remove()
        else:
            own = state.get if state.exists else None
            for b in batches:
                b = b.sort_values(["first_us", "last_us"])
                for p, o, first, last in zip(b["PACKETS"], b["BYTES"], b["first_us"], b["last_us"], strict=True):
                    if own is not None and (own[3] + active * 1_000_000 < first or first - own[4] > passive * 1_000_000):
                        rows.append((*key, *own))
                        own = None
                    own = (1, int(p), int(o), int(first), int(last)) if own is None else (own[0] + 1, own[1] + int(p), own[2] + int(o), own[3], max(own[4], int(last)))
            state.update(own)
            state.setTimeoutTimestamp(max(own[4] // 1000 + passive * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=out.fieldNames())

    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = df.withColumn("first_us", micros("TIME_FIRST")).withColumn("last_us", micros("TIME_LAST")).withColumn("_t", F.col("TIME_LAST").cast("timestamp")).withWatermark("_t", lateness)
    return rows.groupBy(*keys).applyInPandasWithState(run, out, state_schema, "append", GroupStateTimeout.EventTimeTimeout)


def paired(lan: DataFrame, wan: DataFrame, router: str, lateness: str = "5 seconds") -> DataFrame:
    """Inner and outer records of one flow on two streams: an interval join, n to m."""
    from ..operators.joins import PAIR_KEY, directed

    a = directed(lan, router).select(F.col("seq").alias("lan_seq"), F.col("TIME_FIRST").cast("timestamp").alias("lan_first"), F.col("TIME_LAST").cast("timestamp").alias("lan_last"), *[F.col(k).alias(f"a_{k}") for k in PAIR_KEY]).withWatermark("lan_first", lateness)
    b = directed(wan, router).select(F.col("seq").alias("wan_seq"), F.col("TIME_FIRST").cast("timestamp").alias("wan_first"), F.col("TIME_LAST").cast("timestamp").alias("wan_last"), *[F.col(k).alias(f"b_{k}") for k in PAIR_KEY]).withWatermark("wan_first", lateness)
    same = F.lit(True)
    for k in PAIR_KEY:
        same = same & (F.col(f"a_{k}") == F.col(f"b_{k}"))
    near = F.expr("wan_first >= lan_first - interval 2 milliseconds and wan_first <= lan_first + interval 2 milliseconds")
    return a.join(b, same & near).select("lan_seq", "wan_seq")


def one_way(df: DataFrame, history: str = "120 seconds") -> DataFrame:
    """Replies without a request on a stream: a left outer interval join that keeps what met nothing."""
    kind = F.shiftright(F.col("DST_PORT").cast("int"), 8)
    reply = ((F.col("PROTOCOL") == 6) & F.col("TCP_FLAGS").isin(18, 4)) | ((F.col("PROTOCOL") == 1) & kind.isin(0, 3, 4, 5, 11, 12, 14, 16, 18))
    # the watermark stands before the filters, so records that are neither move the time on too
    timed = df.withColumn("t", F.col("TIME_LAST").cast("timestamp")).withWatermark("t", history)
    mine = timed.where(reply).select("seq", "SRC_IP", "DST_IP", "t")
    seen = timed.where(~((F.col("PROTOCOL") == 6) & F.col("TCP_FLAGS").isin(4, 20))).select(F.col("SRC_IP").alias("s"), F.col("DST_IP").alias("d"), F.col("t").alias("u"))
    joined = mine.join(seen, F.expr(f"SRC_IP = d and DST_IP = s and u >= t - interval {history} and u <= t + interval {history}"), "left_outer")
    return joined.where("s is null").select("seq", "SRC_IP", "DST_IP", "t")


def drained(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run to the end of what is there and return the result table (in memory)."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def recorded(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run to the end of what is there, write the results as Parquet and read them: nothing passes through the driver."""
    df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def for_each(df: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str):
    """An action on each micro-batch: uploads, sockets, mail, rules."""
    return df.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(query) -> list[dict]:
    """Rows in and rates of the last batches."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"]} for p in query.recentProgress]


def reloading(df: DataFrame, path: str, act: Callable[[DataFrame, int], None], checkpoint: str):
    """Route a stream by filters that can change while it runs: ``path`` (text, ``TEMPLATE:FILTER;…``) is read again for each micro-batch.

    ``act`` gets the batch's records with ``out_id``. If the file doesn't parse, the last good one holds.
    """
    last: dict[str, str] = {}

    def each(batch: DataFrame, number: int) -> None:
        text = "\n".join(r["value"] for r in batch.sparkSession.read.option("wholetext", True).text(path).collect())
        try:
            routed = tagged_routes(batch, text)
            last["text"] = text
        except ValueError:
            if "text" not in last:
                raise
            routed = tagged_routes(batch, last["text"])
        act(routed, number)

    return for_each(df, each, checkpoint)
