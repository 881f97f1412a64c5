"""Exact top lists of flows, ports and addresses, overall or by interval.

Every list has a total order (ties by the entry itself), so results repeat.
Sums run before ranking, and ranking keeps n rows of each interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ip as ips
from ..functions.scalar import whole_seconds

MEASURES = ("FLOWS", "PACKETS", "BYTES")


def interval(span: int, time: str = "TIME_LAST") -> Column:
    return (F.floor(whole_seconds(F.col(time)) / span) * span).cast("long")


def _best(rows: DataFrame, by: str, n: int, groups: list[str], ties: list[str]) -> DataFrame:
    order = [F.desc(by), *ties]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)) if groups else F.lit(0))
    if groups:
        return ranked.where(F.col("rank") <= n)
    first = rows.orderBy(*order).limit(n)  # TakeOrderedAndProject: no sort of all rows
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_flows(df: DataFrame, n: int, by: str = "BYTES", span: int | None = None, order: str = "seq") -> DataFrame:
    """The n single records with most bytes or packets."""
    groups = [] if span is None else ["interval"]
    rows = df if span is None else df.withColumn("interval", interval(span))
    return _best(rows, by, n, groups, [order])


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("FLOWS"), F.sum("PACKETS").cast("long").alias("PACKETS"), F.sum("BYTES").cast("long").alias("BYTES"))


def top_ports(df: DataFrame, n: int, by: str = "FLOWS") -> DataFrame:
    """Ports by flows, packets or bytes; a flow counts for its source and its destination port, twice if equal."""
    rows = df.select(F.explode(F.array("SRC_PORT", "DST_PORT")).alias("port"), "PACKETS", "BYTES")
    return _best(_summed(rows, "port"), by, n, [], ["port"])


def top_addresses(df: DataFrame, n: int, by: str = "FLOWS", v4_bits: int = 32, v6_bits: int = 128) -> DataFrame:
    """Source addresses, or true prefixes of them."""
    address = F.col("SRC_IP") if (v4_bits, v6_bits) == (32, 128) else ips.mask(F.col("SRC_IP"), v4_bits, v6_bits)
    return _best(_summed(df.select(address.alias("address"), "PACKETS", "BYTES"), "address"), by, n, [], ["address"])


def _of_ports(df: DataFrame, ports: list[int]) -> DataFrame:
    own = F.array_distinct(F.array("SRC_PORT", "DST_PORT"))
    return df.withColumn("listed", F.explode(F.filter(own, lambda p: p.isin(*ports))))


def top_flows_of_ports(df: DataFrame, ports: list[int], n: int, by: str = "BYTES", order: str = "seq") -> DataFrame:
    return _best(_of_ports(df, ports), by, n, ["listed"], [order])


def top_ports_of_ports(df: DataFrame, ports: list[int], n: int, by: str = "FLOWS") -> DataFrame:
    """For each listed port the opposite ports of its flows."""
    rows = _of_ports(df, ports).withColumn("port", F.when(F.col("SRC_PORT") == F.col("listed"), F.col("DST_PORT")).otherwise(F.col("SRC_PORT")))
    return _best(_summed(rows, "listed", "port"), by, n, ["listed"], ["port"])


def top_addresses_of_ports(df: DataFrame, ports: list[int], n: int, by: str = "FLOWS") -> DataFrame:
    rows = _of_ports(df, ports).withColumn("address", F.col("SRC_IP"))
    return _best(_summed(rows, "listed", "address"), by, n, ["listed"], ["address"])


def in_time_order(df: DataFrame, keys: list[str], time: str = "TIME_LAST", order: str = "seq") -> DataFrame:
    """Records of a key in order of time (ties by arrival): ``place`` from 1 on, and ``wait``, seconds since the one before."""
    w = Window.partitionBy(*keys).orderBy(time, order)
    at = whole_seconds(F.col(time))
    return df.withColumn("place", F.row_number().over(w).cast("long")).withColumn("wait", (at - F.lag(at).over(w)).cast("long"))
