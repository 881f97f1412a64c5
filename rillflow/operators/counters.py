"""Counters and histograms over flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ip as ips
from ..functions.scalar import highest_bit, whole_seconds

#: Protocols that have counters of their own.
COUNTED_PROTOCOLS = {"icmp": 1, "tcp": 6, "udp": 17, "icmpv6": 58, "esp": 50, "gre": 47, "sctp": 132}
#: Upper ends of the age bins, in seconds; the last bin has no end.
AGE_BINS = (1, *range(10, 601, 10))


def _totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("FLOWS"), F.sum("PACKETS").cast("long").alias("PACKETS"), F.sum("BYTES").cast("long").alias("BYTES")]


def totals(df: DataFrame) -> DataFrame:
    """FLOWS, PACKETS and BYTES of all records."""
    return df.agg(*_totals())


def periodic_totals(df: DataFrame, period: int, relative: bool = False) -> DataFrame:
    """Counters at the end of each period of event time; running sums, or each period's own."""
    rows = df.groupBy(((F.floor(whole_seconds(F.col("TIME_LAST")) / period) + 1) * period).cast("long").alias("TIME")).agg(*_totals())
    if relative:
        return rows
    upto = Window.orderBy("TIME").rowsBetween(Window.unboundedPreceding, 0)  # one row for each period
    return rows.select("TIME", *[F.sum(c).over(upto).alias(c) for c in ("FLOWS", "PACKETS", "BYTES")])


def by_protocol(df: DataFrame) -> DataFrame:
    """One row: flows, packets and bytes of each counted protocol and of all others."""
    number = F.col("PROTOCOL")
    kinds = [(name, number == n) for name, n in COUNTED_PROTOCOLS.items()]
    kinds.append(("other", ~number.isin(*COUNTED_PROTOCOLS.values())))
    out = []
    for name, met in kinds:
        out += [F.count(F.when(met, 1)).alias(f"{name}_flows"), F.coalesce(F.sum(F.when(met, F.col("PACKETS"))), F.lit(0)).cast("long").alias(f"{name}_packets"), F.coalesce(F.sum(F.when(met, F.col("BYTES"))), F.lit(0)).cast("long").alias(f"{name}_bytes")]
    return df.agg(*out)


def by_link(df: DataFrame, links: DataFrame, directions: bool = True) -> DataFrame:
    """Counters of each configured link (link_bit, name), split by direction 0 and 1; other directions don't count."""
    per = df.groupBy("LINK_BIT_FIELD").agg(
        *[F.coalesce(F.sum(F.when(F.col("DIR_BIT_FIELD") == d, x)), F.lit(0)).cast("long").alias(f"{n}_{side}") for d, side in ((0, "in"), (1, "out")) for n, x in (("flows", F.lit(1)), ("bytes", F.col("BYTES")), ("packets", F.col("PACKETS")))]
    )
    names = [c for c in per.columns if c != "LINK_BIT_FIELD"]
    rows = links.join(per, links.link_bit == per.LINK_BIT_FIELD, "left").select("name", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])
    return rows if directions else rows.drop(*[c for c in names if c.endswith("_out")])


def age_summary(df: DataFrame, received: str, time: str = "TIME_LAST") -> DataFrame:
    """Least, greatest and (whole) average age in milliseconds between ``time`` and the receive time."""
    age = F.unix_millis(F.col(received).cast("timestamp")) - F.unix_millis(F.col(time).cast("timestamp"))
    return df.agg(F.min(age).alias("min_age"), F.max(age).alias("max_age"), F.floor(F.sum(age) / F.count(age)).cast("long").alias("avg_age"))


def age_histogram(df: DataFrame, received: str, time: str = "TIME_LAST") -> DataFrame:
    """Records and percent in each age bin: up to 1 s, 10 s, 20 s … 600 s, and above (bin null)."""
    age = (F.unix_millis(F.col(received).cast("timestamp")) - F.unix_millis(F.col(time).cast("timestamp"))) / 1000.0
    bin_ = F.when(age <= 1, 1).when(age <= 600, (F.greatest(F.ceil(age / 10), F.lit(1)) * 10)).cast("int")
    counts = df.groupBy(bin_.alias("max_age")).agg(F.count(F.lit(1)).alias("records"))
    return counts.withColumn("percent", F.col("records") * 100.0 / F.sum("records").over(Window.partitionBy()))  # a row for each bin


def ip_versions(df: DataFrame, span: int, least_packets: int = 1) -> DataFrame:
    """Per tumbling window of TIME_LAST: flows, packets, bytes by IP version, and distinct sources (exact) by prefix.

    Distinct counts come from a chain of groupings, source, /64, /48, window,
    each of which hands on the sums, so no row is multiplied and each step
    combines before its shuffle.
    """
    v4 = ips.is_v4(F.col("SRC_IP"))
    start = (F.floor(whole_seconds(F.col("TIME_LAST")) / span) * span).cast("long").alias("window_start")
    names = ("flows", "packets", "bytes")
    one = F.max(F.col("PACKETS") >= least_packets).alias("seen")
    sums = [F.count(F.lit(1)).alias("flows"), F.sum("PACKETS").alias("packets"), F.sum("BYTES").alias("bytes")]
    by_source = df.groupBy(start, F.col("SRC_IP").alias("ip"), v4.alias("v4")).agg(one, *sums)
    on = lambda c: F.sum(F.col(c).cast("long"))
    # all of version 4 is one prefix here: its sources are counted in the first step
    wide = by_source.groupBy("window_start", "v4", F.when(~F.col("v4"), F.substring("ip", 1, 8)).alias("p")).agg(F.max("seen").alias("seen"), on("seen").alias("sources"), *[F.sum(n).alias(n) for n in names])
    wider = wide.groupBy("window_start", "v4", F.substring("p", 1, 6).alias("p")).agg(F.max("seen").alias("seen"), F.sum("sources").alias("sources"), on("seen").alias("p64"), *[F.sum(n).alias(n) for n in names])
    out = []
    for name, met in (("v4", F.col("v4")), ("v6", ~F.col("v4"))):
        out += [F.coalesce(F.sum(F.when(met, F.col(n))), F.lit(0)).cast("long").alias(f"{name}_{n}") for n in names]
    some = lambda met, c, n: F.coalesce(F.sum(F.when(met, F.col(c).cast("long"))), F.lit(0)).cast("long").alias(n)
    six = ~F.col("v4")
    out += [some(F.col("v4"), "sources", "unique_v4"), some(six, "sources", "unique_v6"), some(six, "p64", "unique_v6_64"), some(six, "seen", "unique_v6_48")]
    return wider.groupBy("window_start").agg(*out)


#: The long window is so many short ones.
LONG_WINDOWS = 12


def ip_versions_both(df: DataFrame, span: int = 300, least_packets: int = 1) -> DataFrame:
    """``ip_versions`` of the short and the long window: a column ``span`` tells them apart."""
    out = [ip_versions(df, n, least_packets).withColumn("span", F.lit(n).cast("long")) for n in (span, LONG_WINDOWS * span)]
    return out[0].unionByName(out[1])


def tunnels(df: DataFrame, field: str = "TUNNEL_TYPE") -> DataFrame:
    """Counters by tunnel type, the highest set bit of the field; 0 is no tunnel and stays out."""
    return df.where(F.col(field) > 0).groupBy(highest_bit(F.col(field)).cast("int").alias("tunnel")).agg(*_totals())


def by_tag(df: DataFrame, tag: str, span: int = 300) -> DataFrame:
    """Per window, the number of records of each tag as a JSON object."""
    start = (F.floor(whole_seconds(F.col("TIME_LAST")) / span) * span).cast("long").alias("window_start")
    counts = df.groupBy(start, F.col(tag).cast("string").alias("tag")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("window_start").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tag", "n"))))).alias("counts"))


#: Percent of tags (from the rarest on) up to which a sampling rate holds; 0 keeps all.
RATES = ((25, 0), (30, 2), (40, 3), (50, 4), (70, 6), (95, 9), (100, 15))


def sampling_rates(counts: DataFrame) -> DataFrame:
    """(tag, n) with percentile and sampling rate; tags are few, so one ordered window is enough."""
    place = F.row_number().over(Window.orderBy("n", "tag"))
    percent = place * 100.0 / F.count(F.lit(1)).over(Window.partitionBy())
    rate = F.lit(RATES[-1][1])
    for upto, r in reversed(RATES[:-1]):
        rate = F.when(percent <= upto, r).otherwise(rate)
    return counts.withColumn("percentile", percent).withColumn("rate", rate)


def sampled(df: DataFrame, tag: str, rate: int, timeout: int, order: str = "seq", time: str = "TIME_FIRST") -> DataFrame:
    """Every rate-th record of a tag, and always one that comes more than ``timeout`` seconds after the tag's last."""
    w = Window.partitionBy(tag).orderBy(order)
    gap = whole_seconds(F.col(time)) - F.max(whole_seconds(F.col(time))).over(w.rowsBetween(Window.unboundedPreceding, -1)) > timeout
    keep = (F.pmod(F.row_number().over(w) - 1, F.lit(rate)) == 0) | F.coalesce(gap, F.lit(True))
    return df.withColumn("_keep", keep).where("_keep").drop("_keep")
