"""Specialised joins, rewritten to equi-joins where a range or suffix is asked for."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import ip as ips

#: Rows up to which a configuration table is broadcast; above, the join shuffles.
BROADCAST_ROWS = 100_000


def small(table: DataFrame) -> DataFrame:
    """The table with a broadcast hint if it is small; counting stops at the bound."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def prefix_table(spark, prefixes: list[tuple[int, str]]) -> DataFrame:
    """(tag, prefix) pairs as rows: tag, bits, version, low."""
    rows = []
    for tag, text in prefixes:
        low, _, bits, version = ips.network(text)
        rows.append((tag, bits, version, bytearray(low)))
    return spark.createDataFrame(rows, "tag int, bits int, version int, low binary").dropDuplicates(["bits", "version", "low"])


def longest_prefix(df: DataFrame, address: str, table: DataFrame, out: str) -> DataFrame:
    """``df`` with the tag of the longest prefix of ``address``, null if none.

    One equi-join: the distinct (version, length) pairs of the table, 162 at
    most, give each address its masked forms; those join on equality. The tag
    of the longest is chosen per distinct address, not per record.
    """
    lengths = [(r["version"], r["bits"]) for r in table.select("version", "bits").distinct().collect()]
    if not lengths:
        return df.withColumn(out, F.lit(None).cast("int"))
    column = F.col("_a")
    forms = F.array(*[F.struct(F.lit(v).alias("version"), F.lit(b).alias("bits"), F.when(ips.version(column) == v, ips.mask(column, b, b)).alias("low")) for v, b in sorted(lengths)])
    distinct = df.select(F.col(address).alias("_a")).where("_a is not null").distinct()
    exploded = distinct.select("_a", F.inline(forms)).where("low is not null")
    best = exploded.join(small(table), ["version", "bits", "low"]).groupBy("_a").agg(F.max_by("tag", "bits").alias(out))
    return df.join(best, df[address] == best["_a"], "left").drop("_a")


def prefix_tagged(df: DataFrame, table: DataFrame, mode: str = "either") -> DataFrame:
    """Tag records by prefix: ``source``, ``target``, ``either`` (source first) or ``both``; untagged rows go.

    In ``either`` the tag 0 is no tag; in ``both`` PREFIX_TAG and PREFIX_TAG_DST
    are set, 0 for none.
    """
    if mode == "source" or mode == "target":
        address = "SRC_IP" if mode == "source" else "DST_IP"
        return longest_prefix(df, address, table, "PREFIX_TAG").where("PREFIX_TAG is not null")
    rows = longest_prefix(longest_prefix(df, "SRC_IP", table, "_s"), "DST_IP", table, "_d")
    if mode == "both":
        rows = rows.where("_s is not null or _d is not null")
        return rows.withColumn("PREFIX_TAG", F.coalesce("_s", F.lit(0))).withColumn("PREFIX_TAG_DST", F.coalesce("_d", F.lit(0))).drop("_s", "_d")
    tag = F.coalesce(F.nullif("_s", F.lit(0)), F.nullif("_d", F.lit(0)))
    return rows.withColumn("PREFIX_TAG", tag).where("PREFIX_TAG is not null").drop("_s", "_d")


def suffix_table(spark, rows: list[tuple[int, str, str]]) -> DataFrame:
    """(id, tag, "d1, *.d2") to rows id, tag, domain, wild."""
    out = []
    for number, tag, domains in rows:
        for d in "".join(domains.split()).split(","):
            if d:
                out.append((number, tag, d[2:] if d.startswith("*.") else d, d.startswith("*.")))
    return spark.createDataFrame(out, "id int, tag string, domain string, wild boolean").dropDuplicates(["domain"])


def domain_tagged(df: DataFrame, host: str, table: DataFrame) -> DataFrame:
    """Tag of the longest listed name that ends the host: exact, or at a dot where the name has a wildcard.

    Only the longest listed ending is tested, at any place, not only at dots;
    if the test fails the record goes.
    """
    hosts = df.select(F.col(host).alias("_h")).where("_h <> ''").distinct()
    ends = hosts.select("_h", F.explode(F.transform(F.sequence(F.lit(1), F.length("_h")), lambda i: F.substr(F.col("_h"), i))).alias("domain"))
    best = ends.join(small(table), "domain").groupBy("_h").agg(F.max_by(F.struct("id", "tag", "domain", "wild"), F.length("domain")).alias("m"))
    exact = F.col("m.domain") == F.col("_h")
    at_dot = F.col("m.wild") & (F.substr(F.col("_h"), F.length("_h") - F.length("m.domain"), F.lit(1)) == ".")
    best = best.where(exact | at_dot).select("_h", F.col("m.id").alias("SNI_ID"), F.col("m.tag").alias("SNI_TAG"))
    return df.join(best, df[host] == best["_h"]).drop("_h")


def looked_up(df: DataFrame, on: str, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Dictionary join: ``left`` keeps records without an entry, ``inner`` drops them."""
    return df.join(small(table), df[on] == table[key], how).drop(table[key])


def blacklist_table(spark, lists: list[tuple[int, str, str, str]]) -> DataFrame:
    """(number from 1, name, category, source) with the bit that records carry."""
    return spark.createDataFrame([(1 << (n - 1), name, category, source) for n, name, category, source in lists], "blacklist_id long, name string, category string, source string")


def guarded(df: DataFrame, address: str, prefixes: list[str], out: str = "guarded") -> DataFrame:
    """Whether the address lies in any of the prefixes."""
    met = F.lit(False)
    for p in prefixes:
        met = met | ips.within(F.col(address), p)
    return df.withColumn(out, met)


def services(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """SERVICE by port and protocol; ``n/a`` if unknown. ``table`` has port, protocol, service."""
    from ..functions.scalar import service_name

    if table is None:
        return df.withColumn("SERVICE", F.coalesce(F.nullif(service_name(F.col("DST_PORT"), F.col("PROTOCOL")), F.lit("")), F.lit("n/a")))
    rows = df.join(small(table), (df["DST_PORT"] == table["port"]) & (df["PROTOCOL"] == table["protocol"]), "left")
    return rows.withColumn("SERVICE", F.coalesce("service", F.lit("n/a"))).drop(table["port"], table["protocol"], table["service"])


def one_way(df: DataFrame, history: int = 120, networks: list[str] | None = None, order: str = "seq") -> DataFrame:
    """Replies without a request: candidates whose reversed pair was not seen in the history before.

    Candidates are TCP with flags SYN+ACK (18) or RST (4), and ICMP answers.
    All flows but TCP RST (4) and RST+ACK (20) count as seen. The exact form: a
    left anti-join on the reversed pair within ``history`` seconds around the end.
    """
    v4 = df.where(ips.is_v4(F.col("SRC_IP")) & ips.is_v4(F.col("DST_IP")))
    if networks is not None:
        met = F.lit(False)
        for n in networks:
            met = met | ips.within(F.col("SRC_IP"), n) | ips.within(F.col("DST_IP"), n)
        v4 = v4.where(met)
    kind = F.shiftright(F.col("DST_PORT").cast("int"), 8)
    reply = ((F.col("PROTOCOL") == 6) & F.col("TCP_FLAGS").isin(18, 4)) | ((F.col("PROTOCOL") == 1) & kind.isin(0, 3, 4, 5, 11, 12, 14, 16, 18))
    seen = v4.where(~((F.col("PROTOCOL") == 6) & F.col("TCP_FLAGS").isin(4, 20)))
    end = F.unix_micros(F.col("TIME_LAST").cast("timestamp"))
    bin_ = F.floor(end / (history * 1_000_000))
    # a pair meets only in the same or a neighbouring span, so the range is an equi-join on spans; of a span
    # in which it was seen, its ends nearest to both borders decide for the neighbours, all ends for itself
    micros = history * 1_000_000
    ends = seen.select(F.col("SRC_IP").alias("_s"), F.col("DST_IP").alias("_d"), end.alias("_e"), bin_.alias("_k"))
    spans = ends.groupBy("_s", "_d", "_k").agg(F.min("_e").alias("_low"), F.max("_e").alias("_high"))
    past = spans.select("_s", "_d", F.inline(F.array(F.struct(F.col("_k"), F.col("_low"), F.col("_high")), F.struct((F.col("_k") - 1).alias("_k"), F.col("_low"), F.col("_low").alias("_high")), F.struct((F.col("_k") + 1).alias("_k"), F.col("_high").alias("_low"), F.col("_high")))))
    mine = v4.where(reply).withColumn("_end", end).withColumn("_bin", bin_)
    near = (mine["SRC_IP"] == past["_d"]) & (mine["DST_IP"] == past["_s"]) & (mine["_bin"] == past["_k"]) & (mine["_end"] - micros <= past["_high"]) & (mine["_end"] + micros >= past["_low"])
    return mine.join(past, near, "left_anti").drop("_end", "_bin")


PAIR_KEY = ("WAN_IP", "WAN_PORT", "PROTOCOL", "DIRECTION")


def directed(df: DataFrame, router: str) -> DataFrame:
    """DIRECTION of a flow at a translating router: ``L2W`` or ``W2L``, with the outer address; other flows go."""
    src, dst, own = F.col("SRC_IP"), F.col("DST_IP"), ips.literal(ips.packed(router))
    v4 = ips.is_v4(src) & ips.is_v4(dst)
    out = F.when(v4 & ips.is_private(src) & ~ips.is_private(dst) & (dst != own), F.lit("L2W"))
    out = out.when(v4 & (src == own) & ~ips.is_private(dst), F.lit("L2W"))
    out = out.when(v4 & ips.is_private(dst) & ~ips.is_private(src) & (src != own), F.lit("W2L"))
    out = out.when(v4 & (dst == own) & ~ips.is_private(src), F.lit("W2L"))
    rows = df.withColumn("DIRECTION", out).where("DIRECTION is not null")
    outer = F.col("DIRECTION") == "L2W"
    return rows.withColumn("WAN_IP", F.when(outer, dst).otherwise(src)).withColumn("WAN_PORT", F.when(outer, F.col("DST_PORT")).otherwise(F.col("SRC_PORT")))


def nat_pairs(lan: DataFrame, wan: DataFrame, router: str, first_ms: int = 2, last_ms: int = 3, order: str = "seq") -> DataFrame:
    """Pair inner and outer records of one flow, one to one, the first stored candidate first.

    Both sides meet on the outer address, port, protocol and direction and
    stream through in order of arrival; unpaired records are the only state
    and leave it once they are too old to be met.
    """
    fields = ["side", "seq_", "first", "last", *PAIR_KEY]

    def side(df: DataFrame, name: str) -> DataFrame:
        ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
        return directed(df, router).select(F.lit(name).alias("side"), F.col(order).alias("seq_"), ms("TIME_FIRST").alias("first"), ms("TIME_LAST").alias("last"), *PAIR_KEY)

    rows = side(lan, "lan").union(side(wan, "wan"))
    parts = int(lan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = lan.schema[order].dataType
    arrow = to_arrow_type(number)
    ordered = rows.repartition(parts, *PAIR_KEY).sortWithinPartitions(*PAIR_KEY, "first", "seq_", "side")

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: list | None = None
        waiting: dict[str, list[tuple]] = {}
        for b in batches:
            a, z = [], []
            for s, q, first, last, *key in zip(*[b.column(c).to_pylist() for c in fields], strict=True):
                if key != at:
                    at, waiting = key, {"lan": [], "wan": []}
                others = waiting["wan" if s == "lan" else "lan"]
                old = 0
                while old < len(others) and first - others[old][1] >= first_ms:
                    old += 1
                del others[:old]
                for i, (number, start, end) in enumerate(others):
                    inner, outer = ((first, last), (start, end)) if s == "lan" else ((start, end), (first, last))
                    d1, d2 = outer[0] - inner[0], outer[1] - inner[1]
                    if key[3] == "W2L":
                        d1, d2 = -d1, -d2
                    if 0 <= d1 < first_ms and 0 <= d2 < last_ms:
                        del others[i]
                        a.append(q if s == "lan" else number)
                        z.append(number if s == "lan" else q)
                        break
                else:
                    own = waiting[s]
                    own.append((q, first, last))
                    if len(own) > 64 and first - own[0][1] >= first_ms:  # the other side never looked
                        waiting[s] = [w for w in own if first - w[1] < first_ms]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, arrow), pa.array(z, arrow)], ["lan_seq", "wan_seq"])

    return ordered.mapInArrow(paired, T.StructType([T.StructField("lan_seq", number), T.StructField("wan_seq", number)]))
