"""Flow records made from the line items table, the same in Spark and in SQL.

All fields are integer arithmetic on keys, so both engines agree to the bit.
A quarter of the records has version 6 addresses.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import KIND

PORTS = (53, 80, 443, 22, 25, 123, 8080)

#: The view in SQL: addresses as lower-case hex (src, dst) and as text (src_ip, dst_ip), times as seconds (t1, t2).
SQL = """flows as (
  select ((((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) * 10000 + date_diff('day', date '1990-01-01', l_shipdate::date))::bigint as seq,
    l_linenumber % 4 = 0 as v6,
    case when l_linenumber % 4 = 0 then printf('20010db80000%04x000000000000%04x', l_suppkey % 7, l_suppkey % 65536) else printf('%08x', 167772160 + l_suppkey % 65536) end as src,
    case when l_linenumber % 4 = 0 then printf('20010db800ff0000000000000000%04x', l_partkey % 65536) else printf('%08x', 3232235520 + l_partkey % 65536) end as dst,
    case when l_linenumber % 4 = 0 then (case when l_suppkey % 7 = 0 then '2001:db8::' else printf('2001:db8:0:%x::', l_suppkey % 7) end) || (case when l_suppkey % 65536 = 0 then '' else printf('%x', l_suppkey % 65536) end)
      else '10.0.' || (l_suppkey % 65536 // 256) || '.' || (l_suppkey % 256) end as src_ip,
    case when l_linenumber % 4 = 0 then '2001:db8:ff::' || (case when l_partkey % 65536 = 0 then '' else printf('%x', l_partkey % 65536) end)
      else '192.168.' || (l_partkey % 65536 // 256) || '.' || (l_partkey % 256) end as dst_ip,
    (167772160 + l_suppkey % 65536)::bigint as s4, (3232235520 + l_partkey % 65536)::bigint as d4,
    (1024 + l_orderkey % 60000)::bigint as sport, ([53, 80, 443, 22, 25, 123, 8080])[((l_linenumber - 1) % 7) + 1]::bigint as dport,
    (case l_returnflag when 'A' then 6 when 'N' then 17 else 1 end)::bigint as proto,
    round(l_extendedprice)::bigint as octets, l_quantity::bigint as packets,
    (epoch(l_shipdate)::bigint + l_orderkey % 86400)::bigint as t1, (epoch(l_shipdate)::bigint + l_orderkey % 86400 + l_orderkey % 90)::bigint as t2,
    (l_orderkey % 64)::bigint as flags, (l_linenumber % 2)::bigint as dir, (1::bigint << (l_suppkey % 4)::int)::bigint as link, (l_partkey % 6)::bigint as tunnel
  from lineitem)"""


def _hex(number, digits: int):
    return F.lpad(F.lower(F.hex(number)), digits, "0")


#: Type of ``seq`` where a number passes a long.
WIDE = "decimal(38,0)"


#: Bound below which sums of two terms (and the days, an int) stay within a long.
FITS = 9.2e18


def _seq(t: DataFrame):
    """The order of arrival: a long where all numbers fit one (order keys up to about 920 000), exact decimals otherwise."""
    keys = [F.col(f"l_{x}") for x in ("orderkey", "linenumber", "partkey", "suppkey")]
    order, number, part, supplier = (F.coalesce(F.abs(k.cast("double")), F.lit(0.0)) for k in keys)
    top, most = t.agg(F.max((order * 10 + number) * 1e12 + (part * 1000 + supplier) * 1e4), F.max(F.greatest(order * 10 + number, (part * 1000 + supplier) * 1e4))).first()
    if most is not None and most >= FITS:  # not even the two halves fit a long
        keys = [k.cast("decimal(20,0)") for k in keys]
    order, number, part, supplier = keys
    line, days = order * 10 + number, F.datediff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date"))
    rest = (part * 1000 + supplier) * 10000 + days
    if top is None or top < FITS:
        return (line * 10**12 + rest).cast("long")
    return (line.cast("decimal(22,0)") * F.lit(Decimal(10**12)) + rest.cast("decimal(28,0)")).cast(WIDE)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    six = F.col("l_linenumber") % 4 == 0
    src = F.when(six, F.concat(F.lit("20010db80000"), _hex(F.col("l_suppkey") % 7, 4), F.lit("000000000000"), _hex(F.col("l_suppkey") % 65536, 4))).otherwise(_hex(167772160 + F.col("l_suppkey") % 65536, 8))
    dst = F.when(six, F.concat(F.lit("20010db800ff0000000000000000"), _hex(F.col("l_partkey") % 65536, 4))).otherwise(_hex(3232235520 + F.col("l_partkey") % 65536, 8))
    port = F.element_at(F.array(*[F.lit(p) for p in PORTS]), ((F.col("l_linenumber") - 1) % 7 + 1).cast("int"))
    begin = F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1000000 + F.col("l_orderkey") % 86400
    stamp = lambda s: F.timestamp_seconds(s.cast("long")).cast("timestamp_ntz")
    kinds = {
        "SRC_IP": (F.unhex(src), "ipaddr"),
        "DST_IP": (F.unhex(dst), "ipaddr"),
        "SRC_PORT": ((1024 + F.col("l_orderkey") % 60000).cast("int"), "uint16"),
        "DST_PORT": (port.cast("int"), "uint16"),
        "PROTOCOL": (F.when(F.col("l_returnflag") == "A", 6).when(F.col("l_returnflag") == "N", 17).otherwise(1).cast("smallint"), "uint8"),
        "BYTES": (F.round("l_extendedprice").cast("long"), "uint64"),
        "PACKETS": (F.col("l_quantity").cast("long"), "uint32"),
        "TIME_FIRST": (stamp(begin), "time"),
        "TIME_LAST": (stamp(begin + F.col("l_orderkey") % 90), "time"),
        "TCP_FLAGS": ((F.col("l_orderkey") % 64).cast("smallint"), "uint8"),
        "DIR_BIT_FIELD": ((F.col("l_linenumber") % 2).cast("smallint"), "uint8"),
        "LINK_BIT_FIELD": (F.expr("shiftleft(1L, cast(l_suppkey % 4 as int))"), "uint64"),
        "TUNNEL_TYPE": ((F.col("l_partkey") % 6).cast("smallint"), "uint8"),
    }
    return t.select(_seq(t).alias("seq"), *[c.alias(n, metadata={KIND: k}) for n, (c, k) in kinds.items()])
