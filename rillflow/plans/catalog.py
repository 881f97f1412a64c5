"""All queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ip as ips
from ..functions import scalar as sc
from ..operators import aggregate as ag
from ..operators import alerts, anonymize, counters, features, joins, project, records, segments, setops, timeseries, topn
from ..operators.aggregate import Agg
from ..schema import kinds
from ..sources import readers, writers
from ..sources.shared import shared_folder
from ..streaming import queries as live
from . import filters
from .flows import SQL, flows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
c = F.col


def query(sql: str | None = None, plain: bool = False):
    """Register a query; its SQL sees the view ``flows`` unless ``plain``."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = widened(f)
        if sql:
            ORACLES[f.__name__] = sql if plain else f"with {SQL} {sql}" if not sql.lstrip().startswith(",") else f"with {SQL}{sql}"
        return f

    return put


def widened(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with all its integers as long, as SQL gives them."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(*[F.col(x.name).cast("long").alias(x.name) if isinstance(x.dataType, (T.ByteType, T.ShortType, T.IntegerType)) else F.col(x.name) for x in df.schema.fields])

    return run


def hexed(name: str, alias: str):
    return F.lower(F.hex(name)).alias(alias)


def order_kind(df: DataFrame) -> str:
    return df.schema["seq"].dataType.simpleString()


def secs(name: str, alias: str):
    return sc.whole_seconds(c(name)).alias(alias)


# --- filters -----------------------------------------------------------------

#: Filters with their conditions in SQL over the view.
FILTERS = {
    "f1_equal_precedence": ("DST_PORT == 53 OR DST_PORT == 80 AND PROTOCOL == 6", "(dport = 53 or dport = 80) and proto = 6"),
    "f2_not_binds_next": ("NOT DST_PORT == 53 AND PACKETS > 10", "not dport = 53 and packets > 10"),
    "f3_parentheses_true": ("(DST_PORT == 53 || (true && PACKETS <= 5)) and not false", "dport = 53 or packets <= 5"),
    "f4_integer_compare": ("BYTES >= 10000 and BYTES <> 20000 and PACKETS < 40 and DST_PORT =< 443", "octets >= 10000 and octets <> 20000 and packets < 40 and dport <= 443"),
    "f5_signed_compare": ("PACKETS > -1 and DIR_BIT_FIELD != -1", "packets > -1 and dir <> -1"),
    "f6_unknown_column": ("not NO_SUCH == 5 and DST_PORT == 22", "dport = 22"),
    "f7_float_compare": ("SCALE == 1.5 or SCALE != 0.25 and SCALE < 3.0", "(packets / 4.0 = 1.5 or packets / 4.0 <> 0.25) and packets / 4.0 < 3.0"),
    "f8_datetime": ("TIME_FIRST >= 1995-1-1T00:00:00 and TIME_LAST < 1996-06-30T12:30:00.500", "t1 >= epoch(timestamp '1995-01-01') and t2 < epoch(timestamp '1996-06-30 12:30:00.500')"),
    "f9_ip_compare": ("SRC_IP >= 10.0.0.20 and SRC_IP < 2001:db8::1", "(src >= '0a000014' or v6) and (not v6 or src < '20010db8000000000000000000000001')"),
    "f10_cidr": ("SRC_IP == 10.0.0.0/27 or DST_IP == 2001:db8:ff::/112", "(not v6 and s4 between 167772160 and 167772191) or (v6 and dst like '20010db800ff000000000000000%')"),
    "f10_cidr_not": ("SRC_IP != 10.0.0.0/27", "v6 or s4 not between 167772160 and 167772191"),
    "f11_host": ("host == 10.0.0.7 or host == 192.168.0.0/28", "not v6 and (s4 = 167772167 or d4 between 3232235520 and 3232235535)"),
    "f11_host_not": ("host != 10.0.0.7", "v6 or s4 <> 167772167"),
    "f12_port": ("port == 53 or port != 443", "dport = 53 or sport = 53 or dport <> 443 or sport <> 443"),
    "f13_in": ("port in [53, 443, 2000] and SRC_IP IN [10.0.0.1, 10.0.0.64/26, 2001:db8::/64]", "(dport in (53, 443, 2000) or sport in (53, 443, 2000)) and ((not v6 and (s4 = 167772161 or s4 between 167772224 and 167772287)) or (v6 and src like '20010db800000000%'))"),
    "f13_not_in": ("DST_PORT NOT IN [53, 80] and PACKETS in [1, 2, 3]", "dport not in (53, 80) and packets in (1, 2, 3)"),
    "f14_string_regex": ("NAME == \"udp\" or NAME =~ \"^t.p$\"", "proto in (17, 6)"),
    "f15_protocol_name": ("PROTOCOL == \"tcp\" or PROTOCOL == ICMP and not PROTOCOL == UDP", "proto in (6, 1)"),
    "f16_empty": ("", "true"),
}


def _filter(name: str, text: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = flows(spark, sf_dir).withColumn("SCALE", c("PACKETS") / F.lit(4.0)).withColumn("NAME", sc.protocol_name(c("PROTOCOL")))
        return filters.matching(df, text).select("seq", hexed("SRC_IP", "src"), "DST_PORT")

    QUERIES[name] = widened(run)
    ORACLES[name] = f"with {SQL} select seq, src, dport as DST_PORT from flows where {sql}"


for _name, (_text, _sql) in FILTERS.items():
    _filter(_name, _text, _sql)


@query("select dport as DST_PORT, count(*) as COUNT, sum(octets)::bigint as BYTES, sum(packets)::bigint as PACKETS, min(t1) as first, max(t2) as last from flows where dport in (53, 443) and not v6 and s4 between 167772160 and 167776255 group by dport")
def slice0_filter_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = filters.matching(flows(spark, sf_dir), "port in [53, 443] and SRC_IP == 10.0.0.0/20").where("DST_PORT in (53, 443)")
    out = ag.aggregated(df, ["DST_PORT"], [Agg("SUM", "BYTES"), Agg("SUM", "PACKETS")])
    return out.select("DST_PORT", "COUNT", "BYTES", "PACKETS", secs("TIME_FIRST", "first"), secs("TIME_LAST", "last"))


# --- projection ----------------------------------------------------------------


@query("select src, octets as BYTES, 0::bigint as EXTRA, 7::bigint as LEVEL, 'none' as NOTE, '' as EMPTY from flows")
def p1_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = project.projected(flows(spark, sf_dir), 'ipaddr SRC_IP,uint64 BYTES,uint32 EXTRA,uint32 LEVEL=7,string NOTE="none",string EMPTY')
    return out.select(hexed("SRC_IP", "src"), "BYTES", "EXTRA", "LEVEL", "NOTE", "EMPTY")


@query("select 0 as out_id, count(*) as n, sum(octets)::bigint as BYTES from flows where dport = 53 union all select 1, count(*), sum(octets)::bigint from flows where proto = 6 union all select 2, count(*), sum(octets)::bigint from flows")
def p2_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = "ipaddr SRC_IP,uint64 BYTES:DST_PORT == 53; :PROTOCOL == 6 # all of it\n; :;"
    return project.tagged_routes(flows(spark, sf_dir), spec).groupBy("out_id").agg(F.count(F.lit(1)).alias("n"), F.sum("BYTES").alias("BYTES"))


@query("select seq, dport as DST_PORT from (select * from flows order by seq limit 1000) where dport = 80")
def p3_record_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.matching(project.first_received(flows(spark, sf_dir), 1000), "DST_PORT == 80").select("seq", "DST_PORT")


@query("select seq, ((dport % 256) * 256 + dport // 256)::bigint as PORT from flows")
def p5_byte_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).select("seq", sc.bswap(c("DST_PORT"), 2).alias("PORT"))


@query("select seq, octets as BYTES from flows")
def p6_repeater(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.counted(flows(spark, sf_dir))[0].select("seq", "BYTES")


@query("select seq, (t2 - t1)::double as SPAN, octets * 2 as BYTES from flows where dport <> 25")
def p7_script_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = records.transformed(flows(spark, sf_dir), {"SPAN": sc.duration(c("TIME_FIRST"), c("TIME_LAST")), "BYTES": c("BYTES") * 2}, keep=c("DST_PORT") != 25, drop=("PACKETS",))
    return df.select("seq", "SPAN", "BYTES")


@query("select src, dst, count(*) as n from flows group by src, dst")
def p8_anonymize_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = b"0123456789abcdef"
    pairs = flows(spark, sf_dir).groupBy("SRC_IP", "DST_IP").agg(F.count(F.lit(1)).alias("n"))
    back = anonymize.anonymized(anonymize.anonymized(pairs, key), key, reverse=True)
    return back.select(hexed("SRC_IP", "src"), hexed("DST_IP", "dst"), "n")


# --- aggregation ---------------------------------------------------------------


@query("""select src, dport as DST_PORT, count(*) as COUNT, min(t1) as first, max(t2) as last, sum(octets)::bigint as SUM_B, (sum(packets) // count(*))::bigint as AVG_P,
min(octets) as MIN_B, max(octets) as MAX_B, min(dst) as MIN_D, arg_min(sport, seq) as FIRST_P, arg_max(sport, seq) as LAST_P, bit_or(flags)::bigint as OR_F, bit_and(flags)::bigint as AND_F from flows group by src, dport""")
def a1_a10_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = [Agg("SUM", "BYTES", "SUM_B"), Agg("AVG", "PACKETS", "AVG_P"), Agg("MIN", "BYTES", "MIN_B"), Agg("MAX", "BYTES", "MAX_B"), Agg("MIN", "DST_IP", "MIN_D"), Agg("FIRST", "SRC_PORT", "FIRST_P"), Agg("LAST", "SRC_PORT", "LAST_P"), Agg("BITOR", "TCP_FLAGS", "OR_F"), Agg("BITAND", "TCP_FLAGS", "AND_F")]
    out = ag.aggregated(flows(spark, sf_dir), ["SRC_IP", "DST_PORT"], aggs)
    return out.select(hexed("SRC_IP", "src"), "DST_PORT", "COUNT", secs("TIME_FIRST", "first"), secs("TIME_LAST", "last"), "SUM_B", "AVG_P", "MIN_B", "MAX_B", hexed("MIN_D", "MIN_D"), "FIRST_P", "LAST_P", "OR_F", "AND_F")


@query("select count(*) as COUNT, min(t1) as first, max(t2) as last, sum(octets)::bigint as BYTES, avg(octets::double / packets) as RATIO from flows")
def a1_no_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumn("RATIO", c("BYTES") / c("PACKETS").cast("double"))
    return ag.aggregated(df, [], [Agg("SUM", "BYTES"), Agg("AVG", "RATIO")]).select("COUNT", secs("TIME_FIRST", "first"), secs("TIME_LAST", "last"), "BYTES", F.round("RATIO", 4).alias("RATIO"))


ORACLES["a1_no_key"] = ORACLES["a1_no_key"].replace("avg(octets::double / packets) as RATIO", "round(avg(octets::double / packets), 4) as RATIO")


@query("select dport as DST_PORT, coalesce(arg_min(tunnel, seq) filter (where tunnel <> 0), 0)::bigint as FNE, coalesce(arg_max(tunnel, seq) filter (where tunnel <> 0), 0)::bigint as LNE, count(distinct src) as SRC_IP_UNIQUE_COUNT, sum(packets)::bigint as N from flows group by dport")
def a8_a16_nonempty_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = [Agg("FIRST_NON_EMPTY", "TUNNEL_TYPE", "FNE"), Agg("LAST_NON_EMPTY", "TUNNEL_TYPE", "LNE"), Agg("UNIQUE_COUNT", "SRC_IP"), Agg("COUNT", "PACKETS", "N")]
    return ag.aggregated(flows(spark, sf_dir), ["DST_PORT"], aggs).select("DST_PORT", "FNE", "LNE", "SRC_IP_UNIQUE_COUNT", "N")


@query("select proto as PROTOCOL, array_to_string(list(n order by seq)[1:5], '') as NAMES, array_to_string(list(dport order by seq)[1:6], ',') as PORTS from (select *, case proto when 6 then 'tcp' when 17 then 'udp' else 'icmp' end || ';' as n from flows) group by proto")
def a13_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumn("NAME", sc.protocol_name(c("PROTOCOL"))).withColumn("PORTS", F.array("DST_PORT"))
    # five values of 4 (or 5) characters with their delimiter fit 20 (or 25); others are left out whole
    out = ag.aggregated(df, ["PROTOCOL"], [Agg("APPEND", "NAME", "A", delimiter=";", size=20), Agg("APPEND", "NAME", "B", delimiter=";", size=25), Agg("APPEND", "PORTS", size=6)])
    return out.select("PROTOCOL", F.when(c("PROTOCOL") == 1, c("B")).otherwise(c("A")).alias("NAMES"), F.array_join("PORTS", ",").alias("PORTS"))


@query(", x as (select proto, unnest([packets, packets + 1]) as k, unnest([dport, sport]) as v, unnest([0, 1]) as i, seq from flows) select proto as PROTOCOL, array_to_string(list(v order by k, seq, i)[1:8], ',') as UP, array_to_string(list(v order by -k, seq, i)[1:8], ',') as DOWN from x group by proto")
def a14_sorted_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumn("K", F.array(c("PACKETS"), c("PACKETS") + 1)).withColumn("V", F.array("DST_PORT", "SRC_PORT"))
    return ag.aggregated(df, ["PROTOCOL"], [Agg("SORTED_MERGE", "V", "UP", key="K", size=8), Agg("SORTED_MERGE", "V", "DOWN", key="K", size=8, descending=True)]).select("PROTOCOL", F.array_join("UP", ",").alias("UP"), F.array_join("DOWN", ",").alias("DOWN"))


_BI = """, b as (select *, (length(src), src, p1) as x from (select seq, proto, t1, t2, octets, length(a) as la, a as src, b as dst, pa as p1, pb as p2 from (
  select seq, proto, t1, t2, octets, src as a, dst as b, sport as pa, dport as pb from flows where dir = 0 union all select seq, proto, t1, t2, octets, dst, src, dport, sport from flows where dir = 1))),
k as (select *, (src, p1) > (dst, p2) as rev, least((src, p1), (dst, p2)) as lo, greatest((src, p1), (dst, p2)) as hi from b),
g as (select lo, hi, proto, count(*) as n, arg_min(rev, (t1, seq)) as lead, min(t1) as first, max(t2) as last, sum(octets) filter (not rev) as f, sum(octets) filter (rev) as r from k group by lo, hi, proto)
select case when lead then hi[1] else lo[1] end as src, case when lead then lo[1] else hi[1] end as dst, proto as PROTOCOL, n as COUNT, first, last, (case when lead then r else f end)::bigint as BYTES, (case when lead then f else r end)::bigint as BYTES_REV from g"""


@query(_BI.replace("(src, p1)", "row(src, p1)").replace("(dst, p2)", "row(dst, p2)").replace("hi[1]", "hi[1]"))
def a17_biflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir)
    back = c("DIR_BIT_FIELD") == 1
    df = df.select("seq", "PROTOCOL", "TIME_FIRST", "TIME_LAST", "BYTES", *[F.when(back, c(y)).otherwise(c(x)).alias(x) for x, y in (("SRC_IP", "DST_IP"), ("DST_IP", "SRC_IP"), ("SRC_PORT", "DST_PORT"), ("DST_PORT", "SRC_PORT"))])
    out = ag.biflows(df, [Agg("SUM", "BYTES")])
    return out.select(hexed("SRC_IP", "src"), hexed("DST_IP", "dst"), "PROTOCOL", "COUNT", secs("TIME_FIRST", "first"), secs("TIME_LAST", "last"), "BYTES", "BYTES_REV")


@query(""", b as (select seq, proto, t1, packets, 167772160 + seq % 3 as a, 1000 + sport % 2 as pa, 167772170 + seq % 5 as z, dport as pz, dir = 1 as rev from flows),
g as (select a, pa, z, pz, proto, count(*) as n, arg_min(rev, (t1, seq)) as lead from b group by all),
v as (select a, pa, z, pz, proto, seq, rev, unnest([1, 2]) as i, unnest([packets + 2, packets]) as key, unnest([seq % 100 + 1, seq % 50 + 1]) as val from b)
select case when lead then z else a end as src, case when lead then pa else pz end as dport, proto as PROTOCOL, max(n) as COUNT, array_to_string(list(case when rev <> lead then -val else val end order by key, seq, i)[1:25], ',') as DIRS
from v join g using (a, pa, z, pz, proto) group by a, pa, z, pz, proto, lead""")
def a15_sorted_merge_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-way traffic between few ends; every second record runs from the larger end to the smaller."""
    back, ten = c("DIR_BIT_FIELD") == 1, 167772160
    one = (ips.v4_of_number(F.lit(ten) + c("seq") % 3), (1000 + c("SRC_PORT") % 2).cast("int"))
    two = (ips.v4_of_number(F.lit(ten + 10) + c("seq") % 5), c("DST_PORT"))
    ends = [F.when(back, y).otherwise(x).alias(name) for name, x, y in (("SRC_IP", one[0], two[0]), ("DST_IP", two[0], one[0]), ("SRC_PORT", one[1], two[1]), ("DST_PORT", two[1], one[1]))]
    keys, values = F.array(c("PACKETS") + 2, c("PACKETS")), F.array(c("seq") % 100 + 1, c("seq") % 50 + 1)
    df = flows(spark, sf_dir).select("seq", "PROTOCOL", "TIME_FIRST", "TIME_LAST", *ends, keys.alias("K"), values.alias("DIRS"))
    out = ag.biflows(df, [Agg("SORTED_MERGE_DIR", "DIRS", key="K", size=25)])
    return out.select(F.conv(F.hex("SRC_IP"), 16, 10).cast("long").alias("src"), c("DST_PORT").alias("dport"), "PROTOCOL", "COUNT", F.array_join("DIRS", ",").alias("DIRS"))


_STEP = 86400


@query(f""", e as (select *, unnest(range(t1 // {_STEP} - (case when t1 % {_STEP} = 0 then 1 else 0 end), t2 // {_STEP} + 1)) * {_STEP} as step from flows),
s as (select *, case when t2 > t1 then greatest(least(t2, step + {_STEP}) - greatest(t1, step), 0)::double / (t2 - t1) else 1.0 end as share from e)
select step::bigint as TIME, round(sum(octets * share), 3) as total, count(*) filter (dport = 53) as dns, round(avg(packets * share), 6) as mean, round(sum(octets * share) / {_STEP}, 9) as rate, count(distinct src) as hosts from s group by step""")
def a18_a20_time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = timeseries.parsed_rules("total:SUM(BYTES)\ndns:count():DST_PORT == 53\nmean:AVG(PACKETS)\nrate:RATE(BYTES)\nhosts:COUNT_UNIQ(SRC_IP)")
    out = timeseries.series(flows(spark, sf_dir), rules, _STEP)
    return out.select("TIME", F.round("total", 3).alias("total"), "dns", F.round("mean", 6).alias("mean"), F.round("rate", 9).alias("rate"), "hosts")


@query(f""", f as (select *, max(t2) over (order by seq) as clock from flows where dport = 8080 and tunnel = 0), h as (select distinct t1 // {_STEP} * {_STEP} as t from f), q as (select max(t) as start from (select t, t - lag(t) over (order by t) as gap from h) where gap > 3 * {_STEP}),
e as (select f.*, unnest(range(t1 // {_STEP} - (case when t1 % {_STEP} = 0 then 1 else 0 end), t2 // {_STEP} + 1)) * {_STEP} as step from f, q where start is null or t1 >= start)
select step::bigint as TIME, count(*) as n from e where step + {_STEP} > clock - 30 * {_STEP} group by step""")
def a20_delay_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = segments.global_clock(flows(spark, sf_dir).where("DST_PORT = 8080 and TUNNEL_TYPE = 0"))
    return timeseries.series(df, timeseries.parsed_rules("n:COUNT()"), _STEP, delay=30 * _STEP, inactive=3 * _STEP)


@query("select count(*) as FLOWS, sum(packets)::bigint as PACKETS, sum(octets)::bigint as BYTES from flows")
def a21_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.totals(flows(spark, sf_dir))


@query(", p as (select (t2 // 604800 + 1) * 604800 as t, count(*) as f, sum(packets) as p, sum(octets) as b from flows group by 1) select t::bigint as TIME, sum(f) over (order by t)::bigint as FLOWS, sum(p) over (order by t)::bigint as PACKETS, sum(b) over (order by t)::bigint as BYTES from p")
def a21_periodic_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.periodic_totals(flows(spark, sf_dir), 604800)


@query("select " + ", ".join(f"count(*) filter ({m}) as {n}_flows, coalesce(sum(packets) filter ({m}), 0)::bigint as {n}_packets, coalesce(sum(octets) filter ({m}), 0)::bigint as {n}_bytes" for n, m in [*((n, f"proto = {v}") for n, v in counters.COUNTED_PROTOCOLS.items()), ("other", "proto not in (1, 6, 17, 58, 50, 47, 132)")]) + " from flows")
def a22_by_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.by_protocol(flows(spark, sf_dir))


@query(", l as (select * from (values (1, 'a'), (2, 'b'), (4, 'c'), (16, 'e')) as l(bit, name)) select name, " + ", ".join(f"count(*) filter (dir = {d} and seq is not null) as flows_{s}, coalesce(sum(octets) filter (dir = {d}), 0)::bigint as bytes_{s}, coalesce(sum(packets) filter (dir = {d}), 0)::bigint as packets_{s}" for d, s in ((0, "in"), (1, "out"))) + " from l left join flows on link = bit group by name")
def a23_by_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = spark.createDataFrame([(1, "a"), (2, "b"), (4, "c"), (16, "e")], "link_bit long, name string")
    return counters.by_link(flows(spark, sf_dir), links)


def _received(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).withColumn("RECEIVED", c("TIME_LAST") + F.make_dt_interval(secs=(c("SRC_PORT") % 700).cast("decimal(18,6)")))


@query("select min(sport % 700) * 1000 as min_age, max(sport % 700) * 1000 as max_age, floor(avg(sport % 700 * 1000))::bigint as avg_age from flows")
def a24_age_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.age_summary(_received(spark, sf_dir), "RECEIVED")


@query(", a as (select sport % 700 as a from flows), b as (select case when a <= 1 then 1 when a <= 600 then greatest(ceil(a / 10.0), 1)::int * 10 end as max_age, count(*) as records from a group by 1) select max_age, records, records * 100.0::double / sum(records) over () as percent from b")
def a24_age_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.age_histogram(_received(spark, sf_dir), "RECEIVED")


@query("select (t2 // 3600 * 3600)::bigint as window_start, " + ", ".join(f"count(*) filter ({m}) as {n}_flows, coalesce(sum(packets) filter ({m}), 0)::bigint as {n}_packets, coalesce(sum(octets) filter ({m}), 0)::bigint as {n}_bytes" for n, m in (("v4", "not v6"), ("v6", "v6"))) + ", count(distinct src) filter (not v6 and packets >= 3) as unique_v4, count(distinct src) filter (v6 and packets >= 3) as unique_v6, count(distinct src[1:16]) filter (v6 and packets >= 3) as unique_v6_64, count(distinct src[1:12]) filter (v6 and packets >= 3) as unique_v6_48 from flows group by 1")
def a25_ip_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.ip_versions(flows(spark, sf_dir), 3600, 3)


@query(", w as (select unnest([3600, 43200]) as span) select span::bigint as span, (t2 // span * span)::bigint as window_start, count(*) filter (not v6) as v4_flows, count(*) filter (v6) as v6_flows, coalesce(sum(octets) filter (v6), 0)::bigint as v6_bytes, count(distinct src) filter (not v6 and packets >= 3) as unique_v4, count(distinct src) filter (v6 and packets >= 3) as unique_v6, count(distinct src[1:16]) filter (v6 and packets >= 3) as unique_v6_64, count(distinct src[1:12]) filter (v6 and packets >= 3) as unique_v6_48 from flows, w group by 1, 2")
def w7_short_and_long_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = counters.ip_versions_both(flows(spark, sf_dir), 3600, 3)
    return out.select("span", "window_start", "v4_flows", "v6_flows", "v6_bytes", "unique_v4", "unique_v6", "unique_v6_64", "unique_v6_48")


@query("select floor(log2(tunnel))::int as tunnel, count(*) as FLOWS, sum(packets)::bigint as PACKETS, sum(octets)::bigint as BYTES from flows where tunnel > 0 group by 1")
def a25_tunnels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.tunnels(flows(spark, sf_dir))


@query("select seq, octets as BYTES, row_number() over (order by octets desc, seq) as rank from flows qualify rank <= 10")
def a26_top_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_flows(flows(spark, sf_dir), 10).select("seq", "BYTES", "rank")


@query("select (t2 // 2592000 * 2592000)::bigint as interval, seq, packets as PACKETS, row_number() over (partition by t2 // 2592000 order by packets desc, seq) as rank from flows qualify rank <= 3")
def a26_top_flows_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_flows(flows(spark, sf_dir), 3, "PACKETS", 2592000).select("interval", "seq", "PACKETS", "rank")


@query(", p as (select unnest([sport, dport]) as port, packets, octets from flows), g as (select port, count(*) as FLOWS, sum(packets)::bigint as PACKETS, sum(octets)::bigint as BYTES from p group by port) select *, row_number() over (order by FLOWS desc, port) as rank from g qualify rank <= 10")
def a27_top_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_ports(flows(spark, sf_dir), 10)


@query(", g as (select case when v6 then src[1:16] || repeat('0', 16) else printf('%08x', (s4 // 8) * 8) end as address, count(*) as FLOWS, sum(packets)::bigint as PACKETS, sum(octets)::bigint as BYTES from flows group by 1) select *, row_number() over (order by BYTES desc, unhex(address)) as rank from g qualify rank <= 10")
def a28_top_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_addresses(flows(spark, sf_dir), 10, "BYTES", 29, 64).withColumn("address", F.lower(F.hex("address")))


@query(", l as (select unnest([53, 443]) as listed), g as (select listed, case when sport = listed then dport else sport end as port, count(*) as FLOWS, sum(packets)::bigint as PACKETS, sum(octets)::bigint as BYTES from flows join l on listed in (sport, dport) group by 1, 2) select *, row_number() over (partition by listed order by FLOWS desc, port) as rank from g qualify rank <= 5")
def a29_ports_of_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_ports_of_ports(flows(spark, sf_dir), [53, 443], 5)


@query(", l as (select unnest([53, 443]) as listed), g as (select listed, src as address, count(*) as FLOWS, sum(packets)::bigint as PACKETS, sum(octets)::bigint as BYTES from flows join l on listed in (sport, dport) group by 1, 2) select *, row_number() over (partition by listed order by FLOWS desc, unhex(address)) as rank from g qualify rank <= 5")
def a29_addresses_of_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_addresses_of_ports(flows(spark, sf_dir), [53, 443], 5).withColumn("address", F.lower(F.hex("address")))


@query("select distinct (t2 // 86400 * 86400)::bigint as window_start, case tunnel when 1 then 'one' when 2 then 'two' end as tag_name, dst as peer from flows where tunnel in (1, 2)")
def a30_peer_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumn("PREFIX_TAG", c("TUNNEL_TYPE"))
    return writers.peer_sets(df, {1: "one", 2: "two"}, 86400).withColumn("peer", F.lower(F.hex("peer")))


_FLAGS_SQL = ", ".join(f"count(*) filter ((flags & {b}) <> 0) as {n}_flows" for n, b in features.FLAGS.items())


@query(f""", g as (select src, proto, count(*) as flows, sum(packets)::bigint as packets, sum(octets)::bigint as bytes, avg(packets) as avg_packets, stddev_pop(packets) as std_packets, sum(octets) / sum(packets)::double as avg_bytes,
sqrt(greatest(sum(octets * (octets::double / packets)) / sum(packets) - (sum(octets)::double / sum(packets)) * (sum(octets)::double / sum(packets)), 0)) as std_bytes, {_FLAGS_SQL},
count(distinct dst) as targets, count(distinct case when v6 then dst[1:16] else dst[1:6] end) as target_nets, count(distinct dport) as target_ports, count(distinct sport) as source_ports from flows group by src, proto),
p as (select src, proto, sport, count(*) as n, row_number() over (partition by src, proto order by count(*) desc, sport) as r from flows group by src, proto, sport),
t as (select src, proto, {", ".join(f"coalesce(max(sport) filter (r = {i}), 0) as top{i}_port, coalesce(max(n) filter (r = {i}), 0) as top{i}_flows" for i in (1, 2, 3))} from p where r <= 3 group by src, proto),
s as (select src, proto, t2 // 10 as slot, count(*) as n from flows group by 1, 2, 3),
m as (select src, proto, max(x)::bigint as most_per_minute from (select src, proto, sum(n) over (partition by src, proto order by slot range between 5 preceding and current row) as x from s) group by 1, 2)
select src, proto as PROTOCOL, * exclude (src, proto, avg_packets, std_packets, avg_bytes, std_bytes), round(avg_packets, 4) as avg_packets, round(std_packets, 4) as std_packets, round(avg_bytes, 3) as avg_bytes, round(std_bytes, 2) as std_bytes from g join t using (src, proto) join m using (src, proto)""")
def a31_reply_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.reply_features(flows(spark, sf_dir))
    digits = {"avg_packets": 4, "std_packets": 4, "avg_bytes": 3, "std_bytes": 2}
    return out.withColumns({n: F.round(n, d) for n, d in digits.items()}).withColumn("src", F.lower(F.hex("SRC_IP"))).drop("SRC_IP")


@query(""", r as (select s4 as host, d4 as peer, true as is_src, packets, octets, proto, sport, dport, t1, seq from flows where not v6 union all select d4, s4, false, packets, octets, proto, sport, dport, t1, seq from flows where not v6),
n as (select *, coalesce(t1 - lag(t1) over (partition by host, peer order by t1, seq, is_src) > 60, true) as fresh from r)
select printf('%08x', host) as host, count(distinct peer) as peers, count(*) filter (fresh) as connections, round(count(*) filter (fresh and is_src) / count(*) filter (fresh)::double, 6) as begins_ratio,
round(coalesce(sum(octets) filter (is_src), 0) / sum(octets)::double, 6) as bytes_ratio, round(tanh(coalesce(avg(packets) filter (is_src), 0) / 100), 6) as mean_src_packets, round(count(*) filter (proto = 6) / count(*)::double, 6) as tcp_ratio,
round(case when count(*) filter (53 in (sport, dport)) / count(*)::double > 0.01 then tanh(3 * (count(*) filter (53 in (sport, dport)) / count(*)::double)) else 0 end, 6) as port_53 from n group by host""")
def a32_device_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.device_features(flows(spark, sf_dir))
    return out.select(F.lower(F.hex("host")).alias("host"), "peers", "connections", *[F.round(n, 6).alias(n) for n in ("begins_ratio", "bytes_ratio", "mean_src_packets", "tcp_ratio", "port_53")])


@query("""select (epoch(ts)::bigint // 300 * 300)::bigint as window_start, '{' || string_agg('"' || event_type || '":' || n, ',' order by event_type) || '}' as counts from (select to_timestamp(epoch(ts)::bigint // 300 * 300) as ts, event_type, count(*) as n from (select floor(epoch(ts))::bigint as s, event_type, make_timestamp(floor(epoch(ts))::bigint * 1000000) as ts from events) group by 1, 2) group by 1""", plain=True)
def a33_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return counters.by_tag(events.withColumn("TIME_LAST", c("ts")), "event_type")


# --- time-outs --------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records: user as key, times a few minutes long."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    start = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return e.select(c("event_id").alias("seq"), c("user_id").alias("KEY"), start.alias("TIME_FIRST"), (start + F.make_dt_interval(secs=(c("event_id") % 600).cast("decimal(18,6)"))).alias("TIME_LAST"), F.round("value").cast("long").alias("BYTES"))


_EV = "ev as (select event_id as seq, user_id as k, floor(epoch(ts))::bigint as t1, floor(epoch(ts))::bigint + event_id % 600 as t2, round(value)::bigint as b from events)"
_SEG = "select k as KEY, count(*) as COUNT, min(t1) as first, max(t2) as last, sum(b)::bigint as BYTES from {} group by k, g"


def _segments(df: DataFrame, spec: str) -> DataFrame:
    out = ag.aggregated(segments.segmented(df, ["KEY"], spec), ["KEY", "segment"], [Agg("SUM", "BYTES")])
    return out.select("KEY", "COUNT", secs("TIME_FIRST", "first"), secs("TIME_LAST", "last"), "BYTES")


@query(f"with recursive {_EV}, o as (select *, row_number() over (partition by k order by seq) as r from ev), w as (select k, r, seq, t1, t2, b, t1 as s, 0 as g from o where r = 1 union all select o.k, o.r, o.seq, o.t1, o.t2, o.b, case when w.s + 21600 < o.t1 then o.t1 else w.s end, w.g + case when w.s + 21600 < o.t1 then 1 else 0 end from w join o on o.k = w.k and o.r = w.r + 1) {_SEG.format('w')}", plain=True)
def w1_active_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "A:21600")


_GAPS = f"with {_EV}, o as (select *, case when t1 - max(t2) over (partition by k order by seq rows between unbounded preceding and 1 preceding) > 7200 then 1 else 0 end as n from ev), w as (select *, sum(n) over (partition by k order by seq) as g from o) "


@query(_GAPS + _SEG.format("w"), plain=True)
def w2_passive_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "P:7200")


@query(f"with {_EV}, w as (select *, t2 // 86400 as g from ev) {_SEG.format('w')}", plain=True)
def w3_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "G:86400")


@query(f"with recursive {_EV}, o as (select *, row_number() over (partition by k order by seq) as r from ev), w as (select k, r, seq, t1, t2, b, t1 as s, t2 as e, 0 as g from o where r = 1 union all select o.k, o.r, o.seq, o.t1, o.t2, o.b, case when w.s + 43200 < o.t1 or o.t1 - w.e > 14400 then o.t1 else w.s end, case when w.s + 43200 < o.t1 or o.t1 - w.e > 14400 then o.t2 else greatest(w.e, o.t2) end, w.g + case when w.s + 43200 < o.t1 or o.t1 - w.e > 14400 then 1 else 0 end from w join o on o.k = w.k and o.r = w.r + 1) {_SEG.format('w')}", plain=True)
def w3_mixed_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "M:43200,14400")


@query(f"with recursive {_EV}, q as (select *, max(t2) over (order by seq) as c, max(t2) over (order by seq rows between unbounded preceding and 1 preceding) as p from ev), o as (select *, row_number() over (partition by k order by seq) as r from q), w as (select k, r, seq, t1, t2, b, t1 + 40000 as a, t2 + 20000 as z, 0 as g from o where r = 1 union all select k, r, seq, t1, t2, b, case when x then t1 + 40000 else least(a, t1 + 40000) end, case when x then t2 + 20000 else least(t2 + 20000, a, t1 + 40000) end, g + x::int from (select o.*, w.a, w.z, w.g, coalesce(o.p >= w.z, false) or o.t1 >= w.z or o.c >= w.a as x from w join o on o.k = w.k and o.r = w.r + 1)) {_SEG.format('w')}", plain=True)
def w4_event_clock_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "E:40000,20000")


@query(f"with {_EV}, w as (select *, max(t2) over (order by seq) // 3600 as g from ev) {_SEG.format('w')}", plain=True)
def w5_absolute_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "3600a")


@query(f"with recursive {_EV}, q as (select *, max(t2) over (order by seq) as c from ev), d as (select c, row_number() over (order by c) as r from (select distinct c from q)), f as (select c, r, c as l, 0 as g from d where r = 1 union all select d.c, d.r, case when d.c - f.l >= 5000 then d.c else f.l end, f.g + (d.c - f.l >= 5000)::int from f join d on d.r = f.r + 1), w as (select q.*, f.g from q join f on f.c = q.c) {_SEG.format('w')}", plain=True)
def w5_relative_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "5000r")


@query(f"""with recursive {_EV}, q as (select *, max(t2) over (order by seq) as c from ev), o as (select *, row_number() over (partition by k order by seq) as r from q),
w as (select k, r, t1, t2, c, t1 as lo, t2 as hi, 0 as f, 0 as g from o where r = 1
 union all select k, r, t1, t2, c, case when p or a then t1 else least(lo, t1) end, case when p or a then t2 else greatest(hi, t2) end, case when p then 0 when a then 1 else f end, g + (p or a)::int
 from (select o.k, o.r, o.t1, o.t2, o.c, w.lo, w.hi, w.f, w.g, o.c > w.c and w.hi + 9000 < o.c as p, w.lo + 20000 < o.c as a from w join o on o.k = w.k and o.r = w.r + 1)),
e as (select k, g, max(f) as f, count(*) as n, min(t1) as first, max(t2) as last, max(c) as seen from w group by k, g), x as (select *, lead(f) over (partition by k order by g) as after, (select max(t2) from ev) as done from e)
select k as KEY, case when after = 1 then 4 when after = 0 then 2 when seen < done and last + 9000 < done then 2 else 8 end + f as EXPORT, n as COUNT, first, last from x where n >= 2""", plain=True)
def w10_event_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segments.event_tracker(_events(spark, sf_dir), ["KEY"], 20000, 9000, 2)
    return out.select("KEY", "EXPORT", "COUNT", secs("TIME_FIRST", "first"), secs("TIME_LAST", "last"))


@query(f"with {_EV}, o as (select *, case when t1 - max(t2) over (partition by k order by seq rows between unbounded preceding and 1 preceding) > 7200 then 1 else 0 end as n from ev), w as (select *, sum(n) over (partition by k order by seq) as g from o) select * from ({_SEG.format('w')}) where COUNT >= 3", plain=True)
def w10_passive_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(_events(spark, sf_dir), "P:7200").where("COUNT >= 3")


@query(f"with recursive {_EV}, o as (select seq, case when seq % 100 < 8 then t1 + 500000 else t1 end as t, row_number() over (order by seq) as r from ev), w as (select seq, t, r, t as m, 0 as s, 0 as e, true as ok from o where r = 1 union all select seq, t, r, case when ok then greatest(m, t) when s + 1 >= 5 then t else m end, case when ok or s + 1 >= 5 then 0 else s + 1 end, case when not ok and s + 1 >= 5 then e + 1 else e end, ok from (select o.seq, o.t, o.r, w.m, w.s, w.e, o.t between w.m - 60000 and w.m + 200000 as ok from w join o on o.r = w.r + 1)) select seq, t as t1, e::bigint as epoch from w where ok", plain=True)
def w9_time_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ahead = F.when(c("seq") % 100 < 8, F.expr("interval 500000 seconds")).otherwise(F.expr("interval 0 seconds"))
    df = _events(spark, sf_dir).withColumn("T", c("TIME_FIRST") + ahead)
    return segments.in_time(df, 60000, 200000, 5, time="T").select("seq", secs("T", "t1"), "epoch")


@query(f"with {_EV}, q as (select *, max(t1) over (order by seq rows between unbounded preceding and 1 preceding) as m from ev) select seq, t1 from q where m is null or t1 between m - 60 and m + 300", plain=True)
def w9_late_and_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    clocked = segments.global_clock(_events(spark, sf_dir), time="TIME_FIRST")
    at = sc.whole_seconds(c("TIME_FIRST"))
    return clocked.where(c("clock_before").isNull() | at.between(c("clock_before") - 60, c("clock_before") + 300)).select("seq", at.alias("t1"))


@query(f"with {_EV}, w as (select *, row_number() over (partition by k order by seq) as r, t1 - max(t1) over (partition by k order by seq rows between unbounded preceding and 1 preceding) as gap from ev) select seq, k as KEY from w where (r - 1) % 3 = 0 or coalesce(gap > 20000, true)", plain=True)
def w13_sampler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.sampled(_events(spark, sf_dir), "KEY", 3, 20000).select("seq", "KEY")


@query(f"with recursive {_EV}, o as (select *, row_number() over (order by seq) as r from ev), w as (select seq, r, t2, true as ok, [t2] as sent from o where r = 1 union all select seq, r, t2, x, case when x then list_append(sent, t2)[-2:] else sent end from (select o.seq, o.r, o.t2, w.sent, len(w.sent) < 2 or o.t2 - w.sent[1] >= 3600 as x from w join o on o.r = w.r + 1)) select seq, t2 from w where ok", plain=True)
def w14_mail_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.limited_per_hour(_events(spark, sf_dir), 2).select("seq", secs("TIME_LAST", "t2"))


# --- joins ------------------------------------------------------------------------

PREFIXES = [(1, "10.0.0.0/24"), (2, "10.0.0.32/27"), (3, "192.168.1.0/24"), (4, "192.168.0.0/16"), (5, "2001:db8::/32"), (6, "2001:db8:0:3::/64"), (7, "10.0.0.64/30")]
_TAG4 = "case when {0} between {1} + 64 and {1} + 67 then 7 when {0} between {1} + 32 and {1} + 63 then 2 when {0} between {1} and {1} + 255 then 1 end"
_SRC_TAG = "case when v6 then case when src like '20010db800000003%' then 6 else 5 end else " + _TAG4.format("s4", 167772160) + " end"
_DST_TAG = "case when v6 then 5 when d4 between 3232235776 and 3232236031 then 3 else 4 end"


@query(f"select seq, ({_SRC_TAG})::int as PREFIX_TAG from flows where ({_SRC_TAG}) is not null")
def j2_prefix_tag_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.prefix_tagged(flows(spark, sf_dir), joins.prefix_table(spark, PREFIXES), "source").select("seq", "PREFIX_TAG")


@query(f"select seq, coalesce({_SRC_TAG}, 0)::int as PREFIX_TAG, coalesce({_DST_TAG}, 0)::int as PREFIX_TAG_DST from flows")
def j2_prefix_tag_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.prefix_tagged(flows(spark, sf_dir), joins.prefix_table(spark, PREFIXES), "both").select("seq", "PREFIX_TAG", "PREFIX_TAG_DST")


@query("select seq, not v6 and s4 between 167772160 and 167772415 as in4, v6 as in6, true as all_v4_or_v6 from flows")
def j3_prefix_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    ip = c("SRC_IP")
    return flows(spark, sf_dir).select("seq", ips.within(ip, "10.0.0.0/24").alias("in4"), ips.within(ip, "2001:db8::/32").alias("in6"), (ips.within(ip, "0.0.0.0/0") | ips.within(ip, "::/0")).alias("all_v4_or_v6"))


@query(r", h as (select seq, 'www' || (tunnel) || case when dport = 53 then '.mail.example.org' when dport = 80 then '.example.org' when dport = 443 then 'example.org' else '.other.net' end as host from flows) select seq, case when host like '%.mail.example.org' then 2 when host like '%.example.org' then 1 end as SNI_ID from h where host like '%.example.org'")
def j4_domain_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(c("DST_PORT") == 53, ".mail.example.org").when(c("DST_PORT") == 80, ".example.org").when(c("DST_PORT") == 443, "example.org").otherwise(".other.net")
    df = flows(spark, sf_dir).withColumn("HOST", F.concat(F.lit("www"), c("TUNNEL_TYPE").cast("string"), end))
    table = joins.suffix_table(spark, [(1, "site", "*.example.org, exact.test"), (2, "mail", "*.mail.example.org")])
    return joins.domain_tagged(df, "HOST", table).select("seq", "SNI_ID")


@query(", l as (select * from (values (1, 'one', 'x'), (2, 'two', 'y'), (4, 'four', 'x')) as l(id, name, category)) select seq, name, category from flows join l on link = id")
def j5_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.createDataFrame([(1, "one", "x"), (2, "two", "y"), (4, "four", "x")], "id long, name string, category string")
    return joins.looked_up(flows(spark, sf_dir), "LINK_BIT_FIELD", table, "id", "inner").select("seq", "name", "category")


@query("select seq, case when (dport, proto) = (53, 6) or (dport, proto) = (53, 17) then 'domain' when (dport, proto) = (80, 6) then 'http' when dport = 443 and proto in (6, 17) then 'https' when (dport, proto) = (22, 6) then 'ssh' when (dport, proto) = (25, 6) then 'smtp' when (dport, proto) = (123, 17) then 'ntp' when (dport, proto) = (8080, 6) then 'http-alt' else 'n/a' end as SERVICE from flows")
def j6_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.services(flows(spark, sf_dir)).select("seq", "SERVICE")


def _two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 4 flows, every second one turned around."""
    df = flows(spark, sf_dir).where(ips.is_v4(c("SRC_IP")))
    turn = c("SRC_PORT") % 2 == 0
    return df.withColumns({"SRC_IP": F.when(turn, c("DST_IP")).otherwise(c("SRC_IP")), "DST_IP": F.when(turn, c("SRC_IP")).otherwise(c("DST_IP"))})


_TURNED = "z as (select seq, proto, flags, dport, t2, case when sport % 2 = 0 then d4 else s4 end as s, case when sport % 2 = 0 then s4 else d4 end as d from flows where not v6)"


@query(f", {_TURNED} select seq from z where ((proto = 6 and flags in (18, 4)) or (proto = 1 and dport // 256 in (0, 3, 4, 5, 11, 12, 14, 16, 18))) and not exists (select 1 from z y where not (y.proto = 6 and y.flags in (4, 20)) and y.s = z.d and y.d = z.s and abs(y.t2 - z.t2) <= 3000000)")
def j7_one_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.one_way(_two_way(spark, sf_dir), 3000000).select("seq")


@query("select seq, v6 and src like '20010db800000002%' or (not v6 and s4 between 167772160 and 167772175) as guarded from flows")
def j8_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.guarded(flows(spark, sf_dir), "SRC_IP", ["10.0.0.0/28", "2001:db8:0:2::/64"]).select("seq", "guarded")


@query("select seq as lan_seq, seq as wan_seq from flows where not v6")
def j1_nat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each inner flow has one outer copy a millisecond later, apart from all others by its port."""
    df = flows(spark, sf_dir).where(ips.is_v4(c("SRC_IP")))
    number = F.dense_rank().over(Window.partitionBy(F.pmod(F.xxhash64("seq"), F.lit(64))).orderBy("seq"))
    lan = df.withColumn("DST_IP", ips.v4_of_number(F.lit(134744072) + number)).withColumn("DST_PORT", F.pmod(F.xxhash64("seq"), F.lit(65536)).cast("int"))
    late = F.expr("interval 1 millisecond")
    wan = lan.withColumn("SRC_IP", ips.literal(ips.packed("147.1.1.1"))).withColumn("TIME_FIRST", c("TIME_FIRST") + late).withColumn("TIME_LAST", c("TIME_LAST") + late)
    return joins.nat_pairs(lan, wan, "147.1.1.1")


# --- sets ------------------------------------------------------------------------------


@query("select seq, octets as BYTES, 0::bigint as PACKETS, src from flows where dport = 53 union all select seq, 0, packets, repeat('0', 32) from flows where dport = 80")
def u1_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir)
    return setops.merged([df.where("DST_PORT = 53").select("seq", "BYTES", "SRC_IP"), df.where("DST_PORT = 80").select("seq", "PACKETS")]).select("seq", "BYTES", "PACKETS", hexed("SRC_IP", "src"))


@query("select octets as BYTES, 0::bigint as OTHER from flows where dport = 53 union all select octets, 0 from flows where dport = 80")
def u1_merge_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir)
    return setops.merged([df.where("DST_PORT = 53"), df.where("DST_PORT = 80")], "uint64 BYTES,uint32 OTHER")


@query("select seq, octets as BYTES from flows where dport = 22")
def u2_u3_mux_demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir)
    one, two = df.where("DST_PORT = 22").select("seq", "BYTES"), df.where("DST_PORT = 25").select("seq", "PACKETS")
    return setops.demuxed(setops.muxed([one, two]), [one.schema, two.schema])[0]


# --- order -----------------------------------------------------------------------------


@query(", t as (select event_type as tag, count(*) as n from events group by 1), p as (select tag, n, row_number() over (order by n, tag) * 100.0::double / count(*) over () as percentile from t) select tag, n, percentile, case when percentile <= 25 then 0 when percentile <= 30 then 2 when percentile <= 40 then 3 when percentile <= 50 then 4 when percentile <= 70 then 6 when percentile <= 95 then 9 else 15 end as rate from p")
def o3_sampling_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return counters.sampling_rates(events.groupBy(c("event_type").alias("tag")).agg(F.count(F.lit(1)).alias("n")))


@query(f"with {_EV} select seq, row_number() over w as place, t2 - lag(t2) over w as wait from ev window w as (partition by k order by t2, seq)", plain=True)
def o5_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.in_time_order(_events(spark, sf_dir), ["KEY"]).select("seq", "place", "wait")


# --- scalar functions ----------------------------------------------------------------------


@query("select seq, src_ip as s, dst_ip as d, src as back from flows")
def x1_ip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = flows(spark, sf_dir).select("seq", ips.text(c("SRC_IP")).alias("s"), ips.text(c("DST_IP")).alias("d"))
    return texts.select("*", F.lower(F.hex(ips.parse(c("s")))).alias("back"))


@query("select seq, case when v6 then src[1:12] || repeat('0', 20) else printf('%08x', s4 // 32 * 32) end as masked from flows")
def x2_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).select("seq", F.lower(F.hex(ips.mask(c("SRC_IP"), 27, 48))).alias("masked"))


@query("select seq, not v6 as private from flows")
def x3_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).select("seq", ips.is_private(c("DST_IP")).alias("private"))


@query("select seq, (t2 - t1)::double as DURATION, case when t2 = t1 then 0 else round(packets / (t2 - t1)::double, 6) end as PPS, case when t2 = t1 then 0 else round(8 * octets / (t2 - t1)::double, 4) end as BPS, round(octets / packets::double, 6) as BPP from flows")
def x4_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = c("TIME_FIRST"), c("TIME_LAST")
    return flows(spark, sf_dir).select("seq", sc.duration(a, b).alias("DURATION"), F.round(sc.packets_per_second(c("PACKETS"), a, b), 6).alias("PPS"), F.round(sc.bits_per_second(c("BYTES"), a, b), 4).alias("BPS"), F.round(sc.bytes_per_packet(c("BYTES"), c("PACKETS")), 6).alias("BPP"))


@query("select seq, case when sport >= 1440 then (sport // 1440) || 'D' else '' end || printf('%02d:%02d:00', sport % 1440 // 60, sport % 60) as win from flows")
def x5_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).select("seq", sc.minutes_text(c("SRC_PORT")).alias("win"))


@query("select seq, t1 - t1 % 300 as step, case proto when 1 then 'icmp' when 6 then 'tcp' else 'udp' end as name, sport // 256 as kind, sport % 256 as code, case when flags = 0 then 0 else floor(log2(flags))::int end as top, case when (flags & 32) > 0 then 'U' else '.' end || case when (flags & 16) > 0 then 'A' else '.' end || case when (flags & 8) > 0 then 'P' else '.' end || case when (flags & 4) > 0 then 'R' else '.' end || case when (flags & 2) > 0 then 'S' else '.' end || case when (flags & 1) > 0 then 'F' else '.' end as letters, '[' || sport || '|' || dport || ']' as arr, round(tanh(packets / 100.0), 9) as th from flows")
def x6_x17_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = sc.whole_seconds(c("TIME_FIRST"))
    return flows(spark, sf_dir).select("seq", sc.floor_to_step(second, 300).alias("step"), sc.protocol_name(c("PROTOCOL")).alias("name"), sc.icmp_type(c("SRC_PORT")).alias("kind"), sc.icmp_code(c("SRC_PORT")).alias("code"), sc.highest_bit(c("TCP_FLAGS")).alias("top"), sc.tcp_flags_text(c("TCP_FLAGS").cast("int")).alias("letters"), sc.array_text(F.array("SRC_PORT", "DST_PORT")).alias("arr"), F.round(sc.squashed(c("PACKETS")), 9).alias("th"))


@query(r"select doc_id, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') as clean from documents", plain=True)
def x9_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", sc.ascii_only(c("text")).alias("clean"))


@query("select n_nationkey as id, reverse(n_name) as turned, md5(n_name) as digest, regexp_extract(n_name, '([A-Z]+)_([0-9]+)', 2) as part from nation", plain=True)
def x8_x12_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return n.select(c("n_nationkey").alias("id"), F.reverse("n_name").alias("turned"), F.md5("n_name").alias("digest"), F.regexp_extract("n_name", "([A-Z]+)_([0-9]+)", 2).alias("part"))


# --- sources and sinks ----------------------------------------------------------------------


@query("select seq, src, dst, octets as BYTES, dport as DST_PORT, t1, sport || ',' || dport as PORTS from flows")
def s1_k1_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumn("PORTS", F.array("SRC_PORT", "DST_PORT")).select("seq", "SRC_IP", "DST_IP", "BYTES", "DST_PORT", "TIME_FIRST", "PORTS")
    path = shared_folder(spark)
    writers.write_csv(df, path)
    back = readers.read_csv(spark, path, template=f"{kinds(df)['seq']} seq,ipaddr SRC_IP,ipaddr DST_IP,uint64 BYTES,uint16 DST_PORT,time TIME_FIRST,int32* PORTS")
    return back.select("seq", hexed("SRC_IP", "src"), hexed("DST_IP", "dst"), "BYTES", "DST_PORT", secs("TIME_FIRST", "t1"), F.array_join("PORTS", ",").alias("PORTS"))


@query("select seq, octets as BYTES, src_ip as SRC_IP, t1::double as T from flows")
def s3_k4_k5_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    df = flows(spark, sf_dir)
    rows = writers.json_rows(df.select("seq", "BYTES", "SRC_IP", c("TIME_FIRST").alias("T")))
    bad = spark.createDataFrame([("",), ("{broken",)], "value string")
    writers.write_json(rows, path)
    bad.coalesce(1).write.mode("append").text(path)
    return readers.read_json(spark, path, T.StructType.fromDDL(f"seq {order_kind(df)},BYTES bigint,SRC_IP string,T double"))


@query("select seq, case dport when 53 then 'dns' when 80 then 'web' end as DST_PORT, case when sport::varchar like '12%' then 'b' when sport::varchar like '1%' then 'a' else sport::varchar end as SRC_PORT, strftime(make_timestamp(t1 * 1000000), '%Y-%m-%dT%H:%M:%SZ') as TIME_FIRST from flows")
def k5_json_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).select("seq", "DST_PORT", "SRC_PORT", "TIME_FIRST")
    rows = writers.json_rows(df, match={"DST_PORT": {"53": "dns", "80": "web"}}, regex={"SRC_PORT": [("1", "a"), ("12", "b")]}, timify=("TIME_FIRST",))
    return rows.select(F.from_json("value", f"seq {order_kind(df)}, DST_PORT string, SRC_PORT string, TIME_FIRST string").alias("r")).select("r.*")


@query("select (n * 3)::bigint as A, 'r' || n as B from range(100) as t(n)", plain=True)
def s5_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.generated(spark, 100, {"A": c("id") * 3, "B": F.concat(F.lit("r"), c("id").cast("string"))})


@query("select seq, src, octets as BYTES, 4 as DIR, 9::bigint as LINK from flows where dport = 443")
def s2_flow_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = readers.flow_dump(flows(spark, sf_dir), "DST_PORT == 443", interface=2, link_mask=9)
    return out.select("seq", hexed("SRC_IP", "src"), "BYTES", c("DIR_BIT_FIELD").cast("int").alias("DIR"), c("LINK_BIT_FIELD").alias("LINK"))


@query("select seq, src, octets as BYTES from flows")
def s7_k3_recorded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    writers.write_stored(flows(spark, sf_dir), path, "gzip")
    return readers.read_stored(spark, path, "ipaddr SRC_IP,uint64 BYTES").select("seq", hexed("SRC_IP", "src"), "BYTES")


@query("select seq, src, octets as BYTES from flows where " + FILTERS["f1_equal_precedence"][1])
def s4_w12_live_interface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream from start to end: required fields, filter and projection, recorded by micro-batches."""
    df, path = flows(spark, sf_dir), shared_folder(spark)
    writers.write_stored(df, f"{path}/in")
    stream = live.receive(spark, f"{path}/in", df.schema, "ipaddr SRC_IP,uint64 BYTES", files_per_trigger=2)
    out = filters.matching(stream, FILTERS["f1_equal_precedence"][0]).select("seq", "SRC_IP", "BYTES")
    return live.recorded(out, f"{path}/out", f"{path}/log").select("seq", hexed("SRC_IP", "src"), "BYTES")


@query(", m as (select max(t2) as top from flows), w as (select t2 // 86400 * 86400 as s, dport, count(*) as n, sum(octets)::bigint as b from flows group by 1, 2) select s::bigint as start, dport as DST_PORT, n as COUNT, b as BYTES from w, m where s + 86400 <= top - 86400")
def s4_live_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream that the watermark has closed; those still open at the end aren't out yet."""
    df, path = flows(spark, sf_dir), shared_folder(spark)
    writers.write_stored(df.select("DST_PORT", "BYTES", "TIME_LAST").coalesce(1), f"{path}/in")
    stream = live.receive(spark, f"{path}/in", df.select("DST_PORT", "BYTES", "TIME_LAST").schema)
    out = live.windowed(stream, ["DST_PORT"], [Agg("SUM", "BYTES")], "1 day", "1 day")
    out = out.select(F.unix_seconds("window.start").alias("start"), "DST_PORT", "COUNT", "BYTES")
    return live.recorded(out, f"{path}/out", f"{path}/log")


@query("select strftime(make_timestamp(t1 * 1000000), '%Y-%m-%dT%H:%M:%S.%f') || ' ' || printf('%.3f', (t2 - t1)::double) || ' ' || case proto when 6 then 'TCP' when 17 then 'UDP' else 'ICMP' end || ' ' || src_ip || ':' || sport || ' -> ' || dst_ip || ':' || dport || ' ' || case when (flags & 32) > 0 then 'U' else '.' end || case when (flags & 16) > 0 then 'A' else '.' end || case when (flags & 8) > 0 then 'P' else '.' end || case when (flags & 4) > 0 then 'R' else '.' end || case when (flags & 2) > 0 then 'S' else '.' end || case when (flags & 1) > 0 then 'F' else '.' end || ' ' || packets || ' ' || octets as value from flows where length(src_ip) < 15 and length(dst_ip) < 15")
def k2_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.report_lines(flows(spark, sf_dir), 15)


@query("select case when tunnel = 0 then src_ip else 'name' || tunnel end as response, 'q' || sport as query, 60 as ttl, case when tunnel = 0 then (case when v6 then 'AAAA' else 'A' end) else 'CNAME' end as type from flows where packets = 1 and tunnel in (0, 5)")
def k7_passive_dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(c("TUNNEL_TYPE") == 0, F.when(ips.is_v4(c("SRC_IP")), 1).otherwise(28)).when(c("TUNNEL_TYPE") == 5, 5).otherwise(15)
    df = flows(spark, sf_dir).withColumns({"DNS_ANSWERS": F.lit(1), "DNS_RCODE": F.lit(0), "DNS_QTYPE": kind, "DNS_RDATA": F.when(c("TUNNEL_TYPE") == 0, ips.text(c("SRC_IP"))).otherwise(F.concat(F.lit("name"), c("TUNNEL_TYPE").cast("string"))), "DNS_NAME": F.concat(F.lit("q"), c("SRC_PORT").cast("string")), "DNS_RR_TTL": F.lit(60), "SRC_PORT": F.lit(53)})
    return writers.passive_dns(df).select("response", "query", "ttl", "type")


@query("select seq, 'Flow from ' || src_ip || ' to port ' || dport || ' (' || octets || ' B)' as mail from flows")
def k8_mail_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.mail_texts(flows(spark, sf_dir), "Flow from $SRC_IP to port $DST_PORT ($BYTES B)").select("seq", "mail")


@query("select 'store' as action, count(*) as n from flows where dport = 53 or (dport = 80 and dport <> 25) union all select 'warn', count(*) from flows where dport <> 25 and dport = 80 union all select 'rest', count(*) from flows where dport <> 25 and dport <> 80")
def k9_alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("DST_PORT == 53", ["store"], []), ("DST_PORT == 25", ["drop"], []), ("DST_PORT == 80", ["store", "warn"], ["rest"])]
    out = None
    for name, df in writers.ruled(flows(spark, sf_dir), rules).items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("action"), "n")
        out = part if out is None else out.union(part)
    return out


@query("select 'FLOWS,PACKETS,BYTES' as header, count(*) || ',' || sum(packets)::bigint || ',' || sum(octets)::bigint as values from flows")
def k10_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.snapshot(counters.totals(flows(spark, sf_dir)))


@query("select seq || chr(9) || src_ip || chr(9) || octets as value from flows")
def k11_text_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.text_report(flows(spark, sf_dir).select("seq", "SRC_IP", "BYTES"))


# --- scripts, models, plug-ins -------------------------------------------------------------


@query("select seq, dport * 2 as TWICE from flows where dport <> 80")
def u1_record_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).select("seq", "DST_PORT")
    return records.scripted(df, f"{kinds(df)['seq']} seq,int64 TWICE", lambda r, _: None if r["DST_PORT"] == 80 else {"seq": r["seq"], "TWICE": 2 * r["DST_PORT"]})


@query("select dport as DST_PORT, max(octets) - min(octets) as spread, quantile_cont(packets, 0.5)::double as middle from flows group by dport")
def u4_registered_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).groupBy("DST_PORT").agg(records.registered("range", "BYTES").alias("spread"), records.registered("median", "PACKETS").cast("double").alias("middle"))


#: Models as a trainer would have stored them: weights by feature.
MODELS = {"busy": {"peers": 0.5, "connections": 0.25, "": -20.0}, "client": {"begins_ratio": 4.0, "tcp_ratio": -0.5, "": -1.9}}


@query(""", r as (select s4 as host, d4 as peer, true as is_src, proto, t1, seq from flows where not v6 union all select d4, s4, false, proto, t1, seq from flows where not v6),
n as (select *, coalesce(t1 - lag(t1) over (partition by host, peer order by t1, seq, is_src) > 60, true) as fresh from r),
f as (select host, count(distinct peer) as peers, count(*) filter (fresh) as connections, count(*) filter (fresh and is_src) / count(*) filter (fresh)::double as begins_ratio, count(*) filter (proto = 6) / count(*)::double as tcp_ratio from n group by host)
select printf('%08x', host) as host, (0.5 * peers + 0.25 * connections - 20 > 0)::int as is_busy, (4 * begins_ratio - 0.5 * tcp_ratio - 1.9 > 0)::int as is_client from f""")
def u3_multi_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts labelled by stored models; one that was never trained is left out."""
    folder = shared_folder(spark)
    features.write_models(spark, MODELS, folder)
    models = features.read_models(spark, ["busy", "client", "untrained"], folder)
    return features.labelled(features.device_features(flows(spark, sf_dir)), models).select(F.lower(F.hex("host")).alias("host"), "is_busy", "is_client")


@query("select * from (values (0, 'SRC_IP', 'ipaddr'), (1, 'BYTES', 'uint64'), (2, 'TIME_FIRST', 'time')) as t(id, name, type)", plain=True)
def x18_template_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.described(flows(spark, sf_dir).select("SRC_IP", "BYTES", "TIME_FIRST"))


# --- alerts ------------------------------------------------------------------------------------

_WHEN = "strftime(make_timestamp({} * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


@query(f"select seq::varchar as id, {_WHEN.format('t2')} as at, 'Availability.DoS' as category, case when not v6 then dst_ip end as ip4, case when v6 then dst_ip end as ip6, octets as n from flows")
def r5_volume_attack(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alerts.volume_attack(flows(spark, sf_dir).withColumn("EVENT_ID", c("seq")))
    return a.select(c("AltNames")[0].alias("id"), c("DetectTime").alias("at"), c("Category")[0].alias("category"), c("Target")[0]["IP4"][0].alias("ip4"), c("Target")[0]["IP6"][0].alias("ip6"), c("ByteCount").alias("n"))


@query("select case dport when 53 then 'DNS amplification' when 123 then 'NTP amplification' end as description, case dport when 53 then 'domain' when 123 then 'ntp' end as service, packets as n, octets as bytes_out, case when not v6 then src_ip end as ip4 from flows")
def r1_amplification(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).select("*", c("DST_PORT").alias("P"), *[F.lit(1).alias(x) for x in ("REQ_FLOWS", "REQ_PACKETS", "REQ_BYTES", "RSP_PACKETS")], c("PACKETS").alias("RSP_FLOWS"), c("BYTES").alias("RSP_BYTES")).withColumn("SRC_PORT", c("P"))
    a = alerts.amplification(df)
    return a.select(c("Description").alias("description"), c("Source")[0]["Proto"][1].alias("service"), c("FlowCount").alias("n"), c("Source")[0]["OutByteCount"].alias("bytes_out"), c("Source")[0]["IP4"][0].alias("ip4"))


@query("select 'q' || sport as name, case when not v6 then src_ip end as ip4, 'CC' as role from flows")
def r6_generated_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alerts.generated_domains(flows(spark, sf_dir).withColumn("DNS_Q_NAME", F.concat(F.lit("q"), c("SRC_PORT").cast("string"))))
    return a.select(c("Source")[1]["Hostname"][0].alias("name"), c("Source")[0]["IP4"][0].alias("ip4"), c("Source")[1]["Type"][1].alias("role"))


@query("select 'Communication tunnel over DNS observed in ' || case tunnel when 1 then 'requests' else 'responses' end as description, 'Example of used domain name: d?' || dport as note from flows where tunnel in (1, 4, 5)")
def r7_dns_tunnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumn("TUNNEL_CNT_PACKET", c("PACKETS")).withColumn("TUNNEL_DOMAIN", F.concat(F.lit("dé"), c("DST_PORT").cast("string")))
    return alerts.dns_tunnel(df).select(c("Description").alias("description"), c("Note").alias("note"))


@query("select packets as n, dport as port, case when v6 then null else dst_ip || ',' || src_ip end as hosts, '00:05:00' as win from flows")
def r8_horizontal_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumns({"ADDR_CNT": c("PACKETS"), "DST_IP0": c("DST_IP"), "DST_IP1": c("SRC_IP"), "DST_IP2": ips.literal(bytes(16))})
    return alerts.horizontal_scan(df).select(c("FlowCount").alias("n"), c("Target")[0]["Port"][0].alias("port"), F.array_join(c("Target")[0]["IP4"], ",").alias("hosts"), c("Node")[0]["AggrWin"].alias("win"))


@query("select case when dport = 80 then 'Vertical scan using TCP SYN' else 'Block portscan using TCP SYN' end as description, case when dport = 80 then packets else packets + octets end as n from flows")
def r16_vertical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.create_map(ips.text(c("DST_IP")), c("PACKETS"))
    two = F.create_map(ips.text(c("DST_IP")), c("PACKETS"), F.lit("192.0.2.1"), c("BYTES"))
    df = flows(spark, sf_dir).withColumn("dst_ips", F.when(c("DST_PORT") == 80, one).otherwise(two)).withColumn("src_ip", ips.text(c("SRC_IP")))
    return alerts.vertical_scan(df).select(c("Description").alias("description"), c("FlowCount").alias("n"))


@query("select 'Multiple unsuccessful login attempts' || case when dport = 22 then ' on SSH' else '' end as description, case proto when 6 then 'tcp' when 17 then 'udp' else 'icmp' end as proto, packets as n from flows where tunnel = 2")
def r4_brute_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumns({"WARDEN_TYPE": c("TUNNEL_TYPE"), "DETECTION_TIME": c("TIME_LAST"), "EVENT_SCALE": c("PACKETS")})
    return alerts.brute_force(df).select(c("Description").alias("description"), c("Source")[0]["Proto"][0].alias("proto"), c("FlowCount").alias("n"))


@query("select 'Machine Learning model recognized approx. ' || packets || ' unsuccessful login attempts from ' || src_ip || ' against SSH server ' || dst_ip as note from flows")
def r13_learned_ssh(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumns({"ATTEMPTS": c("PACKETS"), "EVENT_TIME": c("TIME_LAST")})
    return alerts.learned_ssh(df).select(c("Note").alias("note"))


@query("select src_ip || ' might be a miner, because it connected to ' || dst_ip || ':' || dport || ' which is flagged as a mining pool server.' as description, packets as n from flows")
def r11_miner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.miner(flows(spark, sf_dir).withColumn("EVENT_SCALE", c("PACKETS"))).select(c("Description").alias("description"), c("ConnCount").alias("n"))


@query(f"select case tunnel when 0 then case when dport = 53 then 'Successful SIP BruteForce login attempt.' else 'SIP BruteForce login attempt.' end when 1 then case when dport = 53 then 'Successful distributed SIP BruteForce login attempt.' else 'Distributed SIP BruteForce login attempt.' end else 'Scan of SIP user accounts.' end as description, case when tunnel < 2 and dport = 53 then {_WHEN.format('t2')} end as breach, case when proto = 6 then 'tcp' else 'udp' end as proto from flows where tunnel in (0, 1, 2)")
def r12_sip_brute_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    df = flows(spark, sf_dir).withColumns({"SBFD_EVENT_TYPE": c("TUNNEL_TYPE"), "SBFD_BREACH_TIME": F.when(c("DST_PORT") == 53, c("TIME_LAST")).otherwise(zero), "SBFD_EVENT_TIME": c("TIME_FIRST"), "SBFD_CEASE_TIME": c("TIME_LAST"), "SBFD_ATTEMPTS": c("PACKETS"), "SBFD_USER": F.lit("u"), "SBFD_PROTOCOL": c("PROTOCOL"), "SBFD_SOURCE": c("SRC_IP"), "SBFD_TARGET": c("DST_IP")})
    return alerts.sip_brute_force(df).select(c("Description").alias("description"), c("BreachTime").alias("breach"), c("Source")[0]["Proto"][0].alias("proto"))


@query("select packets as calls, 'u' || sport as agent, 'Attempt.Login' as category from flows where dport = 53")
def r15_voip_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir).withColumns({"EVENT_TYPE": F.when(c("DST_PORT") == 53, 40).otherwise(41), "DETECTION_TIME": c("TIME_LAST"), "VOIP_FRAUD_USER_AGENT": F.concat(F.lit("u"), c("SRC_PORT").cast("string")), **{f"VOIP_FRAUD_{x}": F.lit("x") for x in ("SIP_FROM", "SIP_TO")}, **{f"VOIP_FRAUD_{x}": c("PACKETS") for x in ("INVITE_COUNT", "PREFIX_LENGTH", "PREFIX_EXAMINATION_COUNT", "SUCCESSFUL_CALL_COUNT")}})
    return alerts.voip_fraud(df).select(c("SuccessfulCalls").alias("calls"), c("Source")[0]["UserAgent"][0].alias("agent"), c("Category")[0].alias("category"))


@query("select case when sport = 1221 then 0.05 when dport = 53 then 0.9 else 0.3 end::double as confidence, 'Attempt to activate VENOM rootkit on ' || dst_ip || '.' as description, case when proto in (6, 17) then dport end as port from flows")
def r14_rootkit(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alerts.rootkit(flows(spark, sf_dir).withColumn("VENOM", F.when(c("DST_PORT") == 53, 255).otherwise(3)))
    return a.select(c("Confidence").alias("confidence"), c("Description").alias("description"), c("Source")[1]["Port"][0].alias("port"))


_KIND = "case dport when 53 then 2 when 80 then 10 when 443 then 15 when 22 then 30 else 99 end"


@query(f"select {_KIND} as kind, case {_KIND} when 2 then 'Horizontal port scan' when 30 then 'SSH dictionary/bruteforce attack' when 15 then 'Abnormally high number of large DNS replies' else 'Abnormally high number of ' || case when proto = 6 then 'TCP SYN packets' else 'packets' end end as description, case when {_KIND} = 30 then 2 * packets else packets end as n, case when {_KIND} = 10 then sport end as sources from flows where {_KIND} <> 99")
def r9_host_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(c("DST_PORT") == 53, 2).when(c("DST_PORT") == 80, 10).when(c("DST_PORT") == 443, 15).when(c("DST_PORT") == 22, 30).otherwise(99)
    note = F.format_string("in: 5 flows, 6 packets; out: 7 flows, 8 packets; approx. %d source addresses", c("SRC_PORT"))
    df = flows(spark, sf_dir).withColumns({"EVENT_TYPE": kind, "EVENT_SCALE": c("PACKETS"), "NOTE": note})
    a = alerts.host_events(df)
    kinds = F.when(c("Description").startswith("Horiz"), 2).when(c("Description").startswith("SSH"), 30).when(c("Description").endswith("replies"), 15).otherwise(10)
    return a.select(kinds.alias("kind"), c("Description").alias("description"), c("FlowCount").alias("n"), c("Source")[0]["Count"].alias("sources"))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = flows(spark, sf_dir)
    return t.select("seq", F.when(c("DST_PORT") == 53, "url").otherwise("ip").alias("type"), c("LINK_BIT_FIELD").alias("blacklist_id"), c("PROTOCOL").alias("protocol"), ips.text(c("SRC_IP")).alias("source"), ips.text(c("SRC_IP")).alias("source_ip"), F.lit("bad.example").alias("source_url"), (c("SRC_PORT") % 2 == 0).alias("is_only_fqdn"), F.array("SRC_PORT").alias("source_ports"), F.array(ips.text(c("DST_IP"))).alias("targets"), c("TIME_FIRST").alias("ts_first"), c("TIME_LAST").alias("ts_last"), F.lit(5).alias("agg_win_minutes"), *[c("PACKETS").alias(f"src_sent_{x}") for x in ("flows", "bytes", "packets")], *[(c("SRC_PORT") % 3).alias(f"tgt_sent_{x}") for x in ("flows", "bytes", "packets")])


@query(", l as (select * from (values (1, 'one', 'Intrusion.Botnet'), (2, 'two', 'Suspicious.Miner')) as l(id, name, category)) select category, case when sport % 3 > 0 then 'Suspicious communication with ' || case when dport <> 53 then 'IP' when sport % 2 = 0 then 'domain name' else 'URL' end || ' listed on ' || name || ' blacklist' else 'Blacklisted IP tried to communicate with host (with no response)' end as description, case category when 'Intrusion.Botnet' then 'CC' else 'PoolServer' end as role, (sport % 3 = 0)::int as targets, '00:05:00' as win, case when dport <> 53 then packets + sport % 3 end as n from flows join l on link = id")
def r2_blacklisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = joins.blacklist_table(spark, [(1, "one", "Intrusion.Botnet", "src1"), (2, "two", "Suspicious.Miner", "src2")])
    a = alerts.blacklisted(_reports(spark, sf_dir), lists)
    return a.select(c("Category")[0].alias("category"), c("Description").alias("description"), c("Source")[0]["Type"][0].alias("role"), F.when(c("Target").isNull(), 0).otherwise(F.size("Target")).alias("targets"), c("Node")[0]["AggrWin"].alias("win"), c("FlowCount").alias("n"))


@query("select (not v6 and s4 between 167772160 and 167772175)::int as own, case when not v6 and s4 between 167772160 and 167772175 then 'IP ' || src_ip || ' and port(s) ' || sport || ' is listed as a mining pool server, and IP ' || dst_ip || ' communicated with it.' else 'Detected possible CryptoCurrency mining by IP ' || dst_ip || ', because of observed communication with ' || src_ip || ':' || sport || ' listed as a mining pool server.' end as note from flows")
def r3_mining_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alerts.mining_pool(_reports(spark, sf_dir), ["10.0.0.0/28"])
    return a.select(F.when(c("Target").isNull(), 1).otherwise(0).alias("own"), c("Note").alias("note"))


@query("select seq, octets as BYTES from flows")
def r10_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.passed(flows(spark, sf_dir)).select("seq", "BYTES")


#: Columns that the SQL gives as 32-bit integers.
WIDE = {
    "p2_routes": ("out_id",),
    "a24_age_histogram": ("max_age",),
    "a25_tunnels": ("tunnel",),
    "a29_ports_of_ports": ("listed",),
    "a29_addresses_of_ports": ("listed",),
    "j2_prefix_tag_source": ("PREFIX_TAG",),
    "j2_prefix_tag_both": ("PREFIX_TAG", "PREFIX_TAG_DST"),
    "j4_domain_suffix": ("SNI_ID",),
    "o3_sampling_rates": ("rate",),
    "x6_x17_scalars": ("top",),
    "x8_x12_strings": ("id",),
    "s2_flow_dump": ("DIR",),
    "k7_passive_dns": ("ttl",),
    "r9_host_events": ("kind",),
    "r2_blacklisted": ("targets",),
    "r3_mining_pool": ("own",),
}
for _name, _columns in WIDE.items():
    ORACLES[_name] = f"select * replace ({', '.join(f'{x}::bigint as {x}' for x in _columns)}) from ({ORACLES[_name]})"
