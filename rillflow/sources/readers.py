"""Readers of records: CSV with a template line, JSON lines, generated records, stored streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ip as ips
from ..schema import KIND, FieldSpec, parse_template, required, struct

LONGEST_DYNAMIC = 16384


def _scalar(text: Column, kind: str) -> Column:
    if kind == "ipaddr":
        return ips.parse(text)
    if kind == "macaddr":
        return F.when(text.rlike(r"^(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}$"), F.unhex(F.regexp_replace(text, ":", "")))
    if kind == "time":
        return F.regexp_replace(text, "T", " ").try_cast("timestamp_ntz")
    if kind in ("string", "char"):
        return F.substring(text, 1, LONGEST_DYNAMIC)
    if kind == "bytes":
        return F.substring(F.unhex(text), 1, LONGEST_DYNAMIC)
    return text.try_cast(FieldSpec("x", kind).spark_type)


def _parsed(text: Column, f: FieldSpec) -> Column:
    if not f.array:
        return _scalar(text, f.kind)
    inner = F.regexp_replace(text, r"^\[|\]$", "")
    return F.when(inner == "", F.array().cast(f.spark_type)).otherwise(F.transform(F.split(inner, r"\|"), lambda x: _scalar(x, f.kind)))


def _typed(rows: DataFrame, fields: list[FieldSpec]) -> DataFrame:
    """Typed columns from text columns; rows with a bad fixed field go."""
    out = rows.select(*[_parsed(F.col(f.name), f).alias(f.name, metadata={KIND: f.kind + "*" * f.array}) for f in fields])
    for f in fields:
        if f.kind not in ("string", "bytes", "char") and not f.array:
            out = out.where(F.col(f.name).isNotNull())
    return out.na.fill("", [f.name for f in fields if f.kind in ("string", "char") and not f.array])


def header_of(spark: SparkSession, path: str) -> str:
    """The template in the first line of a file; a leading ``time,`` only paces a replay and is no field."""
    first = spark.read.text(path).limit(1).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return first[0]


def read_csv(spark: SparkSession, path: str, limit: int | None = None, template: str | None = None) -> DataFrame:
    """Records of CSV files whose first line is the template. Quotes in quotes are doubled; arrays are ``[a|b]``."""
    head = template or header_of(spark, path)
    paced = head.startswith("time,")
    fields = parse_template(head[5:] if paced else head)
    names = (["_pace"] if paced else []) + [f.name for f in fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(text).option("quote", '"').option("escape", '"').option("header", template is None).option("enforceSchema", True).csv(path)
    out = _typed(rows, fields)
    return out if limit is None else out.limit(limit)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Records of JSON lines; blank and undecodable lines are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    kind = schema.simpleString() if isinstance(schema, T.StructType) else f"struct<{', '.join(':'.join(p.split()) for p in schema.split(','))}>"
    good = lines.where(F.try_parse_json("value").isNotNull())
    return good.select(F.from_json("value", kind).alias("r")).select("r.*")


def read_messages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines as variants, for messages without a common schema."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.try_parse_json("value").alias("message")).where("message is not null")


def generated(spark: SparkSession, n: int, fields: dict[str, Column]) -> DataFrame:
    """n records from expressions over ``id`` (0 to n - 1)."""
    return spark.range(n).select(*[c.alias(name) for name, c in fields.items()])


def shifted_time(base: Column, rule: str) -> Column:
    """A time by a rule: ``+x``, ``-x`` (from ``base``) or ``now±x`` seconds."""
    import re

    m = re.fullmatch(r"(now)?\s*([+-]\s*\d+(?:\.\d+)?)?", rule.strip())
    if not m:
        raise ValueError(f"bad time rule {rule!r}")
    start = F.current_timestamp().cast("timestamp_ntz") if m[1] else base
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float((m[2] or "0").replace(" ", ""))).cast("decimal(18,6)"))


def read_stored(spark: SparkSession, path: str, needs: str = "") -> DataFrame:
    """A recorded stream (Parquet); fails where required fields are missing."""
    df = spark.read.parquet(path)
    if needs:
        required(df, needs)
    return df


def flow_dump(df: DataFrame, condition: str = "", limit: int | None = None, interface: int = 0, link_mask: int = 1, restamp: str | None = None) -> DataFrame:
    """Flows of an exported dump brought to the standard record: filter, then limit, direction bit, link mask, new times.

    Dumps are converted to Parquet or CSV outside; their binary form belongs to an external library.
    """
    from ..plans.filters import matching

    rows = matching(df, condition) if condition else df
    rows = rows if limit is None else rows.limit(limit)
    bit = F.shiftleft(F.lit(1), interface) if interface > 0 else F.lit(0)
    rows = rows.withColumn("DIR_BIT_FIELD", bit.cast("short")).withColumn("LINK_BIT_FIELD", F.lit(link_mask).cast("long"))
    if restamp:
        span = F.col("TIME_LAST") - F.col("TIME_FIRST")
        rows = rows.withColumn("TIME_LAST", F.lit(restamp).cast("timestamp_ntz") + span).withColumn("TIME_FIRST", F.lit(restamp).cast("timestamp_ntz"))
    return rows


#: The standard flow record.
FLOW_TEMPLATE = "ipaddr DST_IP,ipaddr SRC_IP,uint64 BYTES,uint64 LINK_BIT_FIELD,time TIME_FIRST,time TIME_LAST,uint32 PACKETS,uint16 DST_PORT,uint16 SRC_PORT,uint8 DIR_BIT_FIELD,uint8 PROTOCOL,uint8 TCP_FLAGS,uint8 TOS,uint8 TTL"
FLOW_SCHEMA = struct(parse_template(FLOW_TEMPLATE))
