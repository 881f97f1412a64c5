"""Keyed aggregation of records, one-way and two-way.

An aggregation is a list of :class:`Agg`. Each builds one Column, so a whole
specification is one ``groupBy().agg()``: partial aggregation runs before the
shuffle. What depends on arrival asks for the order column ``seq``.

Sums don't wrap at the field's width, MAX starts from no value and not from
zero, addresses compare in their own order: deliberate deviations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Agg:
    """One output field. ``reverse`` names the field that holds the value in records of the other direction."""

    function: str
    field: str
    alias: str = ""
    reverse: str = ""
    key: str = ""
    descending: bool = False
    delimiter: str = ","
    size: int = 0

    @property
    def name(self) -> str:
        return self.alias or (f"{self.field}_UNIQUE_COUNT" if self.function == "UNIQUE_COUNT" else self.field)


def _empty(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return value == ""
    if isinstance(kind, T.BinaryType):
        return F.hex(value).rlike("^0*$")
    if isinstance(kind, T.NumericType):
        return value == 0
    return value.isNull()


def _zero(kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BinaryType):
        return F.lit(bytearray(b""))
    return F.lit(0).cast(kind) if isinstance(kind, T.NumericType) else F.lit(None).cast(kind)


def _integral(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _in_order(value: Column, order: Column) -> Column:
    """All values of a group in order of arrival."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])


def _joined(value: Column, order: Column, a: Agg) -> Column:
    """Values with a delimiter behind each; a value that doesn't fit whole is left out."""
    cost = len(a.delimiter)
    step = lambda acc, x: F.when(F.length(acc) + F.length(x) + cost <= a.size, F.concat(acc, x, F.lit(a.delimiter))).otherwise(acc)
    return F.aggregate(_in_order(value, order), F.lit(""), step)


def _merged(value: Column, key: Column, order: Column, a: Agg) -> Column:
    """Values of all arrays, sorted by the keys of theirs, ties by arrival and place."""
    n = F.when(F.size(value) == F.size(key), F.size(value)).otherwise(0)
    sign = -1 if a.descending else 1
    entry = lambda i: F.struct((F.get(key, i).cast("double") * sign).alias("k"), order.alias("o"), i.alias("i"), F.get(value, i).alias("v"))
    entries = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), entry)).otherwise(F.array())
    sorted_all = F.transform(F.array_sort(F.flatten(F.collect_list(entries))), lambda x: x["v"])
    return F.slice(sorted_all, 1, a.size) if a.size else sorted_all


def built(a: Agg, schema: T.StructType, value: Column | None = None, order: str = "seq", turned: Column | None = None) -> Column:
    """The aggregate expression of one output field."""
    value = F.col(a.field) if value is None else value
    kind = schema[a.field].dataType
    seq = F.col(order)
    filled = F.when(~_empty(value, kind), value)
    arrival = F.when(~_empty(value, kind), seq)
    makers: dict[str, Callable[[], Column]] = {
        "SUM": lambda: F.sum(value),
        "AVG": lambda: F.try_divide(F.sum(value) - F.pmod(F.sum(value), F.count(value)), F.count(value)).cast("long") if _integral(kind) else F.avg(value),
        "MIN": lambda: F.min(value),
        "MAX": lambda: F.max(value),
        "FIRST": lambda: F.min_by(value, seq),
        "LAST": lambda: F.max_by(value, seq),
        "FIRST_NON_EMPTY": lambda: F.coalesce(F.min_by(filled, arrival), _zero(kind)),
        "LAST_NON_EMPTY": lambda: F.coalesce(F.max_by(filled, arrival), _zero(kind)),
        "BITOR": lambda: F.bit_or(value),
        "BITAND": lambda: F.bit_and(value),
        "COUNT": lambda: F.sum(F.coalesce(value, F.lit(1))),
        "UNIQUE_COUNT": lambda: F.count_distinct(filled if isinstance(kind, T.StringType) else value),
        "APPROX_COUNT": lambda: F.approx_count_distinct(filled if isinstance(kind, T.StringType) else value, 0.01),
        "APPEND": lambda: _joined(value, seq, a) if isinstance(kind, T.StringType) else F.slice(F.flatten(_in_order(value, seq)), 1, a.size or 2**31 - 1),
        "SORTED_MERGE": lambda: _merged(value, F.col(a.key), seq, a),
        "SORTED_MERGE_DIR": lambda: _merged(value if turned is None else F.when(turned, F.transform(value, lambda x: -x)).otherwise(value), F.col(a.key), seq, a),
    }
    if a.function not in makers:
        raise ValueError(f"unknown function {a.function}")
    return makers[a.function]().alias(a.name)


def _implicit(df: DataFrame) -> list[Column]:
    one = F.sum("COUNT") if "COUNT" in df.columns else F.count(F.lit(1))
    out = [one.cast("long").alias("COUNT")]
    if "TIME_FIRST" in df.columns:
        out.append(F.min("TIME_FIRST").alias("TIME_FIRST"))
    if "TIME_LAST" in df.columns:
        out.append(F.max("TIME_LAST").alias("TIME_LAST"))
    return out


#: Functions whose result is a list of at most ``size`` elements.
LISTS = ("APPEND", "SORTED_MERGE", "SORTED_MERGE_DIR")


def _few(df: DataFrame, keys: list[str], a: Agg, value: Column, turned: Column | None, order: str) -> DataFrame:
    """Of each group the rows that can be in a list of ``a.size`` elements: keys, o (order), v, and for merges k and i.

    Ranks are limited before the shuffle too, so a hot group costs ``size``
    rows of each task.

    * Arrays in order of arrival: each that isn't empty gives an element, so the first ``size`` are enough.
    * Texts: of one length, a text that doesn't fit ends its length for good, so the first ones of each length are enough.
    * Merges: the elements themselves are ranked.
    """
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    group = [f"_k{i}" for i in range(len(keys))] or [F.lit(0)]
    rows = df.select(*named, F.col(order).alias("o"), value.alias("v"), *([F.col(a.key).alias("_key")] if a.function != "APPEND" else []), *([turned.alias("_turned")] if turned is not None else []))
    if a.function != "APPEND":
        rows = rows.where(F.size("v") == F.size("_key"))
        rows = rows.select(*group if keys else [], "o", *(["_turned"] if turned is not None else []), F.posexplode(F.arrays_zip(F.col("_key").alias("k"), F.col("v").alias("v"))).alias("i", "e"))
        v = F.col("e.v") if turned is None else F.when(F.col("_turned"), -F.col("e.v")).otherwise(F.col("e.v"))
        rows = rows.select(*group if keys else [], "o", "i", F.col("e.k").alias("k"), v.alias("v"))
        by = [F.col("k").cast("double").desc() if a.descending else F.col("k").cast("double"), "o", "i"]
        return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*by))).where(F.col("_r") <= a.size)
    if isinstance(df.schema[a.field].dataType, T.StringType):
        cost = F.length("v") + len(a.delimiter)
        rows = rows.where(cost <= a.size)
        rank = F.row_number().over(Window.partitionBy(*group, F.length("v")).orderBy("o"))
        return rows.withColumn("_r", rank).where((F.col("_r") <= max(1, a.size // max(1, len(a.delimiter)))) & (F.col("_r") * cost <= a.size))
    rows = rows.where(F.size("v") > 0).withColumn("v", F.slice("v", 1, a.size))
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy("o"))).where(F.col("_r") <= a.size)


def _listed(df: DataFrame, keys: list[str], a: Agg, name: str, value: Column, turned: Column | None, order: str) -> DataFrame:
    """(_k0, …, name): the list of each group that has one, from a bounded number of rows."""
    few, kind = _few(df, keys, a, value, turned, order), df.schema[a.field].dataType
    group = [f"_k{i}" for i in range(len(keys))]
    if a.function != "APPEND":
        sign = -1 if a.descending else 1
        entries = F.array_sort(F.collect_list(F.struct((F.col("k").cast("double") * sign).alias("k"), "o", "i", "v")))
        out = F.transform(entries, lambda x: x["v"])
    else:
        values = F.transform(F.array_sort(F.collect_list(F.struct("o", "v"))), lambda x: x["v"])
        if isinstance(kind, T.StringType):
            cost = len(a.delimiter)
            out = F.aggregate(values, F.lit(""), lambda acc, x: F.when(F.length(acc) + F.length(x) + cost <= a.size, F.concat(acc, x, F.lit(a.delimiter))).otherwise(acc))
        else:
            out = F.slice(F.flatten(values), 1, a.size)
    return few.groupBy(*group).agg(out.alias(name))


def _grouped(df: DataFrame, keys: list[str], plain: list[Column], lists: list[tuple[Agg, str, Column, Column | None]], order: str) -> DataFrame:
    """``plain`` in one pass, each list joined by the keys (groups without one have an empty list)."""
    out = df.groupBy(*keys).agg(*plain)
    for a, name, value, turned in lists:
        part, kind = _listed(df, keys, a, name, value, turned, order), df.schema[a.field].dataType
        if keys:
            same = F.lit(True)
            for i, k in enumerate(keys):
                same = same & out[k].eqNullSafe(part[f"_k{i}"])
            out = out.join(part, same, "left").drop(*[f"_k{i}" for i in range(len(keys))])
        else:
            out = out.join(F.broadcast(part), F.lit(True), "left")  # one row on both sides
        out = out.withColumn(name, F.coalesce(name, F.lit("") if isinstance(kind, T.StringType) else F.array().cast(kind)))
    return out


def _bounded(a: Agg) -> bool:
    return a.function in LISTS and a.size > 0


def aggregated(df: DataFrame, keys: list[str], aggs: list[Agg], order: str = "seq") -> DataFrame:
    """Keys, COUNT, TIME_FIRST, TIME_LAST and the aggregates; without keys one group.

    Lists with a size are made of a bounded number of rows of each group;
    lists without one hold the group, as their result does.
    """
    names = [*keys, *[a.name for a in aggs]]
    if len(set(names)) != len(names):
        raise ValueError("an output field stands twice")
    lists = [(a, a.name, F.col(a.field), None) for a in aggs if _bounded(a)]
    out = _grouped(df, keys, [*_implicit(df), *[built(a, df.schema, order=order) for a in aggs if not _bounded(a)]], lists, order)
    return out.select(*keys, *[c for c in ("COUNT", "TIME_FIRST", "TIME_LAST") if c in out.columns], *[a.name for a in aggs])


def _arrival(df: DataFrame, order: str) -> Column:
    """(TIME_FIRST, order) as one number where it can be, so that the aggregate stays a hash aggregate."""
    if not _integral(df.schema[order].dataType):
        return F.struct("TIME_FIRST", order)
    micros = F.unix_micros(F.col("TIME_FIRST").cast("timestamp")).cast("decimal(18,0)")
    return micros * F.lit(Decimal(2**64)) + F.col(order).cast("decimal(20,0)")


FIVE_TUPLE = ("SRC_IP", "DST_IP", "SRC_PORT", "DST_PORT", "PROTOCOL")


def biflows(df: DataFrame, aggs: list[Agg], extra_keys: tuple[str, ...] = (), order: str = "seq") -> DataFrame:
    """Both directions of a connection in one row, in the direction of the record that began first.

    Keys are canonical (the smaller address first). Each aggregate gives
    ``name`` from records in the output's direction and ``reverse`` (or
    ``name_REV``) from those against it; an aggregate with ``reverse`` equal to
    its own field takes both. SORTED_MERGE_DIR takes both too, its values
    negative where a record's direction isn't the output's.

    A key is one binary value: the address in 16 bytes, its length, the port.
    """
    src, dst = (F.concat(F.lpad(F.col(f"{x}_IP"), 16, bytes(16)), F.unhex(F.lpad(F.hex(F.length(f"{x}_IP")), 2, "0")), F.unhex(F.lpad(F.hex(F.col(f"{x}_PORT").cast("int")), 4, "0"))) for x in ("SRC", "DST"))
    rows = df.withColumn("_src", src).withColumn("_dst", dst)
    rows = rows.withColumn("_rev", F.col("_src") > F.col("_dst")).withColumn("_low", F.least("_src", "_dst")).withColumn("_high", F.greatest("_src", "_dst")).drop("_src", "_dst")
    keys = ["_low", "_high", "PROTOCOL", *extra_keys]
    outs: list[Column] = [*_implicit(df), F.min_by("_rev", _arrival(df, order)).alias("_lead")]
    lists: list[tuple[Agg, str, Column, Column | None]] = []
    pairs = []
    for a in aggs:
        if a.reverse == a.field or a.function == "SORTED_MERGE_DIR":
            turned = F.col("_rev") if a.function == "SORTED_MERGE_DIR" else None
            if _bounded(a):
                lists.append((a, a.name, F.col(a.field), turned))
            else:
                outs.append(built(a, df.schema, order=order, turned=turned))
            continue
        back = a.reverse or f"{a.name}_REV"
        for side, rev in (("_f", False), ("_b", True)):
            own = F.when(F.col("_rev") == rev, F.col(a.field))
            if _bounded(a):
                lists.append((a, a.name + side, own, None))
            else:
                outs.append(built(a, df.schema, value=own, order=order).alias(a.name + side))
        pairs.append((a.name, back))
    both = _grouped(rows, keys, outs, lists, order)
    turn = F.col("_lead")
    pick = lambda x, y: F.when(turn, y).otherwise(x)
    columns = []
    for side, end in (("SRC", pick(F.col("_low"), F.col("_high"))), ("DST", pick(F.col("_high"), F.col("_low")))):
        width = F.conv(F.hex(F.substring(end, 17, 1)), 16, 10).cast("int")
        columns += [F.substr(end, 17 - width, width).alias(f"{side}_IP"), F.conv(F.hex(F.substring(end, 18, 2)), 16, 10).cast(df.schema[f"{side}_PORT"].dataType).alias(f"{side}_PORT")]
    columns += [F.col("PROTOCOL"), *map(F.col, extra_keys)]
    columns += [F.col(c) for c in ("COUNT", "TIME_FIRST", "TIME_LAST") if c in both.columns]
    for name, back in pairs:
        columns += [pick(F.col(f"{name}_f"), F.col(f"{name}_b")).alias(name), pick(F.col(f"{name}_b"), F.col(f"{name}_f")).alias(back)]
    for a in aggs:
        if a.function == "SORTED_MERGE_DIR":
            columns.append(F.when(turn, F.transform(a.name, lambda x: -x)).otherwise(F.col(a.name)).alias(a.name))
        elif a.reverse == a.field:
            columns.append(F.col(a.name))
    return both.select(*columns)


#: Option letters of the short form and their functions.
OPTIONS = {"s": "SUM", "a": "AVG", "m": "MIN", "M": "MAX", "f": "FIRST", "F": "FIRST_NON_EMPTY", "l": "LAST", "o": "BITOR", "n": "BITAND"}


def parsed_options(text: str) -> tuple[list[str], list[Agg], str]:
    """Keys, aggregates and time-out of ``-k FIELD -s FIELD … -t TYPE:N``."""
    words, keys, aggs, timeout = text.split(), [], [], ""
    for option, value in zip(words[::2], words[1::2], strict=True):
        letter = option.lstrip("-")
        if letter == "k":
            keys.append(value)
        elif letter == "t":
            timeout = value
        elif letter in OPTIONS:
            aggs.append(Agg(OPTIONS[letter], value))
        else:
            raise ValueError(f"unknown option {option}")
    return keys, aggs, timeout


def parsed_xml(text: str, section: str) -> tuple[list[str], list[Agg]]:
    """Keys and aggregates of the section with this id: ``<id name=…><field><name/><type/>…``."""
    import xml.etree.ElementTree as ET

    for node in ET.fromstring(text):
        if node.get("name") == section:
            keys, aggs = [], []
            for f in node.findall("field"):
                get = lambda tag, f=f: (f.findtext(tag) or "").strip()
                if get("type") == "KEY":
                    keys.append(get("name"))
                else:
                    aggs.append(Agg(get("type"), get("name"), reverse=get("reverse_name"), key=get("sort_key"), descending=get("sort_type").upper() in ("DESC", "DESCENDING"), delimiter=get("delimiter") or ",", size=int(get("size") or 0)))
            return keys, aggs
    raise ValueError(f"no section {section}")
