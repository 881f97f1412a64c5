"""Projection to templates, routing to several outputs, pass-through."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import ip as ips
from ..plans import filters
from ..schema import KIND, FieldSpec, kinds, parse_template, zero

LONGEST_TEXT = 1024


def _default(spec: FieldSpec) -> Column:
    if spec.default is None:
        return zero(spec)
    text = spec.default.strip('"')
    if spec.kind == "ipaddr":
        return ips.literal(ips.packed(text))
    if spec.kind == "time":
        return F.lit(text.replace("T", " ")).cast("timestamp_ntz")
    return F.lit(text).cast(spec.spark_type)


def projected(df: DataFrame, template: str) -> DataFrame:
    """Only the template's fields: copied where the input has them, else the default or zero.

    Texts are cut at LONGEST_TEXT characters. An empty template is the input's own.
    """
    if not template.strip():
        return df
    out = []
    for f in parse_template(template):
        column = F.coalesce(F.col(f.name).cast(f.spark_type), zero(f)) if f.name in df.columns else _default(f)
        if f.kind in ("string", "bytes") and not f.array:
            column = F.substring(column, 1, LONGEST_TEXT)
        out.append(column.alias(f.name, metadata={KIND: f.kind + "*" * f.array}))
    return df.select(*out)


def route_specs(text: str) -> list[tuple[str, str]]:
    """(template, filter) of each output in ``TEMPLATE:FILTER;…``; ``#`` starts a comment."""
    text = re.sub(r"#[^\n]*", "", text)
    out = []
    for part in re.findall(r'(?:[^;"]|"[^"]*")+', text):
        if part.strip():
            template, _, condition = part.partition(":") if ":" in part else ("", "", part)
            out.append((template.strip(), condition.strip()))
    if not 0 < len(out) <= 32:
        raise ValueError("1 to 32 outputs are possible")
    return out


def routed(df: DataFrame, spec: str) -> dict[int, DataFrame]:
    """Each output's records. A record goes to every output whose filter it meets."""
    return {i: projected(filters.matching(df, condition), template) for i, (template, condition) in enumerate(route_specs(spec))}


def tagged_routes(df: DataFrame, spec: str) -> DataFrame:
    """All outputs in one pass: the input's columns and ``out_id``, a row for each output met."""
    conditions = [filters.condition(df, c) for _, c in route_specs(spec)]
    ids = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)]))
    return df.withColumn("out_id", F.explode(ids))


def first_received(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """The first n records received, before any filter."""
    return df.orderBy(order).limit(n)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The input unchanged, and an observation of the number of records."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen


def with_fields(df: DataFrame, add: dict[str, Column] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add or replace fields, then drop some."""
    return df.withColumns(add or {}).drop(*drop)


def described(df: DataFrame) -> DataFrame:
    """The template as rows: id (place), name, type."""
    rows = [(i, n, k) for i, (n, k) in enumerate(kinds(df).items())]
    return df.sparkSession.createDataFrame(rows, "id int, name string, type string")


def swapped(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """The named integers with their bytes in reverse order; the number is the width in bytes."""
    from ..functions.scalar import bswap

    return df.withColumns({c: bswap(F.col(c), n) for c, n in columns.items()})
