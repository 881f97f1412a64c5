"""Union, tagged union and split of record streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KIND, FieldSpec, kinds, zero
from .project import projected

MOST_INPUTS = 32


def merged(inputs: list[DataFrame], template: str = "") -> DataFrame:
    """All records of all inputs (UNION ALL). Missing fields are zero; the fields are all inputs' or the template's."""
    if not 0 < len(inputs) <= MOST_INPUTS:
        raise ValueError(f"1 to {MOST_INPUTS} inputs are possible")
    if template:
        return reduce(DataFrame.unionByName, [projected(df, template) for df in inputs])
    fields: dict[str, str] = {}
    for df in inputs:
        fields |= {n: k for n, k in kinds(df).items() if n not in fields}
    out = []
    for df in inputs:
        columns = []
        for name, kind in fields.items():
            spec = FieldSpec(name, kind.rstrip("*"), kind.endswith("*"))
            columns.append((F.coalesce(F.col(name), zero(spec)) if name in df.columns else zero(spec)).alias(name, metadata={KIND: kind}))
        out.append(df.select(*columns))
    return reduce(DataFrame.unionByName, out)


def muxed(inputs: list[DataFrame]) -> DataFrame:
    """One stream of records of different templates: message 1 (data), interface, payload as JSON."""
    if not 0 < len(inputs) <= MOST_INPUTS:
        raise ValueError(f"1 to {MOST_INPUTS} inputs are possible")
    rows = [df.select(F.lit(1).alias("message"), F.lit(i).alias("interface"), F.to_json(F.struct(*df.columns)).alias("payload")) for i, df in enumerate(inputs)]
    return reduce(DataFrame.union, rows)


def demuxed(rows: DataFrame, schemas: list) -> dict[int, DataFrame]:
    """Each interface's records again."""
    return {i: rows.where((F.col("message") == 1) & (F.col("interface") == i)).select(F.from_json("payload", s).alias("r")).select("r.*") for i, s in enumerate(schemas)}
