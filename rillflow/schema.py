"""Record templates: ``"type NAME,type NAME"`` to Spark schemas.

Records know no nulls: a missing value is zero or empty. Every boundary that
adds columns fills them with the typed zero of :func:`zero`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Record types and the Spark types that hold all their values.
TYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "int128": T.DecimalType(38, 0),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.LongType(),
    "char": T.StringType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "ipaddr": T.BinaryType(),
    "macaddr": T.BinaryType(),
    "time": T.TimestampNTZType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}
KIND = "record_type"
_FIELD = re.compile(r"\s*([a-z]+[0-9]*)(\*?)\s+([A-Za-z][A-Za-z0-9_]*)\s*(?:=(.*))?$")
INTEGERS = frozenset(k for k in TYPES if "int" in k)


@dataclass(frozen=True)
class FieldSpec:
    name: str
    kind: str
    array: bool = False
    default: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        base = TYPES[self.kind]
        return T.ArrayType(base) if self.array else base


def parse_template(spec: str) -> list[FieldSpec]:
    """Fields of ``"type NAME[=default],…"``; an empty text has none."""
    fields = []
    for part in filter(str.strip, _outside_quotes(spec)):
        m = _FIELD.match(part)
        if not m or m[1] not in TYPES:
            raise ValueError(f"bad field in template: {part.strip()!r}")
        fields.append(FieldSpec(m[3], m[1], bool(m[2]), None if m[4] is None else m[4].strip()))
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise ValueError(f"a field stands twice in template: {spec!r}")
    return fields


def _outside_quotes(spec: str) -> list[str]:
    """Parts between commas, where commas in double quotes don't count."""
    return re.findall(r'(?:[^,"]|"[^"]*")+', spec)


def struct(fields: list[FieldSpec]) -> T.StructType:
    """The Spark schema; the record type stays in each column's metadata."""
    return T.StructType([T.StructField(f.name, f.spark_type, True, {KIND: f.kind + "*" * f.array}) for f in fields])


def kinds(df: DataFrame) -> dict[str, str]:
    """The record type of each column: from metadata, else by the Spark type."""
    plain = {T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64", T.DecimalType: "int128", T.FloatType: "float", T.DoubleType: "double", T.BinaryType: "ipaddr", T.StringType: "string", T.TimestampNTZType: "time", T.TimestampType: "time"}
    out = {}
    for f in df.schema.fields:
        base, star = (f.dataType.elementType, "*") if isinstance(f.dataType, T.ArrayType) else (f.dataType, "")
        known = "string" if isinstance(base, T.DecimalType) and base.scale else plain.get(type(base), "string")
        out[f.name] = f.metadata.get(KIND) or known + star
    return out


def template_of(df: DataFrame) -> str:
    return ",".join(f"{kind} {name}" for name, kind in kinds(df).items())


def zero(spec: FieldSpec) -> Column:
    """The value of a missing field."""
    if spec.array:
        return F.array().cast(spec.spark_type)
    if spec.kind in ("string", "char"):
        return F.lit("")
    if spec.kind == "bytes":
        return F.lit(bytearray(b""))
    if spec.kind == "ipaddr":
        return F.lit(bytearray(16))
    if spec.kind == "macaddr":
        return F.lit(bytearray(6))
    if spec.kind == "time":
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.lit(0).cast(spec.spark_type)


def required(df: DataFrame, spec: str) -> None:
    """A record stream may have more fields than asked for, but none less."""
    missing = [f.name for f in parse_template(spec) if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing fields: {', '.join(missing)}")
