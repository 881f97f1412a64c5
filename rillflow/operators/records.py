"""User code on records: Column expressions first, Arrow batches where code is needed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import parse_template, struct

#: Aggregates by name, for :func:`registered`.
_REGISTRY: dict[str, Callable[[Column], Column]] = {}


def transformed(df: DataFrame, fields: dict[str, Column], keep: Column | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """A record script as expressions: ``keep`` false drops a record, ``fields`` are set, ``drop`` deleted."""
    rows = df if keep is None else df.where(keep)
    return rows.withColumns(fields).drop(*drop)


def scripted(df: DataFrame, template: str, on_record: Callable[[dict, int], dict | None], on_init: Callable[[], None] | None = None) -> DataFrame:
    """A record script as code: gets a record and its number in the partition, returns a record of the template or None."""
    schema = struct(parse_template(template))
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if on_init:
            on_init()
        n = 0
        for b in batches:
            out = []
            for rec in b.to_dict("records"):
                new = on_record(rec, n)
                n += 1
                if new is not None:
                    out.append([new.get(c) for c in names])
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def converted(df: DataFrame, convert: Callable[[dict], dict | None]) -> DataFrame:
    """An alert converter as code: a dict for each record (None drops it), as JSON text in ``value``."""
    import json

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            docs = [d for d in map(convert, b.to_dict("records")) if d is not None]
            yield pd.DataFrame({"value": [json.dumps(d, default=str) for d in docs]})

    return df.mapInPandas(run, "value string")


def register(name: str, maker: Callable[[Column], Column]) -> None:
    """Make an aggregate known by name; it builds a Column from a Column."""
    _REGISTRY[name.upper()] = maker


def registered(name: str, field: str) -> Column:
    return _REGISTRY[name.upper()](F.col(field))


register("GEOMEAN", lambda c: F.exp(F.avg(F.log(c))))
register("RANGE", lambda c: F.max(c) - F.min(c))
register("MEDIAN", lambda c: F.percentile(c, F.lit(0.5)))
