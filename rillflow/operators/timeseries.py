"""Time series from records that last: rules ``NAME:FUNC(FIELD)[:FILTER]``.

A record's value is spread evenly over its duration; every step it touches
gets its share. Both ends of a step are inclusive, so a record that ends at a
border counts in both steps. A record without duration gives its whole value
to every touched step. Buffered steps are flushed at the end (deviation: they
aren't lost), and values of records without duration don't turn into NaN.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import seconds, whole_seconds
from ..plans import filters

FUNCTIONS = ("SUM", "COUNT", "AVG", "RATE", "COUNT_UNIQ")
_RULE = re.compile(r"([A-Za-z][A-Za-z0-9_]*):([A-Za-z_]+)\(([A-Za-z][A-Za-z0-9_]*)?\)(?::(.*))?$", re.DOTALL)


@dataclass(frozen=True)
class Rule:
    name: str
    function: str
    field: str
    condition: str = ""


def parsed_rule(text: str) -> Rule:
    m = _RULE.match(text.strip().replace(r"\:", "\0"))
    if not m or m[2].upper() not in FUNCTIONS or (m[2].upper() != "COUNT" and not m[3]):
        raise ValueError(f"bad rule: {text!r}")
    return Rule(m[1], m[2].upper(), m[3] or "", (m[4] or "").replace("\0", ":").strip())


def parsed_rules(text: str) -> list[Rule]:
    rules = [parsed_rule(r) for r in text.split(",") if r.strip()] if "\n" not in text else [parsed_rule(r) for r in text.splitlines() if r.strip()]
    if not 0 < len(rules) <= 32 or len({r.name for r in rules}) != len(rules):
        raise ValueError("1 to 32 rules with different names are possible")
    return rules


def stepped(df: DataFrame, step: int) -> DataFrame:
    """A row for each record and step it touches: TIME (begin of the step, seconds) and share (0 to 1)."""
    first, last = whole_seconds(F.col("TIME_FIRST")), whole_seconds(F.col("TIME_LAST"))
    begin = F.floor(first / step) - F.when(F.pmod(first, F.lit(step)) == 0, 1).otherwise(0)
    rows = df.withColumn("_k", F.explode(F.sequence(begin, F.greatest(begin, F.floor(last / step)))))
    rows = rows.withColumn("TIME", (F.col("_k") * step).cast("long")).withColumn("_a", seconds(F.col("TIME_FIRST"))).withColumn("_b", seconds(F.col("TIME_LAST")))
    overlap = F.least(F.col("_b"), (F.col("TIME") + step).cast("double")) - F.greatest(F.col("_a"), F.col("TIME").cast("double"))
    span = F.col("_b") - F.col("_a")
    return rows.withColumn("share", F.when(span > 0, F.greatest(overlap, F.lit(0.0)) / F.nullif(span, F.lit(0.0))).otherwise(F.lit(1.0))).drop("_k", "_a", "_b")


def _column(rule: Rule, df: DataFrame, step: int) -> Column:
    met = filters.condition(df, rule.condition) if rule.condition else F.lit(True)
    part = F.when(met, F.col(rule.field).cast("double") * F.col("share")) if rule.field and rule.function not in ("COUNT", "COUNT_UNIQ") else None
    count = F.count(F.when(met, F.lit(1)))
    return {
        "SUM": lambda: F.coalesce(F.sum(part), F.lit(0.0)),
        "COUNT": lambda: count,
        "AVG": lambda: F.when(count > 0, F.sum(part) / F.nullif(count, F.lit(0))).otherwise(F.lit(0.0)),
        "RATE": lambda: F.coalesce(F.sum(part), F.lit(0.0)) / step,
        "COUNT_UNIQ": lambda: F.count_distinct(F.when(met, F.col(rule.field))),
    }[rule.function]().alias(rule.name)


def series(df: DataFrame, rules: list[Rule], step: int, delay: int | None = None, inactive: int | None = None) -> DataFrame:
    """One row for each step: TIME and a column for each rule.

    With ``delay``, what lies more than that before the clock of a record's
    arrival (column ``clock``) is late and lost, like in a stream with this
    watermark; ``inactive`` starts over after a silence of so many seconds by
    dropping what came before it.
    """
    if inactive is not None:
        from pyspark.sql import Window

        # one row for each step that has records; silences are found there
        tops = df.groupBy((F.floor(whole_seconds(F.col("TIME_FIRST")) / step) * step).cast("long").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
        quiet = F.col("_t") - F.lag("_t").over(Window.orderBy("_t")) > inactive
        start = tops.withColumn("_q", quiet).agg(F.max(F.when(F.col("_q"), F.col("_t")))).first()[0]
        df = df if start is None else df.where(whole_seconds(F.col("TIME_FIRST")) >= start)
    rows = stepped(df, step)
    if delay is not None:
        rows = rows.where(F.col("TIME") + step > F.col("clock") - delay)
    return rows.groupBy("TIME").agg(*[_column(r, df, step) for r in rules])
