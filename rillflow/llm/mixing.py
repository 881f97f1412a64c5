"""Mixing sources to target weights with a time-varying curriculum.

Every source has a weight that changes linearly over the training run. The
weight's integral is the source's cumulative demand for words; the inverse of
that integral gives each document the position at which its first word is
due. Sorting by position gives the training order. Only DataFrame functions
are used, all of them run in the JVM.

A document is taken at most twice. Each source's documents stand in an order
by hash; the second turn follows the first. A document at the end of the
demand is taken in part, so each source gives its target to the word.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own and comes last; rows that repeat are separate documents; an
empty table gives an empty result; a source of size 0 has target 0; other
columns stay out of the computation, and names beginning with ``_mix_`` are
reserved for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import storage

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_TURNS = 2
#: The weight of source number k moves linearly from (1 + r) to (1 - r) of its mean, r by turns.
RAMPS = (0.5, 0.0, -0.5)
SLICES = 64


def words(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_TURNS) -> DataFrame:
    """Targets by water-filling: (source, source_size) -> with number, weight, target.

    A common level L with sum(min(L * weight, most * size)) = the wanted sum.
    Sources reach their bound in ascending order of bound / weight, so running
    sums in that order give the level. One row for each source takes part.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sources.withColumn("number", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("bound", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("bound") / F.col("weight"), "number")
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = (
        rows.withColumn("filled", F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("wanted", F.sum("source_size").over(all_rows) * F.lit(share_percent / 100.0))
        .withColumn("level", (F.col("wanted") - F.col("filled")) / F.col("left_weight"))
    )
    # The level that holds is the first one at which the source stays below its bound.
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("bound"), F.struct(F.col("bound") / F.col("weight"), F.col("number"), F.col("level").alias("level")))).over(all_rows)
    rows = rows.withColumn("open", open_level["level"])
    target = F.when(F.col("open").isNull(), F.col("bound")).otherwise(F.least(F.col("open") * F.col("weight"), F.col("bound")))
    return rows.select(*sources.columns, "number", "weight", F.greatest(target, F.lit(0.0)).alias("target"))


def position(demand: Column, target: Column, number: Column) -> Column:
    """The time in [0, 1] at which a source's cumulative demand reaches ``demand``.

    The rate target * (1 + r - 2 r t) integrates to target * ((1 + r) t - r t^2);
    the inverse is the smaller root of that square equation.
    """
    ramp = F.element_at(F.array(*[F.lit(r) for r in RAMPS]), (number % len(RAMPS) + 1).cast("int"))
    share = F.when(target > 0, demand / target).otherwise(F.lit(0.0))
    root = F.sqrt(F.greatest((1 + ramp) * (1 + ramp) - 4 * ramp * share, F.lit(0.0)))
    return F.when(ramp == 0, share).otherwise(2 * share / (1 + ramp + root))


def sized(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The columns ``keep`` with each document's source, size and place in its source's order, stored: words are counted once."""
    source = F.coalesce(F.col(source_col), F.lit(""))
    slices = max(SLICES, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(source_col).alias("_mix_source"),
        F.xxhash64(F.col(source_col).isNull(), source).alias("_mix_key"),
        words(F.col(text_col)).alias("_mix_size"),
        F.xxhash64(text_col).alias("_mix_mark"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long").alias("_mix_place"),
    )
    rows = rows.withColumn("_mix_slice", F.floor(F.col("_mix_place").cast("double") / 2.0**60 * slices).cast("int"))
    return storage.stored(rows, storage.shared_dir(docs.sparkSession), "sized")


def planned(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``sized`` with the plan of the mix in columns ``_mix_*``.

    took0 and took1 are the words taken at the first and second turn, pos0 and
    pos1 their positions. A source's running sum is built in two levels, within
    slices of the hash range and over the slices, so no task holds a whole
    source. The order within a source is by md5 of the id, so it is the same
    for every engine and every run.
    """
    by_slice = rows.groupBy("_mix_key", "_mix_slice").agg(F.first("_mix_source").alias("source"), F.sum("_mix_size").alias("slice_size"))
    upto = Window.partitionBy("_mix_key").orderBy("_mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = by_slice.withColumn("_mix_start", F.coalesce(F.sum("slice_size").over(upto), F.lit(0)))
    per_source = targets(by_slice.groupBy("_mix_key").agg(F.first("source").alias("source"), F.sum("slice_size").alias("source_size")))
    per_source = per_source.select("_mix_key", F.col("number").alias("_mix_number"), F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"))
    by_slice = by_slice.join(per_source, "_mix_key").select("_mix_key", "_mix_slice", "_mix_start", "_mix_number", "_mix_source_size", "_mix_target")
    rows = rows.join(by_slice, ["_mix_key", "_mix_slice"])
    inner = Window.partitionBy("_mix_key", "_mix_slice").orderBy("_mix_place", id_col, "_mix_mark").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_mix_before", F.col("_mix_start") + F.coalesce(F.sum("_mix_size").over(inner), F.lit(0)))
    goal = F.round("_mix_target").cast("long")
    for turn in range(MOST_TURNS):
        begin = F.col("_mix_before") + turn * F.col("_mix_source_size")
        rows = rows.withColumn(f"_mix_took{turn}", F.greatest(F.lit(0).cast("long"), F.least(F.col("_mix_size"), goal - begin)))
        rows = rows.withColumn(f"_mix_pos{turn}", position(begin.cast("double"), F.col("_mix_target"), F.col("_mix_number")))
    return rows


def mixed(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken words (repeats counted), first position.

    A document that isn't taken has position null. The rows stand in training order.
    """
    plan = planned(sized(docs, ["doc_id"]))
    out = plan.select(
        "doc_id",
        F.col("_mix_size").alias("size"),
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        sum((F.col(f"_mix_took{turn}") for turn in range(1, MOST_TURNS)), F.col("_mix_took0")).alias("taken"),
        F.when(F.col("_mix_took0") > 0, F.col("_mix_pos0")).alias("position"),
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(parts, F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def curriculum(docs: DataFrame, whole: bool = False) -> DataFrame:
    """The mixed corpus itself: the columns of ``docs``, a row for each turn, range-sorted by position.

    A document taken in part keeps its first words, joined by one space; if
    ``whole``, it keeps its text as it is.
    """
    turns = F.array(*[F.struct(F.col(f"_mix_took{k}").alias("took"), F.col(f"_mix_pos{k}").alias("pos")) for k in range(MOST_TURNS)])
    rows = planned(sized(docs, docs.columns)).withColumn("_mix_turn", F.explode(F.filter(turns, lambda x: x["took"] > 0)))
    took, pos = F.col("_mix_turn.took"), F.col("_mix_turn.pos")
    if not whole:
        part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")), F.lit(1), took.cast("int")), " ")
        rows = rows.withColumn("text", F.when(took < F.col("_mix_size"), part).otherwise(F.col("text")))
    if "n_chars" in docs.columns and not whole:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("_mix_pos", pos).repartitionByRange(parts, "_mix_pos", "doc_id").sortWithinPartitions("_mix_pos", "doc_id").select(*docs.columns)
