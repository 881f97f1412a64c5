"""Bounded samples of labelled rows for fitting classifiers on the driver.

Only fitting uses a sample; its bounds are parameters. Rows are chosen by a
hash of the id, so reruns choose the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text (null: empty), modulo ``folds``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def labelled(docs: DataFrame, known: DataFrame, label: str, per_label: int, total: int, longest: int) -> list[tuple[bytes, object]]:
    """Up to ``per_label`` texts of each label and ``total`` at all, of at most ``longest`` bytes: [(text, label)].

    ``known`` has doc_id and the label. The choice is made on ids alone: hashes
    below a bound by label leave a few times as many as wanted, so ranking
    within a label handles few rows even where one label holds most. The ids
    chosen, twice ``total`` at most, are broadcast to the documents; so texts
    don't move.
    """
    rows = known.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("label"), F.xxhash64("doc_id").alias("h"))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(total)
    unit = F.col("h").cast("double") / 2.0**64 + 0.5
    near = rows.join(counts, "label").where(unit * F.col("n") <= 4 * per_label + 50)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))).where(F.col("rank") <= 2 * per_label)
    chosen = docs.sparkSession.createDataFrame(ranked.orderBy("rank", "label").limit(2 * total).select("doc_id", "label", "rank").collect(), ranked.select("doc_id", "label", "rank").schema)
    texts = docs.where(F.col("text").isNotNull() & (F.octet_length("text") <= longest)).select("doc_id", F.col("text").cast("binary").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").collect()
    out, seen = [], {}
    for r in sorted(found, key=lambda r: (r["rank"], str(r["label"]), bytes(r["text"]))):
        if seen.get(r["label"], 0) < per_label and len(out) < total:
            seen[r["label"]] = seen.get(r["label"], 0) + 1
            out.append((bytes(r["text"]), r["label"]))
    return out
