"""Connected components of a graph given as a table of links.

Large-star and small-star steps by turns: every node links its larger
neighbours to the smallest node it knows, until all components are stars.
Links never leave the cluster; each step is written to the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage

#: Rows of one key that one task meets at least; most keys that are listed as hot.
HOT_ROWS, LISTED = 1024, 100_000
#: Links for each file of a step.
FILE_LINKS = 1 << 16


def met(rows: DataFrame, per_key: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """``rows`` joined to one row for each key (with its number ``n`` of rows); a hot key is met in several tasks.

    ``most`` is the largest n. Keys above the bound are listed: as the bound is
    at least ``total`` / LISTED, they are at most LISTED. Their rows are dealt
    by salt, and their row of ``per_key`` is copied to each salt.
    """
    bound = max(HOT_ROWS, -(-total // LISTED))
    if most <= bound:
        return rows.join(per_key, key).drop("n")
    hot = per_key.where(F.col("n") > bound).select(key, F.ceil(F.col("n") / bound).cast("int").alias("_chunks"))
    hot = F.broadcast(rows.sparkSession.createDataFrame(hot.collect(), hot.schema))
    others = [c for c in rows.columns if c != key]
    dealt = rows.join(hot, key, "left").withColumn("_salt", F.when(F.col("_chunks").isNotNull(), F.pmod(F.xxhash64(*others), F.col("_chunks"))).otherwise(0).cast("int")).drop("_chunks")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_chunks", F.lit(1)) - 1))
    copied = per_key.join(hot, key, "left").withColumn("_salt", copies).drop("_chunks", "n")
    return dealt.join(copied, [key, "_salt"]).drop("_salt")


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) for each node of ``links`` (columns a and b, long); root is the smallest node of its component.

    Links from a node to itself and repeated links change nothing. Nodes
    without a link aren't in the result. A node with very many links, like the
    centre of a large star, is met in several tasks. Steps end as soon as all
    links are stars: no node has two links to smaller ones, or links both ways.
    """
    spark, folder = links.sparkSession, f"{folder}/components-{uuid.uuid4().hex}"
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, step = storage.stored(now, folder, "links-0"), 0

    def measured(df: DataFrame):
        per = df.select(F.expr("stack(2, a, 1L, b, 0L) as (node, up)")).groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
        loose = F.count(F.when((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("n") > 1)), 1))
        return per.agg(F.sum("up").alias("n"), F.max("n").alias("most"), F.max("up").alias("up"), loose.alias("loose")).first()

    seen = measured(now)
    while seen["loose"]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = met(both, least, "a", seen["most"], 2 * seen["n"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if seen["up"] <= HOT_ROWS:  # a node has as many rows here as it has smaller neighbours
            small = large.repartition("a").withColumn("m", F.min("b").over(Window.partitionBy("a"))).select(F.expr("stack(2, b, m, a, m) as (a, b)")).where("a <> b")
        else:
            large = large.distinct()
            smallest = large.groupBy("a").agg(F.min("b").alias("m"))
            joined = large.join(smallest.withColumnRenamed("a", "u"), F.col("a") == F.col("u"))
            small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(smallest.select("a", F.col("m").alias("b")))
        step += 1
        files = max(spark.sparkContext.defaultParallelism, -(-seen["n"] // FILE_LINKS))
        now = storage.stored(small.distinct().coalesce(files), folder, f"links-{step}")
        seen = measured(now)
        storage.removed(spark, f"{folder}/links-{step - 1}")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def spanning(n: int, pairs) -> list[tuple[int, int]]:
    """Those of the pairs (numbers below n) that join two parts not yet joined: n - 1 at most."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((i, j))
    return out
