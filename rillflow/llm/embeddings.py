"""Near-duplicate vectors by an exact metric range join.

Cosine c of two vectors is the distance sqrt(2 - 2 c) of their unit vectors.
Pivots, some of the vectors, part the space into cells of the nearest pivot. A
vector within reach of another cell visits it: by the triangle inequality (in
the form of the distance to the plane between two pivots), a vector farther
than the radius from that plane has no partner behind it. Large cells are split
again by pivots of their own. Cells then join independently, those that stay
large as pairs of blocks, each a matrix product in double precision. Equal
vectors (told apart by 128 bits of hash) are joined once, with their number.

Defined results: vectors that are null, zero or empty, or hold null or
non-finite components, and vectors without a label, have no links and are
their own component. Vectors of different length are never linked. Rows with
the same vec_id count as separate vectors; the result has a row for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import components, storage

COSINE = 0.98
#: Wanted vectors of a cell, most pivots of one cell and of one pass, levels, and most rows of a block.
CELL_VECTORS, MOST_PIVOTS, PIVOTS_PER_PASS, MOST_LEVELS, BLOCK_VECTORS = 4096, 64, 1 << 16, 60, 2048
KEY = ["label", "dim", "cell"]
#: Room for rounding in the choice of cells; links themselves are judged by cosine.
SLACK = 1e-9


def units(vectors: DataFrame) -> DataFrame:
    """Rows that can have links: vec_id, label, dim, unit (doubles, little-endian)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, dims, out = [], [], []
            for i, v in enumerate(b.column("embedding").to_pylist()):
                if not v or None in v:
                    continue
                x = np.array(v, float)
                top = np.abs(x).max()
                if not math.isfinite(top) or not top:
                    continue
                x = x / top
                keep.append(i)
                dims.append(len(x))
                out.append((x / np.sqrt(x @ x)).astype("<f8").tobytes())
            t = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([t.column("vec_id"), t.column("label"), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "label", "dim", "unit"])

    rows = vectors.where(F.col("label").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return rows.mapInArrow(made, "vec_id long, label string, dim int, unit binary")


def _matrix(column: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<f8") for x in column]) if column else np.empty((0, 0))


def pivots_of(rows: DataFrame, big: DataFrame) -> dict[tuple, np.ndarray]:
    """For each of the cells ``big`` (label, dim, cell, n) the unit vectors of its pivots: those of its vectors with the smallest hashes.

    A hash bound leaves a few times as many as wanted, so the ranking holds few rows of each cell.
    """
    wanted = F.least(F.lit(MOST_PIVOTS), F.ceil(F.col("n") / CELL_VECTORS) + 1)
    h = F.xxhash64(F.lit(7), "node").cast("double") / 2.0**64 + 0.5
    near = rows.join(F.broadcast(big), KEY).withColumn("h", h).where(F.col("h") * F.col("n") <= 4 * wanted + 50)
    ranked = near.withColumn("k", F.row_number().over(Window.partitionBy(*KEY).orderBy("h", "node"))).where(F.col("k") <= wanted)
    out: dict[tuple, list] = {}
    for r in ranked.select(*KEY, "unit").collect():  # at most PIVOTS_PER_PASS rows
        out.setdefault((r["label"], r["dim"], r["cell"]), []).append(bytes(r["unit"]))
    return {k: _matrix(sorted(v)) for k, v in out.items()}


def split(rows: DataFrame, pivots: dict[tuple, np.ndarray], level: int, radius: float) -> DataFrame:
    """The rows of cells that have pivots, each in the cell of its nearest pivot and in those it visits.

    ``away`` gets the bit ``level`` where a row only visits. A row visits cells
    with a smaller number than its own, so two rows that have to meet do so in
    one cell, and there at least one of them is at home on each level.
    """
    spark = rows.sparkSession
    numbers = {k: i for i, k in enumerate(sorted(pivots))}
    shared = spark.sparkContext.broadcast(list(pivots[k] for k in sorted(pivots)))
    known = spark.createDataFrame([(*k, i) for k, i in numbers.items()], "label string, dim int, cell long, number int")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number = b.column("number").to_numpy()
            units_of = b.column("unit").to_pylist()
            at, sub, visits = [], [], []
            for k in np.unique(number).tolist():
                mine, p = np.flatnonzero(number == k), shared.value[k]
                # distances between pivots, from one matrix product
                apart = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 1e-300))
                cos = _matrix([units_of[i] for i in mine]) @ p.T
                own = cos.argmax(axis=1)
                # distance to the plane between the own pivot and another: (d^2 - d_own^2) / (2 * apart)
                plane = (cos[np.arange(len(mine)), own][:, None] - cos) / apart[own]
                i, j = np.nonzero((plane <= radius + SLACK) & (np.arange(len(p)) < own[:, None]))
                at += [*mine.tolist(), *mine[i].tolist()]
                sub += [*own.tolist(), *j.tolist()]
                visits += [False] * len(mine) + [True] * len(i)
            t = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[t.column(c) for c in ("label", "dim", "cell")], pa.array(sub, pa.int64()), pa.array(visits, pa.bool_()), *[t.column(c) for c in ("away", "node", "many", "unit")]], ["label", "dim", "cell", "sub", "visits", "away", "node", "many", "unit"])

    schema = "label string, dim int, cell long, sub long, visits boolean, away long, node long, many long, unit binary"
    out = rows.join(F.broadcast(known), KEY).select("number", *KEY, "away", "node", "many", "unit").mapInArrow(dealt, schema)
    return out.withColumn("away", F.col("away").bitwiseOR(F.when(F.col("visits"), 1 << level).otherwise(0).cast("long"))).drop("visits")


def cells(classes: DataFrame, radius: float, folder: str) -> DataFrame:
    """Classes in cells of about CELL_VECTORS: label, dim, cell, away, node, many, unit.

    Large cells are split by pivots of their own, level by level, so no level
    has more than MOST_PIVOTS for a vector to look at, and the number of cells
    follows the input without a bound. A split that doesn't halve the pairs of
    a cell is dropped: its vectors lie so near each other, or their number of
    dimensions is so high, that the triangle inequality tells nothing. The
    pivots of a level go out in passes of PIVOTS_PER_PASS at most.
    """
    spark = classes.sparkSession
    rows = classes.select("label", "dim", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("away"), "node", "many", "unit")
    done: list[DataFrame] = []
    for level in range(MOST_LEVELS):
        sizes = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        big = storage.stored(sizes.where(F.col("n") > 2 * CELL_VECTORS).withColumn("number", F.monotonically_increasing_id()), folder, f"big-{level}")
        count = big.count()
        if not count:
            break
        done.append(rows.join(big, KEY, "left_anti"))
        # passes over parts of the large cells, by hash
        passes = -(-count * MOST_PIVOTS // PIVOTS_PER_PASS)
        next_rows = None
        for k in range(passes):
            part = storage.stored(big.where(F.pmod(F.xxhash64("number"), F.lit(passes)) == k).drop("number"), folder, f"big-{level}-{k}")
            mine = rows.join(F.broadcast(part), KEY, "left_semi")
            dealt = storage.stored(split(mine, pivots_of(mine, part), level, radius), folder, f"dealt-{level}-{k}")
            pairs = dealt.groupBy(*KEY, "sub").agg(F.count(F.lit(1)).cast("double").alias("m")).groupBy(*KEY).agg(F.sum(F.col("m") * F.col("m")).alias("pairs"))
            good = part.join(pairs, KEY).where(F.col("pairs") <= 0.5 * F.col("n") * F.col("n")).select(*KEY)
            good = storage.stored(good, folder, f"good-{level}-{k}")
            done.append(mine.join(F.broadcast(good), KEY, "left_anti"))
            fresh = dealt.join(F.broadcast(good), KEY, "left_semi").withColumn("cell", F.xxhash64("cell", "sub", F.lit(level))).drop("sub")
            next_rows = fresh if next_rows is None else next_rows.unionByName(fresh)
        rows = storage.stored(next_rows, folder, f"rows-{level}")
    done.append(rows)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    folder = storage.shared_dir(spark)
    hashes = {"h1": F.xxhash64("label", "dim", "unit"), "h2": F.xxhash64(F.lit(35), "unit", "dim", "label")}
    valid = storage.stored(units(vectors).withColumns(hashes), folder, "units")
    first = [F.first(c).alias(c) for c in ("label", "dim", "unit")]
    classes = valid.groupBy("h1", "h2").agg(*first, F.count(F.lit(1)).alias("many"), F.min("vec_id").alias("least"))
    classes = storage.stored(classes.withColumn("node", F.monotonically_increasing_id()), folder, "classes")
    dealt = storage.stored(cells(classes, math.sqrt(2 - 2 * cosine), folder), folder, "cells")
    blocks = dealt.groupBy(*KEY).agg(F.ceil(F.count(F.lit(1)) / BLOCK_VECTORS).cast("int").alias("blocks"))
    rows = dealt.join(blocks, KEY).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def joined(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list] = {c: [] for c in ("own", "low", "high", "away", "node", "many", "unit")}
        for b in batches:
            for c in got:
                got[c] += b.column(c).to_pylist()
        own, node, many, away = (np.array(got[c]) for c in ("own", "node", "many", "away"))
        x = _matrix(got["unit"])
        one = np.flatnonzero(own == got["low"][0])
        two = np.flatnonzero(own == got["high"][0])
        near = x[one] @ x[two].T >= cosine
        near &= (away[one][:, None] & away[two][None]) == 0
        near &= node[one][:, None] != node[two][None]
        links = np.zeros(len(own), np.int64)
        links[one] += near @ many[two]
        if got["low"][0] != got["high"][0]:
            links[two] += near.T @ many[one]
        i, j = np.nonzero(near)
        tree = components.spanning(len(own), zip(one[i].tolist(), two[j].tolist(), strict=True))
        some = np.flatnonzero(links)
        a = [*node[some].tolist(), *[int(node[i]) for i, _ in tree]]
        b = [*[None] * len(some), *[int(node[j]) for _, j in tree]]
        n = [*links[some].tolist(), *[0] * len(tree)]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "links"])

    found = rows.groupBy(*KEY, "low", "high").applyInArrow(joined, "a long, b long, links long")
    found = storage.stored(found, folder, "links")
    roots = components.components(found.where("b is not null").select("a", "b"), folder)
    counted = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    known = classes.join(roots, "node", "left").join(counted.withColumnRenamed("a", "node"), "node", "left")
    known = known.select("h1", "h2", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = known.join(least, "root").select("h1", "h2", "n_links", "component_id")
    per_vector = valid.select("vec_id", "h1", "h2").join(per_class, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    # the rows that can have no link: all rows less the valid ones, by count for each vec_id
    counts = vectors.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"))
    linked = valid.groupBy("vec_id").agg(F.count(F.lit(1)).alias("m"))
    rest = counts.join(linked.withColumnRenamed("vec_id", "id"), F.col("vec_id").eqNullSafe(F.col("id")), "left")
    rest = rest.withColumn("copy", F.explode(F.expr("if(n > coalesce(m, 0), sequence(1L, n - coalesce(m, 0)), cast(array() as array<bigint>))")))
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return per_vector.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
