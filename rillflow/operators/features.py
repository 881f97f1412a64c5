"""Feature vectors of hosts, from moments and exact distinct counts."""

from __future__ import annotations

import json
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ip as ips
from ..functions.scalar import seconds, squashed, whole_seconds

#: TCP flag bits by name.
FLAGS = {"fin": 1, "syn": 2, "rst": 4, "psh": 8, "ack": 16, "urg": 32}


def _deviation(n: Column, total: Column, squares: Column) -> Column:
    mean = total / F.nullif(n, F.lit(0))
    return F.coalesce(F.sqrt(F.greatest(squares / F.nullif(n, F.lit(0)) - mean * mean, F.lit(0.0))), F.lit(0.0))


def reply_features(df: DataFrame, block: int = 10, blocks: int = 6, best: int = 3) -> DataFrame:
    """Per (SRC_IP, PROTOCOL): counts, means and deviations, flags, distinct partners, top source ports, busiest minute.

    The deviation of bytes per packet is weighted by packets. The busiest
    minute is the largest sum of ``blocks`` neighbouring blocks of ``block``
    seconds. Distinct counts and top ports are exact.
    """
    keys = ["SRC_IP", "PROTOCOL"]
    packets = F.col("PACKETS").cast("double")
    per_packet = F.col("BYTES").cast("double") / F.nullif(packets, F.lit(0.0))
    # sums go up by partner and partner's network, so both are counted without rows being multiplied
    sums = {"flows": F.count(F.lit(1)), "packets": F.sum("PACKETS").cast("long"), "bytes": F.sum("BYTES").cast("long"), "_pp": F.sum(packets * packets), "_bb": F.sum(packets * per_packet * per_packet)}
    sums |= {f"{name}_flows": F.count(F.when(F.col("TCP_FLAGS").bitwiseAND(bit) != 0, 1)) for name, bit in FLAGS.items()}
    up = [F.sum(c).alias(c) for c in sums]
    by_target = df.groupBy(*keys, "DST_IP").agg(*[c.alias(n) for n, c in sums.items()])
    by_net = by_target.groupBy(*keys, ips.mask(F.col("DST_IP"), 24, 64).alias("_net")).agg(F.count(F.lit(1)).alias("targets"), *up)
    base = by_net.groupBy(*keys).agg(F.sum("targets").alias("targets"), F.count(F.lit(1)).alias("target_nets"), *up)
    n, total, octets = F.col("flows").cast("double"), F.col("packets").cast("double"), F.col("bytes").cast("double")
    base = base.withColumns({
        "avg_packets": total / n,
        "std_packets": _deviation(n, total, F.col("_pp")),
        "avg_bytes": F.col("bytes") / F.nullif(F.col("packets"), F.lit(0)),
        "std_bytes": _deviation(total, octets, F.col("_bb")),
    }).drop("_pp", "_bb")
    asked = df.groupBy(*keys, "DST_PORT").agg(F.lit(1).alias("_one")).groupBy(*keys).agg(F.count("_one").alias("target_ports"))
    ports = df.groupBy(*keys, "SRC_PORT").agg(F.count(F.lit(1)).alias("n"))
    ranked = ports.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "SRC_PORT")))
    tops = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_ports"), *[F.coalesce(F.max(F.when(F.col("r") == i, F.col(c))), F.lit(0)).alias(f"top{i}_{name}") for i in range(1, best + 1) for c, name in (("SRC_PORT", "port"), ("n", "flows"))])
    slots = df.groupBy(*keys, F.floor(whole_seconds(F.col("TIME_LAST")) / block).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    minute = F.sum("n").over(Window.partitionBy(*keys).orderBy("slot").rangeBetween(-(blocks - 1), 0))
    busiest = slots.withColumn("m", minute).groupBy(*keys).agg(F.max("m").alias("most_per_minute"))
    return base.join(asked, keys).join(tops, keys).join(busiest, keys)


def _moments(met: Column, value: Column, name: str) -> list[Column]:
    v = F.when(met, value)
    n = F.count(v).cast("double")
    return [squashed(F.coalesce(F.avg(v), F.lit(0.0))).alias(f"mean_{name}"), squashed(_deviation(n, F.coalesce(F.sum(v), F.lit(0.0)), F.coalesce(F.sum(v * v), F.lit(0.0)))).alias(f"sd_{name}")]


def device_features(df: DataFrame, gap: int = 60, ports: tuple[int, ...] = (22, 25, 53, 80, 123, 443, 8080), least: float = 0.01) -> DataFrame:
    """Per version 4 host, in both roles: peers, connections, who begins, ratios of bytes, TCP and ports, squashed moments.

    A connection is new if the last flow with the same peer lies more than
    ``gap`` seconds back. Port ratios up to ``least`` are 0, others tanh(3 r).
    """
    v4 = df.where(ips.is_v4(F.col("SRC_IP")) & ips.is_v4(F.col("DST_IP")))
    span = F.floor(seconds(F.col("TIME_LAST")) - seconds(F.col("TIME_FIRST")))
    shared = [F.col("PACKETS").cast("double").alias("packets"), F.col("BYTES").cast("double").alias("bytes"), span.cast("double").alias("secs"), F.col("PROTOCOL").alias("protocol"), "SRC_PORT", "DST_PORT", F.unix_micros(F.col("TIME_FIRST").cast("timestamp")).alias("t"), "seq"]
    roles = v4.select(F.col("SRC_IP").alias("host"), F.col("DST_IP").alias("peer"), F.lit(True).alias("src"), *shared).union(v4.select(F.col("DST_IP").alias("host"), F.col("SRC_IP").alias("peer"), F.lit(False).alias("src"), *shared))
    before = F.lag("t").over(Window.partitionBy("host", "peer").orderBy("t", "seq", "src"))
    rows = roles.withColumn("new", F.coalesce(F.col("t") - before > gap * 1_000_000, F.lit(True)))
    src, n = F.col("src"), F.count(F.lit(1))
    out = [
        F.count_distinct("peer").alias("peers"),
        F.count(F.when(F.col("new"), 1)).alias("connections"),
        (F.count(F.when(F.col("new") & src, 1)) / F.count(F.when(F.col("new"), 1))).alias("begins_ratio"),
        (F.coalesce(F.sum(F.when(src, F.col("bytes"))), F.lit(0.0)) / F.nullif(F.sum("bytes"), F.lit(0.0))).alias("bytes_ratio"),
        *_moments(src, F.col("packets"), "src_packets"),
        *_moments(~src, F.col("packets"), "dst_packets"),
        *_moments(src, F.col("secs"), "src_secs"),
        *_moments(~src, F.col("secs"), "dst_secs"),
        (F.count(F.when(F.col("protocol") == 6, 1)) / n).alias("tcp_ratio"),
    ]
    for p in ports:
        ratio = F.count(F.when((F.col("SRC_PORT") == p) | (F.col("DST_PORT") == p), 1)) / n
        out.append(F.when(ratio > least, F.tanh(3 * ratio)).otherwise(F.lit(0.0)).alias(f"port_{p}"))
    return rows.groupBy("host").agg(*out)


def sparse_rows(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """``label index:value …`` text of the non-zero features, from 1 on."""
    parts = [F.when(F.col(c) != 0, F.concat(F.lit(f"{i}:"), F.col(c).cast("double").cast("string"))) for i, c in enumerate(features, 1)]
    return df.select(F.concat_ws(" ", F.col(label).cast("string"), *parts).alias("value"))


def fit_labels(df: DataFrame, features: list[str], labels: list[str], steps: int = 30, rate: float = 0.5) -> dict[str, dict]:
    """A linear classifier with hinge loss for each label column (0/1): {label: {feature or "": weight}}.

    Full-batch descent on scaled features: each step is one aggregate over the
    rows (the sums of the gradient of all labels), so only a few numbers reach
    the driver. The weights returned are those of the features as they are.
    """
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    mean = [stats[f"m{i}"] or 0.0 for i in range(len(features))]
    spread = [stats[f"s{i}"] or 1.0 for i in range(len(features))]
    x = [(F.col(c).cast("double") - m) / s for c, m, s in zip(features, mean, spread, strict=True)] + [F.lit(1.0)]
    scaled = df.select(F.array(*x).alias("x"), *labels).persist()
    weights = {y: [0.0] * len(x) for y in labels}

    def margin(row: Column, w: list[float]) -> Column:
        return sum((F.get(row, F.lit(i)) * v for i, v in enumerate(w)), F.lit(0.0))

    for step in range(steps):
        sums = []
        for y in labels:
            sign = F.when(F.col(y) == 1, 1.0).otherwise(-1.0)
            wrong = sign * margin(F.col("x"), weights[y]) < 1
            sums += [F.avg(F.when(wrong, sign * F.get(F.col("x"), F.lit(i))).otherwise(0.0)).alias(f"{y}_{i}") for i in range(len(x))]
        g = scaled.agg(*sums).first()
        for y in labels:
            weights[y] = [v * (1 - 0.001 * rate) + rate / (1 + step / 10) * (g[f"{y}_{i}"] or 0.0) for i, v in enumerate(weights[y])]
    scaled.unpersist()
    out = {}
    for y, w in weights.items():
        plain = {c: v / s for c, v, s in zip(features, w, spread, strict=False)}
        out[y] = plain | {"": w[-1] - sum(plain[c] * m for c, m in zip(features, mean, strict=True))}
    return out


def write_models(spark: SparkSession, models: dict[str, dict], folder: str) -> None:
    """A JSON file for each label, in a folder of its name."""
    for label, weights in models.items():
        spark.createDataFrame([(json.dumps(weights, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{label}")


def read_models(spark: SparkSession, labels: list[str], folder: str) -> dict[str, dict]:
    """The stored models of these labels; a label whose model isn't there (never trained) is left out with a warning."""
    out = {}
    for label in labels:
        try:
            out[label] = json.loads(spark.read.text(f"{folder}/{label}").first()[0])
        except AnalysisException:
            warnings.warn(f"no model of {label} in {folder}", stacklevel=2)
    return out


def labelled(df: DataFrame, models: dict[str, dict]) -> DataFrame:
    """``df`` with ``is_LABEL`` (0/1) of each model: one projection, whatever the number of models."""
    margin = lambda w: sum((F.col(c).cast("double") * v for c, v in w.items() if c), F.lit(w.get("", 0.0)))
    return df.withColumns({f"is_{y}": (margin(w) > 0).cast("int") for y, w in models.items()})
