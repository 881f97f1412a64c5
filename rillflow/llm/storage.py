"""Shared storage for intermediate results.

Every executor and the driver must see the same files, so intermediates go
below ``spark.checkpoint.dir``. Only where that setting is absent and all runs
in one process (unit tests) a temporary folder is set for the session; on a
cluster that is an error.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text for each task of a shuffle whose number of partitions AQE may not choose.
TASK_BYTES = 64 << 20


#: Bytes of an Arrow batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes (for the session), so long texts don't fill JVM and worker with thousands of rows at once."""
    now = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared folder, for an operator that begins."""
    small_batches(spark)
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="rillflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/rillflow-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet to ``folder/name`` and read it again.

    This cuts the lineage: what is lost with an executor is read again from
    the shared folder and not computed from the start.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def swept(spark: SparkSession) -> None:
    """Let Spark remove the files of shuffles that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediates that nothing refers to any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text_col).cast("binary")))).first()[0] or 0


def parts_for(spark: SparkSession, size: int, per_task: int = TASK_BYTES) -> int:
    """Shuffle partitions for ``size`` bytes: as set for the session, more where tasks would grow with the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // per_task))


#: Folders of answers at most.
SHELVES = 1 << 14


def by_home(answers: DataFrame, path: str, parts: int) -> None:
    """Write answers (column ``home``, long) so that a task finds those of one partition: in one folder, ordered by home."""
    rows = answers.withColumn("shelf", F.pmod("home", F.lit(SHELVES)))
    rows.repartition(parts, "shelf").sortWithinPartitions("shelf", "home").write.mode("overwrite").option("compression", "zstd").partitionBy("shelf").parquet(path)


def answers_of(path: str, home: int) -> Iterator[tuple]:
    """The answers for one partition, row by row, without ``home``; none where there is no folder."""
    store, at = fs.FileSystem.from_uri(f"{path}/shelf={home % SHELVES}")
    if store.get_file_info(at).type == fs.FileType.Directory:
        table = pq.read_table(at, filesystem=store, partitioning=None, filters=[("home", "=", home)]).drop_columns(["home"])
        for batch in table.to_batches(max_chunksize=256):
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)
