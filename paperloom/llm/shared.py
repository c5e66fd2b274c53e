"""Helpers that several training-data operators use."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled rows whose crc32(doc_id) leaves this remainder by HELD_OUT_MOD are never learnt from.
HELD_OUT_MOD = 5
#: Longest text that a training sample takes; scoring has no such bound.
MAX_TRAINING_CHARS = 200_000
#: Rows in an Arrow batch: long texts stay within a Python worker's memory.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def written(df: DataFrame, label: str) -> DataFrame:
    """df, written once as Parquet in the shared folder and read from there: its lineage ends here."""
    path = os.path.join(_session_dir(df.sparkSession), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _session_dir(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "paperloom", spark.sparkContext.applicationId)


def clear(spark: SparkSession) -> None:
    """Remove what written() has left in this session; results that still read it must have been written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the rows per Arrow batch, unless the session has a lower number already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def collect_garbage(spark: SparkSession) -> None:
    """Let the executors collect their garbage, a task for each core, so that their heaps go back to what is in use.

    A heap otherwise grows to its limit by what earlier steps have left, and keeps that beside
    the memory of the Python workers. No result depends on it; a JVM that was told to ignore
    such requests ignores them.
    """
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.expr("reflect('java.lang.System', 'gc')")).collect()


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Other rows per Arrow batch for what is run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def crc_of_id(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held_out(column: str = "doc_id"):
    return F.coalesce(crc_of_id(column) % HELD_OUT_MOD == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, target: str, per_class: int) -> list[tuple[str, int]]:
    """At most per_class labelled texts of either class, in a fixed order; the held-out rows are never among them.

    The sample is the labelled rows with the least hash of their id, so that it doesn't
    depend on partitions. Its bound is per_class rows of MAX_TRAINING_CHARS characters.
    """
    usable = labels.where(~held_out() & F.col(target).isin(0, 1)).select("doc_id", F.col(target).cast("int").alias("y"))
    parts = [usable.where(F.col("y") == y).dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= MAX_TRAINING_CHARS))
    # of rows that share an id the first text counts, so that there are 2 * per_class rows at most
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return [(r.text, r.y) for r in rows]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated bytes of a string or binary column, and its offsets; a null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it none of the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def appended(schema, columns: str):
    """The schema of some columns, then of others given as DDL."""
    from pyspark.sql.types import StructType

    return StructType([*schema.fields, *StructType.fromDDL(columns).fields])
