"""Shared helpers: scratch tables in the folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only where the session names none and runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Plans made inside send Python batches of at most ``size`` bytes, or one longer row; the session's smaller bound stays.

    By rows alone, 10,000 long texts would be one batch, held by the JVM and by each worker of the stage.
    """
    before = spark.conf.get(ARROW_BYTES, None)
    if before is None or spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > size:
        spark.conf.set(ARROW_BYTES, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` whose workers, which Spark keeps for later stages, hand Arrow's unused memory back after each batch."""

    def frugal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pa.default_memory_pool()
        try:
            for batch in run(batches):
                yield batch
                del batch
                pool.release_unused()
        finally:
            pool.release_unused()

    return df.mapInArrow(frugal, schema)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with bounded_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table written by ``materialise`` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = scratch_root(spark).removeprefix("file://")
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root in parent:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(conf).delete(path, True)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores put before it until no column is called like that."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name
