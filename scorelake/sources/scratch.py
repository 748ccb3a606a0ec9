"""Tables in the folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder of its own under the one that all executors see; a temporary one on one machine only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        root = "file://" + tempfile.mkdtemp(prefix="spark-stream-")
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, for what is used several times."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
