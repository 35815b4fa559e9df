"""The shared folder for files that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session may fall back to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="custodia-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path that no other run uses; what is there goes when the application ends."""
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """df, written to a folder of its own and read back, so that nothing before it runs again."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """For a wide projection: Spark splits generated methods above 8,000 bytes meanwhile, which the
    JVM would interpret row by row and never compile. A limit that the session sets stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    unset = spark.conf.get(key, None) is None
    if unset:
        spark.conf.set(key, "8000")
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(key)
