"""What the operators share: words, staged tables, and columns taken by name."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
BLANKS = "\x20\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local session, where there is one machine, may do without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    folder = tempfile.mkdtemp(prefix="custodia-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python and back in Arrow batches of so many rows, unless the session says otherwise.

    Spark's own 10,000 rows of long texts, their copies and the results take hundreds of MB of a worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))


def new_place(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for one table."""
    return f"{shared_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"


def dropped_at_end(spark: SparkSession, path: str) -> None:
    """The files of a written table go when the application ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: cuts the lineage, survives lost executors.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = new_place(spark, name)
    df.write.parquet(path)
    dropped_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The array of words [^\\x20\\x09-\\x0D]+ of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))
