"""Parquet sinks and the scan of their output."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from custodia.functions.clean import utc_now
from custodia.sources.workspace import small_methods


def write_snapshot(
    df: DataFrame, folder: str, at: datetime | None = None, keep_latest: bool = True
) -> str:
    """A timestamped snapshot and a "latest" copy of it; returns the snapshot's path.

    The copy is made from the written files, so the job behind them runs once
    and nothing has to be held in memory.
    """
    stamp = (at or utc_now()).strftime("%Y%m%d_%H%M%S")
    snapshot = f"{folder}/enriched_{stamp}"
    with small_methods(df.sparkSession):
        df.write.mode("overwrite").parquet(snapshot)
    if keep_latest:
        df.sparkSession.read.parquet(snapshot).write.mode("overwrite").parquet(latest(folder))
    return snapshot


def latest(folder: str) -> str:
    return f"{folder}/enriched_latest"


def write_trends(df: DataFrame, path: str) -> None:
    """The county trends as Parquet."""
    df.write.mode("overwrite").parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The enriched bookings; a missing path is an error that says what to run."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"{path} not found; run the ingest job first") from error
