"""Booking rows from source names to derived flags."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from custodia import config
from custodia.config import Source
from custodia.functions.clean import day, number, utc_now, zip5
from custodia.functions.measures import work_days_to_bail

_BY_NAME = {source.name: source for source in config.SOURCES}
PROVENANCE = ["jurisdiction", "source_system", "extracted_at"]


def renamed(df: DataFrame, source: Source | None) -> DataFrame:
    """Source field names to schema names, for the fields that are there."""
    return df.withColumnsRenamed(source.column_map) if source else df


def renamed_by_name(df: DataFrame, source_name: str) -> DataFrame:
    return renamed(df, _BY_NAME.get(source_name))


def only_declared(df: DataFrame, source: Source) -> DataFrame:
    """Nothing but the fields the source declares, and its provenance."""
    if not source.column_map:
        return df
    wanted = [*source.column_map, *PROVENANCE]
    return df.select(*[name for name in wanted if name in df.columns])


def with_known_source(df: DataFrame) -> DataFrame:
    """Rows that say which source they come from (each source is renamed on reading)."""
    return df.filter(F.col("source_system").isNotNull()) if "source_system" in df.columns else df


def custody_status(code: Column) -> Column:
    """What a custody status code means."""
    kept = F.trim(code)
    return (
        F.when(kept.isin(config.PRETRIAL_CODES), "pretrial")
        .when(kept.isin(config.SENTENCED_CODES), "sentenced")
        .when(kept.isin(config.PAROLE_CODES), "parole")
        .otherwise("unknown")
    )


def with_pretrial_from_status(df: DataFrame) -> DataFrame:
    """NYC publishes no bail, so its pretrial flag comes from the status code.

    Rows of other places are false. A frame without status codes is left alone.
    """
    if "detention_status_code" not in df.columns:
        return df
    code = F.trim("detention_status_code")
    pretrial = (F.col("jurisdiction") == "NYC") & code.isin(config.PRETRIAL_CODES)
    return df.withColumn("pretrial_derived", F.coalesce(pretrial, F.lit(False)))


def first_present(df: DataFrame, candidates: list[str]) -> str | None:
    """The first of the candidate columns that the frame has."""
    return next((name for name in candidates if name in df.columns), None)


def with_clean_zip(df: DataFrame) -> DataFrame:
    """Whichever ZIP column is there, cleaned, under the name ``zip_code``."""
    found = first_present(df, config.ZIP_CANDIDATES)
    if found is None:
        return df
    cleaned = df.withColumn("zip_code", zip5(F.col(found)))
    return cleaned if found == "zip_code" else cleaned.drop(found)


def with_bail_gap(df: DataFrame) -> DataFrame:
    """Work days to bail; null where the bail or the income is not known."""
    if "bail_set_amount" not in df.columns or "median_daily_income" not in df.columns:
        return df
    return df.withColumn("bail_set_amount_num", number(F.col("bail_set_amount"))).withColumn(
        "work_days_to_bail",
        work_days_to_bail(F.col("bail_set_amount_num"), F.col("median_daily_income")),
    )


def with_reform_tag(df: DataFrame) -> DataFrame:
    """Maryland bookings since the reform. An unreadable date is not one of them."""
    if "booking_date" not in df.columns or "jurisdiction" not in df.columns:
        return df
    since = (F.col("jurisdiction") == config.REFORM_JURISDICTION) & (
        F.col("booking_date_parsed") >= F.lit(config.REFORM_DATE)
    )
    return df.withColumn("booking_date_parsed", day(F.col("booking_date"))).withColumn(
        "is_md_reform_case", F.coalesce(since, F.lit(False))
    )


def with_batch(df: DataFrame, batch_id: str | None = None, at: datetime | None = None) -> DataFrame:
    """One identifier and load time for all rows of a run."""
    return df.withColumns(
        {
            "etl_batch_id": F.lit(batch_id or str(uuid.uuid4())),
            "etl_loaded_at": F.lit((at or utc_now()).isoformat()),
        }
    )


def detention_timeline(custody: DataFrame, discharges: DataFrame) -> DataFrame:
    """Daily-custody rows with the release of the same person's same admission.

    Discharges are reduced to one row per person and admission first, so no pair
    of repeated rows multiplies. People without an identifier cannot be linked;
    the admission date in the join key keeps their rows spread out.
    """
    key = ["inmate_id_hash", "booking_day"]
    releases = (
        discharges.filter(F.col("inmate_id_hash") != config.UNKNOWN_PERSON)
        .select("inmate_id_hash", day(F.col("booking_date")).alias("booking_day"),
                day(F.col("release_date")).alias("release_day"))
        .filter(F.col("booking_day").isNotNull())
        .groupBy(*key)
        .agg(F.max("release_day").alias("release_day"))
    )
    held = custody.withColumn("booking_day", day(F.col("booking_date")))
    return held.join(releases, key, "left").withColumn(
        "days_detained", F.datediff("release_day", "booking_day")
    )
