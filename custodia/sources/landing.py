"""Readers for landed files. Every raw field is text; typing comes later and never fails."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from custodia import config
from custodia.config import Source
from custodia.functions.clean import as_date, day, utc_now, zip5

log = logging.getLogger(__name__)


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def fields_of(source: Source) -> list[str]:
    """The raw fields worth reading: the mapped ones, or the court record's."""
    fields = list(source.column_map) or list(config.COURT_COLUMNS)
    return fields if source.date_field in fields else [*fields, source.date_field]


def clean_name(name: str, keep_hyphens: bool = False) -> str:
    name = name.lower().strip().replace(" ", "_")
    return name if keep_hyphens else name.replace("-", "_")


def _picked(record: Column, fields: Sequence[str], keep_hyphens: bool) -> list[Column]:
    """The fields of a map of text, whatever the case and spacing of its names."""
    entries = F.map_entries(record)

    def clean(key: Column) -> Column:
        key = F.replace(F.trim(F.lower(key)), F.lit(" "), F.lit("_"))
        return key if keep_hyphens else F.replace(key, F.lit("-"), F.lit("_"))

    def found(name: str) -> Column:
        same = F.filter(entries, lambda e: clean(e["key"]) == clean_name(name, keep_hyphens))
        return F.coalesce(F.try_element_at(record, F.lit(name)), F.get(same, 0)["value"]).alias(name)

    return [found(name) for name in fields]


def record_maps(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(value, record): every record as a map of text; record is null for what is not JSON.

    Text that begins with a bracket is an array of records. ``multi_line`` reads whole files,
    which hold one page of a bounded number of records each.
    """
    text = spark.read.text(path, wholetext=multi_line)
    many = F.from_json("value", "array<map<string,string>>")
    one = F.array(F.from_json("value", "map<string,string>"))
    records = F.when(F.ltrim("value").startswith("["), many).otherwise(one)
    lines = text.filter(F.trim("value") != "").select("value", records.alias("records"))
    return lines.select("value", F.explode_outer("records").alias("record"), F.size("records").alias("_n")).filter("_n <> 0").drop("_n")


def unreadable(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The text of landed records that cannot be read."""
    return record_maps(spark, path, multi_line).filter(F.col("record").isNull()).select("value")


def read_records(
    spark: SparkSession, path: str, fields: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Flat JSON records, one a line or in arrays. ``multi_line`` is for files that spread one
    array over lines. Records that cannot be read are left to ``unreadable``."""
    records = record_maps(spark, path, multi_line).filter(F.col("record").isNotNull())
    return records.select(*_picked(F.col("record"), fields, keep_hyphens=False))


def read_features(
    spark: SparkSession, path: str, fields: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Pages of ``{"features": [{"attributes": {...}}]}``, one row per feature."""
    attributes = T.MapType(T.StringType(), T.StringType())
    feature = T.StructType([T.StructField("attributes", attributes)])
    page = T.StructType([T.StructField("features", T.ArrayType(feature))])
    pages = spark.read.schema(page).json(path, multiLine=multi_line)
    records = pages.select(F.explode("features.attributes").alias("record"))
    return records.filter(F.col("record").isNotNull()).select(*_picked(F.col("record"), fields, keep_hyphens=True))


def normalised(df: DataFrame, keep_hyphens: bool = False) -> DataFrame:
    """Lower-case column names with underscores; feature sources keep their hyphens."""
    return df.toDF(*[clean_name(name, keep_hyphens) for name in df.columns])


def since_days(df: DataFrame, date_field: str, days: int | None, as_of=None) -> DataFrame:
    """Rows of the last ``days`` days; no value or 0 keeps everything."""
    if not days:
        return df
    return df.filter(day(F.col(date_field)) >= F.date_sub(as_date(as_of), days))


def in_date_order(df: DataFrame, date_field: str, *then_by: str) -> DataFrame:
    """Oldest first. Further columns let a sort split a day that holds most of the rows."""
    return df.orderBy(F.col(date_field).asc_nulls_last(), *then_by)


def tagged(df: DataFrame, source: Source, extracted_at: datetime | None = None) -> DataFrame:
    """Where and when the rows come from."""
    at = (extracted_at or utc_now()).isoformat()
    return df.withColumns(
        {
            "jurisdiction": F.lit(source.jurisdiction),
            "source_system": F.lit(source.name),
            "extracted_at": F.lit(at),
        }
    )


def active_sources(sources: Sequence[Source] = config.SOURCES) -> list[Source]:
    """The registry without the placeholders."""
    return [source for source in sources if source.verified]


def combined(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows by column name, with nulls where a source lacks a column."""
    if not frames:
        raise RuntimeError("no source could be read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_source(
    spark: SparkSession,
    source: Source,
    path: str,
    since: int | None = None,
    as_of: date | None = None,
    extracted_at: datetime | None = None,
    multi_line: bool = False,
) -> DataFrame:
    read = read_features if source.kind == "features" else read_records
    fields = fields_of(source)
    rows = read(spark, path, fields, multi_line)
    rows = normalised(rows, keep_hyphens=source.kind == "features")
    rows = since_days(rows, source.date_field, since, as_of)
    if source.date_field not in (list(source.column_map) or config.COURT_COLUMNS):
        rows = rows.drop(source.date_field)  # read for the limit alone
    return tagged(rows, source, extracted_at)


def read_all(
    spark: SparkSession,
    paths: dict[str, str],
    sources: Sequence[Source] | None = None,
    rename=lambda df, source: df,
    **limits,
) -> DataFrame:
    """Every source that can be read and has rows. Fails only when none is left."""
    frames = []
    for source in active_sources() if sources is None else sources:
        try:
            rows = read_source(spark, source, paths[source.name], **limits)
            empty = rows.isEmpty()
        except (PySparkException, KeyError) as error:
            log.warning("source %s skipped: %s", source.name, error)
            continue
        if empty:
            log.warning("source %s has no rows", source.name)
        else:
            frames.append(rename(rows, source))
    return combined(frames)


COUNTY_SCHEMA = (
    "year int, county_fips string, county_name string, state_abbr string, urbanicity string,"
    " total_jail_pop double, total_pretrial_custody double, total_sentenced_custody double,"
    " black_jail_pop double, latinx_jail_pop double, white_jail_pop double,"
    " jail_rated_capacity double, total_jail_admits double, total_jail_discharges double"
)
STATE_SCHEMA = "year int, state_abbr string, total_jail_pop double, total_pretrial_custody double"
DEATHS_SCHEMA = (
    "death_id bigint, facility_name string, jurisdiction string, death_date date,"
    " manner_of_death string, conviction_status string, age_at_death int, gender string,"
    " race_ethnicity string, charge_at_death string, days_detained int, source string,"
    " source_url string"
)
EVICTION_SCHEMA = (
    "zip string, eviction_rate double, eviction_filing_rate double, low_income_renter_pct double"
)

FACILITY_SCHEMA = (
    "facility_id string, facility_name string, jurisdiction string, zip string,"
    " facility_type string, security_level string, rated_capacity bigint,"
    " deaths_in_custody_ytd bigint, use_of_force_incidents_ytd bigint,"
    " solitary_population bigint, federal_oversight boolean, oversight_reason string,"
    " conditions_last_updated date"
)


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The schema's columns by their names in the header, in whatever order and company; what is
    no value of the type, and a column that the file lacks, is null."""
    rows = spark.read.csv(path, header=True)
    own = {clean_name(name): name for name in rows.columns}
    return rows.select(
        *[
            (F.col(f"`{own[f.name]}`") if f.name in own else F.lit(None).cast("string"))
            .try_cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(ddl).fields
        ]
    )


def read_county_trends(spark: SparkSession, path: str) -> DataFrame:
    """County trends; the county code is text padded to five digits."""
    rows = read_csv(spark, path, COUNTY_SCHEMA)
    return rows.withColumn("county_fips", F.lpad("county_fips", 5, "0"))


def read_state_trends(spark: SparkSession, path: str) -> DataFrame:
    """State trends."""
    return read_csv(spark, path, STATE_SCHEMA)


def read_census(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Responses that are arrays of arrays, the first of them the header.

    One response covers a bounded number of ZIPs. Lines hold one response each
    unless ``whole_files`` says that every file is one.
    """
    text = spark.read.text(path, wholetext=whole_files)
    rows = F.from_json("value", "array<array<string>>")
    listed = text.select(rows.alias("rows")).select(
        F.col("rows")[0].alias("header"), F.explode(F.slice("rows", 2, F.size("rows"))).alias("row")
    )
    names = {**config.CENSUS_VARIABLES, config.CENSUS_ZIP_HEADER: "zip_code"}
    by_name = listed.select(F.map_from_arrays("header", "row").alias("cell"))
    return by_name.select(*[F.try_element_at("cell", F.lit(code)).alias(n) for code, n in names.items()])


def read_deaths(spark: SparkSession, path: str) -> DataFrame:
    """Deaths in custody; rows without a source get the register's name."""
    rows = read_csv(spark, path, DEATHS_SCHEMA)
    return rows.withColumn("source", F.coalesce("source", F.lit(config.DEATHS_SOURCE)))


def read_evictions(spark: SparkSession, path: str) -> DataFrame:
    """Eviction rates per ZIP."""
    rows = read_csv(spark, path, EVICTION_SCHEMA)
    return rows.select(
        zip5(F.col("zip")).alias("zip_code"),
        F.col("eviction_rate").alias("eviction_rate_per_100"),
        "eviction_filing_rate",
    )


def with_evictions(geography: DataFrame, evictions: DataFrame) -> DataFrame:
    """Geography with the eviction columns filled in where the ZIP is known."""
    kept = [name for name in geography.columns if not name.startswith("eviction_")]
    return geography.select(*kept).join(evictions, "zip_code", "left")


def read_facilities(spark: SparkSession, path: str) -> DataFrame:
    """Published attributes of facilities."""
    rows = read_csv(spark, path, FACILITY_SCHEMA)
    return rows.withColumn("zip_code", zip5(F.col("zip"))).drop("zip")
