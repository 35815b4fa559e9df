"""Source, transform and load steps by ID, bound to the test tables.

Steps that read files first have Spark write the files from the test tables,
into the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from custodia import config
from custodia.fixtures import binding, intake as raw
from custodia.functions.clean import age_bucket, day, hashed, zip5
from custodia.functions.grouping import numbered
from custodia.functions.measures import rows
from custodia.operators import census, intake, privacy, quality, trends, warehouse
from custodia.operators.charges import charge_dimension, with_charge_key
from custodia.plans.ingest import enriched as enrich
from custodia.plans.load import load
from custodia.sources import landing, sinks
from custodia.sources.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]

AT = datetime(2021, 8, 2)
BATCH = "batch-1"
CUT = date(2015, 1, 4)
SOURCE = {source.name: source for source in config.SOURCES}
CUSTODY, DISCHARGES, DC = SOURCE[raw.CUSTODY], SOURCE[raw.DISCHARGES], SOURCE[raw.DC]


# --- landed files -------------------------------------------------------------
def land(spark: SparkSession, sf_dir: str, source: config.Source, pages: bool = False) -> str:
    path = new_folder(spark, "landing")
    frame = raw.feature_pages if pages else raw.raw_frame
    frame(spark, sf_dir, source).write.json(path)
    return path


def land_csv(spark: SparkSession, df: DataFrame) -> str:
    path = new_folder(spark, "csv")
    df.write.csv(path, header=True)
    return path


def custody_records(spark: SparkSession, sf_dir: str, since: int | None = None) -> DataFrame:
    path = land(spark, sf_dir, CUSTODY)
    return landing.read_source(spark, CUSTODY, path, since, binding.AS_OF, AT)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_source(spark, DC, land(spark, sf_dir, DC, pages=True), extracted_at=AT)


def all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source but one, whose files are missing and which is skipped."""
    paths = {
        source.name: land(spark, sf_dir, source, pages=source.kind == "features")
        for source in config.SOURCES
        if source.name != raw.MD
    }
    paths[raw.MD] = new_folder(spark, "missing")
    return landing.read_all(spark, paths, config.SOURCES, rename=intake.renamed, extracted_at=AT)


def oddly_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = raw.intake(spark, sf_dir)
    return rows_.select(
        F.col("inmate_id").alias(" Inmate ID"),
        F.col("booking_date").alias("Booking Date "),
        F.col("zip_code").alias("Home-ZIP"),
    )


def census_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "census")
    raw.census_responses(spark, sf_dir).write.text(path)
    return landing.read_census(spark, path)


def county_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_county_trends(spark, land_csv(spark, raw.county_trends(spark, sf_dir)))


def state_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_state_trends(spark, land_csv(spark, raw.state_trends(spark, sf_dir)))


def deaths_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = binding.deaths(spark, sf_dir)
    layout = spark.createDataFrame([], landing.DEATHS_SCHEMA)
    full = layout.unionByName(known, allowMissingColumns=True)
    return landing.read_deaths(spark, land_csv(spark, full)).select(*known.columns, "source")


def evicted_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = landing.read_evictions(spark, land_csv(spark, raw.evictions(spark, sf_dir)))
    return landing.with_evictions(binding.geography(spark, sf_dir), rates).select(
        "zip_code", "city", "jurisdiction", "median_household_income", "eviction_rate_per_100",
        "eviction_filing_rate",
    )


def charges_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded dimension with the bookings of each charge."""
    used = binding.bookings(spark, sf_dir).groupBy(
        F.col("primary_charge_key").alias("charge_key")
    ).agg(rows().alias("bookings"))
    return (
        charge_dimension(spark)
        .drop("charge_code")
        .join(used, "charge_key", "left")
        .withColumn("bookings", F.coalesce("bookings", F.lit(0)))
    )


# --- enriched bookings --------------------------------------------------------
def context(spark: SparkSession, sf_dir: str, earlier: bool = False) -> DataFrame:
    return census.context_by_zip(raw.raw_census(spark, sf_dir, earlier))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(raw.intake(spark, sf_dir), context(spark, sf_dir), binding.SALT, BATCH, AT)


def batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The bookings before a date, with earlier census figures, and all the others."""
    bookings = raw.intake(spark, sf_dir)
    early = F.coalesce(day(F.col("booking_date")) < F.lit(CUT), F.lit(False))

    def batch(condition, earlier: bool) -> DataFrame:
        part = bookings.filter(condition)
        return enrich(part, context(spark, sf_dir, earlier), binding.SALT, BATCH, AT)

    return batch(early, True), batch(~early, False)


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Written once and read back: the load steps below read their bookings several times."""
    return sinks.read_snapshot(
        spark, sinks.write_snapshot(df, new_folder(spark, "snapshots"), AT, keep_latest=False)
    )


def stored_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, enriched(spark, sf_dir))


def stored_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    first, second = batches(spark, sf_dir)
    return stored(spark, first), stored(spark, second)


def snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "snapshots")
    snapshot = sinks.write_snapshot(enriched(spark, sf_dir), folder, AT)
    both = [
        sinks.read_snapshot(spark, path).withColumn("copy", F.lit(name))
        for name, path in (("snapshot", snapshot), ("latest", sinks.latest(folder)))
    ]
    return landing.combined(both).groupBy("copy", "jurisdiction").agg(
        rows().alias("bookings"), F.count("work_days_to_bail").alias("with_bail_gap")
    )


def stored_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "trends")
    sinks.write_trends(trends.target_counties(county_file(spark, sf_dir)), path)
    return spark.read.parquet(path)


def counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(rows().alias("bookings"))


def counted_enriched(*keys: str) -> Query:
    return lambda spark, sf_dir: counted(enriched(spark, sf_dir), *keys)


def hashed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = raw.intake(spark, sf_dir).withColumnRenamed("facility", "address")
    hidden = privacy.hash_identifiers(rows_, binding.SALT)
    return counted(hidden, "inmate_id_hash", "address_hash", "jurisdiction")


def bucketed_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two age columns: the later one in the list counts."""
    rows_ = raw.intake(spark, sf_dir)
    two = rows_.withColumnRenamed("age", "defendant_age").withColumn("age", F.lit("40"))
    return counted(privacy.bucket_ages(two), "age_bucket", "jurisdiction")


def guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    safe = privacy.anonymised(raw.intake(spark, sf_dir), binding.SALT)
    left = [name for name in config.PII_COLUMNS + config.AGE_COLUMNS if name in safe.columns]
    return (
        safe.groupBy("jurisdiction", "inmate_id_hash")
        .agg(rows().alias("n"))
        .groupBy("jurisdiction")
        .agg(
            F.sum("n").alias("bookings"),
            rows().alias("people"),
            F.lit(len(left)).cast("long").alias("personal_columns"),
        )
    )


def resolved_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = raw.intake(spark, sf_dir).withColumnRenamed("zip_code", "residence_zip")
    return counted(intake.with_clean_zip(rows_), "zip_code")


def clean_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = zip5(F.col("zip_code")).alias("zip_code")
    return raw.intake(spark, sf_dir).select(code).filter(F.col("zip_code").isNotNull()).distinct()


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = privacy.anonymised(raw.intake(spark, sf_dir), binding.SALT)
    held = both.filter(F.col("source_system") == raw.CUSTODY).drop("release_date")
    freed = both.filter(F.col("source_system") == raw.DISCHARGES)
    return intake.detention_timeline(held, freed).select(
        "inmate_id_hash", "booking_day", "release_day", "days_detained"
    )


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = binding.table(spark, sf_dir, "events").select(
        "event_id",
        binding.jurisdiction(F.col("user_id")).alias("jurisdiction"),
        F.col("ts").cast("date").alias("death_date"),
    )
    return trends.reconciled_deaths(
        events.filter(F.col("event_id") % 2 == 0),
        events.filter(F.col("event_id") % 2 == 1),
    )


# --- warehouse ----------------------------------------------------------------
def geography_after_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = stored_batches(spark, sf_dir)
    return warehouse.upsert_geography(second, warehouse.upsert_geography(first))


def _added(step: Callable) -> Query:
    """A dimension that is only added to, after two batches."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, second = stored_batches(spark, sf_dir)
        known = step(first)
        return known.unionByName(step(second, known))

    return query


def unnamed_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    unnamed = raw.intake(spark, sf_dir).filter(F.col("facility").isNull())
    per_place = counted(unnamed, "jurisdiction")
    return per_place.join(warehouse.default_facilities(spark), "jurisdiction").select(
        "facility_id", "facility_name", "bookings"
    )


def resolved_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_code = counted(raw.intake(spark, sf_dir), "charge_code_raw")
    return with_charge_key(per_code, charge_dimension(spark))


def keyed_rows(rows_: DataFrame) -> DataFrame:
    return warehouse.with_keys(
        warehouse.one_row_per_event(warehouse.projected(rows_)),
        warehouse.upsert_geography(rows_),
        warehouse.new_inmates(rows_),
        warehouse.new_facilities(rows_),
        charge_dimension(rows_.sparkSession),
    )


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_rows(stored_enriched(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.one_row_per_event(warehouse.projected(enriched(spark, sf_dir)))


def keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir).select(
        "event_id", "inmate_key", "facility_key", "home_geo_key", "primary_charge_key"
    )


def filled_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    defaulted = F.col("facility").isNull().alias("defaulted")
    return keyed(spark, sf_dir).groupBy("jurisdiction", defaulted, "facility_key").agg(
        rows().alias("bookings")
    )


def projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bookings under other accepted column names."""
    other = {
        "booking_date": "admitted_dt", "release_date": "discharge_date",
        "bail_set_amount": "bond_amount", "bail_type": "bond_type", "facility": "housed_in_facility",
    }
    renamed = stored_enriched(spark, sf_dir).withColumnsRenamed(other)
    return warehouse.projected(renamed).drop("etl_batch_id", "etl_loaded_at")


def kept_after_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only people booked in the first days are known, so the other bookings lack a key."""
    rows_ = stored_enriched(spark, sf_dir)
    early = rows_.filter(F.col("booking_date_parsed") < F.lit(CUT))
    with_gaps = warehouse.with_keys(
        warehouse.one_row_per_event(warehouse.projected(rows_)),
        warehouse.upsert_geography(rows_),
        warehouse.new_inmates(early),
        warehouse.new_facilities(rows_),
        charge_dimension(spark),
    )
    return warehouse.complete(with_gaps).groupBy("jurisdiction").agg(rows().alias("kept"))


def loaded_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second one loaded again, which must change nothing."""
    root = new_folder(spark, "warehouse")
    first, second = stored_batches(spark, sf_dir)
    for batch in (first, second, second):
        star = load(spark, batch, root)
    return star.fact.select("event_id", "detention_key", F.col("jurisdiction").cast("string"))


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.with_generated(events(spark, sf_dir)).select(
        "event_id", "booking_date", "release_date", "bail_set_amount", "bail_paid",
        "detention_length_days", "pretrial_detention_flag",
    )


def fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = events(spark, sf_dir).select("event_id")
    return numbered(ids, "event_id", "detention_key", F.lit(0), digest=True)


def rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(quality.judged(keyed(spark, sf_dir), quality.fact_rules()), "jurisdiction", "reason")


def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = stored_enriched(spark, sf_dir)
    facts, people = keyed_rows(rows_), warehouse.new_inmates(rows_)
    places = warehouse.new_facilities(rows_)
    return quality.key_report(
        {
            "fact booking_date not null": quality.nulls(facts, "booking_date"),
            "raw person unique": quality.duplicates(rows_, "inmate_id_hash"),
            "person hash unique": quality.duplicates(people, "inmate_id_hash"),
            "fact charge known": quality.orphans(
                facts, "primary_charge_key", charge_dimension(spark), "charge_key"
            ),
            "raw facility known": quality.orphans(rows_, "facility", places, "facility_id"),
        }
    )


def defaulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    defaults = {
        "bail_type": "No Bail Set",
        "federal_oversight": False,
        "census_vintage": config.CENSUS_VINTAGE,
    }
    return counted(warehouse.with_defaults(enriched(spark, sf_dir), defaults), *defaults)


def rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch loaded, then everything built anew from the other one."""
    root = new_folder(spark, "warehouse")
    first, second = stored_batches(spark, sf_dir)
    load(spark, first, root)
    fact = load(spark, second, root, rebuild=True).fact
    return fact.groupBy(F.col("jurisdiction").cast("string").alias("jurisdiction")).agg(
        rows().alias("bookings"),
        F.min("detention_key").alias("first_key"),
        F.max("detention_key").alias("last_key"),
    )


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "warehouse")
    load(spark, stored_enriched(spark, sf_dir), root)
    return spark.read.parquet(f"{root}/mv_innocence_by_jurisdiction")


def queries() -> dict[str, Query]:
    return {
        "S01": custody_records,
        "S02": features,
        "S03": lambda s, d: custody_records(s, d, since=400),
        "S04": lambda s, d: landing.in_date_order(custody_records(s, d), "admitted_dt", "inmateid"),
        "S05": lambda s, d: counted(
            raw.intake(s, d).filter(
                F.col("source_system").isin([source.name for source in landing.active_sources()])
            ),
            "source_system",
        ),
        "S06": lambda s, d: counted(
            landing.tagged(raw.raw_frame(s, d, DISCHARGES), DISCHARGES, AT), *intake.PROVENANCE
        ),
        "S07": all_sources,
        "S08": lambda s, d: landing.normalised(oddly_named(s, d), keep_hyphens=True),
        "S09": county_file,
        "S10": state_file,
        "S11": census_file,
        "S12": deaths_file,
        "S13": evicted_geography,
        "S14": snapshot_counts,
        "S15": stored_trends,
        "S16": lambda s, d: counted(
            stored_enriched(s, d), "jurisdiction", "source_system", "age_bucket"
        ),
        "S17": charges_in_use,
        "T01": lambda s, d: intake.renamed(
            landing.tagged(raw.raw_frame(s, d, DISCHARGES), DISCHARGES, AT), DISCHARGES
        ).drop("extracted_at"),
        "T02": lambda s, d: intake.with_known_source(
            raw.intake(s, d).withColumn(
                "source_system", F.when(F.col("age") != "n/a", F.col("source_system"))
            )
        ),
        "T03": lambda s, d: raw.intake(s, d)
        .groupBy(hashed(F.col("inmate_id"), binding.SALT).alias("person"))
        .agg(rows().alias("bookings")),
        "T04": hashed_columns,
        "T05": lambda s, d: counted(
            raw.intake(s, d).withColumn("age_bucket", age_bucket(F.col("age"))), "age", "age_bucket"
        ),
        "T06": bucketed_ages,
        "T07": guarded,
        "T08": counted_enriched("jurisdiction", "detention_status_code", "pretrial_derived"),
        "T09": lambda s, d: counted(
            raw.intake(s, d).withColumn(
                "custody_status", intake.custody_status(F.col("detention_status_code"))
            ),
            "detention_status_code",
            "custody_status",
        ),
        "T10": resolved_zip,
        "T11": clean_zips,
        "T12": lambda s, d: census.typed(raw.raw_census(s, d)),
        "T13": lambda s, d: census.with_ratios(census.typed(raw.raw_census(s, d))).select(
            "zip_code", "median_daily_income", "poverty_rate_pct", "pct_children_single_parent",
            "pct_severely_rent_burdened", "pct_bachelors_or_higher", "pct_black", "pct_white",
            "pct_hispanic",
        ),
        "T14": context,
        "T15": lambda s, d: enriched(s, d).select(
            "inmate_id_hash", "booking_date", "source_system", *config.CENSUS_OUTPUTS
        ),
        "T16": lambda s, d: enriched(s, d).select(
            "inmate_id_hash", "booking_date", "bail_set_amount", "bail_set_amount_num",
            "median_daily_income", "work_days_to_bail",
        ),
        "T17": counted_enriched(
            "jurisdiction", "booking_date", "booking_date_parsed", "is_md_reform_case"
        ),
        "T18": counted_enriched("etl_batch_id", "etl_loaded_at"),
        "T19": lambda s, d: quality.coverage(enriched(s, d)),
        "T20": lambda s, d: quality.run_summary(enriched(s, d)),
        "T21": lambda s, d: trends.target_counties(county_file(s, d)),
        "T22": lambda s, d: trends.latest_year_summary(county_file(s, d)),
        "T23": lambda s, d: trends.profile(county_file(s, d)),
        "T24": timeline,
        "T25": lambda s, d: intake.only_declared(
            landing.tagged(
                raw.raw_frame(s, d, CUSTODY).withColumns(
                    {"bradh": F.lit("N"), "srg_flg": F.lit("N")}
                ),
                CUSTODY,
                AT,
            ),
            CUSTODY,
        ),
        "T26": reconciliation,
        "T27": lambda s, d: trends.yearly_shares(county_file(s, d), "county_fips"),
        "W01": geography_after_two,
        "W02": _added(warehouse.new_inmates),
        "W03": _added(warehouse.new_facilities),
        "W04": unnamed_facilities,
        "W05": resolved_charges,
        "W06": keys_only,
        "W07": filled_facilities,
        "W08": projected,
        "W09": kept_after_keys,
        "W10": loaded_twice,
        "W11": generated,
        "W12": fact_keys,
        "W13": rejections,
        "W14": key_checks,
        "W15": defaulted,
        "W16": rebuilt,
        "W17": refreshed,
    }
