"""Dimension upserts, key resolution and fact rows for the star schema.

Dimensions are joined in full to resolve keys; nothing is collected to the driver.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from custodia import config
from custodia.functions.clean import day, number
from custodia.functions.grouping import hot_join, numbered, numbered_by_range
from custodia.operators.charges import small_table, with_charge_key
from custodia.operators.intake import first_present

_FAR = "9999-12-31"
REFRESHED = ["median_household_income", "median_daily_income", "poverty_rate_pct"]
KEPT_CONTEXT = [
    "pct_children_single_parent", "pct_severely_rent_burdened", "pct_bachelors_or_higher",
    "total_population", "pct_black", "pct_white", "pct_hispanic",
]
PERSON_ATTRIBUTES = ["age_bucket", "gender", "race_ethnicity"]


def _first_seen(*attributes: Column) -> Column:
    """The attributes of a group's earliest booking. A plain minimum of a struct combines
    on the map side, so a person or ZIP behind a third of the rows is no burden."""
    when = F.coalesce(day(F.col("booking_date")), F.lit(_FAR).cast("date"))
    return F.min(F.struct(when.alias("_when"), F.col("source_system"), *attributes))


def _largest(existing: DataFrame | None, key: str) -> Column:
    """The largest key in use. A scalar subquery, so it stays part of the same job."""
    if existing is None:
        return F.lit(0)
    return F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(0))


def _new_rows(candidates: DataFrame, existing: DataFrame | None, on: str) -> DataFrame:
    if existing is None:
        return candidates
    return candidates.join(existing.select(on), on, "left_anti")


def _with_missing(df: DataFrame, names: list[str], kind: str) -> DataFrame:
    lacking = {name: F.lit(None).cast(kind) for name in names if name not in df.columns}
    return df.withColumns(lacking) if lacking else df


def upsert_geography(bookings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per ZIP. A known ZIP keeps its key and gets new income and poverty
    figures; its other columns stay as they were first loaded."""
    context = _with_missing(bookings, REFRESHED + KEPT_CONTEXT, "double")
    figures = [F.col(name) for name in REFRESHED + KEPT_CONTEXT]
    batch = (
        context.filter(F.col("zip_code").isNotNull())
        .groupBy("zip_code")
        .agg(_first_seen(F.col("jurisdiction"), *figures).alias("first"))
        .select("zip_code", "first.jurisdiction", *[f"first.{n}" for n in REFRESHED + KEPT_CONTEXT])
        .withColumn("census_vintage", F.lit(config.CENSUS_VINTAGE).cast("smallint"))
    )
    added = numbered(
        _new_rows(batch, existing, "zip_code"), "zip_code", "geo_key", _largest(existing, "geo_key")
    )
    if existing is None:
        return added
    fresh = batch.select(
        "zip_code", F.lit(True).alias("_seen"), *[F.col(n).alias(f"_new_{n}") for n in REFRESHED]
    )
    updated = existing.join(fresh, "zip_code", "left").withColumns(
        {n: F.when(F.col("_seen"), F.col(f"_new_{n}")).otherwise(F.col(n)) for n in REFRESHED}
    )
    return updated.select(*existing.columns).unionByName(added, allowMissingColumns=True)


def current_geography(history: DataFrame) -> DataFrame:
    """The newest stored row of each ZIP. Loads only add rows, so one that stops half-way
    leaves every ZIP with either its old or its new figures, never without any."""
    names = [name for name in history.columns if name not in ("zip_code", "load_no")]
    newest = F.max(F.struct("load_no", *names)).alias("row")
    return history.groupBy("zip_code").agg(newest).select("zip_code", *[f"row.{n}" for n in names])


def unseen_inmates(
    bookings: DataFrame, existing: DataFrame | None = None, with_home: bool = False
) -> DataFrame:
    """The people not yet in the dimension, with the attributes of their first booking.

    ``with_home`` adds that booking's ZIP as ``home_zip_code``; everybody without an identifier
    is one row, which has no home.
    """
    people = _with_missing(bookings, PERSON_ATTRIBUTES + ["zip_code"], "string")
    bucket = F.coalesce("age_bucket", F.lit(config.AGE_BUCKETS[-1])).alias("age_bucket")
    attributes = [bucket, F.col("gender"), F.col("race_ethnicity")]
    names = list(PERSON_ATTRIBUTES)
    if with_home:
        named = F.col("inmate_id_hash") != config.UNKNOWN_PERSON
        attributes.append(F.when(named, F.col("zip_code")).alias("home_zip_code"))
        names.append("home_zip_code")
    batch = (
        people.groupBy("inmate_id_hash")
        .agg(_first_seen(*attributes).alias("first"))
        .select("inmate_id_hash", *[f"first.{name}" for name in names])
    )
    return _new_rows(batch, existing, "inmate_id_hash")


def keyed_inmates(people: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Keys for new people, going on from the largest one in use."""
    start = _largest(existing, "inmate_key")
    return numbered(people, "inmate_id_hash", "inmate_key", start, digest=True)


def new_inmates(bookings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """W02 and W12 in one plan. A load writes the people between the two steps instead."""
    return keyed_inmates(unseen_inmates(bookings, existing), existing)


def default_facilities(spark: SparkSession) -> DataFrame:
    """The facility that stands for a jurisdiction when a booking names none."""
    names = ["facility_id", "facility_name", "jurisdiction"]
    return small_table(
        spark,
        [dict(zip(names, row)) for row in config.DEFAULT_FACILITIES],
        pa.schema([(name, pa.string()) for name in names]),
    )


def facility_id(jurisdiction: Column, name: Column) -> Column:
    return F.concat(jurisdiction, F.lit("-"), F.substring(name, 1, 30))


def new_facilities(bookings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Facilities not yet in the dimension; the defaults are always part of it."""
    batch = default_facilities(bookings.sparkSession)
    found = first_present(bookings, config.FACILITY_CANDIDATES)
    if found is not None:
        named = bookings.filter(F.col(found).isNotNull()).select(
            facility_id(F.col("jurisdiction"), F.col(found)).alias("facility_id"),
            F.col(found).alias("facility_name"),
            "jurisdiction",
        )
        seen = named.groupBy("facility_id").agg(
            F.min("facility_name").alias("facility_name"),
            F.min("jurisdiction").alias("jurisdiction"),
        )
        batch = batch.unionByName(seen)
    added = _new_rows(batch, existing, "facility_id")
    start = _largest(existing, "facility_key")
    return numbered_by_range(added, "facility_id", "facility_key", start).withColumn(
        "federal_oversight", F.lit(False)
    )


def projected(bookings: DataFrame) -> DataFrame:
    """The fact's columns from whichever source columns are there, typed."""

    def pick(candidates: list[str]) -> Column:
        found = first_present(bookings, candidates)
        return F.col(found) if found else F.lit(None).cast("string")

    def optional(name: str, kind: str) -> Column:
        return F.col(name) if name in bookings.columns else F.lit(None).cast(kind)

    paid = optional("bail_paid", "string").cast("string").try_cast("boolean")
    return bookings.select(
        "inmate_id_hash",
        "jurisdiction",
        "source_system",
        optional("zip_code", "string").alias("zip_code"),
        pick(config.FACILITY_CANDIDATES).alias("facility"),
        optional("charge_code_raw", "string").alias("charge_code_raw"),
        day(pick(config.BOOKING_DATE_CANDIDATES)).alias("booking_date"),
        day(pick(config.RELEASE_DATE_CANDIDATES)).alias("release_date"),
        number(pick(config.BAIL_AMOUNT_CANDIDATES)).alias("bail_set_amount"),
        pick(config.BAIL_TYPE_CANDIDATES).alias("bail_type"),
        paid.alias("bail_paid"),
        optional("case_disposition", "string").alias("case_disposition"),
        optional("sentence_type", "string").alias("sentence_type"),
        optional("work_days_to_bail", "double").alias("work_days_to_bail"),
        optional("is_md_reform_case", "boolean").alias("is_md_reform_case"),
        optional("pretrial_derived", "boolean").alias("pretrial_derived"),
        optional("etl_batch_id", "string").alias("etl_batch_id"),
        optional("etl_loaded_at", "string").alias("etl_loaded_at"),
    )


_EVENT = ["inmate_id_hash", "booking_date", "source_system", "charge_code_raw", "facility", "bail_set_amount"]
# What becomes known later, so that a repeated row that has it is the better one.
_LATER = ["release_date", "bail_paid", "case_disposition"]
_DETAILS = [
    "jurisdiction", "zip_code", "facility", "charge_code_raw", "release_date", "bail_set_amount",
    "bail_type", "bail_paid", "case_disposition", "work_days_to_bail", "is_md_reform_case",
    "pretrial_derived",
]


def one_row_per_event(projected_rows: DataFrame) -> DataFrame:
    """One row per booking, with a digest ``event_id`` of what tells bookings apart: the person,
    date and source, and the charge, facility and bail.

    A repeated load must not add the same booking twice. People without an
    identifier are not one person, so their rows are told apart by all details.
    Of differing repeats one with a release, then one with a payment and a disposition is
    kept; among those the smallest row, column by column.
    """
    unknown = F.col("inmate_id_hash") == config.UNKNOWN_PERSON
    cents = ["bail_set_amount", "work_days_to_bail"]

    def text(name: str) -> Column:
        whole = F.rint(F.col(name) * 100).cast("long") if name in cents else F.col(name)
        return F.coalesce(whole.cast("string"), F.lit(""))

    person = F.concat_ws("|", *[text(name) for name in _EVENT])
    details = F.concat_ws("|", *[text(name) for name in _EVENT + _DETAILS])
    event_id = F.sha2(F.when(unknown, details).otherwise(person), 256)
    ordered = _EVENT + [name for name in _DETAILS if name not in _EVENT]
    ordered += [name for name in projected_rows.columns if name not in ordered]
    missing = [F.col(name).isNull().alias(f"_no_{name}") for name in _LATER]
    return (
        projected_rows.withColumn("event_id", event_id)
        .groupBy("event_id")
        .agg(F.min(F.struct(*missing, *ordered)).alias("kept"))
        .select("event_id", *[F.col(f"kept.{name}").alias(name) for name in ordered])
    )


def with_keys(
    rows: DataFrame,
    geography: DataFrame,
    inmates: DataFrame,
    facilities: DataFrame,
    charges: DataFrame,
) -> DataFrame:
    """Surrogate keys by joining the dimensions; the default facility fills gaps.

    The person dimension grows with the data and one marker stands for everybody
    without an identifier, so that join spreads the marker's rows. The other
    dimensions are small and left to the planner's own size check.
    """
    homes = geography.select("zip_code", F.col("geo_key").alias("home_geo_key"))
    places = facilities.select("facility_id", "facility_key")
    defaults = places.join(
        default_facilities(rows.sparkSession).select("facility_id", "jurisdiction"), "facility_id"
    ).select("jurisdiction", F.col("facility_key").alias("_default_key"))
    people = inmates.select("inmate_id_hash", "inmate_key")
    placed = (
        with_charge_key(rows, charges)
        .join(homes, "zip_code", "left")
        .withColumn("facility_id", facility_id(F.col("jurisdiction"), F.col("facility")))
        .join(places, "facility_id", "left")
        .join(F.broadcast(defaults), "jurisdiction", "left")  # one row per default facility
        .withColumn("facility_key", F.coalesce("facility_key", "_default_key"))
        .drop("facility_id", "_default_key")
    )
    return hot_join(
        placed, people, "inmate_id_hash", config.UNKNOWN_PERSON, spread_by=["event_id"]
    )


def complete(rows: DataFrame) -> DataFrame:
    """Rows with a person, a facility and a jurisdiction."""
    return rows.dropna(subset=["inmate_key", "facility_key", "jurisdiction"])


def with_generated(rows: DataFrame) -> DataFrame:
    """Length of stay (null while held) and the pretrial flag (bail set, not paid)."""
    return rows.withColumns(
        {
            "detention_length_days": F.datediff("release_date", "booking_date"),
            "pretrial_detention_flag": F.col("bail_set_amount").isNotNull()
            & ~F.coalesce("bail_paid", F.lit(False)),
        }
    )


def with_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Values for columns that are null or not there at all."""

    def filled(name: str, value) -> Column:
        value = F.lit(value)
        return F.coalesce(F.col(name), value) if name in rows.columns else value

    return rows.withColumns({name: filled(name, value) for name, value in defaults.items()})


FACT_DEFAULTS = {"is_md_reform_case": False}


# What a booking that is stored already holds there; null for a new one.
_STORED = {
    "detention_key": "bigint", "jurisdiction": "string", "booking_date": "date", "release_date": "date",
    "bail_paid": "boolean", "case_disposition": "string",
}


def _of_stored(name: str) -> Column:
    return F.col(f"_stored_{name}")


def is_new(rows: DataFrame) -> DataFrame:
    """Of the bookings of ``met`` those that are not stored yet."""
    return rows.filter(_of_stored("detention_key").isNull()).drop(*[f"_stored_{n}" for n in _STORED])


def met(bookings: DataFrame, stored_facts: DataFrame | None) -> DataFrame:
    """The batch's bookings that have work to do: new ones, and stored ones of which the batch knows
    more, those with the state of the stored row (``current_facts``).

    Bookings are told apart and held against the stored ones once, on the same partitioning, so a
    repeated load carries few rows any further.
    """
    events = one_row_per_event(projected(bookings))
    if stored_facts is None:
        return events.withColumns({f"_stored_{n}": F.lit(None).cast(kind) for n, kind in _STORED.items()})
    known = stored_facts.select("event_id", *[F.col(n).alias(f"_stored_{n}") for n in _STORED])
    learned = [_of_stored(n).isNull() & F.col(n).isNotNull() for n in _LATER]
    return events.join(known, "event_id", "left").filter(
        _of_stored("detention_key").isNull() | functools.reduce(Column.__or__, learned)
    )


def fact_candidates(
    rows: DataFrame,
    geography: DataFrame,
    inmates: DataFrame,
    facilities: DataFrame,
    charges: DataFrame,
) -> DataFrame:
    """Keyed rows of bookings (``met``)."""
    keyed = with_keys(rows, geography, inmates, facilities, charges)
    return with_defaults(with_generated(keyed), FACT_DEFAULTS)


def current_facts(facts: DataFrame, amendments: DataFrame | None) -> DataFrame:
    """Stored facts with what later loads have learned of them: the newest amendment of each.

    Amendments hold the whole later state of a booking. They are few beside the facts, so whether
    they are sent to the facts or both are sorted is left to the planner, which knows their size.
    """
    if amendments is None:
        return facts
    newest = F.max(F.struct("load_no", *_LATER)).alias("_new")
    latest = amendments.groupBy("detention_key").agg(newest)
    joined = facts.join(latest, "detention_key", "left")
    later = {name: F.coalesce(F.col(f"_new.{name}"), F.col(name)) for name in _LATER}
    return with_generated(joined.withColumns(later)).select(*facts.columns)


def amendments(bookings: DataFrame, stored_facts: DataFrame) -> DataFrame:
    """What a batch adds to bookings loaded before: a release, payment or disposition that the stored
    row (``current_facts``) lacks. A value that is known already stays.

    Bookings without an identifier cannot be met again: all their details tell them apart.
    """
    return amended(met(bookings, stored_facts))


def amended(rows: DataFrame) -> DataFrame:
    """The whole later state of the stored bookings among ``rows`` (``met``)."""
    return rows.filter(_of_stored("detention_key").isNotNull()).select(
        *[
            (F.coalesce(_of_stored(n), F.col(n)) if n in _LATER else _of_stored(n)).alias(n)
            for n in _STORED
        ]
    )


def new_facts(candidates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Fact rows with keys that go on from the largest one in use.

    Keys follow the order of the event digests and are counted per digest
    prefix, so no window runs over the whole batch.
    """
    start = _largest(existing, "detention_key")
    return numbered(candidates, "event_id", "detention_key", start, digest=True)


def changed_evictions(geography: DataFrame, rates: DataFrame) -> DataFrame:
    """The ZIPs whose eviction figures a file changes, as whole new rows.

    A ZIP that the file lacks, and a figure that it leaves open, stay as they are. Of several rows
    of a ZIP the largest figures are taken.
    """
    names = ["eviction_rate_per_100", "eviction_filing_rate"]
    given = rates.filter(F.col("zip_code").isNotNull()).groupBy("zip_code").agg(*[F.max(n).alias(f"_{n}") for n in names])
    new = {n: F.coalesce(F.col(f"_{n}"), F.col(n)) for n in names}
    differs = functools.reduce(Column.__or__, [~F.col(n).eqNullSafe(c) for n, c in new.items()])
    return geography.join(given, "zip_code").filter(differs).withColumns(new).select(*geography.columns)


def identified(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows that name a facility, with its id: the given one, else that of a known facility of the
    name, else the one that a booking with this name would get."""
    named = ["jurisdiction", "facility_name"]
    ids = known.groupBy(*named).agg(F.min("facility_id").alias("_known"))
    made = facility_id(F.col("jurisdiction"), F.col("facility_name"))
    found = [F.col(n) for n in ("facility_id", "_known") if n == "_known" or n in rows.columns]
    joined = rows.join(ids, named, "left")
    return joined.withColumn("facility_id", F.coalesce(*found, made)).drop("_known")


def current_facilities(facilities: DataFrame, updates: DataFrame | None) -> DataFrame:
    """Facilities with the newest known value of each attribute; updates leave unknown ones null."""
    if updates is None:
        return facilities
    names = [n for n in updates.columns if n not in ("facility_id", "load_no")]
    newest = [F.max_by(n, F.when(F.col(n).isNotNull(), F.col("load_no"))).alias(f"_{n}") for n in names]
    latest = updates.groupBy("facility_id").agg(*newest)
    known = {n: F.coalesce(F.col(f"_{n}"), F.col(n)) for n in names}
    return facilities.join(latest, "facility_id", "left").withColumns(known).select(*facilities.columns)


def facility_updates(attributes: DataFrame, current: DataFrame, geography: DataFrame) -> DataFrame:
    """What a file of attributes changes: one row per facility with the values that are new.

    Of several rows of a facility the largest value of each attribute is taken.
    """
    names = [
        "facility_type", "security_level", "rated_capacity", "geo_key", "deaths_in_custody_ytd",
        "use_of_force_incidents_ytd", "solitary_population", "federal_oversight", "oversight_reason",
        "conditions_last_updated",
    ]
    placed = attributes
    if "zip_code" in attributes.columns:
        placed = attributes.join(geography.select("zip_code", "geo_key"), "zip_code", "left")
    present = [n for n in names if n in placed.columns]
    given = placed.groupBy("facility_id").agg(*[F.max(n).alias(f"_{n}") for n in present])
    new = {n: F.when(~F.col(f"_{n}").eqNullSafe(F.col(n)), F.col(f"_{n}")) for n in present}
    joined = given.join(current.select("facility_id", *present), "facility_id")
    return joined.withColumns(new).select("facility_id", *present).dropna("all", subset=present)


def added_facilities(attributes: DataFrame, known: DataFrame) -> DataFrame:
    """W03 for a file of attributes: dimension rows of facilities that no booking has named yet."""
    seen = attributes.groupBy("facility_id").agg(
        F.min(F.coalesce("facility_name", "facility_id")).alias("facility_name"), F.min("jurisdiction").alias("jurisdiction")
    )
    added = numbered_by_range(_new_rows(seen, known, "facility_id"), "facility_id", "facility_key", _largest(known, "facility_key"))
    return added.withColumn("federal_oversight", F.lit(False))


def deaths_to_date(deaths: DataFrame, known: DataFrame, as_of) -> DataFrame:
    """Deaths of the year of ``as_of`` up to that day, for each facility in the register."""
    today = F.lit(as_of).cast("date")
    counts = F.col("death_date").between(F.trunc(today, "year").cast("date"), today)
    per_name = deaths.groupBy("jurisdiction", "facility_name").agg(F.count_if(counts).alias("n"))
    return (
        identified(per_name, known).filter(F.col("facility_id").isNotNull())
        .groupBy("facility_id").agg(F.sum("n").alias("deaths_in_custody_ytd"))
    )
