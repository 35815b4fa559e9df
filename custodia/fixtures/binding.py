"""Test tables read as a star schema.

Orders stand for bookings, customers for people, nations for ZIP codes and
suppliers for facilities. The check SQL in ``oracle`` states the same binding
independently.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from custodia import config
from custodia.functions.clean import age_bucket, hashed
from custodia.functions.measures import work_days_to_bail
from custodia.operators.charges import charge_dimension
from custodia.plans.star import Star

AS_OF = date(2021, 8, 2)
SALT = "salt"
SHIFT_DAYS = 7305


# Columns of the test tables, so that opening one does not start a job to look at it.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(index: Column, labels: list) -> Column:
    """``labels[index]``; a null label gives null."""
    return F.element_at(F.array(*[F.lit(label) for label in labels]), index.cast("int") + 1)


def jurisdiction(key: Column) -> Column:
    return pick(key % len(config.JURISDICTIONS), config.JURISDICTIONS)


def shifted(timestamp: Column) -> Column:
    return F.date_add(timestamp.cast("date"), SHIFT_DAYS)


def ordered_between(orders: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """Limit the scan by booking date. The bound is turned back to the stored order date,
    so that it reaches the Parquet reader."""
    at = F.col("o_orderdate")
    shift = timedelta(days=SHIFT_DAYS)
    if since is not None:
        orders = orders.filter(at >= F.lit(datetime.combine(since - shift, time())).cast("timestamp_ntz"))
    if until is not None:
        end = datetime.combine(until - shift + timedelta(days=1), time())
        orders = orders.filter(at < F.lit(end).cast("timestamp_ntz"))
    return orders


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    income = (key * 3500 + 28000).cast("double")
    return table(spark, sf_dir, "nation").select(
        (key + 1).cast("long").alias("geo_key"),
        F.lpad((key * 371 + 10001).cast("string"), 5, "0").alias("zip_code"),
        F.col("n_name").alias("city"),
        jurisdiction(key).alias("jurisdiction"),
        income.alias("median_household_income"),
        F.round(income / 365, 2).alias("median_daily_income"),
        (33 - key).cast("double").alias("poverty_rate_pct"),
        (key * 5 % 50 + 10).cast("double").alias("pct_children_single_parent"),
        (key * 11 % 35 + 8).cast("double").alias("pct_severely_rent_burdened"),
        (key * 13 % 80).cast("double").alias("pct_black"),
        F.when(key % 11 != 10, key * 3 % 9 + 1).cast("double").alias("eviction_rate_per_100"),
        (key * 900 + 20000).cast("long").alias("total_population"),
    )


def facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    watched = key % 4 == 0
    return table(spark, sf_dir, "supplier").select(
        (key + 1).alias("facility_key"),
        F.col("s_name").alias("facility_name"),
        jurisdiction(key).alias("jurisdiction"),
        pick(key % 3, ["Pretrial", "Sentenced", "Mixed"]).alias("facility_type"),
        (key * 15 + 150).alias("rated_capacity"),
        watched.alias("federal_oversight"),
        F.when(watched, "court order").alias("oversight_reason"),
        (key % 5).alias("deaths_in_custody_ytd"),
        (key * 17 % 90).alias("use_of_force_incidents_ytd"),
        F.when(key % 4 != 3, key * 3 + 5).alias("solitary_population"),
    )


def inmate(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key + 1).alias("inmate_key"),
        hashed(F.col("c_name"), SALT).alias("inmate_id_hash"),
        age_bucket((key % 60 + 16).cast("string")).alias("age_bucket"),
        F.when(key % 5 == 0, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("race_ethnicity"),
    )


def bookings(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """The fact table without what needs the person's home: one pass over the orders."""
    key, person = F.col("o_orderkey"), F.col("o_custkey")
    facilities = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    orders = ordered_between(table(spark, sf_dir, "orders"), since, until)
    placed = orders.select(
        (key + 1).alias("detention_key"),
        (person + 1).alias("inmate_key"),
        (key % facilities + 1).alias("facility_key"),
        ((key * 7 + person) % 54 + 1).alias("primary_charge_key"),
        jurisdiction(key).alias("jurisdiction"),
        shifted(F.col("o_orderdate")).alias("booking_date"),
        F.when(key % 7 != 0, F.floor(F.col("o_totalprice") / 60.0).cast("double")).alias(
            "bail_set_amount"
        ),
        F.substring("o_orderpriority", 1, 1).alias("_priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("bail_paid"),
        pick(
            person % 8,
            ["Guilty Plea", "Trial - Guilty", "Trial - Not Guilty", "Dismissed",
             "Nolle Prosequi", "ACD", "Unknown", None],
        ).alias("case_disposition"),
    )
    booked, number = F.col("booking_date"), F.col("detention_key")
    reformed = (F.col("jurisdiction") == config.REFORM_JURISDICTION) & (
        booked >= F.lit(config.REFORM_DATE)
    )
    release = F.when(number % 9 != 0, F.date_add(booked, (number * 13 % 500).cast("int")))
    bail_type = (
        F.when(F.col("_priority") == "1", "Remand")
        .when(F.col("_priority") == "2", "Cash")
        .when(F.col("_priority") == "3", "Bond")
        .when(F.col("_priority") == "4", "ROR")
        .when(reformed, "No Bail (MD Reform)")
        .otherwise("Supervised Release")
    )
    unpaid = F.col("bail_set_amount").isNotNull() & ~F.coalesce("bail_paid", F.lit(False))
    return (
        placed.withColumns(
            {
                "release_date": release,
                "bail_type": bail_type,
                "is_md_reform_case": reformed,
                "pretrial_detention_flag": unpaid,
            }
        )
        .withColumn("detention_length_days", F.datediff("release_date", "booking_date"))
        .drop("_priority")
    )


def fact(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """The full fact table: bookings with the home ZIP and the work days to bail."""
    home = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("inmate_key"),
        (F.col("c_nationkey") + 1).cast("long").alias("home_geo_key"),
    )
    income = geography(spark, sf_dir).select(
        F.col("geo_key").alias("home_geo_key"), "median_daily_income"
    )
    work_days = work_days_to_bail(F.col("bail_set_amount"), F.col("median_daily_income"))
    return (
        bookings(spark, sf_dir, since, until)
        .join(home, "inmate_key")
        .join(income, "home_geo_key")
        .withColumn("work_days_to_bail", work_days)
        .drop("median_daily_income")
    )


def star(spark: SparkSession, sf_dir: str, home: bool = True, since=None, until=None) -> Star:
    """The star schema over the test tables.

    ``home=False`` leaves out the home ZIP and work days for reports that use
    neither: the stored fact has them as columns, here they cost a join.
    """
    make = fact if home else bookings
    return Star(
        make_fact=lambda: make(spark, sf_dir, since, until),
        make_inmate=lambda: inmate(spark, sf_dir),
        make_facility=lambda: facility(spark, sf_dir),
        make_charges=lambda: charge_dimension(spark),
        make_geography=lambda: geography(spark, sf_dir),
    )


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deaths register from the events."""
    event = F.col("event_id")
    return (
        table(spark, sf_dir, "events")
        .select(
            event.alias("death_id"),
            F.concat(F.lit("Facility "), (event % 8).cast("string")).alias("facility_name"),
            jurisdiction(F.col("user_id")).alias("jurisdiction"),
            F.col("ts").cast("date").alias("death_date"),
            pick(event % 5, ["Natural", "Suicide", "Homicide", "Accident", "Unknown"]).alias(
                "manner_of_death"
            ),
            pick(event % 3, ["Pretrial", "Sentenced", "Unknown"]).alias("conviction_status"),
            F.floor(F.col("value")).cast("int").alias("days_detained"),
        )
    )
