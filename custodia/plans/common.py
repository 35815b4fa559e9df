"""Pieces the reports share: joins to the dimensions and the cohort filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from custodia import config
from custodia.functions.clean import as_date, label_by_upper_limit
from custodia.functions.measures import averaged, rows, where

ZIP_COLUMNS = [
    "zip_code", "jurisdiction", "city", "median_household_income", "median_daily_income",
    "poverty_rate_pct", "pct_black", "eviction_rate_per_100",
]


def held() -> Column:
    return F.col("pretrial_detention_flag")


def bail() -> Column:
    return F.col("bail_set_amount")


def positive_bail() -> Column:
    return where(bail() > 0, bail())


def days() -> Column:
    return F.col("detention_length_days")


def held_days() -> Column:
    return where(held(), days())


def work_days() -> Column:
    return F.col("work_days_to_bail")


def pled_guilty() -> Column:
    return F.col("case_disposition") == config.GUILTY_PLEA


def exonerated() -> Column:
    return F.col("case_disposition").isin(config.EXONERATING)


def cash() -> Column:
    return F.col("bail_type").isin(config.CASH_BAIL_TYPES)


def no_cash() -> Column:
    return F.col("bail_type").isin(config.NO_CASH_BAIL_TYPES)


def on_remand() -> Column:
    return F.col("bail_type") == config.REMAND


def booked_since(fact: DataFrame, first_day) -> DataFrame:
    return fact.filter(F.col("booking_date") >= first_day)


def last_months(fact: DataFrame, as_of, months: int) -> DataFrame:
    return booked_since(fact, F.add_months(as_date(as_of), -months))


def with_charge(fact: DataFrame, charges: DataFrame, *columns: str) -> DataFrame:
    """Inner join to the charge taxonomy, a literal table of fixed size."""
    side = charges.select(F.col("charge_key").alias("primary_charge_key"), *columns)
    return fact.join(F.broadcast(side), "primary_charge_key")


def with_home(fact: DataFrame, geography: DataFrame, *columns: str) -> DataFrame:
    """Inner join to the home ZIP. No hint: the planner checks the dimension's size."""
    side = geography.select(F.col("geo_key").alias("home_geo_key"), *columns)
    return fact.join(side, "home_geo_key")


def bookings_and_held() -> dict[str, Column]:
    return {"bookings": rows(), "held": F.count_if(held())}


def bail_days_work(
    of_bail: Column | None = None, of_days: Column | None = None
) -> dict[str, Column]:
    return {
        **averaged("bail", bail() if of_bail is None else of_bail),
        **averaged("days", days() if of_days is None else of_days),
        **averaged("work", work_days()),
    }


def time_held() -> Column:
    """Seven-way label of the length of stay; unknown while the person is still held."""
    label = label_by_upper_limit(
        days(),
        [
            (7, "01: 0-7 days"),
            (30, "02: 8-30 days"),
            (90, "03: 1-3 months"),
            (180, "04: 3-6 months"),
            (365, "05: 6-12 months"),
        ],
        "06: Over a year",
    )
    return F.when(days() >= 0, label).otherwise("Unknown")


def whole(percentile: str) -> Column:
    """A percentile of whole numbers, rounded half up."""
    return F.round(F.round(percentile, 4))


def reform_period() -> Column:
    before = F.col("booking_date") < F.lit(config.REFORM_DATE)
    return F.when(before, "Pre-Reform").otherwise("Post-Reform")


def reform_cohort(fact: DataFrame) -> DataFrame:
    first, last = config.REFORM_WINDOW
    return fact.filter(
        (F.col("jurisdiction") == config.REFORM_JURISDICTION)
        & F.col("booking_date").between(F.lit(first), F.lit(last))
    )
