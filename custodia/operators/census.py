"""Socio-economic context per ZIP."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from custodia import config
from custodia.functions.clean import count_or_null, zip5
from custodia.functions.measures import pct, ratio

# Columns that differ between bookings, used to spread rows that have no ZIP.
SPREAD_BY = ["inmate_id_hash", "booking_date"]


def typed(raw: DataFrame) -> DataFrame:
    """Figures as numbers; bad text and negative sentinels are null."""
    return raw.select(
        zip5(F.col("zip_code")).alias("zip_code"),
        *[count_or_null(F.col(name)).alias(name) for name in config.CENSUS_VARIABLES.values()],
    )


def with_ratios(figures: DataFrame) -> DataFrame:
    """Daily income and the percentages; a missing parent group counts as none."""
    population = F.col("total_population")
    single = F.coalesce("children_single_mother_hh", F.lit(0.0)) + F.coalesce(
        "children_single_father_hh", F.lit(0.0)
    )
    shares = {
        "poverty_rate_pct": (F.col("people_below_poverty_line"), F.col("poverty_universe_total")),
        "pct_children_single_parent": (single, F.col("children_total")),
        "pct_severely_rent_burdened": (F.col("rent_burdened_50pct_plus"), F.col("renter_universe_total")),
        "pct_bachelors_or_higher": (F.col("bachelors_degree_count"), F.col("education_universe_total")),
        "pct_black": (F.col("black_alone"), population),
        "pct_white": (F.col("white_alone"), population),
        "pct_hispanic": (F.col("hispanic_or_latino"), population),
    }
    return figures.withColumns(
        {
            "median_daily_income": ratio(F.col("median_household_income"), F.lit(365), 2),
            **{name: pct(part, whole, 2) for name, (part, whole) in shares.items()},
        }
    )


def context_by_zip(raw: DataFrame) -> DataFrame:
    """One row of outputs per ZIP."""
    return with_ratios(typed(raw)).select(*config.CENSUS_OUTPUTS).dropDuplicates(["zip_code"])


def with_context(bookings: DataFrame, context: DataFrame | None) -> DataFrame:
    """Bookings with the context of their ZIP, where there is one.

    Without ZIPs or census data the bookings come back as they are. Rows without
    a ZIP (a whole source may lack it) match nothing; they get a spread-out join
    value, so that they do not all end up in one task when the join shuffles.
    """
    if context is None or "zip_code" not in bookings.columns:
        return bookings
    varied = [name for name in SPREAD_BY if name in bookings.columns] or bookings.columns
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64(*varied), F.lit(4096)).cast("string"))
    return (
        bookings.withColumn("_zip", F.coalesce("zip_code", spread))
        .join(context.withColumnRenamed("zip_code", "_zip"), "_zip", "left")
        .drop("_zip")
    )
