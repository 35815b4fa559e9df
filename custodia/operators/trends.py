"""County and state trends and the deaths registers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from custodia import config
from custodia.functions.measures import pct, ratio, rows, where
from custodia.operators.charges import small_table


def target_counties(trends: DataFrame, keep_all: bool = False) -> DataFrame:
    """The nine counties followed, with their label; or every county."""
    if keep_all:
        return trends
    labels = small_table(
        trends.sparkSession,
        [{"county_fips": code, "jurisdiction_label": label} for code, label in config.TARGET_COUNTIES],
        pa.schema([("county_fips", pa.string()), ("jurisdiction_label", pa.string())]),
    )
    return trends.join(F.broadcast(labels), "county_fips")


def latest_year_summary(trends: DataFrame) -> DataFrame:
    """Populations, pretrial share and crowding in the latest year of the data."""
    latest = trends.agg(F.max("year").alias("year"))
    total, capacity = F.col("total_jail_pop"), F.col("jail_rated_capacity")
    return target_counties(trends.join(F.broadcast(latest), "year")).select(
        "jurisdiction_label",
        "year",
        total,
        "total_pretrial_custody",
        "black_jail_pop",
        where(total > 0, pct(F.col("total_pretrial_custody"), total)).alias("pretrial_pct"),
        where(capacity > 0, pct(total, capacity)).alias("capacity_pct"),
    )


def profile(trends: DataFrame) -> DataFrame:
    """Size and span of the county data."""
    return trends.agg(
        rows().alias("rows"),
        F.count_distinct("county_fips").alias("counties"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def yearly_shares(trends: DataFrame, area: str) -> DataFrame:
    """Pretrial and racial shares per area and year, with means around the reform year.

    The means are of the area's yearly pretrial shares before and since 2017.
    """
    groups = ["black_jail_pop", "latinx_jail_pop", "white_jail_pop"]
    present = [name for name in groups if name in trends.columns]
    total = F.sum("total_jail_pop")
    yearly = trends.groupBy(area, "year").agg(
        pct(F.sum("total_pretrial_custody"), total).alias("pretrial_share"),
        *[pct(F.sum(name), total).alias(name.replace("_jail_pop", "_share")) for name in present],
    )
    whole = Window.partitionBy(area)
    tenths = F.rint(F.col("pretrial_share") * 10)

    def mean_where(condition):
        part = where(condition, tenths)
        return ratio(F.sum(part).over(whole), F.count(part).over(whole) * 10, 1)

    before = F.col("year") < config.REFORM_YEAR
    return yearly.withColumns(
        {"mean_before_reform": mean_where(before), "mean_since_reform": mean_where(~before)}
    )


def reconciled_deaths(register: DataFrame, other: DataFrame) -> DataFrame:
    """Deaths per place and year in two registers, and the gap between them."""

    def counted(deaths: DataFrame, name: str) -> DataFrame:
        year = F.year("death_date").cast("long")
        return deaths.groupBy("jurisdiction", year.alias("year")).agg(rows().alias(name))

    both = counted(register, "register_deaths").join(
        counted(other, "other_deaths"), ["jurisdiction", "year"], "full"
    )
    filled = both.fillna(0, ["register_deaths", "other_deaths"])
    return filled.withColumn("gap", F.col("register_deaths") - F.col("other_deaths"))
