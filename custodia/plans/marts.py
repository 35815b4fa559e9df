"""The two stored aggregates behind the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from custodia.functions.grouping import roll_up
from custodia.functions.measures import average, averaged, from_hundredths, hundredths, pct
from custodia.plans import common as c
from custodia.plans.star import Star


def bail_gap_by_zip(star: Star) -> DataFrame:
    """M1: bookings, bail and work days per home ZIP."""
    per_zip = roll_up(
        star.fact.filter(F.col("home_geo_key").isNotNull()),
        ["home_geo_key"],
        {**c.bookings_and_held(), **c.bail_days_work(of_bail=c.positive_bail())},
        value=hundredths(c.work_days()),
        quantiles={"median_work": 0.5},
    )
    return c.with_home(per_zip, star.geography, *c.ZIP_COLUMNS).select(
        *c.ZIP_COLUMNS,
        F.col("bookings").alias("total_bookings"),
        F.col("held").alias("pretrial_detained"),
        pct(F.col("held"), F.col("bookings"), 2).alias("pretrial_rate_pct"),
        average("bail", 0).alias("avg_bail_amount"),
        average("work", 1).alias("avg_work_days_to_bail"),
        from_hundredths(F.col("median_work"), 1).alias("median_work_days_to_bail"),
        average("days", 0).alias("avg_detention_days"),
    )


def innocence_by_jurisdiction(star: Star) -> DataFrame:
    """M2: pretrial share and waiting time per jurisdiction, over all bookings.

    Unlike Q01 the bail limits here include bail set at zero.
    """
    totals = roll_up(
        star.fact,
        ["jurisdiction"],
        {
            **c.bookings_and_held(),
            "held_under_500_bail": F.count_if(c.held() & (c.bail() <= 500)),
            "held_under_1000_bail": F.count_if(c.held() & (c.bail() <= 1000)),
            **averaged("days", c.held_days()),
        },
        value=c.held_days(),
        quantiles={"median_days": 0.5},
    )
    return totals.select(
        "jurisdiction",
        F.col("bookings").alias("total_detained"),
        F.col("held").alias("legally_innocent"),
        pct(F.col("held"), F.col("bookings")).alias("pct_legally_innocent"),
        "held_under_500_bail",
        "held_under_1000_bail",
        average("days", 0).alias("avg_pretrial_days"),
        c.whole("median_days").alias("median_pretrial_days"),
    )
