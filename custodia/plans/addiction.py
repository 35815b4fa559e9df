"""Bookings on addiction-related charges (Q07-Q09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from custodia.functions.grouping import roll_up
from custodia.functions.measures import average, averaged, mean, pct, rows, where
from custodia.plans import common as c
from custodia.plans.star import Star


def addiction_bookings(star: Star, fact: DataFrame, *columns: str) -> DataFrame:
    related = star.charges.filter("is_addiction_related")
    return c.with_charge(fact, related, *columns)


def scale_by_charge(star: Star, as_of=None, at_least: int = 20) -> DataFrame:
    """Q07: volume, bail and length of stay per addiction charge over three years."""
    keys = ["jurisdiction", "charge_description", "charge_class"]
    cases = addiction_bookings(star, c.last_months(star.fact, as_of, 36), *keys[1:])
    placed = c.with_home(cases, star.geography, "median_household_income")
    volume = roll_up(
        placed,
        keys,
        {
            **c.bookings_and_held(),
            **c.bail_days_work(of_bail=c.positive_bail()),
            **averaged("income", F.col("median_household_income")),
        },
        value=c.days(),
        quantiles={"median_days": 0.5, "p90_days": 0.9},
    ).filter(F.col("bookings") >= at_least)
    by_volume = Window.partitionBy("jurisdiction").orderBy(F.col("bookings").desc())
    return volume.select(
        *keys,
        F.col("bookings").alias("people_locked_up"),
        F.col("held").alias("held_pretrial"),
        pct(F.col("held"), F.col("bookings")).alias("pct_held_pretrial"),
        average("bail", 0).alias("avg_bail_set"),
        average("days", 0).alias("avg_days_detained"),
        c.whole("median_days").alias("median_days_detained"),
        c.whole("p90_days").alias("p90_days_detained"),
        average("work", 1).alias("avg_work_days_to_bail"),
        average("income", 0).alias("avg_neighborhood_income"),
        F.rank().over(by_volume).cast("long").alias("volume_rank"),
    ).orderBy("jurisdiction", F.col("people_locked_up").desc())


def by_zip(star: Star, as_of=None, at_least: int = 10) -> DataFrame:
    """Q08: the same cohort per home ZIP, ranked, with the income's z-score."""
    cases = addiction_bookings(star, c.last_months(star.fact, as_of, 36))
    per_zip = (
        cases.groupBy("home_geo_key")
        .agg(
            rows().alias("addiction_arrests"),
            F.count_if(c.held()).alias("pretrial_detained"),
            mean(c.positive_bail(), 0).alias("avg_bail"),
            mean(c.work_days(), 1).alias("avg_work_days_to_bail"),
            mean(c.days(), 0).alias("avg_days_detained"),
        )
        .filter(F.col("addiction_arrests") >= at_least)
    )
    area = Window.partitionBy("jurisdiction")
    by_arrests = area.orderBy(F.col("addiction_arrests").desc())
    income = F.col("median_household_income")
    spread = F.nullif(F.stddev_samp(income).over(area), F.lit(0.0))
    return (
        c.with_home(per_zip, star.geography, *c.ZIP_COLUMNS)
        .drop("home_geo_key")
        .withColumns(
            {
                "addiction_arrest_rank": F.rank().over(by_arrests).cast("long"),
                "income_z_score": F.round((income - F.avg(income).over(area)) / spread, 2),
            }
        )
        .orderBy("jurisdiction", F.col("addiction_arrests").desc())
    )


def repeat_cycle(star: Star, at_least: int = 5) -> DataFrame:
    """Q09: how often the same people come back, by demographic group.

    Bookings are added up per person first; the person dimension then joins at
    most one row per person and jurisdiction, whatever the number of bookings.
    """
    person = ["inmate_key", "jurisdiction"]
    appearances = addiction_bookings(star, star.fact).groupBy(*person).agg(
        rows().alias("times"),
        F.datediff(F.max("booking_date"), F.min("booking_date")).alias("cycle_days"),
        F.sum(c.days().cast("long")).alias("lifetime_days"),
    )
    people = star.inmate.select("inmate_key", "age_bucket", "gender", "race_ethnicity")
    again = F.col("times") >= 2
    groups = (
        appearances.join(people, "inmate_key")
        .groupBy("jurisdiction", "age_bucket", "gender", "race_ethnicity")
        .agg(
            F.count_if(again).alias("people_in_cycle"),
            F.count_if(F.col("times") >= 4).alias("people_deep_in_cycle"),
            mean(F.col("times"), 1).alias("avg_bookings_per_person"),
            mean(where(again, F.col("lifetime_days")), 0).alias("avg_lifetime_days_detained"),
            mean(where(again, F.col("cycle_days")), 0).alias("avg_days_in_cycle"),
            F.avg("times").alias("_severity"),
            rows().alias("_people"),
        )
        .filter(F.col("_people") >= at_least)
    )
    # One row per demographic group is left, so a single ordered window is fine.
    severity = F.rank().over(Window.orderBy(F.col("_severity").desc()))
    return (
        groups.withColumn("cycle_severity_rank", severity.cast("long"))
        .drop("_severity", "_people")
        .orderBy("jurisdiction", F.col("people_in_cycle").desc())
    )
