"""Who is held without a conviction (Q01-Q03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from custodia import config
from custodia.functions.grouping import fold, roll_up
from custodia.functions.measures import average, averaged, pct, rows
from custodia.plans import common as c
from custodia.plans.star import Star


def by_jurisdiction(star: Star, as_of=None) -> DataFrame:
    """Q01: the last year's bookings per jurisdiction, and how many are legally innocent.

    A stay's length is known only after release, so the waiting times and the
    two long-stay counts cover people who have been released.
    """
    low_bail = c.held() & (c.bail() > 0)
    totals = roll_up(
        c.last_months(star.fact, as_of, 12),
        ["jurisdiction"],
        {
            "total_detained": rows(),
            "legally_innocent": F.count_if(c.held()),
            "held_under_500": F.count_if(low_bail & (c.bail() <= 500)),
            "held_under_1000": F.count_if(low_bail & (c.bail() <= 1000)),
            "held_on_remand": F.count_if(c.on_remand()),
            "over_6_months_pretrial": F.count_if(c.held_days() > 180),
            "over_1_year_pretrial": F.count_if(c.held_days() > 365),
            **averaged("days", c.held_days()),
        },
        value=c.held_days(),
        quantiles={"median_days": 0.5},
    )
    innocent = F.col("legally_innocent")
    return totals.select(
        "jurisdiction",
        "total_detained",
        "legally_innocent",
        "held_under_500",
        "held_under_1000",
        "held_on_remand",
        average("days", 0).alias("avg_days_waiting"),
        c.whole("median_days").alias("median_days_waiting"),
        "over_6_months_pretrial",
        "over_1_year_pretrial",
        pct(innocent, F.col("total_detained")).alias("pct_legally_innocent"),
        pct(F.col("held_under_500"), innocent).alias("pct_held_under_500"),
        pct(F.col("held_under_1000"), innocent).alias("pct_held_under_1000"),
        pct(F.col("over_6_months_pretrial"), innocent).alias("pct_over_6_months"),
        pct(F.col("over_1_year_pretrial"), innocent).alias("pct_over_1_year"),
    ).orderBy(F.col("pct_legally_innocent").desc_nulls_first())


def _held_last_year(star: Star, as_of) -> DataFrame:
    return c.last_months(star.fact, as_of, 12).filter(c.held())


def by_charge_category(star: Star, as_of=None) -> DataFrame:
    """Q02: the same year's pretrial detainees by charge category and flags."""
    measures = {"total_pretrial": rows(), **c.bail_days_work()}
    per_charge = _held_last_year(star, as_of).groupBy("jurisdiction", "primary_charge_key").agg(
        *[column.alias(name) for name, column in measures.items()]
    )
    keys = [
        "charge_category", "is_violent", "is_poverty_linked", "is_addiction_related", "jurisdiction",
    ]
    by_volume = Window.partitionBy("jurisdiction").orderBy(F.col("total_pretrial").desc())
    charged = c.with_charge(per_charge, star.charges, *keys[:-1])
    return (
        fold(charged, keys, list(measures))
        .select(
            *keys,
            "total_pretrial",
            average("bail", 0).alias("avg_bail_set"),
            average("days", 0).alias("avg_days_detained"),
            average("work", 1).alias("avg_work_days_to_bail"),
            F.rank().over(by_volume).cast("long").alias("pretrial_volume_rank"),
        )
        .orderBy("jurisdiction", F.col("total_pretrial").desc())
    )


def by_age(star: Star, as_of=None) -> DataFrame:
    """Q03: the same cohort by age bucket.

    One person can stand for a large part of the bookings (everybody without an
    identifier shares one marker), so bookings are added up per person before
    they meet the person dimension.
    """
    measures = {
        "pretrial_count": rows(),
        "poverty": F.count_if("is_poverty_linked"),
        "addiction": F.count_if("is_addiction_related"),
        **averaged("bail", c.bail()),
        **averaged("days", c.days()),
    }
    charged = c.with_charge(
        _held_last_year(star, as_of), star.charges, "is_poverty_linked", "is_addiction_related"
    )
    per_person = charged.groupBy("inmate_key", "jurisdiction").agg(
        *[column.alias(name) for name, column in measures.items()]
    )
    people = star.inmate.select("inmate_key", "age_bucket")
    bucket_order = F.array_position(
        F.array(*[F.lit(b) for b in config.AGE_BUCKETS[:-1]]), F.col("age_bucket")
    )
    return (
        fold(per_person.join(people, "inmate_key"), ["age_bucket", "jurisdiction"], list(measures))
        .select(
            "age_bucket",
            "jurisdiction",
            "pretrial_count",
            average("bail", 0).alias("avg_bail"),
            average("days", 0).alias("avg_days_detained"),
            pct(F.col("poverty"), F.col("pretrial_count")).alias("pct_poverty_charges"),
            pct(F.col("addiction"), F.col("pretrial_count")).alias("pct_addiction_charges"),
        )
        .orderBy(
            "jurisdiction",
            F.when(bucket_order > 0, bucket_order).otherwise(len(config.AGE_BUCKETS)),
        )
    )
