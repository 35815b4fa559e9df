"""How the length of pretrial detention goes with the outcome (Q04-Q06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from custodia import config
from custodia.functions.grouping import roll_up, tiled
from custodia.functions.measures import average, averaged, mean, pct, ratio, rows, share
from custodia.plans import common as c
from custodia.plans.star import Star

QUINTILES = ["Poorest 20%", "Lower-Middle 20%", "Middle 20%", "Upper-Middle 20%", "Wealthiest 20%"]


def _held(star: Star) -> DataFrame:
    return c.booked_since(star.fact, F.lit(config.PLEA_SINCE)).filter(c.held())


def disposition_by_time_held(star: Star) -> DataFrame:
    """Q04: outcomes by length-of-stay bucket, jurisdiction and charge category."""
    cases = _held(star).filter(F.col("case_disposition").isNotNull())
    charged = c.with_charge(cases, star.charges, "charge_category", "is_poverty_linked")
    placed = c.with_home(charged, star.geography, "median_household_income")
    return (
        placed.groupBy(c.time_held().alias("time_in_cage"), "jurisdiction", "charge_category")
        .agg(
            rows().alias("total_cases"),
            F.count_if(c.pled_guilty()).alias("guilty_pleas"),
            share(c.pled_guilty()).alias("guilty_plea_rate"),
            F.count_if(c.exonerated()).alias("exonerated_or_dismissed"),
            share(c.exonerated()).alias("exoneration_rate"),
            mean(c.bail(), 0).alias("avg_bail"),
            mean(c.work_days(), 1).alias("avg_work_days_to_bail"),
            mean(F.col("median_household_income"), 0).alias("avg_neighborhood_income"),
            share(F.col("is_poverty_linked")).alias("pct_poverty_charges"),
        )
        .orderBy("jurisdiction", "time_in_cage", F.col("total_cases").desc())
    )


def innocence_tax(star: Star, at_least: int = 10) -> DataFrame:
    """Q05: days lost by people whose case ended without a conviction."""
    cases = _held(star).filter(c.exonerated() & (c.days() > 0))
    charged = c.with_charge(cases, star.charges, "charge_category", "charge_description")
    keys = ["jurisdiction", "charge_category", "charge_description"]
    lost = roll_up(
        charged,
        keys,
        {
            "wrongly_detained": rows(),
            "person_days": F.sum(c.days().cast("long")),
            **averaged("bail", c.bail()),
        },
        value=c.days(),
        quantiles={"median_days": 0.5},
    ).filter(F.col("wrongly_detained") >= at_least)
    days = F.col("person_days")
    return lost.select(
        *keys,
        "wrongly_detained",
        ratio(days, F.col("wrongly_detained"), 0).alias("avg_days_wrongly_detained"),
        c.whole("median_days").alias("median_days_wrongly_detained"),
        F.col("_largest").cast("long").alias("max_days_wrongly_detained"),
        average("bail", 0).alias("avg_bail_that_kept_them_in"),
        days.alias("total_person_days_lost"),
        ratio(days, F.lit(365), 1).alias("years_of_life_lost"),
    ).orderBy(F.col("avg_days_wrongly_detained").desc_nulls_first())


def poverty_premium(star: Star) -> DataFrame:
    """Q06: outcomes by quintile of home ZIP income within each jurisdiction.

    Everybody of one ZIP has the same income, so a quintile's edge can run
    through a ZIP; those ties are split by a hash-like bucket of the key.
    """
    charged = c.with_charge(_held(star), star.charges, "is_poverty_linked")
    placed = c.with_home(charged, star.geography, "median_household_income")
    measures = {
        "cases": rows(),
        "pleas": F.count_if(c.pled_guilty()),
        "poverty": F.count_if("is_poverty_linked"),
        **averaged("income", F.col("median_household_income")),
        **c.bail_days_work(),
    }
    quintiles = tiled(
        placed,
        partition="jurisdiction",
        order="median_household_income",
        key="detention_key",
        tiles=len(QUINTILES),
        measures=measures,
    )
    label = F.element_at(F.array(*[F.lit(name) for name in QUINTILES]), F.col("tile").cast("int"))
    return quintiles.select(
        F.col("tile").alias("income_quintile"),
        "jurisdiction",
        label.alias("income_group"),
        average("income", 0).alias("avg_income_in_group"),
        "cases",
        average("bail", 0).alias("avg_bail"),
        average("work", 1).alias("avg_work_days_to_bail"),
        average("days", 0).alias("avg_days_detained"),
        pct(F.col("pleas"), F.col("cases")).alias("guilty_plea_rate"),
        pct(F.col("poverty"), F.col("cases")).alias("pct_poverty_charges"),
    ).orderBy("jurisdiction", "income_quintile")
