"""Bail before and after the 2017 reform (Q13-Q15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from custodia import config
from custodia.functions.grouping import roll_up
from custodia.functions.measures import average, averaged, mean, pct, ratio, rows, share
from custodia.plans import common as c
from custodia.plans.star import Star

def before_and_after(star: Star) -> DataFrame:
    """Q13: the two years on each side of the reform, and the change in the pretrial rate."""
    charged = c.with_charge(c.reform_cohort(star.fact), star.charges, "is_poverty_linked")
    homes = star.geography.select(F.col("geo_key").alias("home_geo_key"))
    cases = charged.join(homes, "home_geo_key").withColumn("reform_period", c.reform_period())
    stats = roll_up(
        cases,
        ["reform_period"],
        {
            "total_bookings": rows(),
            "cash_bail_set": F.count_if(c.cash()),
            "no_cash_required": F.count_if(c.no_cash()),
            "remand_count": F.count_if(c.on_remand()),
            "pretrial_detained": F.count_if(c.held()),
            "poverty": F.count_if("is_poverty_linked"),
            **averaged("days", c.held_days()),
            **averaged("bail", c.positive_bail()),
        },
        value=c.held_days(),
        quantiles={"median_days": 0.5},
    )
    total = F.col("total_bookings")
    # Two rows: the earlier period first, so that the later one looks back at it.
    in_time = Window.orderBy(F.col("reform_period") != "Pre-Reform")
    rate = F.col("pretrial_rate")
    earlier = F.lag(rate).over(in_time)
    return (
        stats.select(
            "reform_period",
            "total_bookings",
            "cash_bail_set",
            pct(F.col("cash_bail_set"), total).alias("pct_cash_bail"),
            "no_cash_required",
            pct(F.col("no_cash_required"), total).alias("pct_no_cash"),
            "remand_count",
            pct(F.col("remand_count"), total).alias("pct_remand"),
            "pretrial_detained",
            pct(F.col("pretrial_detained"), total).alias("pretrial_rate"),
            average("days", 0).alias("avg_pretrial_days"),
            c.whole("median_days").alias("median_pretrial_days"),
            average("bail", 0).alias("avg_bail_amount"),
            pct(F.col("poverty"), total).alias("pct_poverty_charges"),
        )
        .withColumns(
            {
                "comparison_pretrial_rate": earlier,
                "pretrial_rate_change": F.round((rate - earlier) * 10) / 10,
            }
        )
        .orderBy("reform_period")
    )


def monthly(star: Star) -> DataFrame:
    """Q14: month by month through the window. Frames and lags count rows, not months."""
    month = F.trunc("booking_date", "month")
    months = c.reform_cohort(star.fact).groupBy(month.alias("booking_month")).agg(
        rows().alias("bookings"),
        F.count_if(c.cash()).alias("cash_bail"),
        F.count_if(c.no_cash()).alias("no_cash_bail"),
        F.count_if(c.on_remand()).alias("remand"),
        F.count_if(c.held()).alias("pretrial_detained"),
        mean(c.held_days(), 0).alias("avg_pretrial_days"),
    )
    # At most 48 rows from here on.
    in_time = Window.orderBy("booking_month")
    held = F.col("pretrial_detained")
    raw_rate = F.try_divide(held * 100.0, F.col("bookings"))
    rolling = F.avg(raw_rate).over(in_time.rowsBetween(-2, Window.currentRow))
    year_before = F.lag(held, 12).over(in_time)
    running = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reformed = F.col("booking_month") >= F.lit(config.REFORM_DATE)
    return months.select(
        "booking_month",
        "bookings",
        "cash_bail",
        "no_cash_bail",
        "remand",
        held,
        pct(held, F.col("bookings")).alias("pretrial_rate"),
        "avg_pretrial_days",
        F.when(reformed, "Post-Reform").otherwise("Pre-Reform").alias("period"),
        (F.round(F.round(rolling, 6) * 10) / 10).alias("rolling_pretrial_rate"),
        (held - F.lag(held, 1).over(in_time)).alias("pretrial_change_mom"),
        ratio(held - year_before, year_before, 1, factor=100.0).alias("pretrial_change_yoy_pct"),
        F.sum("no_cash_bail").over(running).alias("cumulative_no_cash_bail"),
    ).orderBy("booking_month")


def _income_tier(income: Column) -> Column:
    """A ZIP without a known income counts with the top tier."""
    return (
        F.when(income < 35000, "1: Under $35k")
        .when(income < 55000, "2: $35k-$55k")
        .when(income < 80000, "3: $55k-$80k")
        .otherwise("4: Over $80k")
    )


def by_income_tier(star: Star) -> DataFrame:
    """Q15: pretrial and remand rates per income tier of the home ZIP, before and after."""
    cases = c.with_home(c.reform_cohort(star.fact), star.geography, "median_household_income")
    return (
        cases.groupBy(
            _income_tier(F.col("median_household_income")).alias("income_tier"),
            c.reform_period().alias("period"),
        )
        .agg(
            rows().alias("bookings"),
            share(c.held()).alias("pretrial_rate"),
            share(c.on_remand()).alias("remand_rate"),
            mean(c.held_days(), 0).alias("avg_pretrial_days"),
            mean(c.positive_bail(), 0).alias("avg_bail_set"),
        )
        .orderBy("income_tier", "period")
    )
