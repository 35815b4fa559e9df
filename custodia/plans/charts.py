"""Data feeds of the charts and the dashboard (C01-C17), built from the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from custodia import config
from custodia.functions.clean import as_date, label_by_upper_limit
from custodia.functions.grouping import fold
from custodia.functions.measures import mean, pct, ratio, rows, share
from custodia.plans import addiction, bail_gap, common as c, conditions, innocence, plea, reform
from custodia.plans.star import Star


def innocence_bar(mart: DataFrame) -> DataFrame:
    """Held pretrial against everybody else, one row per bar segment (from M2)."""
    held, total = F.col("legally_innocent"), F.col("total_detained")
    segments = mart.select(
        "jurisdiction", held.alias("Pretrial"), (total - held).alias("Post-conviction")
    )
    return segments.unpivot("jurisdiction", ["Pretrial", "Post-conviction"], "status", "people")


def bail_wall(star: Star, as_of=None) -> DataFrame:
    """Last year's pretrial detainees by the size of their bail."""
    bucket = label_by_upper_limit(
        c.bail(), [(500, "1: $0-$500"), (1000, "2: $500-$1k"), (5000, "3: $1k-$5k")], "4: $5k+"
    )
    held = c.last_months(star.fact, as_of, 12).filter(c.held())
    return (
        held.groupBy(bucket.alias("bail_bucket"))
        .agg(rows().alias("pretrial_detainees"))
        .orderBy("bail_bucket")
    )


def charge_mix(star: Star, as_of=None) -> DataFrame:
    """Pretrial detainees per charge category with their share of the total."""
    by_category = fold(
        innocence.by_charge_category(star, as_of), ["charge_category"], ["total_pretrial"]
    )
    total = F.sum("total_pretrial").over(Window.partitionBy())
    return by_category.withColumn("pct_of_total", pct(F.col("total_pretrial"), total)).orderBy(
        F.col("total_pretrial").desc()
    )


def bail_gap_map(mart: DataFrame) -> DataFrame:
    """The ZIP map's colour, bubble and tooltip values, with the eviction overlap (from M1)."""
    return mart.select(
        "zip_code", "jurisdiction", "median_household_income", "avg_bail_amount",
        "avg_work_days_to_bail", "eviction_rate_per_100", "total_bookings",
        bail_gap.pipeline_zone().alias("pipeline_zone"),
    ).orderBy("zip_code")


def fixed_bail_bars(mart: DataFrame) -> DataFrame:
    """One bar per jurisdiction and bail amount, next to the minimum-wage line (from M1)."""
    amounts = [500, 1000, 5000]
    wide = bail_gap.fixed_bail(mart).select(
        "jurisdiction", *[F.col(f"work_days_for_{a}_bail").alias(str(a)) for a in amounts]
    )
    bars = wide.unpivot("jurisdiction", [str(a) for a in amounts], "bail", "work_days")
    amount = F.col("bail").cast("long")
    return bars.select(
        "jurisdiction",
        amount.alias("bail_amount"),
        "work_days",
        ratio(amount, F.lit(config.MIN_WAGE_PER_DAY), 1).alias("work_days_at_min_wage"),
    ).orderBy("jurisdiction", "bail_amount")


def resolution_flow(star: Star) -> DataFrame:
    """Edges of the flow arrest, bail, payment, time held, outcome.

    The bookings are first added up per combination of labels (a few hundred
    rows); the edges are taken from those.
    """
    group = (
        F.when(c.cash(), "Bail Set - Cash")
        .when(c.no_cash(), "ROR / No Cash")
        .when(c.on_remand(), "Remand")
        .otherwise("Other")
    )
    paid = F.when(F.col("bail_paid"), "Bail Paid - Released").otherwise("Bail Not Paid - Detained")
    held_for = F.when(
        c.days() >= 0,
        label_by_upper_limit(
            c.days(),
            [(7, "0-7 days"), (30, "8-30 days"), (90, "1-3 months"), (365, "3-12 months")],
            "1+ year",
        ),
    ).otherwise("Still held")
    outcome = F.coalesce("case_disposition", F.lit("Open"))
    paths = star.fact.groupBy(
        group.alias("bail"), paid.alias("paid"), held_for.alias("held"), outcome.alias("outcome")
    ).agg(rows().alias("people"))

    def edge(stage: int, source: Column, target: Column) -> Column:
        return F.struct(
            F.lit(stage).cast("long").alias("stage"), source.alias("source"), target.alias("target")
        )

    steps = [F.lit("Arrested"), F.col("bail"), F.col("paid"), F.col("held"), F.col("outcome")]
    edges = F.array(*[edge(i + 1, a, b) for i, (a, b) in enumerate(zip(steps, steps[1:]))])
    listed = paths.select(F.inline(edges), "people")
    return fold(listed, ["stage", "source", "target"], ["people"]).orderBy("stage", "source", "target")


def plea_curve(star: Star) -> DataFrame:
    """Guilty-plea rate by time held, per jurisdiction and for all of them together."""
    cases = plea.disposition_by_time_held(star)
    bucket, area = F.col("time_in_cage"), F.col("jurisdiction")
    return (
        cases.groupingSets([[bucket, area], [bucket]], bucket, area)
        .agg(
            F.sum("total_cases").alias("total_cases"),
            F.sum("guilty_pleas").alias("guilty_pleas"),
            F.grouping_id().alias("_combined"),
        )
        .select(
            "time_in_cage",
            F.when(F.col("_combined") > 0, "ALL").otherwise(area).alias("jurisdiction"),
            "total_cases",
            "guilty_pleas",
            pct(F.col("guilty_pleas"), F.col("total_cases")).alias("guilty_plea_rate"),
        )
        .orderBy("jurisdiction", "time_in_cage")
    )


def addiction_by_year(star: Star) -> DataFrame:
    """Addiction-related bookings per year since 2018."""
    recent = c.booked_since(star.fact, F.lit(config.PLEA_SINCE))
    return (
        addiction.addiction_bookings(star, recent)
        .groupBy(F.year("booking_date").cast("long").alias("year"))
        .agg(rows().alias("addiction_bookings"))
        .orderBy("year")
    )


def repeat_bookings(star: Star) -> DataFrame:
    """People with two, three, four and five or more addiction bookings."""
    people = (
        addiction.addiction_bookings(star, star.fact)
        .groupBy("inmate_key", "jurisdiction")
        .agg(rows().alias("times"))
        .filter(F.col("times") >= 2)
    )
    label = F.when(F.col("times") >= 5, "5+").otherwise(F.col("times").cast("string"))
    return (
        people.groupBy("jurisdiction", label.alias("bookings"))
        .agg(rows().alias("people"))
        .orderBy("jurisdiction", "bookings")
    )


def possession_by_income(star: Star, as_of=None) -> DataFrame:
    """Addiction arrests per 1,000 residents against ZIP income."""
    zips = star.geography.select("zip_code", "total_population")
    return (
        addiction.by_zip(star, as_of)
        .join(zips, "zip_code")
        .select(
            "zip_code", "jurisdiction", "median_household_income", "addiction_arrests",
            ratio(F.col("addiction_arrests"), F.col("total_population"), 2, factor=1000.0).alias(
                "arrests_per_1000"
            ),
            pct(F.col("pretrial_detained"), F.col("addiction_arrests")).alias("pct_pretrial"),
        )
        .orderBy("zip_code")
    )


def crowding_timeline(star: Star, as_of=None) -> DataFrame:
    """C11: the last 90 days of the crowding trend (its frames still see 180 days)."""
    return (
        conditions.crowding_trend(star, as_of)
        .filter(F.col("census_date") >= F.date_sub(as_date(as_of), 90))
        .select("facility_name", "jurisdiction", "census_date", "population_estimate", "capacity_pct")
    )


def deaths_timeline(deaths: DataFrame, pretrial_only: bool = True) -> DataFrame:
    """One dot per death; by default only of people not convicted."""
    shown = deaths.filter(F.col("conviction_status") == "Pretrial") if pretrial_only else deaths
    return shown.select(
        "death_id", "death_date", "jurisdiction", "manner_of_death", "conviction_status",
        "days_detained",
    )


def force_against_crowding(star: Star) -> DataFrame:
    """Use of force per 100 detainees against crowding."""
    force = ratio(
        F.col("use_of_force_incidents_ytd"), F.col("current_population"), 2, factor=100.0
    )
    return conditions.snapshot(star).select(
        "facility_name", "jurisdiction", "capacity_pct", "current_population",
        force.alias("force_per_100_detainees"),
    )


def reform_cards(star: Star) -> DataFrame:
    """C14: three figures before and after the reform."""
    figures = {
        "pct_cash_bail": "Cash Bail Rate",
        "pct_remand": "Remand Rate",
        "avg_pretrial_days": "Avg Pretrial Days",
    }
    rows = reform.before_and_after(star).select(
        "reform_period", *[F.col(name).alias(title) for name, title in figures.items()]
    ).unpivot("reform_period", list(figures.values()), "figure", "value")
    return (
        rows.groupBy("figure")
        .pivot("reform_period", ["Pre-Reform", "Post-Reform"])
        .agg(F.first("value"))
        .select(
            "figure",
            F.col("`Pre-Reform`").alias("pre_reform"),
            F.col("`Post-Reform`").alias("post_reform"),
        )
        .orderBy("figure")
    )


def reform_by_income(star: Star) -> DataFrame:
    """Pretrial rate per income tier before and after the reform."""
    return (
        reform.by_income_tier(star)
        .groupBy("income_tier")
        .pivot("period", ["Pre-Reform", "Post-Reform"])
        .agg(F.first("pretrial_rate"))
        .select(
            "income_tier",
            F.col("`Pre-Reform`").alias("pre_reform_rate"),
            F.col("`Post-Reform`").alias("post_reform_rate"),
        )
        .orderBy("income_tier")
    )


def reform_monthly_rates(star: Star) -> DataFrame:
    """Pretrial, cash-bail and remand rates month by month."""
    return reform.monthly(star).select(
        "booking_month",
        "period",
        "pretrial_rate",
        pct(F.col("cash_bail"), F.col("bookings")).alias("cash_bail_rate"),
        pct(F.col("remand"), F.col("bookings")).alias("remand_rate"),
    )


def dashboard_row(
    star: Star,
    jurisdiction: str | None = None,
    year: int | None = None,
    charge_category: str | None = None,
) -> DataFrame:
    """C17: the four head figures under the dashboard's filters (None means all)."""
    shown = star.fact
    if jurisdiction is not None:
        shown = shown.filter(F.col("jurisdiction") == jurisdiction)
    if year is not None:
        first = F.make_date(F.lit(year), F.lit(1), F.lit(1))
        shown = shown.filter(
            (F.col("booking_date") >= first) & (F.col("booking_date") < F.add_months(first, 12))
        )
    if charge_category is not None:
        shown = c.with_charge(
            shown, star.charges.filter(F.col("charge_category") == charge_category)
        )
    return shown.agg(
        rows().alias("bookings"),
        share(c.held()).alias("pct_legally_innocent"),
        mean(c.held_days(), 0).alias("avg_days_pretrial"),
        F.count_if(c.held() & (c.bail() > 0) & (c.bail() <= 1000)).alias("held_under_1000"),
        mean(c.work_days(), 1).alias("avg_work_days"),
    )
