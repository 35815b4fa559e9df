"""What bail costs in days of work (Q10-Q12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from custodia import config
from custodia.functions.grouping import roll_up
from custodia.functions.measures import average, from_hundredths, hundredths, mean, pct, ratio, where
from custodia.plans import common as c
from custodia.plans.star import Star

_ZIP_CONTEXT = [
    "zip_code", "city", "jurisdiction", "median_household_income", "median_daily_income",
    "poverty_rate_pct", "pct_children_single_parent", "pct_severely_rent_burdened", "pct_black",
    "eviction_rate_per_100",
]
_TENTHS = "_work_tenths"


def by_zip(star: Star, at_least: int = 20) -> DataFrame:
    """Q10: work days to make bail per home ZIP, ranked, with z-score and overlap flag."""
    cases = c.booked_since(star.fact, F.lit(config.BAIL_GAP_SINCE)).filter(c.bail() > 0)
    charged = c.with_charge(cases, star.charges, "is_poverty_linked", "is_addiction_related")
    per_zip = roll_up(
        charged.filter(F.col("home_geo_key").isNotNull()),
        ["home_geo_key"],
        {
            **c.bookings_and_held(),
            **c.bail_days_work(of_days=c.held_days()),
            "poverty": F.count_if("is_poverty_linked"),
            "addiction": F.count_if("is_addiction_related"),
        },
        value=hundredths(c.work_days()),
        quantiles={"median_work": 0.5, "p90_work": 0.9},
    ).filter(F.col("bookings") >= at_least)
    paid_zips = star.geography.filter(F.col("median_daily_income") > 0)

    area = Window.partitionBy("jurisdiction")
    work = F.col("avg_work_days_to_bail")
    tenths = F.col(_TENTHS)
    spread = F.nullif(F.stddev_samp(tenths).over(area), F.lit(0.0))
    burdened = (F.col("poverty_rate_pct") > 25) & (work > 30) & (F.col("eviction_rate_per_100") > 5)
    cases_n = F.col("bookings")
    return (
        c.with_home(per_zip, paid_zips, *_ZIP_CONTEXT)
        .withColumn("avg_work_days_to_bail", average("work", 1))
        .withColumn(_TENTHS, F.round(work * 10).cast("long"))
        .select(
            *_ZIP_CONTEXT,
            average("bail", 0).alias("avg_bail_set"),
            work,
            from_hundredths(F.col("median_work"), 1).alias("median_work_days_to_bail"),
            from_hundredths(F.col("p90_work"), 1).alias("p90_work_days_to_bail"),
            pct(F.col("held"), cases_n).alias("pretrial_detention_rate"),
            pct(F.col("poverty"), cases_n).alias("pct_poverty_charges"),
            pct(F.col("addiction"), cases_n).alias("pct_addiction_charges"),
            average("days", 0).alias("avg_pretrial_days"),
            cases_n.alias("total_bail_cases"),
            F.rank().over(area.orderBy(work.desc_nulls_first())).cast("long").alias("bail_gap_rank"),
            F.round((tenths - F.avg(tenths).over(area)) / spread, 2).alias("bail_gap_z_score"),
            F.coalesce(burdened, F.lit(False)).alias("compounded_disadvantage_zone"),
        )
        .orderBy("jurisdiction", work.desc_nulls_first())
    )


def _days_of_work(amount: float) -> Column:
    """Work days for a fixed bail at the plain average of the ZIPs' daily incomes."""
    daily = F.col("median_daily_income")
    return ratio(F.count(daily), F.sum(hundredths(daily)), 1, factor=amount * 100)


def fixed_bail(mart: DataFrame) -> DataFrame:
    """Q11: what 500, 1,000 and 5,000 of bail mean in each jurisdiction (from M1)."""
    return (
        mart.groupBy("jurisdiction")
        .agg(
            F.count_distinct("zip_code").alias("zip_codes_analyzed"),
            mean(F.col("median_household_income"), 0).alias("jurisdiction_avg_income"),
            mean(F.col("median_daily_income"), 2).alias("jurisdiction_avg_daily_income"),
            _days_of_work(500.0).alias("work_days_for_500_bail"),
            _days_of_work(1000.0).alias("work_days_for_1000_bail"),
            _days_of_work(5000.0).alias("work_days_for_5000_bail"),
        )
        .withColumns(
            {
                "work_days_at_min_wage_for_500": ratio(F.lit(500.0), F.lit(config.MIN_WAGE_PER_DAY), 1),
                "work_days_at_min_wage_for_1000": ratio(F.lit(1000.0), F.lit(config.MIN_WAGE_PER_DAY), 1),
            }
        )
        .orderBy(F.col("jurisdiction_avg_income").asc_nulls_last())
    )


def pipeline_zone() -> Column:
    """Both the eviction rate and the bail gap in their top quarter within the jurisdiction.

    Only ZIPs with a known eviction rate take part; the others are never in the zone.
    """
    area = Window.partitionBy("jurisdiction")
    eviction = F.col("eviction_rate_per_100")
    tenths = where(eviction.isNotNull(), F.round(F.col("avg_work_days_to_bail") * 10))

    def high(value: Column) -> Column:
        return value >= F.percentile(value, F.lit(0.75)).over(area)

    return F.coalesce(high(eviction) & high(tenths), F.lit(False))


def against_eviction(star: Star, mart: DataFrame) -> DataFrame:
    """Q12: ZIPs where both evictions and the bail gap are in the top quarter (from M1)."""
    zips = star.geography.filter(F.col("eviction_rate_per_100").isNotNull()).select(
        "zip_code", "jurisdiction", "eviction_rate_per_100", "median_household_income",
        "pct_severely_rent_burdened",
    )
    gap = mart.select("zip_code", "avg_work_days_to_bail", "pretrial_rate_pct", "total_bookings")
    area = Window.partitionBy("jurisdiction")
    eviction, work = F.col("eviction_rate_per_100"), F.col("avg_work_days_to_bail")
    return (
        zips.join(gap, "zip_code")
        .withColumns(
            {
                "eviction_rank": F.rank().over(area.orderBy(eviction.desc())).cast("long"),
                "bail_gap_rank": F.rank().over(area.orderBy(work.desc_nulls_first())).cast("long"),
                "housing_to_jail_pipeline_zone": pipeline_zone(),
            }
        )
        .orderBy("jurisdiction", eviction.desc())
    )
