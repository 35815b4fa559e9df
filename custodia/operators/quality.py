"""Row constraints, key constraints and run metrics."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, functions as F

from custodia import config
from custodia.functions.grouping import percentile_of_counts
from custodia.functions.measures import from_hundredths, hundredths, mean, pct, rows, share
from custodia.sources.workspace import written

log = logging.getLogger(__name__)


def fact_rules() -> dict[str, Column]:
    """What a fact row must satisfy. As in SQL, a null operand passes a CHECK."""
    released = F.col("release_date") >= F.col("booking_date")
    return {
        "booking_date_missing": F.col("booking_date").isNotNull(),
        "release_before_booking": F.coalesce(released, F.lit(True)),
        "negative_bail": F.coalesce(F.col("bail_set_amount") >= 0, F.lit(True)),
        "unknown_jurisdiction": F.coalesce(
            F.col("jurisdiction").isin(config.JURISDICTIONS), F.lit(True)
        ),
    }


def amendment_rules() -> dict[str, Column]:
    """What a later release must satisfy; the rest of the row was judged when it was loaded."""
    return {"release_before_booking": fact_rules()["release_before_booking"]}


def geography_rules() -> dict[str, Column]:
    return {"bad_zip": F.coalesce(F.col("zip_code").rlike(r"^\d{5}$"), F.lit(False))}


def inmate_rules() -> dict[str, Column]:
    return {
        "bad_age_bucket": F.coalesce(F.col("age_bucket").isin(config.AGE_BUCKETS), F.lit(False))
    }


def facility_rules() -> dict[str, Column]:
    """What a row of facility attributes must satisfy; open figures pass."""
    counts = ["rated_capacity", "deaths_in_custody_ytd", "use_of_force_incidents_ytd", "solitary_population"]
    return {
        "no_facility": F.col("facility_id").isNotNull(),
        "unknown_jurisdiction": F.coalesce(F.col("jurisdiction").isin(config.JURISDICTIONS), F.lit(False)),
        **{f"negative_{n}": F.coalesce(F.col(n) >= 0, F.lit(True)) for n in counts},
    }


def judged(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The first broken rule of each row as ``reason``; null for good rows."""
    reason = F.coalesce(
        *[F.when(~passes, F.lit(name)) for name, passes in rules.items()], F.lit(None)
    )
    return df.withColumn("reason", reason)


def valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return judged(df, rules).filter(F.col("reason").isNull()).drop("reason")


def rejected(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return judged(df, rules).filter(F.col("reason").isNotNull())


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("violations"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(rows().alias("n"))
    return counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))


def orphans(df: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Rows whose key is not in the dimension. The rows are counted per key first."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(rows().alias("n"))
    known = dimension.select(F.col(dimension_key).alias(key))
    lost = counted.join(known, key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def key_report(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per key constraint with the number of rows that break it."""
    named = [df.select(F.lit(name).alias("rule"), "violations") for name, df in checks.items()]
    report = named[0]
    for df in named[1:]:
        report = report.unionByName(df)
    return report


def coverage(enriched: DataFrame) -> DataFrame:
    """Share of rows with a bail gap and with census data, and the median bail gap.

    The median is taken over value counts, not over the rows. They are written once: the totals, the
    counts of buckets and the values inside the middle bucket are all read from them.
    """
    value = hundredths(F.col("work_days_to_bail"))
    counted = enriched.groupBy(value.alias("_value")).agg(
        rows().alias("n"),
        F.count("median_household_income").alias("with_census"),
    )
    counted = written(counted, "coverage")
    known = F.when(F.col("_value").isNotNull(), F.col("n")).otherwise(0)
    totals = counted.agg(
        F.sum("n").alias("rows"),
        F.sum(known).alias("known"),
        F.sum("with_census").alias("with_census"),
    )
    middle = percentile_of_counts(counted, "_value", "n", 0.5, "middle")
    both = totals.unionByName(middle, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns]).select(
        "rows",
        pct(F.col("known"), F.col("rows")).alias("bail_gap_coverage_pct"),
        from_hundredths(F.col("middle"), 1).alias("median_work_days_to_bail"),
        pct(F.col("with_census"), F.col("rows")).alias("census_coverage_pct"),
    )


def warn_low_coverage(metrics: dict) -> list[str]:
    """Warnings for the one row of :func:`coverage` against the fixed thresholds."""
    limits = {
        "bail_gap_coverage_pct": config.COVERAGE_WARNING_PCT["work_days_to_bail"],
        "census_coverage_pct": config.COVERAGE_WARNING_PCT["median_household_income"],
    }
    low = [f"{n} is {metrics[n]}, below {limit}" for n, limit in limits.items()
           if metrics[n] is not None and metrics[n] < limit]
    for message in low:
        log.warning(message)
    return low


def run_summary(enriched: DataFrame) -> DataFrame:
    """Rows, derived pretrial share and reform counts per jurisdiction, in one pass."""
    in_reform_area = F.col("jurisdiction") == config.REFORM_JURISDICTION
    before = in_reform_area & (F.col("booking_date_parsed") < F.lit(config.REFORM_DATE))
    return enriched.groupBy("jurisdiction").agg(
        rows().alias("rows"),
        share(F.col("pretrial_derived")).alias("pct_pretrial_derived"),
        F.count_if(before).alias("pre_reform"),
        F.count_if(F.col("is_md_reform_case")).alias("post_reform"),
        mean(F.col("work_days_to_bail"), 1).alias("avg_work_days_to_bail"),
    )
