"""Conditions inside the facilities (Q16-Q19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from custodia.functions.clean import as_date
from custodia.functions.grouping import fold
from custodia.functions.measures import average, averaged, pct, ratio, rows
from custodia.plans import common as c
from custodia.plans.star import Star


def still_held() -> Column:
    return F.col("release_date").isNull()


def snapshot(star: Star) -> DataFrame:
    """Q16: population, crowding, length of stay and deaths per facility.

    Bookings are added up per facility before the join, so a facility without
    bookings stays in the result and a large one is a single row by then.
    """
    measures = {
        "open": F.count_if(still_held()),
        "open_pretrial": F.count_if(still_held() & c.held()),
        **averaged("days", c.days()),
    }
    stays = star.fact.groupBy("facility_key").agg(
        *[column.alias(name) for name, column in measures.items()]
    )
    population = F.col("current_population")
    capacity = F.col("capacity_pct")
    status = (
        F.when(capacity > 130, "CRITICAL OVERCROWDING")
        .when(capacity > 110, "Overcrowded")
        .when(capacity > 90, "Near Capacity")
        .otherwise("Within Capacity")
    )
    return (
        star.facility.join(stays, "facility_key", "left")
        .withColumn("current_population", F.coalesce(F.col("open"), F.lit(0)))
        .withColumn("capacity_pct", pct(population, F.col("rated_capacity")))
        .select(
            "facility_name", "jurisdiction", "facility_type", "rated_capacity",
            "federal_oversight", "oversight_reason", "deaths_in_custody_ytd",
            "use_of_force_incidents_ytd", "solitary_population",
            population,
            capacity,
            status.alias("capacity_status"),
            pct(F.col("open_pretrial"), population).alias("pct_pretrial_in_facility"),
            average("days", 0).alias("alos_days"),
            ratio(F.col("deaths_in_custody_ytd"), population, 2, factor=1000.0).alias(
                "deaths_per_1000_detainees"
            ),
        )
        .orderBy(capacity.desc_nulls_last())
    )


def in_custody(star: Star) -> DataFrame:
    """Q17: everybody still held, standing in for the deaths register.

    The requested order is by length of stay, which is null for every open stay:
    any order satisfies it, so no sort is run (it would put all rows in one task).
    The person dimension is as large as the data; a person marker shared by many
    bookings makes a skewed join, which adaptive execution splits.
    """
    open_stays = star.fact.filter(still_held()).select(
        "facility_key", "inmate_key", "primary_charge_key", "pretrial_detention_flag",
        "bail_set_amount", "detention_length_days", "bail_type",
    )
    facilities = star.facility.select("facility_key", "facility_name", "jurisdiction")
    people = star.inmate.select("inmate_key", "age_bucket", "gender", "race_ethnicity")
    charged = c.with_charge(
        open_stays, star.charges,
        "charge_category", "is_violent", "is_poverty_linked", "is_addiction_related",
    )
    status = F.when(c.held(), "Legally Innocent").otherwise("Post-Conviction")
    return (
        charged.join(facilities, "facility_key")
        .join(people, "inmate_key")
        .select(
            "facility_name", "jurisdiction", "age_bucket", "gender", "race_ethnicity",
            "charge_category", "is_violent", "is_poverty_linked", "is_addiction_related",
            "pretrial_detention_flag", "bail_set_amount",
            c.days().alias("days_detained_before_death"),
            "bail_type",
            status.alias("conviction_status_at_death"),
        )
    )


def crowding_trend(star: Star, as_of=None) -> DataFrame:
    """Q18: bookings of each day that lasted past the day, against capacity, 180 days back.

    The frames count listed days, so days without bookings do not widen them.
    """
    recent = star.fact.filter(F.col("booking_date") >= F.date_sub(as_date(as_of), 180))
    past_the_day = still_held() | (F.col("release_date") > F.col("booking_date"))
    daily = recent.groupBy("facility_key", F.col("booking_date").alias("census_date")).agg(
        F.count_if(past_the_day).alias("population_estimate")
    )
    facilities = star.facility.select(
        "facility_key", "facility_name", "jurisdiction", "rated_capacity"
    )
    in_time = Window.partitionBy("facility_key").orderBy("census_date")
    week, month = in_time.rowsBetween(-6, 0), in_time.rowsBetween(-29, 0)
    people, capacity = F.col("population_estimate"), F.col("rated_capacity")
    over = F.when(people > capacity, 1).otherwise(0).cast("long")
    return (
        daily.join(facilities, "facility_key")
        .select(
            "facility_name", "jurisdiction", "rated_capacity", "census_date", people,
            pct(people, capacity).alias("capacity_pct"),
            ratio(F.sum(people).over(week), F.count(people).over(week), 0).alias(
                "rolling_7day_population"
            ),
            F.max(people).over(month).alias("rolling_30day_peak"),
            F.sum(over).over(month).alias("days_overcrowded_last_30"),
        )
        .orderBy("jurisdiction", "facility_name", F.col("census_date").desc())
    )


def solitary(star: Star) -> DataFrame:
    """Q19: facilities that report solitary confinement, with their commonest charge category."""
    measures = {
        "stays": rows(),
        "open": F.count_if(still_held()),
        "open_pretrial": F.count_if(still_held() & c.held()),
        **averaged("days", c.days()),
    }
    per_charge = star.fact.groupBy("facility_key", "primary_charge_key").agg(
        *[column.alias(name) for name, column in measures.items()]
    )
    charged = c.with_charge(per_charge, star.charges, "charge_category")
    per_category = fold(charged, ["facility_key", "charge_category"], list(measures))
    most_first = F.struct((-F.col("stays")).alias("fewest_last"), F.col("charge_category"))
    per_facility = per_category.groupBy("facility_key").agg(
        *[F.sum(name).alias(name) for name in measures],
        F.min(most_first)["charge_category"].alias("most_common_charge_category"),
    )
    reporting = star.facility.filter(F.col("solitary_population").isNotNull()).select(
        "facility_key", "facility_name", "jurisdiction", "solitary_population"
    )
    return (
        reporting.join(per_facility, "facility_key")
        .select(
            "facility_name",
            "jurisdiction",
            "solitary_population",
            pct(F.col("solitary_population"), F.col("open")).alias("pct_population_in_solitary"),
            F.col("open_pretrial").alias("pretrial_in_facility"),
            "most_common_charge_category",
            average("days", 0).alias("avg_alos"),
        )
        .orderBy(F.col("pct_population_in_solitary").desc_nulls_first())
    )


def taxonomy_check(charges: DataFrame) -> DataFrame:
    """Q20: charges per category with their flag counts."""
    return (
        charges.groupBy("charge_category")
        .agg(
            rows().alias("total_charges"),
            F.count_if("is_poverty_linked").alias("poverty_linked"),
            F.count_if("is_addiction_related").alias("addiction_related"),
            F.count_if("is_violent").alias("violent"),
        )
        .orderBy(F.col("total_charges").desc())
    )


def taxonomy_use(star: Star) -> DataFrame:
    """Q20 next to the data: the check's counts plus the bookings of each category."""
    per_charge = star.fact.groupBy("primary_charge_key").agg(rows().alias("n"))
    bookings = fold(
        c.with_charge(per_charge, star.charges, "charge_category"), ["charge_category"], ["n"]
    ).select("charge_category", F.col("n").alias("bookings"))
    return (
        taxonomy_check(star.charges)
        .join(bookings, "charge_category", "left")
        .withColumn("bookings", F.coalesce("bookings", F.lit(0)))
        .orderBy(F.col("total_charges").desc())
    )
