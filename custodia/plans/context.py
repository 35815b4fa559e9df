"""Figures on places that come apart from the bookings: evictions, facilities, deaths.

    python -m custodia.plans.context --warehouse DIR [--evictions FILE] [--facilities FILE]
                                     [--deaths FILE --as-of DATE]

The files add to a loaded warehouse: changed ZIPs get a new row in dim_geography, facilities a row
of what is new in facility_update, deaths go to stg_deaths_in_custody. Nothing stored is rewritten
but the marts, and running a file again adds nothing.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from custodia import schemas
from custodia.operators import quality, warehouse
from custodia.plans.load import append, existing, next_load, refresh, refuse
from custodia.plans.star import Star, stored
from custodia.sources import landing


def add_evictions(spark: SparkSession, rates: DataFrame, root: str) -> None:
    """New rows for the stored ZIPs whose eviction figures change."""
    changed = warehouse.changed_evictions(stored(spark, root).geography, rates)
    rows = schemas.conformed(changed, schemas.DIM_GEOGRAPHY)
    append(rows.withColumn("load_no", F.lit(next_load(spark, root))), f"{root}/dim_geography", False)


def add_facilities(spark: SparkSession, attributes: DataFrame, root: str) -> None:
    """Attributes of facilities, known or new; rows that break a rule are kept with the reason."""
    load_no = F.lit(next_load(spark, root))
    known = existing(spark, f"{root}/dim_facility")
    judged = quality.judged(warehouse.identified(attributes, known), quality.facility_rules())
    refuse(judged, "facility_id", load_no, root, False)
    good = judged.filter(F.col("reason").isNull())
    places = warehouse.added_facilities(good, known)
    append(schemas.conformed(places, schemas.DIM_FACILITY), f"{root}/dim_facility", False)
    _update(spark, good, root, load_no)


def add_deaths(spark: SparkSession, deaths: DataFrame, root: str, as_of) -> None:
    """Deaths not staged yet, then the year's deaths of each facility in the register."""
    path = f"{root}/stg_deaths_in_custody"
    rows, known = schemas.conformed(deaths, schemas.DEATHS), existing(spark, path)
    append(rows if known is None else rows.exceptAll(known), path, False)
    counts = warehouse.deaths_to_date(existing(spark, path), existing(spark, f"{root}/dim_facility"), as_of)
    _update(spark, counts, root, F.lit(next_load(spark, root)))


def _update(spark: SparkSession, attributes: DataFrame, root: str, load_no) -> None:
    star = stored(spark, root)
    changed = warehouse.facility_updates(attributes, star.facility, star.geography)
    rows = schemas.conformed(changed, schemas.FACILITY_UPDATE).withColumn("load_no", load_no)
    append(rows, f"{root}/facility_update", False)


def run(
    spark: SparkSession,
    root: str,
    evictions: str | None = None,
    facilities: str | None = None,
    deaths: str | None = None,
    as_of=None,
) -> Star:
    """The given files into the warehouse under ``root``; the marts follow."""
    if deaths and as_of is None:
        raise ValueError("the deaths of a year need the day that it is counted to")
    if evictions:
        add_evictions(spark, landing.read_evictions(spark, evictions), root)
    if facilities:
        add_facilities(spark, landing.read_facilities(spark, facilities), root)
    if deaths:
        add_deaths(spark, landing.read_deaths(spark, deaths), root, as_of)
    star = stored(spark, root)
    refresh(star, root)
    return star


def main() -> None:
    parser = argparse.ArgumentParser(description="Evictions, facilities and deaths into the star schema")
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--evictions")
    parser.add_argument("--facilities")
    parser.add_argument("--deaths")
    parser.add_argument("--as-of")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("custodia-context").getOrCreate()
    star = run(spark, args.warehouse, args.evictions, args.facilities, args.deaths, args.as_of)
    star.facility.select("facility_name", "rated_capacity", "deaths_in_custody_ytd").show()


if __name__ == "__main__":
    main()
