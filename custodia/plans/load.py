"""Enriched bookings into the star schema.

    python -m custodia.plans.load --snapshot DIR --warehouse DIR [--rebuild]

All tables are only ever added to; a ZIP with new figures gets a new row, and a booking of which a
later batch knows more (a release, payment or disposition) a row in fact_amendment. The two marts
are written anew.
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from custodia import schemas
from custodia.operators import quality, warehouse
from custodia.operators.charges import charge_dimension
from custodia.plans import marts
from custodia.plans.star import Star, stored
from custodia.sources.sinks import read_snapshot

TABLES = ["dim_geography", "dim_inmate", "dim_facility", "fact_detention"]


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table; None where no load has written it."""
    try:
        return spark.read.schema(schemas.STORED[path.rsplit("/", 1)[-1]]).parquet(path)
    except AnalysisException:
        return None


def next_load(spark: SparkSession, root: str) -> int:
    """One more than the largest load number of a stored row, refused ones included."""
    numbers = [0]
    for name in ("dim_geography", "rejected", "facility_update"):
        try:
            rows = spark.read.schema("load_no int").parquet(f"{root}/{name}")
        except AnalysisException:
            continue
        numbers.append(rows.agg(F.max("load_no")).first()[0] or 0)
    return max(numbers) + 1


def _staged(df: DataFrame, path: str) -> DataFrame:
    """Written next to the tables and read back, so that nothing before it runs again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append(df: DataFrame, path: str, rebuild: bool, *partition_by: str) -> None:
    df.write.mode("overwrite" if rebuild else "append").partitionBy(*partition_by).parquet(path)


def refuse(judged: DataFrame, key: str, load_no, root: str, rebuild: bool) -> None:
    """Keys of a dimension that break a rule, with the reason and the number of the load."""
    refused = judged.filter(F.col("reason").isNotNull())
    append(refused.select(F.col(key).alias("value"), "reason", load_no.alias("load_no")), f"{root}/rejected_{key}", rebuild)


def _amend(candidates: DataFrame, root: str, load_no) -> None:
    """Append what the batch adds to stored bookings, and apart from it what breaks a rule."""
    found = quality.judged(warehouse.amended(candidates), quality.amendment_rules())
    found = found.withColumn("load_no", load_no)
    for rows, place in (
        (found.filter("reason is null").drop("reason"), "fact_amendment"),
        (found.filter("reason is not null"), "rejected_amendment"),
    ):
        if not rows.isEmpty():  # reports join amendments only where there are any
            rows.write.mode("append").parquet(f"{root}/{place}")


def _by_date(facts: DataFrame) -> DataFrame:
    """Files that each hold a short span of days, so that a report's date limit skips most of
    them. The key as last range column splits days that hold very many bookings."""
    order = ["jurisdiction", "booking_date", "detention_key"]
    return facts.repartitionByRange(*order).sortWithinPartitions(*order)


def load(spark: SparkSession, bookings: DataFrame, root: str, rebuild: bool = False) -> Star:
    """One batch into the warehouse under ``root`` (W01-W17). Safe to run again.

    ``rebuild`` starts from empty tables (W16). Rows that break a constraint are
    written next to the fact table with the reason (W13).
    """
    path = {name: f"{root}/{name}" for name in TABLES}
    old = {name: None if rebuild else existing(spark, path[name]) for name in TABLES}
    for name in ("fact_amendment", "facility_update"):
        if rebuild and (later := existing(spark, f"{root}/{name}")) is not None:
            later.limit(0).write.mode("overwrite").parquet(f"{root}/{name}")  # keys start anew

    history = old["dim_geography"]
    current = None if history is None else warehouse.current_geography(history)
    load_no = F.lit(1 if rebuild else next_load(spark, root))
    judged = quality.judged(warehouse.upsert_geography(bookings, current), quality.geography_rules())
    judged = _staged(judged, f"{root}/dim_geography_next")
    refuse(judged, "zip_code", load_no, root, rebuild)
    zips = schemas.conformed(judged.filter(F.col("reason").isNull()), schemas.DIM_GEOGRAPHY)
    if history is not None:
        zips = zips.exceptAll(current.select(*zips.columns))
    append(zips.withColumn("load_no", load_no), path["dim_geography"], rebuild)

    # Numbering reads its rows twice (counts, then ranks), so they are written before it.
    people = warehouse.unseen_inmates(bookings, old["dim_inmate"], with_home=True)
    people = _staged(quality.judged(people, quality.inmate_rules()), f"{root}/dim_inmate_next")
    refuse(people, "inmate_id_hash", load_no, root, rebuild)
    people = warehouse.keyed_inmates(people.filter(F.col("reason").isNull()), old["dim_inmate"])
    append(schemas.conformed(people, schemas.DIM_INMATE), path["dim_inmate"], rebuild)
    places = warehouse.new_facilities(bookings, old["dim_facility"])
    append(schemas.conformed(places, schemas.DIM_FACILITY), path["dim_facility"], rebuild)

    loaded = old["fact_detention"]
    if loaded is not None:
        # Only bookings of the batch's own days can have been loaded before.
        first_day = warehouse.projected(bookings).agg(F.min("booking_date")).first()[0]
        known = loaded if first_day is None else loaded.filter(F.col("booking_date") >= first_day)
        known = warehouse.current_facts(known, existing(spark, f"{root}/fact_amendment"))
    else:
        known = None
    rows = warehouse.fact_candidates(
        warehouse.met(bookings, known),
        warehouse.current_geography(existing(spark, path["dim_geography"])),
        existing(spark, path["dim_inmate"]),
        existing(spark, path["dim_facility"]),
        charge_dimension(spark),
    )
    # Written once, then split: the results would otherwise repeat every join above.
    candidates = _staged(quality.judged(rows, quality.fact_rules()), f"{root}/fact_detention_next")
    if loaded is not None:
        _amend(candidates, root, load_no)
    new = warehouse.complete(warehouse.is_new(candidates))
    good = new.filter(F.col("reason").isNull())
    refused = new.filter(F.col("reason").isNotNull()).withColumn("load_no", load_no)
    append(refused, f"{root}/rejected", rebuild)
    facts = schemas.conformed(warehouse.new_facts(good, loaded), schemas.FACT_DETENTION)
    append(_by_date(facts), path["fact_detention"], rebuild, "jurisdiction")
    star = stored(spark, root)
    refresh(star, root)
    return star


def refresh(star: Star, root: str) -> None:
    """Recompute both marts from the stored star schema."""
    marts.bail_gap_by_zip(star).write.mode("overwrite").parquet(f"{root}/mv_bail_gap_by_zip")
    marts.innocence_by_jurisdiction(star).write.mode("overwrite").parquet(
        f"{root}/mv_innocence_by_jurisdiction"
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="Enriched Parquet into the star schema")
    parser.add_argument("--snapshot", required=True)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--rebuild", action="store_true")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("custodia-load").getOrCreate()
    star = load(spark, read_snapshot(spark, args.snapshot), args.warehouse, args.rebuild)
    star.fact.groupBy("jurisdiction").count().show()


if __name__ == "__main__":
    main()
