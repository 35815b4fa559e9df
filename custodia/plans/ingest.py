"""Landed files to enriched, anonymised bookings.

    python -m custodia.plans.ingest --landing DIR --census DIR --out DIR [--since-days N]

The landing folder holds one folder per source, named by its data set id.
"""

from __future__ import annotations

import argparse
import logging
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from custodia import config
from custodia.operators import census, intake, privacy
from custodia.operators.quality import coverage, run_summary, warn_low_coverage
from custodia.sources import landing, sinks

log = logging.getLogger(__name__)


def enriched(
    bookings: DataFrame,
    context: DataFrame | None,
    salt: str,
    batch_id: str | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Everything between the landed rows and the snapshot, as one lazy plan.

    Personal data goes first; nothing before that step may be cached or written.
    """
    rows = privacy.anonymised(intake.with_known_source(bookings), salt)
    rows = intake.with_clean_zip(intake.with_pretrial_from_status(rows))
    rows = census.with_context(rows, context)
    return intake.with_batch(intake.with_reform_tag(intake.with_bail_gap(rows)), batch_id, at)


def unreadable_of(snapshot: str) -> str:
    """Where the records that could not be read lie, beside their snapshot."""
    folder, _, stamp = snapshot.rpartition("enriched_")
    return f"{folder}unreadable_{stamp}"


def write_unreadable(spark: SparkSession, paths: dict[str, str], sources, salt: str, place: str, whole_files: bool = False) -> None:
    """Source, digest and length of each text that could not be read, and their counts in the log.

    The text may hold personal data, so it is not written. An array that breaks off after its first record
    is not among them: the parser yields what came before.
    """
    found = []
    for source in sources:
        try:
            rows = landing.unreadable(spark, paths[source.name], whole_files)
        except PySparkException as error:
            log.warning("source %s skipped: %s", source.name, error)
            continue
        found.append(rows.select(F.lit(source.name).alias("source_system"), privacy.hashed(F.col("value"), salt).alias("text_hash"), F.length("value").alias("n_chars")))
    landing.combined(found).write.mode("overwrite").parquet(place)
    for r in spark.read.parquet(place).groupBy("source_system").count().collect():  # a row for each source
        log.warning("source %s: %d texts could not be read", r["source_system"], r["count"])


def timeline_of(snapshot: str) -> str:
    """Where the detention timeline lies, beside its snapshot."""
    folder, _, stamp = snapshot.rpartition("enriched_")
    return f"{folder}timeline_{stamp}"


def write_timeline(spark: SparkSession, snapshot: str, place: str) -> None:
    """How long each admission in the daily custody lasted, as far as the discharges say.

    Both come from the written snapshot, where persons are digests; nothing is written unless both
    sources had rows.
    """
    rows = sinks.read_snapshot(spark, snapshot)
    if "release_date" not in rows.columns:
        return
    own = rows.select("inmate_id_hash", "booking_date", "release_date", "source_system")
    held = own.filter(F.col("source_system") == config.CUSTODY_SOURCE).drop("release_date")
    freed = own.filter(F.col("source_system") == config.DISCHARGE_SOURCE)
    if held.isEmpty() or freed.isEmpty():
        return
    made = intake.detention_timeline(held, freed)
    made.select("inmate_id_hash", "booking_day", "release_day", "days_detained").write.mode("overwrite").parquet(place)


def run(
    spark: SparkSession,
    landing_root: str,
    census_path: str | None,
    out: str,
    since: int | None = None,
    as_of: date | None = None,
    sources=None,
    whole_files: bool = False,
) -> str:
    """Read all sources, enrich, write the snapshot and what could not be read; returns the snapshot's path."""
    chosen = landing.active_sources() if sources is None else sources
    paths = {source.name: f"{landing_root}/{source.dataset_id}" for source in chosen}
    bookings = landing.read_all(
        spark, paths, chosen, since=since, as_of=as_of, multi_line=whole_files,
        rename=lambda rows, source: intake.renamed(intake.only_declared(rows, source), source),
    )
    context = census.context_by_zip(landing.read_census(spark, census_path, whole_files)) if census_path else None
    salt = privacy.salt_from_environment()
    snapshot = sinks.write_snapshot(enriched(bookings, context, salt), out)
    write_timeline(spark, snapshot, timeline_of(snapshot))
    write_unreadable(spark, paths, chosen, salt, unreadable_of(snapshot), whole_files)
    return snapshot


def main() -> None:
    parser = argparse.ArgumentParser(description="Landed booking files to enriched Parquet")
    parser.add_argument("--landing", required=True)
    parser.add_argument("--census")
    parser.add_argument("--out", required=True)
    parser.add_argument("--since-days", type=int)
    parser.add_argument("--whole-files", action="store_true", help="files hold one JSON array each")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("custodia-ingest").getOrCreate()
    path = run(spark, args.landing, args.census, args.out, since=args.since_days, whole_files=args.whole_files)
    written = spark.read.parquet(path)
    if "work_days_to_bail" in written.columns:
        metrics = coverage(written).first().asDict()
        print(metrics, *warn_low_coverage(metrics), sep="\n")
        run_summary(written).show(truncate=False)
    print(path)


if __name__ == "__main__":
    main()
