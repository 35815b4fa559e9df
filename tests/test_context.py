"""Evictions, facilities and deaths that come after the bookings, and the reports on them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from custodia import config
from custodia.fixtures import registry_etl as etl
from custodia.operators import warehouse
from custodia.plans import bail_gap, conditions, context, ingest, marts
from custodia.plans.load import load
from custodia.plans.star import stored, stored_mart

SF = "/root/testdata/sf0.001"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def files(spark, root, folder):
    """An eviction, a facility and a deaths file on what the warehouse holds, with odd rows."""
    star = stored(spark, root)
    zips = sorted(r.zip_code for r in star.geography.select("zip_code").collect())
    used = star.fact.filter("release_date is null").groupBy("facility_key").count().orderBy(F.desc("count"), "facility_key").first()
    first = star.facility.filter(F.col("facility_key") == used.facility_key).first()
    evictions = write(
        folder / "evictions.csv", "zip,eviction_rate,eviction_filing_rate", *[f"{z},{k + 1}.5,{k + 2}" for k, z in enumerate(zips[1:])],
        "99999,7,7", f"{zips[1]},0.5,1", ",1,1", f"{zips[2]},,",
    )
    facilities = write(
        folder / "facilities.csv",
        "facility_id,facility_name,jurisdiction,zip,rated_capacity,solitary_population,federal_oversight,oversight_reason,conditions_last_updated",
        f"{first.facility_id},{first.facility_name},{first.jurisdiction},{zips[0]},10,4,true,consent decree,2021-06-01",
        ",Annex,NYC,,200,,,,", ",Annex,NYC,,150,,,,", ",Nowhere,XX,,1,,,,", ",Odd,LA,,-5,,,,", ",,NYC,,5,,,,",
    )
    name = first.facility_name
    deaths = write(
        folder / "deaths.csv", "facility_name,jurisdiction,death_date,manner_of_death",
        *[f"{name},{first.jurisdiction},{day},natural" for day in ("2021-01-01", "2021-08-02", "2021-08-02", "2020-12-31", "2021-08-03")],
        "Annex,NYC,2020-05-05,suicide", "DC DOC,DC,2021-03-03,natural", "Unlisted,LA,2021-02-02,natural", ",NYC,2021-02-02,natural",
    )
    return zips, first, evictions, facilities, deaths


@pytest.fixture(scope="module")
def informed(spark, tmp_path_factory):
    root, folder = str(tmp_path_factory.mktemp("warehouse")), tmp_path_factory.mktemp("files")
    first, second = etl.stored_batches(spark, SF)
    load(spark, first, root)
    load(spark, second, root)
    before = bail_gap.against_eviction(stored(spark, root), stored_mart(spark, root, "mv_bail_gap_by_zip")).count()
    zips, place, *paths = files(spark, root, folder)
    context.run(spark, root, *paths, as_of="2021-08-02")
    return root, second, zips, place, paths, before


def state(spark, root):
    star = stored(spark, root)
    rows = {n: sorted(map(str, getattr(star, n).collect())) for n in ("geography", "facility")}
    rows["deaths"] = sorted(map(str, spark.read.parquet(f"{root}/stg_deaths_in_custody").collect()))
    tables = ("dim_geography", "dim_facility", "facility_update", "stg_deaths_in_custody")
    return rows | {f"n_{n}": spark.read.parquet(f"{root}/{n}").count() for n in tables}


def test_evictions_fill_stored_zips(spark, informed):
    root, _, zips, _, _, before = informed
    star = stored(spark, root)
    got = {r.zip_code: (r.eviction_rate_per_100, r.eviction_filing_rate) for r in star.geography.collect()}
    expected = {z: (k + 1.5, float(k + 2)) for k, z in enumerate(zips[1:])} | {zips[0]: (None, None)}
    assert got == expected and before == 0
    mart = stored_mart(spark, root, "mv_bail_gap_by_zip")
    report = {r.zip_code: r.eviction_rate_per_100 for r in bail_gap.against_eviction(star, mart).collect()}
    with_gap = {r.zip_code for r in mart.select("zip_code").collect()}
    assert report == {z: expected[z][0] for z in zips[1:] if z in with_gap} and report


def test_facilities_and_deaths_reach_the_reports(spark, informed):
    root, _, zips, place, _, _ = informed
    star = stored(spark, root)
    got = {r.facility_id: r for r in star.facility.collect()}
    known = got[place.facility_id]
    home = star.geography.filter(F.col("zip_code") == zips[0]).first().geo_key
    assert (known.rated_capacity, known.solitary_population, known.federal_oversight, known.geo_key) == (10, 4, True, home)
    assert known.deaths_in_custody_ytd == 3 and known.facility_key == place.facility_key
    annex = got["NYC-Annex"]
    assert (annex.rated_capacity, annex.deaths_in_custody_ytd, annex.federal_oversight) == (200, 0, False)
    assert annex.facility_key == len(got) and "XX-Nowhere" not in got and "LA-Odd" not in got and "LA-Unlisted" not in got
    reasons = {(r.value, r.reason) for r in spark.read.parquet(f"{root}/rejected_facility_id").collect()}
    assert reasons == {("XX-Nowhere", "unknown_jurisdiction"), ("LA-Odd", "negative_rated_capacity"), (None, "no_facility")}
    report = {(r.jurisdiction, r.facility_name): r for r in conditions.snapshot(star).collect()}
    row = report[place.jurisdiction, place.facility_name]
    assert row.capacity_pct == row.current_population * 10 and row.deaths_in_custody_ytd == 3
    assert row.current_population > 0 and got["DC-DEFAULT"].deaths_in_custody_ytd == 1
    assert report["NYC", "Annex"].capacity_pct == 0
    assert [r.solitary_population for r in conditions.solitary(star).collect()] == [4]


def test_files_again_and_later_loads_change_nothing(spark, informed):
    root, second, _, place, paths, _ = informed
    before = state(spark, root)
    context.run(spark, root, *paths, as_of="2021-08-02")
    assert state(spark, root) == before
    rates = dict(stored(spark, root).geography.select("zip_code", "eviction_rate_per_100").collect())
    load(spark, second, root)
    star = stored(spark, root)
    after = dict(star.geography.select("zip_code", "eviction_rate_per_100").collect())
    assert {z: after[z] for z in rates} == rates
    mart = stored_mart(spark, root, "mv_bail_gap_by_zip")
    assert sorted(map(tuple, mart.collect())) == sorted(map(tuple, marts.bail_gap_by_zip(star).collect()))
    context.run(spark, root, deaths=paths[2], as_of="2022-01-31")
    known = {r.facility_id: r for r in stored(spark, root).facility.collect()}[place.facility_id]
    assert known.deaths_in_custody_ytd == 0 and known.rated_capacity == 10
    with pytest.raises(ValueError):
        context.run(spark, root, deaths=paths[2])


def test_each_attribute_has_its_newest_value(spark):
    facilities = spark.createDataFrame([("a", 1, False), ("b", None, False)], "facility_id string, rated_capacity bigint, federal_oversight boolean")
    updates = spark.createDataFrame([("a", 5, None, 1), ("a", None, True, 2), ("a", 7, None, 3), ("c", 9, True, 1)], "facility_id string, rated_capacity bigint, federal_oversight boolean, load_no int")
    assert sorted(map(tuple, warehouse.current_facilities(facilities, updates).collect())) == [("a", 7, True), ("b", None, False)]
    assert sorted(map(tuple, warehouse.current_facilities(facilities, updates.limit(0)).collect())) == [("a", 1, False), ("b", None, False)]


def test_ingest_writes_the_timeline_beside_its_snapshot(spark, tmp_path):
    held, freed = config.CUSTODY_SOURCE, config.DISCHARGE_SOURCE
    rows = [("p", "2020-01-01", None, held), ("p", "2020-01-01", "2020-01-11", freed), ("q", "2020-01-01", None, held), ("r", "2020-01-01", "2020-02-01", freed), ("UNKNOWN", "2020-01-01", None, held), ("UNKNOWN", "2020-01-01", "2020-01-02", freed)]
    df = spark.createDataFrame(rows, "inmate_id_hash string, booking_date string, release_date string, source_system string")
    path = f"{tmp_path}/enriched_1"
    df.write.parquet(path)
    ingest.write_timeline(spark, path, ingest.timeline_of(path))
    got = {r.inmate_id_hash: r.days_detained for r in spark.read.parquet(f"{tmp_path}/timeline_1").collect()}
    assert got == {"p": 10, "q": None, "UNKNOWN": None}
