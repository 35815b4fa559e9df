"""The warehouse load, and the reports on what it stores."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from custodia.fixtures import registry_etl as etl
from custodia.operators import quality, warehouse
from custodia.plans import addiction, bail_gap, conditions, innocence, marts, plea, reform
from custodia.plans.load import load
from custodia.plans.star import stored, stored_mart
from custodia.sources.workspace import small_methods

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    first, second = etl.stored_batches(spark, SF)
    load(spark, first, root)
    load(spark, second, root)
    return root, second


def keys(spark, root):
    star = stored(spark, root)
    return {
        "geo": sorted(map(tuple, star.geography.select("zip_code", "geo_key").collect())),
        "people": sorted(map(tuple, star.inmate.select("inmate_id_hash", "inmate_key").collect())),
        "places": sorted(map(tuple, star.facility.select("facility_id", "facility_key").collect())),
        "facts": sorted(map(tuple, star.fact.select("event_id", "detention_key").collect())),
    }


def test_loading_again_changes_nothing(spark, loaded):
    root, second = loaded
    before = keys(spark, root)
    load(spark, second, root)
    assert keys(spark, root) == before
    for rows in before.values():
        numbers = [n for _, n in rows]
        assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_stored_files_hold_short_spans_of_days(spark, loaded):
    fact = stored(spark, loaded[0]).fact
    spans = fact.groupBy(F.input_file_name().alias("file")).agg(
        F.min("booking_date").alias("first"), F.max("booking_date").alias("last"), F.first("jurisdiction").alias("place")
    ).collect()
    by_place = {}
    for span in spans:
        by_place.setdefault(span.place, []).append((span.first, span.last))
    # Within one load and place the spans follow each other; two loads were made here.
    for place, ordered in by_place.items():
        overlaps = sum(a[1] > b[0] for a, b in zip(sorted(ordered), sorted(ordered)[1:]))
        assert overlaps <= 1, place


def test_new_figures_replace_old_ones_under_the_same_key(spark, tmp_path):
    first, second = etl.stored_batches(spark, SF)
    load(spark, first, str(tmp_path))
    known = dict(keys(spark, str(tmp_path))["geo"])
    later = first.withColumn("median_household_income", F.lit(1.0)).withColumn("pct_black", F.lit(2.0))
    load(spark, later, str(tmp_path))
    load(spark, second, str(tmp_path))
    star = stored(spark, str(tmp_path))
    assert known.items() <= dict(keys(spark, str(tmp_path))["geo"]).items()
    seen_again = {r.zip_code for r in second.select("zip_code").distinct().collect()}
    for row in star.geography.filter(F.col("zip_code").isin(list(known))).collect():
        assert row.pct_black != 2.0
        assert row.zip_code in seen_again or row.median_household_income == 1.0
    assert star.geography.count() == star.geography.select("zip_code").distinct().count()


def test_marts_add_up_to_the_facts(spark, loaded):
    root, _ = loaded
    star = stored(spark, root)
    mart = spark.read.parquet(f"{root}/mv_bail_gap_by_zip")
    placed = star.fact.filter(F.col("home_geo_key").isNotNull()).count()
    assert mart.agg(F.sum("total_bookings")).first()[0] == placed
    assert spark.read.parquet(f"{root}/rejected").filter(F.col("reason").isNull()).count() == 0


def test_every_report_runs_on_the_stored_tables(spark, loaded):
    star = stored(spark, loaded[0])
    mart = stored_mart(spark, loaded[0], "mv_bail_gap_by_zip")
    as_of = "2021-08-02"
    reports = [
        innocence.by_jurisdiction(star, as_of), innocence.by_charge_category(star, as_of),
        innocence.by_age(star, as_of), plea.disposition_by_time_held(star), plea.innocence_tax(star),
        plea.poverty_premium(star), addiction.scale_by_charge(star, as_of),
        addiction.by_zip(star, as_of), addiction.repeat_cycle(star), bail_gap.by_zip(star),
        bail_gap.fixed_bail(mart), bail_gap.against_eviction(star, mart),
        reform.before_and_after(star), reform.monthly(star), reform.by_income_tier(star),
        conditions.snapshot(star), conditions.in_custody(star),
        conditions.crowding_trend(star, as_of), conditions.solitary(star),
        marts.innocence_by_jurisdiction(star),
    ]
    for report in reports:
        shares = [n for n in report.columns if n.startswith("pct_") or n.endswith("_rate")]
        for row in report.collect():
            assert all(0 <= row[n] <= 100 for n in shares if row[n] is not None)


def test_unknown_people_are_kept_apart(spark):
    schema = (
        "inmate_id_hash string, booking_date string, source_system string, jurisdiction string,"
        " charge_code_raw string, work_days_to_bail double"
    )
    df = spark.createDataFrame(
        [
            ("UNKNOWN", "2020-01-01", "s", "NYC", "155", 1.0),
            ("UNKNOWN", "2020-01-01", "s", "NYC", "220.03", 1.0),
            ("UNKNOWN", "2020-01-01", "s", "NYC", "155", 1.0),
            ("p", "2020-01-01", "s", "NYC", "155", 1.0),
            ("p", "2020-01-01", "s", "NYC", "220.03", 1.0),
        ],
        schema,
    )
    events = warehouse.one_row_per_event(warehouse.projected(df)).collect()
    assert sorted((e.inmate_id_hash, e.charge_code_raw) for e in events) == [
        ("UNKNOWN", "155"), ("UNKNOWN", "220.03"), ("p", "155"), ("p", "220.03"),
    ]


def test_of_repeats_the_released_one_is_kept(spark):
    kind = "inmate_id_hash string, booking_date string, release_date string, source_system string, jurisdiction string"
    rows = [("p", "2020-01-01", None, "s", "NYC"), ("p", "2020-01-01", "2020-02-01", "s", "NYC")]
    (event,) = warehouse.one_row_per_event(warehouse.projected(spark.createDataFrame(rows, kind))).collect()
    assert str(event.release_date) == "2020-02-01"


def test_rejects_of_earlier_loads_stay_and_a_load_may_have_no_valid_row(spark, tmp_path):
    first, second = etl.stored_batches(spark, SF)
    bad = first.filter("inmate_id_hash <> 'UNKNOWN'").limit(20).withColumn("booking_date", F.lit("unreadable"))
    bad = bad.withColumn("booking_date_parsed", F.lit(None).cast("date"))
    star = load(spark, bad, str(tmp_path))
    assert star.fact.count() == 0
    n = spark.read.parquet(f"{tmp_path}/rejected").count()
    load(spark, second, str(tmp_path))
    kept = spark.read.parquet(f"{tmp_path}/rejected").groupBy("load_no").count().collect()
    assert n > 0 and {r.load_no: r["count"] for r in kept}[1] == n


def later_known(spark, root):
    """What may become known later of each booking of a person with an identifier."""
    star = stored(spark, root)
    people = star.inmate.filter("inmate_id_hash <> 'UNKNOWN'").select("inmate_key")
    names = ["event_id", "release_date", "detention_length_days", "bail_paid", "pretrial_detention_flag", "case_disposition"]
    return {r.event_id: tuple(r)[1:] for r in star.fact.join(people, "inmate_key").select(*names).collect()}


def test_a_later_load_completes_stored_bookings(spark, tmp_path):
    _, whole = etl.stored_batches(spark, SF)
    late = {n: F.lit(None).cast(whole.schema[n].dataType) for n in ("release_date", "discharge_date", "bail_paid", "case_disposition") if n in whole.columns}
    assert late
    early, at_once, in_steps = whole.withColumns(late), str(tmp_path / "a"), str(tmp_path / "b")
    load(spark, whole, at_once)
    load(spark, early, in_steps)
    before = later_known(spark, in_steps)
    numbers = dict(keys(spark, in_steps)["facts"])
    load(spark, whole, in_steps)
    expected, got = later_known(spark, at_once), later_known(spark, in_steps)
    # A release before the booking refuses a new booking, but only itself where the booking is stored.
    refused = spark.read.parquet(f"{at_once}/rejected").filter("reason = 'release_before_booking'")
    kept = {r.event_id for r in refused.select("event_id").collect()} & set(got)
    assert before != got == expected | {k: before[k] for k in kept} and kept
    assert spark.read.parquet(f"{in_steps}/rejected_amendment").count() >= len(kept)
    assert numbers.items() <= dict(keys(spark, in_steps)["facts"]).items()
    n = spark.read.parquet(f"{in_steps}/fact_amendment").count()
    load(spark, early, in_steps)  # knows less: nothing is taken back
    load(spark, whole, in_steps)
    assert n == spark.read.parquet(f"{in_steps}/fact_amendment").count() and later_known(spark, in_steps) == got
    load(spark, early, in_steps, rebuild=True)
    assert before == later_known(spark, in_steps)


def test_amendments_fill_only_what_is_missing(spark):
    kind = "inmate_id_hash string, booking_date string, release_date string, bail_paid string, case_disposition string, source_system string, jurisdiction string"
    rows = [("p", "2020-01-01", "2020-02-01", "true", None, "s", "NYC"), ("q", "2020-01-01", "2020-03-01", None, "Dismissed", "s", "NYC"), ("r", "2020-01-01", "2019-01-01", None, None, "s", "NYC"), ("n", "2020-01-01", None, None, None, "s", "NYC")]
    batch = spark.createDataFrame(rows, kind)
    events = warehouse.one_row_per_event(warehouse.projected(batch)).withColumn("detention_key", F.when(F.col("inmate_id_hash") == "p", 1).when(F.col("inmate_id_hash") == "q", 2).when(F.col("inmate_id_hash") == "r", 3).otherwise(4).cast("long"))
    known = F.col("detention_key") == 2
    facts = events.withColumns({
        "release_date": F.when(known, F.lit("2020-02-15").cast("date")), "bail_paid": F.when(known, False), "case_disposition": F.lit(None).cast("string"),
        "detention_length_days": F.lit(None).cast("int"), "pretrial_detention_flag": F.lit(True),
    })
    made = warehouse.amendments(batch, facts)
    assert {(r.detention_key, str(r.release_date), r.bail_paid, r.case_disposition) for r in made.collect()} == {(1, "2020-02-01", True, None), (2, "2020-02-15", False, "Dismissed"), (3, "2019-01-01", None, None)}
    judged = quality.judged(made, quality.amendment_rules())
    assert [(r.detention_key, r.reason) for r in judged.filter("reason is not null").collect()] == [(3, "release_before_booking")]
    good = judged.filter("reason is null").drop("reason").withColumn("load_no", F.lit(2))
    older = good.withColumns({"load_no": F.lit(1), "case_disposition": F.lit("Open")})
    now = {r.detention_key: r for r in warehouse.current_facts(facts, good.unionByName(older)).collect()}
    assert now[1].detention_length_days == 31 and now[2].case_disposition == "Dismissed" and now[2].detention_length_days == 45
    assert now[3].release_date is None and now[4].release_date is None and len(now) == 4


def test_a_load_tells_its_bookings_apart_once(spark, tmp_path, monkeypatch):
    """A batch is reduced to bookings in one pass, which finds both the new and the amended ones."""
    kind = "inmate_id_hash string, booking_date string, release_date string, source_system string, jurisdiction string"
    batches = [
        [("p", "2020-01-01", None, "s", "NYC"), ("q", "2020-01-02", None, "s", "LA"), ("UNKNOWN", "2020-01-02", None, "s", "LA")],
        [("p", "2020-01-01", "2020-02-01", "s", "NYC"), ("q", "2020-01-02", None, "s", "LA"), ("q", "2020-01-02", "2019-01-01", "s", "LA"), ("r", "2020-01-03", None, "s", "DC")],
    ]
    passes = []
    one_row = warehouse.one_row_per_event
    monkeypatch.setattr(warehouse, "one_row_per_event", lambda rows: passes.append(1) or one_row(rows))
    for rows in (*batches, batches[1]):
        star = load(spark, spark.createDataFrame(rows, kind).withColumn("zip_code", F.lit("10001")), str(tmp_path))
    assert len(passes) == 3
    people = {r.inmate_id_hash: r.inmate_key for r in star.inmate.collect()}
    got = {(r.inmate_key, str(r.booking_date), str(r.release_date)) for r in star.fact.collect()}
    assert got == {(people["p"], "2020-01-01", "2020-02-01"), (people["q"], "2020-01-02", "None"), (people["UNKNOWN"], "2020-01-02", "None"), (people["r"], "2020-01-03", "None")}
    assert sorted(r.detention_key for r in star.fact.collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(f"{tmp_path}/fact_amendment").count() == 1
    assert {r.reason for r in spark.read.parquet(f"{tmp_path}/rejected_amendment").collect()} == {"release_before_booking"}


def test_a_wide_write_keeps_the_sessions_method_limit(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    assert spark.conf.get(key, None) is None
    with small_methods(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "9000")
    try:
        with small_methods(spark):
            assert spark.conf.get(key) == "9000"
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.unset(key)


def test_people_have_homes_and_refused_keys_a_reason(spark, tmp_path):
    _, first = etl.stored_batches(spark, SF)
    odd = first.filter("inmate_id_hash <> 'UNKNOWN' and zip_code is not null").limit(5).withColumns({"zip_code": F.lit("ABCDE"), "age_bucket": F.lit("old"), "inmate_id_hash": F.concat(F.lit("odd"), "inmate_id_hash")})
    load(spark, first.unionByName(odd), str(tmp_path))
    people = stored(spark, str(tmp_path)).inmate
    assert people.filter("home_zip_code is not null").count() > 0 and people.filter("inmate_id_hash = 'UNKNOWN' and home_zip_code is not null").count() == 0
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/rejected_zip_code").collect()] == [("ABCDE", "bad_zip", 1)]
    assert {tuple(r)[1:] for r in spark.read.parquet(f"{tmp_path}/rejected_inmate_id_hash").collect()} == {("bad_age_bucket", 1)}


def test_rebuild_starts_from_empty(spark, tmp_path):
    first, _ = etl.stored_batches(spark, SF)
    load(spark, first, str(tmp_path))
    before = keys(spark, str(tmp_path))
    load(spark, first, str(tmp_path), rebuild=True)
    assert keys(spark, str(tmp_path)) == before
