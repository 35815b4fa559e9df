"""Sources, privacy, derivations and quality checks on small frames."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from custodia import config
from custodia.operators import census, intake, privacy, quality, trends
from custodia.plans import conditions, ingest
from custodia.operators.charges import charge_dimension
from custodia.sources import landing, sinks, workspace

CUSTODY, DISCHARGES, LA, MD, DC = config.SOURCES


def test_taxonomy_counts(spark):
    got = {r.charge_category: tuple(r)[1:] for r in conditions.taxonomy_check(charge_dimension(spark)).collect()}
    assert got == {
        "Drug": (14, 0, 12, 0), "Poverty-Linked": (14, 14, 0, 0), "Violent": (12, 0, 0, 12),
        "Property": (7, 0, 0, 0), "Other": (7, 0, 0, 0),
    }
    assert charge_dimension(spark).count() == 54


# --- sources ------------------------------------------------------------------
def test_active_sources_leave_out_placeholders():
    assert [s.name for s in landing.active_sources()] == [CUSTODY.name, DISCHARGES.name, DC.name]


def test_array_file_and_feature_file(spark, tmp_path):
    records, pages = tmp_path / "records", tmp_path / "pages"
    records.mkdir(), pages.mkdir()
    (records / "a.json").write_text(json.dumps([{"inmateid": "1", "age": "30", "ssn": "x"}, {"inmateid": "2"}], indent=1))
    page = {"features": [{"attributes": {"inmate_id": "7"}}, {"attributes": {"inmate_id": "8"}}]}
    (pages / "p.json").write_text(json.dumps(page, indent=1))
    got = landing.read_records(spark, str(records), landing.fields_of(CUSTODY), multi_line=True)
    assert "ssn" not in got.columns and [(r.inmateid, r.age) for r in got.orderBy("inmateid").collect()] == [("1", "30"), ("2", None)]
    features = landing.read_features(spark, str(pages), ["inmate_id"], multi_line=True)
    assert sorted(r.inmate_id for r in features.collect()) == ["7", "8"]


def test_array_lines_other_case_and_corrupt_records(spark, tmp_path):
    folder = tmp_path / "r"
    folder.mkdir()
    lines = ['[{"InmateID": 1, "Admitted_DT": "2021-08-01"}, {"inmateid": "2", "admitted_dt": "2021-07-30"}]', '{"inmateid": broken', '{"INMATEID": "3"}', "[]"]
    (folder / "a.json").write_text("\n".join(lines))
    got = landing.read_source(spark, CUSTODY, str(folder)).collect()
    assert sorted((r.inmateid, r.admitted_dt) for r in got) == [("1", "2021-08-01"), ("2", "2021-07-30"), ("3", None)]
    assert [r.value for r in landing.unreadable(spark, str(folder)).collect()] == ['{"inmateid": broken']


def test_since_limit_of_a_feature_source(spark, tmp_path):
    page = {"features": [{"attributes": {"Inmate_ID": "7", "report_date": "2015-01-01"}}, {"attributes": {"inmate_id": "8", "Report_Date": "2021-08-01"}}]}
    (tmp_path / "p.json").write_text(json.dumps(page, indent=1))
    got = landing.read_source(spark, DC, str(tmp_path), since=30, as_of=date(2021, 8, 2), multi_line=True)
    assert [r.inmate_id for r in got.collect()] == ["8"] and "report_date" not in got.columns


def test_csv_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "s.csv").write_text("more,State_Abbr,total_pretrial_custody,year,total_jail_pop\nx,MD,5,2020,10\ny,NY,bad,2021,7\n")
    got = landing.read_state_trends(spark, str(tmp_path)).orderBy("year").collect()
    assert [tuple(r) for r in got] == [(2020, "MD", 10.0, 5.0), (2021, "NY", 7.0, None)]


def test_sources_that_fail_are_skipped_until_none_is_left(spark, tmp_path):
    good = tmp_path / "good"
    good.mkdir()
    (good / "a.json").write_text('{"inmateid": "1", "admitted_dt": "2021-01-01"}\n')
    paths = {CUSTODY.name: str(good), DISCHARGES.name: str(tmp_path / "none")}
    df = landing.read_all(spark, paths, [CUSTODY, DISCHARGES], rename=intake.renamed)
    assert df.count() == 1 and df.first().inmate_id == "1"
    with pytest.raises(RuntimeError):
        landing.read_all(spark, {}, [CUSTODY, DISCHARGES])


def test_since_days_and_full_load(spark):
    df = spark.createDataFrame([("2021-08-01",), ("2021-07-03",), ("2021-07-02",), ("bad",), (None,)], "d string")
    kept = landing.since_days(df, "d", 30, date(2021, 8, 2))
    assert sorted(r.d for r in kept.collect()) == ["2021-07-03", "2021-08-01"]
    assert landing.since_days(df, "d", None).count() == landing.since_days(df, "d", 0).count() == 5


def test_column_names_are_normalised(spark):
    df = spark.createDataFrame([(1, 2)], " Top Charge, `Home-ZIP` int".replace(" Top Charge,", "`Top Charge ` int,"))
    assert landing.normalised(df).columns == ["top_charge", "home_zip"]
    assert landing.normalised(df, keep_hyphens=True).columns == ["top_charge", "home-zip"]


def test_census_response_as_one_file(spark, tmp_path):
    body = [["B01003_001E", config.CENSUS_ZIP_HEADER, "B19013_001E"], ["100", "00601", "-666666666"], ["200", "601", "36500"]]
    (tmp_path / "r.json").write_text(json.dumps(body, indent=1))
    got = landing.read_census(spark, str(tmp_path), whole_files=True)
    rows = {r.total_population: r for r in census.typed(got).collect()}
    assert rows[100.0].median_household_income is None and rows[200.0].zip_code == "00601"
    ratios = census.with_ratios(census.typed(got)).filter("total_population = 200").first()
    assert ratios.median_daily_income == 100.0 and ratios.poverty_rate_pct is None
    assert ratios.pct_children_single_parent is None


def test_county_codes_are_padded_and_files_must_exist(spark, tmp_path):
    (tmp_path / "c.csv").write_text("year,county_fips,county_name,state_abbr,urbanicity,total_jail_pop,total_pretrial_custody,total_sentenced_custody,black_jail_pop,latinx_jail_pop,white_jail_pop,jail_rated_capacity,total_jail_admits,total_jail_discharges\n2020,6037,LA,CA,urban,10,5,1,1,1,1,0,1,1\n2020,99999,No,XX,rural,0,5,1,1,1,1,20,1,1\n")
    counties = landing.read_county_trends(spark, str(tmp_path))
    row = trends.latest_year_summary(counties).first()
    assert (row.jurisdiction_label, row.pretrial_pct, row.capacity_pct) == ("Los Angeles, CA", 50.0, None)
    assert trends.target_counties(counties, keep_all=True).count() == 2
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, str(tmp_path / "missing"))


def test_yearly_shares_of_states_with_means_around_the_reform(spark):
    states = spark.createDataFrame(
        [(2015, "MD", 100.0, 60.0), (2016, "MD", 100.0, 61.0), (2017, "MD", 100.0, 40.0), (2018, "MD", 0.0, 5.0)],
        landing.STATE_SCHEMA,
    )
    got = {r.year: r for r in trends.yearly_shares(states, "state_abbr").collect()}
    assert [got[y].pretrial_share for y in (2015, 2017, 2018)] == [60.0, 40.0, None]
    assert {(r.mean_before_reform, r.mean_since_reform) for r in got.values()} == {(60.5, 40.0)}


def test_evictions_fill_known_zips_only(spark, tmp_path):
    (tmp_path / "e.csv").write_text("zip,eviction_rate,eviction_filing_rate,low_income_renter_pct\n601,2.5,4.0,30\n")
    geography = spark.createDataFrame([("00601", 9.0), ("10001", 9.0)], "zip_code string, eviction_rate_per_100 double")
    got = landing.with_evictions(geography, landing.read_evictions(spark, str(tmp_path)))
    assert {r.zip_code: r.eviction_rate_per_100 for r in got.collect()} == {"00601": 2.5, "10001": None}


def test_deaths_get_a_default_source(spark, tmp_path):
    names = [f.split()[0] for f in landing.DEATHS_SCHEMA.split(", ")]
    (tmp_path / "d.csv").write_text(",".join(n.strip() for n in names) + "\n1,F,NYC,2020-01-02,Natural,Pretrial,40,M,X,Y,12,,\n")
    row = landing.read_deaths(spark, str(tmp_path)).first()
    assert (row.death_date, row.days_detained, row.source) == (date(2020, 1, 2), 12, config.DEATHS_SOURCE)


def test_snapshot_and_latest_hold_the_same(spark, folder):
    df = spark.range(5)
    path = sinks.write_snapshot(df, folder, datetime(2021, 8, 2, 1, 2, 3))
    assert path.endswith("enriched_20210802_010203")
    assert spark.read.parquet(sinks.latest(folder)).count() == spark.read.parquet(path).count() == 5


def test_folders_are_shared_and_new(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    a, b = workspace.new_folder(spark, "x"), workspace.new_folder(spark, "x")
    assert a != b and (configured is None or a.startswith(configured))


# --- privacy ------------------------------------------------------------------
def test_no_personal_column_survives(spark):
    names = config.PII_COLUMNS + config.AGE_COLUMNS + ["jurisdiction"]
    df = spark.createDataFrame([tuple(["20"] * len(names))], ", ".join(f"`{n}` string" for n in names))
    safe = privacy.anonymised(df, "s")
    assert not set(safe.columns) & set(config.PII_COLUMNS + config.AGE_COLUMNS)
    assert {f"{n}_hash" for n in config.PII_COLUMNS} <= set(safe.columns)


def test_guard_stops_on_a_left_column(spark):
    with pytest.raises(RuntimeError, match="dob"):
        privacy.refuse_personal_columns(spark.createDataFrame([("x",)], "dob string"))


def test_salt_has_no_default(monkeypatch):
    monkeypatch.delenv(privacy.SALT_VARIABLE, raising=False)
    with pytest.raises(RuntimeError):
        privacy.salt_from_environment()


# --- derivations --------------------------------------------------------------
def test_pretrial_from_status(spark):
    df = spark.createDataFrame(
        [("NYC", " DE "), ("NYC", "de"), ("NYC", None), ("NYC", "CS"), ("LA", "DE")],
        "jurisdiction string, detention_status_code string",
    )
    assert [r.pretrial_derived for r in intake.with_pretrial_from_status(df).collect()] == [True, False, False, False, False]
    assert "pretrial_derived" not in intake.with_pretrial_from_status(df.drop("detention_status_code")).columns


def test_bail_gap_edges(spark):
    df = spark.createDataFrame(
        [("500", 80.0), ("none", 80.0), ("500", 0.0), ("500", None), ("719", 115.04)],
        "bail_set_amount string, median_daily_income double",
    )
    assert [r.work_days_to_bail for r in intake.with_bail_gap(df).collect()] == [6.3, None, None, None, 6.3]


def test_reform_tag(spark):
    df = spark.createDataFrame(
        [("MD", "2017-06-30"), ("MD", "2017-07-01T00:00:00"), ("MD", "bad"), ("LA", "2018-01-01"), ("MD", None)],
        "jurisdiction string, booking_date string",
    )
    assert [r.is_md_reform_case for r in intake.with_reform_tag(df).collect()] == [False, True, False, False, False]


def test_bookings_without_zips_or_census_come_back_unchanged(spark):
    df = spark.createDataFrame([("NYC", "2020-01-01")], "jurisdiction string, booking_date string")
    context = spark.createDataFrame([("00601", 1.0)], "zip_code string, median_household_income double")
    assert census.with_context(df, context) is df and census.with_context(df, None) is df


def test_first_zip_candidate_wins(spark):
    df = spark.createDataFrame([("1", "2")], "addr_zip string, zipcode string")
    assert intake.first_present(df, config.ZIP_CANDIDATES) == "zipcode"
    assert intake.with_clean_zip(df).first().zip_code == "00002"


def test_timeline_links_known_people_only(spark):
    held = spark.createDataFrame(
        [("p", "2020-01-01"), ("p", "2020-01-01"), ("UNKNOWN", "2020-01-01"), ("q", "bad")],
        "inmate_id_hash string, booking_date string",
    )
    freed = spark.createDataFrame(
        [("p", "2020-01-01", "2020-01-05"), ("p", "2020-01-01", "2020-01-09"), ("UNKNOWN", "2020-01-01", "2020-01-02")],
        "inmate_id_hash string, booking_date string, release_date string",
    )
    got = sorted((r.inmate_id_hash, r.days_detained or 0) for r in intake.detention_timeline(held, freed).collect())
    assert got == [("UNKNOWN", 0), ("p", 8), ("p", 8), ("q", 0)]


# --- quality ------------------------------------------------------------------
def test_each_constraint_rejects_its_own_rows(spark):
    df = spark.createDataFrame(
        [
            ("ok", date(2020, 1, 2), date(2020, 1, 2), 0.0, "NYC"),
            ("open", date(2020, 1, 2), None, None, "LA"),
            ("undated", None, None, 1.0, "LA"),
            ("backwards", date(2020, 1, 2), date(2020, 1, 1), 1.0, "MD"),
            ("negative", date(2020, 1, 2), None, -1.0, "DC"),
            ("elsewhere", date(2020, 1, 2), None, 1.0, "TX"),
        ],
        "name string, booking_date date, release_date date, bail_set_amount double, jurisdiction string",
    )
    rules = quality.fact_rules()
    assert {r.name: r.reason for r in quality.rejected(df, rules).collect()} == {
        "undated": "booking_date_missing", "backwards": "release_before_booking",
        "negative": "negative_bail", "elsewhere": "unknown_jurisdiction",
    }
    assert sorted(r.name for r in quality.valid(df, rules).collect()) == ["ok", "open"]
    zips = spark.createDataFrame([("00601",), ("6o1",), (None,)], "zip_code string")
    assert quality.rejected(zips, quality.geography_rules()).count() == 2
    ages = spark.createDataFrame([("65+",), ("66",), ("Unknown",)], "age_bucket string")
    assert [r.age_bucket for r in quality.rejected(ages, quality.inmate_rules()).collect()] == ["66"]


def test_key_checks_count_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    known = spark.createDataFrame([(1,), (2,)], "id int")
    report = quality.key_report(
        {"null": quality.nulls(df, "k"), "unique": quality.duplicates(df, "k"), "known": quality.orphans(df, "k", known, "id")}
    )
    assert {r.rule: r.violations for r in report.collect()} == {"null": 1, "unique": 2, "known": 2}


def test_coverage_and_warnings(spark):
    df = spark.createDataFrame(
        [(1.0, 10.0), (2.0, 10.0), (None, None), (None, None), (None, None), (None, None), (None, 1.0)],
        "work_days_to_bail double, median_household_income double",
    )
    metrics = quality.coverage(df).first().asDict()
    assert metrics == {"rows": 7, "bail_gap_coverage_pct": 28.6, "median_work_days_to_bail": 1.5, "census_coverage_pct": 42.9}
    assert len(quality.warn_low_coverage(metrics)) == 2


def test_ingest_keeps_count_of_what_it_cannot_read(spark, tmp_path, monkeypatch):
    monkeypatch.setenv(privacy.SALT_VARIABLE, "s")
    source = tmp_path / "landing" / CUSTODY.dataset_id
    source.mkdir(parents=True)
    bad = ['{"inmateid": broken']
    (source / "a.json").write_text("\n".join(['{"inmateid": "A1", "admitted_dt": "2021-08-01"}', *bad]))
    path = ingest.run(spark, str(tmp_path / "landing"), None, str(tmp_path / "out"))
    lost = spark.read.parquet(ingest.unreadable_of(path)).collect()
    assert sorted((r.source_system, r.n_chars) for r in lost) == [(CUSTODY.name, len(x)) for x in bad]
    assert all(len(r.text_hash) == 64 for r in lost) and spark.read.parquet(path).count() == 1


def test_ingest_from_landed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setenv(privacy.SALT_VARIABLE, "s")
    source = tmp_path / "landing" / CUSTODY.dataset_id
    source.mkdir(parents=True)
    (source / "a.json").write_text(
        '{"inmateid": "A1", "admitted_dt": "2021-08-01T00:00:00.000", "age": "33", "inmate_status_code": "DE", "ssn": "1"}\n'
        '{"inmateid": "B2", "admitted_dt": "2019-08-01T00:00:00.000", "age": "70"}\n'
    )
    path = ingest.run(spark, str(tmp_path / "landing"), None, str(tmp_path / "out"), since=30, as_of=date(2021, 8, 2))
    (row,) = spark.read.parquet(path).collect()
    assert (row.age_bucket, row.pretrial_derived, row.jurisdiction) == ("25-34", True, "NYC")
    assert "ssn" not in row.asDict() and "inmate_id" not in row.asDict()
