"""Cleaning and rounding expressions on rows chosen for their edges."""

from __future__ import annotations

import hashlib
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from custodia.functions import clean, measures as m
from custodia.operators.charges import bare_section, charge_dimension, with_charge_key
from custodia.plans import common, reform


def evaluate(spark, values, column, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", column(F.col("x")).alias("y"))
    return [row.y for row in sorted(df.collect(), key=lambda r: r.i)]


def test_number_accepts_only_finite_numbers(spark):
    texts = ["12", " 7.5 ", "-3", "1e3", "", None, "none", "NaN", "Infinity", "-Infinity", "12,5"]
    assert evaluate(spark, texts, clean.number) == [
        12.0, 7.5, -3.0, 1000.0, None, None, None, None, None, None, None,
    ]


def test_census_figures_below_zero_are_unknown(spark):
    texts = ["0", "5", "-666666666", "x", "NaN", None]
    assert evaluate(spark, texts, clean.count_or_null) == [0.0, 5.0, None, None, None, None]


def test_age_bucket_edges(spark):
    ages = ["17", "17.9", "18", "24", "25", "34", "35", "44", "45", "54", "55", "64", "65", "99"]
    assert evaluate(spark, ages, clean.age_bucket) == [
        "<18", "<18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54",
        "55-64", "55-64", "65+", "65+",
    ]
    assert evaluate(spark, ["n/a", "", None, "NaN"], clean.age_bucket) == ["Unknown"] * 4


def test_hash_links_a_person_and_hides_blanks(spark):
    got = evaluate(spark, ["Ann Lee", " ann lee ", "", "   ", None], lambda c: clean.hashed(c, "s"))
    expected = hashlib.sha256(b"s:ANN LEE").hexdigest()
    assert got == [expected, expected, "UNKNOWN", "UNKNOWN", "UNKNOWN"]


@settings(max_examples=5, deadline=None)
@given(names=st.lists(st.text("abcXYZ 09-", min_size=1, max_size=12), min_size=20, max_size=20))
def test_hash_ignores_case_and_outer_spaces(spark, names):
    plain = evaluate(spark, names, lambda c: clean.hashed(c, "s"))
    varied = evaluate(spark, [f"  {n.lower()} " for n in names], lambda c: clean.hashed(c, "s"))
    assert plain == varied


def test_zip_is_trimmed_cut_and_padded(spark):
    zips = [" 601 ", "10001-1234", "07030", "", "  ", None]
    assert evaluate(spark, zips, clean.zip5) == ["00601", "10001", "07030", None, None, None]


def test_day_reads_dates_and_timestamps_only(spark):
    got = evaluate(spark, ["2017-07-01", "2017-07-01T10:00:00.000", "bad", "", None], clean.day)
    assert [str(d) if d else None for d in got] == ["2017-07-01", "2017-07-01", None, None, None]


def exact(numerator, denominator, digits, factor=1):
    unit = Decimal(1).scaleb(-digits)
    return float((Decimal(factor) * numerator / denominator).quantize(unit, ROUND_HALF_UP))


@pytest.mark.parametrize("digits, factor", [(0, 1), (1, 100), (2, 100), (1, 1)])
def test_ratio_rounds_every_tie_away_from_zero(spark, digits, factor):
    pairs = [(a, b) for b in (8, 16, 40, 64, 200, 2000) for a in range(0, 300)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", m.ratio(F.col("a"), F.col("b"), digits, float(factor)).alias("r"))
    for row in got.collect():
        assert row.r == exact(row.a, row.b, digits, factor), (row.a, row.b)


def test_ratio_without_a_whole_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 2)], "a long, b long")
    assert [r.r for r in df.select(m.pct(F.col("a"), F.col("b")).alias("r")).collect()] == [None] * 3


def test_average_of_cents_is_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.15,), (None,)], "x double")
    assert df.agg(m.mean(F.col("x"), 2).alias("v")).first().v == 0.15
    tenths = spark.createDataFrame([(2.3,), (2.4,)], "x double")
    assert tenths.agg(m.mean(F.col("x"), 1).alias("v")).first().v == 2.4


def test_percentile_of_cents_rounds_the_tie(spark):
    df = spark.createDataFrame([(2.3,), (2.4,)], "x double").select(m.hundredths(F.col("x")).alias("h"))
    middle = df.agg(m.from_hundredths(F.percentile("h", F.lit(0.5)), 1).alias("v")).first().v
    assert middle == 2.4


def test_length_of_stay_edges(spark):
    days = [0, 7, 8, 30, 31, 90, 91, 180, 181, 365, 366, None]
    df = spark.createDataFrame([(d,) for d in days], "detention_length_days int")
    labels = [r.b[:2] for r in df.select(common.time_held().alias("b")).collect()]
    assert labels == ["01", "01", "02", "02", "03", "03", "04", "04", "05", "05", "06", "Un"]


def test_reform_period_starts_on_its_day(spark):
    df = spark.sql("select explode(array(date'2017-06-30', date'2017-07-01')) as booking_date")
    assert [r.p for r in df.select(common.reform_period().alias("p")).collect()] == [
        "Pre-Reform", "Post-Reform",
    ]


def test_income_tiers_and_unknown_income(spark):
    incomes = [34999.0, 35000.0, 54999.0, 55000.0, 79999.0, 80000.0, None]
    got = evaluate(spark, incomes, reform._income_tier, "double")
    assert [tier[0] for tier in got] == ["1", "2", "2", "3", "3", "4", "4"]


def test_charge_lookup_prefers_exact_sections(spark):
    codes = ["220.03", "PL 220.03", "155", "155.25", "220", "165.15", "165", "125", "999.9", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, charge_code_raw string")
    rows = with_charge_key(df, charge_dimension(spark)).orderBy("i").collect()
    # Several charges share a section: the last listed one stands for it, and the
    # first one of an article that is not a section itself.
    assert [r.primary_charge_key for r in rows] == [20, 20, 17, 39, 20, 34, 34, 2, None, None]


def test_bare_section(spark):
    assert evaluate(spark, ["PL 155", "155", " PL 155.25 "], bare_section) == ["155", "155", "155.25"]
