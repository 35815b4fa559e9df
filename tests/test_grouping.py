"""The grouping helpers against the plain Spark form, with most rows on one key."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from custodia.functions import grouping
from custodia.functions.grouping import hot_join, numbered, numbered_by_range, percentile_of_counts, roll_up, tiled
from custodia.functions.measures import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows share one area and one income."""
    i = F.col("id")
    return spark.range(3000).select(
        (i * 7919 % 100003).alias("key"),
        F.when(i % 3 > 0, "a").otherwise(F.concat(F.lit("b"), (i % 4).cast("string"))).alias("area"),
        F.when(i % 3 > 0, 100).when(i % 11 == 0, None).otherwise(i % 17).cast("double").alias("income"),
        (i % 29).alias("days"),
    ).cache()


def as_set(df):
    return sorted(tuple(map(repr, row)) for row in df.collect())


@pytest.mark.parametrize("tie_buckets", [1, 7, 65521])
def test_tiles_equal_ntile(skewed, monkeypatch, tie_buckets):
    monkeypatch.setattr(grouping, "TIE_BUCKETS", tie_buckets)
    order = Window.partitionBy("area").orderBy(
        F.col("income").asc_nulls_last(), F.col("key") % tie_buckets, "key"
    )
    sums = {"n": rows(), "total": F.sum("days"), "keys": F.sum("key")}
    for tiles in (5, 4):
        plain = (
            skewed.withColumn("tile", F.ntile(tiles).over(order).cast("long"))
            .groupBy("area", "tile")
            .agg(*[c.alias(n) for n, c in sums.items()])
        )
        made = tiled(skewed, "area", "income", "key", tiles, sums)
        assert as_set(made.select(plain.columns)) == as_set(plain)


def test_tiles_of_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 2), ("b", None, 3)], "area string, income double, key long")
    got = tiled(df, "area", "income", "key", 5, {"n": rows()})
    assert as_set(got) == [("'a'", "1", "1"), ("'a'", "2", "1"), ("'b'", "1", "1")]


def test_roll_up_equals_one_step(skewed):
    made = roll_up(
        skewed, ["area"], {"n": rows(), "total": F.sum("days")}, F.col("days"), {"p50": 0.5, "p90": 0.9}
    ).withColumn("_largest", F.col("_largest").cast("long"))
    plain = skewed.groupBy("area").agg(
        rows().alias("n"), F.sum("days").alias("total"), F.percentile("days", F.lit(0.5)).alias("p50"),
        F.percentile("days", F.lit(0.9)).alias("p90"), F.max("days").alias("_largest"),
    )
    assert as_set(made) == as_set(plain)


def test_numbers_equal_row_number(skewed):
    ids = skewed.select(F.sha2(F.col("key").cast("string"), 256).alias("id")).distinct()
    made = numbered(ids, "id", "n", F.lit(10), digest=True)
    plain = ids.withColumn("n", F.row_number().over(Window.orderBy("id")).cast("long") + 10)
    assert as_set(made.select("id", "n")) == as_set(plain)


def test_numbers_by_range_equal_row_number(spark):
    """All keys begin alike, as the names of one jurisdiction's facilities do; one row has no key."""
    ids = spark.range(5000).select(
        F.when(F.col("id") > 0, F.concat(F.lit("NYC-Facility number "), F.col("id").cast("string"))).alias("id")
    ).repartition(7)
    made = numbered_by_range(ids, "id", "n", F.lit(10))
    plain = ids.dropna().withColumn("n", F.row_number().over(Window.orderBy("id")).cast("long") + 10)
    assert as_set(made.select("id", "n")) == as_set(plain)
    assert numbered_by_range(ids.limit(0), "id", "n", F.lit(0)).count() == 0


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("rows_", [1, 2, 999, 1000])
def test_percentile_of_counts_equals_percentile(spark, p, rows_):
    """Negative and large values, ties, weights and nulls."""
    i = F.col("id")
    counted = spark.range(rows_).select(
        F.when(i % 9 != 1, (i * 7919 % 613 - 100) * F.when(i % 5 == 0, 100003).otherwise(1)).alias("value"), (i % 4 + 1).alias("n")
    ).groupBy("value").agg(F.sum("n").alias("n"))
    made = percentile_of_counts(counted, "value", "n", p, "at").first()["at"]
    plain = counted.agg(F.percentile("value", F.lit(p), F.col("n"))).first()[0]
    assert made == pytest.approx(plain, abs=1e-6)


def test_percentile_of_no_counts(spark):
    none = spark.createDataFrame([(None, 3)], "value long, n long")
    assert [r["at"] for r in percentile_of_counts(none, "value", "n", 0.5, "at").collect()] == [None]


def test_hot_join_equals_left_join(skewed):
    lookup = skewed.select("area").distinct().filter("area <> 'b1'").withColumn("code", F.length("area"))
    made = hot_join(skewed, lookup, "area", "a", ["key"])
    plain = skewed.join(lookup, "area", "left")
    assert as_set(made.select(plain.columns)) == as_set(plain)
