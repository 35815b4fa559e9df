"""Test tables read as raw booking rows, census responses, trends and registers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from custodia import config
from custodia.fixtures.binding import jurisdiction, pick, shifted, table

CUSTODY, DISCHARGES, LA, MD, DC = [source.name for source in config.SOURCES]
STATUS_CODES = [" DE ", "DEP", "DNS", "CS", "CSP", "SSR", "DPV", None]
CHARGE_CODES = ["220.03", "220", "165.15", "155", "PL 140.10", None, "999.99"]
DISPOSITIONS = [
    "Guilty Plea", "Trial - Guilty", "Trial - Not Guilty", "Dismissed", "Nolle Prosequi", "ACD",
    "Unknown", None,
]
LONG_FACILITY = "County Detention and Intake Center"
# variable -> (figure of the first ZIP, step from one ZIP to the next)
CENSUS_FIGURES = {
    "B19013_001E": (28000, 3500), "B17001_002E": (1000, 31), "B17001_001E": (9000, 7),
    "B15003_022E": (2000, 11), "B15003_001E": (7000, 13), "B15003_002E": (50, 1),
    "B09002_002E": (3000, 1), "B09002_008E": (400, 9), "B09002_011E": (100, 3),
    "B09002_001E": (3500, 17), "B25070_010E": (300, 7), "B25070_001E": (4000, 5),
    "B25002_003E": (120, 1), "B01003_001E": (20000, 900), "B02001_002E": (9000, 101),
    "B02001_003E": (5000, 57), "B02001_004E": (100, 1), "B02001_005E": (900, 1),
    "B03001_003E": (3000, 41),
}


def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_intake(spark, sf_dir).drop("turn")


def numbered_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booking rows of all sources under schema names, everything still text.

    People held in New York appear in the daily custody list and, once released,
    again in the discharges. New York has no bail, ZIP or facility; the other
    places come with court records.
    """
    key, person = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, sf_dir, "orders")
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    place = jurisdiction(key)
    sources = (
        F.when(place == "LA", F.array(F.lit(LA)))
        .when(place == "MD", F.array(F.lit(MD)))
        .when(place == "DC", F.array(F.lit(DC)))
        .when(F.col("o_orderstatus") == "F", F.array(F.lit(CUSTODY), F.lit(DISCHARGES)))
        .otherwise(F.array(F.lit(CUSTODY)))
    )
    rows = orders.join(people, "o_custkey").withColumns(
        {
            "jurisdiction": place,
            "source_system": F.explode(sources),
            "_day": shifted(F.col("o_orderdate")),
            "turn": F.floor(key / 4),
        }
    )
    source, day = F.col("source_system"), F.col("_day")
    court = F.col("jurisdiction") != "NYC"
    custody = source == CUSTODY
    stamp = F.when(court, "").otherwise("T00:00:00.000")
    free = F.when(key % 211 == 0, F.date_sub(day, 5)).otherwise(
        F.date_add(day, (key * 13 % 500).cast("int"))
    )
    age = (person % 60 + 16).cast("string")
    bail = (
        F.when(key % 13 == 0, "none")
        .when(key % 17 == 0, "NaN")
        .when(key % 199 == 0, "-100")
        .otherwise(F.floor(F.col("o_totalprice") / 100).cast("string"))
    )
    facility = F.when(key % 10 != 9, F.when(key % 5 == 4, LONG_FACILITY).otherwise(
        F.concat(F.lit("Facility "), (key % 5).cast("string"))
    ))
    return rows.select(
        F.when(person % 50 == 0, "  ")
        .when(person % 50 != 1, F.when(key % 3 == 0, F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")))
              .otherwise(F.col("c_name")))
        .alias("inmate_id"),
        F.when(key % 101 == 0, "bad-date").otherwise(F.concat(day.cast("string"), stamp)).alias(
            "booking_date"
        ),
        F.when((F.col("o_orderstatus") == "F") & ~custody, F.concat(free.cast("string"), stamp)).alias(
            "release_date"
        ),
        F.col("c_mktsegment").alias("race_ethnicity"),
        F.when(person % 5 == 0, "F").otherwise("M").alias("gender"),
        F.when(person % 97 == 0, "n/a")
        .when(person % 10 == 3, F.concat(age, F.lit(".5")))
        .otherwise(age)
        .alias("age"),
        pick(F.col("turn") % 8, STATUS_CODES).alias("detention_status_code"),
        pick(F.col("turn") % 7, CHARGE_CODES).alias("charge_code_raw"),
        F.when(custody, pick(key % 3, ["MIN", "MED", "MAX"])).alias("custody_level"),
        F.when(custody, pick(key % 2, ["N", "Y"])).alias("infraction_flag"),
        F.when(custody, "N").alias("sealed_flag"),
        F.when(court, bail).alias("bail_set_amount"),
        F.when(court, pick(
            F.substring("o_orderpriority", 1, 1).cast("int") - 1,
            ["Remand", "Cash", "Bond", "ROR", "Supervised Release"],
        )).alias("bail_type"),
        F.when(court & (F.col("o_orderstatus") != "P"),
               F.when(F.col("o_orderstatus") == "F", "true").otherwise("false")).alias("bail_paid"),
        F.when(court, pick(person % 8, DISPOSITIONS)).alias("case_disposition"),
        F.when(court, F.concat(F.lit(" "), (F.col("c_nationkey") * 371 + 601).cast("string"),
                               F.lit(" "))).alias("zip_code"),
        F.when(court, facility).alias("facility"),
        "jurisdiction",
        "source_system",
        "turn",
    )


def raw_frame(spark: SparkSession, sf_dir: str, source: config.Source, *extra: str) -> DataFrame:
    """The rows of one source under that source's own field names."""
    fields = source.column_map or {name: name for name in config.COURT_COLUMNS}
    rows = numbered_intake(spark, sf_dir).filter(F.col("source_system") == source.name)
    return rows.select(*[F.col(name).alias(raw) for raw, name in fields.items()], *extra)


def feature_pages(spark: SparkSession, sf_dir: str, source: config.Source) -> DataFrame:
    """The rows of one source as pages of nested features, a thousand or fewer per page."""
    rows = raw_frame(spark, sf_dir, source, "turn")
    fields = [name for name in rows.columns if name != "turn"]
    feature = F.struct(F.struct(*fields).alias("attributes"))
    pages = rows.groupBy(F.floor(F.col("turn") / 1000).alias("page"))
    return pages.agg(F.collect_list(feature).alias("features")).drop("page")


def census_figure(code: str, earlier: bool) -> Column:
    base, step = CENSUS_FIGURES[code]
    key = F.col("n_nationkey")
    if code == "B19013_001E":
        income = (key * step + (base - 1000 if earlier else base)).cast("string")
        return F.when(key % 10 == 9, "-666666666").otherwise(income)
    text = (key * step + base).cast("string")
    if code == "B17001_001E":
        return F.when(key == 3, "0").otherwise(text)
    if code == "B09002_008E":
        return F.when(key % 6 != 5, text)
    if code == "B09002_011E":
        return F.when(key % 7 == 6, "x").otherwise(text)
    return text


def raw_census(spark: SparkSession, sf_dir: str, earlier: bool = False) -> DataFrame:
    """Census figures as text under their readable names, one row per ZIP."""
    figures = [census_figure(code, earlier).alias(name) for code, name in config.CENSUS_VARIABLES.items()]
    zip_code = F.lpad((F.col("n_nationkey") * 371 + 601).cast("string"), 5, "0")
    return table(spark, sf_dir, "nation").select(*figures, zip_code.alias("zip_code"))


def census_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures as text lines of arrays of arrays, at most 50 ZIPs per response."""
    names = {**config.CENSUS_VARIABLES, config.CENSUS_ZIP_HEADER: "zip_code"}
    header = F.array(F.array(*[F.lit(code) for code in names]))
    rows = raw_census(spark, sf_dir).withColumn("_zip", F.col("zip_code").cast("int"))
    lines = rows.groupBy(F.floor((F.col("_zip") - 601) / (371 * 50)).alias("page")).agg(
        F.collect_list(F.array(*names.values())).alias("rows")
    )
    return lines.select(F.to_json(F.concat(header, F.col("rows"))).alias("value"))


COUNTY_CODES = [code for code, _ in config.TARGET_COUNTIES]


def county_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County rows for every nation and year met in the customers."""
    key, year = F.col("n"), F.col("year")
    met = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("n"), (F.col("c_custkey") % 53 + 1970).cast("int").alias("year")
    ).distinct()
    since = year - 1970
    code = F.when(key == 5, "6037").when(key < 9, pick(key, COUNTY_CODES + [""] * 16)).otherwise(
        (key * 2 + 1001).cast("string")
    )

    def figure(base: int, step: int, yearly: int = 0) -> Column:
        return (key * step + since * yearly + base).cast("double")

    return met.select(
        year,
        code.alias("county_fips"),
        F.concat(F.lit("County "), key.cast("string")).alias("county_name"),
        pick(key % 5, ["NY", "CA", "DC", "MD", "TX"]).alias("state_abbr"),
        pick(key % 2, ["urban", "rural"]).alias("urbanicity"),
        F.when(key != 4, figure(500, 40, 10)).alias("total_jail_pop"),
        figure(300, 25, 6).alias("total_pretrial_custody"),
        figure(150, 10, 3).alias("total_sentenced_custody"),
        figure(100, 9).alias("black_jail_pop"),
        figure(80, 7).alias("latinx_jail_pop"),
        figure(90, 8).alias("white_jail_pop"),
        F.when(key == 8, 0.0).otherwise(figure(800, 30)).alias("jail_rated_capacity"),
        figure(2000, 3).alias("total_jail_admits"),
        figure(1990, 3).alias("total_jail_discharges"),
    )


def state_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return county_trends(spark, sf_dir).groupBy("year", "state_abbr").agg(
        F.sum("total_jail_pop").alias("total_jail_pop"),
        F.sum("total_pretrial_custody").alias("total_pretrial_custody"),
    )


def evictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eviction rates of the ZIPs in the geography, unknown for some."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        (key * 371 + 10001).cast("string").alias("zip"),
        F.when(key % 6 != 1, key * 3 % 9 + 1).cast("double").alias("eviction_rate"),
        (key * 5 % 11 + 2).cast("double").alias("eviction_filing_rate"),
        (key * 7 % 50 + 20).cast("double").alias("low_income_renter_pct"),
    )
