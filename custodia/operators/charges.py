"""The charge dimension and the lookup from raw statute sections to charge keys."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from custodia import config

_ARROW_SCHEMA = pa.schema(
    [
        ("charge_key", pa.int64()),
        ("charge_code", pa.string()),
        ("charge_description", pa.string()),
        ("charge_class", pa.string()),
        ("charge_category", pa.string()),
        ("is_violent", pa.bool_()),
        ("is_poverty_linked", pa.bool_()),
        ("is_addiction_related", pa.bool_()),
        ("jurisdiction", pa.string()),
        ("penal_law_section", pa.string()),
    ]
)


def small_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A literal table. It becomes a local relation, whose size the planner knows exactly."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def charge_dimension(spark: SparkSession) -> DataFrame:
    """The 54 classified charges; always small enough to be sent to every task."""
    return small_table(spark, config.taxonomy_rows(), _ARROW_SCHEMA)


def bare_section(section: Column) -> Column:
    """Statute section without the leading ``PL ``."""
    return F.trim(F.regexp_replace(F.trim(section), "^PL ", ""))


def charge_lookup(charges: DataFrame) -> DataFrame:
    """(section, charge_key): exact sections, then whole articles not listed as a section.

    Several charges can share a section: the largest key stands for an exact
    section, the smallest for an article (the part before the dot).
    """
    listed = charges.filter(F.col("penal_law_section").isNotNull()).select(
        bare_section(F.col("penal_law_section")).alias("section"), "charge_key"
    )
    exact = listed.groupBy("section").agg(F.max("charge_key").alias("charge_key"))
    article = listed.groupBy(F.split_part("section", F.lit("."), F.lit(1)).alias("section")).agg(
        F.min("charge_key").alias("charge_key")
    )
    return exact.unionByName(article.join(exact, "section", "left_anti"))


def with_charge_key(df: DataFrame, charges: DataFrame) -> DataFrame:
    """Resolve ``charge_code_raw`` to ``primary_charge_key`` (null when unknown)."""
    lookup = charge_lookup(charges).select(
        F.col("section").alias("_section"), F.col("charge_key").alias("primary_charge_key")
    )
    return df.join(
        F.broadcast(lookup),  # at most two rows per classified charge
        bare_section(F.col("charge_code_raw")) == F.col("_section"),
        "left",
    ).drop("_section")
