"""The star schema as one bundle of DataFrames, whatever storage they come from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from custodia import schemas
from custodia.operators.charges import charge_dimension
from custodia.operators.warehouse import current_facilities, current_facts, current_geography

Maker = Callable[[], DataFrame]


@dataclass(frozen=True)
class Star:
    """Tables are looked up on first use: a report touches only the files it needs."""

    make_fact: Maker
    make_inmate: Maker
    make_facility: Maker
    make_charges: Maker
    make_geography: Maker

    @cached_property
    def fact(self) -> DataFrame:
        return self.make_fact()

    @cached_property
    def inmate(self) -> DataFrame:
        return self.make_inmate()

    @cached_property
    def facility(self) -> DataFrame:
        return self.make_facility()

    @cached_property
    def charges(self) -> DataFrame:
        return self.make_charges()

    @cached_property
    def geography(self) -> DataFrame:
        return self.make_geography()


def of_tables(
    fact: DataFrame,
    inmate: DataFrame,
    facility: DataFrame,
    charges: DataFrame,
    geography: DataFrame,
) -> Star:
    return Star(lambda: fact, lambda: inmate, lambda: facility, lambda: charges, lambda: geography)


def stored(spark: SparkSession, root: str) -> Star:
    """The star schema written by the warehouse load under ``root``."""

    def table(name: str) -> Maker:
        # A table whose loads had no valid row has no file to take a schema from.
        kind = schemas.STORED[name]
        return lambda: spark.read.schema(kind).parquet(f"{root}/{name}")

    def optional(name: str) -> DataFrame | None:
        try:
            return table(name)()
        except AnalysisException:  # no job has had rows for it
            return None

    return Star(
        make_fact=lambda: current_facts(table("fact_detention")(), optional("fact_amendment")),
        make_inmate=table("dim_inmate"),
        make_facility=lambda: current_facilities(table("dim_facility")(), optional("facility_update")),
        make_charges=lambda: charge_dimension(spark),
        make_geography=lambda: current_geography(table("dim_geography")()),
    )


def stored_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart as the last load left it: mv_bail_gap_by_zip or mv_innocence_by_jurisdiction."""
    return spark.read.parquet(f"{root}/{name}")
