"""Columns of the stored star schema. Amounts are doubles with at most two decimals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

DIM_GEOGRAPHY = (
    "geo_key bigint, zip_code string, city string, county string, state string,"
    " jurisdiction string, median_household_income double, median_daily_income double,"
    " poverty_rate_pct double, pct_children_single_parent double,"
    " pct_severely_rent_burdened double, pct_bachelors_or_higher double,"
    " total_population double, pct_black double, pct_white double, pct_hispanic double,"
    " eviction_rate_per_100 double, eviction_filing_rate double, census_vintage smallint"
)
DIM_FACILITY = (
    "facility_key bigint, facility_id string, facility_name string, jurisdiction string,"
    " facility_type string, security_level string, rated_capacity bigint, geo_key bigint,"
    " deaths_in_custody_ytd bigint, use_of_force_incidents_ytd bigint, solitary_population bigint,"
    " federal_oversight boolean, oversight_reason string, conditions_last_updated date"
)
DIM_INMATE = (
    "inmate_key bigint, inmate_id_hash string, age_bucket string, gender string,"
    " race_ethnicity string, home_zip_code string"
)
FACT_DETENTION = (
    "detention_key bigint, event_id string, inmate_key bigint, facility_key bigint,"
    " home_geo_key bigint, primary_charge_key bigint, booking_date date, release_date date,"
    " detention_length_days int, bail_set_amount double, bail_type string, bail_paid boolean,"
    " pretrial_detention_flag boolean, work_days_to_bail double, is_md_reform_case boolean,"
    " pretrial_derived boolean, case_disposition string, sentence_type string,"
    " source_system string, etl_batch_id string, etl_loaded_at string, jurisdiction string"
)

FACT_AMENDMENT = (
    "detention_key bigint, jurisdiction string, booking_date date, release_date date,"
    " bail_paid boolean, case_disposition string, load_no int"
)

FACILITY_UPDATE = (
    "facility_id string, facility_type string, security_level string, rated_capacity bigint,"
    " geo_key bigint, deaths_in_custody_ytd bigint, use_of_force_incidents_ytd bigint,"
    " solitary_population bigint, federal_oversight boolean, oversight_reason string,"
    " conditions_last_updated date"
)
DEATHS = (
    "facility_name string, jurisdiction string, death_date date, manner_of_death string,"
    " conviction_status string, age_at_death int, gender string, race_ethnicity string,"
    " charge_at_death string, days_detained int, source string, source_url string"
)


def conformed(df: DataFrame, ddl: str) -> DataFrame:
    """The schema's columns in its order and types; null where ``df`` lacks one."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(ddl).fields
        ]
    )


STORED = {
    "dim_geography": f"{DIM_GEOGRAPHY}, load_no int",
    "dim_facility": DIM_FACILITY,
    "dim_inmate": DIM_INMATE,
    "fact_detention": FACT_DETENTION,
    "fact_amendment": FACT_AMENDMENT,
    "facility_update": f"{FACILITY_UPDATE}, load_no int",
    "stg_deaths_in_custody": DEATHS,
}
