"""Removal of personal data (T03-T07). Runs before any row is written anywhere."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F

from custodia import config
from custodia.functions.clean import bucket_of, hashed, number

SALT_VARIABLE = "PII_SALT"


def salt_from_environment() -> str:
    salt = os.environ.get(SALT_VARIABLE)
    if not salt:
        raise RuntimeError(f"set {SALT_VARIABLE}: identifiers must not be hashed without a secret")
    return salt


def hash_identifiers(df: DataFrame, salt: str) -> DataFrame:
    """A digest column for every personal column present, and the raw ones gone."""
    found = [name for name in config.PII_COLUMNS if name in df.columns]
    digests = {f"{name}_hash": hashed(F.col(name), salt) for name in found}
    return (df.withColumns(digests) if digests else df).drop(*found)


def bucket_ages(df: DataFrame) -> DataFrame:
    """The bucket of the last age column present, and the raw ones gone."""
    found = [name for name in config.AGE_COLUMNS if name in df.columns]
    if not found:
        return df
    # The number is its own column, so that it is parsed once and not once per bucket.
    years = df.withColumn("_years", number(F.col(found[-1])))
    return years.withColumn("age_bucket", bucket_of(F.col("_years"))).drop("_years", *found)


def refuse_personal_columns(df: DataFrame) -> DataFrame:
    """Stop when a personal or age column is left. Looks at the schema only."""
    left = [name for name in config.PII_COLUMNS + config.AGE_COLUMNS if name in df.columns]
    if left:
        raise RuntimeError(f"personal columns left after the privacy step: {left}")
    return df


def anonymised(df: DataFrame, salt: str) -> DataFrame:
    """T04, T06 and T07 together."""
    return refuse_personal_columns(bucket_ages(hash_identifiers(df, salt)))
