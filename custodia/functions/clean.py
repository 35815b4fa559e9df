"""Cleaning expressions for raw text fields. None of them raises on bad input."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, functions as F

from custodia import config


LARGEST = 1.7976931348623157e308


def number(text: Column) -> Column:
    """A finite double, or null for anything that is not one (words, NaN, infinities).

    NaN compares as larger than every number, so one bound excludes it as well.
    """
    value = text.try_cast("double")
    return F.when(F.abs(value) <= LARGEST, value)


def count_or_null(text: Column) -> Column:
    """A census figure: negative sentinels and bad text become null."""
    value = text.try_cast("double")
    return F.when((value >= 0) & (value <= LARGEST), value)


def day(text: Column) -> Column:
    """The date of an ISO date or timestamp text; null when it cannot be read."""
    return text.try_cast("date")


def hashed(value: Column, salt: str) -> Column:
    """SHA-256 of the salted, upper-cased, trimmed value; blanks share one marker."""
    kept = F.trim(value.cast("string"))
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.upper(kept)), 256)
    return F.when(F.length(kept) > 0, digest).otherwise(F.lit(config.UNKNOWN_PERSON))


def bucket_of(years: Column) -> Column:
    """The age bucket of a number of years; not knowing it is a bucket of its own."""
    labels = config.AGE_BUCKETS
    bucket = F.when(years.isNull(), labels[-1])
    for upper, label in zip(config.AGE_BUCKET_STARTS, labels):
        bucket = bucket.when(years < upper, label)
    return bucket.otherwise(labels[len(config.AGE_BUCKET_STARTS)])


def age_bucket(age: Column) -> Column:
    return bucket_of(number(age))


def zip5(text: Column) -> Column:
    """First five characters of the trimmed code, left-padded with zeros; blank is null."""
    kept = F.substring(F.trim(text.cast("string")), 1, 5)
    return F.when(F.length(kept) > 0, F.lpad(kept, 5, "0"))


def label_by_upper_limit(value: Column, limits, last: str) -> Column:
    """Label of the first ``(limit, label)`` whose limit is not below ``value``."""
    (first_limit, first_label), *rest = limits
    labelled = F.when(value <= first_limit, first_label)
    for limit, label in rest:
        labelled = labelled.when(value <= limit, label)
    return labelled.otherwise(last)


def as_date(value: date | str | None) -> Column:
    """A day given by the caller, or today."""
    if value is None:
        return F.current_date()
    if isinstance(value, datetime):
        value = value.date()
    return F.lit(value).cast("date")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
