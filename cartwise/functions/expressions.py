"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30.4375
# Odd, and below 2^31, so that its product with a 32-bit number is a 64-bit one.
MULTIPLIER = 1103515245


def ts(value: datetime | str) -> Column:
    """A time literal without time zone: comparing it with a parquet timestamp
    leaves the column uncast, so the filter reaches the scan."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour days between two times, truncated; not a calendar-date difference."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def iso_weekday(column: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(column) + F.lit(1)


def age_in_months(date_of_birth: Column, ref_date: date | datetime) -> Column:
    """Completed months of ``30.4375`` days; null without a birth date."""
    ref = ref_date.date() if isinstance(ref_date, datetime) else ref_date
    days = F.datediff(F.lit(ref), date_of_birth)
    return F.floor(days / F.lit(DAYS_PER_MONTH)).cast("int")


def add_baby_age_feature(users: DataFrame, ref_date: date | datetime) -> DataFrame:
    """``users`` with ``age_in_month`` at the reference date."""
    return users.withColumn("age_in_month", age_in_months(F.col("date_of_birth"), ref_date))


def seeded_key(column: Column, seed: int = 42, method: str = "xxhash64") -> Column:
    """A repeatable pseudo-random order key of an id.

    It depends on the id and the seed only, so a recomputed partition gives the
    same sample. ``xxhash64`` is a bijection of 64-bit ids. ``multiplicative`` is
    a plain multiplicative hash that any SQL engine can reproduce; it has no ties
    among ids that differ modulo 2^32, and takes any 64-bit id.
    """
    if method == "xxhash64":
        return F.xxhash64(column.cast("long"), F.lit(seed))
    if method == "multiplicative":
        span = F.lit(1 << 32)
        within = F.pmod(F.pmod(column.cast("long"), span) + F.lit(seed), span)
        return F.pmod(within * F.lit(MULTIPLIER), span)
    raise ValueError(f"Unknown key method: {method}")


def count_nulls_as_value(column: str) -> Column:
    """Distinct count in which null is one more value."""
    return F.count_distinct(column) + F.max(F.col(column).isNull().cast("long"))
