"""Column expressions used by several plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 8


def exact_sum(c: Column) -> Column:
    """A sum of money that doesn't depend on the order of rows."""
    return F.sum(c.cast("string").cast("decimal(18,4)")).cast("double")


def ratio(a: Column, b: Column) -> Column:
    """Null on a zero denominator."""
    return a / F.nullif(b.cast("double"), F.lit(0.0))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def hour(t: Column) -> Column:
    return F.date_trunc("HOUR", t)


def millis(t: Column) -> Column:
    return F.unix_millis(t)


def micros(t: Column) -> Column:
    return F.unix_micros(t)


def lag_seconds(earlier: Column, later: Column) -> Column:
    """Differences of whole epoch seconds."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def household_bucket(household: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.hash(household), F.lit(buckets))


def joined(values: Column) -> Column:
    """A sorted array as one string."""
    return F.array_join(values, ",")
