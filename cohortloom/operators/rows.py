"""Row filters and date repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import is_blank, normalize_lower, normalize_upper

# Categories and codes that decide between measurement and observation.
MEASUREMENT_CATEGORIES = ("laboratory", "vital-signs", "exam")
OBSERVATION_CATEGORIES = ("health indicator", "survey", "social-history")
QUALITY_CODES = ("QOLS", "QALY", "DALY")


def once(c: Column) -> Column:
    """The same value, worked out once a row.

    A filter on a column that a projection computes is planned below the projection, so what is costly (parsing a date, cleaning
    a key) would be done for the filter, term by term, and again for the rows that pass. A projection that asks for
    the partition is not passed.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def repair_interval(df: DataFrame, start: str, stop: str) -> DataFrame:
    """A missing end takes the other one, a stop before its start moves to the start.

    Rows without either are dropped.
    """
    begin = F.coalesce(F.col(start), F.col(stop))
    end = F.greatest(F.coalesce(F.col(stop), F.col(start)), begin)
    return df.filter(F.col(start).isNotNull() | F.col(stop).isNotNull()).withColumns(
        {start: begin, stop: end}
    )


def fill_either(df: DataFrame, start: str, stop: str) -> DataFrame:
    """Null start from the stop, then null stop from the start; nothing is dropped."""
    begin = F.coalesce(F.col(start), F.col(stop))
    return df.withColumns({start: begin, stop: F.coalesce(F.col(stop), begin)})


def not_before(event: Column, birth: Column) -> Column:
    """Keeps events on or after birth; an unknown birth keeps the event."""
    return birth.isNull() | (event >= birth)


def clamp_period(df: DataFrame, start: str, stop: str, birth: Column) -> DataFrame:
    """Period start not before birth, period end not before its start."""
    begin = F.greatest(F.col(start), birth)
    return df.withColumns({start: begin, stop: F.greatest(F.col(stop), begin)})


def is_measurement(category: Column, code: Column, value: Column, units: Column) -> Column:
    """True for measurement rows, false for observation rows, never null.

    ``value`` is the numeric value as far as it could be read, null otherwise.
    """
    kind = normalize_lower(category)
    by_category = kind.isin(*MEASUREMENT_CATEGORIES)
    by_value = ~kind.isin(*OBSERVATION_CATEGORIES) & value.isNotNull() & ~is_blank(units)
    return (by_category | by_value) & ~normalize_upper(code).isin(*QUALITY_CODES)
