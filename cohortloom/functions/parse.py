"""Lenient parsing: what cannot be read becomes null instead of an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import schema
from cohortloom.functions.text import column_or_null


def _has_offset(text: Column) -> Column:
    """A time that ends in +hh:mm or +hhmm; a bare date is too short to count."""
    signs = ("+", "-")
    ends = F.substring(text, -6, 1).isin(*signs) | F.substring(text, -5, 1).isin(*signs)
    return (F.length(text) > 16) & ends


def to_datetime(c: Column, formats: Sequence[str] = ()) -> Column:
    """Timestamp without zone, in UTC.

    ISO text is read as written; text with a numeric offset is moved to UTC first. Further
    ``formats`` are tried in order where the ISO form does not fit.
    """
    text = c.cast("string")
    moved = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone())
    iso = F.when(_has_offset(text), moved.cast("timestamp_ntz")).otherwise(
        text.try_cast("timestamp_ntz")
    )
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(iso, *others) if others else iso


def datetime_of(df: DataFrame, name: str, formats: Sequence[str] = ()) -> Column:
    """``to_datetime`` of a column, without a detour through text where it is typed already."""
    kind = dict(df.dtypes)[name]
    if kind == "timestamp_ntz":
        return F.col(name)
    if kind == "date":
        return F.col(name).cast("timestamp_ntz")
    return to_datetime(F.col(name), formats)


def number_of(df: DataFrame, name: str) -> Column:
    """``to_float`` of a column, which a typed double passes as it is."""
    if dict(df.dtypes)[name] == "double":
        return F.when(~F.isnan(F.col(name)), F.col(name))
    return to_float(F.col(name))


def to_day(c: Column, formats: Sequence[str] = ()) -> Column:
    return to_datetime(c, formats).cast("date")


def to_float(c: Column) -> Column:
    number = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_int(c: Column) -> Column:
    """Whole numbers, also written as '12.0'; a fraction is not a whole number."""
    text = F.trim(c.cast("string"))
    number = text.try_cast("double")
    whole = F.when((F.abs(number) < 9.0e18) & (F.floor(number) == number), number.cast("long"))
    return F.coalesce(text.try_cast("long"), whole)


def coerce_column(c: Column, rule: schema.Field) -> Column:
    """One column in the type, length and default its registry rule asks for."""
    if rule.kind == "int":
        value = to_int(c)
    elif rule.kind == "float":
        value = to_float(c)
    elif rule.kind == "date":
        value = to_day(c)
    elif rule.kind == "datetime":
        value = to_datetime(c)
    elif rule.kind == "str":
        value = c.cast("string")
        if rule.max_length:
            value = F.substring(value, 1, rule.max_length)
    else:
        raise ValueError(f"unsupported type {rule.kind!r} for column {rule.name!r}")
    return value if rule.default is None else F.coalesce(value, F.lit(rule.default))


_SAME = {"int": "bigint", "float": "double", "date": "date", "datetime": "timestamp_ntz"}


def coerce(df: DataFrame, table: str, skip: Sequence[str] = ()) -> DataFrame:
    """All registry columns of a mapped frame in one projection.

    Columns in ``skip`` and those outside the registry pass through. A column that already
    has the right type is not parsed again.
    """
    known = set(schema.MAPPED[table])
    types = dict(df.dtypes)

    def shaped(name: str) -> Column:
        if name not in known or name in skip:
            return F.col(name)
        rule = schema.field(name)
        if types[name] == _SAME.get(rule.kind):
            value = F.col(name)
            if rule.default is not None:
                value = F.coalesce(value, F.lit(rule.default))
        else:
            value = coerce_column(F.col(name), rule)
        return value.alias(name)

    return df.select([shaped(name) for name in df.columns])


def project(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The listed fields in list order; a missing one becomes an all-null column."""
    kept = [F.col(name) for name in keep if name in df.columns]
    return df.select(*[column_or_null(df, name).alias(name) for name in fields], *kept)
