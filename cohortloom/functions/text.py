"""Text clean-up and lookups in short fixed lists."""

from __future__ import annotations

import string
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c"
LETTERS_AND_DIGITS = string.ascii_letters + string.digits


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null when the extract does not carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def first_present(df: DataFrame, names: list[str]) -> str | None:
    """First of several alias names the frame has."""
    return next((name for name in names if name in df.columns), None)


def alnum(c: Column) -> Column:
    """Drop every character outside a-z, A-Z and 0-9.

    What is left without these are the characters to drop. A regular expression takes several times
    as long, and every row of every extract comes through here.
    """
    text = c if isinstance(c, Column) else F.col(c)
    others = F.call_function("translate", text, F.lit(LETTERS_AND_DIGITS), F.lit(""))
    return F.call_function("translate", text, others, F.lit(""))


def cut(c: Column, length: int = 50) -> Column:
    return F.substring(c, 1, length)


def _trimmed(c: Column) -> Column:
    return F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(BLANKS))


def normalize_lower(c: Column) -> Column:
    """Categories and demographics: null to '', trimmed, lower case."""
    return F.lower(_trimmed(c))


def normalize_upper(c: Column) -> Column:
    """Codes: null to '', trimmed, upper case."""
    return F.upper(_trimmed(c))


def is_blank(c: Column) -> Column:
    return _trimmed(c) == ""


def lookup(c: Column, values: dict) -> Column:
    """Value listed for the column's key, null when it is not listed."""
    literals = F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])
    return F.try_element_at(literals, c)


def lookup_or(c: Column, values: dict, default) -> Column:
    return F.coalesce(lookup(c, values), F.lit(default))


def lookup_or_keep(c: Column, values: dict) -> Column:
    """Listed values are replaced, all others pass through."""
    return F.coalesce(lookup(c, values), c)


def whole_number_text(c: Column) -> Column:
    """Code text of a column that was read as a number: '12.0' is '12', null is '0'."""
    text = F.coalesce(c.cast("string"), F.lit("0"))
    text = F.when(text == "nan", "0").otherwise(text)
    # The expression is slow and only needed for a line break behind the number.
    plain = F.when(text.endswith(".0"), text.substr(F.lit(1), F.length(text) - 2))
    return plain.when(text.contains(".0"), F.regexp_replace(text, r"\.0$", "")).otherwise(text)


def float_text(c: Column) -> Column:
    """Text of a double: plain decimals from 1e-4 to below 1e16, else an exponent of two digits.

    25000000.0, 0.0005, 1e-05 and 1e+16 are written so.
    """
    text = c.cast("string")
    decimal = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.when(decimal.endswith("."), F.concat(decimal, F.lit("0"))).otherwise(decimal)
    digits = F.regexp_replace(F.regexp_extract(text, "^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int")
    size = F.abs(power).cast("string")
    sign = F.when(power < 0, "-").otherwise("+")
    two = F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size)
    scientific = F.concat(digits, F.lit("e"), sign, two)
    inside = (F.abs(c) >= 1e-4) & (F.abs(c) < 1e16)
    special = F.when(F.isnan(c), "nan").when(text == "Infinity", "inf").when(text == "-Infinity", "-inf")
    return F.coalesce(
        special, F.when(~text.contains("E"), text).when(inside, plain).otherwise(scientific)
    )
