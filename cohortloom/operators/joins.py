"""Key lookups, anti joins and first-row-per-key, all without a window over raw groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by the ``order`` columns, remaining ties by the other columns.

    An aggregate rather than ``row_number``: every task already reduces its rows to one per
    key before the shuffle, so a key that holds a large part of the table costs no more than
    any other. A null key is a key of its own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys] + rest
    if not ranked:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def renewed(df: DataFrame, key: str) -> Column:
    """The key as a new expression of the same value.

    A side that was just aggregated by the join key would be joined in the stage of the
    aggregate. Adaptive execution splits a hot key only between two plain exchanges, and the
    new expression makes the planner add one.
    """
    kind = dict(df.dtypes)[key]
    if kind == "string":
        return F.concat(key, F.lit("")).alias(key)
    return F.col(key).bitwiseOR(F.lit(0).cast(kind)).alias(key)


def one_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Dimension reduced to its key and one id, so that a join never multiplies rows."""
    unique = df.groupBy(key).agg(F.min(value).alias(value))
    return unique.select(renewed(df, key), value)


def join_person(facts: DataFrame, persons: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Facts of known persons, with the person id and further person columns."""
    key = "person_source_value"
    if not extra:
        return facts.join(one_per_key(persons, key, "person_id"), key, "inner")
    known = keep_first(persons.select(key, "person_id", *extra), key, ["person_id"])
    known = known.select(renewed(known, key), "person_id", *extra)
    return facts.join(known, key, "inner")


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str, value: str) -> DataFrame:
    """Left join to a dimension by natural key; a miss gives a null id."""
    return facts.join(one_per_key(dimension, key, value), key, "left")


def join_parent(facts: DataFrame, parents: DataFrame, key: str, value: str) -> DataFrame:
    """Inner join to a parent table by natural key; facts without a parent vanish."""
    return facts.join(one_per_key(parents, key, value), key, "inner")


def only_new(df: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet; a null key counts as new."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(existing.select(*keys), keys, "left_anti")


def first_new(
    df: DataFrame, existing: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """``keep_first`` then ``only_new`` on the same key: one exchange serves both."""
    return only_new(keep_first(df, key, order), existing, key)


def own_or_looked_up(
    df: DataFrame, dimension: DataFrame, key: str, value: str
) -> DataFrame:
    """Keep the row's own id, else the one the dimension has for its natural key."""
    found = one_per_key(dimension, key, value).withColumnRenamed(value, "_found")
    own: Column = F.col(value) if value in df.columns else F.lit(None).cast("long")
    return df.join(found, key, "left").withColumn(value, F.coalesce(own, "_found")).drop("_found")
