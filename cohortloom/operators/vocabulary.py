"""Code lookups against the vocabulary tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.joins import renewed


def used_codes(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct codes the given columns hold, as ``concept_code``."""
    if len(columns) == 1:
        codes = df.select(F.col(columns[0]).cast("string").alias("concept_code"))
    else:
        texts = F.array(*[F.col(c).cast("string") for c in columns])
        codes = df.select(F.explode(texts).alias("concept_code"))
    return codes.filter(F.col("concept_code").isNotNull()).distinct()


def _hits(codes: DataFrame, concept: DataFrame) -> DataFrame:
    """Concepts with a used code."""
    return concept.join(codes, "concept_code", "left_semi")


def _lowest(found: DataFrame, concept_id: str = "concept_id") -> DataFrame:
    """One id per code: the lowest where a code stands for several concepts."""
    return found.groupBy("concept_code").agg(F.min(concept_id).alias("concept_id"))


def standard_concepts(codes: DataFrame, concept: DataFrame) -> DataFrame:
    """Code to id of the standard concept with that code, in any vocabulary."""
    return _lowest(_hits(codes, concept).filter(F.col("standard_concept") == "S"))


def mapped_concepts(
    codes: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    vocabularies: Sequence[str],
) -> DataFrame:
    """Code to id of the standard concept its concept 'Maps to'."""
    sources = (
        _hits(codes, concept)
        .filter(F.col("vocabulary_id").isin(*vocabularies))
        .select(F.col("concept_id").alias("concept_id_1"), "concept_code")
    )
    links = relationship.filter(F.col("relationship_id") == "Maps to").select(
        "concept_id_1", "concept_id_2"
    )
    targets = concept.filter(F.col("standard_concept") == "S").select(
        F.col("concept_id").alias("concept_id_2")
    )
    linked = sources.join(links, "concept_id_1").join(targets, "concept_id_2", "left_semi")
    return _lowest(linked, "concept_id_2")


def own_concepts(
    codes: DataFrame, concept: DataFrame, vocabularies: Sequence[str]
) -> DataFrame:
    """Code to id of its own concept in the listed vocabularies."""
    return _lowest(_hits(codes, concept).filter(F.col("vocabulary_id").isin(*vocabularies)))


def missing_codes(codes: DataFrame, found: DataFrame) -> DataFrame:
    """Codes a lookup did not find."""
    return codes.join(found, "concept_code", "left_anti")


def code_table(
    codes: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    vocabularies: Sequence[str],
    own_vocabularies: Sequence[str] = (),
) -> DataFrame:
    """Both lookups of every used code in one table.

    ``concept_id`` is the standard concept, else what the code maps to, else 0; ``own_id`` is
    the code's own concept in ``own_vocabularies``, else 0. The three lookups are stacked and
    folded by code, which takes one exchange instead of a join each.
    """

    def column(found: DataFrame, name: str) -> DataFrame:
        return found.withColumnRenamed("concept_id", name)

    parts = [
        column(standard_concepts(codes, concept), "_direct"),
        column(mapped_concepts(codes, concept, relationship, vocabularies), "_mapped"),
        codes,
    ]
    if own_vocabularies:
        parts.append(column(own_concepts(codes, concept, own_vocabularies), "_own"))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    own = F.coalesce(F.max("_own"), F.lit(0)) if own_vocabularies else F.lit(0).cast("long")
    return stacked.groupBy("concept_code").agg(
        F.coalesce(F.max("_direct"), F.max("_mapped"), F.lit(0)).alias("concept_id"),
        own.alias("own_id"),
    )


def resolve_codes(
    codes: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    vocabularies: Sequence[str],
) -> DataFrame:
    """Every code with its standard concept, else what it maps to, else 0."""
    return code_table(codes, concept, relationship, vocabularies).drop("own_id")


def source_concepts(
    codes: DataFrame, concept: DataFrame, vocabularies: Sequence[str]
) -> DataFrame:
    """Every code with the id of its own concept in the listed vocabularies, else 0."""
    own = own_concepts(codes, concept, vocabularies)
    return codes.join(own, "concept_code", "left").select(
        "concept_code", F.coalesce("concept_id", F.lit(0)).alias("concept_id")
    )


def apply_codes(
    facts: DataFrame, code: str, table: DataFrame, results: Mapping[str, str]
) -> DataFrame:
    """Set each result column to a column of the code table, 0 where it lacks the code.

    The table holds used codes only, so it is usually small; whether it is broadcast is
    decided from its size.
    """
    names = sorted(set(results.values()))
    ids = table.select(
        renewed(table, "concept_code").alias("_code"), *[F.col(c).alias(f"_{c}") for c in names]
    )
    joined = facts.join(ids, F.col(code).cast("string") == F.col("_code"), "left")
    found = {name: F.coalesce(f"_{c}", F.lit(0)) for name, c in results.items()}
    return joined.withColumns(found).drop("_code", *[f"_{c}" for c in names])
