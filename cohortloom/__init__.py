"""Conform clinical extracts to OMOP CDM tables as Spark DataFrame plans."""
