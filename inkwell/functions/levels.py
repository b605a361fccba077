"""Confidence levels and gates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def classifier_level(label: Column, score: Column) -> Column:
    """NEG for class 0, else LOW below 0.667, MEDIUM below 0.833, HIGH."""
    return F.when(label == 0, "NEG").when(score < 0.667, "LOW").when(score < 0.833, "MEDIUM").otherwise("HIGH")


def priority_level(name: Column, score: Column) -> Column:
    return F.concat(name, F.when(score < 0.5, "-LOW").when(score < 0.75, "-MEDIUM").otherwise("-HIGH"))


def gene_level(score: Column) -> Column:
    return F.when(score > 0.7, "HIGH").when(score > 0.5, "MEDIUM").otherwise("LOW")


def export_level(score: Column) -> Column:
    """Levels of an export; a null score is an unknown level, which counts as positive."""
    return F.when(score.isNull(), "UNKNOWN_LEVEL_NONE").when(score == 0, "neg").when(score < 0.667, "low").when(score < 0.833, "medium").otherwise("high")


def tag_wanted(label: Column, negated: Column) -> Column:
    """Positive results are tagged always, negative ones if the model may negate."""
    return (label == 1) | F.coalesce(negated, F.lit(False))


def taxon_species(species: Column) -> Column:
    return F.when(species.startswith("NCBITaxon:"), species)


def sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))
