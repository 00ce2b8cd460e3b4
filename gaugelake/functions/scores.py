"""Dispersion score: three clamped components, their weighted sum and its category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-score levels, weights and category bounds.
FULL_BOUNDARY_LAYER_M = 1500.0
FULL_WIND_SPEED = 25.0
FULL_PRECIPITATION_MM = 3.0
WEIGHT_BOUNDARY_LAYER = 0.40
WEIGHT_WIND = 0.35
WEIGHT_PRECIPITATION = 0.25
POOR_BELOW = 0.30
FAIR_UP_TO = 0.55
CATEGORIES_WORST_FIRST = ("poor", "fair", "good")


def clamp_score(value: Column, full: float) -> Column:
    """``value / full`` held within 0..1; a missing value scores 0, the worst case."""
    return F.when(value.isNull(), F.lit(0.0)).otherwise(
        F.least(F.greatest(value / F.lit(full), F.lit(0.0)), F.lit(1.0))
    )


def round_half_up(value: Column, places: int) -> Column:
    """Rounding of non-negative doubles that gives the same bits in any IEEE engine."""
    scale = F.lit(float(10**places))
    return F.floor(value * scale + F.lit(0.5)) / scale


def dispersion(boundary_layer: Column, wind: Column, precipitation: Column) -> Column:
    """Unrounded weighted score of the three component scores."""
    return (
        F.lit(WEIGHT_BOUNDARY_LAYER) * boundary_layer
        + F.lit(WEIGHT_WIND) * wind
        + F.lit(WEIGHT_PRECIPITATION) * precipitation
    )


def category(score: Column) -> Column:
    """Category of an unrounded score."""
    return F.when(score < POOR_BELOW, "poor").when(score <= FAIR_UP_TO, "fair").otherwise("good")


def severity_rank(name: Column) -> Column:
    """0 for the worst category, so that ``min`` finds the worst."""
    rank = F.lit(None).cast("int")
    for position, label in enumerate(CATEGORIES_WORST_FIRST):
        rank = F.when(name == label, F.lit(position)).otherwise(rank)
    return rank


def category_of_rank(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(label) for label in CATEGORIES_WORST_FIRST]), rank)
