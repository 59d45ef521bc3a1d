"""Health bands of the 0-100 rating scale."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rating_band(rating: Column) -> Column:
    """Half-open bands: 80 and up healthy, 60 usable, 30 warning, below that fault."""
    return (
        F.when(rating >= 80, "healthy")
        .when(rating >= 60, "usable")
        .when(rating >= 30, "warning")
        .when(rating.isNotNull(), "fault")
    )
