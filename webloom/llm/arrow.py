"""Shared plumbing of the Arrow-batched operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.operators.rows import map_rows

__all__ = ["map_rows", "text_column"]


def text_column(df: DataFrame, name: str):
    """A text column read as string whatever its declared type; a missing column reads as null."""
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
