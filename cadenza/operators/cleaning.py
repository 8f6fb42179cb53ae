"""Drop unused columns, drop rows holding a null or NaN."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """P1 (missing names are ignored, as ``DataFrame.drop`` does)."""
    return df.drop(*cols)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """F8: ``na.drop()`` removes rows with any null, and NaN in numeric columns."""
    return df.na.drop()
