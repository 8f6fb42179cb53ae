"""Telling a table that is not there yet from one that cannot be read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


def or_none(read) -> DataFrame | None:
    """``read()``, or None if its path does not exist (or holds no file yet); every other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
