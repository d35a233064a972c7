"""Temp-view registration for the SQL forms of the pipelines."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame


def temp_view(df: DataFrame, base: str) -> str:
    """Register ``df`` under a fresh session-scoped name and return the name.

    A unique name per call keeps concurrent pipelines in one session from replacing each
    other's views."""
    name = f"{base}_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    return name


@contextmanager
def temp_views(**frames: DataFrame):
    """Register each DataFrame under a fresh name for the duration of the block; yields the
    names by keyword. ``spark.sql`` analyses its text when called, so a DataFrame built inside
    the block keeps working after the views are dropped, and the session catalog does not grow
    with every call."""
    names = {key: temp_view(df, key) for key, df in frames.items()}
    try:
        yield names
    finally:
        for df, name in zip(frames.values(), names.values()):
            df.sparkSession.catalog.dropTempView(name)
