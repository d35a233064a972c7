"""Arrow (pandas) UDF twins of built-in expressions (D-1, D-2).

The built-in forms in ``expressions`` are the fast path; these twins exist for the
built-in-vs-UDF comparison and as templates for logic Spark has no function for. They are
vectorised: one Arrow batch per call, never one row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import PART_OF_DAY_BANDS, PART_OF_DAY_REST


@F.pandas_udf(T.StringType())
def part_of_day_udf(hour: pd.Series) -> pd.Series:
    """Twin of ``expressions.part_of_day`` (null hour -> null)."""
    h = pd.to_numeric(hour, errors="coerce").astype("Float64")
    out = pd.Series(PART_OF_DAY_REST, index=hour.index, dtype="object")
    for label, lo, hi in PART_OF_DAY_BANDS:
        out[((h >= lo) & (h <= hi)).fillna(False).to_numpy(dtype=bool)] = label
    out[h.isna().to_numpy()] = None
    return out


def times_udf(factor: int):
    """Twin of ``expressions.times`` for integral inputs: returns a bigint pandas UDF."""

    @F.pandas_udf(T.LongType())
    def _times(x: pd.Series) -> pd.Series:
        v = x.astype("Int64")
        return v * np.int64(factor)

    return _times


def apply_times_udf(x: str | Column, factor: int) -> Column:
    return times_udf(factor)(F.col(x) if isinstance(x, str) else x)
