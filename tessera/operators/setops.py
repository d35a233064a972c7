"""Set operations.

Distinct results are computed with a partial aggregate per task before the shuffle, so a value
repeated a billion times crosses the network once per task, not once per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Positional UNION ALL, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by column name; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION (one aggregate over the union; partial distinct per task first)."""
    return union_all(frames).distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: distinct rows present in both inputs (nulls compare equal, as in INTERSECT).

    One aggregate over the union: every row brings a bit for its side, and rows with both bits stay.
    One shuffle, after the bits of equal rows have been combined in each task."""
    sides = [f.toDF(*a.columns).withColumn("_side", F.lit(bit)) for bit, f in ((1, a), (2, b))]
    return (sides[0].union(sides[1]).groupBy(*a.columns).agg(F.bit_or("_side").alias("_side"))
            .where(F.col("_side") == 3).drop("_side"))
