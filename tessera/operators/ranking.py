"""Sort, limit, top-k and top-N-per-group (W*, O*, F6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, by: Sequence[str | Column],
          cols: Sequence[str | Column] | None = None) -> DataFrame:
    """The first ``k`` rows in ``by`` order.

    Planned as ``TakeOrderedAndProject``: every task keeps a ``k``-row heap, only ``k`` rows per
    task cross the network. ``by`` should end with a unique key so ties are deterministic."""
    out = df.orderBy(*by).limit(k)
    return out.select(*cols) if cols else out


def bottom_k(df: DataFrame, k: int, by: Sequence[str], cols: Sequence[str] | None = None
             ) -> DataFrame:
    """The ``k`` smallest rows by ``by`` (ascending)."""
    return top_k(df, k, [F.col(c).asc() for c in by], cols)


def top_n_per_group(df: DataFrame, group: Sequence[str], by: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """``row_number`` per group, keep ranks ``<= n``.

    Catalyst plans the rank filter as a partial ``WindowGroupLimit`` before the shuffle, so each
    task forwards at most ``n`` rows per group."""
    w = Window.partitionBy(*group).orderBy(*by)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n))
