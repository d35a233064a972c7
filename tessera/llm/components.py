"""Connected components of a link table by alternating stars.

Each round points every node's larger neighbours at its smallest neighbour (large star), then
every node and its smaller neighbours at the smallest of them (small star). Both are a grouped
minimum with map-side combine and one join back, so no neighbour list is ever gathered, and a hub
node's rows are split by the adaptive skew join. Rounds are cut with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("dst", "src")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").where("v <> m")
            .select(F.col("v").alias("src"), F.col("m").alias("dst")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select("v", "m")
    return moved.union(least.select("u", "m")).toDF("src", "dst").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (src, dst) of comparable ids -> (node, root): every linked node with the smallest
    node that it reaches. Loops and nulls are ignored; repeated links count once."""
    prepare(links)
    edges = links.where("src <> dst").select("src", "dst").distinct().checkpoint()
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        edges = _small_star(_large_star(edges)).checkpoint()
    return (edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
            .union(edges.select("dst", "dst")).distinct())
