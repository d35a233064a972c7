"""Generic operators on edge cases: null-safe set semantics, name-keyed joins, JSON loading,
top-N per group on raw rows with one hot group."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import ranking, relational, setops
from tessera.sources import load


def test_intersect_and_union_are_null_safe(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y"), (None, "y"), (2, None)], "k INT, v STRING")
    b = spark.createDataFrame([(None, "y"), (2, None), (3, "z")], "k INT, v STRING")
    assert sorted(rows(setops.intersect(a, b)), key=str) == sorted([(None, "y"), (2, None)],
                                                                   key=str)
    assert sorted(rows(setops.intersect(a, b)), key=str) == \
        sorted(rows(a.intersect(b)), key=str)
    assert len(rows(setops.union_distinct([a, b]))) == 4
    assert len(rows(setops.union_all([a, b]))) == 7


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, name STRING")
    b = spark.createDataFrame([("y", 2, True)], "name STRING, id INT, flag BOOLEAN")
    out = setops.union_by_name([a, b])
    assert out.columns == ["id", "name", "flag"]
    assert sorted(rows(out), key=str) == sorted([(1, "x", None), (2, "y", True)], key=str)


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge", "shuffle_hash",
                                      "shuffle_replicate_nl"])
def test_join_on_column_names(spark, strategy):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k INT, l STRING")
    right = spark.createDataFrame([(2, "X"), (3, "Y")], "k INT, r STRING")
    # the size of rows from the driver is unknown to the optimizer, so the bounds are lifted here
    out = relational.join(left, right, ["k"], "inner", strategy, max_broadcast_bytes=1 << 64,
                          max_nested_loop_bytes=1 << 64)
    assert sorted(rows(out)) == [(2, "b", "X"), (2, "c", "X")]
    with pytest.raises(ValueError):
        relational.join(left, right, ["k"], "inner", "teleport")


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle_replicate_nl"])
def test_copying_strategy_is_refused_with_an_error(spark, strategy):
    df = spark.range(0, 1000)
    bounds = {"max_broadcast_bytes": 100, "max_nested_loop_bytes": 100}
    with pytest.raises(relational.SideTooLarge):
        relational.join(df, df.toDF("k"), F.col("id") == F.col("k"), strategy=strategy, **bounds)


def test_building_joins_runs_no_job(spark):
    sc = spark.sparkContext
    left = spark.range(0, 1000, numPartitions=60).withColumn("v", F.col("id") % 7)
    right = left.groupBy("v").count()
    sc.setJobGroup("planning", "no job may run here")
    try:
        for strategy in relational.STRATEGIES:
            relational.join(left, right, "v", strategy=strategy, max_nested_loop_bytes=1 << 60)
        assert list(sc.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_join_of_tables_that_share_every_name(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, name STRING")
    right = spark.createDataFrame([(1, "x"), (3, "y")], "id INT, name STRING")
    joined = relational.join_keys(left, right, "id", "id")
    got = joined.select(*relational.qualified("l", ["id", "name"]), F.col("r.name").alias("other"))
    assert rows(got) == [(1, "a", "x")]


def test_sorted_rows_of_a_hot_group(spark):
    df = spark.range(0, 6000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("g"), (F.col("id") * 37 % 1001).alias("v"))
    got = rows(relational.sorted_rows_by(df, "g", "v"))
    by = {}
    for g, v in rows(df):
        by.setdefault(g, []).append(v)
    want = [(g, i + 1, v) for g, vs in by.items() for i, v in enumerate(sorted(vs))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert rows(relational.sorted_rows_by(df.limit(0), "g", "v")) == []


def test_top_n_per_group_hot_group(spark):
    # one group holds most rows; the rank filter is a per-task limit before the shuffle
    df = spark.range(0, 5000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
        F.col("id").alias("v"))
    out = ranking.top_n_per_group(df, ["g"], [F.col("v").desc()], 2, "rank")
    got = sorted(rows(out))
    assert got == [("cold", 4980, 2), ("cold", 4990, 1), ("hot", 4998, 2), ("hot", 4999, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_load_json_with_schema(spark, tmp_path):
    p = tmp_path / "j" / "a.json"
    os.makedirs(p.parent)
    p.write_text("\n".join(json.dumps({"a": i, "b": str(i)}) for i in range(3)))
    df = load(spark, str(p.parent), "json", schema="a INT, b STRING")
    assert sorted(rows(df)) == [(0, "0"), (1, "1"), (2, "2")]
    with pytest.raises(ValueError):
        load(spark, str(p.parent), "xml")


def test_mean_and_sums(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 2.5), ("b", None)], "k STRING, v DOUBLE")
    assert dict(rows(relational.mean_by(df, ["k"], "v"))) == {"a": 1.875, "b": None}
    got = dict(rows(relational.sum_by(df, ["k"], "v", "s", money=True)))
    assert float(got["a"]) == 3.75 and got["b"] is None


def test_mean_of_large_integers(spark):
    df = spark.createDataFrame([("a", 2 ** 62)] * 3 + [("b", -5)], "k STRING, v LONG")
    assert dict(rows(relational.mean_by(df, ["k"], "v"))) == {"a": 2.0 ** 62, "b": -5.0}
