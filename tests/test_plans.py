"""Physical-plan checks: the plans we rely on at scale are the plans Spark actually picks."""

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from tessera.operators import relational
from tessera.plans import registry

SF = f"{TESTDATA}/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bottom_k_is_bounded_heap(spark):
    p = plan(registry.QUERIES["bottom_k"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_scan_is_pruned_and_filter_pushed(spark):
    df = registry.QUERIES["top_k_in_dim"](spark, SF)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(n_name), EqualTo(n_name,NATION_3)" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double>" \
        in p
    hv = plan(registry.QUERIES["high_value"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double," \
        "l_extendedprice:double>" in hv


def test_aggregates_are_partial_before_shuffle(spark):
    p = plan(registry.QUERIES["revenue_by_category"](spark, SF))
    assert p.count("HashAggregate") >= 4  # partial + final, per product then per category
    p = plan(registry.QUERIES["word_count"](spark, SF))
    assert "partial_count" in p


def test_window_group_limit(spark):
    p = plan(registry.QUERIES["top_months_per_year"](spark, SF))
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("strategy,node", [("broadcast", "BroadcastHashJoin"),
                                           ("merge", "SortMergeJoin"),
                                           ("shuffle_hash", "ShuffledHashJoin"),
                                           ("shuffle_replicate_nl", "CartesianProduct")])
def test_join_hints(spark, strategy, node):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    n = spark.read.parquet(f"{SF}/nation.parquet")
    df = relational.join(c, n, F.col("c_nationkey") == F.col("n_nationkey"), "inner", strategy)
    assert node in plan(df)


@pytest.fixture()
def large_sides(spark):
    """Both sides planned as if too large to be copied."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_intersect_is_one_aggregate(spark, large_sides):
    p = plan(registry.QUERIES["intersect_keys"](spark, SF))
    assert "Join" not in p and "partial_bit_or" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_shuffle_hash_hashes_the_small_side(spark, large_sides):
    assert "BuildRight" in plan(registry.QUERIES["join_shuffle_hash"](spark, SF))
    assert "BuildRight" in plan(registry.QUERIES["join_shuffle_hash_sql"](spark, SF))


def test_revenue_joins_one_row_per_product(spark, large_sides):
    p = plan(registry.QUERIES["revenue_by_category"](spark, SF))
    assert p.count("Exchange hashpartitioning") == 3  # per product, its join side, per category


def test_appended_files_are_seen(spark, scratch):
    path = scratch("sf")
    spark.range(10).select(F.col("id").alias("p_partkey")).write.parquet(f"{path}/part.parquet")
    assert registry.QUERIES["global_sum"](spark, path).first()[0] == 45
    spark.range(10, 15).select(F.col("id").alias("p_partkey")).write.mode("append").parquet(f"{path}/part.parquet")
    assert registry.QUERIES["global_sum"](spark, path).first()[0] == 105


def test_accumulated_mean_has_no_grouped_python_aggregate(spark):
    p = plan(registry.QUERIES["grouped_udf_mean"](spark, SF))
    assert "MapInPandas" in p and "AggregateInPandas" not in p and "partial_sum" in p


PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapCoGroupsInPandas",
                "AggregateInPandas", "FlatMapGroupsInPandas", "WindowInPandas")
UDF_TWINS = {"yearly_income_udf", "share_by_part_of_day_udf", "grouped_udf_mean", "quantiles_per_key",
             "funnels_per_user", "exchanges_per_conversation", "csv_text_round_trip", "geojson_documents",
             "cogroup_udf_join"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_plan_lint(spark, name):
    p = plan(registry.QUERIES[name](spark, SF))
    # no row-at-a-time Python, and no Python call that receives a whole group
    assert "BatchEvalPython" not in p
    assert "AggregateInPandas" not in p and "FlatMapGroupsInPandas" not in p
    if name not in UDF_TWINS:
        assert not any(node in p for node in PYTHON_NODES), name
    # nested loops only where a bounded nested loop was requested explicitly
    assert "BroadcastNestedLoopJoin" not in p
    if name not in ("join_shuffle_nl", "join_shuffle_nl_sql"):
        assert "CartesianProduct" not in p


@pytest.mark.parametrize("strategy,node", [("broadcast", "BroadcastHashJoin"),
                                           ("merge", "SortMergeJoin"),
                                           ("shuffle_hash", "ShuffledHashJoin"),
                                           ("shuffle_replicate_nl", "CartesianProduct")])
def test_sql_join_hints(spark, strategy, node):
    from tessera.plans import payroll
    c = spark.read.parquet(f"{SF}/customer.parquet")
    n = spark.read.parquet(f"{SF}/nation.parquet")
    df = payroll.count_per_dimension_sql(spark, c, n, "c_nationkey", "n_nationkey", "n_name",
                                         strategy)
    assert node in plan(df)
    assert sorted(r[1] for r in df.collect()) == sorted(
        r[1] for r in payroll.count_per_dimension(c, n, "c_nationkey", "n_nationkey",
                                                  "n_name").collect())
