"""Functions over streamed groups, order over groups of any size, and states merged in a tree."""

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import grouped, relational, streams
from tessera.operators.quantiles import Quantiles
from tessera.plans import workbook


def batches(table: list[tuple], cuts: list[int]) -> list[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([pa.array([r[i] for r in table], t) for i, t in
                                        enumerate((pa.float64(), pa.string(), pa.int64()))], names=["a", "b", "v"])
    edges = [0, *sorted(cuts), len(table)]
    return [whole.slice(s, e - s) for s, e in zip(edges, edges[1:])]


KEYS = st.tuples(st.sampled_from([None, 0.0, 1.5, math.nan]), st.sampled_from([None, "", "x"]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=30), st.lists(st.integers(0, 30), max_size=5))
def test_pieces_at_every_cut(found, cuts):
    """Groups come whole and in order, wherever batches end; null equals null and NaN equals NaN."""
    found.sort(key=lambda r: repr(r[0]))
    table = [(*k, v) for k, v in found]
    got = {}
    for n, key, part in streams.pieces(batches(table, [c for c in cuts if c <= len(table)]), ["a", "b"]):
        got.setdefault((n, repr(key)), []).extend(part.column(2).to_pylist())
    want = {}
    for k, v in found:
        want.setdefault(repr(k), []).append(v)
    assert [(k[1], v) for k, v in got.items()] == list(want.items())


def test_state_machine_of_a_hot_key(spark):
    kinds = ["in", "x", "out", "in", "stop", None, "in", "in", "out"]
    df = spark.range(0, 90_000, numPartitions=7).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("k"), "id",
        F.get(F.array(*[F.lit(k) for k in kinds]), (F.col("id") * 7 % 9).cast("int")).alias("kind"))
    got = {r[0]: tuple(r[1:]) for r in rows(streams.stream_groups(
        df, ["k"], workbook.funnel("kind", "in", "out", "stop"), "k long, n long, f long, l long, b long", ["id"]))}
    want = {}
    for k, _, kind in sorted(rows(df), key=lambda r: r[1]):
        n, f, l, b, open_ = want.get(k, (0, 0, 0, 0, 0))
        open_ = 1 if kind == "in" else open_ and open_ + 1
        if open_ > 1 and kind in ("out", "stop"):
            f, l, b = (f + 1, max(l, open_), b) if kind == "out" else (f, l, b + 1)
            open_ = 0
        want[k] = (n + 1, f, l, b, open_)
    assert got == {k: v[:4] for k, v in want.items()} and None in got


def test_a_function_may_stop_early_and_emptiness(spark):
    df = spark.range(0, 5000, numPartitions=3).select((F.col("id") % 3).alias("k"), "id")

    def first(key, group):
        yield (*key, next(group).column(1)[0].as_py())

    assert sorted(rows(streams.stream_groups(df, ["k"], first, "k long, v long", ["id"]))) == [(0, 0), (1, 1), (2, 2)]
    assert rows(streams.stream_groups(df.limit(0), ["k"], first, "k long, v long", ["id"])) == []


def test_zeros_of_both_signs_are_one_key(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (math.nan, 3), (math.nan, 4)], "k DOUBLE, v INT").repartition(4)

    def total(key, group):
        yield (sum(sum(b.column(1).to_pylist()) for b in group),)

    assert sorted(rows(streams.stream_groups(df, ["k"], total, "v int"))) == [(3,), (7,)]


def test_equal_values_of_one_group_are_spread(spark):
    df = spark.range(0, 300_000, numPartitions=6).select(F.lit("g").alias("g"), F.lit(7).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else 3 MB are one task's work
    try:
        placed = streams.sorted_runs(df, [F.col("g"), F.col("v")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.select("run").distinct().count() >= 4
    assert placed.groupBy("run").count().agg(F.max("count")).first()[0] < 150_000
    got = relational.sorted_rows_by(df, "g", "v")
    assert got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first() == (1, 300_000, 300_000)


def test_numbered_with_clashing_names_and_null_groups(spark):
    df = spark.createDataFrame([(None, 3, "p"), ("a", 2, "q"), (None, 1, "r"), ("a", 2, "s"), ("b", None, "t")],
                               "_run STRING, _at INT, rows STRING")
    got = rows(streams.numbered(df, ["_run"], [F.col("_at"), F.col("rows")]))
    assert sorted(got, key=str) == sorted([(None, 1, "r", 1), (None, 3, "p", 2), ("a", 2, "q", 1), ("a", 2, "s", 2),
                                           ("b", None, "t", 1)], key=str)
    # no group: one order over the whole table
    assert [r[3] for r in sorted(rows(streams.numbered(df, [], [F.col("rows")])), key=lambda r: r[2])] == [1, 2, 3, 4, 5]


def test_a_hundred_thousand_states_of_one_key(spark):
    """The states of a hot key are merged over several levels, never all in one call."""
    def state(batches_):
        for b in batches_:
            yield pa.RecordBatch.from_arrays(
                [pa.array(["hot"] * b.num_rows), b.column(0),
                 pa.array([pickle.dumps((1, 1, i)) for i in b.column(0).to_pylist()], pa.binary())],
                names=["k", "node", "state"])

    states = spark.range(0, 100_000, numPartitions=8).mapInArrow(state, "k string, node long, state binary")

    def comb(a, b):  # (states, depth of the merge chain within one call, largest)
        return a[0] + b[0], a[1] + 1 if b[1] == 1 else max(a[1], b[1]), max(a[2], b[2])

    got = rows(grouped.merge_states(states, ["k"], comb, lambda s: [s], "n long, chain long, top long", fan=64))
    assert got[0][0] == "hot" and got[0][1] == 100_000 and got[0][2] <= 3 * 64 and got[0][3] == 99_999


def test_states_with_null_and_nan_keys_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (math.nan, 2.0), (math.nan, math.nan), (1.0, None)],
                               "k DOUBLE, v DOUBLE").repartition(3)

    def seq(state, batch):
        column = batch.column(0)
        odd = sum(v is not None and math.isnan(v) for v in column.to_pylist())
        return state[0] + column.null_count, state[1] + odd

    got = rows(grouped.aggregate_states(df, ["k"], ["v"], lambda: (0, 0), seq,
                                        lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: [s], "nulls long, nans long"))
    assert sorted(map(repr, got)) == sorted(map(repr, [(None, 1, 0), (math.nan, 0, 1), (1.0, 1, 0)]))


def test_mean_keeps_nan_and_null_apart(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", math.nan), ("a", 3.0), ("b", None), ("b", 4.0), ("c", None),
                                ("d", math.inf)], "k STRING, v DOUBLE").repartition(3)
    built_in, own = (dict(rows(f(df, "k", "v"))) for f in (workbook.mean_per_key, workbook.mean_per_key_accumulated))
    assert repr(sorted(built_in.items())) == repr(sorted(own.items())) and math.isnan(own["a"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(allow_nan=True, width=16), max_size=80), min_size=1, max_size=8),
       st.integers(2, 12), st.floats(0, 1))
def test_quantile_bound_holds(parts, size, q):
    summaries = [Quantiles(size).add(np.array(p, "float64")) for p in parts]
    whole = summaries[0]
    for s in summaries[1:]:
        whole = whole.merge(s)
    values = np.sort(np.array([v for p in parts for v in p], "float64"))
    assert whole.n == len(values)
    got = whole.at(q)
    if not len(values):
        return
    same = np.isnan(values) if math.isnan(got) else values == got
    assert same.any()
    below, upto = int(np.flatnonzero(same)[0]), int(np.flatnonzero(same)[-1]) + 1
    rank = max(1, math.ceil(q * whole.n))
    assert below + 1 - whole.error <= rank <= upto + whole.error
    levels = len(whole.levels)
    assert whole.error <= levels * whole.n / size


def test_quantiles_of_a_hot_key(spark):
    df = spark.range(0, 60_000, numPartitions=9).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 > 0, "cold").alias("k"),
        F.when(F.col("id") % 50 > 0, (F.col("id") * 7919 % 60_013).cast("double")).alias("v"))
    found = workbook.quantiles_per_key(df, "k", "v", [0.0, 0.25, 1.0], size=64)
    ranked = workbook.ranked_quantiles(df, "k", "v", found).collect()
    assert len(ranked) == 9 and all(r["within"] for r in ranked)
    assert all(r["error"] < 0.2 * r["n"] for r in ranked)
    nothing = df.where("v IS NULL")
    assert {r["value"] for r in workbook.quantiles_per_key(nothing, "k", "v", [0.5]).collect()} == {None}


def test_amounts_are_never_cut(spark):
    sales = spark.createDataFrame([(1, 3, 0.0000004)] * 10, "p INT, q INT, price DOUBLE")
    parts = spark.createDataFrame([(1, "x")], "p INT, cat STRING")
    with pytest.raises(Exception, match="not an amount of up to 6 decimals"):
        workbook.revenue_by_category(sales, parts, "p", "p", "q", "price", "cat", scale=6).collect()
    got = workbook.revenue_by_category(sales, parts, "p", "p", "q", "price", "cat", scale=6, digits=10)
    assert rows(got) == [("x", 0.000012)]
    with pytest.raises(Exception, match="not an amount"):
        relational.sum_by(sales, ["p"], "price", "s", money=True).collect()
    assert rows(relational.sum_by(sales.select("p", F.lit(None).cast("double").alias("v")), ["p"], "v", "s", money=True)) == [(1, None)]


def test_flat_join_never_loses_columns(spark):
    a = spark.createDataFrame([(1, "l")], "id INT, name STRING")
    b = spark.createDataFrame([(1, "r")], "id INT, name STRING")
    with pytest.raises(grouped.SharedColumns):
        grouped.reduce_side_join(a, b, "id", "id", nest=False)
    got = grouped.reduce_side_join(a, b.toDF("key", "other"), "id", "key", nest=False)
    assert got.columns == ["k", "id", "name", "key", "other"] and rows(got) == [(1, 1, "l", 1, "r")]


def test_pandas_comb_over_many_chunks(spark):
    df = spark.range(0, 3000, numPartitions=5).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    got = grouped.aggregate_by_key(
        df, ["k"], ["v"], lambda c: c.groupby("k", as_index=False).agg(s=("v", "sum")), "k long, s long",
        lambda states: pd.DataFrame({"s": [states["s"].sum()]}))
    assert sorted(rows(got)) == [(0, sum(range(0, 3000, 2))), (1, sum(range(1, 3000, 2)))]
