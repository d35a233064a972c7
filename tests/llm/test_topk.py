"""Exact top-k search against plain loops."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import topk

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, row INT, `_k` STRING"


def plain(rows, k=5, every=50, scale=256):
    """(query_id, rank, vec_id, score) with row identity; rows are (vec_id, vector, ...)."""
    whole = [(i, r[0], [math.floor(float(np.float32(x)) * scale) for x in r[1]]) for i, r in enumerate(rows)
             if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, query, a in whole:
        if query is None or query % every:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b)), doc is None, doc or 0, j) for j, doc, b in whole if j != i)
        out += [(query, rank, None if null else doc, -score) for rank, (score, null, doc, _) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def searched(spark, rows, partitions=3, **more):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in topk.nearest(df, **more).select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_nulls_repeats_ties_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (50, [0.25, -1.0]), (None, [1.0, 0.5]), (None, [1.0, 0.5]), (3, [1.0, 0.5]),
            (4, None), (5, [None, 1.0]), (100, [nan, 1.0]), (6, [inf, 0.0]), (150, [-inf]), (200, []), (7, [0.5]),
            (8, [0.001, 0.002, 9.0]), (-50, [-0.001, 0.0])]
    got = searched(spark, rows)
    assert got == plain(rows) and {g[0] for g in got} == {0, 50, 200, -50}
    assert searched(spark, rows, k=100) == plain(rows, k=100)  # fewer rows than k
    assert searched(spark, rows[:1]) == []                     # nothing but the query
    assert searched(spark, []) == []
    assert searched(spark, [(1, [1.0])]) == []                 # no query


def test_one_vector_in_a_third_of_the_rows(spark):
    rng = random.Random(5)
    rows = [(i, [0.5] * 8 if i % 3 else [rng.uniform(-1, 1) for _ in range(8)]) for i in range(600)]
    assert searched(spark, rows, partitions=5) == plain(rows)


@pytest.mark.parametrize("limits", [{"BLOCK_ROWS": 4, "QUERY_ROWS": 2, "AT_ONCE": 1}, {"BLOCK_ROWS": 7, "QUERY_ROWS": 3}])
def test_blocks_of_any_size(spark, limits):
    rng = random.Random(9)
    rows = [(i * 10, [rng.choice([0.0, 0.0, 0.5, -0.25]) for _ in range(rng.choice([5, 6]))]) for i in range(40)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(2)
    path = topk.indexed(df, "vec_id", "embedding", rows=limits["BLOCK_ROWS"])
    queries = topk.query_blocks(spark.read.schema(topk.BLOCKS).parquet(path), rows=limits["QUERY_ROWS"])
    got = [tuple(r) for r in topk.search(path, queries).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got, key=str) == plain(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=30), st.integers(0, 6), st.integers(-1, 29))
def test_partition_selection(scores, k, own):
    own = own if 0 <= own < len(scores) else None
    want = sorted((-s, i) for i, s in enumerate(scores) if i != own)[:k]
    assert topk.best(np.array(scores), k, own) == [i for _, i in want]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-2**33, 2**33) | st.just(0), max_size=4), min_size=1, max_size=6),
       st.lists(st.lists(st.integers(-2, 2), max_size=5), min_size=1, max_size=4))
def test_scatter_equals_products(docs, queries):
    def rows(vectors):
        flat = np.array([x for v in vectors for x in v], "int64")
        return topk.Rows(np.arange(len(vectors)), list(range(len(vectors))), np.array([len(v) for v in vectors]), flat)
    got = topk.Postings(rows(docs)).scores(rows(queries))
    assert got.tolist() == [[sum(a * b for a, b in zip(q, d)) for d in docs] for q in queries]


def test_scores_beyond_64_bits_are_an_error():
    big = topk.Rows(np.arange(1), [1], np.array([1]), np.array([2 ** 40], "int64"))
    with pytest.raises(topk.ScoreTooLarge):
        topk.Postings(big).scores(big)
    with pytest.raises(topk.ScoreTooLarge):
        topk.whole_numbers(np.array([1e300]), 256)


def test_a_block_keeps_null_ids():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[1, 2]]), pa.array([[None, 9]], pa.list_(pa.int64())), pa.array([[1, 0]], pa.list_(pa.int32())),
         pa.array([[5]], pa.list_(pa.int64()))], names=["rows", "ids", "sizes", "terms"])
    block = topk.Rows.of(batch)
    assert block.ids == [None, 9] and block.table.tolist() == [[5], [0]]
