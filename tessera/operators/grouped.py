"""Custom per-key computations (D-3, J6); functions over the rows of a key are in ``streams`` (D-4).

A custom aggregate runs its ``seq`` step inside each task, with no shuffle of raw rows, and merges the
states of a key in a tree: at most ``fan`` of them, or of what they have been merged to, meet in one
call, so the states of a key that every task holds are merged by many tasks.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import streams
from tessera.session import scratch_path, ship_package

FLUSH_ROWS = 200_000  # partial-state rows held per task before they are emitted
HELD_KEYS = 50_000    # keys whose states a task holds before they are emitted
FAN = 64              # states that are merged in one call
COMBINERS = {"sum": F.sum, "min": F.min, "max": F.max}


# -- states of any kind --------------------------------------------------------------------------------

def aggregate_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str], zero: Callable[[], Any],
                     seq: Callable[[Any, pa.RecordBatch], Any], comb: Callable[[Any, Any], Any],
                     finish: Callable[[Any], Iterable[tuple]], schema: str, fan: int = FAN) -> DataFrame:
    """Aggregate with a zero / seqOp / combOp contract over states that are any picklable object (D-3).

    ``seq(state, batch)`` adds the rows of one key, an Arrow batch of ``columns`` in which null and NaN are
    what they were; ``comb(a, b)`` makes one state of two; ``finish(state)`` yields the row tuples of
    ``schema`` (DDL) that follow the key in the result. ``comb`` must not depend on order or grouping.

    A task holds the states of up to ``HELD_KEYS`` keys and emits them when there are more. Null keys
    are a key; a table without rows has no keys. States are merged by ``merge_states``."""
    keys, columns = list(keys), list(columns)
    ship_package(df.sparkSession)
    names = [f"k{i}" for i in range(len(keys))]
    fields = [df.schema[k] for k in keys]
    key_schema = [T.StructField(n, f.dataType) for n, f in zip(names, fields)]
    schema_out = T.StructType([*key_schema, T.StructField("node", T.LongType()), T.StructField("state", T.BinaryType())])
    arrow_out = streams.arrow_schema(schema_out)
    width = len(keys)

    def per_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId()

        def states() -> Iterator[tuple]:
            held: dict[tuple, Any] = {}
            for batch in batches:
                for key, rows in by_key(batch, width):
                    name = tuple("nan" if v != v else (v,) for v in key)
                    if name not in held:
                        held[name] = (key, zero())
                    held[name] = (key, seq(held[name][1], rows))
                if len(held) > HELD_KEYS:
                    yield from ((*key, node, pickle.dumps(state)) for key, state in held.values())
                    held = {}
            yield from ((*key, node, pickle.dumps(state)) for key, state in held.values())

        yield from streams.packed(states(), arrow_out)

    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)],
                     *[F.col(f"`{c}`") for c in columns])
    merged = merge_states(rows.mapInArrow(per_task, schema_out), names, comb, finish, schema, fan)
    return merged.select(*[F.col(n).alias(k) for n, k in zip(names, keys)],
                         *T.StructType.fromDDL(schema).fieldNames())


def by_key(batch: pa.RecordBatch, width: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of a batch by its first ``width`` columns, as batches of the other columns."""
    if not batch.num_rows:
        return
    codes = np.zeros(batch.num_rows, "int64")
    for i in range(width):
        mine = pc.dictionary_encode(batch.column(i), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        codes = np.unique(codes * (int(mine.max()) + 1) + mine, return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(codes[order])) + 1).tolist(), batch.num_rows]
    dealt = batch.take(pa.array(order))
    rest = dealt.select(list(range(width, batch.num_columns)))
    for start, end in itertools.pairwise(cuts):
        yield tuple(dealt.column(i)[start].as_py() for i in range(width)), rest.slice(start, end - start)


def merge_states(states: DataFrame, keys: Sequence[str], comb: Callable[[Any, Any], Any],
                 finish: Callable[[Any], Iterable[tuple]], schema: str, fan: int = FAN) -> DataFrame:
    """One state of each key's pickled ``state`` rows, finished; ``node`` numbers say which may be
    merged first (all of one number, then ``fan`` neighbours, and so on).

    Every level is a shuffle of one state per (key, node); levels follow the logarithm of the number of
    nodes. Between levels the states are written, so that a lost executor costs one level."""
    spark, keys = states.sparkSession, list(keys)
    kinds = [T.StructField(k, states.schema[k].dataType) for k in keys]
    level_schema = T.StructType([*kinds, T.StructField("node", T.LongType()), T.StructField("state", T.BinaryType())])
    out = T.StructType([*kinds, *T.StructType.fromDDL(schema).fields])

    def fold(batches: Iterator[pa.RecordBatch]) -> Any:
        loaded = (pickle.loads(s) for b in batches for s in b.column(b.schema.get_field_index("state")).to_pylist())
        state = next(loaded)
        for other in loaded:
            state = comb(state, other)
        return state

    def up(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        yield (*key, pickle.dumps(fold(batches)))

    def top(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for row in finish(fold(batches)):
            yield (*key, *row)

    level = states.select(*keys, "node", "state")
    while True:
        path = scratch_path(spark, "states")
        level.write.parquet(path)
        level = spark.read.schema(level_schema).parquet(path)
        nodes = level.agg(F.max("node")).first()[0]
        if nodes is None or nodes < fan:
            return streams.stream_groups(level, keys, top, out)
        level = streams.stream_groups(level.withColumn("node", F.floor(F.col("node") / fan)),
                                      [*keys, "node"], up, level_schema)


# -- states as columns -----------------------------------------------------------------------------------

def aggregate_by_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     seq: Callable[[pd.DataFrame], pd.DataFrame], state_schema: str,
                     comb: dict[str, str] | Callable[[pd.DataFrame], pd.DataFrame],
                     finish: Sequence[Column] | None = None) -> DataFrame:
    """Aggregate with states that are rows of columns (D-3, A8).

    * ``seq(chunk)`` gets a pandas chunk (``keys + columns``) and returns one state row per key
      (columns of ``state_schema``: the keys, then the state fields). pandas takes nulls for NaN; a ``seq``
      that must tell them apart gets a flag column beside the value.
    * ``comb`` says how states merge. Either per state field ``sum`` / ``min`` / ``max``, applied with Spark's
      partial + final aggregation, or any pandas function taking several state rows of one key and
      returning one, which runs inside each task and then over the tree of ``merge_states``.
    * ``finish`` are output expressions over the keys and merged state fields.
    """
    keys = list(keys)
    ship_package(df.sparkSession)
    rows = df.select(*keys, *columns)
    if not callable(comb):
        partial = rows.mapInPandas(lambda chunks: (seq(c) for c in chunks if len(c)), state_schema)
        merged = partial.groupBy(*keys).agg(*[COMBINERS[v](c).alias(c) for c, v in comb.items()])
        return merged if finish is None else merged.select(*keys, *finish)

    fields = [f for f in T.StructType.fromDDL(state_schema).fields if f.name not in keys]
    names = [f.name for f in fields]

    def add(state: list[pd.DataFrame], batch: pa.RecordBatch) -> list[pd.DataFrame]:
        mine = pa.RecordBatch.from_arrays(batch.columns, names=[*keys, *columns])
        state = [*state, seq(mine.to_pandas())[names]]
        return state if sum(map(len, state)) < 64 else one(state)

    def one(state: list[pd.DataFrame]) -> list[pd.DataFrame]:
        together = pd.concat(state, ignore_index=True)
        return [comb(together) if len(together) > 1 else together]

    def last(state: list[pd.DataFrame]) -> Iterator[tuple]:
        yield from one(state)[0][names].itertuples(index=False, name=None)

    # the keys go along as columns too, since ``seq`` groups by them
    copies = [streams.free_name(f"key_{k}", df.columns) for k in keys]
    keyed = df.select(*[F.col(f"`{k}`").alias(c) for k, c in zip(keys, copies)], *keys, *columns)
    merged = aggregate_states(keyed, copies, [*keys, *columns], list, add, lambda a, b: one(a + b), last,
                              ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
    merged = merged.select(*[F.col(c).alias(k) for c, k in zip(copies, keys)], *names)
    return merged if finish is None else merged.select(*keys, *finish)


# -- reduce-side join --------------------------------------------------------------------------------------

class SharedColumns(ValueError):
    """The flat form of a join would have to drop one of two columns of the same name."""


def reduce_side_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     key_alias: str = "k", nest: bool = True) -> DataFrame:
    """The tag / union / group / pair-up join, expressed as a sort-merge join.

    Same rows as building per-key lists and pairing them, without holding any key's list in
    memory (the merge streams both sorted sides; AQE splits skewed keys). The shape
    ``(k, left_row, right_row)`` is kept with ``nest=True``; ``nest=False`` flattens it to all columns of
    both sides, which must not share names (``SharedColumns``), the key's alias included; only a right key
    of the left key's name, which holds the same value, is not repeated."""
    joined = left.alias("l").hint("merge").join(
        right.alias("r"), F.col(f"l.`{left_key}`") == F.col(f"r.`{right_key}`"), "inner")
    if nest:
        return joined.select(F.col(f"l.`{left_key}`").alias(key_alias),
                             F.struct(*[F.col(f"l.`{c}`") for c in left.columns]).alias("left"),
                             F.struct(*[F.col(f"r.`{c}`") for c in right.columns]).alias("right"))
    others = [c for c in right.columns if not c == left_key == right_key]
    every = [c.lower() for c in (key_alias, *left.columns, *others)]
    shared = sorted({c for c in every if every.count(c) > 1})
    if shared:
        raise SharedColumns(f"columns {shared} are on both sides; rename them or ask for the nested form")
    return joined.select(F.col(f"l.`{left_key}`").alias(key_alias),
                         *[F.col(f"l.`{c}`").alias(c) for c in left.columns],
                         *[F.col(f"r.`{c}`").alias(c) for c in others])
