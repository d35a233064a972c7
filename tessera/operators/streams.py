"""Per-key functions over a stream of rows, and order over groups of any size (D-4, A9, O1-O4).

``stream_groups`` hands a function the rows of one key as an iterator of Arrow batches: Spark deals
the rows out by key and sorts within each partition, and a task cuts the batches that it gets at key
borders. A key may be longer than a batch or than memory; the function decides what it holds.

``sorted_runs`` spreads even one key over many tasks: rows are range-partitioned on keys, order and a
number of their own, so neither a hot key nor a value that repeats has to fit one task. The sorted rows
are written with the ``run`` (the task that sorted them) and their place; ``numbered`` makes positions of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.session import scratch_path, ship_package

OUT_ROWS = 4096        # rows of a result batch
OUT_CHARS = 8 << 20    # characters of text after which a result batch ends sooner
MAX_HELD = 1_000_000   # rows of the held side of one key in a cogroup

GroupFn = Callable[[tuple, Iterator[pa.RecordBatch]], Iterable[tuple]]


class HeldTooLarge(ValueError):
    """The side that a cogroup holds has more rows of one key than its bound."""


def free_name(wanted: str, *taken: Iterable[str]) -> str:
    """``wanted``, with underscores behind it until no column has the name (case ignored, as in SQL)."""
    names = {n.lower() for group in taken for n in group}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


# -- cutting batches at key borders ----------------------------------------------------------------

def _differs(column: pa.Array) -> pa.Array:
    """For every row but the first: whether its key value differs from the row before (nulls are
    equal to nulls, NaN to NaN)."""
    after, before = column.slice(1), column.slice(0, len(column) - 1)
    out = pc.fill_null(pc.not_equal(after, before), False)
    if pa.types.is_floating(column.type):
        both = pc.fill_null(pc.and_(pc.is_nan(after), pc.is_nan(before)), False)
        out = pc.and_(out, pc.invert(both))
    return pc.or_(out, pc.xor(pc.is_null(after), pc.is_null(before)))


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def pieces(batches: Iterable[pa.RecordBatch], keys: Sequence[str]
           ) -> Iterator[tuple[int, tuple, pa.RecordBatch]]:
    """(number of the group, its key, a slice of its rows) of rows that come sorted by ``keys``."""
    group, last = -1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        starts = [0]
        if batch.num_rows > 1 and columns:
            differs = _differs(columns[0])
            for column in columns[1:]:
                differs = pc.or_(differs, _differs(column))
            starts += [i + 1 for i in pc.indices_nonzero(differs).to_pylist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(c[start].as_py() for c in columns)
            if last is None or not _same(key, last):
                group, last = group + 1, key
            yield group, last, batch.slice(start, end - start)


def packed(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of bounded size."""
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= OUT_ROWS or chars >= OUT_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def arrow_schema(schema: T.StructType | str) -> pa.Schema:
    return to_arrow_schema(schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema))


# -- functions over groups ---------------------------------------------------------------------------

def stream_sorted(df: DataFrame, keys: Sequence[str], fn: GroupFn, schema: T.StructType | str) -> DataFrame:
    """``fn(key, batches)`` for every run of equal keys in partitions that are sorted by ``keys``; it
    yields row tuples of ``schema``, and what it leaves of ``batches`` is passed over."""
    ship_package(df.sparkSession)
    names, out = list(keys), arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, members in itertools.groupby(pieces(batches, names), key=lambda p: p[0]):
                first = next(members)
                yield from fn(first[1], itertools.chain([first[2]], (m[2] for m in members)))
        yield from packed(rows(), out)

    return df.mapInArrow(run, schema)


def stream_groups(df: DataFrame, keys: Sequence[str], fn: GroupFn, schema: T.StructType | str,
                  order: Sequence[str | Column] = ()) -> DataFrame:
    """``fn(key, batches)`` once per key of ``df`` (D-4): all rows of the key, sorted by ``order``, as Arrow
    batches that are read as the function asks for them.

    Only what ``fn`` keeps is held, whatever the size of the key; rows of ``df`` are shuffled once and
    sorted by Spark, which spills. Null keys are a group. An empty table calls nothing. One key's rows pass
    through one task, one after another, as their order demands; work that can be merged from
    parts belongs in ``sorted_runs`` or in ``grouped.aggregate_states``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    # a hash takes -0.0 and 0.0 apart though they are one key
    dealt = [F.col(f"`{k}`") + F.lit(0).cast(kinds[k]) if isinstance(kinds[k], (T.DoubleType, T.FloatType))
             else F.col(f"`{k}`") for k in keys]
    rows = df.repartition(*dealt).sortWithinPartitions(*[F.col(f"`{k}`") for k in keys], *order)
    return stream_sorted(rows, keys, fn, schema)


def stream_cogroup(held: DataFrame, streamed: DataFrame, held_key: str, streamed_key: str,
                   fn: Callable[[object, list[dict], Iterator[pa.RecordBatch]], Iterable[tuple]],
                   schema: T.StructType | str, max_held: int = MAX_HELD, spread: int = 1) -> DataFrame:
    """``fn(key, rows, batches)`` per key of two tables (D-4): the rows of ``held`` as dicts and those of
    ``streamed`` as Arrow batches with its columns, for keys that ``held`` has (``batches`` may be empty).

    More than ``max_held`` rows of one key on the held side raise ``HeldTooLarge``. With ``spread`` over 1
    a key's streamed rows are dealt to that many groups by a hash of the row, each with all held rows: for
    functions that look at one streamed row at a time. Null keys match nothing. The
    columns of the sides may share names."""
    key_type = held.schema[held_key].dataType
    row_types = [T.StructType([T.StructField(f.name, f.dataType) for f in side.schema.fields])
                 for side in (held, streamed)]

    def tagged(df: DataFrame, key: str, side: int, salt: Column) -> DataFrame:
        rows = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        mine = [rows if i == side else F.lit(None).cast(row_types[i]) for i in (0, 1)]
        return df.where(F.col(f"`{key}`").isNotNull()).select(
            F.col(f"`{key}`").cast(key_type).alias("key"), salt.alias("salt"), F.lit(side).alias("side"),
            mine[0].alias("held"), mine[1].alias("streamed"))

    both = tagged(held, held_key, 0, F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).union(
        tagged(streamed, streamed_key, 1, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in streamed.columns]),
                                                 F.lit(spread)).cast("int")))

    def call(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows: list[dict] = []
        rest: Iterator[pa.RecordBatch] = iter(())
        for batch in batches:
            sides = batch.column(batch.schema.get_field_index("side")).to_numpy(zero_copy_only=False)
            cut = int((sides == 0).sum())
            rows += batch.column(batch.schema.get_field_index("held")).slice(0, cut).to_pylist()
            if len(rows) > max_held:
                raise HeldTooLarge(f"key {key[0]!r}: more than {max_held} rows on the held side")
            if cut < batch.num_rows:
                rest = itertools.chain([batch.slice(cut)], batches)
                break
        if rows:
            yield from fn(key[0], rows, map(_unnested, rest))

    return stream_groups(both, ["key", "salt"], call, schema, ["side"])


def _unnested(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = batch.column(batch.schema.get_field_index("streamed"))
    return pa.RecordBatch.from_arrays(rows.flatten(), names=[rows.type.field(i).name
                                                             for i in range(rows.type.num_fields)])


# -- order over groups of any size ---------------------------------------------------------------------

def sorted_runs(df: DataFrame, order: Sequence[Column], run: str = "run", at: str = "at") -> DataFrame:
    """``df`` in the order of ``order``, written to the shared folder with the columns ``run`` (the task that
    sorted the row; runs follow each other in order) and ``at`` (a number that rises along the order).

    A number of the row's own ends the range key, so equal rows spread over tasks too; they
    follow each other in any order. The table is written because a second sort may draw other borders."""
    own = free_name("_own", df.columns, [run, at])
    path = scratch_path(df.sparkSession, "runs")
    # the number is the row's place in its input task: the same when that task runs again
    keyed = df.withColumn(own, F.monotonically_increasing_id())
    placed = (keyed.repartitionByRange(*order, F.col(own)).sortWithinPartitions(*order, F.col(own))
              .select(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id().alias(run),
                      F.monotonically_increasing_id().alias(at)))
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column], position: str = "position"
             ) -> DataFrame:
    """``df`` with each row's place, from 1, within its group in the order of ``order``; null groups count as
    groups. Only the counts of each (run, group) meet, never the rows of a group."""
    run, at = (free_name(n, df.columns, [position]) for n in ("_run", "_at"))
    runs = sorted_runs(df, [*[F.col(f"`{g}`") for g in groups], *order], run, at)
    names = [f"g{i}" for i in range(len(groups))]
    counts = runs.groupBy(*[F.col(f"`{g}`").alias(n) for g, n in zip(groups, names)], F.col(run).alias("run")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(at).alias("first"))
    before = Window.partitionBy(*names).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    same = F.col(f"l.`{run}`") == F.col("r.run")
    for g, n in zip(groups, names):
        same &= F.col(f"l.`{g}`").eqNullSafe(F.col(f"r.{n}"))
    return runs.alias("l").join(starts.alias("r"), same).select(
        *[F.col(f"l.`{c}`").alias(c) for c in df.columns],
        (F.col("r.before") + F.col(f"l.`{at}`") - F.col("r.first") + 1).alias(position))
