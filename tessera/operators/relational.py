"""Projection, filter, join and aggregation operators (P*, F*, J*, A*).

Joins leave the strategy to Catalyst + AQE by default: AQE re-plans a sort-merge join into a
broadcast join only after it has *measured* the materialised side. An explicit strategy is a
request and is honoured as given or refused with an error; it is never replaced. Sizes come from
the optimizer's statistics, in bytes, while the plan is built; a side that these call too large is measured.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import sorted_values
from tessera.operators import streams
from tessera.session import scratch_path

MAX_BROADCAST_BYTES = 512 << 20    # estimated size up to which an explicit broadcast is made
MAX_NESTED_LOOP_BYTES = 16 << 20   # the same for the replicated side of a nested loop
STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")


class SideTooLarge(ValueError):
    """A side that a strategy would copy to every task is larger than its bound."""


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- projections ---------------------------------------------------------------------------------

def with_product(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """P5: a derived ``a * b`` column."""
    return df.withColumn(name, F.col(a) * F.col(b))


# -- size estimates ------------------------------------------------------------------------------

def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (from file sizes and plan statistics; planning only,
    no job). An unknown size, or one that the session cannot tell, is estimated as very large."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # a session without a JVM beside it
        return 1 << 62


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """About the bytes of a value in memory: 8 of its slot, and what it holds beside."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        more = F.octet_length(value).cast("long")
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        more = F.octet_length(F.to_json(F.struct(value))).cast("long")
    elif isinstance(kind, T.DecimalType) and kind.precision > 18:
        more = F.lit(16).cast("long")
    else:
        return F.lit(8).cast("long")
    return F.coalesce(more, F.lit(0)) + 8


def measured_bytes(df: DataFrame) -> int:
    """About the bytes that the rows of ``df`` take in memory, counted by a job that reads them and keeps none."""
    row = functools.reduce(lambda a, b: a + b, (_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields),
                           F.lit(16).cast("long"))
    return int(df.agg(F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0))).first()[0])


def check_strategy(copied: DataFrame, strategy: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                   max_nested_loop_bytes: int = MAX_NESTED_LOOP_BYTES, keep: bool = False) -> DataFrame:
    """The side that a copying strategy may copy, or ``SideTooLarge``.

    A side that is estimated within the bound is taken as it is, and no job runs. An estimate knows neither filters
    nor groups, so a side above it is measured: one that is really small is written once, and that table, whose
    size is known, is what the join copies. With ``keep`` it is only measured: a join condition may name columns
    of the side itself."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}")
    bound = {"broadcast": max_broadcast_bytes, "shuffle_replicate_nl": max_nested_loop_bytes}.get(strategy)
    if bound is None or estimated_bytes(copied) <= bound:
        return copied
    size = measured_bytes(copied)
    if size > bound:
        raise SideTooLarge(f"{strategy} join: the copied side takes {size} bytes, the bound is "
                           f"{bound}; ask for 'merge', 'shuffle_hash' or 'auto' instead")
    if keep:
        return copied
    path = scratch_path(copied.sparkSession, "side")
    copied.write.parquet(path)
    return copied.sparkSession.read.schema(copied.schema).parquet(path)


# -- filters ---------------------------------------------------------------------------------------

def drop_unparsed(df: DataFrame, col: str, observation=None) -> DataFrame:
    """drop rows whose cleaned/parsed ``col`` is null, and count them.

    The ``rows`` / ``dropped`` counts go to ``observation`` (an ``Observation`` or a name). The
    observed metric also sits between the projection that computes ``col`` and the filter, so
    Catalyst does not push the filter -- and with it a second evaluation of the whole parsing
    expression -- down into the scan: each row is parsed once."""
    name = observation or f"unparsed_{col}_{uuid.uuid4().hex[:8]}"
    observed = df.observe(name, F.count(F.lit(1)).alias("rows"),
                          F.count_if(F.col(col).isNull()).alias("dropped"))
    return observed.where(F.col(col).isNotNull())


# -- joins -----------------------------------------------------------------------------------------

def join(left: DataFrame, right: DataFrame, on, how: str = "inner", strategy: str = "auto",
         max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
         max_nested_loop_bytes: int = MAX_NESTED_LOOP_BYTES) -> DataFrame:
    """Join with an optional strategy request (J1-J11); ``right`` is the smaller side.

    ``on`` is a column name, a list of names, or a join condition. ``strategy``:

    * ``auto`` -- Catalyst/AQE decide (broadcast only under the measured-size threshold)
    * ``broadcast`` -- copy ``right`` to every executor
    * ``merge`` -- shuffle and sort both sides on the key
    * ``shuffle_hash`` -- shuffle both sides on the key, hash ``right``
    * ``shuffle_replicate_nl`` -- nested loop over all pairs of partitions: a cross join with a
      condition, made only because it was asked for

    ``SideTooLarge`` is raised when ``right`` is above the bound of a copying strategy (see ``check_strategy``)."""
    right = check_strategy(right, strategy, max_broadcast_bytes, max_nested_loop_bytes, keep=isinstance(on, Column))
    return left.join(right if strategy == "auto" else right.hint(strategy), on, how)


def join_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
              strategy: str = "auto", **bounds) -> DataFrame:
    """Equi join of two tables whose columns may share names (J1, J4, P2): the sides are aliased
    ``l`` and ``r``, so every column stays reachable as ``l.name`` or ``r.name``."""
    on = F.col(f"l.`{left_key}`") == F.col(f"r.`{right_key}`")
    right = check_strategy(right, strategy, **bounds).alias("r")
    return left.alias("l").join(right if strategy == "auto" else right.hint(strategy), on, how)


def qualified(side: str, cols: Sequence[str]) -> list[Column]:
    """Columns of one side of ``join_keys`` under their plain names."""
    return [F.col(f"{side}.`{c}`").alias(c) for c in cols]


def join_filtered_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                      dim_filter: Column, how: str = "inner") -> DataFrame:
    """Filter the dimension, then join (sides ``l`` and ``r``, see ``join_keys``)."""
    return join_keys(fact, dim.where(dim_filter), fact_key, dim_key, how)


def _band(value: Column, width: float) -> Column:
    """The number of the band that a value lies in: never less for a greater value, NaN being the greatest."""
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(F.floor(value.cast("double") / F.lit(float(width))))


def theta_join(left: DataFrame, right: DataFrame, condition: Callable[[str, str], Column], cells: int = 256,
               shape: tuple[int, int] | None = None,
               band: tuple[Column, Column, Column, float] | None = None) -> DataFrame:
    """Inner join under any condition (J11), by a matrix over the space of pairs: sides ``l`` and ``r``, as in
    ``join_keys``; ``condition`` is made of the two aliases, e.g. ``lambda l, r: F.col(f"{l}.a") < F.col(f"{r}.b")``.

    A left row goes to one random row of the matrix and is copied to all its cells, a right row to one random
    column; so every pair of rows meets in exactly one cell, cells hold equal shares whatever the values, and a
    side is copied about the square root of ``cells`` times. ``shape`` (rows, columns) sets the matrix: (n, 1) copies
    only the right side. The cell is an equi-join key, so Spark joins by sort or hash and tests the condition on the
    pairs of a cell; no cartesian product is planned. Equal rows are dealt apart, and the same way when a
    task runs again.

    All pairs are tested, so the work is the product of the sides. ``band`` (value, low, high, width) is for a
    condition that holds only where a number of the left row lies from ``low`` to ``high``, both of the right row and
    in the units of the condition: the numbers are cut into bands of ``width``, a left row is in the band of its value,
    a right row is copied to those from ``low`` to ``high`` (so these lie some widths apart at most), and only
    rows of the same band and cell are tested. The matrix still deals out a band that holds most of the rows."""
    rows, columns = shape or (max(1, round(cells ** 0.5)),) * 2

    def dealt(df: DataFrame, own: int, other: int, cell: Column, names: tuple[str, str], bands: Column) -> DataFrame:
        place = F.pmod(F.xxhash64(F.monotonically_increasing_id(), *[F.col(f"`{c}`") for c in df.columns]), F.lit(own))
        return (df.withColumns({names[0]: place.cast("int"), part: bands})
                .withColumn(part, F.explode(part))
                .withColumn(names[1], F.explode(F.sequence(F.lit(0), F.lit(other - 1))))
                .select(*[F.col(f"`{c}`") for c in df.columns], F.col(part), cell.alias(key))
                .repartition(tasks, part, key))

    a, b, part, key = (streams.free_name(n, left.columns, right.columns) for n in ("_row", "_column", "_band", "_cell"))
    cell = F.col(a) * columns + F.col(b)
    # a fixed number of tasks: the bytes of the sides say little of their pairs
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = reach = F.array(F.lit(0).cast("long"))
    if band:
        value, low, high, width = band
        own, reach = F.array(_band(value, width)), F.sequence(_band(low, width), _band(high, width))
    sides = (dealt(left, rows, columns, cell, (a, b), own).alias("l"),
             dealt(right, columns, rows, cell, (b, a), reach).alias("r"))
    # a cell's pairs are as many under either order of the sides; the hash of the smaller one would not spill
    same = (F.col(f"l.{part}") == F.col(f"r.{part}")) & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    joined = sides[0].hint("merge").join(sides[1], same & condition("l", "r"))
    return joined.drop(*[F.col(f"{s}.{c}") for s in "lr" for c in (part, key)])


# -- aggregates -----------------------------------------------------------------------------------

def exact(df: DataFrame, col: str | Column) -> Column:
    """A column in a type whose sums are exact: integers as ``decimal(38,0)`` (a bigint sum overflows,
    which stops the job in ANSI mode), decimals as they are, doubles as they are."""
    column = _c(col)
    kind = df.select(column.alias("c")).schema["c"].dataType
    return column.cast("decimal(38,0)") if isinstance(kind, T.IntegralType) else column


def exact_amount(value: Column, digits: int = 6, precision: int = 28) -> Column:
    """An amount stored as double as the decimal that its shortest text says. One with more than ``digits``
    decimals, or too large for ``precision`` places, stops the job: nothing is cut in silence."""
    number = value.cast("double")
    exact = number.try_cast(f"decimal({precision},{digits})")
    return F.when(number.isNull() | (exact.cast("double") == number), exact).otherwise(F.raise_error(F.concat(
        F.lit(f"not an amount of up to {digits} decimals: "), number.cast("string"))))


def sum_by(df: DataFrame, keys: Sequence[str | Column], col: str | Column, alias: str,
           money: bool = False) -> DataFrame:
    """A1: one sum per group (partial sums per task before the shuffle).

    ``money`` sums amounts stored as double exactly (``exact_amount``): the result does not depend
    on the order in which rows reach the sum."""
    value = exact_amount(_c(col)) if money else _c(col)
    return df.groupBy(*keys).agg(F.sum(value).alias(alias))


def sums_by(df: DataFrame, keys: Sequence[str | Column],
            sums: dict[str, str | Column]) -> DataFrame:
    """A2: several sums per group in one pass."""
    return df.groupBy(*keys).agg(*[F.sum(_c(c)).alias(a) for a, c in sums.items()])


def count_by(df: DataFrame, keys: Sequence[str | Column], alias: str = "n") -> DataFrame:
    """Rows per group (keys may be expressions such as ``year(ts)``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def flagged_and_total(df: DataFrame, keys: Sequence[str | Column], flag: Column,
                      flagged_alias: str = "flag_count", total_alias: str = "total",
                      counted: Column | None = None) -> DataFrame:
    """A5 + A4 in one pass (A7): rows matching ``flag`` and all rows, per group.

    With ``counted`` the total counts only rows where that column is not null."""
    total = F.count(counted) if counted is not None else F.count(F.lit(1))
    return df.groupBy(*keys).agg(F.count_if(F.coalesce(flag, F.lit(False))).alias(flagged_alias),
                                 total.alias(total_alias))


def mean_by(df: DataFrame, keys: Sequence[str | Column], col: str | Column,
            alias: str = "mean") -> DataFrame:
    """Accumulator mean as ``sum / count`` with partial (sum, count) per task; integers are
    summed without overflow."""
    return (df.groupBy(*keys)
            .agg(F.sum(exact(df, col)).alias("_s"), F.count(_c(col)).alias("_n"))
            .select(*[k for k in keys if isinstance(k, str)],
                    (F.col("_s") / F.col("_n")).alias(alias)))


def sorted_rows_by(df: DataFrame, group: str, value: str, position: str = "position") -> DataFrame:
    """The values of each group in order, as rows (group, position, value), positions from 1.

    A group of any size is spread over many tasks, and so is a value that makes up most of it: rows are
    range-partitioned on group, value and a number of their own, and placed by the counts of the
    runs before (``streams.numbered``). Equal values follow each other in any order; nulls come first."""
    return streams.numbered(df.select(F.col(group), F.col(value)), [group], [F.col(value)], position).select(
        group, position, value)


def sorted_list_by(df: DataFrame, key: str, value: str, alias: str = "values",
                   sep: str | None = None) -> DataFrame:
    """The sorted values of each group, as an array or (with ``sep``) joined text.

    The list is one row, so this is for groups that are bounded by their meaning (the lines of an
    order); ``sorted_rows_by`` gives the same order for groups of any size."""
    lst = sorted_values(F.collect_list(F.col(value)))
    out = lst if sep is None else F.array_join(lst, sep)
    return df.groupBy(key).agg(out.alias(alias))
