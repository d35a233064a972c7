"""Small dataflow pipelines (QP6-QP13), generalised to any table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import explode_tokens, rounded
from tessera.operators import grouped, relational, setops, streams
from tessera.operators.quantiles import Quantiles


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """QP6: frequency of every whitespace-separated word, most frequent first, ties by word.

    Tokens are exploded and counted with partial counts per task, so a very common word is one
    row per task before the shuffle. The final sort is a range shuffle over distinct words."""
    words = explode_tokens(lines, text, "word")
    return (relational.count_by(words, ["word"], "n")
            .orderBy(F.col("n").desc(), F.col("word").asc()))


WIDE_INT = "decimal(38,0)"  # exact integers up to 38 digits


def even_squares(df: DataFrame, col: str, alias: str = "n", sq_alias: str = "sq") -> DataFrame:
    """QP7: even values with their squares, largest first.

    Squares are exact ``decimal(38,0)``: a bigint square overflows (and fails the job in ANSI
    mode) once values pass about 3e9, well inside the key range of a large table."""
    wide = F.col(col).cast(WIDE_INT)
    return (df.where(F.col(col) % 2 == 0)
            .select(F.col(col).alias(alias), (wide * wide).alias(sq_alias))
            .orderBy(F.col(alias).desc()))


def in_either(a: DataFrame, b: DataFrame) -> DataFrame:
    """QP8: distinct members of either list, sorted (U1 + U3 + O4)."""
    out = setops.union_distinct([a, b])
    return out.orderBy(*out.columns)


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """QP8: distinct members of both lists, sorted (U4 + O4)."""
    out = setops.intersect(a, b)
    return out.orderBy(*out.columns)


def sorted_names_per_group(df: DataFrame, group: str, name: str, alias: str = "names",
                           sep: str | None = ",") -> DataFrame:
    """QP9: the sorted names of every group as one row, groups in key order (A9, X14, O4); for groups
    that are bounded by their meaning."""
    return relational.sorted_list_by(df, group, name, alias, sep).orderBy(group)


def sorted_name_rows(df: DataFrame, group: str, name: str, position: str = "position") -> DataFrame:
    """QP9 for groups of any size: (group, position, name) in that order."""
    return relational.sorted_rows_by(df, group, name, position).orderBy(group, position)


def high_value(df: DataFrame, qty: str, price: str, threshold: float,
               cols: Sequence[str], alias: str = "value") -> DataFrame:
    """QP10: rows whose ``qty * price`` reaches ``threshold``, largest first (P5, F2, O2)."""
    return (relational.with_product(df, qty, price, alias).select(*cols, alias)
            .where(F.col(alias) >= F.lit(threshold))
            .orderBy(F.col(alias).desc(), *[F.col(c).asc() for c in cols]))


def _factor(df: DataFrame, name: str, digits: int) -> Column:
    """A column as a decimal whose products and sums are exact: integers with no decimals, decimals as
    they are, doubles as ``relational.exact_amount``."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(name)
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("decimal(18,0)")
    return relational.exact_amount(F.col(name), digits, 18)


def revenue_by_category(sales: DataFrame, products: DataFrame, sale_key: str, product_key: str,
                        qty: str, price: str, category: str, alias: str = "revenue",
                        scale: int = 2, digits: int = 6) -> DataFrame:
    """QP11: revenue (qty * price) per product category, rounded once, largest first.

    Amounts stored as double may have up to ``digits`` decimals; one with more is an error.

    Revenue is summed exactly (decimal) per product key *before* the join: the join then sees
    one row per product instead of one per sale, and a hot product is one row per task before
    the shuffle. The re-keyed sum per category is a second tiny aggregate."""
    line = _factor(sales, qty, digits) * _factor(sales, price, digits)
    per_product = sales.groupBy(sale_key).agg(F.sum(line).alias("_rev"))
    named = relational.join_keys(per_product, products.select(product_key, category), sale_key, product_key)
    return (named.groupBy(F.col(f"r.`{category}`").alias(category))
            .agg(rounded(F.sum("_rev"), scale).cast("double").alias(alias))
            .orderBy(F.col(alias).desc(), F.col(category).asc()))


def mean_per_key(df: DataFrame, key: str, value: str, alias: str = "mean", scale: int = 2) -> DataFrame:
    """QP12: mean per key, rounded, largest first."""
    means = relational.mean_by(df, [key], value, "_mean")
    return (means.select(key, rounded("_mean", scale).cast("double").alias(alias))
            .orderBy(F.col(alias).desc(), F.col(key).asc()))


def mean_per_key_accumulated(df: DataFrame, key: str, value: str, alias: str = "mean",
                             scale: int = 2) -> DataFrame:
    """QP12 through the zero/seqOp/combOp contract (D-3): per-task pandas partial ``(sum, count)``,
    merged with built-in sums, finished as ``sum / count``.

    The state holds what the input's type needs: integers are summed as exact decimals (two 32-bit
    halves per chunk, so that nothing wraps), decimals as decimals of their scale, floats as double.
    NaN counts as a value and makes the mean NaN, as in the built-in form; nulls do not count. Other types
    are refused."""
    kind = df.schema[value].dataType
    key_type = df.schema[key].dataType.simpleString()
    if isinstance(kind, T.IntegralType):
        state = "decimal(38,0)"

        def total(column):
            held = column.to_numpy("int64")
            return Decimal((int((held >> 32).sum()) << 32) + int((held & 0xFFFFFFFF).sum()))
    elif isinstance(kind, T.DecimalType):
        state = f"decimal(38,{kind.scale})"

        def total(column):
            return sum(column, Decimal(0))
    elif isinstance(kind, T.FractionalType):
        state = "double"

        def total(column):
            return float(column.sum())
    else:
        raise TypeError(f"mean of {kind.simpleString()} column {value!r}")

    def seq(chunk):
        # pandas holds nulls and NaN alike: the flags say which is which
        rows = [(None if pd.isna(k) else k, total(g["v"][g["held"] & ~g["odd"]]), int(g["held"].sum()), int(g["odd"].sum()))
                for k, g in chunk.groupby("key", dropna=False, sort=False)]
        out = pd.DataFrame(rows, columns=["key", "s", "n", "odd"], dtype=object)
        return out.astype({"n": "int64", "odd": "int64"} | ({"s": "float64"} if state == "double" else {}))

    floating = isinstance(kind, (T.DoubleType, T.FloatType))
    flagged = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{value}`").alias("v"),
                        F.col(f"`{value}`").isNotNull().alias("held"),
                        (F.coalesce(F.isnan(F.col(f"`{value}`")), F.lit(False)) if floating else F.lit(False)).alias("odd"))
    mean = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(
        F.col("n") > 0, rounded(F.col("s") / F.col("n"), scale).cast("double"))
    found = grouped.aggregate_by_key(
        flagged, ["key"], ["v", "held", "odd"], seq, f"key {key_type}, s {state}, n bigint, odd bigint",
        {"s": "sum", "n": "sum", "odd": "sum"}, [mean.alias("mean")])
    return found.select(F.col("key").alias(key), F.col("mean").alias(alias))


def quantiles_per_key(df: DataFrame, key: str, value: str, wanted: Sequence[float],
                      size: int = 1024) -> DataFrame:
    """(key, q, value, n, error): a value of the key for each quantile of ``wanted``, whose rank is within
    ``error`` of the wanted one (D-3 over mergeable summaries, ``quantiles.Quantiles``).

    ``n`` counts the values that are not null; NaN is the largest value; a key without values has a null
    ``value``. Tasks keep summaries of about ``size`` values per level, never the rows of a key."""
    asked = list(wanted)

    def seq(state: Quantiles, batch: pa.RecordBatch) -> Quantiles:
        return state.add(batch.column(0).drop_null().to_numpy(zero_copy_only=False))

    def finish(state: Quantiles) -> Iterator[tuple]:
        for q in asked:
            yield q, state.at(q), state.n, state.error

    rows = df.select(F.col(f"`{key}`"), F.col(f"`{value}`").cast("double").alias("v"))
    return grouped.aggregate_states(rows, [key], ["v"], lambda: Quantiles(size), seq, Quantiles.merge, finish,
                                    "q double, value double, n bigint, error bigint")


def ranked_quantiles(df: DataFrame, key: str, value: str, found: DataFrame) -> DataFrame:
    """``found`` (of ``quantiles_per_key``) with the exact ranks of its values in ``df``: ``below`` and ``upto``
    count the values under and not over the answer, and ``within`` says whether the wanted rank is as
    near as ``error`` promises. One join of the rows with the few answers, one aggregate."""
    answers = found.select(F.col(key).alias("k"), "q", F.col("value").alias("answer"), "n", "error")
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{value}`").cast("double").alias("v"))
    ranks = (rows.alias("l").join(answers.alias("r"), F.col("l.k").eqNullSafe(F.col("r.k")))
             .groupBy(F.col("r.k").alias("k"), "q")
             .agg(F.first("answer").alias("value"), F.first("n").alias("n"), F.first("error").alias("error"),
                  F.count_if(F.col("v") < F.col("answer")).alias("below"),
                  F.count_if(F.col("v") <= F.col("answer")).alias("upto")))
    rank = F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n")))
    near = (F.col("below") + 1 - F.col("error") <= rank) & (rank <= F.col("upto") + F.col("error"))
    return ranks.select(F.col("k").alias(key), "q", "value", "n", "error", "below", "upto",
                        F.coalesce(near, F.col("n") == 0).alias("within"))


def funnel(kind: str, opens: str, closes: str, breaks: str) -> streams.GroupFn:
    """A state machine for ``streams.stream_groups``: (key.., events, funnels, longest, broken).

    A funnel opens at an event of kind ``opens`` and closes at the next ``closes``; ``breaks`` ends it
    without success and another ``opens`` begins it anew; other events, null kinds too, pass by.
    ``longest`` counts the events of the longest funnel. Three numbers are held per key."""
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        events = funnels = longest = broken = length = 0
        for batch in batches:
            events += batch.num_rows
            for what in batch.column(batch.schema.get_field_index(kind)).to_pylist():
                if what == opens:
                    length = 1
                elif length:
                    length += 1
                    if what == closes:
                        funnels, longest, length = funnels + 1, max(longest, length), 0
                    elif what == breaks:
                        broken, length = broken + 1, 0
        yield (*key, events, funnels, longest, broken)
    return run


def paired(streamed: Sequence[str], held: Sequence[str]) -> Callable:
    """A function for ``streams.stream_cogroup`` that pairs each streamed row with each held one."""
    def run(key: object, rows: list[dict], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        kept = [tuple(r[c] for c in held) for r in rows]
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in streamed]
            for row in zip(*columns):
                for other in kept:
                    yield (*row, *other)
    return run


def reduce_side_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     key_alias: str = "k", nest: bool = True) -> DataFrame:
    """QP13 (J6, A12, P12)."""
    return grouped.reduce_side_join(left, right, left_key, right_key, key_alias, nest)
