"""Payroll-style pipelines (QP1-QP5) in DataFrame and SQL form.

Every name and constant of the original jobs (``Dep A``, 14, 5, 3) is a parameter here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import apply_times_udf, times
from tessera.operators import ranking, relational
from tessera.plans.sqlview import temp_views


def lowest_paid(staff: DataFrame, k: int = 5, amount: str = "salary", key: str = "id",
                cols: Sequence[str] | None = None) -> DataFrame:
    """QP1: the ``k`` rows with the smallest ``amount`` (ties by ``key``)."""
    return ranking.bottom_k(staff, k, [amount, key], cols)


def lowest_paid_sql(spark: SparkSession, staff: DataFrame, k: int = 5, amount: str = "salary",
                    key: str = "id", cols: Sequence[str] | None = None) -> DataFrame:
    sel = ", ".join(f"`{c}`" for c in (cols or staff.columns))
    with temp_views(staff=staff) as v:
        return spark.sql(f"SELECT {sel} FROM {v['staff']} ORDER BY `{amount}`, `{key}` "
                         f"LIMIT {int(k)}")


def top_in_dimension(facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str,
                     dim_name: str, name: str, k: int = 3, amount: str = "salary",
                     tiebreak: str = "id", cols: Sequence[str] | None = None,
                     dim_cols: Sequence[str] = ()) -> DataFrame:
    """QP2: the ``k`` largest ``amount`` rows of the facts whose dimension is called ``name``, with
    the fact columns ``cols`` (default: all) and the dimension columns ``dim_cols``.

    The two tables may share column names. The dimension filter is pushed below the join by
    Catalyst; the join then sees one dimension row, and the top-k keeps a k-row heap per task."""
    joined = relational.join_filtered_dim(facts, dims, fact_key, dim_key, F.col(dim_name) == F.lit(name))
    return ranking.top_k(joined, k, [F.col(f"l.`{amount}`").desc(), F.col(f"l.`{tiebreak}`").asc()],
                         [*relational.qualified("l", cols or facts.columns), *relational.qualified("r", dim_cols)])


def top_in_dimension_sql(spark: SparkSession, facts: DataFrame, dims: DataFrame, fact_key: str,
                         dim_key: str, dim_name: str, name: str, k: int = 3,
                         amount: str = "salary", tiebreak: str = "id",
                         cols: Sequence[str] | None = None, dim_cols: Sequence[str] = ()) -> DataFrame:
    sel = ", ".join([f"f.`{c}`" for c in (cols or facts.columns)] + [f"d.`{c}`" for c in dim_cols])
    with temp_views(facts=facts, dims=dims) as v:
        return spark.sql(
            f"SELECT {sel} FROM {v['facts']} f JOIN {v['dims']} d "
            f"ON f.`{fact_key}` = d.`{dim_key}` WHERE d.`{dim_name}` = :name "
            f"ORDER BY f.`{amount}` DESC, f.`{tiebreak}` LIMIT {int(k)}",
            args={"name": name})


def yearly_income(staff: DataFrame, amount: str = "salary", label: str = "name",
                  factor: int | float = 14, alias: str = "yearly_income",
                  extra: Sequence[str] = ()) -> DataFrame:
    """QP3: ``amount * factor`` per row, sorted descending, ties by ``label`` then ``extra``.

    Integral amounts are widened to bigint first (ANSI mode fails on int overflow). Pass a unique
    key in ``extra``: as the last sort key it lets the range shuffle split even a value shared by
    a third of all rows over many tasks."""
    integral = dict(staff.dtypes)[amount] in ("tinyint", "smallint", "int", "bigint")
    value = times(amount, factor, widen=integral)
    return (staff.select(*extra, label, value.alias(alias))
            .orderBy(F.col(alias).desc(), F.col(label).asc(), *[F.col(c).asc() for c in extra]))


def yearly_income_udf(staff: DataFrame, amount: str = "salary", label: str = "name",
                      factor: int = 14, alias: str = "yearly_income",
                      extra: Sequence[str] = ()) -> DataFrame:
    """QP4: the same with an Arrow UDF (D-1), for the built-in vs UDF comparison."""
    return (staff.select(*extra, label, apply_times_udf(amount, factor).alias(alias))
            .orderBy(F.col(alias).desc(), F.col(label).asc(), *[F.col(c).asc() for c in extra]))


def yearly_income_sql(spark: SparkSession, staff: DataFrame, amount: str = "salary",
                      label: str = "name", factor: int = 14, alias: str = "yearly_income",
                      extra: Sequence[str] = ()) -> DataFrame:
    integral = dict(staff.dtypes)[amount] in ("tinyint", "smallint", "int", "bigint")
    value = f"CAST(`{amount}` AS BIGINT) * {factor}" if integral else f"`{amount}` * {factor}"
    pre = "".join(f"`{c}`, " for c in extra)
    post = "".join(f", `{c}`" for c in extra)
    with temp_views(staff=staff) as v:
        return spark.sql(f"SELECT {pre}`{label}`, {value} AS `{alias}` FROM {v['staff']} "
                         f"ORDER BY `{alias}` DESC, `{label}`{post}")


def sum_per_dimension(facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str,
                      dim_name: str, amount: str, alias: str = "total",
                      money: bool = False) -> DataFrame:
    """QP5: total ``amount`` per dimension name, largest first.

    Aggregated to one row per key *before* the join (partial sums per task, so a hot key is
    one row per task), then joined to the dimension and re-summed per name (names need not be
    unique)."""
    per_key = relational.sum_by(facts, [fact_key], amount, "_part", money=money)
    named = relational.join_keys(per_key, dims.select(dim_key, dim_name), fact_key, dim_key)
    total = F.sum("_part").cast("double") if money else F.sum("_part")
    return (named.groupBy(F.col(f"r.`{dim_name}`").alias(dim_name)).agg(total.alias(alias))
            .orderBy(F.col(alias).desc(), F.col(dim_name).asc()))


def count_per_dimension(facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str,
                        dim_name: str, strategy: str = "auto", alias: str = "n", **bounds) -> DataFrame:
    """Rows per dimension name, the fact rows joined under a requested strategy."""
    joined = relational.join_keys(facts.select(fact_key), dims.select(dim_key, dim_name), fact_key, dim_key,
                                  strategy=strategy, **bounds)
    return joined.groupBy(F.col(f"r.`{dim_name}`").alias(dim_name)).agg(F.count("*").alias(alias))


SQL_HINTS = {"broadcast": "BROADCAST", "merge": "MERGE", "shuffle_hash": "SHUFFLE_HASH",
             "shuffle_replicate_nl": "SHUFFLE_REPLICATE_NL"}


def count_per_dimension_sql(spark: SparkSession, facts: DataFrame, dims: DataFrame,
                            fact_key: str, dim_key: str, dim_name: str, strategy: str = "auto",
                            alias: str = "n") -> DataFrame:
    """The SQL form of ``count_per_dimension``: the strategy becomes a ``/*+ HINT(d) */`` comment,
    under the same bounds."""
    relational.check_strategy(dims.select(dim_key, dim_name), strategy, keep=True)
    hint = f"/*+ {SQL_HINTS[strategy]}(d) */ " if strategy in SQL_HINTS else ""
    with temp_views(facts=facts, dims=dims) as v:
        return spark.sql(f"""
            SELECT {hint}d.`{dim_name}`, count(*) AS `{alias}`
            FROM {v['facts']} f JOIN {v['dims']} d ON f.`{fact_key}` = d.`{dim_key}`
            GROUP BY d.`{dim_name}`""")
