"""Sinks and actions (K1-K7).

Writers always go through Spark's distributed writer (one file per task). ``single_file`` is an
opt-in that funnels the result through one task -- only for small final reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _maybe_single(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """K1."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False,
              sep: str = ",", single_file: bool = False) -> None:
    """K2. Text is written so that ``readers.read_csv`` gives it back unchanged: quotes doubled, blanks
    kept, the empty text quoted and null left empty. Line breaks inside fields need the reader's
    ``multi_line``."""
    (_maybe_single(df, single_file).write.mode(mode).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", '""').option("nullValue", "")
     .option("header", header).option("sep", sep).csv(path))


def write_raw_lines(lines: DataFrame, path: str, header: str, mode: str = "overwrite") -> None:
    """Lines as they are (a single string column), with a header line in every file."""
    (lines.toDF(header).write.mode(mode).option("header", True).option("sep", "\x01")
     .option("quote", "\x00").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def format_lines(df: DataFrame, fmt: str, cols: Sequence[str | Column]) -> DataFrame:
    """Rows -> one formatted text column ``value`` (K4, X15), e.g. ``"%s,%.2f"``."""
    return df.select(F.format_string(fmt, *[F.col(c) if isinstance(c, str) else c
                                            for c in cols]).alias("value"))


def join_lines(df: DataFrame, cols: Sequence[str | Column], sep: str = ",") -> DataFrame:
    """Rows -> delimited text column ``value`` (nulls become empty fields)."""
    return df.select(F.concat_ws(sep, *[F.coalesce((F.col(c) if isinstance(c, str) else c)
                                                   .cast("string"), F.lit(""))
                                        for c in cols]).alias("value"))


def write_text(lines: DataFrame, path: str, mode: str = "overwrite",
               single_file: bool = False) -> None:
    """K3: ``lines`` has a single string column."""
    _maybe_single(lines, single_file).write.mode(mode).text(path)


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """K6 as a DataFrame: one row, partial counts per task then one final sum."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def read_back_count(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """K5: the row count of what was just written (an action; returns a Python int)."""
    return spark.read.format(fmt).load(path).count()


def global_sum(df: DataFrame, col: str, alias: str = "total", exact: bool = False) -> DataFrame:
    """Reduce a column to one scalar row (map-side partial sums, one tiny final task).

    ``exact`` sums integers as ``decimal(38,0)``, which cannot overflow where a bigint sum of a
    large table's keys would (ANSI mode fails the job on bigint overflow)."""
    value = F.col(col).cast("decimal(38,0)") if exact else F.col(col)
    return df.agg(F.sum(value).alias(alias))
