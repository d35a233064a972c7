"""Ordered output in many files (K2, K3, O1-O4), and checked conversion between formats (K5).

A sorted result is written by many tasks, each a range of the order, with a manifest that names the files in
order with their rows and border keys. Reading it back gives every row its position, so the order of
the result is part of what can be read and compared; nothing is funnelled through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import streams
from tessera.session import scratch_path
from tessera.sources.readers import CSV_TEXT
from tessera.sources.sinks import write_csv, write_parquet, write_text

MANIFEST = "_order"  # beside the files; hidden from Spark's readers by its name


class OutOfOrder(ValueError):
    """Files whose rows do not follow each other in the order of the manifest."""


def write_ordered(df: DataFrame, path: str, order: Sequence[tuple[str, bool]], fmt: str = "parquet") -> DataFrame:
    """Writes ``df`` sorted by ``order`` -- (column, ascending) pairs, nulls first when ascending -- as many ``parquet``,
    ``csv`` or ``text`` files, and its manifest (file, place, rows, first, last), which is returned.

    Each file is a range of the order; rows with equal keys may fall into neighbouring files. ``text`` takes a
    single string column (order it before formatting by ``order`` over that column). The manifest is made from the
    files as they were written and checked: ``OutOfOrder`` if their borders do not follow each other."""
    keys = [F.col(f"`{c}`").asc_nulls_first() if up else F.col(f"`{c}`").desc_nulls_last() for c, up in order]
    own = streams.free_name("_own", df.columns)
    placed = df.withColumn(own, F.monotonically_increasing_id())  # ends the range key, so equal rows spread
    placed = placed.repartitionByRange(*keys, F.col(own)).sortWithinPartitions(*keys, F.col(own)).drop(own)
    {"parquet": write_parquet, "csv": write_csv, "text": write_text}[fmt](placed, path)
    rows = _with_place(_read(df.sparkSession, path, fmt, df.schema), df.columns)
    border = F.struct(*[F.col(f"`{c}`").alias(c) for c, _ in order])
    at = F.struct("block", "at")
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min_by(border, at).alias("first"),
                                     F.max_by(border, at).alias("last"))
    # Spark names a file by the number of its task, and tasks hold ranges in order
    place = F.regexp_extract(F.element_at(F.split("file", "/"), -1), r"part-(\d+)", 1).cast("int")
    manifest = files.select(F.element_at(F.split("file", "/"), -1).alias("file"), place.alias("place"), "rows", "first", "last")
    manifest.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{MANIFEST}")
    manifest = read_manifest(df.sparkSession, path)
    check_order(manifest, order)
    return manifest


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}")


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "csv":
        return spark.read.schema(schema).options(**CSV_TEXT).csv(path)
    return spark.read.text(path).toDF(*schema.fieldNames())


def _with_place(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with their file, the byte range that they were read from, and a number that rises within it."""
    return rows.select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def follows(a: str, b: str, order: Sequence[tuple[str, bool]]) -> Column:
    """Whether the key struct ``b`` may come right after ``a``."""
    out: Column = F.lit(True)
    for name, up in reversed(order):
        x, y = F.col(f"{a}.`{name}`"), F.col(f"{b}.`{name}`")
        less = F.coalesce(x < y if up else x > y, (x.isNull() & y.isNotNull()) if up else (x.isNotNull() & y.isNull()))
        out = less | (x.eqNullSafe(y) & out)
    return out


def check_order(manifest: DataFrame, order: Sequence[tuple[str, bool]]) -> None:
    """``OutOfOrder`` unless every file begins where the one before it ends or later (a row per file is compared)."""
    along = Window.orderBy("place")
    wrong = (manifest.withColumn("before", F.lag("last").over(along)).where(F.col("before").isNotNull())
             .where(~follows("before", "first", order)))
    if found := wrong.select("file").head(1):
        raise OutOfOrder(f"{found[0]['file']} begins before its predecessor ends")


def read_ordered(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                 position: str = "position") -> DataFrame:
    """The rows of ``write_ordered`` with their position, from 1, in its order.

    Files come in manifest order, and within a file rows are counted per byte range: a file may be read by
    many tasks. Only counts meet. A file that the manifest does not name, or that is missing, is an error."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    rows = _with_place(_read(spark, path, fmt, schema), schema.fieldNames())
    name = F.element_at(F.split("file", "/"), -1)
    # written, so that the counts and the rows are of one scan
    where = scratch_path(spark, "ordered")
    rows.write.parquet(where)
    rows = spark.read.schema(rows.schema).parquet(where)
    manifest = read_manifest(spark, path).select(F.col("file").alias("named"), "place", F.col("rows").alias("listed"))
    blocks = rows.groupBy(name.alias("named"), "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    held = blocks.groupBy("named").agg(F.sum("n").alias("found"))
    odd = manifest.join(held, "named", "full").where(~F.col("listed").eqNullSafe(F.col("found")))
    if found := odd.head(1):
        raise OutOfOrder(f"file {found[0]['named']}: the manifest lists {found[0]['listed']} rows, {found[0]['found']} are there")
    along = Window.orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per byte range of a file
    starts = blocks.join(manifest, "named").select("named", "block", "first",
                                                   F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    return (rows.withColumn("named", name).join(F.broadcast(starts), ["named", "block"])
            .select(*[F.col(f"`{c}`") for c in schema.fieldNames()],
                    (F.col("before") + F.col("at") - F.col("first") + 1).alias(position)))


# -- checked conversion ------------------------------------------------------------------------------------

class Changed(ValueError):
    """Tables that should hold the same rows do not."""


def _sums(df: DataFrame) -> list[Column]:
    """The aggregates of ``fingerprint``, numbered by column; the last are those of whole rows."""
    every: list[Column] = [F.count(F.lit(1)).alias("rows")]
    cells = [F.col(f"`{name}`") for name in df.columns]
    # a null leaves a hash as it is: it is told apart from a value by its flag
    flagged = [[value.isNull(), value] for value in cells]
    for i, values in enumerate([*flagged, [v for pair in flagged for v in pair]]):
        every.append((F.count_if(cells[i].isNull()) if i < len(cells) else F.count_if(F.lit(False))).alias(f"nulls{i}"))
        for name, seed in ((f"total{i}", i), (f"mixed{i}", -1 - i)):
            every.append(F.coalesce(F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")), F.lit(0))
                         .cast("decimal(38,0)").alias(name))
    return every


def fingerprint(df: DataFrame) -> DataFrame:
    """(part, rows, nulls, total, mixed): for each column of ``df`` (``part`` its name) and for whole rows (``part`` null), sums
    of two 64-bit hashes of its values.

    Sums know no order, and a value counts as often as it is there (exact decimals, which no cancelling of pairs
    empties as exclusive-or would). They are one aggregate, partial in each task, so a fingerprint may be taken of
    any part of a table and added up. Values that move between rows change the rows' sum though no column's."""
    parts = [F.struct(F.lit(name).cast("string").alias("part"), "rows", F.col(f"nulls{i}").alias("nulls"),
                      F.col(f"total{i}").alias("total"), F.col(f"mixed{i}").alias("mixed"))
             for i, name in enumerate([*df.columns, None])]
    return df.agg(*_sums(df)).select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def differences(columns: Sequence[str], a: dict, b: dict) -> list[str]:
    """What differs between two tables with these columns, given the aggregates of their fingerprints."""
    out = [f"{a['rows']} and {b['rows']} rows"] if a["rows"] != b["rows"] else []
    for i, name in enumerate([*columns, None]):
        if any(a[f"{what}{i}"] != b[f"{what}{i}"] for what in ("nulls", "total", "mixed")):
            out.append("whole rows" if name is None else f"values of {name}")
    return out


def compare(a: DataFrame, b: DataFrame) -> list[str]:
    """What differs between two tables, as phrases; empty if they hold the same rows, in whatever order."""
    if a.columns != b.columns:
        return [f"columns {a.columns} and {b.columns}"]
    return differences(a.columns, *(df.agg(*_sums(df)).first().asDict() for df in (a, b)))


def convert_checked(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back compared with the source (QP17 with its check): ``Changed`` if a value, or
    the rows that values stand in, are not the same. The source's fingerprint is taken as it is read to be written,
    in the same job."""
    seen = Observation()
    write_parquet(df.observe(seen, *_sums(df)), path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    if found := differences(df.columns, seen.get, back.agg(*_sums(back)).first().asDict()):
        raise Changed(f"{path} does not hold what was written: {'; '.join(found)} differ")
    return back
