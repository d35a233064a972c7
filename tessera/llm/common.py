"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, shared_dir, ship_package

# fixed value: the characters that end a word
SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def prepare(df: DataFrame) -> SparkSession:
    """The session of ``df``, with a shared checkpoint folder and this package on its workers."""
    spark = df.sparkSession
    shared_dir(spark)
    ship_package(spark)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column: Column) -> Column:
    """Text as UTF-8 bytes; null counts as the empty text."""
    return F.coalesce(column, F.lit("")).cast("binary")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, so a lost
    executor costs no recomputation, and every later reader sees the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it, for a path in a folder that driver and executors share."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


def slices(batches: Iterable[pa.RecordBatch], column: str,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``max_bytes`` of ``column`` (one row at least), so that a
    task's working memory follows the longest text and not the rows of a batch."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + (size or 0) > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def sorted_spans(spans: Column, kinds: list[str], by_kind: bool) -> Column:
    """``kind:start:end`` texts, comma-joined, of an array of (rank, start, end) structs; ``rank``
    is the kind's place in ``kinds``. Order: kind then start, or start then kind."""
    names = F.array(*[F.lit(k) for k in kinds])
    if by_kind:
        keyed = F.transform(spans, lambda s: F.struct(s["rank"], s["start"], s["end"]))
    else:
        keyed = F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"]))
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
