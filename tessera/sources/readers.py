"""File and in-memory sources.

Readers are lazy (no schema inference pass): a schema or the header option describes the file, and Catalyst
prunes columns / pushes filters into the scan. Two run small jobs while the plan is built: differing headers of
many files are read first, and records with line breaks are surveyed for where they begin.
"""

from __future__ import annotations

import csv
import io
import re
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import streams
from tessera.operators.setops import union_by_name
from tessera.session import ship_package
from tessera.sources import splits

CORRUPT_COL = "_corrupt_record"


#: Options under which text written by ``sinks.write_csv`` comes back as it was: quotes inside a
#: field are doubled, blanks stay, an empty field is null and a quoted empty field is the empty text.
#: The null marker is a text that no file holds; with ``''`` empty texts would come back as null.
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
            "emptyValue": "", "nullValue": "\x00null\x00"}


def _as_schema(schema: T.StructType | str) -> T.StructType:
    """A StructType from a StructType or DDL text such as ``"id INT, name STRING"``."""
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


# -- S1 / S4: CSV with an explicit schema ---------------------------------------------------

def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             sep: str = ",", header: bool = False, mode: str = "PERMISSIVE", multi_line: bool = False,
             **options) -> DataFrame:
    """Headerless (S1) or header (S4, any separator) CSV read with a fixed schema.

    Bad fields become null in PERMISSIVE mode; ``mode="DROPMALFORMED"`` drops the row instead.
    ``multi_line`` reads quoted fields that hold line breaks (quotes in them doubled): records are cut from byte
    ranges (``splits.csv_records``), so a large file is still read by many tasks, and parsed by Spark."""
    if not multi_line:
        return (spark.read.schema(_as_schema(schema)).options(**CSV_TEXT).option("sep", sep)
                .option("header", header).option("mode", mode).options(**options).csv(path))
    schema = _as_schema(schema)
    records = splits.csv_records(spark, path if isinstance(path, str) else list(path), sep)
    if header:
        records = records.where(~F.col("first"))
    fields = list(schema.fields)
    drop = mode == "DROPMALFORMED"
    if drop:
        fields.append(T.StructField(options.setdefault("columnNameOfCorruptRecord", "corrupt record"), T.StringType()))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parse = {**CSV_TEXT, "sep": sep, "multiLine": True, **options, "mode": "PERMISSIVE" if drop else mode}
    parsed = records.where("text <> ''").select(F.from_csv(
        F.col("text"), ddl, {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in parse.items()}).alias("r"))
    if drop:
        parsed = parsed.where(F.col("r").getField(options["columnNameOfCorruptRecord"]).isNull())
    return parsed.select(*[F.col("r").getField(n).alias(n) for n in schema.fieldNames()])


# -- S2 / S3: header CSV read as all strings, header names normalised ------------------------

def read_csv_strings(spark: SparkSession, path: str | Sequence[str], sep: str = ",",
                     mode: str = "PERMISSIVE") -> DataFrame:
    """Header CSV with every column a string (no inference); names come from the header."""
    return (spark.read.options(**CSV_TEXT).option("header", True).option("inferSchema", False)
            .option("sep", sep).option("mode", mode).csv(path))


class HeaderClash(ValueError):
    """Two columns of one file have the same name once blanks are trimmed."""


def trimmed_names(header: Sequence[str], path: str) -> list[str]:
    """Column names without the blanks around them (S3)."""
    by_name: dict[str, list[str]] = {}
    for raw in header:
        by_name.setdefault(raw.strip(), []).append(raw)
    clashes = [raws for raws in by_name.values() if len(raws) > 1]
    if clashes:
        raise HeaderClash(f"{path}: {clashes} are the same column after trimming")
    return list(by_name)


def read_trimmed(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A header CSV as strings with blanks around its column names removed (S3)."""
    table = read_csv_strings(spark, path, sep=sep)
    return table.toDF(*trimmed_names(table.columns, path))


def _header_record(text: Iterable[str], sep: str) -> list[str]:
    """The fields of the first record of a file, given as lines; quoted names may hold line breaks."""
    kind, held, quoted = splits.CsvRecords(sep), [], False
    for line in text:
        held.append(line)
        quoted = kind.open_after(line, quoted)
        if not quoted:
            break
    return next(csv.reader(io.StringIO("\n".join(held).removesuffix("\r"), newline=""), delimiter=sep), [])


def file_headers(spark: SparkSession, files: Sequence[str], sep: str = ",") -> dict[str, tuple[str, ...]]:
    """The header fields of every file (listed paths, escaped as in URIs), read by a distributed job; a file without a
    line has none.

    Tasks open the files and read their first lines. A store that only Spark's readers reach is read by a
    text scan instead, of which each file's first range counts."""
    ship_package(spark)
    out = "path string, header array<string>"
    try:
        fs.FileSystem.from_uri(files[0])
        reached = True
    except (OSError, ValueError, pa.ArrowException):
        reached = False
    if reached:
        def read(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            for batch in batches:
                paths = batch.column(0).to_pylist()
                headers = []
                for path in paths:
                    store, base = fs.FileSystem.from_uri(path)
                    with store.open_input_stream(base) as source:
                        lines = io.TextIOWrapper(source, "utf-8", newline="\n")
                        headers.append(_header_record((line.removesuffix("\n") for line in lines), sep))
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(headers, pa.list_(pa.string()))], names=["path", "header"])

        tasks = max(1, min(len(files) // 16, 4 * spark.sparkContext.defaultParallelism))
        rows = spark.createDataFrame([(f,) for f in files], "path string").repartition(tasks).mapInArrow(read, out)
    else:
        def first(key: tuple, batches: Iterable[pa.RecordBatch]) -> Iterable[tuple]:
            if key[1] == 0:
                yield key[0], _header_record((v for b in batches for v in b.column("value").to_pylist()), sep)

        rows = streams.stream_sorted(splits.ranges(spark, [unquote(f) for f in files], "\n"), ["path", "block"], first, out)
    found = {r["path"]: tuple(r["header"]) for r in rows.collect()}  # a row per file, as the caller's list
    return {f: found.get(f, ()) for f in files}


def read_header_csv_union(spark: SparkSession, paths: Sequence[str], sep: str = ",",
                          drift: dict[str, list[str]] | None = None) -> DataFrame:
    """Header CSV files whose headers differ, as one table of strings (S2 + S3 + U2): columns by
    trimmed name, in order of first appearance, null where a file lacks one.

    ``paths`` are files or folders. The headers are read by one distributed job, files are grouped by what their
    header says, and the plan has one scan per distinct header, however many files there are. Files without
    a line are passed over. ``drift``, a dict, receives the names that a path lacks (in any of its files)."""
    listed = spark.read.text(list(paths)).inputFiles()
    headers = file_headers(spark, listed, sep) if listed else {}
    given = {_plain_path(p): p for p in paths}
    place = {p: i for i, p in enumerate(paths)}

    def origin(file: str) -> str:
        at = _plain_path(file)
        while at not in given and "/" in at:
            at = at.rpartition("/")[0]
        return given.get(at, file)

    files = sorted((f for f in listed if headers[f]), key=lambda f: (place.get(origin(f), len(place)), f))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        groups.setdefault(tuple(trimmed_names(headers[file], file)), []).append(file)
    if not groups:
        raise ValueError(f"no header in {list(paths)}")
    every = list(dict.fromkeys(name for names in groups for name in names))
    if drift is not None:
        for names, members in groups.items():
            lacks = [name for name in every if name not in names]
            for file in members if lacks else ():
                held = drift.setdefault(origin(file), [])
                held += [name for name in lacks if name not in held]
    return union_by_name([
        read_csv(spark, [unquote(m) for m in members], T.StructType([T.StructField(name, T.StringType()) for name in names]), sep, header=True)
        for names, members in groups.items()]).select(*[F.col(f"`{name}`") for name in every])


def _plain_path(path: str) -> str:
    """A path without scheme and escapes, to compare given paths with listed files."""
    return unquote(re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", path)).rstrip("/") if ":" in path else path.rstrip("/")


# -- S6: quote-aware CSV with bad-row handling -------------------------------------------------

def header_schema(spark: SparkSession, path: str | Sequence[str], types: dict[str, str],
                  sep: str = ",") -> T.StructType:
    """The positional schema of a header CSV, built by looking each header name up in
    ``types`` (names are trimmed; unknown names are strings). Reads only the header line."""
    names = [c.strip() for c in read_csv_strings(spark, path, sep=sep).columns]
    ddl = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
    return _as_schema(ddl)


def read_csv_checked(spark: SparkSession, path: str | Sequence[str],
                     schema: T.StructType | str | dict[str, str],
                     columns: Sequence[str] | None = None, sep: str = ",", header: bool = True,
                     quarantine_path: str | None = None, observation=None) -> DataFrame:
    """Read a quoted CSV, dropping rows that do not fit the schema, then pick columns by name.

    ``schema`` is positional (a StructType or DDL), or a ``{name: type}`` mapping looked up by
    the file's header names, so the wanted columns are found by name whatever their order.

    Rows that do not fit (wrong field count, a value not of its column's type) land in a
    corrupt-record column and are filtered out. The CSV parser only converts the columns a query
    needs, so selecting fewer ``columns`` would make fewer rows look malformed; an observed
    metric over every column (the malformed-row count, readable from the ``Observation``
    ``observation`` if passed) keeps all columns required, so the verdict is always whole-row.
    With ``quarantine_path`` the bad rows are also written there (whole lines, Parquet).
    Observed counts are exact when the returned rows are consumed by one job (a global sort
    adds a sampling job that reads them again).
    """
    if isinstance(schema, dict):
        schema = header_schema(spark, path, schema, sep)
    schema = _as_schema(schema)
    with_bad = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    raw = read_csv(spark, path, with_bad, sep=sep, header=header, mode="PERMISSIVE",
                   columnNameOfCorruptRecord=CORRUPT_COL)
    if quarantine_path is not None:  # whole rows are written, so every column is parsed here
        (raw.where(F.col(CORRUPT_COL).isNotNull()).write.mode("overwrite")
         .parquet(quarantine_path))
    observed = raw.observe(observation or f"csv_checked_{uuid.uuid4().hex[:8]}",
                           F.count_if(F.col(CORRUPT_COL).isNotNull()).alias("malformed"),
                           F.max(F.xxhash64(*[F.col(f.name) for f in schema.fields]))
                           .alias("_whole_row"))
    good = observed.where(F.col(CORRUPT_COL).isNull())
    return good.select(*(columns or schema.fieldNames()))


# -- S5 / S7 / S8 / S11 / X2: raw text lines -------------------------------------------------

def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value`` (S11). Splittable: a big file is read by many tasks."""
    return spark.read.text(path)


def drop_header_line(lines: DataFrame, header_text: str, col: str = "value") -> DataFrame:
    """Remove header lines from a text read (S7) by value, without a driver round trip."""
    return lines.where(F.col(col) != F.lit(header_text))


def parse_lines(lines: DataFrame, sep: str, fields: Sequence[tuple[str, str]],
                min_fields: int | None = None, col: str = "value") -> DataFrame:
    """Positional split of delimited lines (S5/X2) with a short-row guard.

    ``fields`` is ``[(name, spark_type), ...]`` for positions 1..n; values are ``try_cast`` so a
    junk field becomes null instead of failing the job.
    """
    need = min_fields if min_fields is not None else len(fields)
    parts = F.col("_parts")
    return (lines.select(F.split(F.col(col), re.escape(sep)).alias("_parts"))
            .where(F.size(parts) >= need)
            .select(*[F.try_element_at(parts, F.lit(i + 1)).try_cast(t).alias(name)
                      for i, (name, t) in enumerate(fields)]))


# -- S10 / S14: Parquet and the format switch ----------------------------------------------------

def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


def load(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
         schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Same logical table from CSV or Parquet."""
    if fmt == "parquet":
        return read_parquet(spark, path)
    if fmt == "csv":
        if schema is not None:
            return read_csv(spark, path, schema, **options)
        return read_csv_strings(spark, path, **options)
    if fmt == "text":
        return read_lines(spark, path)
    if fmt == "json":
        reader = spark.read
        if schema is not None:
            reader = reader.schema(_as_schema(schema))
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.json(path)
    raise ValueError(f"unknown format {fmt!r}")


# -- S12 / S13: in-memory collections ----------------------------------------------------------

def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str,
              partitions: int | None = None) -> DataFrame:
    """A small driver-side collection as a DataFrame, optionally spread over N partitions."""
    df = spark.createDataFrame(list(rows), schema=schema)
    return df.repartition(partitions) if partitions else df


def int_range(spark: SparkSession, start: int, end: int | None = None, step: int = 1,
              partitions: int | None = None) -> DataFrame:
    """``spark.range`` (S13): generated on the executors, no driver data."""
    if end is None:
        start, end = 0, start
    return spark.range(start, end, step, numPartitions=partitions)

