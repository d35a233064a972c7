"""Records that run over lines, read from byte ranges of a file by many tasks.

A file is read as text cut at a separator that every record border follows, by Spark's own splitting:
each task gets the pieces of one byte range (``block``) in order. Where a range begins -- inside quotes
or not, how deep -- is not known to its task, so a range is first surveyed for every possibility, which gives
a row per range; these rows are chained along each file, and a second pass over the text, which now knows
where it starts, cuts it into records. A record that runs over range borders is put together from its pieces
under the range in which it began. No text is shuffled but such pieces. The chained rows are copied to
all tasks: one row of a few numbers for each range of a file (about a millionth of its bytes).

``CsvRecords`` cuts quoted CSV at line breaks outside quotes, ``JsonFeatures`` the elements of the
``features`` array of GeoJSON documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import streams
from tessera.session import scratch_path, ship_package

CUT = "file long, block long, at long, owner long, kind int, known boolean, first boolean, text string"
WHOLE, PIECE, STRAY, LAST = range(4)  # kinds of cut rows


class CsvRecords:
    """Records of quoted CSV. ``survey``: is a quoted field open at the end, if none (one) was at the start, and does
    a record end in between."""

    line_sep = "\n"
    survey_schema = "open0 boolean, open1 boolean, ends boolean"
    start_schema = "quoted boolean"

    def __init__(self, sep: str = ",", quote: str = '"'):
        self.sep, self.quote = sep, quote

    def open_after(self, line: str, quoted: bool) -> bool:
        """Whether a quoted field is open behind a line, given whether one was in front of it. A quote opens a field only
        at its start, two quotes in a quoted field are one, what follows the closing quote belongs to the field."""
        if self.quote not in line:
            return quoted
        at = 0
        while True:
            if quoted:
                at = line.find(self.quote, at)
                if at < 0:
                    return True
                if line.startswith(self.quote, at + 1):
                    at += 2
                    continue
                quoted = False
            elif line.startswith(self.quote, at):
                quoted, at = True, at + 1
                continue
            at = line.find(self.sep, at)
            if at < 0:
                return False
            at += len(self.sep)

    def survey(self, batches: Iterable[list[str]]) -> tuple:
        plain, quoted, ends = False, True, False
        for lines in batches:
            for line in lines:
                plain, quoted = self.open_after(line, plain), self.open_after(line, quoted)
                ends |= not quoted
        return plain, quoted, ends

    def chain(self, rows: Iterable[dict]) -> Iterator[tuple[int | None, tuple]]:
        """(block in which the record that is open at the start of a range began, start values) per range."""
        quoted, owner = False, None
        for row in rows:
            yield owner, (quoted,)
            ends = row["ends"] or not quoted
            quoted = row["open1"] if quoted else row["open0"]
            owner = None if not quoted else row["block"] if ends else owner

    def cut(self, block: int, owner: int | None, start: dict, batches: Iterable[list[str]]) -> Iterator[tuple]:
        """(owner, kind, known, first, text): records, and the pieces of those that cross a border."""
        quoted, held, first = start["quoted"], [], block == 0
        mine = owner if quoted else block
        for lines in batches:
            for line in lines:
                held.append(line)
                quoted = self.open_after(line, quoted)
                if not quoted:
                    whole = mine == block
                    yield mine, WHOLE if whole else PIECE, True, first and whole, "\n".join(held)
                    held, mine, first = [], block, first and not whole
        if held:
            yield mine, PIECE, True, first and mine == block, "\n".join(held)

    joint = "\n"


def _quotes(buf: np.ndarray) -> np.ndarray:
    """Where unescaped quotes are."""
    quotes = buf == 34
    slashes = buf == 92
    if slashes.any():
        at = np.arange(len(buf))
        plain = np.maximum.accumulate(np.where(~slashes, at, -1))  # the last place that is no backslash
        quotes[1:] &= (at[1:] - 1 - plain[:-1]) % 2 == 0
    return quotes


def _steps(buf: np.ndarray) -> np.ndarray:
    return ((buf == 123) | (buf == 91)).astype("int64") - ((buf == 125) | (buf == 93)).astype("int64")


class JsonFeatures:
    """The objects in the array ``features`` of the top-level objects of JSON files, cut at closing braces.

    ``survey``, for a range that begins outside (0) or inside (1) a string: do quotes pair up, how much deeper is
    its end, and how deep its shallowest place."""

    line_sep = "}"
    survey_schema = "odd boolean, deeper0 long, deeper1 long, low0 long, low1 long"
    start_schema = "quoted boolean, depth long"
    joint = ""

    @staticmethod
    def bytes_of(pieces: list[str]) -> np.ndarray:
        return np.frombuffer(("}".join(pieces) + "}").encode(), "u1")

    def survey(self, batches: Iterable[list[str]]) -> tuple:
        odd, depth, low = False, [0, 0], [0, 0]
        for pieces in batches:
            buf = self.bytes_of(pieces)
            inside = ((np.cumsum(_quotes(buf)) + odd) % 2).astype(bool)
            steps = _steps(buf)
            for i, counted in enumerate((steps * ~inside, steps * inside)):
                level = depth[i] + np.cumsum(counted)
                depth[i], low[i] = int(level[-1]), min(low[i], int(level.min()))
            odd = bool(inside[-1])
        return odd, *depth, *low

    def chain(self, rows: Iterable[dict]) -> Iterator[tuple[int | None, tuple]]:
        quoted, depth, owner = False, 0, None
        for row in rows:
            yield owner, (quoted, depth)
            low = depth + row[f"low{int(quoted)}"]
            depth = max(0, depth + row[f"deeper{int(quoted)}"])
            quoted ^= row["odd"]
            owner = None if depth < 3 else row["block"] if low < 3 else owner

    def cut(self, block: int, owner: int | None, start: dict, batches: Iterable[list[str]]) -> Iterator[tuple]:
        """Elements of top-level arrays: ``known`` says whether the array is ``features``, null where it opened
        in a range before. ``STRAY`` is what an array holds beside objects, ``LAST`` the array at the end of the range."""
        quoted, depth = start["quoted"], start["depth"]
        where: bool | None = None if depth >= 2 else False
        open_: list[str] | None = [] if depth >= 3 else None  # an object that began before
        mine, head = (owner if depth >= 3 else block), where
        for pieces in batches:
            buf = self.bytes_of(pieces)
            inside = ((np.cumsum(_quotes(buf)) + quoted) % 2).astype(bool)
            level = np.maximum(depth + np.cumsum(_steps(buf) * ~inside), 0)
            before = np.concatenate([[depth], level[:-1]])
            turns = np.flatnonzero((level != before) & (np.minimum(level, before) <= 2))
            from_ = 0
            arrays: list[tuple[int, int, bool | None]] = []  # stretches of arrays that are not known to be others
            stretch = 0 if depth >= 2 and where is not False else None
            for at in turns.tolist():
                up = level[at] > before[at]
                if up and level[at] == 2:
                    where = bool(buf[at] == 91) and _names_features(buf, at)
                    stretch = at + 1 if where else None
                elif not up and level[at] == 1:
                    if stretch is not None:
                        arrays.append((stretch, at, where))
                    where, stretch = False, None
                elif up and level[at] == 3:
                    open_, from_, mine, head = [], at, block, where
                elif not up and level[at] == 2 and open_ is not None:
                    open_.append(buf[from_:at + 1].tobytes().decode())
                    if mine != block:
                        yield mine, PIECE, head, False, "".join(open_)
                    elif head is not False:
                        yield mine, WHOLE, head, False, "".join(open_)
                    open_ = None
            if stretch is not None:
                arrays.append((stretch, len(buf), where))
            for a, b, known in arrays:
                part, own = buf[a:b], (level[a:b] == 2) & (before[a:b] == 2)
                odd = part[own & ~np.isin(part, np.frombuffer(b" \t\r\n,", "u1"))]
                if len(odd):
                    yield block, STRAY, known, False, odd.tobytes().decode(errors="replace")[:100]
            if open_ is not None:
                open_.append(buf[from_:].tobytes().decode())
                from_ = 0
            quoted, depth = bool(inside[-1]), int(level[-1])
        if open_ is not None:
            yield mine, PIECE, head, False, "".join(open_)
        yield block, LAST, where, False, None


def _names_features(buf: np.ndarray, at: int) -> bool:
    """Whether the key in front of the value at ``at`` is ``features``."""
    for length in (64, at):  # the whole text only where blanks fill the near part
        text = buf[max(0, at - length):at].tobytes().rstrip(b" \t\r\n")
        colon = text.endswith(b":")
        text = text[:-1].rstrip(b" \t\r\n")
        if len(text) > 11 or length >= at:
            return colon and text.endswith(b'"features"') and not text.endswith(b'\\"features"')
    return False


def _lists(batches: Iterable[pa.RecordBatch]) -> Iterator[list[str]]:
    for batch in batches:
        yield batch.column(batch.schema.get_field_index("value")).to_pylist()


def ranges(spark: SparkSession, path: str | list[str], line_sep: str) -> DataFrame:
    """(path, block, value): the pieces between separators, in order within each byte range of a file."""
    text = spark.read.option("lineSep", line_sep).option("recursiveFileLookup", True).text(path)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def cut_records(spark: SparkSession, path: str | list[str], kind: Any) -> DataFrame:
    """``CUT`` rows of all files under ``path``, by a class such as ``CsvRecords``. Runs the survey; the cutting is left
    to the caller's job."""
    ship_package(spark)
    pieces = ranges(spark, path, kind.line_sep)
    names = [c.split()[0] for c in kind.start_schema.split(", ")]

    def survey(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        yield (*key, *kind.survey(_lists(batches)))

    def chain(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        seen: list[int] = []

        def rows() -> Iterator[dict]:
            for batch in batches:
                for row in batch.to_pylist():
                    seen.append(row["block"])
                    yield row

        for owner, start in kind.chain(rows()):
            yield (*key, seen.pop(), owner, *start)

    surveyed = streams.stream_sorted(pieces, ["path", "block"], survey, f"path string, block long, {kind.survey_schema}")
    starts = streams.stream_groups(surveyed, ["path"], chain, f"path string, block long, owner long, {kind.start_schema}",
                                   ["block"])
    where = scratch_path(spark, "range-starts")
    starts.write.parquet(where)
    starts = spark.read.schema(starts.schema).parquet(where)
    files = streams.numbered(starts.select("path").distinct(), [], [F.col("path")], "file")
    starts = starts.join(files, "path")
    # one row per byte range, see above
    told = pieces.join(F.broadcast(starts), ["path", "block"]).select("file", "block", "owner", *names, "value")

    def cut(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        first = next(batches)
        start = {n: first.column(first.schema.get_field_index(n))[0].as_py() for n in ("owner", *names)}

        def every() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        for at, (owner, *row) in enumerate(kind.cut(key[1], start["owner"], start, _lists(every()))):
            yield (*key, at, owner, *row)

    return streams.stream_sorted(told, ["file", "block"], cut, CUT)


def stitched(pieces: DataFrame, joint: str) -> DataFrame:
    """``PIECE`` rows put together to records: (file, owner, known, first, text). A record fits one task, as a row does."""
    def join(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows = [r for b in batches for r in zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                                                  for c in ("known", "first", "text")))]
        yield (*key, rows[0][0], rows[0][1], joint.join(r[2] for r in rows))

    return streams.stream_groups(pieces.where(F.col("kind") == PIECE), ["file", "owner"], join,
                                 "file long, owner long, known boolean, first boolean, text string", ["block", "at"])


def csv_records(spark: SparkSession, path: str | list[str], sep: str = ",", quote: str = '"') -> DataFrame:
    """(file, first, text): every record of quoted CSV files, line breaks in quoted fields included; ``first`` marks
    the first of a file. A file of any size is read by many tasks. Quotes in a quoted field are doubled."""
    kind = CsvRecords(sep, quote)
    cut = cut_records(spark, path, kind)
    # a record that began before its range's border is always a piece
    whole = cut.where(F.col("kind") == WHOLE).select("file", "first", "text")
    return whole.union(stitched(cut, kind.joint).select("file", "first", "text")).withColumn(
        "text", F.regexp_replace("text", r"\r\z", ""))


def json_features(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(text): every object of the ``features`` array of the GeoJSON documents under ``path``, whatever their lines. A
    file of any size is read by many tasks; the objects are written once, as text in Parquet. Anything but an
    object in the array stops the job."""
    cut = cut_records(spark, path, JsonFeatures())
    where = scratch_path(spark, "features")
    cut.write.parquet(where)
    cut = spark.read.schema(CUT).parquet(where)

    def follow(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        inside = False
        for batch in batches:
            for block, known in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("block", "known"))):
                yield (*key, block, inside)
                inside = inside if known is None else known

    ends = cut.where(F.col("kind") == LAST).select("file", "block", "known")
    entered = F.broadcast(streams.stream_groups(ends, ["file"], follow, "file long, block long, inside boolean", ["block"]))
    found = cut.where(F.col("kind").isin(WHOLE, STRAY)).select("file", F.col("block").alias("owner"), "kind", "known", "text").union(
        stitched(cut, "").select("file", "owner", F.lit(WHOLE), "known", "text"))
    mine = found.join(entered.withColumnRenamed("block", "owner"), ["file", "owner"]).where(F.coalesce("known", "inside"))
    return mine.select(F.when(F.col("kind") == WHOLE, F.col("text")).otherwise(F.raise_error(
        F.concat(F.lit("not an object in the features array: "), F.col("text")))).alias("text"))
