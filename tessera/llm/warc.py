"""WARC segments and their fixity audit by Merkle trees.

``write_segments`` writes pages as WARC/1.1 response records, each a gzip member of its own, into
segment files (one per task, in input order) and returns the offset index of all records. An audit
hashes the bytes that a replica holds in every record's offset range: the leaves of a tree. A node
of the next level hashes the offset range and the hashes of ``FAN`` neighbours in offset order, up to a
root per segment, and on over the segments up to one root. Two replicas are compared from the top;
below a node that agrees nothing is read, so the work of a comparison follows the damage.

Groups never exceed ``FAN`` rows; files are named by task attempt, and only those in the index count.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import place, prepare, slices, stored, utf8
from tessera.session import scratch_path

FAN = 16
TOP = -1  # the part that holds the tree over segments
INDEX = "segment long, record long, page_id long, path string, offset long, length long, sha256 string"


def record(page_id: int | None, url: str, body: bytes) -> bytes:
    """One response record, uncompressed."""
    name = "-" if page_id is None else str(page_id)
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{name}>\r\n"
            f"WARC-Target-URI: {url}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


def write_segments(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   body_col: str = "html") -> DataFrame:
    """The offset index (see ``INDEX``), itself a written table, of freshly written segments.

    Null urls and bodies are empty, null ids are kept, repeated rows are records of their own; an
    empty table writes nothing; other columns are ignored."""
    spark = prepare(pages)
    folder = folder or scratch_path(spark, "warc")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, out, at, n = TaskContext.get().partitionId(), None, 0, 0
        path = f"{folder}/segment-{segment:06d}-{uuid.uuid4().hex}.warc.gz"
        for batch in slices(batches, "body"):
            if out is None and batch.num_rows:
                store, base = place(path)
                store.create_dir(base.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(base, compression=None, buffer_size=1 << 20)
            offsets, sizes, digests = [], [], []
            for page_id, url, body in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "body"))):
                data = gzip.compress(record(page_id, url, body), 1, mtime=0)
                out.write(data)
                offsets.append(at)
                sizes.append(len(data))
                digests.append(hashlib.sha256(data).hexdigest())
                at += len(data)
            rows = len(offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment] * rows, pa.int64()), pa.array(range(n, n + rows), pa.int64()),
                 batch.column("id"), pa.array([path] * rows, pa.string()), pa.array(offsets, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                names=["segment", "record", "page_id", "path", "offset", "length", "sha256"])
            n += rows
        if out is not None:
            out.close()

    rows = pages.select(F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(url_col), F.lit("")).alias("url"), utf8(F.col(body_col)).alias("body"))
    return stored(rows.mapInArrow(work, INDEX), "warc-index")


def copy_segments(index: DataFrame, folder: str | None = None, damaged: Column | None = None) -> DataFrame:
    """Copies every segment to another folder; (segment, copy) of each, a written table. For drills
    ``damaged`` marks records of the index in whose middle a byte is turned over on the way."""
    spark = prepare(index)
    folder = folder or scratch_path(spark, "warc-copy")
    marked = F.coalesce(F.lit(False) if damaged is None else damaged, F.lit(False))
    rows = index.select("segment", "record", "path", "offset", "length", marked.alias("hit"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = out = None
        path = name = ""
        for batch in batches:
            done: dict[str, list] = {"segment": [], "copy": []}
            for row in batch.to_pylist():
                if row["path"] != path:
                    for f in filter(None, (source, out)):
                        f.close()
                    path = row["path"]
                    name = f"{folder}/{path.rpartition('/')[2]}.{uuid.uuid4().hex}"
                    store, base = place(name)
                    store.create_dir(base.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(base, compression=None, buffer_size=1 << 20)
                    store, base = place(path)
                    source = store.open_input_stream(base, compression=None, buffer_size=1 << 20)
                    done["segment"].append(row["segment"])
                    done["copy"].append(name)
                data = bytearray(source.read(row["length"]))
                if row["hit"] and data:
                    data[len(data) // 2] ^= 0xFF
                out.write(bytes(data))
            yield pa.RecordBatch.from_pydict({"segment": pa.array(done["segment"], pa.int64()),
                                              "copy": pa.array(done["copy"], pa.string())})
        for f in filter(None, (source, out)):
            f.close()

    # a segment is written in order by one task; segments are bounded by the writer's input split
    moved = rows.repartition("segment").sortWithinPartitions("segment", "record").mapInArrow(
        work, "segment long, copy string")
    return stored(moved, "warc-copies")


def leaves(index: DataFrame) -> DataFrame:
    """(segment, record, lo, hi, hash) of what the files of ``index`` hold now. A file that is gone or
    too short gives the hash of the bytes that are left."""
    prepare(index)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source = "", None
        for batch in batches:
            hashes = []
            for at, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if at != path:
                    if source is not None:
                        source.close()
                    store, base = place(at)
                    found = store.get_file_info(base).type == fs.FileType.File
                    path, source = at, store.open_input_file(base) if found else None
                data = b""
                if source is not None and offset < source.size():
                    data = source.read_at(length, offset)
                hashes.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("segment"), batch.column("record"), batch.column("offset"),
                 pc.add(batch.column("offset"), batch.column("length")), pa.array(hashes, pa.string())],
                names=["segment", "record", "lo", "hi", "hash"])
        if source is not None:
            source.close()

    rows = index.select("segment", "record", "path", "offset", "length")
    return rows.mapInArrow(work, "segment long, record long, lo long, hi long, hash string")


def _parents(nodes: DataFrame, fan: int) -> DataFrame:
    group = F.sort_array(F.collect_list(F.struct("node", "lo", "hi", "hash")))
    return (nodes.groupBy("part", F.floor(F.col("node") / fan).alias("up")).agg(group.alias("kids"))
            .select("part", F.col("up").alias("node"), F.col("kids")[0]["lo"].alias("lo"),
                    F.get("kids", F.size("kids") - 1)["hi"].alias("hi"),
                    F.sha2(F.array_join(F.transform("kids", lambda k: F.concat_ws(
                        ":", k["node"], k["lo"], k["hi"], k["hash"])), "|"), 256).alias("hash")))


def _depth(count: int, fan: int) -> int:
    depth = 0
    while count > 1:
        count, depth = -(-count // fan), depth + 1
    return depth


def trees(leaf_rows: DataFrame, fan: int = FAN) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels (part, node, lo, hi, hash), leaves first: those within segments, whose top is node 0 of
    each segment, and those over the segments."""
    base = stored(leaf_rows.select(F.col("segment").alias("part"), F.col("record").alias("node"), "lo", "hi", "hash"),
                  "merkle")
    most, segments = base.agg(F.coalesce(F.max("node"), F.lit(-1)) + 1, F.coalesce(F.max("part"), F.lit(-1)) + 1).first()
    inner = [base]
    for _ in range(_depth(most, fan)):
        inner.append(_parents(inner[-1], fan).checkpoint())
    outer = [inner[-1].select(F.lit(TOP).cast("long").alias("part"), F.col("part").alias("node"), "lo", "hi", "hash")]
    for _ in range(_depth(segments, fan)):
        outer.append(_parents(outer[-1], fan).checkpoint())
    return inner, outer


def _differences(a: DataFrame, b: DataFrame) -> DataFrame:
    return (a.select("part", "node", F.col("hash").alias("a")).join(
        b.select("part", "node", F.col("hash").alias("b")), ["part", "node"], "full")
        .where(~F.col("a").eqNullSafe(F.col("b"))))


def _below(wrong: DataFrame, level: DataFrame, fan: int) -> DataFrame:
    """The nodes of ``level`` under the differing nodes of the level above."""
    up = wrong.select(F.col("part").alias("_p"), F.col("node").alias("_n"))
    return level.join(up, (F.col("part") == F.col("_p")) & (F.floor(F.col("node") / fan) == F.col("_n")), "left_semi")


def audit(index: DataFrame, left: DataFrame, right: DataFrame, fan: int = FAN) -> DataFrame:
    """Records whose bytes differ between two replicas: the index rows with ``status`` ``first`` (only the first
    replica disagrees with the recorded hash), ``second`` or ``both``.

    ``left`` and ``right`` are the index with the ``path`` of each replica's file. Replicas that agree, empty
    ones included, give no rows."""
    prepare(index)
    (a_in, a_out), (b_in, b_out) = trees(leaves(left), fan), trees(leaves(right), fan)
    wrong = _differences(a_out[-1], b_out[-1])
    for a, b in zip(a_out[-2::-1], b_out[-2::-1]):
        wrong = _differences(_below(wrong, a, fan), _below(wrong, b, fan))
    wrong = wrong.select(F.col("node").alias("part"), F.lit(0).cast("long").alias("node"), "a", "b")
    for a, b in zip(a_in[-2::-1], b_in[-2::-1]):
        wrong = _differences(_below(wrong, a, fan), _below(wrong, b, fan))
    found = wrong.select(F.col("part").alias("segment"), F.col("node").alias("record"), "a", "b")
    return index.join(found, ["segment", "record"]).withColumn(
        "status", F.when(F.col("a") == F.col("sha256"), "second").when(F.col("b") == F.col("sha256"), "first")
        .otherwise("both")).drop("a", "b")


def drilled(page_id: Column) -> Column:
    """Records that the registered drill damages: about one in 256, by a hash of the id."""
    return F.substring(F.md5(page_id.cast("string")), 1, 2) == "00"


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages, copies the segments with known damage and locates it by the audit."""
    index = write_segments(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    copies = copy_segments(index, damaged=drilled(F.col("page_id")))
    second = index.join(copies, "segment").withColumn("path", F.col("copy")).drop("copy")
    return audit(index, index, second).select("page_id", "status")


OP2_SQL = """
SELECT page_id, 'second' AS status FROM pages WHERE substr(md5(page_id::VARCHAR), 1, 2) = '00'
"""
