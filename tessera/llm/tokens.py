"""Token ids as length-delimited binary records.

A record file is a run of frames, one per document; integers are little-endian:

    u64 payload length | u32 masked checksum of these 8 bytes | payload | u32 masked checksum of it

The payload is one serialized sequence: u8 bytes per id (2 or 4), u8 whether the document has an
id, i64 document id, then the token ids. A checksum is masked so that data which holds checksums
does not check itself: the CRC-32 turned right by 15 bits plus a constant, modulo 2^32.

Beside each record file lies an index: u64 offset and u32 number of token ids per record, so that
single records can be read in any order. Documents are in ascending id order within and across
files (a range partition per file). Files are written by the tasks to the shared folder under a
name of their own attempt, and a manifest table lists those that count: a repeated attempt leaves
at most a file that nobody reads.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, place, prepare, slices, stored, utf8
from tessera.session import scratch_path

END_ID = 2
CACHE_WORDS = 500_000
MASK_DELTA = 0xA282EAD8  # fixed value of the framing

HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
PREFIX = struct.Struct("<BBq")
INDEX = np.dtype([("offset", "<u8"), ("n_ids", "<u4")])

MANIFEST = "shard int, path string, n_docs long, n_ids long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers in one bytes object.

    For a tokenizer that marks word ends and drops white space, a text's ids are the ids of its
    blank-separated parts one after another: ids of parts are kept (two generations of
    ``CACHE_WORDS`` parts each) and the library sees a part only when it is new. Other tokenizers,
    and texts that may spell a special token, go to the library whole."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.by_part = getattr(self.tokenizer.model, "end_of_word_suffix", None) == "</w>"
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.special = [t for t in (a.content for a in self.tokenizer.get_added_tokens_decoder().values()) if t]
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_part or any(s in text for s in self.special):
            return self.whole(text)
        if text.isascii():
            text = text.lower()  # what the tokenizer does; fewer parts differ
        parts = text.replace("\n", " ").split(" ")
        ids = list(map(self.young.get, parts))
        if None in ids:
            self._learn({p for p, i in zip(parts, ids) if i is None})
            ids = list(map(self.young.get, parts))
            if len(self.young) > CACHE_WORDS:
                self.old, self.young = self.young, {"": b""}
        return b"".join(ids)

    def _learn(self, missing: set[str]) -> None:
        plain, marked = [], []
        for part in missing:
            if (ids := self.old.get(part)) is not None:
                self.young[part] = ids
            elif part.lower().isalpha():
                plain.append(part)
            elif part[-1] in ".," and part[:-1].lower().isalpha():
                marked.append(part)
                plain.append(part[:-1])
            else:
                self.young[part] = self.whole(part)
        rest = []
        for part in plain:
            if part in self.young:
                continue
            if (ids := self.old.get(part)) is not None:
                self.young[part] = ids
            elif part.isascii():  # one word, which no normalisation but lower case changes
                ids = [t.id for t in self.tokenizer.model.tokenize(part.lower())]
                self.young[part] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(part)
        if rest:
            # letters only: one word each, and its last id is marked as a word's end
            ids = np.array(self.tokenizer.encode_batch_fast(
                [" ".join(rest)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(rest):
                data, at = ids.tobytes(), 0
                for part, end in zip(rest, ends.tolist()):
                    self.young[part] = data[4 * at:4 * end]
                    at = end
            else:
                for part in rest:
                    self.young[part] = self.whole(part)
        for part in marked:
            mark = self.young.get(part[-1])
            if mark is None:
                mark = self.young[part[-1]] = self.whole(part[-1])
            self.young[part] = self.young[part[:-1]] + mark


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker process: its parts stay known from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    if width == 2:
        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    payload = PREFIX.pack(width, doc_id is not None, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return b"".join((size, TAIL.pack(masked_crc(size)), payload, TAIL.pack(masked_crc(payload))))


def unframe(read) -> tuple[int | None, bytes] | None:
    """The next record of ``read(n) -> bytes`` as (document id, ids as 32-bit); None at the end."""
    head = read(HEAD.size)
    if not head:
        return None
    size, check = HEAD.unpack(head)
    if masked_crc(head[:8]) != check:
        raise ValueError("record length fails its checksum")
    payload, tail = read(size), read(TAIL.size)
    if len(payload) != size or len(tail) != TAIL.size or masked_crc(payload) != TAIL.unpack(tail)[0]:
        raise ValueError("record fails its checksum")
    width, known, doc_id = PREFIX.unpack_from(payload)
    ids = payload[PREFIX.size:]
    if width == 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return (doc_id if known else None), ids


def write_records(docs: DataFrame, tokenizer_file: str, folder: str | None = None, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes every document's ids plus ``end_id`` and returns the manifest (shard, path, n_docs,
    n_ids), itself a written table. ``path`` has no suffix; the files end in .rec and .idx.

    Null texts are empty (``end_id`` alone); null ids come first; repeated rows are written as often
    as they occur; an empty table writes no file; other columns are ignored."""
    spark = prepare(docs)
    folder = folder or scratch_path(spark, "tokens")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder, end = _encoder(tokenizer_file), np.array([end_id], "<u4").tobytes()
        out, index, at, total = None, [], 0, 0
        for batch in slices(batches, "body"):
            if not batch.num_rows:
                continue
            if out is None:
                store, base = place(folder)
                store.create_dir(base, recursive=True)
                name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(f"{base}/{name}.rec", buffer_size=1 << 20)
            for doc_id, body in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist()):
                ids = encoder.encode(body.decode()) + end
                data = frame(doc_id, ids, encoder.width)
                out.write(data)
                index.append((at, len(ids) // 4))
                at += len(data)
                total += len(ids) // 4
        if out is not None:
            out.close()
            with store.open_output_stream(f"{base}/{name}.idx") as f:
                f.write(np.array(index, INDEX).tobytes())
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name}"],
                "n_docs": pa.array([len(index)], pa.int64()), "n_ids": pa.array([total], pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(F.col(text_col)).alias("body"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    return stored(rows.mapInArrow(work, MANIFEST), "manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard, record) of every record, from the files: frames
    are checked, and each file against its index. ``start`` counts the ids of all documents before."""
    prepare(manifest)
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = place(row["path"])
                with store.open_input_stream(f"{path}.idx") as f:
                    index = np.frombuffer(f.read(), INDEX)
                ids, starts, sizes, crcs = [], [], [], []
                at = row["before"]
                with store.open_input_stream(f"{path}.rec", buffer_size=1 << 20) as f:
                    while (record := unframe(f.read)) is not None:
                        ids.append(record[0])
                        starts.append(at)
                        sizes.append(len(record[1]) // 4)
                        crcs.append(zlib.crc32(record[1]))
                        at += sizes[-1]
                if len(index) != len(ids) or not np.array_equal(index["n_ids"], sizes):
                    raise ValueError(f"{path}: records and index differ")
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()),
                    "shard": pa.array([row["shard"]] * len(ids), pa.int32()),
                    "record": pa.array(range(len(ids)), pa.int64())})

    n = max(1, manifest.count())
    return files.repartition(n).mapInArrow(
        work, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, record long")


def read_record(path: str, record: int) -> tuple[int | None, np.ndarray]:
    """One record by its place, through the index: for shuffled reads."""
    store, base = place(path)
    with store.open_input_file(f"{base}.idx") as f:
        offset = int(np.frombuffer(f.read_at(INDEX.itemsize, record * INDEX.itemsize), INDEX)["offset"][0])
    with store.open_input_file(f"{base}.rec") as f:
        f.seek(offset)
        doc_id, ids = unframe(f.read)
    return doc_id, np.frombuffer(ids, "<u4")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """Write, then read back: (doc_id, start, n_tokens, ids_crc32)."""
    manifest = write_records(docs, tokenizer_file or default_tokenizer())
    return read_records(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
