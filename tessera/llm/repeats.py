"""Removal of long repeated byte strings with run-length Burrows-Wheeler indexes.

Every byte that lies in a string of ``width`` bytes which also starts anywhere else, in any text, is
marked. Texts are UTF-8 bytes, matches never cross texts, and the input is judged as it is.

1. Sampling. Of every window of ``width`` bytes the position of the least hash of its ``gram``-byte
   strings is an anchor. Equal windows hold equal anchors at the same place, so only windows around
   anchors whose gram occurs again can repeat. An anchor's chunk is the union of the windows that
   it was chosen in.
2. Equal chunks repeat as a whole: counting (gram, chunk) hashes settles nearly all copies.
3. A gram in several different chunks is looked at byte by byte. One chunk per distinct text goes to
   the shard of its gram. A shard's chunks, end to end, get a Burrows-Wheeler transform, compressed
   to runs. The longest match with the neighbour in suffix order is computed only at the sampled run
   ends; inside a run it shrinks by one from each position to the next, so one pass over the text
   streams the matching statistics of all positions. Positions with statistics of ``width`` and
   more start a repeated window.
4. Grams in more than ``SHARD_CHUNKS`` different chunks (a common passage in ever new surroundings)
   would fill a shard: their windows are counted by hash instead, which is exact as well and has
   no groups.

Hashes of chunks and windows are 64 bits of XXH3, taken together with the gram's own hash. A text is
known by its MD5, whatever its id: rows of equal texts share their spans.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, prepare, slices, stored, utf8

WIDTH = 400
GRAM = 200
SHARD_CHUNKS = 2048
SHARD_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size``-byte string, by doubling: strings of length 2n from two of length n."""
    done, length = None, 0
    part, n = _BYTES[data], 1
    while size:
        if size & 1:
            if done is None:
                done, length = part, n
            else:
                m = len(data) - length - n + 1
                done = done[:m] * np.uint64(pow(_BASE, n, 1 << 64)) + part[length:length + m]
                length += n
        size >>= 1
        if size:
            m = len(part) - n
            part = part[:m] * np.uint64(pow(_BASE, n, 1 << 64)) + part[n:n + m]
            n *= 2
    done = done ^ (done >> np.uint64(29))
    done *= np.uint64(0xBF58476D1CE4E5B9)
    return done ^ (done >> np.uint64(32))


def _slide(values: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``size`` neighbours."""
    n = 1
    while 2 * n <= size:
        values = best(values[:-n], values[n:])
        n *= 2
    return best(values[:n - size], values[size - n:]) if n < size else values


def anchors(text: bytes, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(position, gram hash, first window start, last window start) of a text's anchors: the windows
    from first to last are those whose least gram hash lies at the position (the rightmost if equal)."""
    if len(text) < width:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    grams = _grams(np.frombuffer(text, np.uint8), gram)
    # the upper half of the hash, then the place, so that the rightmost of equals is least
    place = np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64)
    least = _slide(grams & np.uint64(0xFFFFFFFF00000000) | place, width - gram + 1, np.minimum)
    at = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return at[first], grams[at[first]], first, last


ANCHORS = "key binary, gram long, chunk long, lo int, size int"


def anchor_rows(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """One row per anchor of ``texts`` (key, body): its gram, its chunk's hash, and the chunk's
    place (lo, size)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 2 << 20):
            parts, owner = [], []
            for i, text in enumerate(batch.column("body").to_pylist()):
                at, own, first, last = anchors(text, width, gram)
                if not len(at):
                    continue
                chunk = np.fromiter(
                    (xxhash.xxh3_64_intdigest(text[a:b + width], p - a) for p, a, b in
                     zip(at.tolist(), first.tolist(), last.tolist())), np.uint64, len(at))
                parts.append((own, chunk, first, last - first + width))
                owner.extend([i] * len(at))
            if not parts:
                continue
            own, chunk, lo, size = (np.concatenate(c) for c in zip(*parts))
            take = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(take), pa.array(own.view(np.int64)), pa.array(chunk.view(np.int64)),
                 pa.array(lo.astype(np.int32)), pa.array(size.astype(np.int32))],
                names=["key", "gram", "chunk", "lo", "size"])

    return texts.mapInArrow(work, ANCHORS)


# --- the index of one shard -------------------------------------------------------------------

def suffix_order(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Order of the suffixes, each up to the end of its chunk (``ends``; an end sorts before any byte,
    equal suffixes go by place), and for 7, 14, 28, ... bytes the ranks of the strings of that length."""
    n = len(data)
    place = np.arange(n)
    value = data.astype(np.int64) + 1  # 9 bits each; 0 is the end
    key = np.zeros(n, np.int64)
    for k in range(7):
        far = place + k
        key = key << 9 | np.where(far < ends, value[np.minimum(far, n - 1)], 0)
    longest, known, levels = int((ends - place).max()), 7, []
    while True:
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]) + 1
        levels.append((known, rank))
        if known >= longest or int(rank.max()) == n:
            return np.argsort(rank * n + place), levels
        far = place + known
        key = rank * (n + 2) + np.where(far < ends, rank[np.minimum(far, n - 1)], 0)
        known *= 2


def _common(data: np.ndarray, ends: np.ndarray, levels: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and ``b``: by falling lengths of
    equal strings, the last bytes one by one."""
    last, most = len(data) - 1, np.minimum(ends[a] - a, ends[b] - b)
    length = np.zeros(len(a), np.int64)
    for known, rank in reversed(levels):
        same = rank[np.minimum(a + length, last)] == rank[np.minimum(b + length, last)]
        length += known * (same & (length < most))
    going = length < most
    for _ in range(levels[0][0] - 1):
        going &= data[np.minimum(a + length, last)] == data[np.minimum(b + length, last)]
        length += going
        going &= length < most
    return np.minimum(length, most)


def matching_statistics(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every position the length of its longest match that starts elsewhere, from the runs of
    the Burrows-Wheeler transform."""
    n = len(data)
    order, levels = suffix_order(data, ends)
    place = np.arange(n)
    begins = np.concatenate([[True], ends[1:] != ends[:-1]])
    # the transform in runs; a chunk's first byte is preceded by a mark of its own
    transform = np.where(begins[order], -1, data[order - 1].astype(np.int64))
    edge = np.flatnonzero((transform[1:] != transform[:-1]) | (transform[1:] < 0))
    upper, lower = order[edge], order[edge + 1]  # last suffix of a run, first of the next
    sample = _common(data, ends, levels, upper, lower)
    best = np.zeros(n, np.int64)
    for own in (lower, upper):  # the match with the suffix before, then with the one after
        reach = np.full(n, -1, np.int64)
        reach[own] = sample + own
        # the stream: a match is one shorter at the next position, until a sample says otherwise
        np.maximum(best, np.maximum.accumulate(reach) - place, out=best)
    return best


def repeated_starts(chunks: list[bytes], width: int) -> list[np.ndarray]:
    """For each chunk the places where a string of ``width`` bytes starts that another place of the
    chunks holds too."""
    sizes = np.array([len(c) for c in chunks])
    ends = np.repeat(np.cumsum(sizes), sizes)
    stats = matching_statistics(np.frombuffer(b"".join(chunks), np.uint8), ends)
    return [np.flatnonzero(s >= width) for s in np.split(stats, np.cumsum(sizes)[:-1])]


def _runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes (first, end) that windows at sorted ``starts`` cover."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > width)
    first = starts[np.concatenate([[0], gap + 1])]
    last = starts[np.concatenate([gap, [len(starts) - 1]])]
    return list(zip(first.tolist(), (last + width).tolist()))


SPANS = "key binary, lo int, hi int"


def _shard_spans(width: int):
    def work(table: pa.Table) -> pa.Table:
        starts = repeated_starts(table.column("body").to_pylist(), width)
        rows, los, his = [], [], []
        for i, (found, alone, lo) in enumerate(zip(starts, table.column("alone").to_pylist(),
                                                   table.column("lo").to_pylist())):
            for first, end in _runs(found, width) if alone else ():
                rows.append(i)
                los.append(lo + first)
                his.append(lo + end)
        return pa.table({"key": table.column("key").take(pa.array(rows, pa.int64())),
                         "lo": pa.array(los, pa.int32()), "hi": pa.array(his, pa.int32())})

    return work


def _window_hashes(width: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 256 << 10):
            hashes, owner, at = [], [], []
            for i, body in enumerate(batch.column("body").to_pylist()):
                n = len(body) - width + 1
                hashes.extend(xxhash.xxh3_64_intdigest(body[s:s + width]) for s in range(n))
                owner.extend([i] * n)
                at.extend(range(n))
            take = pa.array(owner, pa.int32())
            lo = pc.add(batch.column("lo").take(take), pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(take), batch.column("gram").take(take), batch.column("alone").take(take),
                 pa.array(np.array(hashes, np.uint64).view(np.int64)), lo],
                names=["key", "gram", "alone", "window", "lo"])

    return work


def repeated_spans(texts: DataFrame, width: int = WIDTH, gram: int = GRAM, shard_chunks: int = SHARD_CHUNKS,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(key, spans array<struct<lo, hi>>) for the distinct ``key`` of ``texts`` (key, body) whose body
    holds repeated windows; spans may overlap. Equal bodies have equal keys and no others."""
    spark = texts.sparkSession
    found = stored(anchor_rows(texts, width, gram), "anchors")
    # written before the join, which can then split the rows of a hot gram over tasks
    grams = stored(found.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("chunk").alias("c0"), F.max("chunk").alias("c1"))
        .where("n > 1").select("gram", (F.col("c0") != F.col("c1")).alias("mixed")), "grams")
    again = stored(found.join(grams, "gram"), "repeated-anchors")
    span = ["key", "lo", (F.col("lo") + F.col("size")).alias("hi")]
    spans = again.where("NOT mixed").select(*span)

    mixed = again.where("mixed")
    kinds = stored(mixed.groupBy("gram", "chunk").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "lo", "size")).alias("at")),
        "chunks")
    spans = spans.union(mixed.join(kinds.where("n > 1").select("gram", "chunk"), ["gram", "chunk"], "left_semi").select(*span))

    variants = kinds.groupBy("gram").agg(F.count("*").alias("variants"), F.min("n").alias("least"))
    total = kinds.agg(F.coalesce(F.sum("at.size"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    # chunks of grams whose chunks all recur are settled
    wanted = kinds.join(variants.where("least = 1"), "gram").select(
        "at.key", F.struct("gram", F.col("n").cast("int").alias("n"), F.col("at.lo").alias("lo"),
                                      F.col("at.size").alias("size"),
                                      (F.col("variants") > shard_chunks).alias("crowded")).alias("c"))
    # a text with a chunk of its own has no copies
    wanted = wanted.groupBy("key").agg(F.collect_list("c").alias("cs"), (F.min("c.n") == 1).alias("unique"))

    def bodies(of: DataFrame) -> DataFrame:
        return (texts.join(of, "key").select("key", "body", F.explode("cs").alias("c"))
                .select("key", "c.gram", "c.lo", (F.col("c.n") == 1).alias("alone"), "c.crowded",
                        F.expr("substring(body, c.lo + 1, c.size)").alias("body")))

    # one body for each chunk, however many copies its text has
    chunks = bodies(wanted.where("unique")).union(
        bodies(wanted.where("NOT unique")).dropDuplicates(["key", "gram", "lo"]))
    chunks = stored(chunks, "variants")
    quiet = chunks.where("NOT crowded").withColumn("shard", F.pmod("gram", F.lit(shards)))
    # a fixed number of tasks: near copies shrink so well in a shuffle that its bytes say little of the work
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 16))
    spans = spans.union(quiet.select("shard", "key", "lo", "alone", "body").repartition(tasks, "shard")
                        .groupBy("shard").applyInArrow(_shard_spans(width), SPANS))

    windows = stored(chunks.where("crowded").select("key", "gram", "lo", "alone", "body").mapInArrow(
        _window_hashes(width), "key binary, gram long, alone boolean, window long, lo int"), "windows")
    twice = stored(windows.groupBy("gram", "window").agg(F.count("*").alias("n")).where("n > 1")
                   .select("gram", "window"), "repeated-windows")
    spans = spans.union(windows.where("alone").join(twice, ["gram", "window"], "left_semi").select(
        "key", "lo", (F.col("lo") + width).alias("hi")))
    return spans.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def merged(spans: Iterable[dict]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def cut(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_bytes, removed array<struct<lo, hi>>, kept binary) for every row: the maximal removed
    byte runs and the remaining bytes.

    Null and empty texts, and texts below ``width`` bytes, lose nothing; null ids are values like any
    other; a repeated row repeats its text, so both lose all their windows; an empty table gives an
    empty result; other columns are ignored."""
    prepare(docs)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), utf8(F.col(text_col)).alias("body")).select(
        "id", F.unhex(F.md5("body")).alias("key"), "body")
    found = repeated_spans(texts.select("key", "body"), width, **options)
    rows = texts.join(found, "key", "left").select("id", "body", "spans")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        for batch in slices(batches, "body"):
            sizes, runs, kept = [], [], []
            for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
                gone = merged(spans or ())
                edges = [0, *(x for g in gone for x in g), len(body)]
                sizes.append(len(body))
                runs.append([{"lo": a, "hi": b} for a, b in gone])
                kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(runs, run), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"])

    return rows.mapInArrow(work, "doc_id long, n_bytes long, removed array<struct<lo int, hi int>>, kept binary")


def op5_repeat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(documents(spark, sf_dir))
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT r, doc_id, b, octet_length(b) AS n FROM d),
w AS (SELECT r, i, md5(b[i:i + 399]) AS h FROM (
        SELECT r, b, unnest(range(1, n - 398)) AS i FROM n WHERE n >= 400)),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
starts AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w SEMI JOIN twice USING (h)),
runs AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i - before > 400 THEN 1 ELSE 0 END)
                       OVER (PARTITION BY r ORDER BY i) AS run FROM starts),
spans AS (SELECT r, run, min(i) AS lo, max(i) + 400 AS hi FROM runs GROUP BY r, run),
cuts AS (SELECT r, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his, sum(hi - lo) AS gone FROM spans GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(len(los), 0)::BIGINT AS n_spans,
       sha256(CASE WHEN los IS NULL THEN b ELSE list_reduce(
           [b[(CASE WHEN k = 1 THEN 1 ELSE his[k - 1] END):(CASE WHEN k > len(los) THEN n ELSE los[k] - 1 END)]
            for k in range(1, len(los) + 2)], lambda x, y: x || y) END) AS kept_sha256
FROM n LEFT JOIN cuts USING (r)
"""
