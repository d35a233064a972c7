"""Benchmark decontamination by greedy string tiling.

An item's words are covered by tiles: the longest run of words that the item and a document share
and that no tile uses yet is marked in both, again and again, down to ``min_match`` words. Tiles
need not be in order, so a re-ordered passage is covered as well. A document is contaminated by an
item if tiles cover at least ``threshold`` of the item's words.

* Seeds: a tile holds a run of ``min_match`` words found in both. The items' seeds are a hash index
  that every task probes with its documents' word runs (a map-side join: documents are not
  shuffled); only (document, item) pairs whose shared seeds could reach the threshold are tiled.
* Tiling is by running Karp-Rabin: rolling hashes of all unmarked runs of the current length, the
  length falling from the longest match to ``min_match``; equal hashes are compared word by word.
* The index is broadcast in blocks of items. A block's size is bounded by ``BLOCK_CHARS``
  characters of item text (one item at least), whatever the number of items; documents are read
  once per block.

Words are runs of letters, digits and underscores, lower-cased.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, prepare, slices, utf8

MIN_MATCH = 5
THRESHOLD = 0.5
BLOCK_CHARS = 16 << 20

_BASE = 1_000_003
_MOD = (1 << 61) - 1
_WORDS = re.compile(r"\w+").findall


def words(text: str) -> list[str]:
    return _WORDS(text.lower())


def _rolling(values: list[int], size: int) -> Iterator[int]:
    """Karp-Rabin hash of every run of ``size`` values, each from the one before."""
    top, h = pow(_BASE, size - 1, _MOD), 0
    for i, v in enumerate(values):
        if i >= size:
            h -= values[i - size] * top
        h = (h * _BASE + v) % _MOD
        if i >= size - 1:
            yield h


def _free_runs(values: list[int], marked: bytearray, size: int) -> Iterator[tuple[int, int]]:
    """(start, hash) of the unmarked runs of ``size`` values."""
    last = -1  # place of the last marked value
    for start, h in enumerate(_rolling(values, size)):
        if start == 0:
            last = max((j for j in range(size) if marked[j]), default=-1)
        elif marked[start + size - 1]:
            last = start + size - 1
        if last < start:
            yield start, h


def tiles(item: list[int], doc: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """(item start, document start, length) of the greedy tiling. Values below 0 match nothing.
    Equal lengths go by item start, then document start."""
    used_item = bytearray(v < 0 for v in item)
    used_doc = bytearray(v < 0 for v in doc)
    found: list[tuple[int, int, int]] = []
    size = max(min_match, len(item) // 2)
    while size >= min_match:
        by_hash: dict[int, list[int]] = defaultdict(list)
        if len(item) >= size and len(doc) >= size:
            for a, h in _free_runs(item, used_item, size):
                by_hash[h].append(a)
        matches, longest = [], 0
        if by_hash:
            for b, h in _free_runs(doc, used_doc, size):
                for a in by_hash.get(h, ()):
                    if item[a:a + size] != doc[b:b + size]:
                        continue
                    n = size
                    while (a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n]
                           and not used_item[a + n] and not used_doc[b + n]):
                        n += 1
                    matches.append((n, a, b))
                    longest = max(longest, n)
        if longest > size:  # the longest first
            size = longest
            continue
        for n, a, b in sorted(matches, key=lambda m: (m[1], m[2])):
            if not any(used_item[a:a + n]) and not any(used_doc[b:b + n]):
                used_item[a:a + n] = used_doc[b:b + n] = b"\x01" * n
                found.append((a, b, n))
        # all matches left are shorter
        size = max(min_match, size - 1 - size // 4) if size > min_match else 0
    return found


class SeedIndex:
    """The word runs of a block of items, by hash."""

    def __init__(self, items: list[tuple[int, str]], min_match: int, threshold: float) -> None:
        self.min_match, self.threshold = min_match, threshold
        self.ids: list[int | None] = []
        self.values: list[list[int]] = []
        self.vocabulary: dict[str, int] = {}
        keys, places = [], []
        self.whole: dict[int, list[int]] = defaultdict(list)  # items shorter than a seed, by length
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text or "")]
            if not ids:
                continue
            at = len(self.ids)
            self.ids.append(item_id)
            self.values.append(ids)
            if len(ids) < min_match:
                self.whole[len(ids)].append(at)
                continue
            for place, key in enumerate(self.keys(np.array(ids, np.uint64), min_match).tolist()):
                keys.append(key)
                places.append((at, place))
        order = np.argsort(np.array(keys, np.uint64), kind="stable")
        self.seeds = np.array(keys, np.uint64)[order]
        self.places = np.array(places, np.int64).reshape(-1, 2)[order]

    @staticmethod
    def keys(ids: np.ndarray, size: int) -> np.ndarray:
        h = np.zeros(len(ids) - size + 1, np.uint64)
        for k in range(size):
            h = (h ^ ids[k:k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def hits(self, text: str) -> list[dict]:
        """One entry per item that the text covers to the threshold."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words(text)], np.int64)
        if not len(ids) or not ids.any():
            return []
        found = []
        for size, items in self.whole.items():
            for at in items:
                if self._holds(ids, self.values[at]):
                    found.append(self._entry(at, [(0, 0, size)]))
        m = self.min_match
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        if len(ids) < m or not len(self.seeds):
            return found
        inside = np.flatnonzero(known[m:] - known[:-m] == m)  # runs of known words only
        if not len(inside):
            return found
        runs = np.lib.stride_tricks.sliding_window_view(ids, m)[inside].astype(np.uint64)
        h = np.zeros(len(inside), np.uint64)
        for k in range(m):
            h = (h ^ runs[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        lo, hi = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
        by_item: dict[int, tuple[set, set]] = defaultdict(lambda: (set(), set()))
        for j in np.flatnonzero(hi > lo).tolist():
            for at, place in self.places[lo[j]:hi[j]].tolist():
                by_item[at][0].add(int(inside[j]))
                by_item[at][1].add(place)
        for at, (in_doc, in_item) in by_item.items():
            item = self.values[at]
            if self._reach(in_item) < self.threshold * len(item):
                continue
            # of the document only the words in shared seeds can be tiled
            doc: list[int] = []
            end = -1
            for start in sorted(in_doc):
                if start > end:
                    doc.append(-1)
                doc.extend(ids[max(start, end):start + m].tolist())
                end = start + m
            cover = tiles(item, doc, m)
            if sum(t[2] for t in cover) >= self.threshold * len(item):
                found.append(self._entry(at, cover))
        return found

    def _reach(self, places: set) -> int:
        total, end = 0, -1
        for p in sorted(places):
            total += p + self.min_match - max(p, end)
            end = p + self.min_match
        return total

    @staticmethod
    def _holds(ids: np.ndarray, item: list[int]) -> bool:
        if len(ids) < len(item):
            return False
        view = np.lib.stride_tricks.sliding_window_view(ids, len(item))
        return bool((view == np.array(item)).all(axis=1).any())

    def _entry(self, at: int, cover: list[tuple[int, int, int]]) -> dict:
        covered = sum(t[2] for t in cover)
        return {"item_id": self.ids[at], "item_words": len(self.values[at]), "covered_words": covered,
                "n_tiles": len(cover), "longest_tile": max(t[2] for t in cover),
                "coverage": covered / len(self.values[at])}


def _indexes(benchmark: DataFrame, min_match: int, threshold: float, block_chars: int,
             item_col: str, text_col: str) -> Iterator:
    """Broadcast seed indexes of bounded blocks of items."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        rows = items.where(block == b).orderBy("item_id", "text").collect()
        if rows:
            index = SeedIndex([tuple(r) for r in rows], min_match, threshold)
            yield spark.sparkContext.broadcast(index)


HIT_SCHEMA = ("doc_id long, item_id long, item_words int, covered_words int, n_tiles int, "
              "longest_tile int, coverage double")


def contaminations(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                   threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text") -> DataFrame:
    """One row per (document, item) that is covered to the threshold.

    Null and empty texts hold and cover nothing; repeated items count once, repeated documents
    each; an item of fewer words than ``min_match`` must occur whole; null ids are carried along;
    an empty table on either side gives an empty result; other columns are ignored."""
    spark = prepare(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("body"))

    def search(index) -> Callable:
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = None
            for batch in slices(batches, "body"):
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("body").to_pylist()
                found = [{"doc_id": i, **hit} for i, t in zip(ids, texts)
                         for hit in index.value.hits(t.decode())]
                schema = schema or pa.schema([
                    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int32()),
                    ("covered_words", pa.int32()), ("n_tiles", pa.int32()),
                    ("longest_tile", pa.int32()), ("coverage", pa.float64())])
                yield pa.RecordBatch.from_pylist(found, schema=schema)
        return work

    result = spark.createDataFrame([], HIT_SCHEMA)
    for index in _indexes(benchmark, min_match, threshold, block_chars, item_col, item_text_col):
        result = result.union(rows.mapInArrow(search(index), HIT_SCHEMA))
    return result


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                        threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS,
                        text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that cover an item to the threshold; a filter in place, so no
    row is shuffled and rows without an id are judged as well. Columns are those of ``docs``."""
    prepare(docs)

    def keep(index) -> Callable:
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_col):
                texts = batch.column(text_col).to_pylist()
                yield batch.filter(pa.array([not (t and index.value.hits(t)) for t in texts], pa.bool_()))
        return work

    result = docs
    for index in _indexes(benchmark, min_match, threshold, block_chars, item_col, item_text_col):
        result = result.mapInArrow(keep(index), docs.schema)
    return result


def op7_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
