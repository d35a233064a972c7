"""SimHash near-duplicates with BK-trees.

A document's fingerprint has a bit for each of 64 votes over the XXH64 hashes of its word
shingles. Fingerprints are linked when they differ in at most ``max_bits`` bits.

* Only distinct fingerprints are compared: exact copies meet in a grouped minimum.
* Distinct fingerprints are dealt into shards by pigeonhole: cut into ``max_bits + 1`` blocks, two
  fingerprints within ``max_bits`` bits agree on a whole block. A shard of more than ``SHARD_ROWS``
  fingerprints is dealt again in the same way, by blocks of the bits that its members need not agree on,
  until it is small or so few bits are open that it holds at most ``2 ** OPEN_BITS``.
* Each shard gets a BK-tree: a child hangs under its parent by their Hamming distance, and a search
  follows only the edges within the radius. The tree is built where the shard's queries are: the
  fingerprints of a corpus have no bounded size, so a tree is sent to no one else.
* Links, reduced to a spanning forest in each shard, go to ``components``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, prepare, slices, stored, utf8
from tessera.llm.components import components
from tessera.operators.streams import free_name

BITS = 64
SHARD_ROWS = 1024
OPEN_BITS = 13  # a shard with no more open bits than this is not dealt again


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text; 0 without words."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII blanks split
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if n <= shingle:
        hashes = [digest(joined, seed)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[:n - shingle + 1].tolist()
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1:].tolist())]
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.frombuffer(b"".join(hashes[i:i + 65536]), np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fp bigint) for every document; a null text has no words."""
    prepare(docs)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            prints = [fingerprint(t, shingle, seed) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(prints, pa.int64())], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(F.col(text_col)).alias("body"))
    return rows.mapInArrow(work, "id long, fp long")


class BKTree:
    """Integers by Hamming distance."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int) -> None:
        node = [value, {}]
        if self.root is None:
            self.root = node
            return
        at = self.root
        while True:
            d = (at[0] ^ value).bit_count()
            if d == 0:
                return
            nxt = at[1].get(d)
            if nxt is None:
                at[1][d] = node
                return
            at = nxt

    def near(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            at, children = todo.pop()
            d = (at ^ value).bit_count()
            if d <= radius:
                found.append(at)
            if children:
                todo.extend(c for e, c in children.items() if d - radius <= e <= d + radius)
        return found


def _forest(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """(value, root) of a spanning forest of the links among ``values``."""
    tree, parent = BKTree(), {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for v in values:
        if v in parent:
            continue
        parent[v] = v
        for other in tree.near(v, radius):
            a, b = find(v), find(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(v)
    for v in parent:
        if (root := find(v)) != v:
            yield v, root


def _shard_trees(radius: int):
    mask = (1 << BITS) - 1

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((path, shard, fp & mask) for b in batches
                for path, shard, fp in zip(*(b.column(c).to_pylist() for c in range(3))))
        out: list[tuple[int, int]] = []
        for _, group in groupby(rows, key=lambda r: r[:2]):  # sorted by shard, of bounded size
            out.extend(_forest([fp for *_, fp in group], radius))
            if len(out) >= 50_000:
                yield _links(out)
                out = []
        yield _links(out)

    return work


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], names=["src", "dst"])


def _blocks(open_: list[int], max_bits: int) -> list[list[int]]:
    """The bits ``open_`` cut into ``max_bits + 1`` blocks."""
    cuts = [round(i * len(open_) / (max_bits + 1)) for i in range(max_bits + 2)]
    return [open_[a:b] for a, b in zip(cuts, cuts[1:])]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _deal(rows: DataFrame, paths: dict[int, list[int]], max_bits: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """``rows`` (path, fp) in every shard of the next level, (path, shard, fp), and its paths. A path is a choice of
    blocks; the bits that it leaves open are its value in ``paths``. A shard is the fingerprint in all chosen blocks."""
    below: dict[int, list[int]] = {}
    choices = []
    for path, open_ in paths.items():
        for block in _blocks(open_, max_bits):
            left = [b for b in open_ if b not in block]
            choices.append((path, len(below), _signed([b for b in range(BITS) if b not in left])))
            below[len(below)] = left
    if len(paths) == 1:  # a join on a constant would be a cross join
        each = F.array(*[F.struct(F.lit(own).alias("own"), F.lit(shared).cast("long").alias("shared")) for _, own, shared in choices])
        dealt = rows.select("fp", F.explode(each).alias("c")).select("fp", "c.own", "c.shared")
    else:  # a few rows, max_bits + 1 for each path
        table = rows.sparkSession.createDataFrame(choices, "path int, own int, shared long")
        dealt = rows.join(F.broadcast(table), "path")
    return dealt.select(F.col("own").alias("path"), F.col("fp").bitwiseAND(F.col("shared")).alias("shard"), "fp"), below


def near_links(prints: DataFrame, max_bits: int = 2, shard_rows: int = SHARD_ROWS, open_bits: int = OPEN_BITS) -> DataFrame:
    """(src, dst): links that connect all distinct ``fp`` within ``max_bits`` bits.

    A shard that is dealt again sends each of its fingerprints to ``max_bits + 1`` smaller ones; its pairs within
    the radius meet in one of them at least, since they agree on a block of the open bits as well."""
    prepare(prints)
    paths: dict[int, list[int]] = {0: list(range(BITS))}
    rows = prints.select(F.lit(0).alias("path"), "fp")
    ready: list[DataFrame] = []
    while True:
        dealt, paths = _deal(rows, paths, max_bits)
        dealt = dealt.checkpoint()
        sizes = dealt.groupBy("path", "shard").agg(F.count("*").alias("n")).where("n > 1")
        last = max(map(len, paths.values())) <= open_bits
        small = sizes if last else sizes.where(F.col("n") <= shard_rows)
        ready.append(dealt.join(small.drop("n"), ["path", "shard"], "left_semi"))
        large = sizes.where(F.col("n") > shard_rows).drop("n")
        if last or large.isEmpty():
            break
        rows = dealt.join(large, ["path", "shard"], "left_semi").select("path", "fp").distinct()
    every = ready[0]
    for more in ready[1:]:
        every = every.union(more)
    return (every.select("path", "shard", "fp").repartition("path", "shard").sortWithinPartitions("path", "shard")
            .mapInArrow(_shard_trees(max_bits), "src long, dst long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    ``component_id`` is the smallest id that is reachable over links: that of a row without an id too, and null
    only where no row of a component has one. Null and blank texts have fingerprint zero and link like any
    other; repeated rows give repeated rows; an empty table gives an empty result; other columns are ignored."""
    prints = stored(fingerprints(docs, shingle, seed, id_col, text_col), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-prints")
    roots = components(near_links(nodes, max_bits)).toDF("fp", "root")
    linked = nodes.join(roots, "fp")
    heads = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    merged = linked.join(heads, "root").select("fp", "component_id")
    # written before the join, which can then split the rows of a fingerprint with many copies over tasks
    of = stored(nodes.join(merged, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")), "components")
    return prints.join(of, "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one of the smallest ``doc_id``, then of
    the smallest text hash; a row without an id only where no row of its group has one.

    Rows are compared one by one, whatever their ids. Columns are those of ``docs``, whatever their names."""
    row = free_name("_row", docs.columns)
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows, shingle, max_bits, id_col=row).select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.md5("text").alias("hash"), F.col(row).alias("row"))
    kept = (rows.select(F.col(row).alias("row"), order.alias("order")).join(groups, "row")
            .groupBy("group").agg(F.min("order").alias("first")).select(F.col("first.row").alias(row)))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
