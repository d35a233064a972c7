"""Exact top-k search by inner product: term-at-a-time accumulation over blocks.

Vectors are whole numbers (components scaled and floored). Every vector is a document whose terms are its
non-zero components: a block of documents is indexed by postings, per term the places in the block and
the weights. A query row is sparse too. For each of its terms the weighted postings are scattered
into a dense array of one score per document of the block; when all terms are done the best k are found by
partition selection, and merged with the best of the blocks before.

The query set may grow with the table, so neither side is broadcast or collected: queries are packed into
blocks of ``QUERY_ROWS``, rows of a table, and a task takes a query block and streams a share of the
candidate blocks from the shared folder, holding one block of either side and k results per query. The
shares' results, k rows per query each, are merged by a ranking.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import place, prepare
from tessera.session import scratch_path

SCALE = 256          # fixed by the query's contract
K = 5
EVERY = 50
BLOCK_ROWS = 8192    # documents whose scores are dense at a time
QUERY_ROWS = 1024    # queries of a block
AT_ONCE = 64         # queries scored together: 64 x 8192 scores stay in a core's cache
CELLS_PER_CORE = 3   # tasks wanted, if there are blocks enough

VECTORS = "row long, id long, terms array<long>"
BLOCKS = "rows array<long>, ids array<long>, sizes array<int>, terms array<long>"
HITS = "query_row long, query_id long, row long, vec_id long, score long"


class ScoreTooLarge(ValueError):
    """A component or a score may not fit into 64 bits."""


def whole_numbers(flat: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of doubles, as 64-bit integers."""
    scaled = np.floor(flat.astype("float64") * scale)
    if len(scaled) and np.abs(scaled).max() >= 2.0 ** 62:
        raise ScoreTooLarge("a scaled component is 2**62 or more")
    return scaled.astype("int64")


def indexed(vectors: DataFrame, id_col: str, vector_col: str, scale: float = SCALE,
            rows: int = BLOCK_ROWS) -> str:
    """Writes ``vectors`` as blocks of whole-number vectors (see ``BLOCKS``) to the shared folder; the path.

    Vectors that are null or hold a null or non-finite component are left out; an empty vector has no terms
    and scores 0. ``rows`` numbers tell rows with one id, or none, apart."""
    spark = prepare(vectors)
    values = F.col(f"`{vector_col}`").cast("array<double>")
    # -(2**1024) and NaN fail the comparison; so does a null, which forall passes on
    finite = F.forall(values, lambda x: F.coalesce(F.abs(x) <= 1.7976931348623157e308, F.lit(False)))
    sound = vectors.where(F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), values.alias("x"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                if held and sum(b.num_rows for b in held) + part.num_rows > rows:
                    yield _block(held, scale)
                    held = []
                held.append(part)
        if held:
            yield _block(held, scale)

    path = scratch_path(spark, "vector-blocks")
    sound.mapInArrow(work, BLOCKS).write.parquet(path)
    return path


def _block(parts: list[pa.RecordBatch], scale: float) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    x = table.column("x").combine_chunks()
    sizes = np.diff(x.offsets.to_numpy()).astype("int32")
    terms = whole_numbers(x.flatten().to_numpy(zero_copy_only=False), scale)
    return pa.RecordBatch.from_arrays(
        [pa.array([table.column("row").to_pylist()], pa.list_(pa.int64())),
         pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())),
         pa.array([sizes], pa.list_(pa.int32())), pa.array([terms], pa.list_(pa.int64()))],
        names=["rows", "ids", "sizes", "terms"])


class Rows:
    """A block's vectors: row numbers, ids (None for null) and a table of components, as wide as the widest."""

    def __init__(self, rows: np.ndarray, ids: list, sizes: np.ndarray, terms: np.ndarray):
        self.rows, self.ids = rows, ids
        width = int(sizes.max()) if len(sizes) else 0
        self.table = np.zeros((len(rows), width), "int64")
        if width:
            self.table[np.arange(width) < sizes[:, None]] = terms
        self.most = int(np.abs(self.table).max()) if self.table.size else 0

    @staticmethod
    def of(batch: pa.RecordBatch, i: int = 0) -> Rows:
        """The block in row ``i`` of a batch of ``BLOCKS``."""
        cell = {name: batch.column(batch.schema.get_field_index(name))[i].values for name in ("rows", "ids", "sizes", "terms")}
        return Rows(cell["rows"].to_numpy(zero_copy_only=False), cell["ids"].to_pylist(),
                    cell["sizes"].to_numpy(zero_copy_only=False).astype("int64"), cell["terms"].to_numpy(zero_copy_only=False))

    def take(self, keep: list[int]) -> Rows:
        out = Rows(self.rows[keep], [self.ids[i] for i in keep], np.zeros(0, "int64"), np.zeros(0, "int64"))
        out.table, out.most = self.table[keep], self.most
        return out


class Postings:
    """A block of documents by term. Documents are in the order of ties: id, nulls last, then row."""

    def __init__(self, block: Rows):
        order = sorted(range(len(block.ids)), key=lambda i: (block.ids[i] is None, block.ids[i] or 0, block.rows[i]))
        self.docs = block.take(order)
        self.lists: list[tuple[np.ndarray | slice, np.ndarray]] = []
        for weights in self.docs.table.T:
            places = np.flatnonzero(weights)
            everywhere = len(places) == len(weights)
            self.lists.append((slice(None) if everywhere else places, weights[places]))

    def scores(self, queries: Rows) -> np.ndarray:
        """The inner products of all queries with all documents, term at a time."""
        width = min(queries.table.shape[1], len(self.lists))
        bound = queries.most * self.docs.most * max(width, 1)
        if bound >= 2 ** 63:
            raise ScoreTooLarge("a score may be 2**63 or more")
        kind = "int32" if bound < 2 ** 31 else "int64"
        out = np.zeros((len(queries.rows), len(self.docs.rows)), kind)
        for term in range(width):
            places, weights = self.lists[term]
            asked = queries.table[:, term]
            who = np.flatnonzero(asked)
            if not len(who) or not len(weights):
                continue
            add = np.multiply.outer(asked[who].astype(kind), weights.astype(kind))
            if isinstance(places, slice):
                if len(who) == len(asked):
                    out += add
                else:
                    out[who] += add
            else:
                out[np.ix_(who, places)] += add
        return out


def best(scores: np.ndarray, k: int, own: int | None) -> list[int]:
    """The places of the k largest of one query's scores, of equal ones the first; ``own`` is left out."""
    left = len(scores) - (own is not None)
    k = min(k, left)
    if k <= 0:
        return []
    # one more than k covers the own place
    wanted = min(k + (own is not None), len(scores))
    border = np.partition(scores, len(scores) - wanted)[len(scores) - wanted]
    above = [i for i in np.flatnonzero(scores > border).tolist() if i != own]
    above.sort(key=lambda i: (-int(scores[i]), i))
    if len(above) < k:
        equal = np.flatnonzero(scores == border)[:k + 1].tolist()
        above += [i for i in equal if i != own][:k - len(above)]
    return above[:k]


def candidate_blocks(path: str, share: int, shares: int) -> Iterator[Rows]:
    """The blocks of every ``shares``-th file of an index, one at a time."""
    store, base = place(path)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet"))
    for name in files[share::shares]:
        with store.open_input_file(name) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=1):
                yield Rows.of(batch)


def search(index: str, queries: DataFrame, k: int = K) -> DataFrame:
    """For every query vector its ``k`` best documents of ``index`` (all, if fewer) other than its own row:
    (query_row, query_id, rank, vec_id, score), ties to the smaller id, null ids last.

    ``queries`` has the columns of ``BLOCKS``. Vectors of different lengths are compared over the places both have.
    A score that may pass 64 bits is an error. No queries or no documents: no rows."""
    spark = queries.sparkSession
    blocks = queries.count()
    if not blocks:
        return spark.createDataFrame([], "query_row long, query_id long, rank int, vec_id long, score long")
    shares = max(1, -(-CELLS_PER_CORE * spark.sparkContext.defaultParallelism // blocks))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, share in enumerate(batch.column(batch.schema.get_field_index("share")).to_pylist()):
                yield hits(Rows.of(batch, i), candidate_blocks(index, share, shares), k)

    cells = queries.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    # few, heavy rows: dealt out one by one
    found = cells.repartition(blocks * shares).mapInArrow(work, HITS)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", "vec_id", "score"))


def hits(queries: Rows, blocks: Iterable[Rows], k: int) -> pa.RecordBatch:
    """The k best documents of ``blocks`` for each query (see ``HITS``)."""
    kept: list[list[tuple]] = [[] for _ in queries.rows]
    for block in blocks:
        postings = Postings(block)
        places = {row: i for i, row in enumerate(postings.docs.rows.tolist())}
        for start in range(0, len(queries.rows), AT_ONCE):
            some = queries.take(list(range(start, min(start + AT_ONCE, len(queries.rows)))))
            scores = postings.scores(some)
            for q, row in enumerate(some.rows.tolist()):
                mine = scores[q]
                old = kept[start + q]
                new = [(-int(mine[i]), postings.docs.ids[i] is None, postings.docs.ids[i] or 0, int(postings.docs.rows[i]))
                       for i in best(mine, k, places.get(row))]
                kept[start + q] = sorted(old + new)[:k]
    rows = [(int(queries.rows[q]), queries.ids[q], row, None if null else doc, -score)
            for q, found in enumerate(kept) for score, null, doc, row in found]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      names=["query_row", "query_id", "row", "vec_id", "score"])


def query_blocks(index: DataFrame, every: int = EVERY, rows: int = QUERY_ROWS) -> DataFrame:
    """The vectors of an index whose id is divisible by ``every``, packed into blocks again."""
    spark = index.sparkSession
    prepare(index)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                rows_, ids, sizes, terms = (batch.column(c)[i].values for c in range(4))
                starts = itertools.accumulate(sizes.to_pylist(), initial=0)
                for row, vec, size, start in zip(rows_.to_pylist(), ids.to_pylist(), sizes.to_pylist(), starts):
                    if vec is not None and vec % every == 0:
                        held.append((row, vec, size, terms.slice(start, size)))
                while len(held) >= rows:
                    yield _query_block(held[:rows])
                    held = held[rows:]
        if held:
            yield _query_block(held)

    path = scratch_path(spark, "query-blocks")
    index.mapInArrow(work, BLOCKS).write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


def _query_block(held: list[tuple]) -> pa.RecordBatch:
    rows, ids, sizes, terms = zip(*held)
    return pa.RecordBatch.from_arrays(
        [pa.array([list(rows)], pa.list_(pa.int64())), pa.array([list(ids)], pa.list_(pa.int64())),
         pa.array([list(sizes)], pa.list_(pa.int32())),
         pa.array([pa.concat_arrays(terms)], pa.list_(pa.int64()))],
        names=["rows", "ids", "sizes", "terms"])


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            every: int = EVERY, scale: float = SCALE) -> DataFrame:
    """``search`` of a table for its own rows whose id is divisible by ``every``.

    Rows with null ids are documents but no queries; rows that share an id are documents and queries of their own.
    Other columns are ignored, whatever their names."""
    path = indexed(vectors, id_col, vector_col, scale)
    index = vectors.sparkSession.read.schema(BLOCKS).parquet(path)
    return search(path, query_blocks(index, every), k)


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best scores of every 50th vector against all others."""
    found = nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("query_id", "rank", "vec_id", "score")


OP12_SQL = """
WITH whole AS (
    SELECT vec_id, row_number() OVER () AS row,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS terms
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id, c.row,
           CAST(list_inner_product(q.terms, c.terms) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.row <> c.row WHERE q.vec_id % 50 = 0),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id NULLS LAST, row) AS INT) AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
