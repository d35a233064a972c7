"""Merkle manifest of a table: a root over all rows, and per row the proof that it is in it.

Rows are leaves of one tree per group (source), in the order of their ids; the group roots are the leaves of a
tree of their own. Leaves are not sorted: tasks build compressed bitmaps of the ids that they see (a container
of 2**12 ids is an array of its set places, or a bitmap once that is smaller), the containers of all
tasks are merged, and a directory counts the ids before each container. A leaf's place in its tree is a
rank query: the count before its container, plus the set bits before its id by a popcount
directory of the container's words. Ids that repeat, and null ids, which come first, carry their counts; their
copies are told apart by the leaf hash.

A node knows its place, so levels need no order either: nodes are dealt to blocks by place, each block is an array
of slots, and one shuffle reduces ``LEVELS`` levels. On the way down a block hands each of its nodes
the siblings on the way to the root, so a leaf's proof is made where its block is. No task holds more than one
block of nodes or one container; a group of any size is many of both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, prepare, stored
from tessera.operators import streams

FAN = 3              # fixed by the query's contract
LEVELS = 6           # levels that one shuffle reduces: blocks of 3**6 nodes
LOW_BITS = 12        # ids of a container: 2**12 rows are little work for the task that gets it
ARRAY_MOST = (1 << LOW_BITS) // 16  # ids up to which an array of 16-bit places is smaller than a bitmap
SALTS = 8            # tasks over which the rows of a container are dealt, each with a copy of it
HELD_ROWS = 1 << 20  # rows that a task gathers before it emits containers

CONTAINERS = "source string, hi long, bits binary, extra_at binary, extra_n binary, n long"
PLACED = "tree long, n long, place long, copies long, doc_id long, leaf binary, bad binary"
NODES = "tree long, place long, n long, hash binary"
PATHS = "tree long, place long, path string, subroot string, root string"
PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


# -- leaves --------------------------------------------------------------------------------------------

def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


# -- containers of ids ------------------------------------------------------------------------------------

def packed_bits(counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """A container from the number of rows at each of its places: the places that are set, as an array or a
    bitmap, and those of more than one row with the number of further ones."""
    at = np.flatnonzero(counts)
    bits = at.astype("<u2") if len(at) <= ARRAY_MOST else np.packbits(counts > 0, bitorder="little")
    many = at[counts[at] > 1]
    return bits.tobytes(), many.astype("<u2").tobytes(), (counts[many] - 1).astype("<i8").tobytes()


def unpacked_bits(bits: bytes, extra_at: bytes, extra_n: bytes) -> np.ndarray:
    counts = np.zeros(1 << LOW_BITS, "int64")
    if len(bits) == 1 << LOW_BITS >> 3:
        counts[:] = np.unpackbits(np.frombuffer(bits, "u1"), bitorder="little")
    else:
        counts[np.frombuffer(bits, "<u2")] = 1
    counts[np.frombuffer(extra_at, "<u2")] += np.frombuffer(extra_n, "<i8")
    return counts


class Ranks:
    """Rank queries on a container: words of 64 places, the set bits before each word, and the further rows of
    repeated ids in place order."""

    def __init__(self, bits: bytes, extra_at: bytes, extra_n: bytes):
        held = unpacked_bits(bits, extra_at, extra_n)
        self.words = np.packbits(held > 0, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype("int64"))])
        self.many = np.frombuffer(extra_at, "<u2").astype("int64")
        self.further = np.concatenate([[0], np.cumsum(np.frombuffer(extra_n, "<i8"))])
        self.counts = held

    def rank(self, low: np.ndarray) -> np.ndarray:
        """Rows whose place is before each of ``low``."""
        word, bit = low >> 6, (low & 63).astype("u8")
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return (self.before[word] + np.bitwise_count(below).astype("int64")
                + self.further[np.searchsorted(self.many, low)])


def containers(leaves: DataFrame) -> DataFrame:
    """The merged containers (see ``CONTAINERS``) of all (source, doc_id); null ids are a container without places."""
    schema = streams.arrow_schema(CONTAINERS)

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= HELD_ROWS:
                    yield from emit(held)
                    held = []
            yield from emit(held)

        yield from streams.packed(rows(), schema)

    def emit(held: list[pa.RecordBatch]) -> Iterator[tuple]:
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([("source", "ascending"), ("hi", "ascending")]).combine_chunks()
        for _, (source, hi), rows in streams.pieces(table.to_batches(), ["source", "hi"]):
            if hi is None:
                yield source, hi, b"", b"", b"", rows.num_rows
            else:
                low = rows.column(2).to_numpy(zero_copy_only=False)
                yield source, hi, *packed_bits(np.bincount(low, minlength=1 << LOW_BITS)), rows.num_rows

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total, counts = 0, np.zeros(1 << LOW_BITS, "int64")
        for batch in batches:
            for bits, extra_at, extra_n, n in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                total += n
                if bits:
                    counts += unpacked_bits(bits, extra_at, extra_n)
        yield (*key, *packed_bits(counts), total)

    ids = leaves.select("source", F.shiftright("doc_id", LOW_BITS).alias("hi"),
                        F.col("doc_id").bitwiseAND((1 << LOW_BITS) - 1).alias("low"))
    return stored(streams.stream_groups(ids.mapInArrow(gather, CONTAINERS), ["source", "hi"], merge, CONTAINERS),
                  "id-containers")


def directory(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The containers with the rows of their source ``before`` them, their ``tree`` and its size; and the
    trees: (source, tree, n). Trees are numbered in the order of sources, null first, UTF-8 bytewise.

    Sums run within the sorted runs of containers, and over the runs: a source of any size is split."""
    trees = streams.numbered(found.groupBy("source").agg(F.sum("n").alias("size")), [],
                             [F.col("source").asc_nulls_first()], "tree")
    trees = stored(trees.select("source", (F.col("tree") - 1).alias("tree"), "size"), "trees")
    runs = streams.sorted_runs(found, [F.col("source").asc_nulls_first(), F.col("hi").asc_nulls_first()])
    inside = Window.partitionBy("source", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy("source", "run").agg(F.sum("n").alias("total")).select(
        "source", "run", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("earlier"))
    runs = runs.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    placed = (runs.alias("l").join(totals.alias("r"), same & (F.col("l.run") == F.col("r.run")))
              .select("l.*", (F.col("r.earlier") + F.col("l.within")).alias("before")))
    return (placed.alias("l").join(trees.alias("r"), same)
            .select("l.source", "l.hi", "l.bits", "l.extra_at", "l.extra_n", "l.n", "l.before", "r.tree", "r.size"), trees)


def ranked(leaves: DataFrame, where: DataFrame) -> DataFrame:
    """``PLACED``: each leaf with its tree and its place there. A container and the leaves whose ids it holds
    meet as a stream, the container first; an id of many rows is dealt over ``SALTS`` such streams. Copies of an id share
    its first place, and are then dealt the places behind it in the order of leaf hashes."""
    nothing = {"bits": "binary", "extra_at": "binary", "extra_n": "binary", "before": "long", "tree": "long", "size": "long"}
    first = where.select("source", "hi", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("side"), *nothing, F.lit(None).cast("long").alias("doc_id"),
                         F.lit(None).cast("binary").alias("leaf"), F.lit(None).cast("binary").alias("bad"), "n")
    salt = F.pmod(F.xxhash64("leaf", "doc_id"), F.lit(SALTS)).cast("int")
    rows = leaves.select("source", F.shiftright("doc_id", LOW_BITS).alias("hi"), salt.alias("salt"), F.lit(1).alias("side"),
                         *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], "doc_id", "leaf", "bad",
                         F.lit(None).cast("long").alias("n"))

    def place(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        container, ranks = None, None
        for batch in batches:
            if container is None:
                container = batch.slice(0, 1).to_pylist()[0]
                ranks = Ranks(container["bits"], container["extra_at"], container["extra_n"])
                batch = batch.slice(1)
            ids, good, bad = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "leaf", "bad"))
            if key[1] is None:
                places, copies = [container["before"]] * batch.num_rows, [container["n"]] * batch.num_rows
            else:
                low = ids.to_numpy(zero_copy_only=False).astype("int64") & ((1 << LOW_BITS) - 1)
                places, copies = (container["before"] + ranks.rank(low)).tolist(), ranks.counts[low].tolist()
            for at, n, doc, a, b in zip(places, copies, ids.to_pylist(), good.to_pylist(), bad.to_pylist()):
                yield container["tree"], container["size"], at, n, doc, a, b

    placed = stored(streams.stream_groups(first.union(rows), ["source", "hi", "salt"], place, PLACED, ["side"]), "ranked")
    copies = streams.numbered(placed.where("copies > 1"), ["tree", "place"], [F.col("leaf")], "copy")
    return placed.where("copies = 1").select("tree", "n", "place", "doc_id", "leaf", "bad").union(
        copies.select("tree", "n", (F.col("place") + F.col("copy") - 1).alias("place"), "doc_id", "leaf", "bad"))


# -- the tree -------------------------------------------------------------------------------------------

def joined_hash(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels until a tree of ``n`` leaves has one node."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def block_levels(slots: list[str], levels: int) -> list[list[str]]:
    """A block's nodes, level by level: ``FAN`` neighbours become one, the last run may be shorter."""
    out = [slots]
    for _ in range(levels):
        below = out[-1]
        out.append([joined_hash(below[i:i + FAN]) for i in range(0, len(below), FAN)])
    return out


def siblings(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """The hashes left and right of a node in its run, at every level of its block but the top."""
    out = []
    for nodes in levels[:-1]:
        start = place - place % FAN
        out.append(("".join(nodes[start:place]), "".join(nodes[place + 1:start + FAN])))
        place //= FAN
    return out


def block_of(batches: Iterator[pa.RecordBatch]) -> tuple[int, list[list[str]], list[tuple]]:
    """A block's nodes in slots, by level, from rows of ``NODES``: (size of the tree, levels, rows)."""
    size = FAN ** LEVELS
    rows = [r for b in batches for r in zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                                             for c in ("place", "n", "hash")))]
    slots: list[str] = [""] * len(rows)
    for place, _, digest in rows:
        slots[place % size] = digest.hex()
    n = rows[0][1]
    return n, block_levels(slots, min(LEVELS, depth(n))), rows


def rise(nodes: DataFrame) -> DataFrame:
    """``NODES`` of the level that is ``LEVELS`` above, or the root of trees that end before; a written table."""
    def up(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        n, levels, _ = block_of(batches)
        for _ in levels[1:]:
            n = -(-n // FAN)
        yield key[0], key[1], n, bytes.fromhex(levels[-1][0])

    blocks = nodes.withColumn("block", F.floor(F.col("place") / FAN ** LEVELS))
    return stored(streams.stream_groups(blocks, ["tree", "block"], up, NODES), "merkle-level")


def grown(nodes: DataFrame) -> list[DataFrame]:
    """Levels of all trees of ``nodes``, up to the one in which every tree is one node."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    for _ in range(-(-depth(most) // LEVELS)):
        levels.append(rise(levels[-1]))
    return levels


def descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``PATHS`` of ``nodes`` from those of the blocks above: per level ``left,right``, joined by ``;``."""
    def down(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head, rest = with_path(batches)
        n, levels, rows = block_of(rest)
        for place, _, _ in rows:
            steps = [f"{a},{b}" for a, b in siblings(levels, place % FAN ** LEVELS)]
            yield key[0], place, ";".join([*steps, *filter(None, [head["path"]])]), head["subroot"], head["root"]

    return stored(streams.stream_groups(beside(nodes, above), ["tree", "block"], down, PATHS, ["side"]), "merkle-paths")


def beside(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks of nodes, the path of each block as its first row."""
    own = [c for c in nodes.columns if c not in ("tree", "place")]
    texts = ["path", "subroot", "root"]
    first = above.select("tree", F.col("place").alias("block"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("place"),
                         *texts, *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in own])
    rest = nodes.select("tree", F.floor(F.col("place") / FAN ** LEVELS).alias("block"), F.lit(1).alias("side"), "place",
                        *[F.lit(None).cast("string").alias(c) for c in texts], *own)
    return first.union(rest)


def with_path(batches: Iterator[pa.RecordBatch]) -> tuple[dict, Iterator[pa.RecordBatch]]:
    batch = next(batches)
    head = {c: batch.column(batch.schema.get_field_index(c))[0].as_py() for c in ("path", "subroot", "root")}

    def rest() -> Iterator[pa.RecordBatch]:
        if batch.num_rows > 1:
            yield batch.slice(1)
        yield from batches

    return head, rest()


def proofs(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """``PROOFS`` of the leaves (``NODES`` with doc_id and bad). The root is recomputed from the ``bad`` leaf where
    there is one, else from the leaf itself, and the siblings of the untampered tree."""
    def prove(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head, rest = with_path(batches)
        held = list(rest)
        _, levels, rows = block_of(iter(held))
        more = [r for b in held for r in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "bad")))]
        upper = [tuple(step.split(",")) for step in filter(None, head["path"].split(";"))]
        upper_text = "".join(a + b for a, b in upper)
        known: dict[str, str] = {}  # from a block's top node on, untampered leaves share the way
        for (place, _, digest), (doc, bad) in zip(rows, more):
            steps = siblings(levels, place % FAN ** LEVELS)
            node = (digest if bad is None else bad).hex()
            for a, b in steps:
                node = joined_hash((a, node, b))
            if node not in known:
                folded = node
                for a, b in upper:
                    folded = joined_hash((a, folded, b))
                if bad is None:
                    known[node] = folded
            else:
                folded = known[node]
            yield (doc, digest.hex(), head["subroot"], head["root"], joined_hash([*(a + b for a, b in steps), upper_text]),
                   folded, folded == head["root"])

    return streams.stream_groups(beside(leaves, above), ["tree", "block"], prove, PROOFS, ["side"])


def manifest(leaves: DataFrame) -> DataFrame:
    """``PROOFS`` of a table (source, doc_id, leaf, bad): binary hashes; ``bad``, the hash of a row as it is found now,
    is null where the row is as it was.

    Null sources are a group, the first. Null ids come first in their group; rows of one id follow each other in the
    order of their hashes, equal rows in any order. An empty table has no rows and no root. Other columns are
    not read, so their names cannot clash."""
    leaves = stored(leaves.select("source", "doc_id", "leaf", "bad"), "leaves")
    where, _ = directory(containers(leaves))
    base = stored(ranked(leaves, where).withColumnRenamed("leaf", "hash"), "merkle-leaves")
    levels = grown(base.select("tree", "place", "n", "hash"))
    tops = levels[-1]
    count = tops.count()
    over = grown(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"),
                             F.lit(count).cast("long").alias("n"), "hash"))
    root = F.lower(F.hex("hash"))
    paths = over[-1].select("tree", F.lit(0).cast("long").alias("place"), F.lit("").alias("path"),
                            F.lit("").alias("subroot"), root.alias("root"))
    for nodes in over[-2::-1]:
        paths = descend(nodes, paths)
    ways = paths.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "path", "root")
    paths = ways.join(tops.select("tree", root.alias("subroot")), "tree").select("tree", "place", "path", "subroot", "root")
    for nodes in levels[-2:0:-1]:
        paths = descend(nodes, paths)
    return proofs(base, paths)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and a check of documents of which half have lost their line breaks."""
    docs = documents(spark, sf_dir)
    prepare(docs)
    cut = F.replace("text", F.lit("\n"), F.lit(""))
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & (F.instr("text", "\n") > 0)
    plain = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return manifest(docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), leaf(plain).alias("leaf"),
                                F.when(hit, leaf([*plain[:-1], cut])).alias("bad")))


def _sql(levels: int = 14) -> str:
    """The same for DuckDB, its levels written out: enough for 3**levels rows of a source."""
    def part(x: str) -> str:
        return f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"

    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    steps = []

    def tree(name: str, group: str) -> None:
        """Levels ``{name}_n0..`` of nodes and ``{name}_w0..`` of the way of every leaf."""
        for i in range(levels):
            steps.append(f"""{name}_r{i} AS MATERIALIZED (SELECT {group} AS g, place // 3 AS run, max(n) AS n,
                list(hash ORDER BY place) AS hs, sha256(string_agg(hash, '' ORDER BY place)) AS hash
                FROM {name}_n{i} WHERE n > 1 GROUP BY {group}, place // 3)""")
            steps.append(f"""{name}_n{i + 1} AS MATERIALIZED (SELECT g, run AS place, (n + 2) // 3 AS n, hash FROM {name}_r{i}
                UNION ALL SELECT g, place, n, hash FROM {name}_n{i} WHERE n = 1)""")
            steps.append(f"""{name}_w{i + 1} AS MATERIALIZED (SELECT w.* EXCLUDE (place, way), w.place // 3 AS place,
                CASE WHEN r.run IS NULL THEN w.way ELSE list_append(w.way,
                {{'l': array_to_string(r.hs[:w.place % 3], ''), 'r': array_to_string(r.hs[w.place % 3 + 2:], '')}}) END AS way
                FROM {name}_w{i} w LEFT JOIN {name}_r{i} r ON w.g IS NOT DISTINCT FROM r.g AND w.place // 3 = r.run)""")

    steps.append("""crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t)""")
    steps.append(f"""leaves AS MATERIALIZED (SELECT doc_id, source AS g, sha256({head} || {part('text')}) AS hash,
        CASE WHEN text IS NOT NULL AND doc_id IS NOT NULL AND xor(list_reduce(list_transform(range(1, len(doc_id::VARCHAR) + 1),
            lambda k: ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT),
            lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 2 = 0
        THEN sha256({head} || {part("replace(text, chr(10), '')")}) END AS bad
        FROM documents, crc_table)""")
    steps.append("""s_n0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, hash) - 1
        AS place, count(*) OVER (PARTITION BY g) AS n FROM leaves)""")
    steps.append("s_w0 AS MATERIALIZED (SELECT *, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) AS way FROM s_n0)")
    tree("s", "g")
    steps.append(f"""t_n0 AS MATERIALIZED (SELECT 0 AS g, g AS source, hash, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS place,
        count(*) OVER () AS n FROM s_n{levels})""")
    steps.append("t_w0 AS MATERIALIZED (SELECT *, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) AS way FROM t_n0)")
    tree("t", "g")
    steps.append(f"""ways AS MATERIALIZED (SELECT s.doc_id, s.hash AS leaf, t.hash AS subroot, r.hash AS root,
        list_concat(s.way, t.way) AS way, coalesce(s.bad, s.hash) AS now
        FROM s_w{levels} s JOIN t_w{levels} t ON s.g IS NOT DISTINCT FROM t.source, t_n{levels} r)""")
    steps.append("""folded AS (SELECT *, list_reduce(list_transform(way, lambda x: x.l || ',' || x.r),
        lambda h, x: sha256(split_part(x, ',', 1) || h || split_part(x, ',', 2)), now) AS folded_root FROM ways)""")
    body = ",\n".join(steps)
    return f"""WITH {body}
        SELECT doc_id, leaf, subroot, root,
        sha256(array_to_string(list_transform(way, lambda x: x.l || x.r), '')) AS proof_sha256,
        folded_root, folded_root = root AS verified FROM folded"""


OP13_SQL = _sql()
