"""The Merkle manifest against a plain one."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import manifest as m

SCHEMA = "source STRING, doc_id LONG, leaf BINARY, bad BINARY, hi STRING, place INT"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """(root, per leaf the siblings of each level as (left, right))."""
    ways, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, place in enumerate(at):
            start = place // 3 * 3
            ways[i].append(("".join(nodes[start:place]), "".join(nodes[place + 1:start + 3])))
        nodes, at = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], [p // 3 for p in at]
    return nodes[0], ways


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (source, doc_id, leaf, bad)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees.append(tree([r[2].hex() for r in groups[s]]))
    root, tops = tree([t[0] for t in trees])
    out = []
    for s, (sub, ways), top in zip(order, trees, tops):
        for (_, doc, leaf, bad), way in zip(groups[s], ways):
            node = (leaf if bad is None else bad).hex()
            for a, b in way + top:
                node = H(a, node, b)
            out.append((doc, leaf.hex(), sub, root, H(*(a + b for a, b in way + top)), node, node == root))
    return sorted(out, key=str)


def made(spark, rows, partitions=4):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in m.manifest(df).collect()), key=str)


def digest(x):
    return hashlib.sha256(str(x).encode()).digest()


def test_nulls_repeats_and_far_ids(spark):
    rng = random.Random(3)
    ids = [None, None, 0, 1, 5, 5, 5, -1, -70_000, 65_535, 65_536, 2 ** 62, -2 ** 63, 2 ** 63 - 1]
    rows = []
    for i in range(90):
        leaf = digest(rng.choice([i, "same"]))
        # rows that are equal have been tampered with alike
        rows.append((rng.choice([None, "", "a", "é", "Z", "\U0001F600", "￿"]), rng.choice(ids), leaf,
                     [None, None, digest(leaf), leaf][leaf[0] % 4]))
    assert made(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_one_group_of_every_shape(spark, n):
    rows = [("s", i, digest(i), None) for i in range(n)]
    got = made(spark, rows)
    assert got == plain(rows) and all(r[6] for r in got)


def test_more_levels_than_a_block_has(spark):
    """A group of more than two blocks' levels, and more groups than a block has nodes."""
    big = [("big", i * 3, digest(i), digest("bad") if i % 7 == 0 else None) for i in range(3 ** m.LEVELS * 3 + 5)]
    rows = big + [(f"s{i}", None, digest(-i), None) for i in range(3 ** m.LEVELS + 2)]
    got = made(spark, rows)
    assert got == plain(rows) and sum(not r[6] for r in got) == len([r for r in rows if r[3]])


def test_a_null_id_in_a_third_of_the_rows(spark):
    rows = [("s", None if i % 3 else i, digest(i % 50), None) for i in range(900)]
    assert made(spark, rows) == plain(rows)


def test_nothing(spark):
    assert made(spark, []) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4095), max_size=40), st.integers(0, 4095), st.booleans())
def test_ranks_of_a_container(places, low, dense):
    counts = np.bincount(np.array(places, "int64"), minlength=1 << m.LOW_BITS)
    if dense:
        counts[:3000] += 1
    packed = m.packed_bits(counts)
    assert (m.unpacked_bits(*packed) == counts).all()
    assert m.Ranks(*packed).rank(np.array([low]))[0] == counts[:low].sum()
    assert len(packed[0]) <= 512


def test_leaf_fields(spark):
    df = spark.createDataFrame([(7, None, "é\n", None)], "a LONG, b STRING, c STRING, d LONG")
    got = df.select(m.leaf([F.col(c) for c in df.columns])).first()[0]
    assert bytes(got).hex() == H("1:7", "-", "3:é\n", "-")


def test_query_marks_only_tampered_texts(spark):
    from tessera.llm import queries
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r["verified"] for r in queries.QUERIES["op13_merkle_manifest"](spark, sf).collect()}
    assert got == {d: not ("\n" in (t or "") and zlib.crc32(str(d).encode()) % 2 == 0) for d, t in texts.items()}
    assert set(got.values()) == {True, False}
