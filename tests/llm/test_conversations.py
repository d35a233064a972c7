"""Conversation repair against a plain search over edit words."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.llm import conversations as conv

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def fits(roles: str) -> bool:
    return re.fullmatch(r"(s?(ua)+)?", roles) is not None


def faults(rows):
    """(initial, must go, truncated) of each (role, text)."""
    out = []
    for i, (role, text) in enumerate(rows):
        bare = text.strip(SPACE)
        seen = bare and (role, text) in rows[:i]
        out.append((role[:1], not bare or bool(seen), bool(bare) and not seen and bare[-1] not in ".!?"))
    return out


def cheapest(turns):
    """(cost, audit) by trying every edit at every place, from roles written so far (only their end matters)."""
    def ahead(roles):  # what may still become a fitting word
        return re.fullmatch(r"s?(ua)*u?", roles) is not None

    @functools.cache
    def best(i, tail):
        found = [(0, "")] if i == len(turns) and fits(tail) else []
        for new in "ua":
            if ahead(tail + new) and len(tail) < 2 * len(turns) + 4:
                cost, word = best_after_insert(i, tail + new)
                found.append((cost + 3, "I" + word))
        return min([*found, *rows(i, tail), (1 << 20, "")])

    @functools.cache
    def rows(i, tail):
        if i == len(turns):
            return []
        initial, go, cut = turns[i]
        cost, word = best(i + 1, tail)
        found = [(cost + 4, "D" + word)]
        if not go:
            options = [("K", initial, 0)] if initial else []
            for edit, new, price in [*options, ("R", "u", 3), ("R", "a", 3)]:
                if ahead(tail + new):
                    cost, word = best(i + 1, tail + new)
                    found.append((cost + price + 3 * cut, edit + word))
        return found

    def best_after_insert(i, tail):
        # no cheapest word inserts more than three times in a row
        if tail.count("u") + tail.count("a") > 2 * len(turns) + 3:
            return 1 << 20, ""
        return best(i, tail)

    return best(0, "")


def repaired(rows, audit):
    out, roles, i = [], "", 0
    for edit in audit:
        wanted = "assistant" if roles.endswith("u") else "user"
        if edit == "I":
            out.append(f"{wanted}:")
            roles += wanted[0]
            continue
        role, text = rows[i]
        i += 1
        if edit != "D":
            role = wanted if edit == "R" else role
            out.append(f"{role}:{text}")
            roles += role[0]
    assert i == len(rows) and fits(roles)
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(conv_id, rows):
    """The whole row for (turn, role, text) rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    said = [r[1:] for r in rows]
    marks = faults(said)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    blank = sum(not t.strip(SPACE) for _, t in said)
    cost, audit = cheapest(marks)
    pairs = [a[0] + b[0] for a, b in zip(marks, marks[1:])]
    return (conv_id, gaps, blank, sum(m[1] for m in marks) - blank, sum(m[2] for m in marks),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, repaired(said, audit))


def damage(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        mine = out.setdefault(conv_id, [])
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


SYMBOL = st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.booleans(), st.booleans())


@settings(max_examples=250, deadline=None)
@given(st.lists(SYMBOL, max_size=9))
def test_tables_find_the_least_cheapest_word(turns):
    turns = [(i, go, cut and not go) for i, go, cut in turns]
    symbols = bytes(0 if go else 1 + 2 * conv.initial_of(i) + cut for i, go, cut in turns)
    cost, audit = cheapest(turns)
    assert conv.total(symbols) == cost and conv.trace(symbols, 0, conv.START, last=True)[0] == audit


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40).map(lambda b: bytes(x % 9 for x in b)), st.lists(st.integers(0, 40), max_size=4))
def test_parts_chain_to_the_whole(symbols, cuts):
    edges = [0, *sorted(min(c, len(symbols)) for c in cuts), len(symbols)]
    parts = [symbols[a:b] for a, b in zip(edges, edges[1:])]
    vector, cost, behind = 0, 0, []
    for part in reversed(parts):
        behind.insert(0, vector)
        vectors, added = conv.effect(part)
        cost, vector = cost + added[vector], vectors[vector]
    assert cost + conv.tables().vectors[vector][conv.START] == conv.total(symbols)
    state, audit = conv.START, ""
    for i, (part, after) in enumerate(zip(parts, behind)):
        edits, state = conv.trace(part, after, state, last=i == len(parts) - 1)
        audit += edits
    assert audit == conv.trace(symbols, 0, conv.START, last=True)[0]


def test_few_vectors():
    assert len(conv.tables().vectors) < 40
    assert all(min(v) == 0 and max(v) <= 10 for v in conv.tables().vectors)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = sorted(expected(c, r) for c, r in damage(rows).items())
    got = entry.queries()["op11_conversation_repair"](spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want


def hostile(seed: int, n: int, convs: list):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "yes.", "no", "What?\x1f", "é!", "a\x00b", "same", "same", "x" * 70_000 + "."]
    return [(rng.choice(convs), rng.choice([None, 0, 1, 2, 3, 7, -4, 12]), rng.choice([None, "", "user", "assistant", "system", "tool", "ua"]),
             rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("whole_bytes,parts", [(conv.WHOLE_BYTES, 1), (0, 1), (conv.WHOLE_BYTES, 9), (0, 9)])
def test_hostile_turns_short_and_long(spark, whole_bytes, parts):
    """Nulls anywhere, empty and long texts, repeated rows, ties; long conversations in several parts."""
    rows = hostile(7, 60, [None, 1, 2, 3, 4]) + hostile(8, 3, [9])
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").repartition(3)
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(parts)}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = [tuple(r) for r in conv.repair(conv.damaged(df), whole_bytes).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [expected(c, r) for c, r in damage(rows).items()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_and_all_dropped(spark):
    none = spark.createDataFrame([], conv.TURNS)
    assert conv.repair(none).collect() == []
    gone = spark.createDataFrame([(5, 1, "user", "x", True), (5, 2, "user", "y", True)], conv.TURNS)
    assert [tuple(r) for r in conv.repair(gone).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_a_conversation_of_a_third_of_all_rows(spark):
    """The hot conversation is sorted by several tasks; its repair equals the plain one."""
    df = spark.range(0, 6000, numPartitions=4).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 400).alias("conv_id"), (F.col("id") * 17 % 6000).alias("turn"),
        F.when(F.col("id") % 5 < 2, "user").when(F.col("id") % 5 < 4, "assistant").otherwise("system").alias("role"),
        F.concat(F.lit("t"), F.col("id") % 900, F.lit(".")).alias("text"))
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = {r["conv_id"]: r for r in conv.repair(df.withColumn("gone", F.lit(False))).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    rows = sorted(((r["turn"], r["role"], r["text"]) for r in df.where("conv_id IS NULL").collect()))
    marks = faults([r[1:] for r in rows])
    symbols = bytes(0 if go else 1 + 2 * conv.initial_of(i) + cut for i, go, cut in marks)
    audit, _ = conv.trace(symbols, 0, conv.START, last=True)
    hot = got[None]
    assert (hot["cost"], hot["audit"]) == (conv.total(symbols), audit)
    assert hot["repaired_sha256"] == repaired([r[1:] for r in rows], audit)
    assert len(got) == df.select("conv_id").distinct().count()
