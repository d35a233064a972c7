"""The registered queries over whole tables, against SQL or the plain versions."""

import glob
import hashlib
import os
import re
import zlib

import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


def run(spark, name):
    return sorted((tuple(r) for r in entry.queries()[name](spark, SF).collect()), key=lambda r: r[0])


@pytest.mark.parametrize("name", ["op2_warc_fixity", "op5_repeat_index", "op6_quality_rules", "op8_secret_scan", "op10_source_mix",
                                  "op12_exact_topk", "op13_merkle_manifest"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, SF)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in df.select(*want.columns).collect()) == sorted(want.fetchall())


def test_simhash(spark, docs):
    assert run(spark, "op1_simhash_dedup") == brute.near_duplicates([(r["doc_id"], r["text"]) for r in docs])


def test_pii(spark, docs):
    for r, got in zip(docs, run(spark, "op4_pii_anchors")):
        base = brute.personal(r["text"])
        assert got[:5] == (r["doc_id"], *(sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")))
        assert got[5] == hashlib.sha256(brute.joined(base).encode()).hexdigest()
        assert set(brute.joined(base).split(",")) <= set(got[6].split(",")) | {""}


def test_repeats(spark, docs):
    want = brute.removed([r["text"] for r in docs], 400)
    assert run(spark, "op5_repeat_index") == [(r["doc_id"], *w) for r, w in zip(docs, want)]


def test_tiling(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [(r["doc_id"], i) for r in docs for i in brute.contaminated(r["text"], items)]
    assert want and sorted(r[:2] for r in run(spark, "op7_benchmark_tiling")) == sorted(want)


def test_secrets(spark, docs):
    for r, got in zip(docs, run(spark, "op8_secret_scan")):
        base = brute.secrets(r["text"])
        assert got[1:4] == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert got[4] == hashlib.sha256(brute.joined(base).encode()).hexdigest()


def test_language(spark, docs):
    got = run(spark, "op3_language_id")
    assert [g[0] for g in got] == [r["doc_id"] for r in docs]
    assert [g[1] for g in got] == [zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs]
    unseen = [(g[2], r["lang"]) for g, r in zip(got, docs) if g[1] and re.search(r"[^\W\d_]", r["text"] or "")]
    assert sum(a == b for a, b in unseen) >= 0.95 * len(unseen)
    assert all(0 < g[3] <= 1 for g in got if g[2] != "und")


def test_tokens(spark, docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    assert run(spark, "op9_token_records") == brute.encode([(r["doc_id"], r["text"]) for r in docs], tokenizer)


def test_pipeline(spark, docs):
    from tokenizers import Tokenizer
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs if brute.quality(r["text"])[-1]]
    first = {d for d, _, c in brute.near_duplicates([r[:2] for r in rows]) if d == c}
    rows = [r for r in rows if r[0] in first and not brute.contaminated(r[1], items)]
    mixed = [(d, t) for (d, t, _), m in zip(rows, brute.mix(rows)) for _ in range(m[4])]
    want = brute.encode(mixed, Tokenizer.from_file(tokens.default_tokenizer()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(want)


def test_stages_keep_the_columns(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, SF).columns == df.columns
