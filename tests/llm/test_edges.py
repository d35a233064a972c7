"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import pytest

import brute
from pyspark.sql import functions as F
from tessera.llm import decontaminate, langid, mixing, pii, quality, repeats, secrets, simhash, tokens, warc

SCHEMA = "doc_id long, text string, lang string, source string, id int, body string, size string, fp string, rank int"
PROSE = " ".join(f"word{i % 97} und{i * 7 % 61} été{i % 13}" for i in range(60))


@pytest.fixture(scope="module")
def messy(spark):
    rows = [
        (1, PROSE, "en", "b"), (2, PROSE, "en", "b"), (3, None, None, None), (4, "", "de", "a"),
        (5, " \n\t ", "de", None), (6, "one two", "fr", "a"), (7, PROSE + " tail", None, "c"),
        (7, PROSE + " tail", None, "c"), (None, "mail a.b@c.de +49 30 1234567", "en", None),
        (8, "x" * 200_000, "en", "d"), (9, "Σας ΌΣ İstanbul 4111 1111 1111 1111 10.0.0.1", "fr", "d"),
        (10, "token = abcdef0123456789abcdef0123456789 " * 40, "fr", "d"),
    ]
    return spark.createDataFrame([(*r, 0, "clash", "clash", "clash", 0) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def test_simhash(messy, empty):
    docs = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert by_id(simhash.near_duplicates(messy)) == brute.near_duplicates(docs)  # rows without an id too
    assert simhash.near_duplicates(empty).collect() == []
    kept = simhash.keep_first(messy)
    assert kept.columns == messy.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # 1 = 2 (copies), 3 = 4 = 5 (no words); the repeated row of 7 once; the row without an id stays
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in brute.near_duplicates(docs)} - {None})
    assert ids.count(None) == 1
    assert simhash.keep_first(empty).count() == 0


def test_quality(messy, empty):
    rows = quality.judge(messy).select("doc_id", "text", *[F.col("_q")[c] for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], quality.base_failed(F.col("_q")), "_kept")
    for _, text, *got in rows.collect():
        want = brute.quality(text)
        assert tuple(got[:6]) == want[:6]
        assert (not got[5] and got[6]) == want[6]
    kept = quality.keep_good(messy)
    assert kept.columns == messy.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(
        str(r["doc_id"]) for r in messy.collect() if brute.quality(r["text"])[-1])
    assert quality.keep_good(empty).count() == 0
    assert quality.judge(empty).count() == 0


def test_pii(messy, empty):
    for r in pii.scan(messy).join(messy.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r["base_sha256"] == __import__("hashlib").sha256(brute.joined(brute.personal(r["text"])).encode()).hexdigest()
    assert pii.scan(messy).count() == messy.count()
    none = [r for r in pii.scan(messy).collect() if r["doc_id"] is None]
    assert none[0]["spans"] == "email:5:13,phone:14:28"
    assert pii.scan(empty).collect() == []


def test_secrets(messy, empty):
    rows = secrets.scan(messy)
    assert set(messy.columns) <= set(rows.columns)
    for r in rows.collect():
        base = sorted((s["start"], s["rank"], s["end"]) for s in r["_base"])
        assert [(secrets.KINDS[k], s, e) for s, k, e in base] == brute.secrets(r["text"])
    assert rows.count() == messy.count()
    assert secrets.scan(empty).count() == 0


def test_language(messy, empty):
    net = langid.fit(messy, train_docs=5, steps=5)
    rows = by_id(langid.predict(messy, net))
    assert len(rows) == messy.count()
    for doc_id, _, lang, score, _ in rows:
        assert (lang, score) == ("und", 0.0) if doc_id in (3, 4, 5) else lang in net.langs and 0 < score <= 1
    assert langid.fit(empty) is None
    assert {r["lang_pred"] for r in langid.predict(messy, None).collect()} == {"und"}
    assert langid.predict(empty, net).collect() == []


def test_repeats(messy, empty):
    order = [(r["doc_id"], r["text"]) for r in messy.collect()]
    want = sorted(map(str, ((d, *x) for (d, _), x in zip(order, brute.removed([t for _, t in order], 400)))))
    rows = repeats.cut(messy).select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")), F.size("removed"),
                                     F.sha2("kept", 256))
    assert sorted(str(tuple(r)) for r in rows.collect()) == want
    assert repeats.cut(empty).collect() == []


def test_decontamination(spark, messy, empty):
    items = spark.createDataFrame([(1, "One, TWO"), (1, "One, TWO"), (2, None), (3, ""), (4, PROSE[30:400]), (None, PROSE[500:900])],
                                  "item_id long, text string")
    found = by_id(decontaminate.contaminations(messy, items).select("doc_id", "item_id"))
    assert sorted(found, key=str) == sorted([(6, 1), *((d, i) for d in (1, 2, 7, 7) for i in (4, None))], key=str)
    clean = decontaminate.remove_contaminated(messy, items)
    assert clean.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(["3", "4", "5", "None", "8", "9", "10"])
    assert decontaminate.remove_contaminated(empty, items).count() == 0
    assert decontaminate.contaminations(messy, items.limit(0)).count() == 0
    assert decontaminate.remove_contaminated(messy, items.limit(0)).count() == messy.count()


def test_tokens(messy, empty):
    from tokenizers import Tokenizer
    rows = messy.collect()
    got = tokens.encode_documents(messy).collect()
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i))
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    want = {d: (n, c) for d, _, n, c in brute.encode([(r["doc_id"], r["text"]) for r in rows], tokenizer)}
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, *want[r["doc_id"]])
        at += r["n_tokens"]
    assert tokens.encode_documents(empty).collect() == []


def test_mix(messy, empty):
    rows = messy.collect()
    want = brute.mix([("-" if r["doc_id"] is None else r["doc_id"], r["text"], r["source"]) for r in rows])
    got = mixing.mix(messy).collect()
    assert len(got) == len(want)
    for (d, size, source_size, target, copies), r in zip(
            sorted(want, key=str), sorted(((("-" if g[0] is None else g[0]), *g[1:5]) for g in got), key=str)):
        assert (d, size, source_size) == r[:3] and r[3] == pytest.approx(target) and r[4] == copies
    assert all(g["taken"] <= 3 * g["size"] for g in got)
    assert mixing.mix(empty).collect() == []
    taken = mixing.take_mix(messy)
    assert taken.columns == messy.columns
    assert taken.count() == sum(g["copies"] for g in got)
    assert mixing.take_mix(empty).count() == 0


def test_warc(spark):
    schema = "page_id long, url string, html string, path string, segment int, lo int"
    rows = [(1, "http://a", "<p>x</p>"), (2, None, None), (None, "http://b", ""), (1, "http://a", "<p>x</p>"), (3, "u", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash", 0, 0) for r in rows], schema).repartition(2)
    index = warc.write_segments(pages)
    assert index.count() == 5
    copies = warc.copy_segments(index)
    second = index.join(copies, "segment").withColumn("path", F.col("copy")).drop("copy")
    assert warc.audit(index, index, second).collect() == []
    nothing = warc.write_segments(pages.limit(0))
    assert warc.audit(nothing, nothing, nothing).collect() == []
