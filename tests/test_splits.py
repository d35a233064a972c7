"""Records cut from byte ranges, headers of many files, ordered output, checked conversion, theta joins."""

import csv
import io
import json
import os
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import TESTDATA, rows
from tessera.operators import relational
from tessera.sources import (HeaderClash, compare, convert_checked, fingerprint, ordered, read_csv,
                             read_features, read_header_csv_union, read_ordered, splits, write_csv, write_ordered)


# -- the cutters, without Spark ---------------------------------------------------------------------------

def cut(kind, groups):
    """All ``CUT`` rows of pieces that are dealt to ranges."""
    names, start_names = ([c.split()[0] for c in s.split(", ")] for s in (kind.survey_schema, kind.start_schema))
    surveyed = [dict(zip(names, kind.survey([g]))) | {"block": i} for i, g in enumerate(groups)]
    out = []
    for row, group, (owner, start) in zip(surveyed, groups, kind.chain(surveyed)):
        # the pieces of a range may come in several batches
        halves = [group[:len(group) // 2], group[len(group) // 2:]]
        for at, x in enumerate(kind.cut(row["block"], owner, dict(zip(start_names, start)), [h for h in halves if h])):
            out.append((row["block"], at, *x))
    return out


def dealt(pieces, cuts):
    edges = [0, *sorted(min(c, len(pieces)) for c in cuts), len(pieces)]
    return [pieces[a:b] for a, b in zip(edges, edges[1:]) if b > a]


def features(groups):
    found, inside, joined, state = [], {}, {}, False
    out = cut(splits.JsonFeatures(), groups)
    for block, _, _, kind, known, _, _ in out:
        if kind == splits.LAST:
            inside[block] = state
            state = state if known is None else known
    for block, _, owner, kind, known, _, text in out:
        if kind == splits.PIECE:
            joined.setdefault(owner, []).append((known, text))
        elif kind != splits.LAST and (inside[block] if known is None else known):
            assert kind == splits.WHOLE, text
            found.append(text)
    for owner, parts in joined.items():
        if inside[owner] if parts[0][0] is None else parts[0][0]:
            found.append("".join(p[1] for p in parts))
    return sorted(json.dumps(json.loads(f), sort_keys=True) for f in found)


TEXT = st.text(alphabet='a"\\{}[]:, \né', max_size=6)
VALUE = st.recursive(TEXT | st.integers(-9, 9) | st.none(),
                     lambda v: st.lists(v, max_size=3) | st.dictionaries(TEXT | st.just("features"), v, max_size=3), max_leaves=8)
FEATURE = st.dictionaries(TEXT, VALUE, max_size=3)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(TEXT, VALUE, max_size=2), st.lists(FEATURE, max_size=4), st.dictionaries(TEXT, VALUE, max_size=2),
       st.sampled_from([None, 0, 2]), st.sampled_from(["", "\n", " \n "]), st.lists(st.integers(0, 60), max_size=5))
def test_features_of_any_document_and_cut(head, members, tail, indent, end, cuts):
    doc = {**head, "features": members, **{k: v for k, v in tail.items() if k != "features"}}
    pieces = (json.dumps(doc, indent=indent, ensure_ascii=False) + end).split("}")
    pieces = pieces if pieces[-1] else pieces[:-1]
    want = sorted(json.dumps(m, sort_keys=True) for m in members)
    assert features(dealt(pieces, cuts)) == want
    assert features([[p] for p in pieces]) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", '"', '""', ",", "\n", '"x\ny"', " ", "é"]), max_size=25), st.lists(st.integers(0, 20), max_size=4))
def test_csv_records_at_any_cut(parts, cuts):
    text = "".join(parts)
    lines = text.split("\n")
    lines = lines if lines[-1] else lines[:-1]
    records = {}
    for block, at, owner, kind, _, _, part in cut(splits.CsvRecords(), dealt(lines, cuts)):
        records.setdefault((owner, at if kind == splits.WHOLE else 1 << 30), []).append(part)
    got = ["\n".join(r) for _, r in sorted(records.items())]
    assert "\n".join(got) == "\n".join(lines)
    if splits.CsvRecords().survey([lines])[0]:
        return  # a quote that is never closed takes the last line break or not
    want = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    assert [next(csv.reader(io.StringIO(g, newline=""))) for g in got if g] == want


# -- with Spark's own splitting ---------------------------------------------------------------------------------

@pytest.fixture()
def split_bytes(spark):
    def set_(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield set_
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


COLLECTION = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}},
              "other": [{"type": "Feature", "properties": {"z": "no", "n": 0}}],
              "features": [{"type": "Feature", "properties": {"z": z, "n": i, "more": {"features": [{"a": "}"}]}},
                            "geometry": {"type": "Point", "coordinates": [i / 2, -1.5]} if i % 3 else None}
                           for i, z in enumerate(["a", 'b"}{', "\\", "", None, "é\n", "features", "}]}"] * 3)],
              "bbox": [1, 2], "name": "features"}


@pytest.mark.parametrize("n", [150, 1000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_document_equals_the_whole_read(spark, tmp_path, split_bytes, n, indent):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(json.dumps(COLLECTION, indent=indent) + "\n" * (name == "b.json"))
    schema = T.StructType.fromDDL("z STRING, n INT")
    want = spark.read.schema(splits_schema(schema)).option("multiLine", True).json(str(tmp_path)).select(
        F.explode("features").alias("f")).select("f.*").collect()
    split_bytes(n)
    got = read_features(spark, str(tmp_path), schema, layout="document")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want)) and len(want) == 48


def splits_schema(properties):
    from tessera.sources.geojson import collection_schema
    return collection_schema(properties)


def test_one_document_is_read_by_several_tasks(spark, tmp_path, split_bytes):
    big = dict(COLLECTION, features=COLLECTION["features"] * 200)
    (tmp_path / "a.json").write_text(json.dumps(big, indent=1))
    split_bytes(64 << 10)
    found = splits.cut_records(spark, str(tmp_path), splits.JsonFeatures())
    assert found.where("kind = 0").select(F.spark_partition_id()).distinct().count() >= 5
    assert read_features(spark, str(tmp_path), T.StructType.fromDDL("z STRING"), layout="document").count() == 4800


@pytest.mark.parametrize("text", ['{"features":[1]}', '{"features":[{"a":1},null]}', '{"features":["x}",{"a":1}]}', '{"features":[[{"a":1}], 2]}'])
def test_what_is_no_feature_stops_the_job(spark, tmp_path, split_bytes, text):
    (tmp_path / "a.json").write_text(text)
    split_bytes(8)
    with pytest.raises(Exception, match="not an object"):
        read_features(spark, str(tmp_path), T.StructType.fromDDL("z STRING"), layout="document").collect()


def test_default_layout_never_reads_nothing_in_silence(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(COLLECTION, indent=2))
    schema = T.StructType.fromDDL("z STRING, n INT")
    with pytest.raises(Exception, match="no whole FeatureCollection"):
        read_features(spark, str(tmp_path), schema).collect()
    assert read_features(spark, str(tmp_path), schema, layout="document").count() == 24


def hostile_csv(seed, n):
    rng = random.Random(seed)
    cell = ["", "a", 'q"q', "x,y", "two\nlines", "cr\r\nlf", '"', "\n", " blank ", "é", "a\n\n\"\nb", "x" * 300]
    return [[str(i), rng.choice(cell), rng.choice(cell)] for i in range(n)]


@pytest.mark.parametrize("n", [150, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_equal_csv_reader(spark, tmp_path, split_bytes, n, end):
    want = []
    for name in ("a.csv", "b.csv"):
        table = hostile_csv(name, 25)
        want += table
        with open(tmp_path / name, "w", newline="") as f:
            writer = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
            writer.writerows([["id", "two\nlines", "c"], *table])
    split_bytes(n)
    got = read_csv(spark, str(tmp_path), "id STRING, b STRING, c STRING", header=True, multi_line=True)
    assert sorted(map(list, rows(got))) == sorted(want)


def test_one_csv_file_is_read_by_several_tasks(spark, tmp_path, split_bytes):
    with open(tmp_path / "a.csv", "w", newline="") as f:
        csv.writer(f).writerows(hostile_csv(3, 20_000))
    split_bytes(64 << 10)
    df = read_csv(spark, str(tmp_path / "a.csv"), "id INT, b STRING, c STRING", multi_line=True)
    assert df.select(F.spark_partition_id()).distinct().count() >= 5
    assert df.agg(F.count("*"), F.count_distinct("id"), F.max("id")).first() == (20_000, 20_000, 19_999)
    bad = tmp_path / "bad.csv"
    bad.write_text('1,a,"x\ny"\nno,b\n3,c,d\n')
    assert sorted(rows(read_csv(spark, str(bad), "id INT, b STRING, c STRING", multi_line=True, mode="DROPMALFORMED"))) == [
        (1, "a", "x\ny"), (3, "c", "d")]


# -- header drift ---------------------------------------------------------------------------------------------------

def test_headers_of_many_files(spark, tmp_path):
    heads = ["id,name", "id , name,extra", '"na,me",id', "id,name"]
    for i in range(600):
        (tmp_path / f"f{i:04d}.csv").write_text(f"{heads[i % 4]}\n" + ",".join([str(i)] * (3 if i % 4 == 1 else 2)) + "\n")
    paths = [str(tmp_path / f"f{i:04d}.csv") for i in range(600)]
    drift = {}
    t = time.perf_counter()
    got = read_header_csv_union(spark, paths, drift=drift)
    planned = time.perf_counter() - t
    assert got.columns == ["id", "name", "extra", "na,me"] and planned < 30
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3  # one scan per distinct header
    assert got.count() == 600 and got.where("extra IS NOT NULL").count() == 150
    assert drift[paths[0]] == ["extra", "na,me"] and drift[paths[2]] == ["name", "extra"] and drift[paths[1]] == ["na,me"]


def test_header_folders_quotes_clashes_and_empty_files(spark, tmp_path):
    one, two = tmp_path / "one dir", tmp_path / "two"
    for d in (one, two):
        os.makedirs(d)
    (one / "a.csv").write_text('id,"a\nb"\r\n1,x\r\n')
    (one / "b.csv").write_text("id\n2\n")
    (two / "c.csv").write_text("")
    drift = {}
    got = read_header_csv_union(spark, [str(one), str(two)], drift=drift)
    assert got.columns == ["id", "a\nb"]
    assert drift == {str(one): ["a\nb"]}
    (two / "d.csv").write_text("x, x\n1,2\n")
    with pytest.raises(HeaderClash):
        read_header_csv_union(spark, [str(one), str(two)])


# -- ordered output and checked conversion -----------------------------------------------------------------------------

@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_order_survives_many_files(spark, scratch, split_bytes, fmt):
    df = spark.range(0, 4000, numPartitions=5).select((F.col("id") * 7919 % 4001).cast("int").alias("n"),
                                                      F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"))
    order = [("k", False), ("n", True)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = scratch("ordered")
        manifest = write_ordered(df, path, order, fmt)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() >= 4 and manifest.agg(F.sum("rows")).first()[0] == 4000
    split_bytes(3000)
    got = sorted(rows(read_ordered(spark, path, df.schema, fmt)), key=lambda r: r[2])
    want = sorted(rows(df), key=lambda r: (r[1] is None, -ord(r[1][0]) if r[1] else 0, r[0]))
    assert [r[:2] for r in got] == want and [r[2] for r in got] == list(range(1, 4001))


def test_manifest_finds_missing_rows_and_broken_order(spark, scratch):
    df = spark.range(100).select(F.col("id").cast("int").alias("n"))
    path = scratch("ordered")
    manifest = write_ordered(df, path, [("n", True)])
    spark.range(3).select(F.col("id").cast("int").alias("n")).write.mode("append").parquet(path)
    with pytest.raises(ordered.OutOfOrder):
        read_ordered(spark, path, df.schema).count()
    row = manifest.first()
    twice = spark.createDataFrame([("a", 0, 1, (1,), (5,)), ("b", 1, 1, (4,), (9,))], manifest.schema)
    with pytest.raises(ordered.OutOfOrder, match="b begins"):
        ordered.check_order(twice, [("n", True)])
    assert row["rows"] <= 100


def test_nulls_and_emptiness_in_order(spark, scratch):
    df = spark.createDataFrame([(None, "a"), (2, None), (None, None), (1, "b")], "n INT, k STRING")
    path = scratch("ordered")
    write_ordered(df, path, [("n", True), ("k", False)])
    got = sorted(rows(read_ordered(spark, path, df.schema)), key=lambda r: r[2])
    assert got == [(None, "a", 1), (None, None, 2), (1, "b", 3), (2, None, 4)]
    empty = scratch("ordered")
    write_ordered(df.limit(0), empty, [("n", True)])
    assert rows(read_ordered(spark, empty, df.schema)) == []


def test_a_swapped_pair_is_found(spark, scratch):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 0.5), (2, "y", 0.5), (3, None, -1.0)], "id INT, s STRING, d DOUBLE")
    assert compare(a, a.repartition(3).orderBy("d")) == []
    swapped = spark.createDataFrame([(1, "y", None), (2, "x", 0.5), (2, "y", 0.5), (3, None, -1.0)], a.schema)
    assert compare(a, swapped) == ["whole rows"]  # every column holds the same values, and the count agrees
    other = a.withColumn("s", F.coalesce("s", F.lit("")))
    assert compare(a, other) == ["values of s", "whole rows"]
    assert compare(a, a.union(a.limit(1)))[0] == "4 and 5 rows"
    assert compare(a, a.drop("d"))
    assert compare(a.limit(0), a.limit(0)) == []
    both = fingerprint(a).collect()
    halves = [fingerprint(a.where(c)).collect() for c in ("id = 2", "id <> 2")]
    assert [r["total"] for r in both] == [x["total"] + y["total"] for x, y in zip(*halves)]
    assert sorted(map(repr, rows(convert_checked(a, scratch("checked"))))) == sorted(map(repr, rows(a)))


def test_conversion_that_loses_something_is_refused(spark, scratch, monkeypatch):
    df = spark.range(10).select("id", F.lit("x").alias("s"))
    monkeypatch.setattr(ordered, "write_parquet", lambda d, p: d.withColumn("s", F.when(F.col("id") == 3, "y").otherwise(F.col("s"))).write.parquet(p))
    with pytest.raises(ordered.Changed, match="values of s"):
        convert_checked(df, scratch("lossy"))


# -- joins ------------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("more", [{"cells": 1}, {"cells": 20}, {"shape": (5, 1)}, {"shape": (2, 7)}])
def test_theta_join_equals_the_nested_loop(spark, more):
    a = spark.range(0, 90, numPartitions=3).select(F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("v"), F.lit("l").alias("_row"))
    b = spark.range(0, 40, numPartitions=2).select((F.col("id") % 9).alias("v"), F.lit("r").alias("_cell")).union(
        spark.createDataFrame([(None, None)], "v LONG, _cell STRING"))

    def less(x, y):
        return F.col(f"{x}.v") < F.col(f"{y}.v")

    got = relational.theta_join(a, b, less, **more)
    assert got.columns == ["v", "_row", "v", "_cell"]
    want = relational.join(a.alias("l"), b.alias("r"), less("l", "r"), strategy="shuffle_replicate_nl")
    assert sorted(rows(got)) == sorted(rows(want)) and got.count() > 100
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_theta_join_spreads_equal_rows(spark):
    hot = spark.range(0, 30_000, numPartitions=4).select(F.lit(1).alias("v"))
    few = spark.range(0, 64).select(F.lit(2).alias("w"))
    got = relational.theta_join(hot, few, lambda x, y: F.col(f"{x}.v") < F.col(f"{y}.w"), shape=(8, 2))
    assert got.count() == 30_000 * 64
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 4 and max(sizes) < 0.5 * 30_000 * 64


def _near(x, y):
    return F.col(f"{x}.v").between(F.col(f"{y}.v") - 5, F.col(f"{y}.v") + 5) & (F.col(f"{x}._band") != F.col(f"{y}._cell"))


@pytest.mark.parametrize("more", [{"cells": 1}, {"cells": 9}, {"shape": (3, 2)}])
@pytest.mark.parametrize("width", [0.7, 5, 1000])
def test_theta_join_in_bands_equals_the_nested_loop(spark, more, width):
    odd = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 4.999999999999999, -5.0, 5.0, 10.0, 1e300, -1e300, 2.0 ** 53 + 2]
    draw = random.Random(7)
    values = odd + [round(draw.uniform(-30, 30), draw.choice([0, 1, 15])) for _ in range(80)] + [7.0] * 40
    a, b = (spark.createDataFrame([(v, i % n) for i, v in enumerate(values)], f"v DOUBLE, {name} LONG")
            for n, name in ((3, "_band"), (2, "_cell")))
    got = relational.theta_join(a, b, _near, band=(F.col("v"), F.col("v") - 5, F.col("v") + 5, width), **more)
    assert got.columns == ["v", "_band", "v", "_cell"]
    want = relational.join(a.alias("l"), b.alias("r"), _near("l", "r"), strategy="shuffle_replicate_nl")
    assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(want))) and got.count() > 1000


def test_theta_join_in_bands_of_whole_numbers(spark):
    """Numbers that are equal as doubles."""
    a, b = (spark.range(9).select((F.col("id") * step + (1 << 60)).alias("v")) for step in (1, 150))
    band = (F.col("v"), F.col("v") - 3, F.col("v") + 3, 2)
    got = relational.theta_join(a, b, lambda x, y: F.col(f"{x}.v").between(F.col(f"{y}.v") - 3, F.col(f"{y}.v") + 3), band=band)
    assert got.count() == 4


def test_theta_join_in_bands_tests_few_pairs(spark):
    a = spark.range(0, 4000, numPartitions=3).select((F.col("id") * 2.5).alias("v"))
    b = spark.range(0, 400, numPartitions=2).select((F.col("id") * 25.0).alias("w"))
    reach = (F.col("w") - 50, F.col("w") + 50)
    found = relational.theta_join(a, b, lambda x, y: F.col(f"{x}.v").between(F.col(f"{y}.w") - 50, F.col(f"{y}.w") + 50),
                                  band=(F.col("v"), *reach, 50)).count()
    tested = relational.theta_join(a, b, lambda x, y: F.lit(True), band=(F.col("v"), *reach, 50)).count()
    assert 16_000 < found <= tested < 1.7 * found < 4000 * 400 / 50


def test_customers_and_suppliers_are_joined_in_bands(spark, scratch):
    from tessera.plans import registry

    path, draw = scratch("balances"), random.Random(3)
    customers, suppliers = ([(i, round(draw.uniform(-999, 9999), 2), draw.randrange(5)) for i in range(n)] for n in (600, 80))
    customers += [(1, 100.0, 0), (1, 100.0, 0), (None, 200.0, 1), (9, None, 1), (9, 100.0, None)]
    suppliers += [(1, 150.0, 1), (1, 150.0, 1), (2, 50.0, 0), (3, None, 2), (4, 100.0, None)]
    for name, data, columns in (("customer", customers, "c_custkey LONG, c_acctbal DOUBLE, c_nationkey INT"),
                                ("supplier", suppliers, "s_suppkey LONG, s_acctbal DOUBLE, s_nationkey INT")):
        spark.createDataFrame(data, columns).write.parquet(f"{path}/{name}.parquet")
    got = registry.QUERIES["join_theta"](spark, path)
    want = [(c, s) for c, x, m in customers for s, y, n in suppliers
            if None not in (x, y, m, n) and y - 50 <= x <= y + 50 and m != n]
    assert sorted(map(repr, rows(got))) == sorted(map(repr, want)) and len(want) > 100
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x]
    assert joins and all("_band" in x.partition("Inner")[0] for x in joins)


def test_small_results_of_large_tables_may_be_broadcast(spark, scratch):
    path = scratch("large")
    spark.range(0, 200_000).select("id", (F.col("id") % 5).alias("g")).write.parquet(path)
    large = spark.read.parquet(path)
    few = large.where("id * 3 % 7919 = 3")  # a filter that no statistics know
    groups = large.groupBy("g").agg(F.max("id").alias("top"))
    for side, key in ((few, "id"), (groups, "g")):
        assert relational.estimated_bytes(side) > 20_000
        got = relational.join_keys(large, side, key, key, strategy="broadcast", max_broadcast_bytes=20_000)
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == relational.join_keys(large, side, key, key).count()
        named = relational.join(large, side, [key], strategy="broadcast", max_broadcast_bytes=20_000)
        assert named.count() == got.count()
    with pytest.raises(relational.SideTooLarge):
        relational.join_keys(large, large, "id", "id", strategy="broadcast", max_broadcast_bytes=20_000)


def test_csv_texts_of_documents_come_back(spark, scratch, split_bytes):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    path = scratch("texts")
    write_csv(docs, path)
    split_bytes(20_000)
    assert compare(docs, read_csv(spark, path, docs.schema, multi_line=True)) == []
