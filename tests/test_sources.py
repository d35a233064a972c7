"""Sources and sinks: fixed-schema CSV, bad rows, quarantine, raw lines, GeoJSON, round trips."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import fixture, rows
from tessera.sources import (HeaderClash, drop_header_line, format_lines, from_rows, load, parse_lines,
                             read_back_count, read_csv, read_csv_checked, read_features,
                             read_header_csv_union, read_lines, read_trimmed, row_count,
                             write_collections, write_csv, write_parquet, write_raw_lines,
                             write_text)

BAD = """id,label,amount
1,"a, b",1.5
2,plain,2.5
oops,bad,3.5
3,"x, y, z",
4,short
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_fixed_schema_csv_nulls_bad_fields(spark):
    df = read_csv(spark, fixture("employees.csv"), "id INT, name STRING, salary INT, dep_id INT")
    assert df.count() == 11 and df.schema["salary"].dataType.simpleString() == "int"


def test_drop_malformed_and_quarantine(spark, tmp_path, scratch):
    p = _write(str(tmp_path / "bad" / "bad.csv"), BAD)
    schema = "id INT, label STRING, amount DOUBLE"
    kept = rows(read_csv_checked(spark, p, schema).orderBy("id"))
    assert kept == [(1, "a, b", 1.5), (2, "plain", 2.5), (3, "x, y, z", None)]
    q = scratch("quarantine")
    from pyspark.sql import Observation
    seen = Observation("malformed_rows")
    kept_q = sorted(rows(read_csv_checked(spark, p, schema, quarantine_path=q,
                                          observation=seen)))
    assert kept_q == kept and seen.get["malformed"] == 2
    bad = [r["_corrupt_record"] for r in spark.read.parquet(q).collect()]
    assert sorted(bad) == ["4,short", "oops,bad,3.5"]
    # picking one column must not change what is dropped
    assert rows(read_csv_checked(spark, p, schema, columns=["label"]).orderBy("label")) == [
        ("a, b",), ("plain",), ("x, y, z",)]


def test_line_parse_header_and_short_rows(spark, tmp_path):
    p = _write(str(tmp_path / "lines" / "l.txt"),
               "Zip Code,Community,Income\n90001,Florence,52806\n90002,Watts\n90003,South,x\n")
    lines = drop_header_line(read_lines(spark, p), "Zip Code,Community,Income")
    got = parse_lines(lines, ",", [("zip", "string"), ("community", "string"),
                                   ("income", "int")], min_fields=3)
    assert sorted(rows(got)) == [("90001", "Florence", 52806), ("90003", "South", None)]


def test_semicolon_lines(spark, tmp_path):
    p = _write(str(tmp_path / "semi" / "s.txt"), "a;b;c\n1;2;3\n")
    got = parse_lines(read_lines(spark, p), ";", [("x", "int"), ("y", "int"), ("z", "int")])
    assert rows(got) == [(None, None, None), (1, 2, 3)] or rows(got) == [(1, 2, 3),
                                                                       (None, None, None)]


def test_in_memory_partitions(spark):
    df = from_rows(spark, [(i,) for i in range(1, 11)], "x INT", partitions=4)
    assert df.rdd.getNumPartitions() == 4 and rows(row_count(df)) == [(10,)]


def test_round_trips_and_format_switch(spark, scratch):
    emp = read_csv(spark, fixture("employees.csv"), "id INT, name STRING, salary INT, dep_id INT")
    pq, cs = scratch("emp_pq"), scratch("emp_csv")
    write_parquet(emp, pq)
    write_csv(emp, cs)
    assert read_back_count(spark, pq) == 11
    back_pq = load(spark, pq, "parquet")
    back_csv = load(spark, cs, "csv", schema="id INT, name STRING, salary INT, dep_id INT")
    assert sorted(rows(back_pq)) == sorted(rows(back_csv)) == sorted(rows(emp))


def test_text_sink_fixed_format(spark, scratch):
    df = spark.createDataFrame([("Electronics", 129.0), ("Stationery", 37.005)],
                               "k STRING, v DOUBLE")
    out = scratch("lines")
    write_text(format_lines(df, "%s,%.2f", ["k", "v"]), out)
    assert sorted(r[0] for r in read_lines(spark, out).collect()) == [
        "Electronics,129.00", "Stationery,37.01"]


def test_single_file_opt_in(spark, scratch):
    df = spark.range(100).repartition(4)
    out = scratch("one")
    write_csv(df, out, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1


def _numbers(spark):
    df = spark.range(0, 50, numPartitions=5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    point = F.struct(F.lit("Point").alias("type"), F.array(F.col("k").cast("double"), F.lit(0.0)).alias("coordinates"))
    return df, point


@pytest.mark.parametrize("layout", ["document_per_line", "feature_per_line"])
def test_geojson_writer_bounded_documents(spark, scratch, layout):
    df, point = _numbers(spark)
    out = scratch("gj")
    write_collections(df, out, ["k", "v"], point, features_per_doc=4)
    assert read_lines(spark, out).count() == 15  # 5 partitions of 10 rows, 4 + 4 + 2 each
    assert not [d for d in os.listdir(out) if os.path.isdir(os.path.join(out, d))]
    feats = read_features(spark, out, T.StructType.fromDDL("k LONG, v LONG"), layout=layout)
    assert feats.count() == 50
    assert rows(feats.agg(F.sum("properties.v"))) == [(2450,)]


FEATURE = '{"type": "Feature", "properties": {"k": %d, "v": 0}, "geometry": {"type": "Point", "coordinates": [1, 2]}}'


@pytest.mark.parametrize("text", [
    '{"type": "FeatureCollection", "features": [' + FEATURE % 1 + ", " + FEATURE % 2 + "]}",
    '{"type": "FeatureCollection", "features": [' + FEATURE % 1 + ",\n" + FEATURE % 2 + "\n]}",
    '{\n"type": "FeatureCollection",\n"name": "x",\n"crs": {"type": "name"},\n"features": [\n' + FEATURE % 1 + ",\n" + FEATURE % 2 + "\n]\n}",
    FEATURE % 1 + ",\n" + FEATURE % 2 + "]}\n\n",
])
def test_features_on_any_line(spark, tmp_path, text):
    p = _write(str(tmp_path / "gj" / "a.json"), text)
    feats = read_features(spark, p, T.StructType.fromDDL("k LONG, v LONG"), layout="feature_per_line")
    assert sorted(r[0] for r in feats.select("properties.k").collect()) == [1, 2]
    if text.startswith("{\n") or text.startswith('{"type": "FeatureC'):
        whole = read_features(spark, p, T.StructType.fromDDL("k LONG, v LONG"), layout="document")
        assert whole.count() == 2


@pytest.mark.parametrize("line", ["garbage", '{"type": "Feature", "properties": {"k": 1', '[1, 2]x'])
def test_lines_that_are_no_features_stop_the_read(spark, tmp_path, line):
    p = _write(str(tmp_path / "gj" / "a.json"), '{"type": "FeatureCollection", "features": [\n' + line + "\n]}")
    with pytest.raises(Exception, match="not a GeoJSON feature line"):
        read_features(spark, p, T.StructType.fromDDL("k LONG, v LONG"), layout="feature_per_line").collect()


TRICKY = ["plain", "", None, " s ", 'say "hi", ok', '"', '""', "a,b", "line\nbreak", "tab\t", "\\", '\\"', "é"]


def test_csv_text_comes_back_unchanged(spark, scratch):
    import csv
    df = spark.createDataFrame(list(enumerate(TRICKY)), "i INT, t STRING").coalesce(1)
    out = scratch("tricky")
    write_csv(df, out)
    back = read_csv(spark, out, "i INT, t STRING", multi_line=True)
    assert [r["t"] for r in back.orderBy("i").collect()] == TRICKY
    part = next(f for f in os.listdir(out) if f.startswith("part-"))
    with open(os.path.join(out, part), newline="") as f:
        assert [r[1] for r in csv.reader(f)] == [t or "" for t in TRICKY]


def test_doubled_quotes_are_good_rows(spark, tmp_path):
    p = _write(str(tmp_path / "q" / "q.csv"), 'id,label,amount\n1,"say ""hi"", ok",2.5\n2,x,1\n')
    schema = "id INT, label STRING, amount DOUBLE"
    want = [(1, 'say "hi", ok', 2.5), (2, "x", 1.0)]
    assert sorted(rows(read_csv_checked(spark, p, schema))) == want
    assert sorted(rows(read_csv(spark, p, schema, header=True))) == want


def test_raw_lines_carry_a_header_in_every_file(spark, scratch):
    out = scratch("raw")
    lines = spark.range(0, 4, numPartitions=2).select(F.concat(F.col("id"), F.lit(',"a ""q""", ')).alias("value"))
    write_raw_lines(lines, out, "x,y")
    got = sorted(r[0] for r in read_lines(spark, out).collect())
    assert got == ['0,"a ""q""", ', '1,"a ""q""", ', '2,"a ""q""", ', '3,"a ""q""", ', "x,y", "x,y"]


def test_header_drift_and_clash(spark, tmp_path):
    a = _write(str(tmp_path / "h" / "a.csv"), "id, name \n1,x\n")
    b = _write(str(tmp_path / "h" / "b.csv"), "name,extra\ny,2\n")
    drift = {}
    got = read_header_csv_union(spark, [a, b], drift=drift)
    assert got.columns == ["id", "name", "extra"]
    assert sorted(rows(got), key=str) == sorted([("1", "x", None), (None, "y", "2")], key=str)
    assert drift == {a: ["extra"], b: ["id"]}
    c = _write(str(tmp_path / "h" / "c.csv"), "id,id \n1,2\n")
    with pytest.raises(HeaderClash):
        read_trimmed(spark, c)


def test_checked_csv_columns_by_header_name(spark, tmp_path):
    text = ('DR_NO,Premis Desc,TIME OCC\n1,"STREET, MAIN",1350\n2,ALLEY,0045\n'
            'x,broken\n3,PARK,abc\n')
    p = _write(str(tmp_path / "crime" / "c.csv"), text)
    got = read_csv_checked(spark, p, {"TIME OCC": "int", "DR_NO": "int"},
                           columns=["TIME OCC", "Premis Desc"])
    # 'x,broken' has too few fields and a bad DR_NO; 'abc' is not an int -> both rows dropped
    assert sorted(rows(got)) == [(45, "ALLEY"), (1350, "STREET, MAIN")]
