"""QP14-QP17 on small hand-made files: band edges, blank/junk hours, header drift, quoted
commas, unparsable dates, zero population, unparsable money, null ZIPs."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tessera.functions import hhmm_to_hour
from tessera.plans import city
from tessera.sources import (flatten_properties, read_csv_strings, read_features,
                             read_header_csv_union)

CRIME_A = """DR_NO,DATE OCC,TIME OCC,Premis Desc,Crm Cd Desc
1,2010 Feb 20 12:00:00 AM,0459,STREET,"THEFT, PETTY"
2,2010 Feb 21 12:00:00 AM,0500,STREET,BURGLARY
3,2010 Jan 05 12:00:00 AM,1159,SIDEWALK,ASSAULT
4,2010 Jan 06 12:00:00 AM,1200,STREET,ASSAULT
5,2010 Jan 07 12:00:00 AM,1659,PARKING LOT,"ROBBERY, ARMED"
"""
CRIME_B = """DR_NO,DATE OCC,TIME OCC ,Premis Desc
6,2020 Nov 01 12:00:00 AM,1700,STREET
7,2020 Nov 02 12:00:00 AM,2059,STREET
8,2020 Apr 03 12:00:00 PM,2100,ALLEY
9,bad date,,STREET
10,2020 Nov 04 12:00:00 AM,abc,STREET
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture(scope="module")
def crime(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("crime")
    a = _write(str(d / "a" / "crime_a.csv"), CRIME_A)
    b = _write(str(d / "b" / "crime_b.csv"), CRIME_B)
    return read_header_csv_union(spark, [a, b])


def test_header_drift_report(spark, tmp_path):
    a = _write(str(tmp_path / "a" / "a.csv"), CRIME_A)
    b = _write(str(tmp_path / "b" / "b.csv"), CRIME_B)
    drift = {}
    read_header_csv_union(spark, [a, b], drift=drift)
    assert drift == {b: ["Crm Cd Desc"]}


def test_header_drift_union(crime):
    assert crime.columns == ["DR_NO", "DATE OCC", "TIME OCC", "Premis Desc", "Crm Cd Desc"]
    assert crime.count() == 10
    got = dict(rows(crime.select("DR_NO", "Crm Cd Desc")))
    assert got["1"] == "THEFT, PETTY" and got["6"] is None


def _share(crime, unknown="drop", use_udf=False):
    hour = hhmm_to_hour("TIME OCC")
    return rows(city.share_by_part_of_day(crime, hour, F.col("Premis Desc") == "STREET",
                                          use_udf=use_udf, unknown=unknown))


@pytest.mark.parametrize("use_udf", [False, True])
def test_share_by_part_of_day(crime, use_udf):
    assert _share(crime, use_udf=use_udf) == [
        ("Evening", 2, 2, 100.0), ("Afternoon", 1, 2, 50.0), ("Morning", 1, 2, 50.0),
        ("Night", 1, 2, 50.0)]


def test_share_reports_unknown_hours(crime):
    from pyspark.sql import Observation
    seen = Observation("hours")
    out = city.share_by_part_of_day(crime, hhmm_to_hour("TIME OCC"),
                                    F.col("Premis Desc") == "STREET", observation=seen)
    out.collect()
    assert seen.get == {"rows": 10, "unknown_hour": 2}


@pytest.mark.parametrize("use_udf", [False, True])
def test_share_unknown_hour_policies(crime, use_udf):
    night = dict((r[0], r[1:]) for r in _share(crime, "Night", use_udf))
    assert night["Night"] == (3, 4, 75.0)
    own = dict((r[0], r[1:]) for r in _share(crime, "null", use_udf))
    assert own[None] == (2, 2, 100.0)


def test_percent_rounding_is_exact(spark):
    from tessera.functions import percent_of
    df = spark.createDataFrame([(7, 24), (1, 8), (1, 3), (2, 3), (0, 5), (3, 0)], "p INT, w INT")
    got = [r[0] for r in rows(df.select(percent_of("p", "w")))]
    assert got == [29.17, 12.5, 33.33, 66.67, 0.0, None]


def test_top_months_per_year_df_and_sql(spark, crime):
    from tessera.functions import parse_timestamp
    want = [(2010, 1, 3, 1), (2010, 2, 2, 2), (2020, 11, 3, 1), (2020, 4, 1, 2)]
    assert rows(city.top_months_per_year(crime, parse_timestamp(F.col("DATE OCC")), 3)) == want
    assert rows(city.top_months_per_year_sql(spark, crime, "DATE OCC")) == want


def test_top_months_plan_has_group_limit(crime):
    from tessera.functions import parse_timestamp
    df = city.top_months_per_year(crime, parse_timestamp(F.col("DATE OCC")), 3)
    df.collect()
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


INCOME = """Zip Code;Community;Estimated Median Income
90001;Florence;$52,806
90002;Watts;$46,159
90003;South LA; $47,733
90071;Downtown;No 2021 estimate ($90,546 in 2020)
91046;Verdugo;---
"""

FEATURES = [("90001", 100, 30), ("90001", 50, 20), ("90002", 0, 5), (None, 7, 7),
            ("91046", 10, 4), ("90071", 20, 9), ("90003", None, 3), ("90003", 40, None)]
PROPS = T.StructType([T.StructField("HOUSING20", T.LongType()),
                      T.StructField("POP20", T.LongType()),
                      T.StructField("ZCTA20", T.StringType())])


def _geojson_doc():
    feats = [{"type": "Feature",
              "properties": {"ZCTA20": z, "POP20": p, "HOUSING20": h},
              "geometry": {"type": "Polygon",
                           "coordinates": [[[-118.2, 34.0], [-118.1, 34.0], [-118.2, 34.1]]]}}
             for z, p, h in FEATURES]
    return json.dumps({"type": "FeatureCollection", "features": feats}, indent=2)


@pytest.mark.parametrize("layout", ["document", "feature_per_line"])
def test_per_capita_income(spark, tmp_path, layout):
    from tessera.sources.geojson import POLYGON
    if layout == "document":
        gj = _write(str(tmp_path / "blocks" / "blocks.geojson"), _geojson_doc())
    else:
        doc = json.loads(_geojson_doc())
        lines = ['{"type": "FeatureCollection", "features": ['] + \
            [json.dumps(f) + "," for f in doc["features"]] + ["]}"]
        gj = _write(str(tmp_path / "blocks" / "blocks.geojson"), "\n".join(lines))
    inc = _write(str(tmp_path / "income" / "income.csv"), INCOME)
    features = flatten_properties(read_features(spark, os.path.dirname(gj), PROPS, POLYGON,
                                                layout=layout))
    assert features.columns == ["HOUSING20", "POP20", "ZCTA20", "geometry"]
    people = city.population_by_zip(features)
    from pyspark.sql import Observation
    seen = Observation(f"income_{layout}")
    income = city.income_by_zip(read_csv_strings(spark, inc, sep=";"), observation=seen)
    assert income.count() == 3
    assert seen.get == {"rows": 5, "dropped": 2}
    got = rows(city.per_capita(people, income))
    assert got == [("90001", 150, 50, 52806.0, 17602.0), ("90003", 40, 3, 47733.0, 3579.98)]


def test_convert_to_parquet(spark, tmp_path, scratch):
    a = _write(str(tmp_path / "a" / "a.csv"), CRIME_A)
    b = _write(str(tmp_path / "b" / "b.csv"), CRIME_B)
    out = scratch("crime_parquet")
    assert city.convert_to_parquet(spark, [a, b], out) == 10
    back = spark.read.parquet(out)
    assert "TIME OCC" in back.columns and back.count() == 10
