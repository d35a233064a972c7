"""Every registered query against its DuckDB SQL on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from tessera.plans import registry

SF = f"{TESTDATA}/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "n", "rank"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = df.collect()
    res = duck.execute(registry.ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_types = dict(zip(d_cols, [str(d[1]) for d in res.description]))
    want = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in df.dtypes} == d_types
    so = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    do = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    assert sorted(tuple(_norm(r[i]) for i in so) for r in got) == \
        sorted(tuple(_norm(r[i]) for i in do) for r in want)


def test_udf_queries_run_from_another_directory(tmp_path):
    """Python workers must import the package even when the driver starts elsewhere."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', len(e.queries()['grouped_udf_mean'](spark, %r).collect()))\n"
    ) % (repo, SF)
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 3" in out.stdout, out.stderr[-2000:]
