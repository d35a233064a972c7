"""Scalar functions on hostile inputs; the Arrow UDF twin agrees with the built-in."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import (explode_tokens, fixed_text, hhmm_to_hour, money_to_double,
                               parse_timestamp, part_of_day, part_of_day_udf, rounded, safe_long)


def test_hhmm_to_hour(spark):
    vals = ["1350", "0045", "0001", "\u00a02359 \n", "1345.0", "", "abc", None, "---"]
    df = spark.createDataFrame([(v,) for v in vals], "t STRING")
    assert [r[0] for r in rows(df.select(hhmm_to_hour("t")))] == [
        13, 0, 0, 23, 13, None, None, None, None]


@pytest.mark.parametrize("unknown", ["drop", "Night"])
def test_part_of_day_bands_and_udf_twin(spark, unknown):
    hours = [None] + list(range(24))
    df = spark.createDataFrame([(h,) for h in hours], "h INT")
    builtin = [r[0] for r in rows(df.select(part_of_day("h", unknown)))]
    want = {h: ("Morning" if 5 <= h <= 11 else "Afternoon" if 12 <= h <= 16 else
                "Evening" if 17 <= h <= 20 else "Night") for h in range(24)}
    assert builtin[1:] == [want[h] for h in range(24)]
    assert builtin[0] == ("Night" if unknown == "Night" else None)
    udf = [r[0] for r in rows(df.select(part_of_day_udf(F.col("h"))))]
    assert udf[1:] == builtin[1:] and udf[0] is None


def test_builtin_path_has_no_python_node(spark):
    df = spark.range(10).select(part_of_day(F.hour(F.current_timestamp())).alias("p"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    df2 = spark.range(10).select(part_of_day_udf(F.col("id").cast("int")))
    assert "ArrowEvalPython" in df2._jdf.queryExecution().executedPlan().toString()


def test_money_text(spark):
    vals = ["$52,806", " $46,159\t", "$1,234,567", "No 2021 estimate ($90,546 in 2020)", "---",
            "", None, "$12.50", "52806"]
    df = spark.createDataFrame([(v,) for v in vals], "m STRING")
    assert [r[0] for r in rows(df.select(money_to_double("m")))] == [
        52806.0, 46159.0, 1234567.0, None, None, None, None, None, None]


def test_parse_timestamp(spark):
    import datetime as dt
    vals = ["2010 Feb 20 12:00:00 AM", "2020 Nov 01 01:30:05 PM", "bad", None]
    df = spark.createDataFrame([(v,) for v in vals], "d STRING")
    got = [r[0] for r in rows(df.select(parse_timestamp("d")))]
    assert got == [dt.datetime(2010, 2, 20, 0, 0), dt.datetime(2020, 11, 1, 13, 30, 5), None,
                   None]
    assert df.select(parse_timestamp("d")).schema[0].dataType.simpleString() == "timestamp_ntz"


def test_safe_long_and_tokens(spark):
    df = spark.createDataFrame([(" 12 ",), ("x",), (None,)], "s STRING")
    assert [r[0] for r in rows(df.select(safe_long("s")))] == [12, 0, 0]
    t = spark.createDataFrame([("  a  b\t\tc ",), (None,), ("",)], "x STRING")
    assert rows(explode_tokens(t, "x")) == [("a",), ("b",), ("c",)]


def test_rounding_is_half_up_on_the_decimal_text(spark):
    cases = {2.675: 2.68, 1.005: 1.01, 8.333333: 8.33, 7.665: 7.67, -0.125: -0.13, -2.5e-3: -0.0,
             1e17: 1e17, 1e300: 1e300, -1.005: -1.01, 0.0: 0.0}
    df = spark.createDataFrame([(x,) for x in cases], "x DOUBLE")
    assert [r[0] for r in rows(df.select(rounded("x", 2)))] == list(cases.values())
    assert rows(df.select(fixed_text("%.2f", "x")).limit(1)) == [("2.68",)]


def test_parse_timestamp_ignores_session_zone(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2010 Mar 14 02:30:00 AM",), ("junk",)], "d STRING")
        got = [r[0] for r in rows(df.select(parse_timestamp("d")))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2010, 3, 14, 2, 30), None]


def test_percent_and_rounding_exact_on_random_inputs(spark):
    import random
    from fractions import Fraction
    from tessera.functions import percent_of
    rnd = random.Random(7)
    pairs = [(0, 1), (1, 1), (1, 8), (1, 16), (5, 40)]
    for _ in range(400):
        w = rnd.randint(1, 10 ** rnd.randint(1, 9))
        pairs.append((rnd.randint(0, w), w))
    df = spark.createDataFrame(pairs, "p LONG, w LONG")
    got = [r[0] for r in df.select(percent_of("p", "w")).collect()]
    for (p, w), g in zip(pairs, got):
        exact = Fraction(100 * p, w)
        want = (exact * 100 + Fraction(1, 2)).__floor__() / 100
        assert g == float(want), (p, w, g, float(want))


def test_money_text_random_amounts(spark):
    import random
    rnd = random.Random(3)
    amounts = [rnd.randint(0, 10 ** rnd.randint(1, 12)) for _ in range(300)]
    texts = [(f"{' ' * (a % 3)}${a:,}{' ' * (a % 2)}", float(a)) for a in amounts]
    df = spark.createDataFrame(texts, "t STRING, want DOUBLE")
    bad = df.where(money_to_double("t") != df.want).count()
    assert bad == 0 and df.where(money_to_double("t").isNull()).count() == 0


def test_strip_matches_python(spark):
    from tessera.functions import strip
    vals = ["  a b  ", "\t　x \n", "\x1cy\x1f", "", "   ", "z"]
    df = spark.createDataFrame([(v,) for v in vals], "s STRING")
    assert [r[0] for r in rows(df.select(strip("s")))] == [v.strip() for v in vals]
