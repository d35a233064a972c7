"""QP1-QP5 on the payroll fixtures: DataFrame, SQL and UDF forms agree with the goldens."""

import pytest

from conftest import fixture, rows
from tessera.plans import payroll
from tessera.sources import read_csv

EMP = "id INT, name STRING, salary INT, dep_id INT"
DEP = "id INT, department STRING"


@pytest.fixture(scope="module")
def staff(spark):
    return read_csv(spark, fixture("employees.csv"), EMP)


@pytest.fixture(scope="module")
def deps(spark):
    return read_csv(spark, fixture("departments.csv"), DEP)


def test_lowest_paid(spark, staff):
    want = [(6, "Jerry L", 550, 3), (2, "John K", 1000, 2), (7, "Marios K", 1000, 1),
            (5, "Helen K", 1050, 2), (10, "Yiannis T", 1500, 1)]
    assert rows(payroll.lowest_paid(staff, 5)) == want
    assert rows(payroll.lowest_paid_sql(spark, staff, 5)) == want


def test_top_in_dimension(spark, staff, deps):
    want = [(3, "Mary T", 2100, "Dep A"), (4, "George T", 2100, "Dep A"), (1, "George R", 2000, "Dep A")]
    cols = {"cols": ["id", "name", "salary"], "dim_cols": ["department"]}
    args = ("dep_id", "id", "department", "Dep A", 3)
    assert rows(payroll.top_in_dimension(staff, deps, *args, **cols)) == want
    assert rows(payroll.top_in_dimension_sql(spark, staff, deps, *args, **cols)) == want


YEARLY = [("Vasilios D", 49000), ("Antonis T", 35000), ("George K", 35000),
          ("George T", 29400), ("Mary T", 29400), ("George R", 28000), ("Yiannis T", 21000),
          ("Helen K", 14700), ("John K", 14000), ("Marios K", 14000), ("Jerry L", 7700)]


def test_yearly_income_three_forms(spark, staff):
    assert rows(payroll.yearly_income(staff)) == YEARLY
    assert rows(payroll.yearly_income_sql(spark, staff)) == YEARLY
    assert rows(payroll.yearly_income_udf(staff)) == YEARLY


def test_yearly_income_no_int_overflow(spark):
    big = spark.createDataFrame([("x", 2_000_000_000)], "name STRING, salary INT")
    assert rows(payroll.yearly_income(big)) == [("x", 28_000_000_000)]
    assert rows(payroll.yearly_income_udf(big)) == [("x", 28_000_000_000)]


def test_udf_null_in_null_out(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "name STRING, salary INT")
    assert sorted(rows(payroll.yearly_income_udf(df)), key=str) == [("a", None), ("b", 28)]


def test_sum_per_dimension(staff, deps):
    got = payroll.sum_per_dimension(staff, deps, "dep_id", "id", "department", "salary")
    assert rows(got) == [("Dep A", 8700), ("Dep B", 7050), ("Dep C", 4050)]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge", "shuffle_hash",
                                      "shuffle_replicate_nl"])
def test_count_per_dimension_strategies(staff, deps, strategy):
    got = payroll.count_per_dimension(staff, deps, "dep_id", "id", "department", strategy)
    assert sorted(rows(got)) == [("Dep A", 5), ("Dep B", 4), ("Dep C", 2)]


def test_ties_are_deterministic(spark):
    df = spark.createDataFrame([(i, "n", 100, 1) for i in range(50, 0, -1)], EMP)
    assert [r[0] for r in rows(payroll.lowest_paid(df, 3))] == [1, 2, 3]


def test_sql_forms_leave_no_views(spark, staff):
    before = {t.name for t in spark.catalog.listTables()}
    df = payroll.lowest_paid_sql(spark, staff, 2)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert len(rows(df)) == 2  # still runs after its view is gone
