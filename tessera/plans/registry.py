"""Named queries over the test tables, each with an equivalent ANSI SQL oracle.

Every query reads whole tables from ``sf_dir`` (or files Spark writes from them) and returns a
DataFrame; computed columns carry the same names as in the SQL. Values that depend on the order
of floating-point additions are summed exactly (decimal) and converted to double at the end.
Rounding is Spark's ``round``; the SQL says the same on the decimal text of the value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import (TEXT_TIMESTAMP_PATTERN, clock_text, fixed_text, hhmm_to_hour,
                               money_to_double, parse_timestamp, safe_long)
from tessera.operators import relational, setops, streams
from tessera.plans import city, payroll, workbook
from tessera.session import scratch_path, ship_package
from tessera.sources import (drop_header_line, flatten_properties, format_lines, global_sum,
                             int_range, join_lines, load, parse_lines, read_csv,
                             read_csv_checked, read_csv_strings, read_features,
                             read_header_csv_union, read_lines, read_parquet, row_count,
                             convert_checked, read_ordered, write_collections, write_csv, write_documents,
                             write_feature_lines, write_ordered, write_parquet, write_raw_lines, write_text)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = " ".join(sql.split())
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it is on disk now."""
    ship_package(spark)  # workers must import the package for the pandas functions
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rounded_sql(x: str) -> str:
    """``round(x, 2)`` on the decimal text of a double, half away from zero, in DuckDB."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


# ---- QP1 / QP2 / QP3 / QP4 / QP5 ----------------------------------------------------------------

BOTTOM_K_SQL = """SELECT c_custkey, c_name, c_acctbal, c_nationkey FROM customer
ORDER BY c_acctbal, c_custkey LIMIT 5"""


@query("bottom_k", BOTTOM_K_SQL)
def q_bottom_k(spark, sf_dir):
    return payroll.lowest_paid(table(spark, sf_dir, "customer"), 5, "c_acctbal", "c_custkey",
                               ["c_custkey", "c_name", "c_acctbal", "c_nationkey"])


@query("bottom_k_sql", BOTTOM_K_SQL)
def q_bottom_k_sql(spark, sf_dir):
    return payroll.lowest_paid_sql(spark, table(spark, sf_dir, "customer"), 5, "c_acctbal",
                                   "c_custkey",
                                   ["c_custkey", "c_name", "c_acctbal", "c_nationkey"])


TOP_K_IN_DIM_SQL = """SELECT c_custkey, c_name, c_acctbal, n_name FROM customer
JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_3'
ORDER BY c_acctbal DESC, c_custkey LIMIT 3"""


@query("top_k_in_dim", TOP_K_IN_DIM_SQL)
def q_top_k_in_dim(spark, sf_dir):
    return payroll.top_in_dimension(table(spark, sf_dir, "customer"),
                                    table(spark, sf_dir, "nation"), "c_nationkey",
                                    "n_nationkey", "n_name", "NATION_3", 3, "c_acctbal",
                                    "c_custkey", ["c_custkey", "c_name", "c_acctbal"], ["n_name"])


@query("top_k_in_dim_sql", TOP_K_IN_DIM_SQL)
def q_top_k_in_dim_sql(spark, sf_dir):
    return payroll.top_in_dimension_sql(spark, table(spark, sf_dir, "customer"),
                                        table(spark, sf_dir, "nation"), "c_nationkey",
                                        "n_nationkey", "n_name", "NATION_3", 3, "c_acctbal",
                                        "c_custkey", ["c_custkey", "c_name", "c_acctbal"], ["n_name"])


TOP_K_SHARED_SQL = """SELECT c_custkey AS id, c_name AS name, c_acctbal AS salary, n_name AS department
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_3'
ORDER BY c_acctbal DESC, c_custkey LIMIT 3"""


def _staff_and_departments(spark, sf_dir):
    """Two tables that share the column names ``id`` and ``name``, as payroll tables do."""
    staff = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("salary"),
        F.col("c_nationkey").alias("dep_id"))
    departments = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("department"), F.lit("x").alias("name"))
    return staff, departments


@query("top_k_shared_names", TOP_K_SHARED_SQL)
def q_top_k_shared_names(spark, sf_dir):
    return payroll.top_in_dimension(*_staff_and_departments(spark, sf_dir), "dep_id", "id", "department",
                                    "NATION_3", 3, cols=["id", "name", "salary"], dim_cols=["department"])


@query("top_k_shared_names_sql", TOP_K_SHARED_SQL)
def q_top_k_shared_names_sql(spark, sf_dir):
    return payroll.top_in_dimension_sql(spark, *_staff_and_departments(spark, sf_dir), "dep_id", "id",
                                        "department", "NATION_3", 3, cols=["id", "name", "salary"],
                                        dim_cols=["department"])


@query("yearly_income", "SELECT o_orderkey, o_totalprice * 14 AS yearly_income FROM orders")
def q_yearly_income(spark, sf_dir):
    return payroll.yearly_income(table(spark, sf_dir, "orders"), "o_totalprice",
                                 "o_orderkey")


YEARLY_INT_SQL = """SELECT p_partkey, p_name, CAST(p_size AS BIGINT) * 14 AS yearly_income
FROM part"""


@query("yearly_income_int", YEARLY_INT_SQL)
def q_yearly_income_int(spark, sf_dir):
    return payroll.yearly_income(table(spark, sf_dir, "part"), "p_size", "p_name",
                                 extra=["p_partkey"])


@query("yearly_income_udf", YEARLY_INT_SQL)
def q_yearly_income_udf(spark, sf_dir):
    return payroll.yearly_income_udf(table(spark, sf_dir, "part"), "p_size", "p_name",
                                     extra=["p_partkey"])


@query("yearly_income_sql", YEARLY_INT_SQL)
def q_yearly_income_sql(spark, sf_dir):
    return payroll.yearly_income_sql(spark, table(spark, sf_dir, "part"), "p_size", "p_name",
                                     extra=["p_partkey"])


@query("sum_per_dim", """SELECT n_name,
CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def q_sum_per_dim(spark, sf_dir):
    return payroll.sum_per_dimension(table(spark, sf_dir, "customer"),
                                     table(spark, sf_dir, "nation"), "c_nationkey",
                                     "n_nationkey", "n_name", "c_acctbal", "total", money=True)


# ---- QP6 - QP13 ---------------------------------------------------------------------------------

# the same whitespace set as functions.WHITESPACE, spelled for RE2
WORD_COUNT_SQL = (r"""SELECT w AS word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}"""
                  r"""\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'))
  AS w FROM documents) t
WHERE w <> '' GROUP BY w""")


@query("word_count", WORD_COUNT_SQL)
def q_word_count(spark, sf_dir):
    return workbook.word_count(table(spark, sf_dir, "documents"), "text")


@query("word_count_text_file", WORD_COUNT_SQL)
def q_word_count_text_file(spark, sf_dir):
    """The same count from a plain text file (S11): the texts are written as lines first."""
    path = scratch_path(spark, "documents_text")
    write_text(table(spark, sf_dir, "documents").select("text"), path)
    return workbook.word_count(read_lines(spark, path), "value")


@query("even_squares", """SELECT p_partkey AS n,
CAST(p_partkey AS DECIMAL(38,0)) * CAST(p_partkey AS DECIMAL(38,0)) AS sq
FROM part WHERE p_partkey % 2 = 0""")
def q_even_squares(spark, sf_dir):
    return workbook.even_squares(table(spark, sf_dir, "part"), "p_partkey")


@query("range_squares", """SELECT range AS n,
CAST(range AS DECIMAL(38,0)) * CAST(range AS DECIMAL(38,0)) AS sq
FROM range((SELECT count(*) FROM part)) WHERE range % 2 = 0""")
def q_range_squares(spark, sf_dir):
    """Even squares over ``spark.range`` (S13) sized by a table's row count (one scalar action);
    the ids are generated on the executors, nothing but the count passes through the driver."""
    n = table(spark, sf_dir, "part").count()
    return workbook.even_squares(int_range(spark, n), "id")


@query("global_sum", "SELECT SUM(CAST(p_partkey AS DECIMAL(38,0))) AS total FROM part")
def q_global_sum(spark, sf_dir):
    return global_sum(table(spark, sf_dir, "part"), "p_partkey", "total", exact=True)


def _sold_and_listed(spark, sf_dir):
    """The part keys of all sales (with repeats) and of all parts."""
    return (table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k")),
            table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")))


@query("union_all", "SELECT l_partkey AS k FROM lineitem UNION ALL SELECT p_partkey AS k FROM part")
def q_union_all(spark, sf_dir):
    return setops.union_all(list(_sold_and_listed(spark, sf_dir)))


@query("union_distinct", "SELECT l_partkey AS k FROM lineitem UNION SELECT p_partkey AS k FROM part")
def q_union_distinct(spark, sf_dir):
    return workbook.in_either(*_sold_and_listed(spark, sf_dir))


@query("intersect_parts", "SELECT l_partkey AS k FROM lineitem INTERSECT SELECT p_partkey AS k FROM part")
def q_intersect_parts(spark, sf_dir):
    return workbook.in_both(*_sold_and_listed(spark, sf_dir))


@query("intersect_keys", """SELECT c_nationkey AS k FROM customer
INTERSECT SELECT s_nationkey AS k FROM supplier""")
def q_intersect_keys(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return workbook.in_both(customers, suppliers)


@query("sorted_list_per_group", """SELECT l_orderkey, string_agg(printf('%08d', l_partkey), ','
ORDER BY l_partkey) AS names FROM lineitem GROUP BY l_orderkey""")
def q_sorted_list_per_group(spark, sf_dir):
    """The part numbers of each order, sorted: a group that is bounded by what it is."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("part"))
    return workbook.sorted_names_per_group(li, "l_orderkey", "part")


@query("sorted_rows_per_group", """SELECT p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_name)
AS position, p_name FROM part""")
def q_sorted_rows_per_group(spark, sf_dir):
    """The sorted names of each part type, one row each: types of any size."""
    return workbook.sorted_name_rows(table(spark, sf_dir, "part"), "p_type", "p_name")


@query("high_value", """SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS value
FROM lineitem WHERE l_quantity * l_extendedprice >= 2000000""")
def q_high_value(spark, sf_dir):
    return workbook.high_value(table(spark, sf_dir, "lineitem"), "l_quantity",
                               "l_extendedprice", 2000000.0, ["l_orderkey", "l_linenumber"])


@query("revenue_by_category", """SELECT p_type,
CAST(round(SUM(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(14,2))), 2) AS DOUBLE)
AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def q_revenue_by_category(spark, sf_dir):
    return workbook.revenue_by_category(table(spark, sf_dir, "lineitem"),
                                        table(spark, sf_dir, "part"), "l_partkey", "p_partkey",
                                        "l_quantity", "l_extendedprice", "p_type")


MEAN_SQL = f"""SELECT l_returnflag, {_rounded_sql('SUM(l_quantity) / COUNT(l_quantity)')} AS mean
FROM lineitem GROUP BY l_returnflag"""


@query("mean_per_key", MEAN_SQL)
def q_mean_per_key(spark, sf_dir):
    return workbook.mean_per_key(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity")


@query("grouped_udf_mean", MEAN_SQL)
def q_grouped_udf_mean(spark, sf_dir):
    return workbook.mean_per_key_accumulated(table(spark, sf_dir, "lineitem"), "l_returnflag",
                                             "l_quantity")


@query("join_theta", """SELECT c_custkey, s_suppkey FROM customer JOIN supplier
ON c_acctbal BETWEEN s_acctbal - 50 AND s_acctbal + 50 AND c_nationkey <> s_nationkey""")
def q_join_theta(spark, sf_dir):
    """J11 for conditions that no equality helps: customers and suppliers of other nations with nearly the same balance.
    Only pairs of the same band of balances are tested, of which two in three match."""
    def near(c: str, s: str):
        return (F.col(f"{c}.c_acctbal").between(F.col(f"{s}.s_acctbal") - 50, F.col(f"{s}.s_acctbal") + 50)
                & (F.col(f"{c}.c_nationkey") != F.col(f"{s}.s_nationkey")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    band = (F.col("c_acctbal"), F.col("s_acctbal") - 50, F.col("s_acctbal") + 50, 50)
    return relational.theta_join(customers, suppliers, near, cells=64, band=band).select("c_custkey", "s_suppkey")


@query("join_broadcast_aggregate", """SELECT o_orderpriority, count(*) AS above FROM orders JOIN
(SELECT o_orderpriority AS p, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n FROM orders GROUP BY 1) AS m
ON o_orderpriority = p WHERE CAST(o_totalprice AS DECIMAL(18,2)) * n > total GROUP BY 1""")
def q_join_broadcast_aggregate(spark, sf_dir):
    """J8 with a side that is small only once it is computed: an estimate takes it for as large as all orders, so it
    is measured. Orders above the mean of their priority."""
    orders = table(spark, sf_dir, "orders")
    price = relational.exact_amount(F.col("o_totalprice"), digits=2, precision=18)
    means = orders.groupBy(F.col("o_orderpriority").alias("p")).agg(F.sum(price).alias("total"), F.count("*").alias("n"))
    joined = relational.join_keys(orders.select("o_orderpriority", price.alias("price")), means, "o_orderpriority", "p",
                                  strategy="broadcast", max_broadcast_bytes=16 << 10)
    return (joined.where(F.col("price") * F.col("n") > F.col("total")).groupBy("o_orderpriority")
            .agg(F.count("*").alias("above")))


@query("ordered_output", """SELECT c_custkey, c_name, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey)
AS position FROM customer""")
def q_ordered_output(spark, sf_dir):
    """O2 as output: customers by balance in many ordered CSV files, read back with their place in the order."""
    path = scratch_path(spark, "customers_ordered")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    write_ordered(rows, path, [("c_acctbal", False), ("c_custkey", True)], "csv")
    return read_ordered(spark, path, rows.schema, "csv")


@query("ordered_text_output", """SELECT doc_id, position FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id)
AS position FROM documents)""")
def q_ordered_text_output(spark, sf_dir):
    """Whole documents, the longest first, in ordered Parquet files."""
    path = scratch_path(spark, "documents_ordered")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    write_ordered(docs, path, [("n_chars", False), ("doc_id", True)])
    return read_ordered(spark, path, docs.schema).select("doc_id", "position")


@query("csv_to_parquet_checked", "SELECT doc_id, text, lang, n_chars FROM documents")
def q_csv_to_parquet_checked(spark, sf_dir):
    """QP17 with a check of its values (K5): whole documents as CSV, converted to Parquet, compared by fingerprints."""
    path = scratch_path(spark, "documents_csv")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars"), path)
    rows = read_csv(spark, path, "doc_id BIGINT, text STRING, lang STRING, n_chars BIGINT", multi_line=True)
    return convert_checked(rows, scratch_path(spark, "documents_parquet"))


JOIN_ROWS_SQL = """SELECT c_nationkey AS k, c_custkey, c_name, c_nationkey, n_nationkey, n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


@query("reduce_side_join", JOIN_ROWS_SQL)
def q_reduce_side_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return workbook.reduce_side_join(c, n, "c_nationkey", "n_nationkey", "k", nest=False)


@query("cogroup_udf_join", """SELECT c_custkey, c_name, c_nationkey, n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_cogroup_udf_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return streams.stream_cogroup(n, c, "n_nationkey", "c_nationkey", workbook.paired(
        ["c_custkey", "c_name", "c_nationkey"], ["n_name"]),
        "c_custkey bigint, c_name string, c_nationkey int, n_name string")


FUNNEL_SQL = """WITH paths AS (SELECT user_id, count(*) AS events,
string_agg(CASE event_type WHEN 'signup' THEN 's' WHEN 'error' THEN 'e' WHEN 'purchase' THEN 'p' ELSE '-' END, ''
ORDER BY ts, event_id) AS path FROM events GROUP BY user_id)
SELECT user_id, events, CAST(len(regexp_extract_all(path, 's-*p')) AS BIGINT) AS funnels,
CAST(coalesce(list_max(list_transform(regexp_extract_all(path, 's-*p'), lambda m: length(m))), 0) AS BIGINT) AS longest,
CAST(len(regexp_extract_all(path, 's-*e')) AS BIGINT) AS broken FROM paths"""


@query("funnels_per_user", FUNNEL_SQL)
def q_funnels_per_user(spark, sf_dir):
    """D-4: a state machine over each user's events in time order: a funnel opens at a signup and closes at
    the next purchase; an error breaks it, another signup starts it anew."""
    machine = workbook.funnel("event_type", "signup", "purchase", "error")
    return streams.stream_groups(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"),
                                 ["user_id"], machine, "user_id bigint, events bigint, funnels bigint, "
                                 "longest bigint, broken bigint", ["ts", "event_id"])


EXCHANGE_SQL = """WITH paths AS (SELECT conv_id, count(*) AS events,
string_agg(CASE role WHEN 'user' THEN 's' WHEN 'system' THEN 'e' WHEN 'assistant' THEN 'p' ELSE '-' END, ''
ORDER BY turn NULLS FIRST, role, text) AS path FROM conversations GROUP BY conv_id)
SELECT conv_id, events, CAST(len(regexp_extract_all(path, 's-*p')) AS BIGINT) AS funnels,
CAST(coalesce(list_max(list_transform(regexp_extract_all(path, 's-*p'), lambda m: length(m))), 0) AS BIGINT) AS longest,
CAST(len(regexp_extract_all(path, 's-*e')) AS BIGINT) AS broken FROM paths"""


@query("exchanges_per_conversation", EXCHANGE_SQL)
def q_exchanges_per_conversation(spark, sf_dir):
    """The same machine over the turns of conversations: questions that the assistant answers."""
    machine = workbook.funnel("role", "user", "assistant", "system")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return streams.stream_groups(turns, ["conv_id"], machine, "conv_id bigint, events bigint, funnels bigint, "
                                 "longest bigint, broken bigint", ["turn", "role", "text"])


QUANTILE_SQL = """SELECT l_returnflag, q, count(l_extendedprice) AS n, true AS within FROM lineitem,
(VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) AS wanted(q) GROUP BY l_returnflag, q"""


@query("quantiles_per_key", QUANTILE_SQL)
def q_quantiles_per_key(spark, sf_dir):
    """D-3 with a state that no built-in has: mergeable quantile summaries of prices, whose answers are then
    ranked in the whole table: ``within`` says whether the error that each summary states holds."""
    lines = table(spark, sf_dir, "lineitem")
    found = workbook.quantiles_per_key(lines, "l_returnflag", "l_extendedprice", [0.1, 0.5, 0.9], size=256)
    return workbook.ranked_quantiles(lines, "l_returnflag", "l_extendedprice", found).select(
        "l_returnflag", "q", "n", "within")


NESTED_SQL = """SELECT c_nationkey AS k, c_custkey, c_name, n_name AS other_name FROM customer
JOIN nation ON c_nationkey = n_nationkey"""


@query("reduce_side_join_nested", NESTED_SQL)
def q_reduce_side_join_nested(spark, sf_dir):
    """J6 in the shape (k, (left, right)); both sides name their columns ``id`` and ``name``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"),
                                                F.col("c_nationkey").alias("id"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    pairs = workbook.reduce_side_join(c, n, "id", "id", "k")
    return pairs.select("k", "left.c_custkey", F.col("left.name").alias("c_name"),
                        F.col("right.name").alias("other_name"))


# ---- join strategies (J8-J11) ---------------------------------------------------------------

JOIN_COUNT_SQL = """SELECT c_mktsegment, count(*) AS n FROM orders
JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""
STRATEGIES = [("broadcast", "broadcast"), ("merge", "merge"), ("shuffle_hash", "shuffle_hash"),
              ("shuffle_nl", "shuffle_replicate_nl"), ("auto", "auto")]


def _orders_per_segment(count, strategy: str):
    """All orders joined row by row to all customers under one strategy."""
    def run(spark, sf_dir):
        sides = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
        keys = "o_custkey", "c_custkey", "c_mktsegment", strategy
        return count(spark, *sides, *keys) if count is payroll.count_per_dimension_sql else count(*sides, *keys)
    return run


NATION_COUNT_SQL = """SELECT n_name, count(*) AS n FROM customer
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


@query("join_hint_sql", NATION_COUNT_SQL)
def q_join_hint_sql(spark, sf_dir):
    """J8 in SQL text: ``/*+ BROADCAST(d) */`` behind the size bound."""
    return payroll.count_per_dimension_sql(spark, table(spark, sf_dir, "customer"),
                                           table(spark, sf_dir, "nation"), "c_nationkey",
                                           "n_nationkey", "n_name", "broadcast")


def _customers_per_nation(spark, sf_dir):
    """The nested loop takes its cross join over the smallest table."""
    return payroll.count_per_dimension(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
                                       "c_nationkey", "n_nationkey", "n_name", "shuffle_replicate_nl")


def _customers_per_nation_sql(spark, sf_dir):
    return payroll.count_per_dimension_sql(spark, table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"),
                                           "c_nationkey", "n_nationkey", "n_name", "shuffle_replicate_nl")


for _name, _strategy in STRATEGIES:
    if _strategy == "shuffle_replicate_nl":
        query("join_shuffle_nl", NATION_COUNT_SQL)(_customers_per_nation)
        query("join_shuffle_nl_sql", NATION_COUNT_SQL)(_customers_per_nation_sql)
        continue
    query(f"join_{_name}", JOIN_COUNT_SQL)(_orders_per_segment(payroll.count_per_dimension, _strategy))
    if _strategy != "auto":
        query(f"join_{_name}_sql", JOIN_COUNT_SQL)(_orders_per_segment(payroll.count_per_dimension_sql, _strategy))


# ---- QP14 - QP16 --------------------------------------------------------------------------------

SHARE_SQL = """WITH t AS (
  SELECT CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'Morning'
              WHEN hour(ts) BETWEEN 12 AND 16 THEN 'Afternoon'
              WHEN hour(ts) BETWEEN 17 AND 20 THEN 'Evening'
              ELSE 'Night' END AS part,
         event_type = 'error' AS flag
  FROM events WHERE ts IS NOT NULL)
SELECT part, CAST(count_if(flag) AS BIGINT) AS flag_count, count(*) AS part_total,
       ((20000 * count_if(flag) + count(*)) // (2 * count(*))) / 100.0::DOUBLE AS pct
FROM t GROUP BY part"""


def _event_hour():
    """The hour as the city pipeline gets it: from ``HHMM`` clock text."""
    return hhmm_to_hour(clock_text("ts"))


@query("share_by_part_of_day", SHARE_SQL)
def q_share_by_part_of_day(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return city.share_by_part_of_day(ev, _event_hour(), F.col("event_type") == "error")


@query("share_by_part_of_day_udf", SHARE_SQL)
def q_share_by_part_of_day_udf(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return city.share_by_part_of_day(ev, _event_hour(), F.col("event_type") == "error",
                                     use_udf=True)


@query("share_by_part_of_day_csv", SHARE_SQL)
def q_share_by_part_of_day_csv(spark, sf_dir):
    """QP14 through the CSV path (S2/S3/S14): events written as a header CSV whose columns are
    all text (`TIME OCC` as HHMM, `Premis Desc`), read back as strings and cleaned."""
    path = scratch_path(spark, "events_csv")
    ev = table(spark, sf_dir, "events")
    write_csv(ev.select(F.col("event_id").alias("DR_NO"), clock_text("ts").alias("TIME OCC"),
                        F.col("event_type").alias("Premis Desc")), path, header=True)
    crime = read_header_csv_union(spark, [path])
    return city.share_by_part_of_day(crime, hhmm_to_hour("TIME OCC"),
                                     F.col("Premis Desc") == "error")


@query("share_by_format_switch", SHARE_SQL)
def q_share_by_format_switch(spark, sf_dir):
    """QP14 with the storage format as a switch (S14): the same logical table as CSV and as Parquet
    through ``load``; both give the same shares."""
    ev = table(spark, sf_dir, "events").select(clock_text("ts").alias("TIME OCC"), F.col("event_type").alias("Premis Desc"))
    paths = {fmt: scratch_path(spark, f"events_{fmt}") for fmt in ("csv", "parquet")}
    write_csv(ev, paths["csv"], header=True)
    write_parquet(ev, paths["parquet"])
    shares = [city.share_by_part_of_day(load(spark, path, fmt), hhmm_to_hour("TIME OCC"), F.col("Premis Desc") == "error")
              for fmt, path in paths.items()]
    return workbook.in_both(*shares)


DIRTY_HOUR_SQL = """WITH t AS (
  SELECT CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN NULL ELSE hour(ts) END AS h,
         event_type = 'error' AS flag FROM events),
p AS (
  SELECT CASE WHEN h BETWEEN 5 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 16 THEN 'Afternoon'
              WHEN h BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS part, flag
  FROM t WHERE h IS NOT NULL)
SELECT part, CAST(count_if(flag) AS BIGINT) AS flag_count, count(*) AS part_total,
       ((20000 * count_if(flag) + count(*)) // (2 * count(*))) / 100.0::DOUBLE AS pct
FROM p GROUP BY part"""


@query("share_dirty_hours", DIRTY_HOUR_SQL)
def q_share_dirty_hours(spark, sf_dir):
    """QP14 over clock texts of which some are null and some are junk: those rows are dropped."""
    text = F.when(F.col("event_id") % 7 == 0, F.lit(None)).when(F.col("event_id") % 11 == 0, "n/a").otherwise(clock_text("ts"))
    ev = table(spark, sf_dir, "events").select(text.alias("TIME OCC"), "event_type")
    return city.share_by_part_of_day(ev, hhmm_to_hour("TIME OCC"), F.col("event_type") == "error")


TOP_MONTHS_SQL = """SELECT year, month, n, rank FROM (
  SELECT year, month, n,
         CAST(row_number() OVER (PARTITION BY year ORDER BY n DESC, month) AS INTEGER) AS rank
  FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
        FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2) c) r
WHERE rank <= 3"""


@query("top_months_per_year", TOP_MONTHS_SQL)
def q_top_months_per_year(spark, sf_dir):
    return city.top_months_per_year(table(spark, sf_dir, "orders"), F.col("o_orderdate"), 3)


def _dates_as_text(spark, sf_dir):
    """Order dates as the city data carries them: text like ``2010 Feb 20 12:00:00 AM``."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", TEXT_TIMESTAMP_PATTERN).alias("DATE OCC"))


@query("sql_cte_view", TOP_MONTHS_SQL)
def q_sql_cte_view(spark, sf_dir):
    """QP15 as SQL text over a view whose date column is text named ``DATE OCC``."""
    return city.top_months_per_year_sql(spark, _dates_as_text(spark, sf_dir), "DATE OCC",
                                        TEXT_TIMESTAMP_PATTERN, 3)


@query("top_months_text", TOP_MONTHS_SQL)
def q_top_months_text(spark, sf_dir):
    """QP15 in DataFrame form over the same text dates (the DataFrame twin of sql_cte_view)."""
    return city.top_months_per_year(_dates_as_text(spark, sf_dir),
                                     parse_timestamp(F.col("DATE OCC")), 3)


PER_CAPITA_SQL = _rounded_sql("median_income * households / population")


@query("per_capita_ratio", """WITH p AS (
  SELECT c_nationkey AS zip, count(*) AS population,
         CAST(SUM(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END) AS BIGINT) AS households
  FROM customer GROUP BY c_nationkey),
i AS (SELECT s_nationkey AS zip, max(s_acctbal) AS median_income FROM supplier GROUP BY s_nationkey)
SELECT zip, population, households, median_income,
       {per_capita} AS per_capita_income
FROM p JOIN i USING (zip) WHERE population > 0""".replace("{per_capita}", PER_CAPITA_SQL))
def q_per_capita_ratio(spark, sf_dir):
    people = relational.sums_by(
        table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "zip"), ["zip"],
        {"population": F.lit(1),
         "households": F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1).otherwise(0)})
    income = (table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("zip"))
              .agg(F.max("s_acctbal").alias("median_income")))
    return city.per_capita(people, income)


@query("per_capita_zero_population", """WITH p AS (
  SELECT c_nationkey AS zip,
         CAST(SUM(CASE WHEN c_nationkey % 5 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS population,
         count(*) AS households
  FROM customer GROUP BY c_nationkey),
i AS (SELECT s_nationkey AS zip, min(s_acctbal) AS median_income FROM supplier GROUP BY s_nationkey)
SELECT zip, population, households, median_income, {per_capita} AS per_capita_income
FROM p JOIN i USING (zip) WHERE population > 0""".replace("{per_capita}", PER_CAPITA_SQL))
def q_per_capita_zero_population(spark, sf_dir):
    """QP16 with keys of no population (F5) and negative amounts."""
    people = relational.sums_by(
        table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "zip"), ["zip"],
        {"population": F.when(F.col("zip") % 5 == 0, 0).otherwise(1), "households": F.lit(1)})
    income = (table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("zip"))
              .agg(F.min("s_acctbal").alias("median_income")))
    return city.per_capita(people, income)


@query("per_capita_geojson", """WITH p AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS zip, count(*) AS population,
         CAST(SUM(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END) AS BIGINT) AS households
  FROM customer GROUP BY c_nationkey),
i AS (SELECT CAST(s_nationkey AS VARCHAR) AS zip,
             CAST(floor(max(s_acctbal)) AS DOUBLE) AS median_income
      FROM supplier GROUP BY s_nationkey HAVING floor(max(s_acctbal)) >= 0)
SELECT zip, population, households, median_income,
       {per_capita} AS per_capita_income
FROM p JOIN i USING (zip) WHERE population > 0""".replace("{per_capita}", PER_CAPITA_SQL))
def q_per_capita_geojson(spark, sf_dir):
    """QP16 end to end on files derived from the tables: customers as GeoJSON census features
    (ZIP = nation, one person each, a household when in the HOUSEHOLD segment), and the top
    supplier balance per nation as `;`-separated money text (``$52,806``; negative amounts do
    not fit the money pattern and are dropped), joined per ZIP."""
    blocks_path = scratch_path(spark, "blocks_geojson")
    c = table(spark, sf_dir, "customer")
    blocks = c.select(
        F.col("c_nationkey").cast("string").alias("ZCTA20"), F.lit(1).cast("long").alias("POP20"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1).otherwise(0).cast("long")
        .alias("HOUSING20"), "c_acctbal", "c_nationkey")
    point = F.struct(F.lit("Point").alias("type"),
                     F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double"))
                     .alias("coordinates"))
    write_collections(blocks, blocks_path, ["ZCTA20", "POP20", "HOUSING20"], point)
    props = T.StructType([T.StructField("HOUSING20", T.LongType()),
                          T.StructField("POP20", T.LongType()),
                          T.StructField("ZCTA20", T.StringType())])
    people = city.population_by_zip(flatten_properties(read_features(spark, blocks_path, props)))

    income_path = scratch_path(spark, "income_csv")
    top = (table(spark, sf_dir, "supplier").groupBy("s_nationkey")
           .agg(F.max("s_acctbal").alias("m")))
    write_csv(top.select(F.col("s_nationkey").cast("string").alias("Zip Code"),
                         F.lit("n/a").alias("Community"),
                         F.concat(F.lit("$"), F.format_number(F.floor("m"), 0))
                         .alias("Estimated Median Income")),
              income_path, header=True, sep=";")
    income = city.income_by_zip(read_csv_strings(spark, income_path, sep=";"))
    return city.per_capita(people, income)


# ---- scalar functions -----------------------------------------------------------------------

UNION_NAMES_SQL = """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nk, c_acctbal AS bal,
c_mktsegment AS seg FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier"""


@query("union_by_name", UNION_NAMES_SQL)
def q_union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nk"), F.col("c_acctbal").alias("bal"),
        F.col("c_mktsegment").alias("seg"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nk"), F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return setops.union_by_name([c, s])


@query("regex_number", r"""SELECT p_partkey,
TRY_CAST(regexp_extract(p_brand, '^Brand#(\d+)$', 1) AS INTEGER) AS brand_no FROM part""")
def q_regex_number(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey",
                    F.regexp_extract("p_brand", r"^Brand#(\d+)$", 1).try_cast("int")
                    .alias("brand_no"))


@query("parse_timestamp", """SELECT o_orderkey,
try_strptime(strftime(o_orderdate, '%Y %b %d %I:%M:%S %p'), '%Y %b %d %I:%M:%S %p') AS ts
FROM orders""")
def q_parse_timestamp(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", TEXT_TIMESTAMP_PATTERN)
    return relational.drop_unparsed(o.select("o_orderkey", parse_timestamp(text).alias("ts")),
                                    "ts")


@query("nested_field", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""")
def q_nested_field(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


@query("explode_count", """SELECT label, count(*) AS n
FROM (SELECT label, unnest(embedding) AS x FROM embeddings) t GROUP BY label""")
def q_explode_count(spark, sf_dir):
    em = table(spark, sf_dir, "embeddings")
    return relational.count_by(em.select("label", F.explode("embedding").alias("x")),
                               ["label"], "n")


@query("hhmm_hour", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events")
def q_hhmm_hour(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", hhmm_to_hour(clock_text("ts")).alias("hour"))


@query("safe_int", """SELECT p_partkey,
coalesce(TRY_CAST(trim(p_type) AS BIGINT), 0)
  + coalesce(TRY_CAST(trim(CAST(p_size AS VARCHAR)) AS BIGINT), 0) AS safe_total FROM part""")
def q_safe_int(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", (safe_long("p_type") + safe_long("p_size")).alias("safe_total"))


@query("money_text", """SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) AS income
FROM orders WHERE o_orderstatus <> 'P'""")
def q_money_text(spark, sf_dir):
    """Money text such as `` $112,946`` (orders in status P carry ``---``) cleaned to double."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("---")).otherwise(
        F.concat(F.lit(" $"), F.format_number(F.floor("o_totalprice"), 0)))
    return relational.drop_unparsed(o.select("o_orderkey", money_to_double(text).alias("income")),
                                    "income")


@query("fixed_text", "SELECT printf('%d,%.2f', o_orderkey, o_totalprice) AS line FROM orders")
def q_fixed_text(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(fixed_text("%d,%.2f", "o_orderkey", "o_totalprice").alias("line"))


# ---- sources and sinks (write with Spark, read back) ---------------------------------------

@query("formatted_lines", "SELECT printf('%d,%.2f', o_orderkey, o_totalprice) AS value FROM orders")
def q_formatted_lines(spark, sf_dir):
    """Formatted lines written as text and read back (K4 + S11)."""
    path = scratch_path(spark, "orders_formatted")
    write_text(format_lines(table(spark, sf_dir, "orders"), "%d,%.2f", ["o_orderkey", "o_totalprice"]), path)
    return read_lines(spark, path)


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def q_row_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"), "n")


@query("read_back_count", "SELECT count(*) AS n FROM part")
def q_read_back_count(spark, sf_dir):
    """QP17's count (K5): parts written as header CSV, converted to Parquet, counted from there."""
    src, out = scratch_path(spark, "part_csv"), scratch_path(spark, "part_parquet")
    write_csv(table(spark, sf_dir, "part"), src, header=True)
    n = city.convert_to_parquet(spark, [src], out)
    return row_count(read_parquet(spark, out), "n").where(F.col("n") == n)


@query("csv_text_round_trip", "SELECT doc_id, text, lang, CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END AS source FROM documents")
def q_csv_text_round_trip(spark, sf_dir):
    """Whole texts -- quotes, commas, blanks at the ends, line breaks, empty texts -- through CSV."""
    path = scratch_path(spark, "documents_csv")
    source = F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("source"))
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", source.alias("source")), path)
    return read_csv(spark, path, "doc_id BIGINT, text STRING, lang STRING, source STRING", multi_line=True)


@query("header_csv_union", UNION_NAMES_SQL)
def q_header_csv_union(spark, sf_dir):
    """Two header CSV files with drifting headers (one name carries a trailing blank, one file
    lacks a column), read as strings, names trimmed, unioned by name, then typed."""
    a, b = scratch_path(spark, "customers_csv"), scratch_path(spark, "suppliers_csv")
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nk "), F.col("c_acctbal").alias("bal"),
        F.col("c_mktsegment").alias("seg"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nk"), F.col("s_acctbal").alias("bal"))
    write_csv(c, a, header=True)
    write_csv(s, b, header=True)
    u = read_header_csv_union(spark, [a, b])
    return u.select(F.col("id").try_cast("bigint").alias("id"), "name",
                    F.col("nk").try_cast("int").alias("nk"),
                    F.col("bal").try_cast("double").alias("bal"), "seg")


@query("delimited_csv", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def q_delimited_csv(spark, sf_dir):
    """A `;`-separated header CSV (S4) read as strings and typed with ``try_cast``."""
    path = scratch_path(spark, "orders_semicolon")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    write_csv(o, path, header=True, sep=";")
    raw = read_csv_strings(spark, path, sep=";")
    return raw.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                      F.col("o_custkey").try_cast("bigint").alias("o_custkey"),
                      "o_orderpriority",
                      F.col("o_totalprice").try_cast("double").alias("o_totalprice"))


@query("line_split", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderstatus <> 'P'""")
def q_line_split(spark, sf_dir):
    """Comma lines with a header line; orders in status P are written short (two fields) and
    must be dropped by the short-row guard."""
    path = scratch_path(spark, "orders_lines")
    o = table(spark, sf_dir, "orders")
    header = "o_orderkey,o_custkey,o_orderstatus"
    body = join_lines(o, ["o_orderkey", "o_custkey",
                          F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))])
    body = body.select(F.regexp_replace("value", ",$", "").alias("value"))
    lines = body.union(spark.range(1).select(F.lit(header).alias("value")))
    write_text(lines, path)
    return parse_lines(drop_header_line(read_lines(spark, path), header), ",",
                       [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                        ("o_orderstatus", "string")], min_fields=3)


@query("drop_malformed", """SELECT o_orderkey, o_orderpriority || ', "' || o_orderstatus || '"'
AS o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus <> 'P'""")
def q_drop_malformed(spark, sf_dir):
    """Quoted CSV whose text field holds a comma and doubled quotes, a header line in every file,
    columns picked by header name; orders in status P are written as broken lines (a non-numeric
    key, a missing field) and must be dropped."""
    path = scratch_path(spark, "orders_quoted")
    o = table(spark, sf_dir, "orders")
    good = F.concat(F.col("o_orderkey").cast("string"), F.lit(',"'), F.col("o_orderpriority"),
                    F.lit(', ""'), F.col("o_orderstatus"), F.lit('""",'),
                    F.col("o_totalprice").cast("string"))
    broken = F.concat(F.lit("broken,"), F.col("o_orderkey").cast("string"))
    lines = o.select(F.when(F.col("o_orderstatus") == "P", broken).otherwise(good)
                     .alias("value"))
    write_raw_lines(lines, path, "o_orderkey,o_orderpriority,o_totalprice")
    return read_csv_checked(spark, path, {"o_orderkey": "BIGINT", "o_totalprice": "DOUBLE"},
                            columns=["o_totalprice", "o_orderkey", "o_orderpriority"])


GEOJSON_SQL = """SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'Point' AS geometry_type FROM customer"""
GEOJSON_PROPERTIES = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE"


def _customers_as_features(write, layout: str):
    """Customers written as GeoJSON (point geometry), read back with an explicit schema, one row per
    feature, flattened by the property names of the schema."""
    def run(spark, sf_dir):
        path = scratch_path(spark, "customers_geojson")
        properties = T.StructType.fromDDL(GEOJSON_PROPERTIES)
        point = F.struct(F.lit("Point").alias("type"),
                         F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double")).alias("coordinates"))
        write(table(spark, sf_dir, "customer"), path, properties.fieldNames(), point)
        flat = flatten_properties(read_features(spark, path, properties, layout=layout))
        return flat.select(*properties.fieldNames(), F.col("geometry.type").alias("geometry_type"))
    return run


query("geojson_documents", GEOJSON_SQL)(_customers_as_features(write_documents, "document"))
query("geojson_flatten", GEOJSON_SQL)(_customers_as_features(write_collections, "document_per_line"))
query("geojson_feature_lines", GEOJSON_SQL)(_customers_as_features(write_feature_lines, "feature_per_line"))
query("geojson_one_line_documents", GEOJSON_SQL)(_customers_as_features(write_collections, "feature_per_line"))


LINEITEM_SCHEMA = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                   "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                   "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ")


@query("csv_round_trip", "SELECT * FROM lineitem")
def q_csv_round_trip(spark, sf_dir):
    """Headerless CSV written by Spark, read back with the fixed schema (K2 + S1)."""
    path = scratch_path(spark, "lineitem_csv")
    write_csv(table(spark, sf_dir, "lineitem"), path)
    return read_csv(spark, path, LINEITEM_SCHEMA)


@query("parquet_round_trip", "SELECT * FROM lineitem")
def q_parquet_round_trip(spark, sf_dir):
    """Parquet written by Spark and read back (K1 + S10): schema and rows come back intact."""
    path = scratch_path(spark, "lineitem_parquet")
    write_parquet(table(spark, sf_dir, "lineitem"), path)
    return read_parquet(spark, path)


@query("csv_to_parquet", "SELECT * FROM lineitem")
def q_csv_to_parquet(spark, sf_dir):
    """QP17: header CSV (all strings) -> names trimmed -> union by name -> typed once -> Parquet, read
    back. The count comes back in ``read_back_count``."""
    src, out = scratch_path(spark, "lineitem_header_csv"), scratch_path(spark, "lineitem_pq")
    write_csv(table(spark, sf_dir, "lineitem"), src, header=True)
    types = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(LINEITEM_SCHEMA).fields}
    city.convert_to_parquet(spark, [src], out, types=types)
    return read_parquet(spark, out)
