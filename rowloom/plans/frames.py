"""Set operations and frame comparison (survey 2.7), data quality (2.13)."""

from pyspark.sql import DataFrame, functions as F

from rowloom.operators import quality, setops
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path
from rowloom.sources import files


@query("""SELECT o_orderkey, o_totalprice FROM orders
          UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem""")
def union_all(t: Tables) -> DataFrame:
    return setops.union_all([t.orders.select("o_orderkey", "o_totalprice"),
                             t.lineitem.select("l_orderkey", "l_extendedprice")])


@query("""SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier_id
          FROM customer
          UNION ALL SELECT s_name, s_acctbal, NULL, s_suppkey FROM supplier
          UNION ALL SELECT n_name, NULL, NULL, NULL FROM nation""")
def union_missing_columns(t: Tables) -> DataFrame:
    """Three frames; each lacks columns, one has them in another order."""
    return setops.union_by_name([
        t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                          F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_acctbal").alias("balance"),
                          F.col("s_name").alias("name")),
        t.nation.select(F.col("n_name").alias("name"))])


@query("SELECT o_custkey AS person FROM orders UNION SELECT user_id FROM events")
def union_distinct(t: Tables) -> DataFrame:
    return setops.union_distinct([t.orders.select(F.col("o_custkey").alias("person")), t.events.select("user_id")])


@query("""SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'A' EXCEPT ALL
          SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A'""")
def except_all(t: Tables) -> DataFrame:
    """Many exact copies on both sides; as many are left over as there are more."""
    pair, lines = ["l_suppkey", "l_linenumber"], t.lineitem
    return setops.except_all(lines.filter(F.col("l_returnflag") != "A").select(pair),
                             lines.filter(F.col("l_returnflag") == "A").select(pair))


@query("""WITH before AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders),
               after AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END
                                AS o_totalprice, o_orderstatus FROM orders)
          SELECT *, 'left' AS side FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after)
          UNION ALL SELECT *, 'right' AS side FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before)""")
def frame_diff(t: Tables) -> DataFrame:
    before = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    raised = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return setops.frame_diff(before, before.withColumn("o_totalprice", raised))


@query("""SELECT 'c_custkey' AS "column", count(*) AS n_rows, CAST(0 AS BIGINT) AS n_null,
                 count(DISTINCT c_custkey) AS n_distinct, CAST(min(c_custkey) AS VARCHAR) AS lowest,
                 CAST(max(c_custkey) AS VARCHAR) AS highest, CAST(NULL AS DOUBLE) AS pass_pct FROM customer
          UNION ALL
          SELECT 'credit', count(*), count(*) FILTER (WHERE c_acctbal < 0), count(DISTINCT c_acctbal) FILTER (WHERE c_acctbal >= 0),
                 CAST(min(c_acctbal) FILTER (WHERE c_acctbal >= 0) AS VARCHAR), CAST(max(c_acctbal) AS VARCHAR),
                 count(*) FILTER (WHERE c_acctbal >= 5000) * 100.0 / count(*) FILTER (WHERE c_acctbal >= 0) FROM customer
          UNION ALL
          SELECT 'c_mktsegment', count(*), 0, count(DISTINCT c_mktsegment), min(c_mktsegment), max(c_mktsegment),
                 count(*) FILTER (WHERE length(c_mktsegment) > 8) * 100.0 / count(*) FROM customer""")
def dq_profile(t: Tables) -> DataFrame:
    customers = t.customer.withColumn("credit", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return quality.dq_profile(customers, ["c_custkey", "credit", "c_mktsegment"], {
        "credit": F.col("credit") >= 5_000, "c_mktsegment": F.length("c_mktsegment") > 8})


@query("""SELECT o_orderkey AS order_id, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS order_day,
                 o_totalprice AS price, CAST(year(o_orderdate) - 1994 AS INTEGER) AS years,
                 o_totalprice / (year(o_orderdate) - 1994) AS price_per_year
          FROM orders""")
def clean_table(t: Tables) -> DataFrame:
    """A raw CSV of orders with text dates, cleaned; no order lacks a date or a ratio."""
    path = scratch_path(t.spark, "orders_raw")
    files.write_csv(t.orders.withColumn("years", F.year("o_orderdate") - 1994)
                    .withColumn("o_orderdate", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")), path)
    raw = files.read_csv(t.spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                        "o_orderdate string, o_orderpriority string, years int")
    return quality.clean_table(
        raw, drop=["o_custkey", "o_orderstatus"],
        names={"o_orderkey": "order_id", "o_orderpriority": "priority", "o_orderdate": "order_day",
               "o_totalprice": "price"},
        date_column="order_day", date_format="dd/MM/yyyy HH:mm", ratio=("price", "years", "price_per_year"),
        required=["order_day", "price_per_year"])
