"""The query behind ``entry``: revenue by nation and year."""

from pyspark.sql import DataFrame, functions as F

from rowloom.operators.ordering import top_n
from rowloom.operators.shape import ratio
from rowloom.operators.windows import partition_share
from rowloom.plans.registry import Tables, query


@query("""
    WITH revenue AS (
        SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_lines,
               round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT n_name, order_year, n_lines, revenue, revenue / n_lines AS revenue_per_line,
           CAST(round(CAST(revenue * 100.0 / sum(revenue) OVER (PARTITION BY order_year) AS DECIMAL(28, 10)), 2)
                AS DOUBLE) AS pct_of_year
    FROM revenue ORDER BY revenue DESC, n_name, order_year LIMIT 10""")
def revenue_by_nation_year(t: Tables) -> DataFrame:
    """Top ten nations and years by revenue, with their share of the year.

    Line prices are summed per order before the other joins, so customers and
    nations meet one row per order.  A year has one row per nation by then, so
    the share is a plain window.
    """
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("order_revenue"),
        F.count(F.lit(1)).alias("order_lines"))
    orders = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    revenue = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
               .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
               .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
               .groupBy("n_name", "order_year")
               .agg(F.sum("order_lines").alias("n_lines"), F.round(F.sum("order_revenue"), 2).alias("revenue")))
    shared = partition_share(ratio(revenue, "revenue", "n_lines", "revenue_per_line"),
                             ["order_year"], "revenue", "pct_of_year", max_rows=None)
    return top_n(shared, ["-revenue", "n_name", "order_year"], 10)
