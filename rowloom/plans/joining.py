"""Joins (survey 2.3)."""

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.operators import joins
from rowloom.plans.registry import Tables, query
from rowloom.sources.generators import skew_lookup, skewed_key

SKEWED_SQL = """(SELECT event_id, CASE WHEN event_id < 1 THEN 'A' WHEN event_id < 10 THEN 'B'
    WHEN event_id < 100 THEN 'C' WHEN event_id < 1000 THEN 'D' ELSE 'E' END AS skew_key FROM events)"""
LOOKUP_SQL = "(VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) AS lookup(skew_key, key_value)"
SKEW_JOIN_SQL = f"SELECT event_id, skew_key, key_value FROM {SKEWED_SQL} LEFT JOIN {LOOKUP_SQL} USING (skew_key)"

SALTS = 32  # for keys that one task can't hold; more than the hottest key needs costs copies of the right side


def skewed_events(t: Tables) -> DataFrame:
    """Events with a key that is E for most of them."""
    return t.events.select("event_id", skewed_key("event_id", scale=0.01).alias("skew_key"))


def mean_amount(column: str) -> Column:
    """Mean of money amounts; the sum is rounded to cents, so the order of adding cannot show."""
    return F.round(F.sum(column), 2) / F.count(F.lit(1))


def lines_on(t: Tables, name: str) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias(name), "l_partkey", "l_quantity")


@query("""SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
          LEFT JOIN orders ON c_custkey = o_custkey""")
def join_left(t: Tables) -> DataFrame:
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return t.customer.join(orders, "c_custkey", "left").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_custkey", "c_mktsegment")


LINES_SQL = """SELECT o_orderkey, l_partkey, l_quantity, o_orderpriority
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query(LINES_SQL)
def join_sort_merge(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return joins.sort_merge_join(lines_on(t, "o_orderkey"), orders, ["o_orderkey"])


@query(LINES_SQL)
def join_shuffle_hash(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return joins.shuffle_hash_join(lines_on(t, "o_orderkey"), orders, ["o_orderkey"])


NATION_SQL = """SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders
                JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


def _orders_by_nationkey(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("n_nationkey"), "o_totalprice")


def _nation_totals(joined: DataFrame) -> DataFrame:
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"),
                                        F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(NATION_SQL)
def join_broadcast(t: Tables) -> DataFrame:
    """Nations are measured before they are broadcast."""
    nations = t.nation.select("n_nationkey", "n_name")
    return _nation_totals(joins.broadcast_join(_orders_by_nationkey(t), nations, ["n_nationkey"]))


@query(NATION_SQL)
def join_auto_broadcast(t: Tables) -> DataFrame:
    """No hint: Spark broadcasts what its own size check allows."""
    return _nation_totals(_orders_by_nationkey(t).join(t.nation, "n_nationkey"))


@query("""WITH totals AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
                                 round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL),
               years AS (SELECT o_custkey, unnest(range(min(order_year), max(order_year) + 1)) AS order_year
                         FROM totals GROUP BY o_custkey)
          SELECT o_custkey, CAST(order_year AS INTEGER) AS order_year, coalesce(total, 0.0) AS total
          FROM years LEFT JOIN totals USING (o_custkey, order_year)""")
def densify(t: Tables) -> DataFrame:
    """Every customer's years from the first to the last order, with 0 where there was none."""
    totals = (t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("order_year"))
              .agg(F.round(F.sum("o_totalprice"), 2).alias("total")))
    return joins.densify(totals, ["o_custkey"], "order_year", ["total"], fill=0.0)


@query("""SELECT l_suppkey, n_left, n_right, n_left * n_right AS n_joined
          FROM (SELECT l_suppkey, count(*) AS n_left FROM lineitem GROUP BY 1)
          JOIN (SELECT s_suppkey AS l_suppkey, count(*) AS n_right FROM supplier GROUP BY 1) USING (l_suppkey)""")
def join_fanout(t: Tables) -> DataFrame:
    return joins.fanout(t.lineitem, t.supplier.withColumnRenamed("s_suppkey", "l_suppkey"), ["l_suppkey"])


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'fast' WHEN '2-HIGH' THEN 'fast'
                 WHEN '3-MEDIUM' THEN 'normal' WHEN '5-LOW' THEN 'slow' END AS lane FROM orders""")
def lookup_as_case(t: Tables) -> DataFrame:
    lanes = {"1-URGENT": "fast", "2-HIGH": "fast", "3-MEDIUM": "normal", "5-LOW": "slow"}
    return joins.lookup_case(t.orders, "o_orderpriority", lanes, "lane").select("o_orderkey", "lane")


@query(SKEW_JOIN_SQL)
def join_salted(t: Tables) -> DataFrame:
    return joins.salted_join(skewed_events(t), skew_lookup(t.spark), ["skew_key"], salts=SALTS)


@query("""SELECT s_suppkey, s_name, count(*) AS n_lines FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
          GROUP BY s_suppkey, s_name""")
def join_salted_supplier(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_partkey", "l_linenumber")
    joined = joins.salted_join(lines, t.supplier.select("s_suppkey", "s_name"), ["s_suppkey"], SALTS, "inner")
    return joined.groupBy("s_suppkey", "s_name").agg(F.count(F.lit(1)).alias("n_lines"))


@query(SKEW_JOIN_SQL)
def join_salted_hot(t: Tables) -> DataFrame:
    """Only the key known to be hot is salted."""
    return joins.salted_join(skewed_events(t), skew_lookup(t.spark), ["skew_key"], salts=SALTS, hot=["E"])


@query(SKEW_JOIN_SQL)
def join_skew_auto(t: Tables) -> DataFrame:
    """Hot keys are found from the counts."""
    return joins.skew_join(skewed_events(t), skew_lookup(t.spark), ["skew_key"], "left")


@query(SKEW_JOIN_SQL)
def join_split_hot(t: Tables) -> DataFrame:
    return joins.split_hot_join(skewed_events(t), skew_lookup(t.spark), "skew_key", ["E"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2)
                 / count(*) OVER (PARTITION BY o_custkey) AS mean_price, count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders""")
def agg_join_back(t: Tables) -> DataFrame:
    """The explicit form; ``window_total`` chooses between this and a window."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    table = orders.groupBy("o_custkey").agg(mean_amount("o_totalprice").alias("mean_price"),
                                            F.count(F.lit(1)).alias("n_orders"))
    return joins.join_back(orders, table, ["o_custkey"], ["mean_price", "n_orders"])
