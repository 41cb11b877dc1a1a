"""Window functions (survey 2.5)."""

from pyspark.sql import DataFrame, functions as F

from rowloom.operators import joins, windows
from rowloom.plans.aggregates import with_year
from rowloom.plans.registry import Tables, query
from rowloom.sources.tables import sql_over

DAILY_SQL = """(SELECT event_type, CAST(ts AS DATE) AS on_day, count(*) AS n FROM events GROUP BY ALL)"""
# Every third day of the month is treated as not reported.
THINNED_SQL = f"""(SELECT event_type, on_day, CASE WHEN day(on_day) % 3 = 0 THEN NULL ELSE n END AS n FROM {DAILY_SQL})"""
YEARLY_SQL = """(SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderpriority, count(*) AS n
                 FROM orders GROUP BY ALL)"""


def daily(t: Tables) -> DataFrame:
    return (t.events.groupBy("event_type", F.to_date("ts").alias("on_day"))
            .agg(F.count(F.lit(1)).alias("n")))


def thinned(t: Tables) -> DataFrame:
    return daily(t).withColumn("n", F.when(F.dayofmonth("on_day") % 3 != 0, F.col("n")))


def yearly(t: Tables) -> DataFrame:
    return with_year(t).groupBy("order_year", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, o_custkey, o_totalprice,
                 round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS customer_total FROM orders""")
def window_total(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return (windows.partition_totals(orders, ["o_custkey"], "o_totalprice", total="customer_total")
            .withColumn("customer_total", F.round("customer_total", 2)))


@query(f"""SELECT *, CAST(round(CAST(n * 100.0 / sum(n) OVER (PARTITION BY order_year) AS DECIMAL(28, 10)), 2)
                          AS DOUBLE) AS pct FROM {YEARLY_SQL}""")
def window_share(t: Tables) -> DataFrame:
    return windows.partition_share(yearly(t), ["order_year"], "n", "pct", max_rows=None)


@query("""SELECT o_orderkey, o_orderpriority, o_totalprice,
                 round(avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS mean_price,
                 max(o_totalprice) OVER (PARTITION BY o_orderpriority) AS max_price FROM orders""")
def window_mean_max(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return (windows.partition_totals(orders, ["o_orderpriority"], "o_totalprice", mean="mean_price",
                                     highest="max_price")
            .withColumn("mean_price", F.round("mean_price", 4)))


@query("""SELECT l_returnflag, l_orderkey, l_partkey, l_quantity, place FROM (
            SELECT *, CAST(rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS INTEGER) AS place
            FROM lineitem) WHERE place <= 3""")
def window_rank_topn(t: Tables) -> DataFrame:
    """Very many lines tie on the highest quantity; all are kept."""
    lines = t.lineitem.select("l_returnflag", "l_orderkey", "l_partkey", "l_quantity")
    return windows.top_ranked(lines, ["l_returnflag"], "l_quantity", 3, "place")


@query("""SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS order_day,
                 row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS row_number,
                 rank() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC) AS rank,
                 dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC) AS dense_rank
          FROM orders""")
def window_rank_compare(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("order_day"))
    return windows.ranked(orders, ["o_orderpriority"], "order_day", "o_orderkey")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
                 row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_number FROM orders""")
def global_row_number(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    return windows.global_row_number(orders, "order_day", "o_orderkey")


@query(f"""SELECT *, lag(n) OVER w AS n_before, lead(n) OVER w AS n_after FROM {DAILY_SQL}
           WINDOW w AS (PARTITION BY event_type ORDER BY on_day)""")
def window_lag_lead(t: Tables) -> DataFrame:
    return windows.lag_lead(daily(t), ["event_type"], "on_day", "on_day", "n", "n_before", "n_after", max_rows=None)


@query("""SELECT event_id, user_id, value, lag(value, 1, 0.0) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                 AS value_before FROM events""")
def window_lag_default(t: Tables) -> DataFrame:
    """Raw events per user, 0 before a user's first one."""
    return (windows.lag_lead(t.events, ["user_id"], "ts", "event_id", "value", "value_before", default=0.0)
            .select("event_id", "user_id", "value", "value_before"))


@query("""WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS on_day, count(*) AS n FROM events GROUP BY ALL),
               days AS (SELECT user_id, CAST(unnest(generate_series(min(on_day), max(on_day), INTERVAL 1 DAY)) AS DATE) AS on_day
                        FROM daily GROUP BY user_id)
          SELECT user_id, on_day, coalesce(n, 0) AS n, lag(coalesce(n, 0)) OVER (PARTITION BY user_id ORDER BY on_day) AS n_before
          FROM days LEFT JOIN daily USING (user_id, on_day)""")
def lag_dense(t: Tables) -> DataFrame:
    """Missing days count 0, so lag means the day before and not the row before."""
    daily_users = t.events.groupBy("user_id", F.to_date("ts").alias("on_day")).agg(F.count(F.lit(1)).alias("n"))
    days = joins.densify(daily_users, ["user_id"], "on_day", ["n"], step=F.expr("INTERVAL 1 DAY"))
    return windows.lag_lead(days, ["user_id"], "on_day", "on_day", "n", "n_before", max_rows=None)


@query("""SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(n AS INTEGER) AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n
            FROM orders) WHERE n <= 3""")
def topk_per_group(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return windows.top_per_group(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3, "place")


@query("""SELECT event_type, event_id, value, n AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id) AS n
            FROM events) WHERE n <= 1500""")
def topk_by_value(t: Tables) -> DataFrame:
    """More rows per key than Spark limits before the shuffle."""
    return windows.top_by_value(t.events.select("event_type", "event_id", "value"), ["event_type"], "value", "event_id", 1_500, "place")


@query(f"""SELECT *, last_value(n IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_forward,
                  first_value(n IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n_backward
           FROM {THINNED_SQL} WINDOW w AS (PARTITION BY event_type ORDER BY on_day)""")
def fill_forward_backward(t: Tables) -> DataFrame:
    return windows.fill_gaps(thinned(t), ["event_type"], "on_day", None, "n", "n_forward", "n_backward", max_rows=None)


@query(f"""SELECT event_type, on_day, n, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS imputed,
                  round(CASE WHEN n IS NOT NULL THEN n ELSE y1 + (y2 - y1) / (x2 - x1) * (x - x1) END, 6) AS filled
           FROM (SELECT *, last_value(CASE WHEN n IS NOT NULL THEN x END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x1,
                        first_value(CASE WHEN n IS NOT NULL THEN x END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x2,
                        CAST(last_value(n IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS y1,
                        CAST(first_value(n IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS y2
                 FROM (SELECT *, epoch(on_day) AS x FROM {THINNED_SQL}) WINDOW w AS (PARTITION BY event_type ORDER BY on_day))""")
def interpolate_linear(t: Tables) -> DataFrame:
    filled = windows.interpolate(thinned(t), ["event_type"], "on_day", "n", max_rows=None)
    return filled.withColumn("filled", F.round("filled", 6))


@query("""WITH placed AS (SELECT c_custkey, c_nationkey, c_acctbal,
                 row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place,
                 lead(c_acctbal) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS below FROM customer)
          SELECT c_custkey, c_nationkey, c_acctbal, CASE WHEN place = 1 THEN c_acctbal - below ELSE 0.0 END AS top_two_gap,
                 CASE WHEN place = 1 AND c_acctbal - below > 50 THEN 1 ELSE 0 END AS gap_flag FROM placed""")
def top_two_gap_flag(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return windows.top_two_gap(customers, ["c_nationkey"], "c_acctbal", "c_custkey", 50.0)


@query(f"SELECT *, CAST(sum(n) OVER (PARTITION BY order_year) AS BIGINT) AS year_total FROM {YEARLY_SQL}")
def window_sql(t: Tables) -> DataFrame:
    """The window runs over counts, a handful per year, not over orders."""
    return sql_over("SELECT *, sum(n) OVER (PARTITION BY order_year) AS year_total FROM {counts}", counts=yearly(t))
