"""Aggregations, pivots, association and quantiles (survey 2.4)."""

from pyspark.sql import DataFrame, functions as F

from rowloom.operators import aggregate
from rowloom.operators.ordering import top_n
from rowloom.operators.windows import partition_totals
from rowloom.plans.joining import mean_amount
from rowloom.plans.projections import CUSTOMER_ORDERS_SQL, customer_orders
from rowloom.plans.registry import Tables, query

YEARS = list(range(1995, 2002))


def with_year(t: Tables) -> DataFrame:
    return t.orders.withColumn("order_year", F.year("o_orderdate"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(t: Tables) -> DataFrame:
    return aggregate.group_count(t.events, ["event_type"])


@query("""SELECT o_custkey, round(sum(o_totalprice), 2) / count(*) AS mean_price FROM orders GROUP BY o_custkey
          ORDER BY mean_price DESC, o_custkey LIMIT 10""")
def group_mean_topn(t: Tables) -> DataFrame:
    means = t.orders.groupBy("o_custkey").agg(mean_amount("o_totalprice").alias("mean_price"))
    return top_n(means, ["-mean_price", "o_custkey"], 10)


@query("""SELECT l_returnflag, l_linestatus, min(l_extendedprice) AS lowest, round(avg(l_extendedprice), 4) AS average,
                 max(l_extendedprice) AS highest, count(*) AS n FROM lineitem
          GROUP BY ALL""")
def group_summary(t: Tables) -> DataFrame:
    return (aggregate.group_summary(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")
            .withColumn("average", F.round("average", 4)))


@query("SELECT round(sum(l_extendedprice), 2) AS total, count(*) AS n FROM lineitem")
def global_sum(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.round(F.sum("l_extendedprice"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_suppkey")
def group_sum(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("""SELECT upper(event_type[1]) || lower(event_type[2:]) AS event_type, CAST(ts AS DATE) AS on_day,
                 count(*) AS n FROM events GROUP BY ALL""")
def group_multi_key(t: Tables) -> DataFrame:
    days = t.events.withColumn("on_day", F.to_date("ts"))
    return aggregate.group_count(days, ["event_type", "on_day"], title_case=["event_type"])


@query("""SELECT count(DISTINCT l_partkey) AS n_parts, CAST(0 AS BIGINT) AS n_missing FROM lineitem""")
def distinct_count(t: Tables) -> DataFrame:
    """A column that does not exist counts 0."""
    missing = aggregate.distinct_count(t.lineitem, "no_such_column", "n_missing")
    return aggregate.distinct_count(t.lineitem, "l_partkey", "n_parts").withColumn("n_missing", missing.scalar())


@query(f"""SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey,
                  count(*) FILTER (WHERE c_mktsegment IS NULL) AS c_mktsegment,
                  count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey,
                  count(*) FILTER (WHERE o_totalprice IS NULL) AS o_totalprice,
                  count(*) FILTER (WHERE o_orderpriority IS NULL) AS o_orderpriority FROM {CUSTOMER_ORDERS_SQL}""")
def null_counts(t: Tables) -> DataFrame:
    return aggregate.null_counts(customer_orders(t))


@query("""SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) >= 12""")
def having_min_count(t: Tables) -> DataFrame:
    return aggregate.group_count(t.orders, ["o_custkey"], name="n_orders").filter(F.col("n_orders") >= 12)


@query("""SELECT o_orderkey, o_custkey, n_orders FROM (
            SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders) WHERE n_orders >= 12""")
def rows_of_large_groups(t: Tables) -> DataFrame:
    """The rows themselves of groups with at least 12 rows."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    return partition_totals(orders, ["o_custkey"], "o_orderkey", rows="n_orders").filter(F.col("n_orders") >= 12)


@query("""SELECT round(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 2) AS returned,
                 CAST(NULL AS DOUBLE) AS none FROM lineitem""")
def filtered_sum(t: Tables) -> DataFrame:
    """No row passes the second filter, so its sum is null."""
    none = aggregate.filtered_sum(t.lineitem, F.col("l_returnflag") == "X", "l_extendedprice", "none")
    returned = aggregate.filtered_sum(t.lineitem, F.col("l_returnflag") == "R", "l_extendedprice", "returned")
    return returned.select(F.round("returned", 2).alias("returned"), none.scalar().alias("none"))


def _year_columns(expression: str, alias: str = "") -> str:
    return ", ".join(f'{expression.format(y=y)} AS "{y}{alias}"' for y in YEARS)


@query("""SELECT o_custkey, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F",
                 nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O",
                 nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS "P" FROM orders GROUP BY o_custkey""")
def pivot_count(t: Tables) -> DataFrame:
    """Values are found by Spark; a status a customer lacks is null."""
    return aggregate.pivot_count(t.orders, ["o_custkey"], "o_orderstatus")


@query(f"""SELECT o_orderpriority, {_year_columns('round(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = {y}), 2)')}
           FROM orders GROUP BY o_orderpriority""")
def pivot_sum_values(t: Tables) -> DataFrame:
    return aggregate.pivot_agg(with_year(t), ["o_orderpriority"], "order_year", YEARS,
                               [F.round(F.sum("o_totalprice"), 2)])


@query("""SELECT o_custkey, o_orderpriority,
            coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2), 0.0) AS "F_total",
            count(*) FILTER (WHERE o_orderstatus = 'F') AS "F_n",
            coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2), 0.0) AS "O_total",
            count(*) FILTER (WHERE o_orderstatus = 'O') AS "O_n",
            coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2), 0.0) AS "P_total",
            count(*) FILTER (WHERE o_orderstatus = 'P') AS "P_n"
          FROM orders GROUP BY o_custkey, o_orderpriority ORDER BY o_custkey, o_orderpriority""")
def pivot_multi_agg(t: Tables) -> DataFrame:
    wide = aggregate.pivot_agg(t.orders, ["o_custkey", "o_orderpriority"], "o_orderstatus", ["F", "O", "P"],
                               [F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("n")],
                               fill=0)
    return wide.orderBy("o_custkey", "o_orderpriority")


@query("""SELECT o_orderpriority AS o_orderpriority_o_orderstatus, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
                 count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
          FROM orders GROUP BY o_orderpriority""")
def crosstab(t: Tables) -> DataFrame:
    return aggregate.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("""SELECT lower(label) AS folded, count(DISTINCT label) AS n_labels, min(label) AS first_label,
                 max(label) AS last_label FROM (
            SELECT CASE WHEN event_id % 2 = 0 THEN event_type
                        WHEN event_type IN ('click', 'view') THEN upper(event_type) ELSE event_type END AS label
            FROM events) GROUP BY 1 HAVING count(DISTINCT label) > 1""")
def label_collisions(t: Tables) -> DataFrame:
    odd = (F.col("event_id") % 2 == 1) & F.col("event_type").isin("click", "view")
    mixed = t.events.withColumn("event_type", F.when(odd, F.upper("event_type")).otherwise(F.col("event_type")))
    return aggregate.label_collisions(mixed, "event_type")


def _cramers_sql(a: str, b: str, table: str, label: str) -> str:
    return f"""SELECT '{label}' AS pair, round(sqrt((sum(n * n / (r * c)) - 1)
                   / (least(count(DISTINCT a), count(DISTINCT b)) - 1)), 6) AS cramers_v
               FROM (SELECT a, b, CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) AS r,
                            CAST(sum(n) OVER (PARTITION BY b) AS DOUBLE) AS c
                     FROM (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {table} GROUP BY ALL))"""


@query(_cramers_sql("o_orderpriority", "o_orderstatus", "orders", "priority-status") + " UNION ALL "
       + _cramers_sql("p_brand", "p_type", "part", "brand-type"))
def cramers_v(t: Tables) -> DataFrame:
    first = aggregate.cramers_v(t.orders, "o_orderpriority", "o_orderstatus")
    second = aggregate.cramers_v(t.part, "p_brand", "p_type")
    both = (first.withColumn("pair", F.lit("priority-status"))
            .unionByName(second.withColumn("pair", F.lit("brand-type"))))
    return both.select("pair", F.round("cramers_v", 6).alias("cramers_v"))


QUARTERS = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


@query("""SELECT quantile_disc(o_totalprice, 0.25) AS q1, quantile_disc(o_totalprice, 0.5) AS q2,
                 quantile_disc(o_totalprice, 0.75) AS q3 FROM orders""")
def quantiles(t: Tables) -> DataFrame:
    return aggregate.exact_quantiles(t.orders, [], "o_totalprice", QUARTERS)


@query("""SELECT c_nationkey, quantile_disc(c_acctbal, 0.25) AS q1, quantile_disc(c_acctbal, 0.5) AS q2,
                 quantile_disc(c_acctbal, 0.75) AS q3 FROM customer GROUP BY c_nationkey""")
def group_quantiles(t: Tables) -> DataFrame:
    return aggregate.exact_quantiles(t.customer, ["c_nationkey"], "c_acctbal", QUARTERS)


@query("SELECT quantile_disc(o_totalprice, 0.5) AS exact, true AS near FROM orders")
def quantile_error(t: Tables) -> DataFrame:
    """The estimate's rank is off by a hundredth at most; prices are about even, so its value is by little more."""
    found = aggregate.quantile_error(t.orders, "o_totalprice", 0.5, accuracy=100)
    return found.select("exact", (F.abs("error") < 0.05).alias("near"))


@query("SELECT o_orderpriority, quantile_disc(o_totalprice, 0.5) AS median FROM orders GROUP BY o_orderpriority")
def group_median_approx(t: Tables) -> DataFrame:
    return aggregate.approx_quantiles(t.orders, ["o_orderpriority"], "o_totalprice", {"median": 0.5}, 100_000)


@query("SELECT o_orderpriority, median(o_totalprice) AS median FROM orders GROUP BY o_orderpriority")
def group_median(t: Tables) -> DataFrame:
    return aggregate.exact_median(t.orders, ["o_orderpriority"], "o_totalprice")


@query("SELECT CAST(length(text) AS INTEGER) AS length, count(*) AS n FROM documents GROUP BY 1")
def length_histogram(t: Tables) -> DataFrame:
    return aggregate.length_histogram(t.documents, "text")


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1""")
def yearly_counts(t: Tables) -> DataFrame:
    return aggregate.group_count(with_year(t), ["order_year"]).orderBy("order_year")


@query("""SELECT l_suppkey, n, n * 100.0 / sum(n) OVER () AS pct, n * count(*) OVER () / sum(n) OVER () AS to_mean
          FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey)""")
def key_skew(t: Tables) -> DataFrame:
    return aggregate.key_skew(t.lineitem, ["l_suppkey"])


@query("""SELECT lang, source, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents) AS pct
          FROM documents GROUP BY lang, source HAVING count(*) > 0.05::DOUBLE * (SELECT count(*) FROM documents)""")
def heavy_keys(t: Tables) -> DataFrame:
    """Groups of documents that hold more than a twentieth of the table, found without shuffling the others."""
    return aggregate.heavy_keys(t.documents, ["lang", "source"], 0.05)
