"""Projections, filters and conditionals (survey 2.2), sorts and limits (2.6)."""

from pyspark.sql import DataFrame, functions as F

from rowloom.operators import ordering, shape
from rowloom.plans.registry import Tables, query

# Orders by customer number and segments by part number: customers without orders and numbers
# without a customer are the source of nulls, and no row of either table is left out.
CUSTOMER_ORDERS_SQL = """(SELECT coalesce(c_custkey, o_custkey * 2) AS c_custkey, c_mktsegment, o_orderkey, o_totalprice,
    o_orderpriority FROM customer FULL JOIN orders ON c_custkey = o_custkey * 2)"""


def customer_orders(t: Tables) -> DataFrame:
    """All customers and all orders, an order going to twice the customer number that it has."""
    orders = t.orders.withColumn("_key", F.col("o_custkey") * 2)
    return t.customer.join(orders, F.col("c_custkey") == F.col("_key"), "full").select(
        F.coalesce("c_custkey", "_key").alias("c_custkey"), "c_mktsegment", "o_orderkey", "o_totalprice", "o_orderpriority")


@query("""SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price,
                 o_orderpriority FROM orders""")
def select_rename_drop(t: Tables) -> DataFrame:
    return shape.select_renamed(t.orders, {"o_orderkey": "order_id", "o_orderstatus": "status",
                                           "o_totalprice": "price"}, drop=["o_custkey", "o_orderdate"])


@query("""SELECT p_partkey AS part_id, array_to_string(list_transform(string_split(p_name, ' '),
                 lambda w: concat(upper(w[1]), lower(w[2:]))), ' ') AS part_name,
                 p_size AS part_size, p_type AS kind FROM part""")
def format_columns(t: Tables) -> DataFrame:
    return shape.format_columns(t.part, {"p_partkey": "part_id", "p_name": "part_name", "p_size": "part_size",
                                         "p_type": "kind"}, title_case=["p_name"])


@query("SELECT o_orderkey, o_totalprice AS o_totalpriceGBP, o_orderpriority AS Order_priority FROM orders")
def clean_column_names(t: Tables) -> DataFrame:
    odd = t.orders.select("o_orderkey", F.col("o_totalprice").alias("o_totalprice(£)"),
                          F.col("o_orderpriority").alias("Order priority"))
    return shape.clean_names(odd, {"(£)": "GBP"})


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                 l_extendedprice / nullif(l_quantity - 1, 0) AS unit_price FROM lineitem""")
def derived_ratio(t: Tables) -> DataFrame:
    """The divisor is zero for quantity 1, where the result is null."""
    less = t.lineitem.withColumn("others", F.col("l_quantity") - 1)
    return shape.ratio(less, "l_extendedprice", "others", "unit_price").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "unit_price")


@query("SELECT o_orderkey AS order_id, o_totalprice * 2 AS double_price, upper(o_orderstatus) AS status FROM orders")
def select_expr(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey AS order_id", "o_totalprice * 2 AS double_price",
                               "upper(o_orderstatus) AS status")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'""")
def filter_eq(t: Tables) -> DataFrame:
    """One condition as a column, one as SQL text."""
    return (t.orders.filter(F.col("o_orderpriority") == "1-URGENT").filter("o_orderstatus = 'F'")
            .select("o_orderkey", "o_totalprice"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem
          WHERE l_returnflag = 'R' AND l_quantity > 40""")
def filter_and(t: Tables) -> DataFrame:
    return (t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40))
            .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"))


@query("""SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
          WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')""")
def filter_isin(t: Tables) -> DataFrame:
    return (t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P"))
            .select("o_orderkey", "o_orderpriority", "o_orderstatus"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_discount FROM lineitem
          WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity BETWEEN 10 AND 20""")
def filter_between(t: Tables) -> DataFrame:
    return (t.lineitem.filter(F.col("l_discount").between(0.05, 0.07) & F.col("l_quantity").between(10, 20))
            .select("l_orderkey", "l_partkey", "l_suppkey", "l_discount"))


@query(f"SELECT c_custkey, c_mktsegment FROM {CUSTOMER_ORDERS_SQL} WHERE o_orderkey IS NULL")
def filter_null(t: Tables) -> DataFrame:
    return customer_orders(t).filter(F.col("o_orderkey").isNull()).select("c_custkey", "c_mktsegment")


@query(f"SELECT * FROM {CUSTOMER_ORDERS_SQL} WHERE o_totalprice IS NOT NULL")
def drop_null_rows(t: Tables) -> DataFrame:
    return shape.drop_null_rows(customer_orders(t), ["o_totalprice"])


@query(f"""SELECT c_custkey, coalesce(o_orderkey, 0) AS o_orderkey, coalesce(o_totalprice, 0.0) AS o_totalprice,
                  coalesce(o_orderpriority, 'none') AS o_orderpriority FROM {CUSTOMER_ORDERS_SQL}""")
def fill_nulls(t: Tables) -> DataFrame:
    """All numeric columns at once, one text column by name."""
    return (customer_orders(t).fillna(0).fillna({"o_orderpriority": "none"})
            .select("c_custkey", "o_orderkey", "o_totalprice", "o_orderpriority"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low'
                 ELSE o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders""")
def replace_values(t: Tables) -> DataFrame:
    return shape.replace_values(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"),
                                {"1-URGENT": "urgent", "5-LOW": "low"})


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_values(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct()


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem) WHERE n = 1""")
def dedupe_keys(t: Tables) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return shape.dedupe(t.lineitem.select(columns), columns[:2], [F.col(c) for c in columns[2:]])


@query("""SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal <= 0 THEN 'owing' ELSE 'in credit' END AS standing
          FROM customer""")
def bin_two(t: Tables) -> DataFrame:
    return shape.bin_values(t.customer, "c_acctbal", [0], ["owing", "in credit"], "standing").select(
        "c_custkey", "c_acctbal", "standing")


@query("""SELECT size_of_order, count(*) AS n FROM (
            SELECT CASE WHEN o_totalprice <= 50000 THEN 'small' WHEN o_totalprice <= 150000 THEN 'medium'
                        WHEN o_totalprice <= 300000 THEN 'large' ELSE 'huge' END AS size_of_order FROM orders)
          GROUP BY size_of_order""")
def bin_many(t: Tables) -> DataFrame:
    binned = shape.bin_values(t.orders, "o_totalprice", [50_000, 150_000, 300_000],
                              ["small", "medium", "large", "huge"], "size_of_order")
    return binned.groupBy("size_of_order").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, o_orderpriority = '1-URGENT' AS is_urgent, o_orderpriority = '2-HIGH' AS is_high,
                 o_orderpriority = '5-LOW' AS is_low FROM orders""")
def indicator_columns(t: Tables) -> DataFrame:
    return shape.indicator_columns(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", {
        "1-URGENT": "is_urgent", "2-HIGH": "is_high", "5-LOW": "is_low"}).drop("o_orderpriority")


@query("""SELECT (SELECT count(*) FROM documents WHERE lang = 'en') AS n_title,
                 CAST(0 AS BIGINT) AS n_lower""")
def count_by_label(t: Tables) -> DataFrame:
    """The column is title-cased, the label is not, so ``en`` finds nothing."""
    lower = shape.count_by_label(t.documents, "lang", "en", "n_lower")
    return shape.count_by_label(t.documents, "lang", "En", "n_title").withColumn("n_lower", lower.scalar())


@query("SELECT n_nationkey, lower(n_name) AS n_name FROM nation WHERE lower(n_name) < 'nation_2'")
def late_binding_filter(t: Tables) -> DataFrame:
    """The filter sees the overwritten column."""
    return (t.nation.select("n_nationkey", "n_name").withColumn("n_name", F.lower(F.col("n_name")))
            .filter(F.col("n_name") < "nation_2"))


@query("""SELECT l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS quantity,
                 CAST(CAST(l_extendedprice AS DECIMAL(12, 1)) AS DOUBLE) AS price,
                 CAST(l_shipdate AS DATE) AS ship_day, TRY_CAST(l_returnflag AS INTEGER) AS flag_number
          FROM lineitem""")
def cast_types(t: Tables) -> DataFrame:
    """Texts that are no numbers become null."""
    typed = shape.cast_columns(t.lineitem, {"l_quantity": "int", "l_extendedprice": "decimal(12,1)",
                                            "l_shipdate": "date", "l_returnflag": "int"})
    return typed.select("l_orderkey", "l_partkey", F.col("l_quantity").alias("quantity"),
                        F.col("l_extendedprice").cast("double").alias("price"),
                        F.col("l_shipdate").alias("ship_day"), F.col("l_returnflag").alias("flag_number"))


@query("""SELECT o_orderkey, CAST((((o_orderkey * 1000000 + 2147483648) % 4294967296) - 2147483648) AS INTEGER)
                 AS wrapped FROM orders""")
def cast_wrap(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", shape.wrap_to_int(F.col("o_orderkey") * 1_000_000).alias("wrapped"))


@query("""SELECT event_type, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM events) AS pct
          FROM events GROUP BY event_type""")
def pct_of_total(t: Tables) -> DataFrame:
    return shape.share_of_total(t.events, ["event_type"])


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_n(t: Tables) -> DataFrame:
    return ordering.top_n(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 10)


@query(f"""(SELECT 'nulls first' AS placing, c_custkey, o_totalprice FROM {CUSTOMER_ORDERS_SQL}
            ORDER BY o_totalprice ASC NULLS FIRST, c_custkey LIMIT 10)
           UNION ALL
           (SELECT 'nulls last' AS placing, c_custkey, o_totalprice FROM {CUSTOMER_ORDERS_SQL}
            ORDER BY o_totalprice ASC NULLS LAST, c_custkey LIMIT 10)""")
def bottom_n_nulls(t: Tables) -> DataFrame:
    rows = customer_orders(t).select("c_custkey", "o_totalprice")
    first = ordering.bottom_n(rows, "o_totalprice", "c_custkey", 10, nulls_first=True)
    last = ordering.bottom_n(rows, "o_totalprice", "c_custkey", 10)
    return (first.withColumn("placing", F.lit("nulls first"))
            .union(last.withColumn("placing", F.lit("nulls last"))))


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL
          ORDER BY o_orderpriority, o_orderstatus DESC""")
def sort_mixed(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(*ordering.order_columns(["o_orderpriority", "-o_orderstatus"]))
