"""Sources and sinks (survey 2.1): what is written is read back and compared with the table."""

from pyspark.sql import DataFrame, functions as F, types as T

from rowloom.operators import quality
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path
from rowloom.sources import files, generators, tables

ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
            o_orderpriority FROM orders"""


@query(ORDERS)
def csv_roundtrip_infer(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders_csv")
    files.write_csv(t.orders, path)
    return (files.read_csv(t.spark, path, infer=True)
            .withColumns({"o_orderkey": F.col("o_orderkey").cast("long"),
                          "o_custkey": F.col("o_custkey").cast("long"),
                          "o_orderdate": F.to_date("o_orderdate")}))


@query(ORDERS)
def csv_roundtrip_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders_csv")
    files.write_csv(t.orders, path)
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])
    return files.read_csv(t.spark, path, schema).withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_roundtrip_ddl(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "nation_csv")
    files.write_csv(t.nation, path)
    return files.read_csv(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sized_csv(t: Tables) -> DataFrame:
    """Few files of a chosen size instead of one file through one task."""
    path = scratch_path(t.spark, "customer_csv")
    files.write_sized_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), path, rows_per_file=1_000_000)
    return files.read_csv(t.spark, path, "c_custkey long, c_name string, c_acctbal double")


@query("SELECT * FROM part UNION ALL SELECT * FROM part")
def parquet_roundtrip_modes(t: Tables) -> DataFrame:
    """Overwrite, then append doubles the rows, then ignore leaves them."""
    path = scratch_path(t.spark, "part_parquet")
    for mode in ("overwrite", "append", "ignore"):
        files.write_parquet(t.part, path, mode)
    return files.read_parquet(t.spark, path)


@query("SELECT * FROM supplier")
def orc_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "supplier_orc")
    files.write_orc(t.supplier, path)
    return files.read_orc(t.spark, path)


@query("SELECT n_nationkey, n_name || ' é' AS n_name FROM nation")
def json_encoding(t: Tables) -> DataFrame:
    """Latin-1 files are read by naming their encoding."""
    path = scratch_path(t.spark, "nation_json")
    named = t.nation.select("n_nationkey", F.concat("n_name", F.lit(" é")).alias("n_name"))
    named.write.option("encoding", "ISO-8859-1").json(path)
    return files.read_json(t.spark, path, "n_nationkey int, n_name string", multi_line=False, encoding="ISO-8859-1")


@query("SELECT count(*) AS n, 1 AS missing FROM supplier")
def safe_read(t: Tables) -> DataFrame:
    """A path that is there is read, one that isn't gives a clear error."""
    try:
        quality.safe_read_parquet(t.spark, t.path("supplier") + "-missing")
    except FileNotFoundError:
        return quality.safe_read_parquet(t.spark, t.path("supplier")).agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("missing"))
    raise AssertionError("a missing path was read")


@query("""SELECT event_id, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
          FROM events""")
def json_roundtrip(t: Tables) -> DataFrame:
    """Events as JSON with the nested properties opened."""
    path = scratch_path(t.spark, "events_json")
    opened = t.events.select("event_id", "user_id", "event_type", "value",
                             F.from_json("props", "k int").alias("props"))
    files.write_json(opened, path)
    schema = "event_id long, user_id long, event_type string, value double, props struct<k: int>"
    return files.read_json(t.spark, path, schema).select(
        "event_id", "user_id", "event_type", "value", F.col("props.k").alias("k"))


@query("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey")
def table_read_sql(t: Tables) -> DataFrame:
    name = tables.fresh_name("nation", t.spark)
    tables.save_table(t.nation, name, scratch_path(t.spark, "nation"))
    return t.spark.sql(f"SELECT n_regionkey, count(*) AS n FROM {name} GROUP BY n_regionkey")


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def insert_into_positional(t: Tables) -> DataFrame:
    """The incoming columns are in another order than the table's."""
    name, path = tables.fresh_name("customer", t.spark), scratch_path(t.spark, "customer")
    t.spark.sql(f"CREATE TABLE {name} (c_custkey BIGINT, c_mktsegment STRING, c_acctbal DOUBLE) "
                f"USING PARQUET LOCATION '{path}'")
    tables.insert_positional(t.customer.select("c_acctbal", "c_custkey", "c_mktsegment"), name)
    return t.spark.table(name)


def _by_year(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority",
                           F.year("o_orderdate").alias("o_year"))


@query("""SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year
          FROM orders WHERE year(o_orderdate) IN (1996, 1997)""")
def partitioned_write_prune(t: Tables) -> DataFrame:
    """Written by year; reading two years lists two folders."""
    path = scratch_path(t.spark, "orders_by_year")
    files.write_parquet(_by_year(t), path, partition_by=["o_year"])
    return files.read_parquet(t.spark, path).filter(F.col("o_year").isin(1996, 1997))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
                 o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""")
def dynamic_partition_overwrite(t: Tables) -> DataFrame:
    """Only the year that comes in is replaced."""
    name = tables.fresh_name("orders_by_year", t.spark)
    tables.save_table(_by_year(t), name, scratch_path(t.spark, "table"), partition_by=["o_year"])
    incoming = _by_year(t).filter(F.col("o_year") == 1998).withColumn("o_totalprice", F.lit(0.0))
    tables.insert_positional(incoming, name)
    return t.spark.table(name)


@query("""SELECT o_orderpriority, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority""")
def bucketed_join(t: Tables) -> DataFrame:
    """Both tables bucketed on the order key, so the join itself needs no shuffle; as many buckets as the larger needs."""
    orders, lines = tables.fresh_name("orders_b", t.spark), tables.fresh_name("lineitem_b", t.spark)
    buckets = tables.bucket_count(t.lineitem)
    tables.save_table(t.orders, orders, scratch_path(t.spark, "orders_b"), buckets=buckets,
                      bucket_by=["o_orderkey"], sort_by=["o_orderkey"])
    tables.save_table(t.lineitem, lines, scratch_path(t.spark, "lineitem_b"), buckets=buckets,
                      bucket_by=["l_orderkey"], sort_by=["l_orderkey"])
    joined = t.spark.table(orders).join(t.spark.table(lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("""SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""")
def partitioned_bucketed_table(t: Tables) -> DataFrame:
    """One folder per status, bucketed by customer inside: the filter prunes folders, the grouping needs no shuffle."""
    name = tables.fresh_name("orders_pb", t.spark)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    kept = tables.save_table(orders, name, scratch_path(t.spark, "table"), partition_by=["o_orderstatus"],
                             buckets=tables.bucket_count(orders), bucket_by=["o_custkey"], sort_by=["o_custkey"])
    return kept.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def table_overwrite(t: Tables) -> DataFrame:
    """A managed table written twice: the second write replaces the first, other columns included."""
    name = tables.fresh_name("suppliers", t.spark)
    t.supplier.select("s_suppkey").write.mode("overwrite").saveAsTable(name)
    t.supplier.select("s_suppkey", "s_name", "s_acctbal").write.mode("overwrite").saveAsTable(name)
    return t.spark.table(name)


@query("""SELECT o_orderpriority, round(avg(o_totalprice), 2) AS mean_price FROM orders
          GROUP BY o_orderpriority ORDER BY o_orderpriority""")
def sql_view_avg(t: Tables) -> DataFrame:
    return tables.create_view(t.spark, tables.fresh_name("mean_price", t.spark), f"""
        SELECT o_orderpriority, round(avg(o_totalprice), 2) AS mean_price
        FROM parquet.`{t.path('orders')}` GROUP BY o_orderpriority ORDER BY o_orderpriority""")


@query("""SELECT skew_key, count(*) AS n FROM (
            SELECT CASE WHEN event_id < 1 THEN 'A' WHEN event_id < 10 THEN 'B' WHEN event_id < 100 THEN 'C'
                        WHEN event_id < 1000 THEN 'D' ELSE 'E' END AS skew_key FROM events)
          GROUP BY skew_key""")
def gen_skewed(t: Tables) -> DataFrame:
    return (t.events.select(generators.skewed_key("event_id", scale=0.01).alias("skew_key"))
            .groupBy("skew_key").agg(F.count(F.lit(1)).alias("n")))


PICK_SQL = "CAST('0x' || substr(md5('7-' || CAST(o_orderkey AS VARCHAR)), 1, 13) AS BIGINT) % 10"


def _odd_text(column: str) -> str:
    return f"""CASE pick WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || {column} || ' ' WHEN 3 THEN upper({column})
               ELSE {column} END AS {column}"""


@query(f"""SELECT o_orderkey, o_custkey, {_odd_text('o_orderstatus')}, CASE pick WHEN 0 THEN NULL WHEN 1 THEN 0.0
                  WHEN 2 THEN -o_totalprice WHEN 3 THEN o_totalprice * 1000000.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
                  {_odd_text('o_orderpriority')} FROM (SELECT *, {PICK_SQL} AS pick FROM orders)""")
def synthetic_orders(t: Tables) -> DataFrame:
    """Orders with nulls, zeros and extremes put in by a hash of the key."""
    return generators.edge_cases(t.orders.drop("o_orderdate"), "o_orderkey")


@query("""SELECT o_orderkey, true AS in_range,
                 CAST('0x' || substr(md5('42-' || CAST(o_orderkey AS VARCHAR)), 1, 13) AS BIGINT) % 12 + 1 AS hashed_int FROM orders""")
def random_columns(t: Tables) -> DataFrame:
    """Seeded random integers, of which only the range can be known, next to hash-based ones."""
    return t.orders.select("o_orderkey", generators.random_ints(12, 42).between(1, 12).alias("in_range"),
                           generators.hashed_ints("o_orderkey", 12, 42).alias("hashed_int"))
