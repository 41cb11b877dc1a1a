"""Scalar functions (survey 2.8)."""

from pyspark.sql import DataFrame, functions as F

from rowloom.functions import scalars
from rowloom.plans.registry import Tables, query


@query("SELECT n_nationkey, upper(lower(n_name)) AS upper_name FROM nation")
def str_case(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", F.upper(F.lower("n_name")).alias("upper_name"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
                 lambda w: concat(upper(w[1]), lower(w[2:]))), ' ') AS title FROM part""")
def str_initcap(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.initcap("p_name").alias("title"))


@query("SELECT c_custkey, substr(c_name, 10, 4) AS part FROM customer")
def str_substr(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.substring("c_name", 10, 4).alias("part"))


# A text that is null for accounts below zero.
SEGMENT_SQL = "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END"


def _segment():
    return F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))


@query(f"SELECT c_custkey, c_name || '-' || {SEGMENT_SQL} AS joined FROM customer")
def str_concat(t: Tables) -> DataFrame:
    """Null if any part is null."""
    return t.customer.select("c_custkey", F.concat("c_name", F.lit("-"), _segment()).alias("joined"))


@query(f"""SELECT c_custkey, concat_ws('-', c_name, {SEGMENT_SQL}) AS joined,
                  concat_ws('-', {SEGMENT_SQL}) AS alone FROM customer""")
def str_concat_ws(t: Tables) -> DataFrame:
    """Nulls are left out; all null gives an empty text."""
    return t.customer.select("c_custkey", F.concat_ws("-", "c_name", _segment()).alias("joined"),
                             F.concat_ws("-", _segment()).alias("alone"))


@query("""SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS zeros,
                 lpad(CAST(o_orderkey AS VARCHAR), 3, '0') AS cut, lpad(CAST(o_orderkey AS VARCHAR), 14, 'xyz') AS cycled,
                 rpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS behind FROM orders""")
def str_pad(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return t.orders.select("o_orderkey", F.lpad(key, 9, "0").alias("zeros"), F.lpad(key, 3, "0").alias("cut"),
                           F.lpad(key, 14, "xyz").alias("cycled"), F.rpad(key, 9, "0").alias("behind"))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[2] AS second_word FROM part")
def str_split(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    return t.part.select("p_partkey", F.get(words, 0).alias("first_word"), F.get(words, 1).alias("second_word"))


TEXT_DATE_SQL = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'unknown'
    ELSE strftime(o_orderdate, '%d/%m/%Y') END AS day_text FROM orders)"""


@query(f"SELECT o_orderkey, CAST(try_strptime(day_text, '%d/%m/%Y') AS DATE) AS order_day FROM {TEXT_DATE_SQL}")
def date_parse(t: Tables) -> DataFrame:
    """Text that is no date becomes null."""
    text = F.when(F.col("o_orderkey") % 7 == 0, "unknown").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return (t.orders.select("o_orderkey", text.alias("day_text"))
            .select("o_orderkey", scalars.parse_date("day_text", "dd/MM/yyyy").alias("order_day")))


@query("SELECT o_orderkey, strftime(o_orderdate, '%b-%d') AS month_day FROM orders")
def date_format(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "MMM-dd").alias("month_day"))


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL '1 year 3 months' AS DATE) AS later,
                 CAST(CAST(o_orderdate AS DATE) - INTERVAL 13 DAY AS DATE) AS earlier,
                 CAST(CAST(o_orderdate AS DATE) + INTERVAL 14 DAY AS DATE) AS two_weeks,
                 CAST(o_orderdate + INTERVAL 30 HOUR AS DATE) AS next_hours FROM orders""")
def date_interval(t: Tables) -> DataFrame:
    return t.orders.withColumn("d", F.to_date("o_orderdate")).select(
        "o_orderkey", F.expr("d + interval 1 year 3 months").alias("later"),
        F.expr("d - interval 13 days").alias("earlier"), F.expr("d + interval 2 weeks").alias("two_weeks"),
        F.expr("cast(o_orderdate + interval 30 hours as date)").alias("next_hours"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) + 10 AS plus_days, CAST(o_orderdate AS DATE) - 10 AS minus_days,
                 CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 MONTH AS DATE) AS plus_years FROM orders""")
def date_add_sub(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.date_add(day, 10).alias("plus_days"),
                           F.date_sub(day, 10).alias("minus_days"), F.add_months(day, 2 * 12).alias("plus_years"))


@query("""SELECT event_id, CAST(ts AS DATE) AS on_day, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
                 CAST(day(ts) AS INTEGER) AS d FROM events""")
def date_parts(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.col("ts").cast("date").alias("on_day"), F.year("ts").alias("y"),
                           F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"))


@query("""SELECT event_id, date_trunc('second', ts) AS at, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events""")
def parse_text_timestamps(t: Tables) -> DataFrame:
    """Text with a pattern, as a timestamp and as seconds."""
    pattern = "dd/MM/yyyy HH:mm:ss"
    texts = t.events.select("event_id", F.date_format("ts", pattern).alias("text"))
    return texts.select("event_id", scalars.parse_timestamp("text", pattern).alias("at"),
                        scalars.text_epoch_seconds("text", pattern).alias("seconds"))


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def epoch_seconds(t: Tables) -> DataFrame:
    return t.events.select("event_id", scalars.epoch_seconds(t.events, "ts").alias("seconds"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, CAST(ceil(l_extendedprice) AS BIGINT) AS up,
                 CAST(floor(l_extendedprice) AS BIGINT) AS down, round_even(l_extendedprice, 0) AS nearest FROM lineitem""")
def math_round_family(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", F.ceil("l_extendedprice").alias("up"),
                             F.floor("l_extendedprice").alias("down"), F.rint("l_extendedprice").alias("nearest"))


HALVES_SQL = "(SELECT l_orderkey, l_partkey, l_suppkey, l_quantity - 25.5 AS half FROM lineitem)"


def _halves(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", (F.col("l_quantity") - 25.5).alias("half"))


@query(f"SELECT *, round(half) + 0.0 AS rounded FROM {HALVES_SQL}")
def math_round(t: Tables) -> DataFrame:
    """Halves go away from zero."""
    return _halves(t).withColumn("rounded", F.round("half"))


@query(f"SELECT *, round_even(half, 0) + 0.0 AS rounded FROM {HALVES_SQL}")
def math_bround(t: Tables) -> DataFrame:
    """Halves go to the even neighbour."""
    return _halves(t).withColumn("rounded", F.bround("half"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS credit,
                 CASE WHEN c_acctbal >= 0 THEN c_acctbal * c_acctbal END AS squared FROM customer""")
def math_square(t: Tables) -> DataFrame:
    credit = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("credit"))
    return scalars.add_square(credit, "credit", "squared")


@query("""SELECT p_partkey, round(sqrt((p_retailprice - 1000) * (p_retailprice - 1000)
                 + (p_size - 25) * (p_size - 25)) / 1000, 9) AS distance FROM part""")
def math_distance(t: Tables) -> DataFrame:
    away = scalars.euclidean(F.col("p_retailprice"), F.col("p_size"), F.lit(1000), F.lit(25))
    return t.part.select("p_partkey", F.round(away, 9).alias("distance"))


# Words of every text, and a row without a list for every item of the benchmark.
WORDS_SQL = """(SELECT doc_id, lang, string_split(text, ' ') AS words FROM documents
                UNION ALL SELECT -1 - item_id, NULL, NULL FROM benchmark)"""


def _words(t: Tables) -> DataFrame:
    none = t.benchmark.select((-1 - F.col("item_id")).alias("doc_id"), F.lit(None).cast("string").alias("lang"),
                              F.lit(None).cast("array<string>").alias("words"))
    return t.documents.select("doc_id", "lang", F.split("text", " ").alias("words")).unionAll(none)


@query(f"SELECT doc_id, CAST(coalesce(len(words), -1) AS INTEGER) AS n_words FROM {WORDS_SQL}")
def array_size(t: Tables) -> DataFrame:
    return _words(t).select("doc_id", scalars.array_size("words").alias("n_words"))


@query("""SELECT p_partkey, array_to_string(string_split(p_name, ' '), ', ') AS joined,
                 array_to_string([p_brand, p_type], ', ') AS pair FROM part""")
def array_join(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(F.split("p_name", " "), ", ").alias("joined"),
                         F.concat_ws(", ", F.array("p_brand", "p_type")).alias("pair"))


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM {WORDS_SQL}) GROUP BY word")
def array_explode(t: Tables) -> DataFrame:
    """Null lists give no row; words are counted before the shuffle."""
    return _words(t).select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT lang, count(*) AS n_rows, count(word) AS n_words FROM (
             SELECT lang, unnest(CASE WHEN words IS NULL THEN [NULL] ELSE words END) AS word FROM {WORDS_SQL})
           GROUP BY lang""")
def array_explode_outer(t: Tables) -> DataFrame:
    """Null lists give one row with a null word."""
    return (_words(t).select("lang", F.explode_outer("words").alias("word"))
            .groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), F.count("word").alias("n_words")))


@query("""SELECT p_partkey, CAST(place AS INTEGER) AS place, word FROM (
            SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1)
                   AS place FROM part)""")
def array_posexplode(t: Tables) -> DataFrame:
    """Positions count from 1."""
    return (t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word"))
            .select("p_partkey", (F.col("pos") + 1).alias("place"), "word"))


@query(f"""SELECT lang, count(*) AS n_rows, count(word) AS n_words, count(*) FILTER (WHERE place = 1) AS n_first FROM (
             SELECT lang, unnest(CASE WHEN words IS NULL THEN [NULL] ELSE words END) AS word,
                    unnest(CASE WHEN words IS NULL THEN [NULL] ELSE range(1, len(words) + 1) END) AS place
             FROM {WORDS_SQL}) GROUP BY lang""")
def array_posexplode_outer(t: Tables) -> DataFrame:
    exploded = _words(t).select("lang", F.posexplode_outer("words").alias("pos", "word"))
    return exploded.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), F.count("word").alias("n_words"),
                                        F.count_if(F.col("pos") + 1 == 1).alias("n_first"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '5-LOW' THEN 30 END
                 AS days FROM orders""")
def map_lookup(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", scalars.map_lookup("o_orderpriority", {
        "1-URGENT": 1, "2-HIGH": 3, "5-LOW": 30}).alias("days"))


# Days of the festive report, and the calendar that runs 13 days behind.
FESTIVE_DAYS = {"Dec-24": "Christmas Eve", "Dec-25": "Christmas Day", "Dec-26": "Boxing Day",
                "Jan-01": "New Years Day"}
ORTHODOX_DAYS = {"Dec-24": "Christmas Eve", "Dec-25": "Christmas Day", "Jan-01": "New Years Day"}
ORTHODOX_SHIFT = 13


def _calendar_sql(days: dict[str, str], shift: int) -> str:
    cases = " ".join(f"WHEN '{day}' THEN '{label}'" for day, label in days.items())
    return f"""SELECT on_date, label, count(*) AS n FROM (
        SELECT CAST(o_orderdate AS DATE) AS on_date,
               CASE strftime(CAST(o_orderdate AS DATE) - {shift}, '%b-%d') {cases} END AS label FROM orders)
        WHERE label IS NOT NULL GROUP BY on_date, label"""


@query(_calendar_sql(FESTIVE_DAYS, 0))
def calendar_label_counts(t: Tables) -> DataFrame:
    return scalars.calendar_counts(t.orders, "o_orderdate", FESTIVE_DAYS)


@query(_calendar_sql(ORTHODOX_DAYS, ORTHODOX_SHIFT))
def calendar_shifted_counts(t: Tables) -> DataFrame:
    return scalars.calendar_counts(t.orders, "o_orderdate", ORTHODOX_DAYS, ORTHODOX_SHIFT)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders WHERE day(o_orderdate) = 1")
def first_of_month(t: Tables) -> DataFrame:
    return t.orders.filter(scalars.first_of_month("o_orderdate")).select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_day"))
