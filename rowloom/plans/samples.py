"""Sampling and splitting (survey 2.9)."""

from pyspark.sql import DataFrame, functions as F

from rowloom.operators import layout, sampling
from rowloom.plans.registry import Tables, query

SEED = 42
# Exact stratum sizes; every other type counts as Other.
STRATA = {"click": 15, "view": 20, "purchase": 10, "signup": 2, "Other": 5}
FRACTIONS = {"click": 0.05, "view": 0.1, "error": 0.5}
HASH_SQL = f"md5('{SEED}-' || CAST({{key}} AS VARCHAR))"
UNIFORM_SQL = f"((CAST('0x' || substr({HASH_SQL}, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)"


def _within(drawn: DataFrame, whole: DataFrame, fraction: float, variance: float) -> DataFrame:
    """Whether the number of drawn rows lies within six standard deviations of what is expected."""
    n, got = whole.agg(F.count(F.lit(1)).alias("n")), drawn.agg(F.count(F.lit(1)).alias("got"))
    return n.select("n", (F.abs(got.scalar() - F.col("n") * fraction) <= 6 * F.sqrt(F.col("n") * variance) + 1).alias("within"))


@query("SELECT count(*) AS n, true AS within FROM orders")
def sample_bernoulli(t: Tables) -> DataFrame:
    return _within(sampling.bernoulli_sample(t.orders, 0.1, SEED), t.orders, 0.1, 0.09)


@query("SELECT count(*) AS n, true AS within FROM orders")
def sample_replacement(t: Tables) -> DataFrame:
    return _within(sampling.bernoulli_sample(t.orders, 1.0, SEED, with_replacement=True), t.orders, 1.0, 1.0)


@query("""SELECT event_type, n_all, true AS within FROM (SELECT event_type, count(*) AS n_all FROM events GROUP BY event_type)
          WHERE event_type IN ('click', 'view', 'error')""")
def sample_by(t: Tables) -> DataFrame:
    """Drawn rows of each listed type lie within six standard deviations of the expected number."""
    drawn = sampling.sample_by(t.events, "event_type", FRACTIONS, SEED)
    return sampling.expected_rows(t.events, drawn, "event_type", FRACTIONS).select(
        "event_type", "n_all", (F.abs(F.col("n_sample") - F.col("n_expected")) <= 6 * F.sqrt("n_all") + 1).alias("within"))


DRAWN_SQL = f"""(SELECT event_type FROM (SELECT event_type, row_number() OVER (ORDER BY {HASH_SQL.format(key='event_id')}) AS place
                FROM events) WHERE place <= (SELECT round(count(*) * 0.1) FROM events))"""


@query(f"""SELECT event_type, n_all, n_all * 100.0 / sum(n_all) OVER () AS pct_all, coalesce(n_sample, 0) AS n_sample,
                  coalesce(n_sample * 100.0 / sum(n_sample) OVER (), 0.0) AS pct_sample
           FROM (SELECT event_type, CAST(count(*) AS DOUBLE) AS n_all FROM events GROUP BY 1)
           LEFT JOIN (SELECT event_type, CAST(count(*) AS DOUBLE) AS n_sample FROM {DRAWN_SQL} GROUP BY 1) USING (event_type)""")
def sample_distribution(t: Tables) -> DataFrame:
    drawn = sampling.exact_sample(t.events, "event_id", SEED, fraction=0.1)
    return (sampling.sample_distribution(t.events, drawn, ["event_type"])
            .withColumns({c: F.col(c).cast("double") for c in ("n_all", "pct_all", "n_sample", "pct_sample")}))


@query("""SELECT event_type, n_all, CAST(fraction AS DOUBLE) AS fraction,
                 CAST(round(n_all * fraction) AS BIGINT) AS n_expected FROM (
            SELECT event_type, count(*) AS n_all, CASE event_type WHEN 'click' THEN 0.05::DOUBLE
                   WHEN 'view' THEN 0.1::DOUBLE WHEN 'error' THEN 0.5::DOUBLE END AS fraction
            FROM events GROUP BY event_type) WHERE fraction IS NOT NULL""")
def sample_expected_rows(t: Tables) -> DataFrame:
    """Only the expected side is checked here; the drawn counts vary with the layout."""
    drawn = sampling.sample_by(t.events, "event_type", FRACTIONS, SEED)
    return sampling.expected_rows(t.events, drawn, "event_type", FRACTIONS).drop("n_sample")


@query(f"""SELECT o_orderkey, o_custkey, o_totalprice FROM (
             SELECT *, row_number() OVER (ORDER BY {HASH_SQL.format(key='o_orderkey')}) AS place FROM orders)
           WHERE place <= (SELECT round(count(*) * 0.1) FROM orders)""")
def sample_exact(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.exact_sample(orders, "o_orderkey", SEED, fraction=0.1)


@query(f"""SELECT event_id, event_type, stratum FROM (
             SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {HASH_SQL.format(key='event_id')}) AS place
             FROM (SELECT *, CASE WHEN event_type IN ('click', 'view', 'purchase', 'signup') THEN event_type
                             ELSE 'Other' END AS stratum FROM events))
           WHERE place <= CASE stratum WHEN 'click' THEN 15 WHEN 'view' THEN 20 WHEN 'purchase' THEN 10
                               WHEN 'signup' THEN 2 ELSE 5 END""")
def sample_exact_stratified(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "event_type")
    return sampling.exact_stratified_sample(events, "event_type", STRATA, "event_id", SEED)


@query(f"""SELECT part_name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM (
             SELECT o_orderkey, CASE WHEN u < 0.6::DOUBLE / 1.0 THEN 'train' WHEN u < 0.6::DOUBLE + 0.3::DOUBLE THEN 'test'
                    ELSE 'check' END AS part_name
             FROM (SELECT o_orderkey, {UNIFORM_SQL.format(key='o_orderkey')} AS u FROM orders)) GROUP BY part_name""")
def random_split(t: Tables) -> DataFrame:
    split = sampling.random_split(t.orders, {"train": 0.6, "test": 0.3, "check": 0.1}, "o_orderkey", SEED, "part_name")
    return split.groupBy("part_name").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("SELECT o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS part FROM orders")
def split_modulo(t: Tables) -> DataFrame:
    return sampling.modulo_split(t.orders.select("o_orderkey"), "o_orderkey", 3)


@query("""SELECT CAST(i % 3 AS INTEGER) AS part, count(*) AS n, CAST(sum(i) AS BIGINT) AS id_sum, min(i) AS lowest, max(i) AS highest
          FROM (SELECT row_number() OVER () - 1 AS i FROM lineitem) GROUP BY 1""")
def split_generated_ids(t: Tables) -> DataFrame:
    """Parts of a table without a key, by generated ids; without gaps, they differ by one row at most."""
    split = sampling.modulo_split(layout.numbered_rows(t.lineitem.select("l_orderkey", "l_linenumber")), "row_id", 3)
    return split.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("id_sum"),
                                     F.min("row_id").alias("lowest"), F.max("row_id").alias("highest"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_id FROM orders")
def ordered_row_ids(t: Tables) -> DataFrame:
    """Ids that follow an order: range partitions in order, each numbered where it lies."""
    return layout.numbered_rows(t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")).drop("o_totalprice")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '3-MEDIUM'")
def sample_by_filter(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderpriority") == "3-MEDIUM").select("o_orderkey", "o_orderpriority")


@query(f"""SELECT o_orderkey, o_totalprice FROM orders
           ORDER BY -ln({UNIFORM_SQL.format(key='o_orderkey')}) / o_totalprice LIMIT 100""")
def sample_weighted(t: Tables) -> DataFrame:
    return sampling.weighted_sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", 100, SEED)


def _summary_sql(source: str, tag: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean_{tag}, round(stddev_samp({c}), 4) AS sd_{tag}, "
        f"CAST(min({c}) AS DOUBLE) AS min_{tag}, CAST(max({c}) AS DOUBLE) AS max_{tag} FROM {source}" for c in columns)


CHECKED = ["o_totalprice", "o_custkey"]
FIFTH_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {HASH_SQL.format(key='o_orderkey')}) AS place FROM orders)
                WHERE place <= (SELECT round(count(*) * 0.2) FROM orders))"""


@query(f"""SELECT * FROM ({_summary_sql('orders', 'all', CHECKED)}) JOIN ({_summary_sql(FIFTH_SQL, 'sample', CHECKED)}) USING ("column")""")
def sample_validate(t: Tables) -> DataFrame:
    drawn = sampling.exact_sample(t.orders, "o_orderkey", SEED, fraction=0.2)
    summary = sampling.validate_sample(t.orders, drawn, CHECKED).drop("mean_gap")
    return summary.withColumns({c: F.round(c, 4) for c in summary.columns if c[:4] == "mean" or c[:2] == "sd"})
