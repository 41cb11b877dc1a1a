"""Model operators (survey 2.12): document quality from length, language and source."""

from pyspark.sql import DataFrame, functions as F

from rowloom.operators import models
from rowloom.plans.registry import Tables, query
from rowloom.session import scratch_path

NUMERIC, CATEGORICAL = ["n_chars"], ["lang"]
REFERENCE = {"lang": "en"}
PREPARED_SQL = """(SELECT CAST(quality AS DOUBLE) AS label, CAST(n_chars AS DOUBLE) AS n_chars, lang
                   FROM labels JOIN documents USING (doc_id))"""


def prepared(t: Tables) -> DataFrame:
    joined = t.labels.join(t.documents.select("doc_id", "n_chars", "lang"), "doc_id")
    return models.prepare(joined, F.col("quality") == 1, NUMERIC, CATEGORICAL)


def training(t: Tables) -> DataFrame:
    """Lengths in thousands, English as the reference language."""
    return models.set_reference(prepared(t).withColumn("n_chars", F.col("n_chars") / 1000), REFERENCE)


@query(f"SELECT * FROM {PREPARED_SQL}")
def ml_prepare(t: Tables) -> DataFrame:
    return prepared(t)


@query(f"""SELECT n_chars, label, lang, CAST(dense_rank() OVER (ORDER BY lang DESC) - 1 AS DOUBLE) AS lang_index
           FROM (SELECT label, n_chars / 1000 AS n_chars,
                        CASE WHEN lang = 'en' THEN '000_en' ELSE lang END AS lang FROM {PREPARED_SQL})""")
def ml_index(t: Tables) -> DataFrame:
    """The prefixed reference category gets the highest index."""
    return models.index_categories(training(t), CATEGORICAL)


@query()
def glm_coefficients(t: Tables) -> DataFrame:
    data = training(t)
    return models.coefficient_table(data, models.fit_glm(data, NUMERIC, CATEGORICAL))


# At the fitted values the predictions of every category add up to its labels.
SUMS_SQL = f"""SELECT CASE WHEN lang = 'en' THEN '000_en' ELSE lang END AS lang, count(*) AS n, sum(label) AS labels,
                      true AS predicted FROM {PREPARED_SQL} GROUP BY lang"""


def _sums(scored: DataFrame, prediction: str, part: float) -> DataFrame:
    gap = F.abs(F.sum("label") - F.sum(prediction))
    return scored.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("labels"),
                                      (gap <= F.count(F.lit(1)) * part).alias("predicted"))


@query(SUMS_SQL)
def ml_fit_predict(t: Tables) -> DataFrame:
    data = training(t)
    return _sums(models.score(data, models.fit_glm(data, NUMERIC, CATEGORICAL)), "prediction", 1e-5)


@query(SUMS_SQL)
def ml_save_refit(t: Tables) -> DataFrame:
    """The unfitted chain is saved, read back and fitted again; so is the fitted one, which then predicts the same."""
    data, path = training(t), scratch_path(t.spark, "chain")
    models.save_chain([*models.design_stages(NUMERIC, CATEGORICAL), models.glm_stage()], path)
    models.save_model(models.load_chain(path).fit(data), f"{path}-fitted")
    return _sums(models.score(data, models.load_model(f"{path}-fitted")), "prediction", 1e-5)


@query(SUMS_SQL)
def logit_predict(t: Tables) -> DataFrame:
    return _sums(models.logit_predict(training(t), NUMERIC, CATEGORICAL), "probability", 1e-2)


@query(f"""SELECT label, n_chars, lang, CAST(place - 1 AS DOUBLE) AS lang_index FROM {PREPARED_SQL} JOIN (
             SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) AS place FROM {PREPARED_SQL} GROUP BY lang) USING (lang)""")
def ml_index_frequency(t: Tables) -> DataFrame:
    """The most frequent category gets index 0."""
    return models.index_categories(prepared(t), CATEGORICAL, "frequencyDesc")


@query("""WITH labels AS (SELECT 'lang' AS "column", lang AS label FROM documents
                          UNION ALL SELECT 'source', source FROM documents)
          SELECT "column", label, count(*) AS n,
                 CAST(row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS "index"
          FROM labels WHERE label IS NOT NULL GROUP BY "column", label""")
def ml_dictionary(t: Tables) -> DataFrame:
    return models.category_dictionary(t.documents, ["lang", "source"], "frequencyDesc")


@query("""WITH known AS (SELECT source AS label, dense_rank() OVER (ORDER BY source) - 1 AS place FROM
                         (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE source IS NOT NULL))
          SELECT doc_id, source, CAST(coalesce(place, (SELECT count(*) FROM known)) AS DOUBLE) AS source_index, label AS source_label
          FROM documents LEFT JOIN known ON source = label""")
def ml_encode_decode(t: Tables) -> DataFrame:
    """The dictionary comes from labelled documents and is applied to all; others' sources are kept as unknown."""
    documents = t.documents.select("doc_id", "source")
    labelled = documents.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    dictionary = models.category_dictionary(labelled, ["source"], "alphabetAsc")
    encoded = models.encode_categories(documents, dictionary, ["source"], "keep")
    return models.decode_categories(encoded, dictionary, ["source"])


@query("""SELECT 'lang' AS "column", count(DISTINCT lang) AS n_levels, count(DISTINCT lang) >= 2 AS usable FROM documents
          UNION ALL SELECT 'kind', CAST(1 AS BIGINT), false""")
def ml_low_cardinality(t: Tables) -> DataFrame:
    return models.low_cardinality(t.documents.withColumn("kind", F.lit("text")), ["lang", "kind"])


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
    for a in CORRELATED for b in CORRELATED))
def corr_matrix(t: Tables) -> DataFrame:
    return models.correlation_pairs(t.lineitem, CORRELATED).withColumn("correlation", F.round("correlation", 6))
