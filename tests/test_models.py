"""Models against a plain numpy fit."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from helpers import rows
from rowloom.operators import models, setops
from rowloom.plans.modelling import CATEGORICAL, NUMERIC, training


def irls(x, y, steps=50):
    """Logistic regression by iteratively reweighted least squares: coefficients and errors."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        mu = 1 / (1 + np.exp(-x @ beta))
        information = x.T @ (x * (mu * (1 - mu))[:, None])
        beta = beta + np.linalg.solve(information, x.T @ (y - mu))
    return beta, np.sqrt(np.diag(np.linalg.inv(information)))


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(0)
    size, kind = r.normal(size=600), r.choice(["a", "b", "c"], size=600)
    chance = 1 / (1 + np.exp(-(0.3 + 0.8 * size - 0.9 * (kind == "b") + 0.4 * (kind == "c"))))
    label = (r.random(600) < chance).astype(float)
    rows = [(float(v), float(s), str(k)) for v, s, k in zip(label, size, kind)]
    df = spark.createDataFrame(rows, "label double, size double, kind string")
    return models.set_reference(df, {"kind": "a"}).persist(), label, size, kind


def test_coefficients_match_irls(data):
    df, label, size, kind = data
    x = np.column_stack([np.ones(600), size, kind == "b", kind == "c"]).astype(float)
    beta, error = irls(x, label)
    table = {r["name"]: r for r in models.coefficient_table(df, models.fit_glm(df, ["size"], ["kind"])).collect()}
    for i, name in enumerate(["intercept", "size", "kind_vec_b", "kind_vec_c"]):
        row = table[name]
        assert row["coefficient"] == pytest.approx(beta[i], abs=1e-5)
        assert row["std_error"] == pytest.approx(error[i], abs=1e-5)
        assert row["t_value"] == pytest.approx(beta[i] / error[i], abs=1e-3)
        assert row["upper_ci"] - row["lower_ci"] == pytest.approx(2 * 1.96 * error[i], abs=1e-4)
        assert 0 <= row["p_value"] <= 1
    assert len(table) == 4


def test_classifier_agrees_with_glm(data):
    df = data[0].withColumn("id", F.monotonically_increasing_id()).persist()
    glm = models.score(df, models.fit_glm(df, ["size"], ["kind"])).select("id", "prediction")
    logit = models.logit_predict(df, ["size"], ["kind"]).select("id", "probability")
    gap = glm.join(logit, "id").agg(F.max(F.abs(F.col("prediction") - F.col("probability")))).first()[0]
    assert gap < 1e-3


def test_model_survives_saving(spark, tables, tmp_path):
    data = training(tables)
    fitted = models.fit_glm(data, NUMERIC, CATEGORICAL)
    models.save_model(fitted, str(tmp_path / "model"))
    models.save_model(fitted, str(tmp_path / "model"))
    again = models.load_model(str(tmp_path / "model"))
    assert setops.frames_equal(models.score(data, fitted), models.score(data, again))


def test_refit_on_a_sample(tables):
    data = training(tables).sample(False, 0.8, 1)
    assert models.score(data, models.fit_glm(data, NUMERIC, [])).count() == data.count()


def test_reference_category_is_last(data):
    indexed = models.index_categories(data[0], ["kind"])
    assert {r["kind"]: r["kind_index"] for r in indexed.select("kind", "kind_index").distinct().collect()} == {
        "c": 0.0, "b": 1.0, "000_a": 2.0}


def test_frequency_order(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",)], "k string")
    indexed = models.index_categories(df, ["k"], "frequencyDesc").distinct().collect()
    assert {r["k"]: r["k_index"] for r in indexed} == {"y": 0.0, "x": 1.0}


@pytest.mark.parametrize("order", models.ORDERS)
@pytest.mark.parametrize("max_rows", [2, 1_000])
def test_dictionary_orders_as_the_indexer_of_spark(spark, order, max_rows):
    df = spark.createDataFrame([(c,) for c in "bbbccaad"], "k string")
    got = models.index_categories(df, ["k"], order, max_rows)
    want = StringIndexer(inputCol="k", outputCol="k_index", stringOrderType=order).fit(df).transform(df)
    assert rows(got) == rows(want)
    table = models.category_dictionary(df, ["k"], order, max_rows).orderBy("index").collect()
    assert [r["label"] for r in table] == sorted(set("abcd"), key=lambda c: dict(rows(want))[c])


def test_dictionary_with_more_labels_than_a_task_holds(spark):
    """10,000 labels with at most 500 in a slice, one label with a third of the rows."""
    df = spark.range(15_000).select(F.when(F.col("id") < 10_000, F.format_string("label %05d", "id")).otherwise("hot").alias("k"),
                                    (F.col("id") % 3).alias("j"))
    dictionary = models.category_dictionary(df, ["k", "j"], "alphabetAsc", max_rows=500)
    found = {(r["column"], r["label"]): (r["n"], r["index"]) for r in dictionary.collect()}
    assert len(found) == 10_004 and found["k", "hot"] == (5_000, 0.0) and found["k", "label 09999"] == (1, 10_000.0)
    assert [found["j", str(i)] for i in range(3)] == [(5_000, 0.0), (5_000, 1.0), (5_000, 2.0)]
    encoded = models.encode_categories(df, dictionary, ["k", "j"], max_rows=500)
    decoded = models.decode_categories(encoded, dictionary, ["k", "j"], max_rows=500)
    assert decoded.count() == 15_000
    assert decoded.filter((F.col("k") != F.col("k_label")) | (F.col("j").cast("string") != F.col("j_label"))
                          | F.col("k_label").isNull() | F.col("j_label").isNull()).isEmpty()


def test_unknown_labels(spark):
    dictionary = models.category_dictionary(spark.createDataFrame([("x",), ("y",), (None,)], "k string"), ["k"])
    df = spark.createDataFrame([("x", 1), ("z", 2), (None, 3)], "k string, _label int")
    kept = models.encode_categories(df, dictionary, ["k"], "keep")
    assert rows(kept, "_label", "k_index") == [(1, 1.0), (2, 2.0), (3, 2.0)]
    assert rows(models.encode_categories(df, dictionary, ["k"], "skip"), "_label", "k_index") == [(1, 1.0)]
    with pytest.raises(Exception, match="not in the dictionary: z"):
        models.encode_categories(df.filter("k = 'z'"), dictionary, ["k"]).collect()
    decoded = models.decode_categories(kept, dictionary, ["k"])
    assert rows(decoded, "_label", "k_label") == [(1, "x"), (2, None), (3, None)]
    with pytest.raises(ValueError):
        models.category_dictionary(df, ["k"], "byLength")


def test_dictionary_of_nothing(spark):
    df = spark.createDataFrame([], "k string")
    assert models.index_categories(df, ["k"]).collect() == []


def test_low_cardinality(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "b")], "one string, two string")
    got = {r["column"]: (r["n_levels"], r["usable"]) for r in models.low_cardinality(df, ["one", "two"]).collect()}
    assert got == {"one": (1, False), "two": (2, True)}


def test_correlation(spark):
    df = spark.createDataFrame([(float(i), float(-2 * i), float(i * i)) for i in range(10)], "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in models.correlation_pairs(df, ["b", "a", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(-1) and got["b", "a"] == pytest.approx(-1)
    assert got["a", "c"] == pytest.approx(np.corrcoef(range(10), [i * i for i in range(10)])[0, 1])
    assert len(got) == 9
