"""Generalised-linear-model operators on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from rowloom.operators.joins import join_back
from rowloom.operators.layout import free_name
from rowloom.operators.skew import MAX_GROUP_ROWS
from rowloom.operators.windows import ranked
from rowloom.session import stored

# Prefix that puts a category last in alphabetDesc order, and the
# normal quantile of the 95 % interval.
REFERENCE_PREFIX = "000_"
OTHER_PREFIX = "001_"  # for categories that sort before the reference all the same
Z_95 = 1.96


def prepare(df: DataFrame, target: Column, numeric: Sequence[str], categorical: Sequence[str],
            label: str = "label") -> DataFrame:
    """M1: 0/1 target, numeric predictors as doubles, categories as strings; rows with a null, target included, go."""
    return df.select(target.cast("double").alias(label),
                     *[F.col(c).cast("double").alias(c) for c in numeric],
                     *[F.col(c).cast("string").alias(c) for c in categorical]).dropna()


def set_reference(df: DataFrame, reference: Mapping[str, str]) -> DataFrame:
    """M2: prefix each reference category so that it sorts below all others and encoding drops it.

    Other categories get a prefix too if they would sort before it.
    """
    def named(c: str, value: str) -> Column:
        own, other = F.lit(REFERENCE_PREFIX + value), F.col(c)
        return F.when(other == value, own).when(other <= own, F.concat(F.lit(OTHER_PREFIX), other)).otherwise(other)

    return df.withColumns({c: named(c, value) for c, value in reference.items()})


#: How labels are ordered, as ``StringIndexer`` names it: by rows or by label, from which end.
ORDERS = ("frequencyDesc", "frequencyAsc", "alphabetDesc", "alphabetAsc")


def category_dictionary(df: DataFrame, columns: Sequence[str], order: str = "alphabetDesc",
                        max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """M2: (column, label, n, index): every label of the columns, numbered from 0 per column; a written table.

    Labels are texts, counted in one pass over all columns and combined before the shuffle.  With more
    than ``max_rows`` labels in a column they are ranked in slices, so no task and not the driver sees all of
    them.  Labels with equally many rows are in alphabetical order.  Nulls are no labels; an empty frame gives an empty table.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {', '.join(ORDERS)}")
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label")) for c in columns])
    counts = (df.select(F.inline(values)).filter(F.col("label").isNotNull())
              .groupBy("column", "label").agg(F.count(F.lit(1)).alias("n")))
    if max_rows is not None:
        counts = stored(counts, "labels")
    descending = order.endswith("Desc")
    if order.startswith("alphabet"):
        found = ranked(counts, ["column"], "label", "label", descending, max_rows)
    else:
        placed = counts.withColumn("_by", -F.col("n") if descending else F.col("n"))
        found = ranked(placed, ["column"], "_by", "label", False, max_rows)
    return stored(found.select("column", "label", "n", (F.col("row_number") - 1).cast("double").alias("index")), "dictionary")


def encode_categories(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], unknown: str = "error",
                      max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """M2: ``<column>_index`` by a dictionary, also one of other rows.

    Labels that the dictionary lacks, nulls too, stop the job (``error``), lose their row (``skip``) or get the
    number of labels as index (``keep``).  The dictionary is joined: Spark broadcasts it if its stored size allows, and hot labels are
    spread over tasks if it doesn't.
    """
    if unknown not in ("error", "skip", "keep"):
        raise ValueError("unknown must be error, skip or keep")
    for c in columns:
        name = f"{c}_index"
        own = dictionary.filter(F.col("column") == c)
        label = free_name(df.columns, "_label")
        texts = own.select(F.col("label").alias(label), F.col("index").alias(name))
        found = join_back(df.withColumn(label, F.col(f"`{c}`").cast("string")), texts, [label], [name], max_rows)
        if unknown == "error":
            bad = F.raise_error(F.concat(F.lit(f"{c} has a label that is not in the dictionary: "), F.coalesce(label, F.lit("null"))))
            found = found.withColumn(name, F.when(F.col(name).isNull(), bad.cast("double")).otherwise(F.col(name)))
        elif unknown == "keep":
            size = own.agg(F.count(F.lit(1)).cast("double")).scalar()
            found = found.withColumn(name, F.coalesce(F.col(name), size))
        else:
            found = found.filter(F.col(name).isNotNull())
        df = found.drop(label)
    return df


def decode_categories(df: DataFrame, dictionary: DataFrame, columns: Sequence[str],
                      max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """M2: ``<column>_label`` from ``<column>_index``; null for an index that the dictionary lacks."""
    for c in columns:
        labels = dictionary.filter(F.col("column") == c).select(
            F.col("index").alias(f"{c}_index"), F.col("label").alias(f"{c}_label"))
        df = join_back(df, labels, [f"{c}_index"], [f"{c}_label"], max_rows)
    return df


def index_categories(df: DataFrame, columns: Sequence[str], order: str = "alphabetDesc",
                     max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """M2: ``<column>_index`` with 0 for the first category in the given order; a null category is an error."""
    return encode_categories(df, category_dictionary(df, columns, order, max_rows), columns, max_rows=max_rows)


def low_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M7: distinct values per column, one row each, marked usable with two or more.

    One level makes one-hot encoding fail and the design singular.
    """
    levels = (df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
                                         for c in columns])))
              .groupBy("column", "level").agg(F.lit(1).alias("_one")))  # combined per task: few rows are shuffled
    return (levels.groupBy("column").agg(F.count("level").alias("n_levels"))
            .withColumn("usable", F.col("n_levels") >= 2))


def design_stages(numeric: Sequence[str], categorical: Sequence[str], order: str = "alphabetDesc") -> list:
    """M2-M4: index, encode (last category dropped), assemble into ``features``."""
    stages, inputs = [], list(numeric)
    if categorical:
        indexed, encoded = [f"{c}_index" for c in categorical], [f"{c}_vec" for c in categorical]
        stages = [StringIndexer(inputCols=list(categorical), outputCols=indexed, stringOrderType=order),
                  OneHotEncoder(inputCols=indexed, outputCols=encoded)]
        inputs += encoded
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def glm_stage(label: str = "label") -> GeneralizedLinearRegression:
    """M5: binomial family, logit link."""
    return GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label, featuresCol="features")


def fit_glm(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "label",
            order: str = "alphabetDesc") -> PipelineModel:
    """M9: the whole chain as one fitted model; training data is passed over, not collected."""
    return Pipeline(stages=[*design_stages(numeric, categorical, order), glm_stage(label)]).fit(df)


def feature_names(scored: DataFrame, features: str = "features") -> list[str]:
    """Names by position from the vector's attribute metadata."""
    groups = scored.schema[features].metadata["ml_attr"]["attrs"].values()
    found = sorted((attr["idx"], attr["name"]) for group in groups for attr in group)
    return [name for _, name in found]


def coefficient_table(df: DataFrame, fitted: PipelineModel) -> DataFrame:
    """M6: name, coefficient, standard error, t, p and 95 % interval, intercept first.

    The table has one row per feature; Spark's own summary holds it on the driver.
    """
    model: GeneralizedLinearRegressionModel = fitted.stages[-1]
    summary = model.summary
    names = feature_names(fitted.transform(df.limit(0)))
    # Spark lists the intercept last in the error, t and p lists.
    lists = zip([*names, "intercept"], [*map(float, model.coefficients), float(model.intercept)],
                summary.coefficientStandardErrors, summary.tValues, summary.pValues)
    rows = list(lists)
    rows = [rows[-1], *rows[:-1]]
    table = df.sparkSession.createDataFrame(
        rows, "name string, coefficient double, std_error double, t_value double, p_value double")
    return (table.withColumn("lower_ci", F.col("coefficient") - Z_95 * F.col("std_error"))
            .withColumn("upper_ci", F.col("coefficient") + Z_95 * F.col("std_error")))


def score(df: DataFrame, fitted: PipelineModel, name: str = "prediction") -> DataFrame:
    """M9: the fitted probability on every row; lazy and narrow."""
    return fitted.transform(df).select(*df.columns, F.col("prediction").alias(name))


def save_model(fitted: PipelineModel, path: str) -> None:
    """Write, replacing an earlier model at that path."""
    fitted.write().overwrite().save(path)


def save_chain(stages: Sequence, path: str) -> None:
    """Write an unfitted chain of stages."""
    Pipeline(stages=list(stages)).write().overwrite().save(path)


def load_chain(path: str) -> Pipeline:
    """An unfitted chain, to be fitted again."""
    return Pipeline.load(path)


def load_model(path: str) -> PipelineModel:
    """Read a fitted chain back."""
    return PipelineModel.load(path)


def logit_predict(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  label: str = "label") -> DataFrame:
    """Unregularised logistic classifier; probability and class per row."""
    model = LogisticRegression(regParam=0.0, labelCol=label, featuresCol="features")
    fitted = Pipeline(stages=[*design_stages(numeric, categorical), model]).fit(df)
    return fitted.transform(df).select(*df.columns, vector_to_array("probability")[1].alias("probability"),
                                       F.col("prediction"))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M8: Pearson correlation of every pair of columns, in long form, in one pass."""
    pairs = [(a, b) for a in columns for b in columns]
    once = sorted({tuple(sorted(p)) for p in pairs})
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in once])
    rows = F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                              F.col("`" + "|".join(sorted((a, b))) + "`").alias("correlation"))
                     for a, b in pairs])
    return wide.select(F.inline(rows))
