"""Documents to packed training sequences: toxicity, language, near copies, benchmark leaks, packing.

Each stage gets the documents that the stage before it kept and returns those
that it keeps, with the same columns; the last one returns the pieces of packed
sequences.  Between stages the documents are written and read again.  A stage
decides on each row that it gets, whatever its doc_id: rows that share one, null
included, stay or go one by one.  Toxicity, language and leaks are judged in the pass that
reads the documents, which shuffles and writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowloom.llm import decontaminate, language, near_copies, packing, toxicity
from rowloom.llm.common import free_name, release, scratch, stored, table
from rowloom.llm.queries import TOKENIZER

#: Texts whose spans are less sure of their languages than this, taken together, go.
LEAST_CERTAINTY = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the classifier chain finds toxic; it learns from the labels of this corpus."""
    chain = toxicity.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, chain)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter or whose languages, one or several, aren't clear."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = language.learn(own.filter(~language.held_out(F.col("doc_id"))), language.TRAIN_ROWS)
    return language.clear_texts(docs, model, LEAST_CERTAINTY)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, five words a shingle, four fifths in common: the smallest doc_id.

    Of several rows with that doc_id the first one stays; a null doc_id comes last.  The
    rows are numbered and written once, so that decisions can name them.
    """
    key = free_name(docs.columns, "_key")
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-keyed", compression="zstd")
    groups = (near_copies.group_copies(keyed.select(F.col(key).alias("doc_id"), "text"), width=5, share=80)
              .select(F.col("doc_id").alias(key), "component_id"))
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.col(key))
    # Names of components are keys, so nothing is null; the groups are summed up before they meet in a task.
    kept = (keyed.select("doc_id", key).join(groups, key).groupBy("component_id").agg(F.min(first).alias("_first"))
            .select(F.col(f"_first.{key}").alias(key)))
    return keyed.join(kept, key, "left_semi").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold ten words of a benchmark item in a row, or a whole shorter one."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All ids of the documents in windows."""
    return packing.pack(docs, TOKENIZER, end_id=1, then=packing.digested, columns=packing.DIGESTS)


STAGES = [("toxicity", drop_toxic), ("language", keep_languages), ("near_copies", drop_copies),
          ("decontamination", drop_leaks), ("packing", pack)]
#: No stage but the benchmark's can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written to the shared folder and read by the next.

    What a stage has written on its way goes as soon as its result is stored, and that goes after the next stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as own:
            result = own.hand_over(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(docs)
        docs = result
    packed = STAGES[-1][1](spark, docs, sf_dir)
    release(docs)  # packing has written all ids
    return packed
