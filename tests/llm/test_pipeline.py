import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from rowloom.llm import decontaminate, language, near_copies, toxicity
from rowloom.llm.common import table


def test_stages_keep_columns_and_decisions_take_effect(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = table(spark, folder, "documents")
    rejected = {"toxicity": lambda d: [r.doc_id for r in toxicity.score(d, toxicity.learn(d, table(spark, folder, "labels"))).collect() if r.rejected],
                "language": lambda d: [r.doc_id for r in language.identify(d).collect()
                                       if r.lang_pred == "und" or r.certainty < corpus_pipeline.LEAST_CERTAINTY],
                "near_copies": lambda d: [r.doc_id for r in near_copies.group_copies(d, 5, 80).collect() if r.doc_id != r.component_id],
                "decontamination": lambda d: [r.doc_id for r in decontaminate.matches(d, table(spark, folder, "benchmark")).collect() if r.n_hit]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.cache()
        docs = stage(spark, before, folder).cache()
        assert docs.columns == before.columns
        kept, all_ids = {r.doc_id for r in docs.select("doc_id").collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        gone = set(rejected[name](before))
        assert kept == all_ids - gone
        assert len(gone) < 0.3 * len(all_ids) and (gone or name == "language")
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == kept


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, _key string, rejected array<int>"
    rows = [(None, None, None, None, None, 1.0, "x", [1]), (1, "", "en", "a", 0, 1.0, None, None), (2, "some words of a text", "en", "a", 3, 1.0, "y", []),
            (2, "some words of a text", "en", "a", 3, 1.0, "y", []), (3, "other words", None, "b", 1, None, "z", [None])]
    for own in (rows, []):
        docs = spark.createDataFrame(own, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "_key", "rejected"], name
            assert {tuple(r) for r in docs.select("doc_id", "_key").collect()} <= {(r[0], r[6]) for r in own}, name
        assert bool(corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()) == bool(own)


def test_run_ends_in_packed_pieces(spark):
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_rows_that_share_an_id_are_judged_one_by_one(spark, monkeypatch):
    def judge(make):
        def compute(batches):
            for batch in batches:
                yield make([t is not None and t.startswith("bad") for t in batch["text"].to_pylist()])
        return lambda *args: compute

    monkeypatch.setattr(toxicity, "learn", lambda docs, labels: None)
    monkeypatch.setattr(toxicity, "predictor", judge(lambda bad: pa.RecordBatch.from_pydict({"rejected": bad})))
    monkeypatch.setattr(language, "learn", lambda docs, limit: None)
    monkeypatch.setattr(language, "labeler", judge(lambda bad: pa.RecordBatch.from_pydict(
        {"lang_pred": ["en"] * len(bad), "certainty": [0.0 if b else 1.0 for b in bad]})))
    item = max((r.text for r in table(spark, SMALL, "benchmark").collect() if r.text), key=len)
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def kept(stage, rows):
        docs = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], schema).repartition(3)
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in got.collect()), key=str)

    for stage, text in ((corpus_pipeline.drop_toxic, "bad words"), (corpus_pipeline.keep_languages, "bad words"),
                        (corpus_pipeline.drop_leaks, f"bad {item}")):
        clean = [(None, "good one"), (None, "another good one"), (7, "a third good one")]
        assert kept(stage, [*clean, (None, text), (7, text), (8, text)]) == sorted(clean, key=str), stage
    long = "one two three four five six seven eight nine ten"
    rows = [(5, long), (5, long), (3, long + " eleven"), (None, long), (None, "x y z"), (None, "x y z"), (2, "p q"), (2, "r s")]
    assert kept(corpus_pipeline.drop_copies, rows) == sorted([(3, long + " eleven"), (None, "x y z"), (2, "p q"), (2, "r s")], key=str)


def test_sure_texts_in_several_languages_stay(spark):
    docs = table(spark, SMALL.replace("0.001", "0.01"), "documents").filter("lang is not null")
    longest = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    three = " ".join(longest[lang][:2_000] for lang in sorted(longest)[:3])
    mixed = spark.createDataFrame([(10**6, three, None, "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_languages(spark, docs.select(mixed.columns).unionByName(mixed), SMALL)
    assert kept.filter("doc_id = 1000000").count() == 1


def test_a_run_leaves_only_what_its_result_reads(spark):
    from rowloom.session import scratch
    with scratch(spark) as own:
        packed = corpus_pipeline.run(spark, SMALL)
        left = spark.sql(f"SHOW TABLES IN {own.database}").count()
        assert packed.count() > 0 and left == 1  # the token ids
