import itertools
import zlib

import numpy as np
import pytest

from conftest import SMALL
from rowloom.llm import language
from rowloom.llm.queries import op2_language


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_is_the_best_path(seed):
    draw = np.random.default_rng(seed)
    scores = [draw.normal(size=(n, 3)).astype(np.float32) * 3 for n in (1, 5, 3, 6)]
    for own, path in zip(scores, language.viterbi(scores, 2.0)):
        def value(p):
            return sum(own[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(path) == pytest.approx(max(map(value, itertools.product(range(3), repeat=len(own)))), abs=1e-4)


def test_grams_stay_in_their_word():
    alone = [sorted(language.grams_of([w])[0].tolist()) for w in ("ab", "größe", "x")]
    bucket, owner = language.grams_of(["ab", "größe", "x"])
    assert [sorted(bucket[owner == i].tolist()) for i in range(3)] == alone


TRAIN = [("el", "καλημέρα σε όλους τους φίλους μας"), ("ru", "доброе утро всем нашим друзьям"),
         ("en", "good morning to all of our friends and the others"), ("de", "guten morgen an alle unsere freunde und die anderen")]


def frame(spark, extra=()):
    ids = [i for i in range(1_000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, *TRAIN[i % 4][::-1]) for i in ids[:80]] + list(extra)
    return spark.createDataFrame([(i, t, l, 1.0) for i, t, l in rows], "doc_id long, text string, lang string, score double")


def test_spans_scripts_and_odd_texts(spark):
    mixed = "good morning to all of our friends guten morgen an alle unsere freunde und die anderen freunde"
    extra = [(2_000, None, "en"), (2_001, "", "en"), (2_002, "12 34² ½ ⅷ !!", "de"), (2_003, "φίλους", None), (2_004, mixed, None),
             (2_005, "日本語", None), (2_006, "the friends " * 20_000, None), (None, "unsere freunde", None), (2_004, mixed, None)]
    got = {}
    for r in language.identify(frame(spark, extra)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [(got[i][0].lang_pred, got[i][0].score) for i in (2_000, 2_001, 2_002)] == [("und", 0.0)] * 3
    assert got[2_003][0].lang_pred == "el" and got[2_006][0].lang_pred == "en" and got[None][0].lang_pred == "de"
    assert got[2_005][0].lang_pred in {"el", "ru", "en", "de"}
    assert len(got[2_004]) == 2
    for r in got[2_004]:
        assert [(s.lang, s.first_word, s.words) for s in r.spans] == [("en", 0, 7), ("de", 7, 10)]
    assert all(0 <= r.score <= 1 and r.held_out == (i is None or zlib.crc32(str(i).encode()) % 4 == 2)
               for i, rs in got.items() for r in rs)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(docs).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0)).collect() == []


def test_held_out_rows_teach_nothing(spark):
    out = [i for i in range(3_000, 4_000) if zlib.crc32(str(i).encode()) % 4 == 2][:50]
    extra = [(i, "zyx wvu tsr", "xx") for i in out]
    assert {r.lang_pred for r in language.identify(frame(spark, extra)).collect()} == {"el", "ru", "en", "de"}


def test_query_on_held_out_documents(spark, tables):
    langs = {r.doc_id: r.lang for r in tables.documents.collect()}
    rows = [r for r in op2_language(spark, SMALL).collect() if r.held_out]
    assert len(rows) > 20
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.95 * len(rows)
