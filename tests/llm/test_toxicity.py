import random
import tracemalloc

import numpy as np

from conftest import SMALL
from rowloom.llm import toxicity
from rowloom.llm.queries import op6_toxicity

WORDS = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]


def made_up(spark, n=600):
    draw, docs, labels = random.Random(1), [], []
    for i in range(n):
        words = draw.choices(WORDS, k=40)
        rude, bad = draw.random() < 0.3, draw.random() < 0.2
        if rude:
            words[3] = draw.choice(["bloop", "zark"])
        if bad:
            words[7] = "grumf" + draw.choice("abcdefghij") + draw.choice("xyz")
        docs.append((i, " ".join(words), int(rude)))
        if i < n // 2:
            labels.append((i, int(rude), int(rude and bad) if i % 10 else None, "x"))
    return (spark.createDataFrame(docs, "doc_id long, text string, p_toxic int"),
            spark.createDataFrame(labels, "doc_id long, rude int, toxic int, text string"), docs)


def test_chain_learns_from_earlier_categories(spark):
    docs, labels, rows = made_up(spark)
    chain = toxicity.learn(docs, labels, ("rude", "toxic"))
    got = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    unseen = [(got[i], t, rude) for i, t, rude in rows if i >= 300]
    assert all((r.p_rude > 0.5) == bool(rude) for r, _, rude in unseen)
    right = [r.rejected == bool(rude and "grumf" in t) for r, t, rude in unseen]
    assert sum(right) >= 0.97 * len(right)
    assert chain.others[1][0] > 0.5  # the later model uses the earlier probability
    assert {w for w in chain.words if w.startswith(b"word") and not w.endswith(b"*")} == set()


def test_out_of_fold_predictions_are_unsure():
    features = [np.array([i], np.int64) for i in range(40)] + [np.array([99], np.int64)] * 40
    labels = np.array([[float(i % 2), float(i % 2)] for i in range(80)])
    known, models = toxicity.fit_chain(features, labels, np.arange(80) % 3)
    assert known.tolist() == [99]
    assert abs(models[1][1][0]) < 1.0  # the first category can't be predicted, so it is little use


def test_odd_rows(spark):
    docs, labels, _ = made_up(spark, 200)
    extra = spark.createDataFrame([(900, None, 0), (901, "", 0), (902, "bloop grumfax " * 30_000, 0), (None, "bloop grumfax", 0),
                                   (5, "again", 0), (5, "again", 0)], "doc_id long, text string, p_toxic int")
    more = spark.createDataFrame([(None, 1, 1, "x"), (900, 1, 1, "x"), (7_777, 1, 1, "x"), (5, 0, 0, "x"), (5, None, None, "x")], labels.schema)
    every = docs.unionByName(extra)
    chain = toxicity.learn(every, labels.unionByName(more), ("rude", "toxic"))
    got = toxicity.score(every, chain).collect()
    assert len(got) == 206
    by_id = {r.doc_id: r for r in got if r.doc_id != 5}
    assert not by_id[900].rejected and not by_id[901].rejected
    assert by_id[902].rejected and by_id[None].rejected


def test_empty_tables(spark):
    docs, labels, _ = made_up(spark, 20)
    assert not any(r.rejected for r in toxicity.score(docs, toxicity.learn(docs, labels.limit(0), ("rude", "toxic"))).collect())
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), labels, ("rude", "toxic"))).collect() == []


def test_query_follows_the_labels(spark, tables):
    got = {r.doc_id: r.toxic for r in op6_toxicity(spark, SMALL.replace("0.001", "0.01")).collect()}
    labels = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/labels.parquet").collect()
    toxic, clean = [got[r.doc_id] for r in labels if r.toxic], [got[r.doc_id] for r in labels if not r.toxic]
    assert sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_rare_features_take_no_room():
    draw = np.random.default_rng(3)
    features = [np.unique(np.r_[draw.integers(-40, 40, 20), draw.integers(-2**62, 2**62, 5_000)]) for _ in range(200)]
    features += [np.empty(0, np.int64)]
    known, count = np.unique(np.concatenate(features), return_counts=True)
    known = known[count >= toxicity.LEAST_TEXTS]
    tracemalloc.start()
    x = toxicity.numbered(features, toxicity.frequent(features))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert toxicity.frequent(features).tolist() == known.tolist() and (x.rows, x.features) == (201, len(known))
    got = [known[x.feature[x.row == r]].tolist() for r in range(201)]
    assert got == [f[np.isin(f, known)].tolist() for f in features]
    assert peak < 4 * sum(f.nbytes for f in features)
    assert toxicity.frequent([]).tolist() == [] and toxicity.fit_chain([], np.empty((0, 2)), np.empty(0))[0].tolist() == []
