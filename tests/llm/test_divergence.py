"""Joint tables against counting, and the audit against its definition in plain Python."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=3, top=200):
    """Straight from the definition, term by term."""
    found = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in docs]
    result = []
    for lang in {d[0] for d in found}:
        own = [d for d in found if d[0] == lang]
        seen = Counter(t for _, _, words in own for t in set(words))
        kept = [t for t in seen if seen[t] >= least]
        count = defaultdict(Counter)
        for _, source, words in own:
            count[source].update(w for w in words if seen[w] >= least)
        whole = sum(count.values(), Counter())

        def prices(counts):
            total = sum(counts.values())
            return {t: 1 + floor(Fraction(10**9 * (counts[t] + 1), total + len(kept))) for t in kept}

        p, all_p = {s: prices(c) for s, c in count.items()}, prices(whole)
        for s in count:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in count if o != s]
            terms = [(t, (p[s][t] - all_p[t]) ** 2 // all_p[t]) for t in kept if count[s][t] and p[s][t] > all_p[t]]
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (item, value) in enumerate(sorted(values, key=lambda v: (-v[1], v[0].encode()))[:most], 1):
                    result.append((lang, s, part, item, value, rank))
    return sorted(result)


def shown(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def made(n=400):
    r = random.Random(4)
    words = [f"Word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)] + ["é", "Éa", "the", "THE", "x1y"]
    docs = [(" ".join(r.choices(words, weights=[1 / (1 + (i + k) % 50) for i in range(105)], k=r.randrange(0, 80))), lang,
             f"s{r.randrange(6) if r.random() < .6 else 0}") for k in range(n) for lang in [r.choice(["en", "fr", None])]]
    return docs + [(None, "en", "empty"), ("", "en", None), ("the", "en", ""), ("alone word", "xx", "one"), ("alone word", "xx", "two"),
                   ("only only only", "yy", "one")] + [("copy of the copy", "zz", "one")] * 3 + [("\x00copy\x7fof9the", "zz", "two")] * 2


@pytest.mark.parametrize("least, top", [(3, 200), (1, 5), (10_000, 200)])
def test_audit_against_plain(spark, least, top):
    docs = made()
    frame = spark.createDataFrame(docs, "text string, lang string, source string").withColumn("n", F.lit("own")).repartition(7)
    assert shown(divergence.audit(frame, least, top)) == plain(docs, least, top)


def test_small_blocks_give_the_same(spark, monkeypatch):
    docs = made(150)
    frame = spark.createDataFrame(docs, "text string, lang string, source string").repartition(3)
    joint, counted = divergence.joint_tables, divergence.count_terms
    monkeypatch.setattr(divergence, "joint_tables", lambda terms: joint(terms, block_rows=20, block_cells=90, width=7))
    monkeypatch.setattr(divergence, "count_terms", lambda docs: counted(docs, held=30))
    assert shown(divergence.audit(frame)) == plain(docs)


def test_joint_levels_count_pairs():
    rng = np.random.default_rng(1)
    counts = rng.poisson(rng.pareto(1.2, 3_000)[:, None] * np.array([4, 1, 1, .2]))
    term, source = np.nonzero(counts)
    level = counts[term, source]
    starts = np.concatenate(([0], np.cumsum((counts > 0).sum(1))))
    got = Counter()
    for a, x, b, y, n in divergence.joint_levels(counts.sum(1), starts, source, level, 100):
        for key in zip(a.tolist(), x.tolist(), b.tolist(), y.tolist(), n.tolist()):
            got[key[:4]] += key[4]
    want = Counter((i, int(row[i]), k, int(row[k])) for row in counts for i in range(4) for k in range(i + 1, 4) if row[i] and row[k])
    assert got == want


def test_prices_beyond_longs(spark):
    df = spark.createDataFrame([(0, 5, 0), (10**12, 10**13, 7), (9 * 10**9, 10**10, 1), (3, 10, 4)], "n long, total long, kinds long")
    found = [r[0] for r in df.select(divergence.price(F.col("n"), F.col("total"), F.col("kinds"))).collect()]
    assert found == [1] + [1 + 10**9 * (n + 1) // (t + v) for n, t, v in [(10**12, 10**13, 7), (9 * 10**9, 10**10, 1), (3, 10, 4)]]


def test_long_texts_repeats_and_empty_tables(spark):
    frame = spark.range(6).select(F.repeat(F.lit("many words in a text "), 120_000).alias("text"), F.lit("en").alias("lang"),
                                  F.concat(F.lit("s"), F.col("id") % 2).alias("source"))
    small = [("many words in a text " * 120_000, "en", f"s{i % 2}") for i in range(6)]
    assert shown(divergence.audit(frame)) == plain(small)
    assert shown(divergence.audit(frame.limit(0))) == []
