import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from rowloom.llm import suffix_tree
from rowloom.llm.queries import op4_suffix_tree
from rowloom.session import Scratch


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute_base(rows, held):
    counts = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (doc_id, text), h in zip(rows, held):
        own = tokens_of(text)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        out.append((doc_id, h, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)))
    return sorted(out, key=str)


def base_of(got):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str)


ROWS = [(i, "The cat sat on THE mat " + "and then " * (i % 7)) for i in range(60)] + [
    (100, None), (101, ""), (102, "über naïve\x0bcafé\x1cx"), (103, "zzz " * 30_000), (104, "q" * 3_000), (5, "the cat"), (5, "the cat")]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, d % 3 == 0 if d is not None else None, 1.5) for d, t in rows],
                                 "doc_id long, text string, test boolean, score double").repartition(3)


@pytest.mark.parametrize("buckets", [1, 7])
def test_counts_and_base(spark, buckets):
    held = [d % 3 == 0 for d, _ in ROWS]
    got = suffix_tree.score(frame(spark, ROWS), F.col("test"), buckets=buckets, answered=1).collect()
    assert base_of(got) == brute_base(ROWS, held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_no_training_rows_and_null_ids(spark):
    rows = [(None, "a b"), (3, "c")]
    got = suffix_tree.score(frame(spark, rows), F.col("test")).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.held_out) for r in got} == {(None, 3, 0, 0, True), (3, 2, 0, 0, True)}
    assert suffix_tree.score(frame(spark, rows).limit(0), F.col("test")).collect() == []


def tree_of(words, gain=0.5, depth=3):
    """A tree grown in this process."""
    words = {**words, suffix_tree.END: 4}
    tree, listed = suffix_tree.SuffixTree(), list(words)
    for level in range(depth + 1):
        joined, since, weight = suffix_tree._bytes_of(listed, np.array([words[w] for w in listed]))
        at = np.flatnonzero(since >= level)
        pair, inverse = np.unique(suffix_tree._contexts(joined, level)[at] * 256 + joined[1:][at], return_inverse=True)
        n = np.bincount(inverse, weights=weight[at])
        keep = suffix_tree.diverging(tree, level, pair >> 8, pair & 255, n, gain) if level > 1 else np.ones(len(pair), bool)
        tree.add(pair[keep] >> 8, pair[keep] & 255, n[keep])
    return tree


def test_probabilities_of_all_short_words_add_up():
    tree = tree_of({b"ab": 5, b"abc": 2, b"b": 9, b"cab": 1})
    # After any context the next bytes add up to one.
    for context in (b" ", b" a", b" ab", b" ca", b"zz"):
        total = sum(tree.next_byte(np.frombuffer(context + bytes([s]), np.uint8), np.arange(1, len(context) + 1))[-1]
                    for s in range(256))
        assert total == pytest.approx(1)
    words = [bytes(w) for n in (1, 2) for w in itertools.product(b"abc", repeat=n)]
    assert 0.5 < sum(np.exp(tree.words([*words, suffix_tree.END]))) < 1


def test_contexts_that_do_not_diverge_are_left_out():
    draw = np.random.default_rng(0)
    words = Counter(bytes(draw.choice(list(b"ab"), 6)) for _ in range(2_000))
    assert len(tree_of(words, gain=40.0).levels[2][0]) < len(tree_of(words, gain=-1e9).levels[2][0])


def test_states_carry_the_last_frequent_word():
    tokens, lengths = np.array([0, 5, 6, 1, 7, 2, 5, 2, 2]), np.array([6, 2, 1])
    assert suffix_tree._states(tokens, lengths, np.array([1, 2, 0, 0, 0, 0, 0, 0])).tolist() == [0, 1, 1, 1, 2, 2, 0, 0, 0]


def test_word_probabilities_add_up_after_every_state(spark):
    """Over all words that can follow, what the tree spells included."""
    rows = [(i, ["the cat sat the dog", "le chat le chien sat", "the cat le"][i % 3]) for i in range(1, 90) if i % 3 or i % 2]
    docs = frame(spark, [(d * 3 + 1, t) for d, t in rows])
    plain = docs.select("doc_id", "text", F.lit(False).alias("held_out"))
    frequent = suffix_tree.frequent_words(plain, 0.1)
    assert {b"the", b"le"} <= set(frequent)
    words = suffix_tree.count_words(suffix_tree.blocks_of(plain, 3, frequent))
    states = suffix_tree.States.of(words, len(frequent) + 1, 0.5)
    assert states.kept.any()
    found = suffix_tree._combined(words.toPandas())
    spelled = np.log(np.full(len(found["words"]), 1e-3))  # the rest, 1 - this, is left to other words
    single = states.words(found["counts"], spelled)
    rest = np.log(1 - 1e-3 * len(found["words"]))
    other = states.words(np.array([0]), np.array([rest]))[0]
    assert np.exp(single).sum() + np.exp(other) == pytest.approx(1)
    pairs = dict(zip(found["pair"].tolist(), found["pair_counts"].tolist()))
    for state in np.flatnonzero(states.kept):
        counts = np.array([pairs.get(w << 16 | int(state), 0) for w in range(len(single))])
        total = np.exp(states.after(np.full(len(single), state), counts, single)).sum()
        assert total + np.exp(states.after(np.array([state]), np.array([0]), np.array([other]))[0]) == pytest.approx(1)


def test_query_equals_brute_force(spark, tables):
    rows = [tuple(r) for r in tables.documents.select("doc_id", "text").collect()]
    got = op4_suffix_tree(spark, SMALL).collect()
    assert base_of(got) == brute_base(rows, [zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows])
    assert all(r.score < 0 for r in got)


def test_contexts_of_rare_words_and_of_several_words_are_states(spark):
    """No word of these has a share of all tokens; what follows is settled by one, two or three words before."""
    draw = np.random.default_rng(5)
    filler = [f"f{i}" for i in range(400)]
    pad = lambda: " ".join(draw.choice(filler, 6))
    rows = []
    for i in range(1_200):
        a, b, c = draw.integers(0, 2, 3)
        # y is told by the word before; z by the second one before and it; v by all three.
        rows.append((i, f"{pad()} r{i % 40} y{i % 40} {pad()} p{a} q{b} z{a ^ b} {pad()} s{a} t{b} u{c} v{a ^ b ^ c}"))
    docs = frame(spark, rows)

    def total(order, least):
        got = suffix_tree.score(docs, F.col("test"), context_share=0.5, order=order, least=least).filter("held_out").collect()
        return sum(r.score for r in got) / sum(r.held_out for r in got)

    by_order = [total(order, 10) for order in range(4)]
    # A context of one word settles y; the others settle one bit each.
    assert by_order[1] - by_order[0] > 1 and by_order[2] - by_order[1] > 0.2 and by_order[3] - by_order[2] > 0.2
    assert total(3, 10_000) == pytest.approx(by_order[0], abs=1e-3)


@pytest.mark.parametrize("buckets", [1, 5])
def test_context_counts_equal_brute_force(spark, buckets):
    """A context is counted exactly, over all blocks, from its least count on."""
    rows = [(i, "a b c d " * (i % 3) + f"e{i % 5} b c x{i % 7}") for i in range(1, 120)]
    want = Counter()
    for d, t in rows:
        words = t.split() if d % 3 else []
        for i in range(3, len(words) + 1):
            want[tuple(words[i - 3:i])] += 1
    seen = {}

    def of(followed, gain, least, real=suffix_tree.contexts_of):
        found = real(followed, -1e9, least)
        seen[len(seen) + 1] = found.collect()
        return found

    kept, suffix_tree.contexts_of = suffix_tree.contexts_of, of
    try:
        suffix_tree.score(frame(spark, rows), F.col("test"), buckets=buckets, answered=1, least=4).collect()
    finally:
        suffix_tree.contexts_of = kept
    totals = [n for r in seen[3] for n in np.frombuffer(r["totals"], "<f8")]
    assert sorted(totals) == sorted(n for n in want.values() if n >= 4)


def test_frequent_words_are_counted_exactly(spark):
    """4 of 1,000 tokens are too few for the second batch to report, and without them the word has 196 of 200."""
    rows = [(1, "w " * 196 + "a " * 803), (2, "w " * 4 + "b " * 995)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    assert suffix_tree.frequent_words(docs, 0.1) == [b"b", b"a", b"w"]
    assert suffix_tree.frequent_words(docs, 0.101) == [b"b", b"a"]
    assert suffix_tree.frequent_words(docs.limit(0), 0.1) == []


def test_adding_up_blocks_first_changes_nothing(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for block in range(6):
        context = np.sort(rng.integers(0, 4, 12 * (block != 3))).astype("<u8")  # one block has no pairs
        pair = (context * np.uint64(100) + np.arange(len(context)).astype("<u8") % np.uint64(5)).astype("<u8")
        context, pair = context[np.unique(pair, return_index=True)[1]], np.unique(pair)
        contexts, runs = suffix_tree._runs(context)
        counts = rng.integers(0, 9, len(pair)).astype("<u4")
        rows.append((block, 0, pair.tobytes(), contexts, runs, counts.tobytes(), (counts * -2.0).astype("<f4").tobytes()))
    followed = spark.createDataFrame(rows, "block long, " + suffix_tree.PAIRS)
    plain = suffix_tree.contexts_of(suffix_tree.added_up(followed, 6), 0.0, 3).collect()
    monkeypatch.setattr(suffix_tree, "ADDED_BLOCKS", 2)
    summed = suffix_tree.added_up(followed, 6)
    assert summed.count() > 1 and "block" not in summed.columns
    assert suffix_tree.contexts_of(summed, 0.0, 3).collect() == plain and len(plain[0]["pairs"]) > 0


def test_only_questions_and_answers_are_shuffled(spark, monkeypatch):
    """Blocks lie in buckets by block: of all that is grouped by block only the answers move, with one Python worker a task at the end."""
    plans = []

    def seen(self, df, name, *more, real=Scratch.stored, **options):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(self, df, name, *more, **options)

    monkeypatch.setattr(Scratch, "stored", seen)
    want = suffix_tree.score(frame(spark, ROWS), F.col("test"), buckets=7, least=4).collect()
    final = [plan for name, plan in plans if name in ("lm-read", "lm-scores")]
    assert len(final) == 4 and len(want) == len(ROWS)
    assert [len(re.findall(r"Exchange hashpartitioning\(block", plan)) for plan in final] == [1] * 4
    assert "MapInArrow" not in final[-1]


def test_contexts_that_are_not_kept_change_nothing(spark):
    """Not even for a word that no state foretells with more than 1e-38."""
    rows = [(i, "the cat sat " * 12) for i in range(1, 30)] + [(99, "the " + "q" * 3_000 + " cat")]
    by_order = [{r.doc_id: r.score for r in suffix_tree.score(frame(spark, rows), F.col("test"), gain=1e9, order=order).collect()}
                for order in (0, 3)]
    assert by_order[0][99] < -1_000
    assert by_order[1] == pytest.approx(by_order[0], rel=1e-5)


@pytest.mark.parametrize("size", [None, 1_000])
def test_words_of_many_blocks_are_added_up_first(spark, size):
    plain = frame(spark, ROWS).select("doc_id", "text", F.lit(False).alias("held_out"))
    blocks = suffix_tree.blocks_of(plain, 2, [b"the"])
    counts = Counter()
    for r in suffix_tree.count_words(blocks, size).collect():
        counts.update(dict(zip(bytes(r["words"]).split(b" "), np.frombuffer(r["counts"], "<i8").tolist())))
    want = Counter(w for _, t in ROWS for w in tokens_of(t))
    assert counts == {suffix_tree.END if w is None else w.encode(): n for w, n in want.items()}
