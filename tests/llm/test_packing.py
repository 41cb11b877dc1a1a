import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from rowloom.llm import packing
from rowloom.llm.queries import TOKENIZER, op3_packing


def placed(histogram, window):
    plan = packing.make_plan(histogram, window)
    windows = defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            pieces = plan.place(length, rank)
            assert [p[0] for p in pieces] == list(np.cumsum([0] + [p[1] for p in pieces])[:-1])
            assert sum(p[1] for p in pieces) == length
            for _, stay, sequence, offset in pieces:
                windows[sequence].append((offset, stay))
    assert sorted(windows) == list(range(plan.n_windows))
    return [sorted(w) for w in windows.values()]


@pytest.mark.parametrize("seed", range(12))
def test_every_rest_has_one_place_and_only_one_window_is_padded(seed):
    draw, window = random.Random(seed), random.Random(seed).choice([8, 32, 100, 256])
    kinds = [draw.randrange(1, window) for _ in range(draw.choice([1, 3, 40]))]
    histogram = dict(Counter(draw.choice(kinds) for _ in range(draw.choice([1, 20, 2000]))))
    gaps = 0
    for pieces in placed(histogram, window):
        ends = np.cumsum([0] + [n for _, n in pieces])
        assert [o for o, _ in pieces] == ends[:-1].tolist()
        assert ends[-1] <= window
        gaps += ends[-1] < window
    assert gaps <= 1


def test_least_squares_uses_exact_complements():
    chosen = packing.combinations([10, 20, 30, 70, 90], 100)
    assert (90, 10) in chosen and (70, 30) in chosen and (70, 20, 10) in chosen
    assert all(sum(c) == 100 for c in chosen)
    counts = packing.repeat_counts([(90, 10), (70, 30)], {10: 7, 90: 7, 30: 4, 70: 6})
    assert counts == pytest.approx([7, 5], abs=0.3)
    assert min(packing.repeat_counts(chosen, {10: 1, 20: 5, 30: 50, 70: 2, 90: 9})) >= 0


def check(spark, docs, rows, window):
    pieces = packing.pack(docs, TOKENIZER, 1, window)
    got = pieces.collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[doc_id, tuple(ids)] += 1
    parts = defaultdict(list)
    for r in got:
        parts[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u2").tolist(), r.length, r.doc_tokens))
    for doc_id, own in parts.items():
        own.sort()
        assert all(len(ids) == n for _, ids, n, _ in own)
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        ends = np.cumsum([0] + [n for _, n in own])
        assert [o for o, _ in own] == ends[:-1].tolist() and ends[-1] <= window
    assert sum(sum(n for _, n in own) < window for own in sequences.values()) <= 1
    return got, want, parts, pieces


def test_documents_come_back_whole(spark):
    rows = [(1, None), (2, ""), (3, "one two three"), (4, "word " * 5_000), (5, "one two three"), (6, "a " * 31)]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, rest int, ids string").repartition(2)
    got, want, parts, pieces = check(spark, docs, rows, 32)
    for (doc_id, ids), _ in want.items():
        at, joined = 0, []
        for start, own, *_ in parts[doc_id]:
            assert start == at
            joined, at = joined + own, at + len(own)
        assert tuple(joined) == ids
    by_sequence = {r.sequence_id: np.frombuffer(r.ids, "<u2").tolist() for r in packing.sequences(pieces).collect()}
    for r in got:
        own = by_sequence[r.sequence_id][r.offset:r.offset + r.length]
        assert own == np.frombuffer(r.ids, "<u2").tolist()


def test_repeated_rows_and_null_ids(spark):
    rows = [(7, "same text here")] * 40 + [(None, "none")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, *_ = check(spark, docs, rows, 16)
    assert sum(r.start == 0 for r in got) == 43


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op3(spark, docs) == []


def op3(spark, docs):
    return packing.digests(packing.pack(docs, TOKENIZER, 1), TOKENIZER, 1).collect()


def test_digests_load_no_tokenizer(spark):
    ids = np.array([5, 1], "<u2")
    for kind in ("<u2", "<u4"):
        piece = spark.createDataFrame([(7, 0, 2, bytearray(ids.astype(kind).tobytes()), 2, 0, 0)], packing.PIECES)
        row = packing.digests(piece, "/no/such/tokenizer", 1).first()
        assert row["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes()) and row["length"] == 2


def test_digests_are_made_where_the_pieces_are(spark, capsys):
    docs = spark.createDataFrame([(i, "one two three " * i) for i in range(40)], "doc_id long, text string").repartition(2)
    own = packing.pack(docs, TOKENIZER, 1, 32, then=packing.digested, columns=packing.DIGESTS)
    assert sorted(own.collect()) == sorted(packing.digests(packing.pack(docs, TOKENIZER, 1, 32), TOKENIZER, 1).collect())
    op3_packing(spark, SMALL).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1  # so a task needs one Python worker


def test_query_holds_every_id_once(spark, tables):
    texts = dict(map(tuple, tables.documents.select("doc_id", "text").collect()))
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in texts.items()}
    covered = Counter()
    for r in op3_packing(spark, SMALL).collect():
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and 1 <= r.length <= 2048
        assert zlib.crc32(own[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        covered[r.doc_id] += r.length
    assert covered == {d: len(i) for d, i in ids.items()}
