"""Counts in batches and parts must be those of whole texts."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from rowloom.llm import queries, token_counts
from rowloom.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARK = token_counts.MARK
AWKWARD = ["", " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", "a b   c", f"x{MARK} y", f"x {MARK}y", MARK, f" {MARK} ",
           "line\n line\n\nend\n", "tab\t tab", "<s> </s> <unk>", "<|endoftext|> x <|endoftext|>y", "café naïve é éx",
           "漢字 仮名 \U0001f600 \U0001f600", "x" * 300, "word " * 500, ("no" * 40 + " ") * 20, "a b c d e f " * 50, "I don't 12 34.5"]


def whole(path):
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t))
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path)
    return lambda t: len(model.encode(t, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("size", [1, 7, 60, 1 << 20])
def test_awkward_texts(spark, name, size):
    path = public_tokenizers.path(name)
    own = whole(path)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(AWKWARD)], "doc_id int, text string")
    found = token_counts.count_tokens(docs, path, 20, size).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found} == {
        i: (len(t.encode()), own(t), own(t) > 20) for i, t in enumerate(AWKWARD)}


def test_pieces_and_byte_pairs_are_cut():
    assert token_counts.counter(MODEL).boundary is not None
    assert token_counts.counter(public_tokenizers.path("byte_bpe_50k.json")).boundary is not None


def test_parts_are_balanced():
    boundary = token_counts.counter(MODEL).boundary
    text = b"some words of a text " * 10_000
    batches = list(token_counts.balanced([b"", text, b"short", text], boundary, 5_000))
    assert max(sum(map(len, b)) for _, b in batches) < 10_100
    assert {o for owners, _ in batches for o in owners} == {1, 2, 3}


def test_query_against_whole_texts(spark):
    own = whole(MODEL)
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r) for r in queries.op11_token_counts(spark, SMALL).collect()}
    assert found == {d: (d, len((t or "").encode()), own(t or ""), own(t or "") > 4096) for d, t in docs}


def test_nulls_repeats_and_other_columns(spark):
    docs = spark.createDataFrame([(None, None, 1), (None, "a b", 2), (5, "a b", 3), (5, "a b", 3)], "doc_id long, text string, n_tokens int")
    found = sorted(map(tuple, token_counts.count_tokens(docs, MODEL).collect()), key=str)
    assert found == [(5, 3, 2, False)] * 2 + [(None, 0, 0, False), (None, 3, 2, False)]
    assert token_counts.count_tokens(docs.filter("doc_id > 9"), MODEL).collect() == []


def test_a_very_long_text(spark):
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.repeat(F.lit("the words  of a long text\n"), 200_000).alias("text"))
    one = whole(MODEL)("the words  of a long text\n" * 50)
    two = whole(MODEL)("the words  of a long text\n" * 51)
    found = token_counts.count_tokens(docs, MODEL).collect()
    assert {r["n_tokens"] for r in found} == {one + (two - one) * (200_000 - 50)}
    assert all(r["n_bytes"] == 26 * 200_000 and r["over_limit"] for r in found)
