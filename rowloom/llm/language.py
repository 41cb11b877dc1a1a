"""Languages of texts: scripts narrow the candidates, a Viterbi path over words labels spans.

A word is a run of letters.  Its score for a language is the log probability of
its character n-grams, hashed into a table of fixed size, counted over training
texts.  Which languages come into question for a word is decided by its script:
only those that write a part of their training letters in it.  The path of
languages through a text gains each word's score and pays a penalty for every
change, so short foreign words don't tear a span apart while a passage in another
language becomes a span of its own.  The text's language is the one with the most
letters in its spans.

Learning takes a sample of the training texts, at most ``TRAIN_ROWS`` of them, the
same at every size; prediction reads every text whole.  What is learned, a table
of ``BUCKETS`` counts for each of at most ``MAX_LANGUAGES`` languages, is bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from rowloom.llm.common import passing, pieces, texts

TRAIN_ROWS = 20_000
MAX_LANGUAGES = 256
BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
#: What a change of language costs, in nats.
PENALTY = 8.0
BATCH_ROWS = 1_000
#: Words whose n-grams are in memory at a time.
SCORED_WORDS = 8_192

# First code points of script ranges, and the scripts; what is between letters doesn't matter.
SCRIPT_STARTS = [(0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
                 (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "other"),
                 (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "other"), (0x0E00, "Thai"), (0x0E80, "other"),
                 (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, "other"), (0x1E00, "Latin"),
                 (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"),
                 (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"),
                 (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFF21, "Latin"), (0xFF66, "Kana"),
                 (0xFFA0, "other"), (0x20000, "Han"), (0x32000, "other")]
SCRIPTS = sorted({s for _, s in SCRIPT_STARTS})
_STARTS = np.array([c for c, _ in SCRIPT_STARTS])
_KINDS = np.array([SCRIPTS.index(s) for _, s in SCRIPT_STARTS])

#: Runs of letters, with the marks that belong to them.
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")

PREDICTED = "doc_id long, lang_pred string, score double, certainty double, spans array<struct<lang:string,first_word:long,words:long>>"


def words_of(text: bytes) -> list[str]:
    return WORDS.findall(text.decode("utf-8", "replace").lower())


def scripts_of(words: list[str]) -> np.ndarray:
    """The script of each word's first letter."""
    return _KINDS[np.searchsorted(_STARTS, [ord(w[0]) for w in words], "right") - 1] if words else np.empty(0, np.int64)


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, borders included, and the number of each gram's word."""
    joined = " " + " ".join(words) + " "
    code = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    border = code == 32
    number = np.cumsum(border) - 1
    buckets, owners = [], []
    for n in GRAMS:
        if len(code) < n:
            continue
        key = np.full(len(code) - n + 1, n, np.uint64)
        inside = np.zeros(len(key), bool)
        for i in range(n):
            part = slice(i, len(code) - n + 1 + i)
            key = (key ^ code[part]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            if 0 < i < n - 1:
                inside |= border[part]
        # A gram may begin or end at a border, but not reach across one.
        first, last = border[:len(key)], border[n - 1:]
        good = ~inside & ~(first & last)
        buckets.append((key[good] % np.uint64(BUCKETS)).astype(np.int64))
        # One that begins at a border belongs to the word behind it.
        owners.append(number[:len(key)][good])
    return np.concatenate(buckets), np.concatenate(owners)


class Model:
    """Log probabilities of gram buckets by language, and the scripts that each language writes."""

    def __init__(self, languages: list[str], counts: np.ndarray, letters: np.ndarray, shared: float = 0.01):
        self.languages = languages
        total = counts.sum(1, keepdims=True)
        self.table = np.log((counts + 0.05) / (total + 0.05 * BUCKETS)).T.astype(np.float32).copy()
        share = letters / np.maximum(letters.sum(1, keepdims=True), 1)
        self.writes = (share >= shared).T.copy()  # script, language
        # A script that no language writes excludes none.
        self.writes[~self.writes.any(1)] = True

    def score(self, words: list[str]) -> np.ndarray:
        """A row for each word: its log probability in each language; far below that for languages of other scripts."""
        bucket, owner = grams_of(words)
        order = np.argsort(owner, kind="stable")
        owner, bucket = owner[order], bucket[order]
        first = np.searchsorted(owner, np.arange(len(words)))
        scores = np.add.reduceat(self.table[bucket], first, axis=0)
        scores = np.where(self.writes[scripts_of(words)], scores, scores.min(1, keepdims=True) - 50.0)
        return scores.astype(np.float32)


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best path of languages for each text; all texts move on together, word by word."""
    lengths = np.array([len(s) for s in scores])
    order = np.argsort(-lengths, kind="stable")
    n, kinds = len(scores), scores[0].shape[1]
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    flat = np.concatenate(scores)
    value = np.zeros((n, kinds), np.float64)
    came = np.empty((len(flat), kinds), np.int16)
    own = np.arange(kinds, dtype=np.int16)
    alive, sorted_lengths = n, lengths[order]
    for step in range(int(lengths.max(initial=0))):
        while alive and sorted_lengths[alive - 1] <= step:
            alive -= 1
        now = order[:alive]
        at = starts[now] + step
        before = value[now]
        best = before.argmax(1)
        top = before[np.arange(alive), best][:, None] - penalty
        change = top > before
        came[at] = np.where(change, best[:, None], own)
        value[now] = np.where(change, top, before) + flat[at]
    path = np.empty(len(flat), np.int16)
    state = value.argmax(1)
    for step in range(int(lengths.max(initial=0)) - 1, -1, -1):
        now = order[:np.searchsorted(-sorted_lengths, -step, "left")]
        at = starts[now] + step
        path[at] = state[now]
        state[now] = came[at, state[now]]
    return [path[s:s + l] for s, l in zip(starts, lengths)]


def in_sample(doc_id: Column, rows: int, limit: int) -> Column:
    """About ``limit`` of ``rows`` rows, chosen by a hash."""
    share = min(1.0, limit / max(1, rows))
    return F.xxhash64(doc_id, F.lit("sample")) <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1)


def learn(training: DataFrame, limit: int = TRAIN_ROWS) -> Model | None:
    """A model from (doc_id, text, lang); null texts and languages teach nothing.  None without any."""
    usable = training.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample = usable.filter(in_sample(F.col("doc_id"), usable.count(), limit))

    def count(batches):
        for batch in pieces(batches, BATCH_ROWS):
            found: dict[tuple[str, int, int], int] = {}
            langs = np.array(batch["lang"].to_pylist(), object)
            split = [words_of(t) for t in texts(batch["text"])]
            for lang in sorted(set(langs.tolist())):
                words = [w for s, l in zip(split, langs) if l == lang for w in s]
                if not words:
                    continue
                grams = sum(np.bincount(grams_of(words[i:i + SCORED_WORDS])[0], minlength=BUCKETS)
                            for i in range(0, len(words), SCORED_WORDS))
                letters = np.bincount(scripts_of(words), [len(w) for w in words])
                for kind, n in ((0, grams), (1, letters)):
                    for i in np.flatnonzero(n).tolist():
                        found[lang, kind, i] = int(n[i])
            keys = list(found)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k in keys], pa.string()), "kind": pa.array([k[1] for k in keys], pa.int32()),
                "cell": pa.array([k[2] for k in keys], pa.int32()), "n": pa.array(list(found.values()), pa.int64())})

    counted = (sample.select(F.col("text").cast("string"), F.col("lang").cast("string"))
               .mapInArrow(count, "lang string, kind int, cell int, n long")
               .groupBy("lang", "kind", "cell").agg(F.sum("n").alias("n")))
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return None
    rows = counted.toArrow()  # at most languages x (BUCKETS + scripts) counts
    which = np.array([languages.index(l) for l in rows["lang"].to_pylist()], np.int64)
    kind, cell, n = (rows[c].to_numpy() for c in ("kind", "cell", "n"))
    counts, letters = np.zeros((len(languages), BUCKETS)), np.zeros((len(languages), len(SCRIPTS)))
    for target, of in ((counts, 0), (letters, 1)):
        np.add.at(target, (which[kind == of], cell[kind == of]), n[kind == of])
    return Model(languages, counts, letters)


def predict(docs: DataFrame, model: Model | None, penalty: float = PENALTY) -> DataFrame:
    """doc_id, lang_pred, score and spans of every text of ``docs`` (doc_id, text).

    ``score`` is the part of the text's letters that lies in spans of its language,
    times how sure the words of these spans are of it: the logistic function of
    their lead over the next best language, over the square root of their number.  Texts that are null or have no
    letter, and all texts if nothing was learned, get ``und`` and 0.  Rows are
    judged one by one.  ``certainty`` is the mean over all letters of how sure the words of
    their language are, whatever the parts of the languages.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(labeler(model, penalty), PREDICTED)


def clear_texts(docs: DataFrame, model: Model | None, least: float, penalty: float = PENALTY) -> DataFrame:
    """The rows of ``docs`` with a language and a certainty of at least ``least``, all columns as they are."""
    def clear(found: pa.RecordBatch) -> np.ndarray:
        named = np.array([lang != "und" for lang in found["lang_pred"].to_pylist()], bool)
        return named & (found["certainty"].to_numpy() >= least)

    return passing(docs, labeler(model, penalty), clear, BATCH_ROWS)


def labeler(model: Model | None, penalty: float = PENALTY):
    """What ``predict`` does with batches of (doc_id, text)."""
    def label(batches):
        for batch in pieces(batches, BATCH_ROWS):
            split = [words_of(t) for t in texts(batch["text"])]
            pred, sure, spans = ["und"] * len(split), [0.0] * len(split), [[] for _ in split]
            certain = [0.0] * len(split)
            used = [i for i, s in enumerate(split) if s and model]
            # Each different word of the batch is scored once.
            number: dict[str, int] = {}
            at = [np.array([number.setdefault(w, len(number)) for w in split[i]], np.int32) for i in used]
            words = list(number)
            table = np.concatenate([model.score(words[i:i + SCORED_WORDS])
                                    for i in range(0, len(words), SCORED_WORDS)]) if used else None
            scores = [table[rows] for rows in at]
            for i, own, path in zip(used, scores, viterbi(scores, penalty) if used else ()):
                letters = np.bincount(path, [len(w) for w in split[i]], len(model.languages))
                best = int(letters.argmax())
                for lang in np.flatnonzero(letters).tolist():
                    sums = own[path == lang].sum(0, dtype=np.float64)
                    margin = (sums[lang] - np.delete(sums, lang).max(initial=-np.inf)) / np.sqrt((path == lang).sum())
                    part = float(letters[lang] / letters.sum() / (1 + np.exp(-np.clip(margin, -50, 50))))
                    certain[i] += part
                    if lang == best:
                        pred[i], sure[i] = model.languages[best], part
                edges = np.flatnonzero(np.diff(path, prepend=-1)).tolist() + [len(path)]
                spans[i] = [{"lang": model.languages[path[a]], "first_word": a, "words": b - a}
                            for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "lang_pred": pred, "score": pa.array(sure, pa.float64()),
                "certainty": pa.array(certain, pa.float64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()),
                                                             ("words", pa.int64())])))})

    return label


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from; a null doc_id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, penalty: float = PENALTY, limit: int = TRAIN_ROWS) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that aren't held out, predict all."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = learn(own.filter(~held_out(F.col("doc_id"))), limit)
    return predict(own, model, penalty).withColumn("held_out", held_out(F.col("doc_id")))
