"""Language-model scores from a probabilistic suffix tree.

A token is a word or the end of a text, and is predicted from the longest state
that the tree keeps of what stands before it.

* Before words, states are the last frequent word that was read (rarer words in
  between don't change it), or the empty context.  A frequent word is kept as a
  state only if what follows it diverges from what follows at large by GAIN nats
  over all its occurrences.
* Longer states are the one, two and three words before, whatever words those are.
  Such a context needs LEAST occurrences in training texts, at any size of the
  corpus, and must gain GAIN nats over the shorter state, each occurrence foretold
  from the others.
* Words that were never seen are spelled by a tree over bytes.  Its states are up to
  DEPTH bytes before, not beyond the start of the word, grown level by level over
  the different words of the corpus and kept by the same test.

Distributions are smoothed from the longer to the shorter state: a count c is
lowered by a discount d = n1 / (n1 + 2 n2), from the numbers of symbols seen once
and twice there, and what that frees is given out as the shorter state says.  So
P(x | frequent word) rests on P(x), that on the tree of bytes, that on equal chances.

The words of all texts, with the states before them, are counted in buckets by a
hash of the word.  Blocks of documents ask each bucket for their own different words
only and get counts and scores back, so nothing that grows with the corpus is held
in one place.  Contexts of one to three words are counted and answered in the same
way, one length after the other, in buckets by a 64-bit hash of the context; they stay
there, and there are more of them in a larger corpus.  How often a context of k + 1
words stands in the corpus is how often its last word follows the k before, which the
length before has counted, so only contexts that reach LEAST are counted.  States that
every task gets are bounded: a frequent word has CONTEXT_SHARE of all tokens, a byte
context MIN_SHARE of all places.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rowloom.llm.common import mixed, pieces, plain_words, release, scratch, stored, texts

DEPTH = 6
MIN_SHARE = 2e-5
#: Part of all tokens that a word needs to be a state.
CONTEXT_SHARE = 3e-3
#: Nats by which a context must beat the shorter one, over all its occurrences.
GAIN = 20.0
#: Words of the longest context, and training occurrences that a context needs.
ORDER = 3
LEAST = 10
BLOCK_ROWS = 2_000
#: Text bytes for each bucket of words, and blocks that one task answers.
BUCKET_BYTES = 8 << 20
#: Blocks whose pairs are added up before the others, and sums of that kind per bucket at most.
ADDED_BLOCKS, ADDED_PARTS = 64, 64
ANSWERED_BLOCKS = 4_096

EDGE = 32  # the border of words
END = b"\n"  # the end of a text: no word can be that

BLOCKS = ("block long, bucket int, words binary, counts binary, kinds binary, states binary, state_counts binary, "
          "doc_ids array<string>, held_out array<boolean>, lengths binary, tokens binary, hashes binary")
WORDS = "bucket int, words binary, counts binary, kinds binary, states binary, state_counts binary"
#: Blocks with all tokens: numbers of (word, state), and the counts of words and log probabilities of these.
READ = ("block long, doc_ids array<string>, held_out array<boolean>, lengths binary, tokens binary, kinds binary, "
        "hashes binary, counts binary, scores binary")
#: Blocks between two lengths of contexts: sums of each text, and the places that a longer context may follow.
LIVE = ("block long, doc_ids array<string>, held_out array<boolean>, lengths binary, known binary, base binary, sums binary, "
        "places binary, words binary, hashes binary, following binary, contexts binary, value binary")
#: Pairs of context and word, grouped by context: different contexts and how many pairs each has; per pair 40 bits of
#: the word's hash, its occurrences and their summed log probability after the shorter state.
PAIRS = "bucket int, pairs binary, contexts binary, runs binary, counts binary, shorter binary"
CONTEXTS = ("bucket int, pairs binary, counts binary, contexts binary, runs binary, kept binary, "
            "taken binary, totals binary, free binary")
WORD_BITS = 40
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def frequent_words(training: DataFrame, share: float = CONTEXT_SHARE) -> list[bytes]:
    """Words with ``share`` of all tokens, the most frequent first.

    A batch reports words that have a twentieth of that share in it, so what a
    word may lose is less than a twentieth of what it needs.  Words that are as
    little short of it by the reports are counted again, exactly.
    """
    def count(batches):
        for batch in pieces(batches, BLOCK_ROWS):
            found = Counter()
            for text in texts(batch["text"]):
                found.update(plain_words(text))
            total = found.total() + batch.num_rows
            often = {w: n for w, n in found.items() if n >= share / 20 * total}
            yield pa.RecordBatch.from_pydict({"word": pa.array([END, *often], pa.binary()),
                                              "n": pa.array([total, *often.values()], pa.int64())})

    counted = training.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "lm-frequent")  # it is read twice
    total = counted.filter(F.col("word") == F.lit(END)).agg(F.sum("n").alias("n")).first()["n"] or 0
    listed = counted.filter((F.col("word") != F.lit(END)) & (F.col("n") >= 0.95 * share * total - 1)).collect()
    found = {bytes(r["word"]): r["n"] for r in listed}
    unsure = frozenset(w for w, n in found.items() if n < share * total)

    def recount(batches):
        again = Counter()
        for batch in pieces(batches, BLOCK_ROWS):
            for text in texts(batch["text"]):
                again.update(w for w in plain_words(text) if w in unsure)
        yield pa.RecordBatch.from_pydict({"word": pa.array(again, pa.binary()), "n": pa.array(again.values(), pa.int64())})

    if unsure:
        exact = training.select("text").mapInArrow(recount, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        found |= {bytes(r["word"]): r["n"] for r in exact.collect()}
    found = {w: n for w, n in found.items() if n >= share * total}
    return sorted(found, key=lambda w: (-found[w], w))


def _planes(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers as their lowest bytes, then the next and so on, which compresses better."""
    return np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T).tobytes()


def _whole(planes: bytes, kind: str) -> np.ndarray:
    """The numbers of ``_planes``."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, len(planes) // size).T).view(kind).ravel()


def _states(tokens: np.ndarray, lengths: np.ndarray, state_of: np.ndarray) -> np.ndarray:
    """For each token the last frequent word before it in its text (from 1; 0 if there is none)."""
    own = state_of[tokens]
    starts = np.cumsum(lengths) - lengths
    seen = np.maximum.accumulate(np.where(own > 0, np.arange(len(own)), -1)) if len(own) else own
    before = np.concatenate(([-1], seen[:-1])) if len(own) else own
    return np.where(before >= np.repeat(starts, lengths), own[np.maximum(before, 0)], 0)


def blocks_of(docs: DataFrame, buckets: int, frequent: list[bytes]) -> DataFrame:
    """Documents in blocks: per block its texts as numbers of (word, state), and its different words by bucket."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()),
                        *[(c, pa.binary()) for c in ("words", "counts", "kinds", "states", "state_counts")],
                        ("doc_ids", pa.list_(pa.string())), ("held_out", pa.list_(pa.bool_())),
                        ("lengths", pa.binary()), ("tokens", pa.binary()), ("hashes", pa.binary())])
    width = len(frequent) + 1

    def split(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, BLOCK_ROWS):
            numbers = {w: i for i, w in enumerate([*frequent, END])}
            held, tokens, lengths = batch["held_out"].to_pylist(), [], np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(texts(batch["text"])):
                listed = plain_words(text)
                listed.append(END)
                for w in set(listed).difference(numbers):
                    numbers[w] = len(numbers)
                lengths[i] = len(listed)
                tokens.append(np.fromiter(map(numbers.__getitem__, listed), np.int64, len(listed)))
            tokens = np.concatenate(tokens)
            state_of = np.zeros(len(numbers), np.int64)
            state_of[:len(frequent)] = np.arange(1, width)
            states = _states(tokens, lengths, state_of)
            training = np.repeat(~np.array(held, bool), lengths)
            # Words in the order of their buckets; then pairs of word and state in that order.
            words = list(numbers)
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            pair, number = np.unique(place[tokens] * width + states, return_inverse=True)
            pair_counts = np.bincount(number[training], minlength=len(pair))
            counts = np.bincount(place[tokens[training]], minlength=len(words))
            kinds = np.bincount(pair // width, minlength=len(words))
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            pair_ends = np.concatenate(([0], np.cumsum(kinds)))[ends]
            rows = [{"block": block, "bucket": -1, "doc_ids": batch["doc_id"].cast(pa.string()).to_pylist(), "held_out": held,
                     "kinds": kinds.astype("<u2").tobytes(), "lengths": lengths.astype("<i8").tobytes(),
                     "tokens": _planes(number, "<u4"), "hashes": hashes[order].astype("<u8").tobytes()}]
            for b in np.flatnonzero(np.diff(ends)).tolist():
                own, pairs = slice(ends[b], ends[b + 1]), slice(pair_ends[b], pair_ends[b + 1])
                rows.append({"block": block, "bucket": b, "words": b" ".join([words[i] for i in order[own]]),
                             "counts": counts[own].astype("<i8").tobytes(), "kinds": kinds[own].astype("<u2").tobytes(),
                             "states": (pair[pairs] % width).astype("<u2").tobytes(),
                             "state_counts": pair_counts[pairs].astype("<i8").tobytes()})
            block += 1
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return stored(docs.mapInArrow(split, BLOCKS), "lm-blocks", (buckets, "block"), compression="zstd")


def _combined(pdf: pd.DataFrame) -> dict:
    """Counts of words, and of words after states, added up over rows of one bucket."""
    number: dict[bytes, int] = {}
    at = [np.array([number.setdefault(w, len(number)) for w in words.split(b" ")], np.int64) for words in pdf["words"]]
    counts = np.zeros(len(number), np.int64)
    for i, raw in zip(at, pdf["counts"]):
        counts[i] += np.frombuffer(raw, "<i8")  # a word stands once in a row
    pairs = np.concatenate([np.repeat(i, np.frombuffer(k, "<u2")) << 16 | np.frombuffer(s, "<u2")
                            for i, k, s in zip(at, pdf["kinds"], pdf["states"])])
    pair, inverse = np.unique(pairs, return_inverse=True)
    pair_counts = np.zeros(len(pair), np.int64)
    np.add.at(pair_counts, inverse, np.frombuffer(b"".join(pdf["state_counts"]), "<i8"))
    return {"words": list(number), "counts": counts, "pair": pair, "pair_counts": pair_counts}


def _row(found: dict) -> dict:
    return {"words": b" ".join(found["words"]), "counts": found["counts"].tobytes(),
            "kinds": np.bincount(found["pair"] >> 16, minlength=len(found["words"])).astype("<u2").tobytes(),
            "states": (found["pair"] & 0xFFFF).astype("<u2").tobytes(), "state_counts": found["pair_counts"].tobytes()}


def count_words(blocks: DataFrame, size: int | None = None) -> DataFrame:
    """Words of each bucket with their counts in training texts, alone and after each state; 0 for held-out ones.

    Many blocks (``size``) are added up in groups first, so a bucket's task gets few rows.
    """
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0], "group": pdf["group"].iloc[0]} | _row(_combined(pdf))])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _combined(pdf)
        return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0]} | _row(found)
                             | {"state_sums": _state_sums(found).tolist()}])

    parts = min(ADDED_PARTS, (blocks.filter("bucket < 0").count() if size is None else size) // ADDED_BLOCKS)
    partly = blocks.filter("bucket >= 0").select("bucket", F.pmod(F.xxhash64("block"), F.lit(max(1, parts))).alias("group"),
                                                 "words", "counts", "kinds", "states", "state_counts")
    if parts > 1:
        partly = partly.groupBy("bucket", "group").applyInPandas(add, "group long, " + WORDS)
    return stored(partly.groupBy("bucket").applyInPandas(merge, WORDS + ", state_sums array<array<double>>"), "lm-words")


def _state_sums(found: dict) -> np.ndarray:
    """Per state the sums that its divergence and its discount need; the last row is for all tokens."""
    state, n, own = found["pair"] & 0xFFFF, found["pair_counts"], found["counts"]
    width = int(state.max(initial=0)) + 1
    seen = n > 0
    state, n, of = state[seen], n[seen].astype(float), own[found["pair"][seen] >> 16]
    per_state = [np.bincount(state, v, width) for v in (n, np.ones(len(n)), n == 1, n == 2, n * np.log(n / of))]
    return np.vstack((np.stack(per_state, axis=1), [own.sum(), (own > 0).sum(), (own == 1).sum(), (own == 2).sum(), 0.0]))


class States:
    """What the counts of all buckets say of each state: tokens, different tokens, discount, and whether it is kept."""

    def __init__(self, sums: np.ndarray, gain: float):
        self.n, self.kinds, once, twice, log_ratio = sums.T
        with np.errstate(divide="ignore", invalid="ignore"):
            self.discount = np.where(once > 0, once / (once + 2 * twice), 0.5)
            gained = log_ratio[:-1] + self.n[:-1] * np.log(self.n[-1] / self.n[:-1])
        self.kept = (self.n[:-1] > 0) & (gained >= gain)

    @classmethod
    def of(cls, words: DataFrame, states: int, gain: float) -> "States":
        """From the sums of all buckets: as many rows as there are states come to the driver."""
        last = F.size("state_sums") - 1
        cells = words.select(F.posexplode("state_sums").alias("state", "v"), last.alias("_last"))
        rows = (cells.groupBy(F.when(F.col("state") == F.col("_last"), states).otherwise(F.col("state")).alias("state"))
                .agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(5)]).collect())
        sums = np.zeros((states + 1, 5))
        for r in rows:
            sums[r["state"]] = [r[f"v{i}"] for i in range(5)]
        return cls(sums, gain)

    def words(self, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Log probability of words in the empty context."""
        if not self.n[-1]:
            return spelled
        with np.errstate(divide="ignore"):
            kept = np.log(np.maximum(counts - self.discount[-1], 0.0))
            return np.logaddexp(kept, np.log(self.discount[-1] * self.kinds[-1]) + spelled) - np.log(self.n[-1])

    def after(self, state: np.ndarray, counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Log probability of words after states, given the log probabilities in the empty context."""
        d, kinds, n = self.discount[state], self.kinds[state], self.n[state]
        with np.errstate(divide="ignore", invalid="ignore"):
            longer = np.logaddexp(np.log(np.maximum(counts - d, 0.0)), np.log(d * kinds) + shorter) - np.log(n)
        return np.where(self.kept[state], longer, shorter)


def _bytes_of(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words between borders as one byte string; how far each byte is from its border; its word's count."""
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    edges = np.flatnonzero(joined == EDGE)
    lengths = np.diff(edges)
    since = np.arange(1, len(joined)) - np.repeat(edges[:-1], lengths)
    return joined, since, np.repeat(counts, lengths)


def _contexts(joined: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` bytes before each byte but the first, as one number; the nearest byte is the lowest."""
    n = len(joined) - 1
    key = np.zeros(n, np.int64)
    for d in range(depth):
        before = np.zeros(n, np.int64)
        before[d:] = joined[:max(n - d, 0)]
        key |= before << (8 * d)
    return key


class SuffixTree:
    """Kept contexts with next-byte counts, by length; contexts are numbers as in ``_contexts``."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, ...]] = []

    def add(self, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> None:
        pair = context * 256 + symbol
        order = np.argsort(pair)
        pair, context, n = pair[order], context[order], n[order].astype(np.float64)
        known, first = np.unique(context, return_index=True)
        total = np.add.reduceat(n, first) if len(n) else n
        kinds = np.diff(np.append(first, len(context))).astype(np.float64)
        self.levels.append((known, total, kinds, pair, n))

    def next_byte(self, joined: np.ndarray, since: np.ndarray) -> np.ndarray:
        """Probability of each byte but the first after its longest kept context."""
        symbol = joined[1:].astype(np.int64)
        p = np.full(len(symbol), 1.0 / 256)
        for depth, (known, total, kinds, pair, n) in enumerate(self.levels):
            if not len(known):
                continue
            at = np.flatnonzero(since >= depth)
            context = _contexts(joined, depth)[at]
            state = np.searchsorted(known, context)
            state[state == len(known)] = 0
            there = known[state] == context
            at, state, context = at[there], state[there], context[there]
            wanted = context * 256 + symbol[at]
            place = np.searchsorted(pair, wanted)
            place[place == len(pair)] = 0
            count = np.where(pair[place] == wanted, n[place], 0.0)
            p[at] = (count + kinds[state] * p[at]) / (total[state] + kinds[state])
        return p

    def words(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the probability of each word, its end included."""
        if not words:
            return np.empty(0)
        joined, since, _ = _bytes_of(words, np.zeros(len(words)))
        p = np.log(self.next_byte(joined, since))
        starts = np.flatnonzero(since == 1)
        # A word has a byte at least: no chance is left for the border at its start.
        return np.add.reduceat(p, starts) - np.log1p(-self._at_start(EDGE))

    def _at_start(self, symbol: int) -> float:
        return float(self.next_byte(np.array([EDGE, symbol], np.uint8), np.array([1]))[0])


def grow_tree(words: DataFrame, depth: int = DEPTH, min_share: float = MIN_SHARE,
              gain: float = GAIN) -> SuffixTree:
    """Level by level: count what follows the candidates of one more byte, keep those that diverge."""
    tree = SuffixTree()
    candidates: np.ndarray | None = None
    total = None
    for level in range(depth + 1):
        known = candidates

        def count(batches, level=level, known=known):
            pairs, counts_ = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for batch in batches:
                for blob, raw in zip(batch["words"].to_pylist(), batch["counts"].to_pylist()):
                    counts = np.frombuffer(raw, "<i8")
                    listed = [w for w, n in zip(blob.split(b" "), counts.tolist()) if n]
                    if not listed:
                        continue
                    joined, since, _ = _bytes_of(listed, np.ones(len(listed)))
                    context, at = _contexts(joined, level), np.flatnonzero(since >= level)
                    if known is not None and level > 1:
                        shorter = context & ((1 << 8 * (level - 1)) - 1)
                        at = at[_found(known, shorter[at])[1]]
                    pair, n = np.unique(context[at] * 256 + joined[1:][at], return_counts=True)
                    pairs.append(pair.astype(np.int64))
                    counts_.append(n)
            # One row per pair and task.
            pair, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
            n = np.bincount(inverse, np.concatenate(counts_), len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"pair": pair, "n": n})

        counted = (words.select("words", "counts").mapInArrow(count, "pair long, n long")
                   .groupBy("pair").agg(F.sum("n").alias("n"))
                   .withColumn("context", F.shiftright("pair", 8)))
        if level > 1:
            often = counted.groupBy("context").agg(F.sum("n").alias("_all")).filter(F.col("_all") >= min_share * total)
            counted = stored(counted, "lm-contexts").join(often, "context", "left_semi")
        found = counted.select("pair", "n").toArrow()  # at most 256 / min_share rows
        pair, n = found["pair"].to_numpy(), found["n"].to_numpy().astype(np.float64)
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        context, symbol = pair >> 8, pair & 255
        if level == 0:
            total = max(1.0, float(n.sum()))
        if not len(pair):
            break
        if level > 1:
            keep = diverging(tree, level, context, symbol, n, gain)
            candidates = np.unique(context)
            context, symbol, n = context[keep], symbol[keep], n[keep]
        tree.add(context, symbol, n)
    return tree


def diverging(tree: SuffixTree, level: int, context: np.ndarray, symbol: np.ndarray, n: np.ndarray,
              gain: float) -> np.ndarray:
    """Which rows belong to contexts whose next bytes gain enough over the longest shorter kept context."""
    depth = level - 1
    text = np.stack([(context >> (8 * d)) & 255 for d in range(depth - 1, -1, -1)] + [symbol], axis=1).astype(np.uint8)
    shorter = np.empty(len(context))
    for at in range(0, len(context), 1 << 16):
        part = text[at:at + (1 << 16)]
        joined = part.ravel()
        since = np.tile(np.arange(depth + 1), len(part))[1:]
        shorter[at:at + (1 << 16)] = tree.next_byte(joined, since)[depth - 1::depth + 1]
    states, inverse = np.unique(context, return_inverse=True)
    total = np.bincount(inverse, weights=n)
    own = np.bincount(inverse, weights=n * (np.log(n / total[inverse]) - np.log(shorter)))
    return (own >= gain)[inverse]


class Places:
    """Of a block, the places that a candidate stands before: their words, contexts and log probabilities; and the texts' sums.

    Words and contexts are numbers into ``hashes`` and ``contexts``.  What no longer context can follow is in the sums.
    """

    def __init__(self, row, least: int, base=None):
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.ends = np.cumsum(self.lengths)
        if "scores" in row:
            self._all(row, least, base)
        else:
            self.known, self.base, self.sums = (np.frombuffer(row[c], k) for c, k in (("known", "<i8"), ("base", "<f8"), ("sums", "<f8")))
            self.words, self.following, value = (
                _whole(row[c], k) for c, k in (("words", "<u4"), ("following", "<u4"), ("value", "<f4")))
            self.at = np.flatnonzero(np.unpackbits(np.frombuffer(row["places"], np.uint8)))
            self.hashes, self.contexts = (np.frombuffer(row[c], "<u8") for c in ("hashes", "contexts"))
            self.value = value.astype(float)
        self.text = np.searchsorted(self.ends, self.at, side="right")

    def _all(self, row, least: int, base) -> None:
        kinds, counts = np.frombuffer(row["kinds"], "<u2"), np.frombuffer(row["counts"], "<i8")
        pair, starts = _whole(row["tokens"], "<u4"), self.ends - self.lengths
        words = np.repeat(np.arange(len(kinds)), kinds)[pair]
        value = _whole(row["scores"], "<f4")[pair].astype(float)
        if base is not None:  # only what keeps the sums needs them
            self.known = np.add.reduceat((counts > 0).astype(np.int64)[words], starts)
            self.base = np.add.reduceat(base(counts)[words], starts)
        after = np.zeros(len(words), bool)
        after[1:] = (counts >= least)[words[:-1]]
        after[starts] = False
        self.at = np.flatnonzero(after)
        self.sums = np.add.reduceat(np.where(after, 0.0, value), starts)
        self.hashes = np.frombuffer(row["hashes"], "<u8")
        self.words, self.following, self.contexts = words[self.at], words[self.at - 1], mixed(self.hashes)
        self.value = value[self.at]

    def scores(self) -> np.ndarray:
        return self.sums + np.bincount(self.text, self.value, len(self.lengths))

    def lengthened(self, followed: "Followed", often: np.ndarray) -> dict:
        """The places after those whose pair is often there, which is their context now; the others go to the sums."""
        before = np.flatnonzero(often[followed.number])
        here, there = _found(self.at, self.at[before] + 1)
        here, before = here[there], before[there]
        rest = np.ones(len(self.at), bool)
        rest[here] = False
        sums = self.sums + np.bincount(self.text[rest], self.value[rest], len(self.lengths))
        pair, following = np.unique(followed.number[before], return_inverse=True)
        word, words = np.unique(self.words[here], return_inverse=True)
        places = np.zeros(int(self.lengths.sum()), np.uint8)
        places[self.at[here]] = 1
        return {"lengths": self.lengths.tobytes(), "known": self.known.tobytes(), "base": self.base.tobytes(), "sums": sums.tobytes(),
                "places": np.packbits(places).tobytes(), "words": _planes(words, "<u4"),
                "hashes": self.hashes[word].tobytes(), "following": _planes(following, "<u4"),
                "contexts": mixed(followed.context_of(pair) ^ self.hashes[followed.word[pair]]).tobytes(),
                "value": _planes(self.value[here], "<f4")}


class Followed:
    """The different pairs of context and word at the places of a block.

    Pairs stand in the order of their contexts' buckets, those of a context together.
    """

    def __init__(self, places: Places, buckets: int):
        bucket = (places.contexts % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pair, self.number = np.unique(rank[places.following] << 32 | places.words, return_inverse=True)
        self._context, self._contexts, self.word = pair >> 32, places.contexts[order], pair & 0xFFFFFFFF
        self.pairs = places.hashes[self.word].view(np.uint8).reshape(-1, 8)[:, :WORD_BITS // 8]
        self.ends = np.searchsorted(bucket[order][self._context], np.arange(buckets + 1))

    def context_of(self, pairs) -> np.ndarray:
        return self._contexts[self._context[pairs]]

    def runs(self) -> np.ndarray:
        """How many pairs each context has, in their order."""
        return np.unique(self._context, return_counts=True)[1]


def follow(read: DataFrame, least: int, buckets: int) -> DataFrame:
    """Pairs of context and word in every block: training occurrences, and their summed log probability after the shorter state."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()),
                        *[(c, pa.binary()) for c in ("pairs", "contexts", "runs", "counts", "shorter")]])

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p = Places(row, least)
                f = Followed(p, buckets)
                training = ~np.array(row["held_out"], bool)[p.text]
                of = f.number[training]
                counts, shorter = np.bincount(of, minlength=len(f.word)), np.bincount(of, p.value[training], len(f.word))
                rows = []
                for b in np.flatnonzero(np.diff(f.ends)).tolist():
                    own = slice(f.ends[b], f.ends[b + 1])
                    contexts, runs = _runs(f.context_of(own))
                    rows.append({"block": row["block"], "bucket": b, "pairs": f.pairs[own].tobytes(),
                                 "contexts": contexts, "runs": runs, "counts": counts[own].astype("<u4").tobytes(),
                                 "shorter": shorter[own].astype("<f4").tobytes()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read.mapInArrow(ask, "block long, " + PAIRS)


def _runs(contexts: np.ndarray) -> tuple[bytes, bytes]:
    """Different ones of contexts that stand together, and how often each stands there."""
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(contexts)), bool), contexts[1:] != contexts[:-1])))
    return contexts[first].tobytes(), np.diff(np.append(first, len(contexts))).astype("<u4").tobytes()


def _numbers(pairs: bytes, size: int) -> np.ndarray:
    """``size`` numbers of as many bytes each as there are."""
    wide = np.zeros((size, 8), np.uint8)
    if size:
        wide[:, :len(pairs) // size] = np.frombuffer(pairs, np.uint8).reshape(size, -1)
    return wide.view("<u8").ravel()


def _bytes(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** WORD_BITS without the bytes that are zero."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BITS // 8].tobytes()


def _keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Pairs as one number: the place of the context among those of a bucket, then the word."""
    if len(context) and int(context.max()) >> (64 - WORD_BITS):
        raise ValueError("a bucket has too many contexts: give more buckets")
    return context.astype(np.uint64) << np.uint64(WORD_BITS) | word


def _added(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Contexts of one bucket and its training pairs in ascending order (``_keys``), occurrences and summed shorter log probability.

    Numbers have 32 bits, sums that need it 64.
    """
    runs = np.frombuffer(b"".join(pdf["runs"]), "<u4")
    size, counts = int(runs.sum()), b"".join(pdf["counts"])
    kinds = ("<u4", "<f4") if len(counts) == 4 * size else ("<i8", "<f8")
    n, shorter = np.frombuffer(counts, kinds[0]), np.frombuffer(b"".join(pdf["shorter"]), kinds[1])
    contexts, of = np.unique(np.frombuffer(b"".join(pdf["contexts"]), "<u8"), return_inverse=True)
    words = _numbers(b"".join(pdf["pairs"]), size)
    seen = n > 0
    pair, number = np.unique(_keys(np.repeat(of, runs), words)[seen], return_inverse=True)
    return contexts, pair, np.bincount(number, n[seen], len(pair)).astype(np.int64), np.bincount(number, shorter[seen], len(pair))


def added_up(followed: DataFrame, blocks: int) -> DataFrame:
    """Pairs of many blocks summed up, so that no task gets those of a frequent context from all blocks.

    The sums are stored: the pairs of the blocks are gone before these are shuffled.
    """
    parts = min(ADDED_PARTS, blocks // ADDED_BLOCKS)
    if parts < 2:
        return followed

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        known, pair, n, shorter = _added(pdf)
        contexts, runs = _runs(known[(pair >> np.uint64(WORD_BITS)).astype(np.int64)])
        kinds = ("<u4", "<f4") if n.max(initial=0) < 1 << 32 else ("<i8", "<f8")
        return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0], "pairs": _bytes(pair), "contexts": contexts, "runs": runs,
                              "counts": n.astype(kinds[0]).tobytes(), "shorter": shorter.astype(kinds[1]).tobytes()}])

    part = F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part")
    summed = followed.select("*", part).drop("block").groupBy("bucket", "part").applyInPandas(add, PAIRS)
    return stored(summed, "lm-sums", compression="zstd")


def contexts_of(followed: DataFrame, gain: float, least: int) -> DataFrame:
    """Per bucket the kept contexts, and the counts of pairs that belong to one or are candidates for the next length.

    Of a kept context there is its discount, its occurrences and the share that it leaves to the shorter state.
    """
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        known, pair, n, shorter = _added(pdf)
        place, of = np.unique((pair >> np.uint64(WORD_BITS)).astype(np.int64), return_inverse=True)
        context = known[place]
        total, kinds, once, twice = (np.bincount(of, v, len(context)) for v in (n, np.ones(len(n)), n == 1, n == 2))
        taken = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
        free = taken * kinds / np.maximum(total, 1)
        shorter = shorter / np.maximum(n, 1)
        # Each occurrence is judged by the others, else a context seems to foretell what it merely has seen.
        others = np.maximum(n - 1 - taken[of], 0.0) + (taken * kinds)[of] * np.exp(shorter) - np.where(
            n == 1, taken[of] * np.exp(shorter), 0.0)
        with np.errstate(divide="ignore"):
            longer = np.log(others) - np.log(np.maximum(total[of] - 1, 1))
        kept = np.bincount(of, n * (longer - shorter), len(context)) >= gain
        listed = kept[of] | (n >= least)
        runs = np.bincount(of[listed], minlength=len(context))
        there = runs > 0
        return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0], "pairs": _bytes(pair[listed]), "counts": n[listed].astype("<i8").tobytes(),
                              "contexts": context[there].tobytes(), "runs": runs[there].astype("<u4").tobytes(),
                              "kept": kept[there].astype(np.uint8).tobytes(), "taken": taken[kept].tobytes(),
                              "totals": total[kept].tobytes(), "free": free[kept].tobytes()}])

    pairs = followed.select(*[c.split()[0] for c in PAIRS.split(", ")])
    return stored(pairs.groupBy("bucket").applyInPandas(merge, CONTEXTS), "lm-word-contexts", compression="zstd")


def _found(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted numbers are in the ascending known ones, and whether they are there."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _scores(row, places: Places, n_all: int) -> pd.DataFrame:
    """The result for the texts of a block."""
    return pd.DataFrame({"doc_id": pd.array([None if d is None else int(d) for d in row["doc_ids"]], "Int64"),
                         "held_out": np.array(row["held_out"], bool), "n_tokens": places.lengths, "n_known": places.known,
                         "train_tokens": n_all, "base_score": places.base, "score": places.scores() / np.log(10)})


def lengthen(read: DataFrame, buckets: int, blocks: int, groups: int, gain: float, least: int, base,
             n_all: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The places of ``read`` that a context of one word more may follow, what such contexts say added to the others; and the stored answers.

    ``read`` lies in buckets by block, so only questions and answers are shuffled, and not both at once.
    With ``n_all``, the number of training tokens, it is the last length: scores come instead of places, in the same pass,
    for a pass behind it would need another Python worker in each task.
    """
    followed = follow(read, least, buckets)
    summed = added_up(followed, blocks)
    contexts = contexts_of(summed, gain, least)
    release(summed)

    def answer(key, asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = []
        names = ("counts", "<i8"), ("contexts", "<u8"), ("runs", "<u4"), ("kept", np.uint8), ("taken", "<f8"), ("totals", "<f8"), ("free", "<f8")
        counts, listed, runs, kept, taken, totals, free = (
            np.frombuffer(known[c].iloc[0] if len(known) else b"", kind) for c, kind in names)
        pairs = _keys(np.repeat(np.arange(len(listed)), runs), _numbers(known["pairs"].iloc[0] if len(known) else b"", len(counts)))
        kept, state = kept > 0, np.cumsum(kept, dtype=np.int64) - 1
        for block, wanted, of, runs in zip(asked["block"], asked["pairs"], asked["contexts"], asked["runs"]):
            runs = np.frombuffer(runs, "<u4")
            context, there = _found(listed, np.frombuffer(of, "<u8"))
            judged = np.zeros(len(there), bool)
            judged[there] = kept[context[there]]
            at, found = _found(pairs, _keys(np.repeat(context, runs), _numbers(wanted, int(runs.sum()))))
            n = np.zeros(len(at))
            found &= np.repeat(there, runs)
            n[found] = counts[at[found]]
            # After what isn't kept, the shorter state says it all.
            left = np.full(len(there), -1.0)
            left[judged] = free[state[context[judged]]]
            own = np.repeat(judged, runs)
            of = state[np.repeat(context[judged], runs[judged])]
            rows.append((block, key[0], (np.maximum(n[own] - taken[of], 0.0) / totals[of]).astype("<f4").tobytes(),
                         left.astype("<f4").tobytes(), np.packbits(n >= least).tobytes()))
        return pd.DataFrame(rows, columns=["block", "bucket", "own", "left", "often"])

    def finish(pdf: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        row, got = pdf.iloc[0], got.sort_values("bucket")
        p = Places(row, least, base)
        f = Followed(p, buckets)
        left = np.repeat(np.frombuffer(b"".join(got["left"]), "<f4"), f.runs())
        kept, own = left >= 0, np.zeros(len(left))
        own[kept] = np.frombuffer(b"".join(got["own"]), "<f4")
        sizes = np.diff(f.ends)
        often = np.concatenate([np.zeros(0, np.uint8), *[np.unpackbits(np.frombuffer(bits, np.uint8), count=size) for bits, size in
                                                         zip(got["often"], sizes[sizes > 0].tolist())]])
        at = np.flatnonzero(kept[f.number])
        of = f.number[at]
        with np.errstate(divide="ignore"):
            p.value[at] = np.logaddexp(p.value[at] + np.log(left[of]), np.log(own[of]))
        if n_all is not None:
            return _scores(row, p, n_all)
        return pd.DataFrame([{"block": row["block"], "doc_ids": row["doc_ids"], "held_out": row["held_out"], **p.lengthened(f, often > 0)}])

    group = F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group")
    asked = followed.select("block", "bucket", "pairs", "contexts", "runs", group)
    known = contexts.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    answers = (asked.groupBy("bucket", "group").cogroup(known.groupBy("bucket", "group"))
               .applyInPandas(lambda key, a, k: answer(key, a, k), "block long, bucket int, own binary, left binary, often binary"))
    answers = stored(answers, "lm-answers", compression="zstd")
    release(contexts)
    return read.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, LIVE if n_all is None else SCORES), answers


def score(docs: DataFrame, held_out, depth: int = DEPTH, min_share: float = MIN_SHARE, gain: float = GAIN,
          context_share: float = CONTEXT_SHARE, buckets: int | None = None, answered: int = ANSWERED_BLOCKS,
          order: int = ORDER, least: int = LEAST) -> DataFrame:
    """Scores of every text of ``docs`` (doc_id, text); learns from rows for which ``held_out`` is false.

    Columns as in SCORES: base_score is the add-0.1 unigram score, score the
    tree's, both log10.  A null text is empty: only its end is a token.  Rows are
    scored one by one, repeated or not; a null ``held_out`` counts as true.
    Without training rows all tokens are unknown.  No rows, no scores.
    """
    with scratch(docs.sparkSession) as own:
        return own.hand_over(_scored(docs, held_out, depth, min_share, gain, context_share, buckets, answered, order, least), "lm-scores")


def _scored(docs: DataFrame, held_out, depth: int, min_share: float, gain: float, context_share: float,
            buckets: int | None, answered: int, order: int, least: int) -> DataFrame:
    text = F.col("text").cast("string")
    plain = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"))
    if buckets is None:
        total = plain.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"]
        buckets = max(16, (total or 0) // BUCKET_BYTES)
    frequent = frequent_words(plain.filter(~F.col("held_out")), context_share)
    blocks = blocks_of(plain, buckets, frequent)
    size = blocks.filter("bucket < 0").count()
    words = count_words(blocks, size)
    states = States.of(words, len(frequent) + 1, gain)
    n_all, n_kinds = int(states.n[-1]), int(states.kinds[-1])
    tree = grow_tree(words, depth, min_share, gain)

    def answer(key, asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame(columns=["block", "bucket", "counts", "scores"])
        found = _combined(known)
        number = {w: i for i, w in enumerate(found["words"])}
        single = states.words(found["counts"], tree.words(found["words"]))
        rows = []
        for block, listed, kinds, of in zip(asked["block"], asked["words"], asked["kinds"], asked["states"]):
            at = np.array([number[w] for w in listed.split(b" ")], np.int64)
            state, owner = np.frombuffer(of, "<u2").astype(np.int64), np.repeat(at, np.frombuffer(kinds, "<u2"))
            # The bucket knows every pair that any block holds.
            pair = np.searchsorted(found["pair"], owner << 16 | state)
            value = states.after(state, found["pair_counts"][pair], single[owner])
            rows.append((block, key[0], found["counts"][at].tobytes(), value.astype("<f4").tobytes()))
        return pd.DataFrame(rows, columns=["block", "bucket", "counts", "scores"])

    groups = max(1, -(-size // answered))
    asked = blocks.filter("bucket >= 0").select("block", "bucket", "words", "kinds", "states",
                                                F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"))
    known = (words.drop("state_sums")
             .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))))
    answers = (asked.groupBy("bucket", "group").cogroup(known.groupBy("bucket", "group"))
               .applyInPandas(lambda key, a, k: answer(key, a, k), "block long, bucket int, counts binary, scores binary"))
    answers = stored(answers, "lm-answers", compression="zstd")
    smooth = 0.1 * (n_kinds + 1)

    def base(counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (n_all + smooth))

    def finish(pdf: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        got = got.sort_values("bucket")
        return pdf.assign(counts=[b"".join(got["counts"])], scores=[_planes(np.frombuffer(b"".join(got["scores"]), "<f4"), "<f4")])

    texts_ = blocks.filter("bucket < 0").select("block", "doc_ids", "held_out", "lengths", "tokens", "kinds", "hashes")
    read = texts_.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, READ)
    release(words)
    used = [blocks, answers]
    for level in range(1, order + 1):
        kept = stored(read, "lm-read", (buckets, "block"), compression="zstd")
        release(*used)  # nothing later reads them
        read, answers = lengthen(kept, buckets, size, groups, gain, least, base, n_all if level == order else None)
        used = [kept, answers]
    if order:
        return read

    def scores(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pandas(_scores(row, Places(row, least, base), n_all), preserve_index=False)

    return read.mapInArrow(scores, SCORES)
