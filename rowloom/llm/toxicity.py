"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other: the model of each gets the words of
the text and the probabilities of the categories before it.  What it sees of those
while it learns are out-of-fold predictions: made by models that did not learn
from that row, and so as unsure as they will be on new texts.

A model is a logistic regression over the presence of words and of their beginnings
(stems that take many endings), with an L1 penalty on each of SIGMAS standard
deviations of the gradient that chance alone gives: only features whose link to the
label can't be chance get a weight.  Learning takes at
most TRAIN_ROWS labelled documents, the same at every size; prediction reads every
text whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rowloom.llm.common import alnum_words, passing, pieces, scratch, stored, texts

#: Categories in the order of the chain: columns of the labels, 0 or 1.
CATEGORIES = ("quality", "toxic")
TRAIN_ROWS = 10_000
FOLDS = 3
SIGMAS = 4.0
RIDGE = 0.5
#: Features in fewer training texts are left out.
LEAST_TEXTS = 3
#: Bytes of a word that count as a beginning.
BEGINNINGS = (4, 5, 6)
BATCH_ROWS = 1_000

MODEL = "category int, feature long, weight double"


class Rows:
    """Presence of features in rows: row numbers and feature numbers of all ones."""

    def __init__(self, row: np.ndarray, feature: np.ndarray, rows: int, features: int):
        self.row, self.feature, self.rows, self.features = row, feature, rows, features

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature], self.rows)

    def summed(self, values: np.ndarray) -> np.ndarray:
        """For each feature the sum of the values of its rows."""
        return np.bincount(self.feature, values[self.row], self.features)

    def only(self, rows: np.ndarray | None = None, features: np.ndarray | None = None) -> "Rows":
        """The given rows, or the given features under new numbers."""
        if rows is not None:
            keep = rows[self.row]
            return Rows(self.row[keep], self.feature[keep], self.rows, self.features)
        number = np.full(self.features, -1)
        number[features] = np.arange(len(features))
        keep = number[self.feature] >= 0
        return Rows(self.row[keep], number[self.feature[keep]], self.rows, len(features))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def descend(x: Rows, dense: np.ndarray, y: np.ndarray, used: np.ndarray, w: np.ndarray, v: np.ndarray,
            limit: np.ndarray | float, ridge: float, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Accelerated proximal steps, each coordinate with its own curvature bound."""
    size = x.times(np.ones(x.features)) + np.abs(dense).sum(1)
    bound = 0.25 * x.summed(size) + ridge + 1e-6
    bound_dense = 0.25 * (np.abs(dense) * (size * used)[:, None]).sum(0) + 1e-3
    w_next, v_next, pace = w.copy(), v.copy(), 1.0
    for _ in range(steps):
        error = np.where(used, sigmoid(x.times(w_next) + dense @ v_next) - y, 0.0)
        step = w_next - (x.summed(error) + ridge * w_next) / bound
        new_w = np.sign(step) * np.maximum(np.abs(step) - limit / bound, 0)
        new_v = v_next - (dense.T @ error + np.r_[1e-2 * v_next[:-1], 0.0]) / bound_dense
        new_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        if np.dot(w_next - new_w, new_w - w) + np.dot(v_next - new_v, new_v - v) > 0:
            new_pace = 1.0  # the way turned: start the acceleration anew
        w_next = new_w + (pace - 1) / new_pace * (new_w - w)
        v_next = new_v + (pace - 1) / new_pace * (new_v - v)
        moved = max(np.abs(new_w - w).max(initial=0), np.abs(new_v - v).max(initial=0))
        w, v, pace = new_w, new_v, new_pace
        if moved < 1e-4:
            break
    return w, v


def fit_logistic(x: Rows, dense: np.ndarray, y: np.ndarray, used: np.ndarray,
                 sigmas: float = SIGMAS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features, and of the dense columns with the intercept last.

    Features are selected under the L1 penalty, looking only at those that may
    matter and adding any that turn out to; the selected ones are then fitted anew
    under a small ridge, as the penalty shrinks what it selects.  Without both
    labels among the used rows, only the intercept.
    """
    n, rate = used.sum(), float(np.clip(y[used].mean(), 1e-3, 1 - 1e-3)) if used.any() else 0.5
    dense = np.column_stack((dense, np.ones(len(y))))
    weights, others = np.zeros(x.features), np.zeros(dense.shape[1])
    others[-1] = np.log(rate / (1 - rate))
    if not used.any() or y[used].min() == y[used].max():
        return weights, others
    x = x.only(rows=used)
    texts_with = x.summed(used.astype(float))
    penalty = sigmas * np.sqrt(np.maximum(texts_with * (1 - texts_with / n), 0) * rate * (1 - rate)) + 1e-9
    active = np.empty(0, np.int64)
    for _ in range(6):
        error = np.where(used, sigmoid(x.times(weights) + dense @ others) - y, 0.0)
        slope = np.abs(x.summed(error))
        found = np.flatnonzero((slope > penalty * (1.0 if len(active) else 0.8)) | (weights != 0))
        if len(active) and not np.setdiff1d(found, active).size:
            break
        active = np.union1d(active, found)
        weights[active], others = descend(x.only(features=active), dense, y, used, weights[active], others, penalty[active], 0.0)
    chosen = np.flatnonzero(weights)
    if len(chosen):
        weights[chosen], others = descend(x.only(features=chosen), dense, y, used, weights[chosen], others, 0.0, RIDGE)
    return weights, others


def frequent(features: list[np.ndarray]) -> np.ndarray:
    """The features of at least LEAST_TEXTS texts, ascending; a text has a feature once."""
    ordered = np.concatenate([*features, np.empty(0, np.int64)])
    ordered.sort()
    last = len(ordered) - LEAST_TEXTS + 1
    return np.unique(ordered[:max(0, last)][ordered[:max(0, last)] == ordered[LEAST_TEXTS - 1:]])


def numbered(features: list[np.ndarray], known: np.ndarray) -> Rows:
    """The known features of each text by their places, in 32 bits; a text at a time, so rare ones take no room."""
    columns = [np.empty(0, np.int32)]
    for own in features:
        at = np.searchsorted(known, own)
        here = at < len(known)
        here[here] = known[at[here]] == own[here]
        columns.append(at[here].astype(np.int32))
    row = np.repeat(np.arange(len(features), dtype=np.int32), [len(c) for c in columns[1:]])
    return Rows(row, np.concatenate(columns), len(features), len(known))


def fit_chain(features: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, n_folds: int = FOLDS,
              sigmas: float = SIGMAS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, float]]]:
    """Feature hashes, and per category weights, weights of earlier categories with the intercept, and threshold.

    ``labels`` has a column per category, NaN where a row has no label for it.  The
    threshold is the probability that separates the out-of-fold predictions best (F1).
    """
    known = frequent(features)
    x = numbered(features, known)
    earlier, models = np.zeros((len(features), 0)), []
    for y in labels.T:
        has = ~np.isnan(y)
        y = np.where(has, y, 0.0)
        unseen = np.zeros(len(y))
        for fold in range(n_folds):
            w, v = fit_logistic(x, earlier, y, has & (folds != fold), sigmas)
            p = sigmoid(x.times(w) + np.column_stack((earlier, np.ones(len(y)))) @ v)
            unseen = np.where(folds == fold, p, unseen)
        w, v = fit_logistic(x, earlier, y, has, sigmas)
        models.append((w, v, best_threshold(unseen[has], y[has])))
        earlier = np.column_stack((earlier, unseen))
    return known, models


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle between the two predictions where cutting gives the best F1; 0.5 without positives."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    f1[:-1][p[1:] == p[:-1]] = 0  # equal predictions aren't cut apart
    at = int(f1.argmax())
    return float((p[at] + (p[at + 1] if at + 1 < len(p) else 0.0)) / 2)


def features_of(text: bytes) -> set[bytes]:
    """The words, and the beginnings of longer ones with a star."""
    words = set(alnum_words(text))
    return words.union(*({w[:n] + b"*" for w in words if len(w) > n} for n in BEGINNINGS))


class Chain:
    """Weights by feature for each category, in the order of the chain."""

    def __init__(self, categories: tuple[str, ...], words: dict[bytes, np.ndarray], others: list[np.ndarray],
                 thresholds: list[float]):
        self.categories, self.words, self.others, self.thresholds = categories, words, others, thresholds
        self._words = frozenset(w for w in words if not w.endswith(b"*"))
        self._stars = [(n, frozenset(w for w in words if w.endswith(b"*") and len(w) == n + 1)) for n in BEGINNINGS]

    def probabilities(self, text: bytes) -> list[float]:
        words = set(alnum_words(text))
        found = words & self._words
        for n, stars in self._stars:
            if stars:
                found |= stars.intersection([w[:n] + b"*" for w in words if len(w) > n])
        sums = np.sum([self.words[w] for w in sorted(found)], axis=0) if found else np.zeros(len(self.categories))
        p: list[float] = []
        for total, v in zip(sums, self.others):
            p.append(float(sigmoid(total + np.dot(v[:-1], p) + v[-1])))
        return p


def _features(text: bytes) -> np.ndarray:
    return np.array(sorted({xxhash.xxh3_64_intdigest(w) for w in features_of(text)}), np.uint64).view(np.int64)


def learn(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, limit: int = TRAIN_ROWS,
          folds: int = FOLDS, sigmas: float = SIGMAS) -> Chain:
    """A chain from labelled texts.

    Of several labels of a doc_id the largest counts; of several texts one is
    taken; null labels teach nothing for their category; labels without a text,
    null texts and null doc_ids are left out.  Without any training rows all
    probabilities are one half and nothing reaches the threshold.
    """
    with scratch(docs.sparkSession):
        return _learned(docs, labels, categories, limit, folds, sigmas)


def _learned(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], limit: int, folds: int, sigmas: float) -> Chain:
    wanted = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(*[F.max(F.col(c).cast("int")).alias(f"_y{i}") for i, c in enumerate(categories)])
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    own = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"),
                                                       F.col("text").cast("string").alias("text"))
    # At most ``limit`` rows of a few numbers are broadcast.
    joined = own.join(F.broadcast(wanted), "doc_id")
    sample = stored(joined.groupBy("doc_id").agg(F.min("text").alias("text"), *[F.first(f"_y{i}").alias(f"_y{i}")
                                                                              for i in range(len(categories))]), "toxicity-sample")

    def extract(batches):
        for batch in pieces(batches, BATCH_ROWS):
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([_features(t).tobytes() for t in texts(batch["text"])], pa.binary())]
                + [batch[f"_y{i}"] for i in range(len(categories))],
                names=["doc_id", "features"] + [f"_y{i}" for i in range(len(categories))])

    kinds = ", ".join(f"_y{i} int" for i in range(len(categories)))
    rows = sample.mapInArrow(extract, f"doc_id long, features binary, {kinds}")

    def train(batches):
        parts = list(batches)
        if not parts:
            return
        pdf = pd.concat(parts).sort_values("doc_id")
        features = [np.frombuffer(f, np.int64) for f in pdf["features"]]
        y = pdf[[f"_y{i}" for i in range(len(categories))]].to_numpy(float)
        fold = np.array([xxhash.xxh3_64_intdigest(str(d).encode()) % folds for d in pdf["doc_id"]])
        known, models = fit_chain(features, y, fold, folds, sigmas)
        for i, (w, v, threshold) in enumerate(models):
            used = np.flatnonzero(w)
            yield pd.DataFrame({"category": i, "feature": known[used], "weight": w[used]})
            # Features below the number of categories: earlier ones, then the intercept; the threshold comes last.
            yield pd.DataFrame({"category": -1 - i, "feature": np.arange(len(v) + 1), "weight": np.append(v, threshold)})

    # One task learns from the bounded sample.
    found = stored(rows.repartition(1).mapInPandas(train, MODEL), "toxicity-model").toPandas()
    others, thresholds = [np.zeros(i + 1) for i in range(len(categories))], [2.0] * len(categories)
    for i in range(len(categories)):
        own_rows = found[found["category"] == -1 - i].sort_values("feature")
        if len(own_rows):
            others[i], thresholds[i] = own_rows["weight"].to_numpy()[:-1], float(own_rows["weight"].iloc[-1])
    weights: dict[int, np.ndarray] = {}
    for category, feature, weight in found[found["category"] >= 0].itertuples(index=False):
        weights.setdefault(int(feature), np.zeros(len(categories)))[int(category)] = weight
    wanted_hashes = frozenset(weights)

    def spell(batches):
        for batch in pieces(batches, BATCH_ROWS):
            words = set().union(*(features_of(t) for t in texts(batch["text"])))
            words = [w for w in words if np.uint64(xxhash.xxh3_64_intdigest(w)).view(np.int64).item() in wanted_hashes]
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary())})

    spelled = sample.select("text").mapInArrow(spell, "word binary").distinct().collect() if weights else []
    return Chain(tuple(categories), {bytes(r["word"]): weights[np.uint64(xxhash.xxh3_64_intdigest(bytes(r["word"]))).view(np.int64).item()]
                                     for r in spelled}, others, thresholds)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, p_<category> for every category, and ``rejected``: the last one reaches its threshold.

    Null and empty texts hold no words and are never rejected; rows are judged one
    by one.
    """
    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in chain.categories) + ", rejected boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(predictor(chain), schema)


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` without the rows that the chain rejects, all columns as they are; judged in the pass that reads them."""
    return passing(docs, predictor(chain), lambda found: ~found["rejected"].to_numpy(zero_copy_only=False), BATCH_ROWS)


def predictor(chain: Chain):
    """What ``score`` does with batches of (doc_id, text)."""
    names = [f"p_{c}" for c in chain.categories]

    def predict(batches):
        for batch in pieces(batches, BATCH_ROWS):
            found = [chain.probabilities(t) for t in texts(batch["text"])]
            p = np.array(found, float).reshape(-1, len(names))
            worded = np.array([len(t) > 0 for t in texts(batch["text"])], bool)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c) for c in p.T], pa.array((p[:, -1] >= chain.thresholds[-1]) & worded)],
                names=["doc_id", *names, "rejected"])

    return predict
