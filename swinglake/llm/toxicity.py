"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; each model reads a text's words and word
beginnings and the probabilities of the categories before it.  In training these come
from models that did not see the row (folds); in scoring, from the models themselves.

The chain is fitted on at most ``MAX_TRAIN`` labelled documents, chosen by a hash of
their ids: that many rows and ``FEATURES`` features per category fit in the driver.
Scoring reads every document once, whole, and shuffles nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import give_back, staged

MAX_TRAIN = 20_000
FEATURES = 1_500      # per category, those that tell most
RATIO = 0.7           # least log ratio of a feature's shares inside and outside a category
SUPPORT = 4           # labelled documents that hold a feature, at least
FOLDS = 5
RIDGE = 1.0
PREFIXES = (4, 5)     # word beginnings, so that unseen endings are known too
THRESHOLD = 0.5

_words = re.compile(r"[^\W\d_]+").findall


def features(text: str | None) -> set[str]:
    """Distinct lower-case words, and their beginnings marked by ``^``."""
    words = set(_words((text or "").lower()))
    return words.union(*({"^" + w[:n] for w in words if len(w) > n} for n in PREFIXES))


@dataclass
class Sparse:
    """Rows of feature numbers, each present or not."""

    column: np.ndarray
    row: np.ndarray
    rows: int
    columns: int

    def times(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=x[self.column], minlength=self.rows)

    def back(self, y: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=y[self.row], minlength=self.columns)

    def columns_at(self, chosen: np.ndarray) -> Sparse:
        number = np.full(self.columns, -1)
        number[chosen] = np.arange(len(chosen))
        column = number[self.column]
        hit = column >= 0
        return Sparse(column[hit], self.row[hit], self.rows, len(chosen))

    def take(self, keep: np.ndarray) -> Sparse:
        number = np.cumsum(keep) - 1
        hit = keep[self.row]
        return Sparse(self.column[hit], number[self.row[hit]], int(keep.sum()), self.columns)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit_logistic(x: Sparse, scale: np.ndarray, dense: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of sparse features (times ``scale``), dense features and the constant.

    Ridge regression of the logit, by Newton steps with conjugate gradients.
    """
    n, k = x.columns, dense.shape[1]
    penalty = np.concatenate([np.full(n + k, RIDGE), [1e-3]])
    w = np.zeros(n + k + 1)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    w[-1] = np.log(share / (1 - share))

    def forward(v: np.ndarray) -> np.ndarray:
        return x.times(v[:n] * scale) + dense @ v[n:n + k] + v[-1]

    def backward(r: np.ndarray) -> np.ndarray:
        return np.concatenate([x.back(r) * scale, dense.T @ r, [r.sum()]])

    def loss(v: np.ndarray) -> float:
        z = forward(v)
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * (penalty * v * v).sum())

    now = loss(w)
    for _ in range(10):
        p = sigmoid(forward(w))
        gradient, curve = backward(p - y) + penalty * w, p * (1 - p)
        step, r = np.zeros_like(w), -gradient
        d, rr = r.copy(), float(r @ r)
        start = rr
        for _ in range(15):
            if rr <= 1e-4 * start:
                break
            h = backward(curve * forward(d)) + penalty * d
            a = rr / float(d @ h)
            step += a * d
            r = r - a * h
            d, rr = r + (float(r @ r) / rr) * d, float(r @ r)
        size = 1.0
        while size > 1e-3 and (new := loss(w + size * step)) > now:
            size /= 2
        if size <= 1e-3 or now - new < 1e-5 * abs(now):
            break
        w, now = w + size * step, new
    return w


@dataclass
class Chain:
    """Per category: weights by feature, weights of the earlier probabilities, constant."""

    names: list[str]
    weights: list[dict[str, float]]
    earlier: list[list[float]]
    constant: list[float]

    def __post_init__(self) -> None:
        joined: dict[str, list[tuple[int, float]]] = {}
        for c, weights in enumerate(self.weights):
            for f, w in weights.items():
                joined.setdefault(f, []).append((c, w))
        self.by_feature = joined

    def probabilities(self, text: str | None) -> list[float]:
        z, get = list(self.constant), self.by_feature.get
        words = set(_words((text or "").lower()))
        marks = {"^" + w[:n] for w in words for n in PREFIXES if len(w) > n}
        for group in (words, marks):
            for f in sorted(group & self.by_feature.keys()):
                for c, w in get(f):
                    z[c] += w
        out: list[float] = []
        for c, x in enumerate(z):
            out.append(float(sigmoid(np.float64(x + sum(a * p for a, p in zip(self.earlier[c], out, strict=True))))))
        return out


def training_rows(docs: DataFrame, labels: DataFrame, categories: Mapping[str, Column], limit: int) -> DataFrame:
    """``doc_id, text`` and a 0/1 column per category: at most ``limit`` labelled documents.

    The ids are chosen first; a row each, they are broadcast and meet the documents in
    their scan.  Of several texts under an id the least is taken, of labels the largest.
    """
    flags = [F.max(F.coalesce(c.cast("int"), F.lit(0))).alias(f"_y{i}") for i, c in enumerate(categories.values())]
    chosen = (labels.where("doc_id is not null").groupBy("doc_id").agg(*flags)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    y = [f"_y{i}" for i in range(len(categories))]
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), *(F.max(c).alias(c) for c in y)))


def _feature_counts(rows: DataFrame, k: int) -> DataFrame:
    """``feature, n`` and per category the count among its rows, over the training rows."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for frame in frames:
            for text, *y in zip(frame["text"], *(frame[f"_y{i}"] for i in range(k)), strict=True):
                here = features(text)
                seen.update((f, -1) for f in here)
                for i in range(k):
                    if y[i]:
                        seen.update((f, i) for f in here)
        yield pd.DataFrame([(f, i, n) for (f, i), n in seen.items()], columns=["feature", "category", "n"])

    parts = rows.mapInPandas(count, "feature string, category int, n long")
    of = lambda i: F.sum(F.when(F.col("category") == i, F.col("n")).otherwise(0))
    return parts.groupBy("feature").agg(of(-1).alias("n"), *(of(i).alias(f"n{i}") for i in range(k)))


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Mapping[str, Column],
              limit: int = MAX_TRAIN) -> Chain:
    """The chain over ``categories``, expressions over ``labels`` in chain order.

    A category without both kinds of rows gets its share as a constant; without any
    labelled document every probability is 0.
    """
    names, k = list(categories), len(categories)
    rows = staged(training_rows(docs, labels, categories, limit), "toxicity-sample")
    totals = rows.agg(F.count("*"), *(F.coalesce(F.sum(f"_y{i}"), F.lit(0)) for i in range(k))).first()
    n, positive = totals[0], list(totals[1:])
    if n == 0:
        return Chain(names, [{} for _ in names], [[0.0] * c for c in range(k)], [-40.0] * k)
    counts = staged(_feature_counts(rows, k).where(F.col("n") >= SUPPORT), "toxicity-features")
    chosen: list[list[str]] = []
    ratios: list[np.ndarray] = []
    for i in range(k):
        inside = (F.col(f"n{i}") + 0.5) / (positive[i] + 1.0)
        outside = (F.col("n") - F.col(f"n{i}") + 0.5) / (n - positive[i] + 1.0)
        ratio = F.log(inside / outside)
        top = (counts.select("feature", ratio.alias("ratio"), (F.abs(ratio) * F.sqrt("n")).alias("worth"))
               .where(F.abs("ratio") >= RATIO).orderBy(F.desc("worth"), "feature").limit(FEATURES).collect())
        chosen.append([r["feature"] for r in top])
        ratios.append(np.array([r["ratio"] for r in top]))
    number = {f: j for j, f in enumerate(sorted(set().union(*chosen)))}

    def present(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["features"] = [sorted(number[f] for f in features(t) if f in number) for t in frame["text"]]
            yield frame.drop(columns="text")

    y_names = [f"_y{i}" for i in range(k)]
    table = (rows.mapInPandas(present, f"doc_id {dict(rows.dtypes)['doc_id']}, "
                              + "".join(f"{c} int, " for c in y_names) + "features array<int>")
             .orderBy("doc_id").toPandas())
    y = table[y_names].to_numpy(dtype=float)
    lengths = table["features"].map(len).to_numpy()
    every = Sparse(np.concatenate([np.asarray(f, dtype=np.int64) for f in table["features"]]),
                   np.repeat(np.arange(n), lengths), n, len(number))
    fold = np.arange(n) % FOLDS
    out_of_fold = np.zeros((n, 0))
    weights, earlier, constant = [], [], []
    for i in range(k):
        share = positive[i] / n
        if share in (0.0, 1.0):
            weights.append({})
            earlier.append([0.0] * i)
            constant.append(-40.0 if share == 0 else 40.0)
            guess = np.full(n, share)
        else:
            scale, own = ratios[i], len(chosen[i])
            x = every.columns_at(np.array([number[f] for f in chosen[i]], dtype=np.int64))
            w = fit_logistic(x, scale, out_of_fold, y[:, i])
            weights.append(dict(zip(chosen[i], map(float, w[:own] * scale), strict=True)))
            earlier.append([float(a) for a in w[own:-1]])
            constant.append(float(w[-1]))
            guess = np.zeros(n)
            for held in range(FOLDS if i + 1 < k else 0):     # the last category feeds none
                inside, outside = fold != held, fold == held
                if not inside.any() or not outside.any():
                    continue
                v = fit_logistic(x.take(inside), scale, out_of_fold[inside], y[inside, i])
                z = x.take(outside).times(v[:own] * scale) + out_of_fold[outside] @ v[own:-1] + v[-1]
                guess[outside] = sigmoid(z)
        out_of_fold = np.column_stack([out_of_fold, guess])
    return Chain(names, weights, earlier, constant)


def scores(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id`` and ``p_<category>``: a row per document; null and empty texts have the constants."""
    k = len(chain.names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [chain.probabilities(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([g[i] for g in got], pa.float64()) for i in range(k))],
                names=["doc_id", *(f"p_{c}" for c in chain.names)])
        give_back()

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}" + "".join(f", `p_{c}` double" for c in chain.names)
    return docs.select("doc_id", "text").mapInArrow(score, schema)


def without_toxic(docs: DataFrame, chain: Chain, category: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` less the rows whose probability of ``category`` reaches the threshold."""
    at, c = docs.columns.index("text"), chain.names.index(category)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([chain.probabilities(t.as_py())[c] < threshold for t in batch.column(at)],
                                        pa.bool_()))
        give_back()

    return docs.mapInArrow(keep, docs.schema)


def label_categories() -> dict[str, Column]:
    """The chain over the table of labels: low quality, toxic, and both at once."""
    junk, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return {"low_quality": junk, "toxic": toxic, "toxic_junk": junk & toxic}
