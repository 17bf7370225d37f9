"""Toxicity by a classifier chain of linear models over words.

The categories are label columns, predicted one after the other.  A category's model sees
the document's words and the probabilities of the categories before it.  For training these
come from out-of-fold predictions, so a later model learns from probabilities as honest as
those it will meet.  The models are fitted on a bounded sample of labelled documents; all
documents are scored on their whole text.
"""

from __future__ import annotations

import re
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, worker_memo

#: Buckets of the hashed words; fixes the size of the models.
BUCKETS = 1 << 20
#: Labelled documents that the models are fitted on, at most, half of them of either class.
TRAIN_ROWS = 12_000
FOLDS = 3
#: A document is toxic from this probability on.
THRESHOLD = 0.35
MEMO = 500_000
_WORD = re.compile(r"\w+")


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        bucket = self[word] = zlib.crc32(word.encode("utf-8", "replace")) & (BUCKETS - 1)
        return bucket


def _bucket_sets(texts: list[str]):
    """Sorted different buckets of each text's words."""
    memo = worker_memo("toxicity", "buckets", _Buckets)
    for text in texts:
        words = set(_WORD.findall(text.lower()))
        yield np.unique(np.fromiter(map(memo.__getitem__, words), np.int32, len(words)))


def _features(batches):
    for batch in batches:
        sets = [x for x in _bucket_sets(batch.column(0).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.int32())), *batch.columns[1:]],
                                         ["words", *batch.schema.names[1:]])


class Linear:
    """Logistic regression on word buckets and a few dense columns.

    Words enter scaled by their log-count ratio between the classes, so a handful of passes
    settles the weights; buckets seen in fewer than ``least`` documents have none.
    """

    def __init__(self, n_dense: int):
        self.weight, self.dense, self.bias = np.zeros(BUCKETS, np.float32), np.zeros(n_dense), 0.0

    def fit(self, words: list[np.ndarray], dense: np.ndarray, y: np.ndarray,
            steps: int = 200, least: int = 3, ridge: float = 5e-4) -> Linear:
        if not len(y) or y.min() == y.max():
            share = (y.sum() + 0.5) / (len(y) + 1.0)
            self.bias = float(np.log(share / (1 - share)))
            return self
        sizes = np.array([len(w) for w in words])
        flat = np.concatenate(words)
        row = np.repeat(np.arange(len(y)), sizes)
        seen = np.bincount(flat, minlength=BUCKETS)
        good = np.bincount(flat, weights=y[row], minlength=BUCKETS)
        a, b = y.sum(), len(y) - y.sum()
        ratio = np.log((good + 0.5) / (a + 1.0)) - np.log((seen - good + 0.5) / (b + 1.0))
        ratio[seen < least] = 0
        used = ratio[flat] != 0
        flat, row = flat[used], row[used]
        # the words in use, numbered
        names, flat = np.unique(flat, return_inverse=True)
        scale = ratio[names]
        value = scale[flat]
        w, d, bias = np.zeros(len(names)), np.zeros(dense.shape[1]), float(np.log(a / b))
        # per-weight curvature bounds keep the steps of frequent and rare words apart
        curve = np.bincount(flat, weights=value**2, minlength=len(names)) / len(y) / 4 + ridge
        curve_d = (dense**2).mean(0) / 4 + ridge if dense.shape[1] else d
        active = max(1.0, np.bincount(row, minlength=len(y)).mean() ** 0.5)
        momentum = [np.zeros_like(w), np.zeros_like(d), 0.0]
        for _ in range(steps):
            z = np.bincount(row, weights=w[flat] * value, minlength=len(y)) + dense @ d + bias
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            grads = (np.bincount(flat, weights=error[row] * value, minlength=len(names)) / len(y) + ridge * w,
                     dense.T @ error / len(y) + ridge * d, error.mean())
            momentum = [0.8 * m + g for m, g in zip(momentum, grads, strict=True)]
            w -= 0.2 * momentum[0] / curve / active
            d -= 0.2 * momentum[1] / (curve_d if len(d) else 1.0) / active
            bias -= 0.2 * momentum[2] * 4 / active
        self.weight[names] = w * scale
        self.dense, self.bias = d, bias
        return self

    def predict(self, words: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        sums = np.array([self.weight[x].sum(dtype=np.float64) for x in words]) if words else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(sums + dense @ self.dense + self.bias, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-4, 1 - 1e-4) / np.clip(1 - p, 1e-4, 1))


class Chain:
    """One linear model per category; each sees the log odds of the categories before it."""

    def __init__(self, categories: list[str]):
        self.categories, self.models = categories, []
        self.key = tuple(categories)

    def fit(self, words: list[np.ndarray], y: dict[str, np.ndarray], folds: int = FOLDS) -> Chain:
        fold = np.arange(len(words)) % folds
        dense = np.zeros((len(words), 0))
        for c in self.categories:
            known = ~np.isnan(y[c])
            held_out = np.zeros(len(words))
            for k in range(folds):
                rows, rest = np.flatnonzero(known & (fold != k)), np.flatnonzero(fold == k)
                part = Linear(dense.shape[1]).fit([words[i] for i in rows], dense[rows], y[c][rows])
                held_out[rest] = part.predict([words[i] for i in rest], dense[rest])
            rows = np.flatnonzero(known)
            self.models.append(Linear(dense.shape[1]).fit([words[i] for i in rows], dense[rows], y[c][rows]))
            dense = np.column_stack([dense, _logit(held_out)])
        return self

    def predict(self, words: list[np.ndarray]) -> np.ndarray:
        dense, out = np.zeros((len(words), 0)), []
        for model in self.models:
            out.append(model.predict(words, dense))
            dense = np.column_stack([dense, _logit(out[-1])])
        return np.column_stack(out) if out else dense


def training_sample(docs: DataFrame, labels: DataFrame, categories: list[str], rows: int = TRAIN_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """words and the categories of at most ``rows`` labelled documents.

    Per category, up to an equal share of the positive rows and of the others, by the hash
    of the id.  The sample's ids are broadcast: ``rows`` bounds them.  Where labels of an id
    differ the largest counts; of different texts of an id the first in byte order is learnt.
    """
    named = labels.select(F.col(id_col).cast("long").alias("__id"), *(F.col(c).cast("double").alias(c) for c in categories)) \
        .where("__id is not null").groupBy("__id").agg(*(F.max(c).alias(c) for c in categories))
    share = max(1, rows // (2 * len(categories)))
    order = (F.xxhash64("__id"), "__id")
    picks = [named.where(F.col(c) == v).orderBy(*order).limit(share) for c in categories for v in (1, 0)]
    ids = reduce(DataFrame.unionByName, picks).distinct()
    return (docs.select(F.col(id_col).cast("long").alias("__id"), text_of(text_col).alias("__body"))
            .join(F.broadcast(ids), "__id").groupBy("__id", *categories).agg(F.min("__body").alias("__body"))
            .select("__body", "__id", *categories)
            .mapInArrow(_features, "words array<int>, __id long, " + ", ".join(f"{c} double" for c in categories)))


def train(docs: DataFrame, labels: DataFrame, categories: list[str], rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain on the bounded sample; null labels are left out of their category."""
    sample = training_sample(docs, labels, categories, rows, id_col, text_col).toPandas().sort_values("__id")
    words = [np.asarray(w, np.int32) for w in sample["words"]]
    return Chain(categories).fit(words, {c: sample[c].to_numpy(np.float64) for c in categories})


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Per document: id, p_<category> for each category, <last category> as boolean.

    Null text is empty and gets the models' base rates; repeated rows get the same answer;
    other columns play no part; an empty table gives an empty result.  A probability at the
    threshold counts as toxic.  Without labels every probability is one half and nothing is toxic.
    """
    last, names = chain.categories[-1], [f"p_{c}" for c in chain.categories]

    def run(batches):
        for batch in batches:
            p = chain.predict(list(_bucket_sets(batch.column(1).to_pylist())))
            p = p if len(p) else np.zeros((batch.num_rows, len(names)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, i]) for i in range(len(names)))],
                                             [id_col, *names])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("__body"))
    scored = rows.mapInArrow(run, f"{id_col} long, " + ", ".join(f"{n} double" for n in names))
    fitted = any(m.weight.any() for m in chain.models)
    return scored.withColumn(last, (F.col(f"p_{last}") >= threshold) & F.lit(fitted))


def toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], **options) -> DataFrame:
    """Train on ``labels`` and score every document."""
    rows = options.pop("rows", TRAIN_ROWS)
    columns = {k: options[k] for k in ("id_col", "text_col") if k in options}
    return score(docs, train(docs, labels, categories, rows, **columns), **options)
