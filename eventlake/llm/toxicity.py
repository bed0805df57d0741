"""Toxicity by a classifier chain.

Categories are predicted one after another: the linear model of a category sees
the text's features and the probabilities of the categories before it. For
training, those probabilities are out of fold: the model that gives them has not
seen the row, so later models learn how far earlier ones can be trusted. The
last pass scores every document in one Arrow pass with the final models.

The models are fitted on at most about ``max_labelled`` labelled documents
(``linear.MAX_LABELLED``). A category counts as present above the threshold with
the best F1 score of its out-of-fold probabilities.

Defined results: null and empty texts have the probabilities of a text without
words; null labels are ignored, of repeated labels the smallest combination counts;
with no labelled document, or a category that all or none have, the probability
is the category's share (0 without labels) and nothing is flagged by it; input
columns are not returned except doc_id; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm import hashing, linear


@dataclass
class Chain:
    names: list[str]
    vocabulary: np.ndarray
    models: list[linear.Linear | float]  # a number where a category does not vary
    thresholds: list[float]

    def probabilities(self, r: linear.Rows) -> np.ndarray:
        r = r.within(self.vocabulary)
        out = []
        for m in self.models:
            p = np.full(r.n, m) if isinstance(m, float) else m.probability(r)
            out.append(p)
            r = r.plus(p)
        return np.column_stack(out)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Half way below the last score taken by the cut with the best F1."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + y.sum())
    last = np.append(p[order][1:] != p[order][:-1], True)
    k = int(np.argmax(np.where(last, f1, -1)))
    after = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + after) / 2)


def fit_chain(vocabulary: np.ndarray, rows: linear.Rows, labels: np.ndarray, ids: np.ndarray,
              names: list[str], folds: int = 3) -> Chain:
    """``labels``: a 0/1 column per category in chain order; folds go by a hash of the id."""
    fold = (hashing.splitmix(ids.view(np.uint64)) % np.uint64(folds)).astype(int)
    models, thresholds, r = [], [], rows
    for j in range(len(names)):
        y = labels[:, j].astype(float) if len(labels) else np.zeros(0)
        oof = np.full(rows.n, y.mean() if len(y) else 0.0)
        if 0 < y.sum() < len(y):
            for f in range(folds):
                train, held = fold != f, fold == f
                if held.any() and 0 < y[train].sum() < train.sum():
                    oof[held] = linear.fit(r.take(train), y[train], len(vocabulary)).probability(r.take(held))
            models.append(linear.fit(r, y, len(vocabulary)))
            thresholds.append(best_threshold(oof, y))
        else:
            models.append(float(y.mean()) if len(y) else 0.0)
            thresholds.append(1.0)
        r = r.plus(oof)
    return Chain(names, vocabulary, models, thresholds)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column | str],
          max_labelled: int = linear.MAX_LABELLED) -> Chain:
    """A chain for ``categories`` (name -> boolean over the label columns, a column or SQL), in their order."""
    names = list(categories)
    code = F.lit(0)
    for j, c in enumerate(map(linear.condition, categories.values())):
        code = code + F.when(c, F.lit(1 << j)).when(~c, F.lit(0))
    words, rows, cls, ids = linear.training_rows(docs, labels, code, max_labelled)
    return fit_chain(words, rows, np.column_stack([(cls >> j) & 1 for j in range(len(names))]), ids, names)


def _score(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, r in linear.features(b.column(1)):
                p = chain.probabilities(r)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), *[pa.array(p[:, j]) for j in range(p.shape[1])]],
                    names=["doc_id", *[f"p_{n}" for n in chain.names]])

    return run


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, p_<category> (double) and <category> (boolean) of every row of ``docs`` (doc_id, text)."""
    for m in (__name__, linear.__name__, hashing.__name__):
        ship_by_value(m)
    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
           .mapInArrow(_score(chain), ", ".join(["doc_id long", *[f"p_{n} double" for n in chain.names]])))
    return out.withColumns({n: F.col(f"p_{n}") > t for n, t in zip(chain.names, chain.thresholds)})
