"""Linear text classifiers: features, vocabulary choice and fitting.

Features of a text are its words (runs of letters, digits and non-ASCII bytes, in
lower case) and their first six bytes, each as a 64-bit hash with value
ln(1 + count), plus a few shares that do not depend on words. They come from
whole Arrow batches by array operations. Fitting works on a bounded, documented
sample of labelled rows: Spark counts and selects the vocabulary, the driver sees
the sample's entries of that vocabulary only. Scoring is one Arrow pass over
any number of rows. Used by the toxicity chain and the domain classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm import hashing
from eventlake.llm.common import reliable, sample_fraction
from eventlake.llm.hashing import SpanHash, text_slices

PREFIX = 6
SHARES = 5
MAX_LABELLED = 12_000  # bound of the sample of labelled rows that models are fitted on
VOCABULARY = 4_000

_BYTES = np.arange(256)
_WORD = ((_BYTES >= 48) & (_BYTES < 58)) | ((_BYTES >= 97) & (_BYTES < 123)) | ((_BYTES >= 65) & (_BYTES < 91)) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES < 58)
_UPPER = (_BYTES >= 65) & (_BYTES < 91)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES < 14))
_SYMBOL = (_BYTES < 128) & ~_WORD & ~_SPACE


@dataclass
class Rows:
    """Sparse rows: entry k has feature ``key[k]`` with value ``x[k]`` in row ``row[k]``; ``dense``: further columns."""
    n: int
    row: np.ndarray
    key: np.ndarray
    x: np.ndarray
    dense: np.ndarray

    def take(self, keep: np.ndarray) -> Rows:
        at, on = np.cumsum(keep) - 1, keep[self.row]
        return Rows(int(keep.sum()), at[self.row[on]], self.key[on], self.x[on], self.dense[keep])

    def within(self, vocabulary: np.ndarray) -> Rows:
        """Entries of the sorted ``vocabulary`` only, their keys as its positions."""
        if not len(vocabulary):
            return Rows(self.n, self.row[:0], self.row[:0], self.x[:0], self.dense)
        at = np.minimum(np.searchsorted(vocabulary, self.key), len(vocabulary) - 1)
        on = vocabulary[at] == self.key
        return Rows(self.n, self.row[on], at[on], self.x[on], self.dense)

    def plus(self, column: np.ndarray) -> Rows:
        return Rows(self.n, self.row, self.key, self.x, np.column_stack([self.dense, column]))


def features(column: pa.Array) -> Iterator[tuple[int, int, Rows]]:
    """(first row, row after the last, features) of slices of a column of texts."""
    for a, z, data, offsets in text_slices(column):
        n = z - a
        lower = pc.utf8_lower(column.slice(a, n).cast(pa.large_string()).fill_null(""))
        if isinstance(lower, pa.ChunkedArray):
            lower = lower.combine_chunks()
        off = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset:lower.offset + n + 1]
        low = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
        start, end, row = hashing.spans(low, off - off[0], _WORD)
        sums = SpanHash(low, 5)
        long = end - start > PREFIX
        key = np.concatenate([sums.of(start, end),
                              hashing.splitmix(sums.of(start[long], start[long] + PREFIX))]) if len(start) else np.empty(0, np.uint64)
        rows = np.concatenate([row, row[long]])
        order = np.lexsort((key, rows))
        key, rows = key[order], rows[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (rows[1:] != rows[:-1])]) if len(key) else np.empty(0, bool)
        at = np.flatnonzero(new)
        x = np.log1p(np.diff(np.append(at, len(key))).astype(float))
        size = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask[data])])[offsets])
        words = np.maximum(1, np.bincount(row, minlength=n))
        chars = np.maximum(1, np.diff(offsets))
        distinct = np.bincount(rows[at], minlength=n)
        dense = np.column_stack([size(_SYMBOL) / words, size(_UPPER) / chars, size(_DIGIT) / chars,
                                 distinct / words, chars / words / 10])
        yield a, z, Rows(n, rows[at], key[at], x, dense)


@dataclass
class Linear:
    """A binary logistic model over vocabulary positions and dense columns."""
    words: np.ndarray
    dense: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def score(self, r: Rows) -> np.ndarray:
        z = np.bincount(r.row, weights=r.x * self.words[r.key], minlength=r.n) if len(r.row) else np.zeros(r.n)
        return z + (r.dense - self.mean) / self.scale @ self.dense + self.bias

    def probability(self, r: Rows) -> np.ndarray:
        return sigmoid(self.score(r))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(r: Rows, y: np.ndarray, n_words: int, l2: float = 3e-4, steps: int = 300) -> Linear:
    """Logistic regression by accelerated gradient descent, step size from the largest
    curvature (power iteration). Classes weigh alike. Rows alone decide the result."""
    mean, scale = r.dense.mean(axis=0), r.dense.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    d = (r.dense - mean) / scale
    w = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, len(y) - y.sum()))
    ahead = lambda a, b, c: np.bincount(r.row, weights=r.x * a[r.key], minlength=r.n) + d @ b + c
    back = lambda g: (np.bincount(r.key, weights=r.x * g[r.row], minlength=n_words), d.T @ g, g.sum())
    v = (np.ones(n_words), np.ones(d.shape[1]), 1.0)
    top = 1.0
    for _ in range(20):
        v = back(0.25 * w * ahead(*v))
        top = np.sqrt((v[0]**2).sum() + (v[1]**2).sum() + v[2]**2)
        v = tuple(x / max(top, 1e-12) for x in v)
    step = 1 / (1.1 * top + l2)
    m = (np.zeros(n_words), np.zeros(d.shape[1]), 0.0)
    a = m
    for k in range(1, steps + 1):
        g = back(w * (sigmoid(ahead(*a)) - y))
        new = (a[0] - step * (g[0] + l2 * a[0]), a[1] - step * (g[1] + l2 * a[1]), a[2] - step * g[2])
        a = tuple(x + (k - 1) / (k + 2) * (x - o) for x, o in zip(new, m))
        m = new
    return Linear(m[0], m[1], m[2], mean, scale)


def condition(c: Column | str) -> Column:
    """A condition given as a column or as SQL text."""
    return F.expr(c) if isinstance(c, str) else c


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, class, text) -> (id, class, keys, values, shares), one row per text."""
    for b in batches:
        for a, z, r in features(b.column(2)):
            lo = np.searchsorted(r.row, np.arange(r.n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(a, z - a), b.column(1).slice(a, z - a),
                 pa.ListArray.from_arrays(lo, r.key.view(np.int64)), pa.ListArray.from_arrays(lo, r.x),
                 pa.ListArray.from_arrays(np.arange(r.n + 1, dtype=np.int32) * SHARES, r.dense.ravel())],
                names=["doc_id", "cls", "keys", "xs", "shares"])


def labelled_sample(docs: DataFrame, labels: DataFrame, cls: Column, max_labelled: int) -> DataFrame:
    """(doc_id, cls, text) of about ``max_labelled`` labelled documents, chosen by a
    hash of the id. ``cls`` (an int over the label columns; null: unlabelled) is the
    class; of repeated labels the smallest counts. The label sample has the bound
    above, so it is broadcast to the scan."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), cls.cast("int").alias("cls")).dropna()
    lab = sample_fraction(lab.groupBy("doc_id").agg(F.min("cls").alias("cls")), F.col("doc_id"), max_labelled)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(lab), "doc_id").select("doc_id", "cls", "text"))


def training_rows(docs: DataFrame, labels: DataFrame, cls: Column, max_labelled: int = MAX_LABELLED,
                  vocabulary: int = VOCABULARY, min_df: int = 3) -> tuple[np.ndarray, Rows, np.ndarray, np.ndarray]:
    """(sorted vocabulary, rows over it, class of each row, id of each row). The
    vocabulary has the features whose document frequencies differ most between the
    classes (chi-squared over all classes)."""
    ship_by_value(__name__)
    ship_by_value(hashing.__name__)
    rows = reliable(labelled_sample(docs, labels, cls, max_labelled).mapInArrow(
        _sample_features, "doc_id long, cls int, keys array<long>, xs array<double>, shares array<double>"))
    n = {r["cls"]: r["n"] for r in rows.groupBy("cls").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    worth = F.lit(0.0)
    for c, size in n.items():
        expect = F.col("df") * (size / total)
        worth = worth + (F.col(f"c{c}") - expect) ** 2 / expect + (expect - F.col(f"c{c}")) ** 2 / (size - expect + 1e-9)
    best = (rows.select("cls", F.explode("keys").alias("key")).groupBy("key")
            .agg(F.count("*").alias("df"), *[F.count_if(F.col("cls") == c).alias(f"c{c}") for c in n])
            .where(F.col("df") >= min_df).select("key", worth.alias("worth"))
            .orderBy(F.desc("worth"), "key").limit(vocabulary).collect()) if n else []
    words = np.sort(np.array([r["key"] for r in best], np.int64).view(np.uint64))
    book = rows.sparkSession.createDataFrame([(int(k),) for k in words.view(np.int64)], "key long")
    entries = (rows.select("doc_id", F.explode(F.arrays_zip("keys", "xs")).alias("e"))
               .select("doc_id", F.col("e.keys").alias("key"), F.col("e.xs").alias("x"))
               .join(F.broadcast(book), "key").groupBy("doc_id")  # at most ``vocabulary`` keys
               .agg(F.sort_array(F.collect_set(F.struct("key", "x"))).alias("on")))
    small = (rows.select("doc_id", "cls", "shares").join(entries, "doc_id", "left").dropDuplicates(["doc_id"])
             .orderBy("doc_id").toArrow())  # columns, not row objects: some 16 bytes an entry
    on = small["on"].combine_chunks().fill_null([]) if small.num_rows else pa.array([], pa.list_(pa.struct([("key", pa.int64()), ("x", pa.float64())])))
    sizes = pc.list_value_length(on).to_numpy(zero_copy_only=False)
    flat = on.flatten()
    row = np.repeat(np.arange(small.num_rows), sizes)
    key = flat.field("key").to_numpy(zero_copy_only=False).view(np.uint64)
    x = flat.field("x").to_numpy(zero_copy_only=False)
    dense = small["shares"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(small.num_rows, SHARES) \
        if small.num_rows else np.zeros((0, SHARES))
    return (words, Rows(small.num_rows, row, key, x, dense).within(words),
            small["cls"].to_numpy().astype(int), small["doc_id"].to_numpy().astype(np.int64))
