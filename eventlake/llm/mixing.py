"""Mixing to target weights with soft domain membership.

A classifier fitted on the label table gives every document a posterior over
domains. Document rates (expected copies) are then fitted by projected-gradient
least squares: with t tokens and posterior p a document adds t * rate * p to the
domains' expected token totals, and the totals should equal the targets. Rates
start at 1 and change by the posterior, not by the length, so a document is never
preferred for being long; they are nonnegative, and bounded above only where the
caller gives a ``max_rate``.

Posteriors are multiples of 1/``GRID``, so documents of equal posterior, whose rates
are equal in every step, form one *class* with their tokens summed: one aggregate
over the documents, then the steps run over the table of classes, whose size is
bounded by the grid and not by the corpus. Each step is one distributed sum of K
totals and of the K x K matrix sum t p p' of the rates that are free to move; the
gradient is taken in the metric that whitens those totals, so a few steps suffice. A
step that brings the totals no nearer is taken again in the metric of all
rates, which never overshoots. The fit ends when every total is within
``tolerance`` of its target, or when a full step no longer changes the totals, then
the targets are out of reach of the rates' bounds; the ``Mix`` says which, with the
totals reached, and a warning is given.

Targets: the weights, times a total that leaves the ``anchor`` domain (the one with
the most expected tokens unless named) at ``1 - headroom`` of its present size. Tokens
are words between white space. Copies of a document: its rate rounded up or down by a
hash of its id, so expectations are exact and reruns agree.

Defined results: null and empty texts have no tokens, and a rate like others of
their posterior; rows with the same id get the same number of copies each; without
labelled documents, or with one domain only, all rates are 1; domains of weight 0
fade out; an empty table stays empty; input columns are returned as given."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from eventlake.functions.shipping import ship_by_value
from eventlake.llm import linear
from eventlake.llm.common import reliable
from eventlake.llm.hashing import text_slices, word_spans
from eventlake.session import scratch_path

P, TOKENS, RATE = "__posterior", "__tokens", "__rate"
GRID = 1000  # posteriors are multiples of 1 / GRID
MAX_STEPS = 40
BROADCAST_CLASSES = 100_000  # more posterior classes than these are joined by a shuffle


@dataclass
class Domains:
    names: list[str]
    vocabulary: np.ndarray
    models: list[linear.Linear | None]
    priors: np.ndarray

    def posterior(self, r: linear.Rows) -> np.ndarray:
        """One model per domain against the rest, fitted with equal class weights;
        its odds times the prior odds, normalised over the domains."""
        r = r.within(self.vocabulary)
        odds = [np.full(r.n, q) if m is None else np.exp(np.clip(m.score(r), -30, 30)) * (q / max(1e-9, 1 - q))
                for m, q in zip(self.models, self.priors)]
        odds = np.column_stack(odds) + 1e-12
        share = odds / (1 + odds)
        return share / share.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labels: DataFrame, domains: dict[str, Column | str],
                max_labelled: int = linear.MAX_LABELLED) -> Domains:
    """``domains``: name -> boolean over the label columns, disjoint; rows in none are unlabelled."""
    code = F.lit(None).cast("int")
    for j, c in reversed(list(enumerate(domains.values()))):
        code = F.when(linear.condition(c), F.lit(j)).otherwise(code)
    words, rows, cls, _ = linear.training_rows(docs, labels, code, max_labelled)
    k = len(domains)
    if not len(cls):
        return Domains(list(domains), words, [None] * k, np.full(k, 1 / k))
    models = [linear.fit(rows, (cls == j).astype(float), len(words)) if 0 < (cls == j).sum() < len(cls) else None
              for j in range(k)]
    return Domains(list(domains), words, models, np.array([(cls == j).mean() for j in range(k)]))


def on_grid(p: np.ndarray) -> np.ndarray:
    """Posteriors as multiples of 1 / ``GRID`` that sum to 1: rounded down, and what is
    left goes to the largest remainders."""
    q = np.floor(p * GRID).astype(np.int64)
    rest = np.argsort(np.argsort(-(p * GRID - q), axis=1, kind="stable"), axis=1)
    return (q + (rest < (GRID - q.sum(axis=1))[:, None])) / GRID


def _posteriors(domains: Domains, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(domains.names)
        for b in batches:
            column = b.column(at)
            for a, z, r in linear.features(column):
                tokens = np.zeros(z - a, np.int64)
                for u, v, data, offsets in text_slices(column.slice(a, z - a)):
                    tokens[u:v] = np.bincount(word_spans(data, offsets)[2], minlength=v - u)
                p = on_grid(domains.posterior(r))
                new = [pa.array(tokens), pa.ListArray.from_arrays(np.arange(z - a + 1, dtype=np.int32) * k, p.ravel())]
                yield pa.RecordBatch.from_arrays([c.slice(a, z - a) for c in b.columns] + new,
                                                 names=[*b.schema.names, TOKENS, P])

    return run


def with_posteriors(docs: DataFrame, domains: Domains, text: str = "text") -> DataFrame:
    """``docs`` plus the number of tokens (words) and the posterior over the domains."""
    ship_by_value(__name__)
    docs = docs.drop(P, TOKENS)
    schema = StructType([*docs.schema.fields, StructField(TOKENS, LongType()), StructField(P, ArrayType(DoubleType()))])
    return docs.mapInArrow(_posteriors(domains, docs.columns.index(text)), schema)


@dataclass
class Mix:
    """The fit: targets, the totals before and after, and the rate of every posterior class."""
    names: list[str]
    targets: list[float]
    before: list[float]
    totals: list[float]
    steps: int
    reached: bool
    rates: DataFrame  # posterior, rate

    def miss(self) -> float:
        """The greatest miss of a total, as a share of the sum of the targets."""
        return max((abs(x - y) for x, y in zip(self.totals, self.targets)), default=0.0) / max(1e-9, sum(self.targets))


def _moments(classes: DataFrame, k: int, max_rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected totals at the present rates, and sum t p p' of the classes off the bounds."""
    p = [F.get(P, F.lit(j)) for j in range(k)]
    free = F.when((F.col(RATE) > 0) & (F.col(RATE) < F.lit(float(max_rate))), F.col("t")).otherwise(F.lit(0.0))
    got = classes.agg(*[F.sum(F.col("t") * F.col(RATE) * x) for x in p],
                      *[F.sum(free * p[i] * p[j]) for i in range(k) for j in range(i, k)]).first()
    g, at = np.zeros((k, k)), k
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = got[at] or 0.0
            at += 1
    return np.array([x or 0.0 for x in got[:k]]), g


def fit_rates(rows: DataFrame, weights: dict[str, float], anchor: str | None = None, max_rate: float = float("inf"),
              headroom: float = 0.0, max_steps: int = MAX_STEPS, tolerance: float = 1e-4) -> Mix:
    """``rows``: the tokens and posteriors of all documents."""
    k, names, w = len(weights), list(weights), np.array(list(weights.values()), float)
    classes = reliable(rows.groupBy(P).agg(F.sum(F.col(TOKENS)).cast("double").alias("t"))
                       .withColumn(RATE, F.lit(1.0)))
    s, _ = _moments(classes, k, float("inf"))
    a = names.index(anchor) if anchor else int(np.argmax(s))
    if s.sum() <= 0 or w[a] <= 0:
        return Mix(names, s.tolist(), s.tolist(), s.tolist(), 0, True, classes.select(P, RATE))
    targets = w / w[a] * s[a] * (1 - headroom)
    off = lambda x: float(np.abs(x - targets).max() / targets.sum())
    # the metric of all rates: a step in it never overshoots
    _, whole = _moments(classes, k, float("inf"))
    safe = np.linalg.pinv(whole, rcond=1e-9)
    total, free = _moments(classes, k, max_rate)
    if not free.any():  # all rates begin at their bound
        free = whole
    bold, steps = True, 0
    while off(total) >= tolerance and steps < max_steps:
        steps += 1
        v = (np.linalg.pinv(free, rcond=1e-9) if bold else safe) @ (total - targets)
        change = sum((F.get(P, F.lit(j)) * F.lit(float(x)) for j, x in enumerate(v)), F.lit(0.0))
        moved = F.greatest(F.col(RATE) - change, F.lit(0.0))
        if np.isfinite(max_rate):
            moved = F.least(moved, F.lit(float(max_rate)))
        ahead = reliable(classes.select(P, "t", moved.alias(RATE)))
        new, new_free = _moments(ahead, k, max_rate)
        if off(new) < off(total) * (1 - 1e-3):
            classes, total, free, bold = ahead, new, new_free if new_free.any() else whole, True
        elif bold:
            bold = False
        else:
            break
    mix = Mix(names, targets.tolist(), s.tolist(), total.tolist(), steps, off(total) < tolerance, classes.select(P, RATE))
    if not mix.reached:
        warnings.warn(f"mixing targets not reached: {dict(zip(names, mix.totals))} of {dict(zip(names, mix.targets))}", stacklevel=2)
    return mix


def mix_to_weights(docs: DataFrame, labels: DataFrame, domains: dict[str, Column | str], weights: dict[str, float],
                   seed: int = 11, **options) -> tuple[DataFrame, Mix]:
    """``docs`` plus ``rate`` and ``copies`` (0 or more) of every row, and the fit. The
    texts are scored once, into a table in the shared folder; ``drop`` names
    columns (the text) that the result goes without."""
    if list(domains) != list(weights):
        raise ValueError("domains and weights must name the same domains in the same order")
    drop = options.pop("drop", ())
    path = scratch_path(docs.sparkSession, "mixing")
    with_posteriors(docs, fit_domains(docs, labels, domains)).drop(*drop).write.parquet(path)
    scored = docs.sparkSession.read.parquet(path)
    mix = fit_rates(scored.select(TOKENS, P), weights, **options)
    rates = mix.rates
    if rates.count() <= BROADCAST_CLASSES:
        rates = F.broadcast(rates)
    u = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) / float(1 << 52)
    out = scored.join(rates, P).withColumnRenamed(RATE, "rate")
    return out.withColumn("copies", F.floor(F.col("rate") + u).cast("int")), mix


def sampled(docs: DataFrame, labels: DataFrame, domains: dict[str, Column | str], weights: dict[str, float],
            **options) -> DataFrame:
    """``docs`` with each row repeated or left out by its copies; columns as given."""
    clash = {c: f"__own_{c}" for c in ("rate", "copies") if c in docs.columns}
    out, _ = mix_to_weights(docs.withColumnsRenamed(clash), labels, domains, weights, **options)
    out = out.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
