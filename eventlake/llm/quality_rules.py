"""Learned decision lists for text quality.

Text statistics are plain Spark SQL expressions. A decision list (an ordered
list of conjunctions of thresholds over those statistics) is learned from
labelled documents by sequential covering: a rule is *grown* condition by
condition on two thirds of the labelled rows by information gain, *pruned*
from its end on the remaining third, and kept while its precision there is
high enough; rows it covers leave the table and the next rule is learned.
The list is emitted as one ordered ``when(...).when(...).otherwise(...)``.

Every grow step is one Spark aggregate over binned statistics: the driver
sees (statistic, bin) counts only, never rows.

Defined results: a null text has no words; empty text likewise (both fail the
base rule); labels that are null, repeated or of unknown documents: null ones
are ignored, the smallest quality of a document counts; without usable labels
the list is empty and only the base rule decides; repeated rows are judged
alike; other columns of the input stay untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import WORD_SPACE, let, reliable, sample_fraction, words

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(ws: Column) -> Column:
    """How many words lie in a 3-word window that the text has at least twice.
    Windows are compared by a 64-bit hash. Sorting (hash, position) puts equal
    windows side by side; of the sorted positions of repeated windows each adds
    the words it covers beyond the one before."""
    hashes = F.transform(
        F.sequence(F.lit(1), F.size(ws) - 2),
        lambda i: F.xxhash64(F.element_at(ws, i), F.element_at(ws, i + 1), F.element_at(ws, i + 2)))

    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        dup = let(pairs, lambda s: F.transform(
            F.filter(F.transform(s, lambda x, i: F.struct(
                x["p"].alias("p"),
                (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))).alias("d"))),
                lambda x: x["d"]),
            lambda x: x["p"]))
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            F.sort_array(dup), zero,
            lambda acc, p: F.struct(p.alias("last"),
                                    (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    return F.when(F.size(ws) < 4, F.lit(0).cast("long")).otherwise(let(
        hashes,
        lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long"))
        .otherwise(covered(hs))))


def text_statistics(text: Column) -> Column:
    """A struct of the ``BASE`` counts of a whole text (long each)."""
    t = F.coalesce(text, F.lit(""))
    gone = lambda chars: F.length(F.translate(t, chars, ""))
    lines = F.filter(F.split(t, "\n"), lambda s: F.translate(s, WORD_SPACE, "") != F.lit(""))
    return F.struct(
        let(words(text), lambda ws: F.struct(F.size(ws).cast("long").alias("n"),
                                             _repeat_words(ws).alias("r"))).alias("w"),
        gone(WORD_SPACE).cast("long").alias("word_chars"),
        (F.length(t) - gone(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long")
        .alias("n_dup_lines"))


def with_statistics(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` plus the five counts, named ``prefix`` + name."""
    s = "__stats"
    df = df.withColumn(s, text_statistics(F.col(text)))
    get = {"n_words": f"{s}.w.n", "n_repeat_words": f"{s}.w.r"}
    return df.withColumns({prefix + c: F.col(get.get(c, f"{s}.{c}")) for c in BASE}).drop(s)


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def features(prefix: str = "") -> dict[str, Column]:
    """The statistics that conditions may use, as ratios where length would
    otherwise decide."""
    c = {b: F.col(prefix + b).cast("double") for b in BASE}
    n = F.greatest(c["n_words"], F.lit(1.0))
    return {"words": c["n_words"], "word_length": c["word_chars"] / n,
            "symbols_per_word": c["n_symbols"] / n,
            "dup_lines_per_100_words": 100 * c["n_dup_lines"] / n,
            "repeat_share": c["n_repeat_words"] / n}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def column(self, prefix: str = "") -> Column:
        x = features(prefix)[self.feature]
        return x > self.threshold if self.above else x <= self.threshold


Rule = tuple[Condition, ...]


def rule_column(rule: Rule, prefix: str = "") -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(prefix)
    return out


def decision_column(rules: list[Rule], prefix: str = "") -> Column:
    """True unless a rule of the ordered list rejects the row."""
    if not rules:
        return F.lit(True)
    out = F.when(rule_column(rules[0], prefix), F.lit(False))
    for r in rules[1:]:
        out = out.when(rule_column(r, prefix), F.lit(False))
    return out.otherwise(F.lit(True))


def _thresholds(df: DataFrame, names: list[str], n: int) -> dict[str, list[float]]:
    """Cut points half way between neighbouring quantiles of the two classes."""
    q = [i / n for i in range(n + 1)]
    rows = df.groupBy("bad").agg(*[F.percentile_approx(c, q, 10000).alias(c) for c in names]).collect()
    out = {}
    for c in names:
        v = sorted({x for r in rows for x in (r[c] or [])})
        out[c] = [(a + b) / 2 for a, b in zip(v, v[1:])]
    return out


def learn_rules(labelled: DataFrame, max_rules: int = 8, max_conditions: int = 3,
                n_cuts: int = 32, min_precision: float = 0.9, min_cover: int = 5) -> list[Rule]:
    """Sequential covering over ``labelled``: columns ``bad`` (boolean) and
    ``part`` (0 or 1: grow, 2: prune) plus the ``BASE`` counts."""
    names = list(features())
    df = labelled.select("bad", "part", *[v.alias(k) for k, v in features().items()])
    cuts = _thresholds(df, names, n_cuts)
    names = [c for c in names if cuts[c]]
    if not names:
        return []
    bin_of = lambda c: F.size(F.filter(  # noqa: E731  how many cuts lie below the value
        F.array(*[F.lit(t) for t in cuts[c]]), lambda t: t < F.col(c)))
    df = reliable(df.select("bad", "part", *[bin_of(c).alias(c) for c in names]))
    as_bin = lambda c: (F.col(c.feature) > cuts[c.feature].index(c.threshold) if c.above
                        else F.col(c.feature) <= cuts[c.feature].index(c.threshold))
    covers = lambda r: F.expr("true") if not r else math_and([as_bin(c) for c in r])

    def grow(left: DataFrame) -> Rule:
        rule: Rule = ()
        while len(rule) < max_conditions:
            cells = (left.where((F.col("part") < 2) & covers(rule))
                     .select("bad", F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).alias("b"))
                                                       for c in names])).alias("x"))
                     .groupBy("x.f", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
                     .collect())
            by = {c: [[0, 0] for _ in range(len(cuts[c]) + 1)] for c in names}
            for r in cells:
                by[r["f"]][r["b"]] = [r["p"], r["n"]]
            p0, n0 = (sum(x[i] for x in by[names[0]]) for i in (0, 1))
            if not p0 or not n0:
                break
            best = (0.0, None)
            for c in names:
                p = n = 0
                for i, t in enumerate(cuts[c]):
                    p, n = p + by[c][i][0], n + by[c][i][1]
                    for above, pc, nc in ((False, p, n), (True, p0 - p, n0 - n)):
                        if pc >= min_cover:
                            gain = pc * (math.log2(pc / (pc + nc)) - math.log2(p0 / (p0 + n0)))
                            best = max(best, (gain, Condition(c, above, t)),
                                       key=lambda x: x[0])
            if best[1] is None or best[0] <= 1e-9:
                break
            rule += (best[1],)
        return rule

    rules: list[Rule] = []
    left = df
    while len(rules) < max_rules:
        rule = grow(left)
        if not rule:
            break
        prefixes = [rule[:i] for i in range(1, len(rule) + 1)]
        got = left.where(F.col("part") == 2).agg(*[
            F.count_if(covers(p) & ok).alias(f"{k}{i}")
            for i, p in enumerate(prefixes) for k, ok in (("p", F.col("bad")), ("n", ~F.col("bad")))]).first()
        # pruning: the prefix with the best (covered bad - covered good) / covered
        worth = [((got[f"p{i}"] - got[f"n{i}"]) / max(1, got[f"p{i}"] + got[f"n{i}"]), -i)
                 for i in range(len(prefixes))]
        i = -max(worth)[1]
        p, n = got[f"p{i}"], got[f"n{i}"]
        if p == 0 or p / (p + n) < min_precision:
            break
        rules.append(prefixes[i])
        left = left.where(~covers(prefixes[i]))
    return rules


def math_and(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out & c
    return out


def fit_quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000,
                      **options) -> list[Rule]:
    """Learn the list on at most about ``max_labelled`` labelled documents (the
    documented bound of the classifier's sample), chosen by a hash of the id.
    The sampled label table has that bound, so it is broadcast to the scan."""
    lab = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    lab = sample_fraction(lab, F.col("doc_id"), max_labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")
    rows = with_statistics(rows).where(~base_failed()).select(
        *BASE, (F.col("quality") == 0).alias("bad"),
        F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(3)).alias("part"))
    return learn_rules(reliable(rows), **options)


def apply_quality_rules(df: DataFrame, rules: list[Rule], prefix: str = "") -> DataFrame:
    """``df`` plus the counts, ``base_failed`` and ``kept`` (names with ``prefix``)."""
    df = with_statistics(df, prefix=prefix)
    df = df.withColumn(prefix + "base_failed", base_failed(prefix))
    return df.withColumn(prefix + "kept", ~F.col(prefix + "base_failed") & decision_column(rules, prefix))
