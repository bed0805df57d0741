"""MinHash near-duplicate detection with ProbMinHash.

A text is the set of its five-word shingles, each of weight 1: links are verified on
sets, and weights by count would pull apart texts that repeat their shingles a
different number of times. In ProbMinHash every shingle is a Poisson process whose rate is its weight; its
arrivals fall on random registers, a register keeps the shingle that arrived
first, and a shingle stops as soon as its next arrival lies behind the latest
first arrival of all registers. Two texts agree in a register with the
probability Jaccard similarity of their weighted shingles. Registers are banded;
texts that share a band are candidates, and candidates are verified with the
exact Jaccard similarity of their shingle sets (0.8 or more).

Large groups: copies (the same word sequence) are one node. In a band bucket all
nodes are verified against one pivot, the node with most copies; only nodes that
this leaves in other classes than the pivot's are compared further, against the
rest of their bucket, block by block, and a block reports the links that join
classes, not all pairs. So no pair of a bucket is missed and pairs are never
listed. Classes are the connected components of the links.

Defined results: texts of one to four words have one shingle, the whole text;
null texts and texts without words are classes of their own; a class is named
by its smallest doc_id; rows with a null id take part by their text; repeated
rows are copies; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm import hashing
from eventlake.llm.common import reliable
from eventlake.llm.components import connected_components
from eventlake.llm.hashing import SpanHash, splitmix, text_slices, word_spans

SHINGLE = 5
BANDS, ROWS = 20, 4
BLOCK = 64


def prob_min_hash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """(n, m) registers: the element of each owner that arrives first in each register."""
    first = np.full(n * m, np.inf)
    record: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live, at, k = np.arange(len(elements)), np.zeros(len(elements)), 0
    while len(live):
        r = splitmix(elements[live] + np.uint64((0x632BE59BD9B4E019 * (k + 1)) & (2**64 - 1)))
        k += 1
        at = at - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[live]
        slot = owner[live] * m + (splitmix(r) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, slot, at)
        hit = at <= first[slot]
        record.append((slot[hit], at[hit], elements[live[hit]]))
        # early termination: an element is done once it is behind its owner's last register
        on = at < first.reshape(n, m).max(axis=1)[owner[live]]
        live, at = live[on], at[on]
    out = np.zeros(n * m, np.uint64)
    for slot, t, e in record:
        won = t == first[slot]
        out[slot[won]] = e[won]
    return out.reshape(n, m)


def shingles_of(data: np.ndarray, offsets: np.ndarray):
    """Of the rows of a slice: shingle hashes, their row, and per row the number of
    words and a 128-bit digest of the word sequence."""
    n = len(offsets) - 1
    s, e, row = word_spans(data, offsets)
    h = [SpanHash(data, seed).of(s, e) for seed in (1, 2)]
    n_words = np.bincount(row, minlength=n)
    lo = np.concatenate([[0], np.cumsum(n_words)])
    place = (np.arange(len(row)) - lo[row]).astype(np.uint64)
    digest = []
    for x in h:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(splitmix(x ^ splitmix(place)), dtype=np.uint64)])
        digest.append(splitmix((sums[lo[1:]] - sums[lo[:-1]]) + n_words.astype(np.uint64)))
    # a shingle starts at every word that has four more behind it, and at the first word of a shorter text
    left = (lo[1:][row] - np.arange(len(row)))
    is_start = (left >= SHINGLE) | ((place == 0) & (left < SHINGLE))
    at = np.flatnonzero(is_start)
    out = np.zeros(len(at), np.uint64)
    for j in range(SHINGLE):
        has = left[at] > j
        w = np.where(has, h[0][np.minimum(at + j, max(0, len(row) - 1))] if len(row) else 0, np.uint64(0))
        out = splitmix(out ^ w)
    return out, row[at], n_words, digest


def _unique(sh: np.ndarray, row: np.ndarray):
    order = np.lexsort((sh, row))
    sh, row = sh[order], row[order]
    new = np.concatenate([[True], (sh[1:] != sh[:-1]) | (row[1:] != row[:-1])]) if len(sh) else np.empty(0, bool)
    at = np.flatnonzero(new)
    return sh[at], row[at], np.diff(np.append(at, len(sh)))


def _digest_bytes(digest, i: int) -> bytes:
    return digest[0][i].tobytes() + digest[1][i].tobytes()


def _signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, data, offsets in text_slices(b.column(2)):
                n = z - a
                sh, row, n_words, digest = shingles_of(data, offsets)
                sh, row, _ = _unique(sh, row)
                live = np.flatnonzero(n_words > 0)
                rank = np.cumsum(n_words > 0) - 1
                sig = prob_min_hash(sh, np.ones(len(sh)), rank[row], len(live), bands * rows)
                key = np.zeros((len(live), bands), np.uint64)
                for j in range(rows):
                    key = splitmix(key ^ sig.reshape(len(live), bands, rows)[:, :, j])
                key = splitmix(key ^ splitmix(np.arange(bands, dtype=np.uint64)))
                full = np.zeros((n, bands), np.int64)
                full[live] = key.view(np.int64)
                size = np.bincount(row, minlength=n)
                lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * bands, full.ravel())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, n), b.column(1).slice(a, n),
                     pa.array([_digest_bytes(digest, i) for i in range(n)], pa.binary()),
                     pa.array(size.astype(np.int64)), lists],
                    names=["doc_id", "text_hash", "digest", "size", "bands"])

    return run


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, digest, text) -> (node, sorted shingle set), where the text has the digest."""
    for b in batches:
        node, want = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
        for a, z, data, offsets in text_slices(b.column(2)):
            sh, row, _, digest = shingles_of(data, offsets)
            sh, row, _ = _unique(sh, row)
            lo = np.searchsorted(row, np.arange(z - a + 1))
            keep = [i for i in range(z - a) if want[a + i].as_py() == _digest_bytes(digest, i)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(node[a + i]) for i in keep], pa.int64()),
                 pa.array([sh[lo[i]:lo[i + 1]].tobytes() for i in keep], pa.binary())],
                names=["node", "sh"])


def jaccard_at_least(x: int, y: int, both: int, t: float) -> bool:
    return both >= t * (x + y - both)


def _verify(t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c, sa, sc = (b.column(i) for i in range(4))
            ok = []
            for i in range(b.num_rows):
                x = np.frombuffer(sa[i].as_buffer(), np.uint64)
                y = np.frombuffer(sc[i].as_buffer(), np.uint64)
                ok.append(jaccard_at_least(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), t))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), c.filter(keep)], names=["a", "b"])

    return run


def block_links(left: list[dict], right: list[dict], bucket: int, t: float) -> list[tuple[int, int]]:
    """Links between two blocks of a bucket that join classes: pairs of different
    classes, first together in this bucket's band, with similarity t or more; of
    pairs that join the same classes one is enough."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    sets = [np.frombuffer(r["sh"], np.uint64) for r in right]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    sizes = np.array([len(x) for x in sets])
    bands = np.array([r["bands"] for r in right])
    comps = np.array([r["comp"] for r in right])
    out = []
    for u in left:
        mine = np.frombuffer(u["sh"], np.uint64)
        same = bands == np.array(u["bands"])[None, :]
        first = same.argmax(axis=1)
        fits = (same.any(axis=1) & (bands[np.arange(len(bands)), first] == bucket) & (comps != u["comp"])
                & (np.minimum(sizes, len(mine)) >= t * np.maximum(sizes, len(mine))))
        if not fits.any():
            continue
        at = np.searchsorted(mine, flat)
        hit = mine[np.minimum(at, len(mine) - 1)] == flat
        both = np.bincount(owner[hit], minlength=len(sets))
        for j in np.flatnonzero(fits & (both >= t * (sizes + len(mine) - both))):
            x, y = root(int(u["comp"])), root(int(comps[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((int(u["node"]), int(right[j]["node"])))
    return out


def _blocks(t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(k)[i].as_py() for k, n in enumerate(("bucket", "us", "ms"))}
                links = block_links(r["us"], r["ms"], r["bucket"], t)
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                                  pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    return run


def _ship() -> None:
    ship_by_value(__name__)
    ship_by_value(hashing.__name__)


def near_duplicate_classes(docs: DataFrame, threshold: float = 0.8, bands: int = BANDS,
                           rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash (xxhash64 of
    the text), class_id, class_root (a text key of the class)."""
    _ship()
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                      F.col("text").cast("string").alias("text"))
    sig = reliable(ids.mapInArrow(_signatures(bands, rows),
                                  "doc_id long, text_hash long, digest binary, size long, bands array<long>"))
    # one node per word sequence; smaller node ids have more copies
    nodes = (sig.where("size > 0").groupBy("digest")
             .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("size").alias("size"),
                  F.first("bands").alias("bands")))
    nodes = reliable(nodes.withColumn("node", F.expr(
        "shiftleft(8191L - least(copies, 8191L), 50) + monotonically_increasing_id()")).drop("copies"))
    flat = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    buckets = reliable(flat.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1"))
    sharing = reliable(flat.join(buckets, "bucket").select("bucket", "node", "size", "pivot"))

    # every node of a bucket against its pivot; sizes alone rule out many
    some = nodes.select(F.col("node").alias("pivot"), F.col("size").alias("pivot_size"))
    pairs = reliable(sharing.where("node <> pivot").select("node", "size", "pivot").distinct()
                     .join(some, "pivot")
                     .where(F.least("size", "pivot_size") >= F.lit(threshold) * F.greatest("size", "pivot_size"))
                     .select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    crowded = sharing.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 2")
    needed = (pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
              .union(sharing.join(crowded, "bucket").select("node")).distinct()
              .join(nodes.select("node", "digest", "rep"), "node"))
    texts = needed.join(ids.select("doc_id", "text"), F.col("rep").eqNullSafe(F.col("doc_id")))
    sets = reliable(texts.select("node", "digest", "text").mapInArrow(_shingle_sets, "node long, sh binary")
                    .groupBy("node").agg(F.first("sh").alias("sh")))
    left, right = sets.select(F.col("node").alias("a"), F.col("sh").alias("sa")), sets.select(F.col("node").alias("b"), F.col("sh").alias("sb"))
    star = reliable(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
                    .mapInArrow(_verify(threshold), "a long, b long"))
    links = star.union(_rest_of_buckets(sharing, nodes, sets, connected_components(star), threshold))
    labels = connected_components(reliable(links))

    named = (nodes.select("digest", "node", "rep").join(labels, "node", "left")
             .withColumn("root", F.coalesce("label", "node")))
    names = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = named.join(names, "root").select("digest", "root", "class_id")
    wordless = sig.where("size = 0").select("doc_id", "text_hash", F.col("doc_id").alias("class_id"),
                                            F.lit(None).cast("long").alias("class_root"))
    return (sig.where("size > 0").join(named, "digest")
            .select("doc_id", "text_hash", "class_id", F.col("root").alias("class_root")).union(wordless))


def _rest_of_buckets(sharing: DataFrame, nodes: DataFrame, sets: DataFrame, labels: DataFrame,
                     threshold: float) -> DataFrame:
    """Links between bucket members that the pivot round left in different classes.
    The outsiders (not in the pivot's class) of a bucket meet all its members but
    the pivot, in blocks of about ``BLOCK`` nodes."""
    comp = sharing.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
    of_pivot = labels.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label"))
    comp = (comp.join(of_pivot, "pivot", "left")
            .withColumn("out", F.col("comp") != F.coalesce("pivot_label", "pivot")).where("node <> pivot")
            .select("bucket", "node", "comp", "out"))
    comp = reliable(comp)
    sizes = (comp.groupBy("bucket").agg(F.count_if("out").alias("n_out"), F.count("*").alias("n"))
             .where("n_out > 0 and n > 1")
             .select("bucket", F.ceil(F.col("n_out") / BLOCK).cast("int").alias("ub"),
                     F.ceil(F.col("n") / BLOCK).cast("int").alias("mb")))
    member = (comp.join(sizes, "bucket").join(nodes.select("node", "bands"), "node").join(sets, "node"))
    row = F.struct("node", "comp", "bands", "sh")
    blk = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    us = (member.where("out").groupBy("bucket", blk("ub").alias("u"), "mb").agg(F.collect_list(row).alias("us"))
          .withColumn("m", F.explode(F.sequence(F.lit(0), F.col("mb") - 1))))
    ms = (member.groupBy("bucket", blk("mb").alias("m")).agg(F.collect_list(row).alias("ms")))
    return (us.join(ms, ["bucket", "m"]).select("bucket", "us", "ms")
            .mapInArrow(_blocks(threshold), "a long, b long"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every class: the one with the smallest id (of rows
    with that id, the smallest text hash). Columns as given."""
    classes = near_duplicate_classes(docs, **options)
    best = (classes.where("class_root is not null").groupBy("class_root")
            .agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select("k.*"))
    best = best.union(classes.where("class_root is null").select("doc_id", "text_hash").distinct())
    best = best.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    rows = docs.withColumn("__text", F.xxhash64("text"))
    kept = rows.join(best, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__text"]).select(*docs.columns)
