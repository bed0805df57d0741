"""Exact top-k search by distributed histogram selection.

All candidates are scored against all queries, block against block. Scores are
integers. A first pass counts them in wide bins of the possible range, per query
and over all blocks, and finds the bin with the k-th highest; the next pass
scores again and splits that bin, until it is one value wide: the exact k-th
score. A last pass keeps what scores above it, and of the ties at it the
smallest ids. A block leaves out of a histogram only bins below its own k-th
score, which cannot hold the global one.

Blocks bound the memory of a task: about ``query_block`` queries against
``candidate_block`` vectors. Each pair of a query block and a candidate group is
a key of its own, so the work spreads over the cluster whatever the sizes.

Defined results: vectors that are null, or hold null or non-finite components, and
rows without an id take no part; every other row is a candidate of its own, and a query if its
id is one, so rows that repeat an id are candidates of each other and queries with the same
query_id; vectors are compared with those of the same length only; a
query with fewer than k candidates returns all of them; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm.common import reliable

BINS = 1024


def quantized(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double (array of long)."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(embedding: Column) -> Column:
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return embedding.isNotNull() & F.forall(embedding, ok)


def _pack_candidates(block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby(b["v"].map(len)):
                for i in range(0, len(g), block):
                    part = g.iloc[i:i + block]
                    yield pd.DataFrame({"dim": [dim], **_packed(part)})

    return run


def _packed(part: pd.DataFrame) -> dict:
    mat = np.array(part["v"].tolist(), dtype=np.int64).reshape(len(part), -1)
    small = mat.size == 0 or np.abs(mat).max() < 2**31
    return {"ids": [part["id"].to_numpy(np.int64).tobytes()], "rows": [part["row"].to_numpy(np.int64).tobytes()], "small": [bool(small)],
            "mat": [mat.astype(np.int32 if small else np.int64).tobytes()]}


def _pack_queries(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"dim": [key[0]], "qb": [key[1]], **_packed(g.sort_values("row"))})


def _matrix(mat: bytes, small: bool, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(mat, np.int32 if small else np.int64).reshape(n, dim)


def scores_of(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where that is exact."""
    top = lambda x: int(np.abs(x.astype(np.int64)).max()) if x.size else 0
    if top(q) * top(c) * max(1, q.shape[1]) < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def _each_pair(batches: Iterator[pa.RecordBatch]):
    """(query rows, query ids, state, candidate ids, scores, mask of the queries' own rows) of each joined pair of blocks."""
    for b in batches:
        for r in b.to_pylist():
            qr, qi, cr, ci = (np.frombuffer(r[x], np.int64) for x in ("qrows", "qids", "rows", "ids"))
            s = scores_of(_matrix(r["qmat"], r["qsmall"], r["dim"], len(qi)),
                          _matrix(r["mat"], r["small"], r["dim"], len(ci)))
            own = qr[:, None] == cr[None, :]
            state = {x["query"]: x for x in r["state"]}
            yield qr, qi, [state.get(int(q)) for q in qr], ci, s, own


def _histogram(k: int):
    schema = pa.schema([("query", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for qr, _, state, _, s, own in _each_pair(batches):
            lo = np.array([x["lo"] if x else 0 for x in state], np.int64)[:, None]
            w = np.array([x["width"] if x else 0 for x in state], np.int64)[:, None]
            step = np.maximum(1, -(-w // BINS))
            inside = (s >= lo) & (s < lo + w) & ~own
            bins = np.where(inside, (s - lo) // step, -1)
            # bins below the block's own k-th score cannot hold the global one
            kk = min(k, bins.shape[1])
            floor = np.partition(bins, bins.shape[1] - kk, axis=1)[:, bins.shape[1] - kk][:, None]
            row, col = np.nonzero(inside & (bins >= floor))
            cells, n = np.unique(np.stack([row, bins[row, col]]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(qr[cells[0]]), pa.array(cells[1]), pa.array(n.astype(np.int64))], schema=schema)

    return run


def _select(k: int):
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for qr, qi, state, ci, s, own in _each_pair(batches):
            kth = np.array([x["lo"] if x else np.iinfo(np.int64).max for x in state], np.int64)[:, None]
            row, col = np.nonzero((s > kth) & ~own)
            parts = [(qr[row], qi[row], ci[col], s[row, col])]
            tie_row, tie_col = np.nonzero((s == kth) & ~own)
            order = np.lexsort((ci[tie_col], tie_row))
            tie_row, tie_col = tie_row[order], tie_col[order]
            first = np.arange(len(tie_row)) - np.searchsorted(tie_row, tie_row)
            tie_row, tie_col = tie_row[first < k], tie_col[first < k]
            parts.append((qr[tie_row], qi[tie_row], ci[tie_col], s[tie_row, tie_col]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], schema=schema)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, query_block: int = 512,
          candidate_block: int = 2048) -> DataFrame:
    """The k best candidates of every query by integer inner product: query_id,
    rank (from 1), vec_id, score; ties to the smaller id. ``vectors``: id (long),
    v (array of long); ``is_query`` marks the query rows, all rows are candidates
    except a query's own."""
    ship_by_value(__name__)
    v = reliable(vectors.select("id", "v", F.monotonically_increasing_id().alias("row")))
    head = v.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") ** 2))).alias("norm"),
                 F.count("*").alias("n"), F.count_if(is_query).alias("nq")).first()
    # no inner product lies outside +-span; scores beyond 2**62 are out of range
    span = min(int(math.ceil((head["norm"] or 0.0) ** 2)) + 1, 2**62 - 1)
    n_qb = max(1, math.ceil(head["nq"] / query_block))
    n_groups = max(1, math.ceil(head["n"] / (4 * candidate_block)))
    qb = F.pmod(F.xxhash64("row"), F.lit(n_qb)).cast("int")
    qs = v.where(is_query).select("id", "row", "v", F.size("v").alias("dim"), qb.alias("qb"))
    qblocks = reliable(qs.groupBy("dim", "qb").applyInPandas(
        _pack_queries, "dim int, qb int, ids binary, rows binary, small boolean, mat binary")
        .select("dim", "qb", F.col("ids").alias("qids"), F.col("rows").alias("qrows"), F.col("small").alias("qsmall"), F.col("mat").alias("qmat")))
    cblocks = reliable(v.mapInPandas(_pack_candidates(candidate_block),
                                     "dim int, ids binary, rows binary, small boolean, mat binary")
                       .withColumn("cg", F.pmod(F.xxhash64("rows"), F.lit(n_groups)).cast("int")))
    state = qs.select("dim", "qb", F.col("row").alias("query"), F.lit(-span).cast("long").alias("lo"),
                      F.lit(2 * span + 1).cast("long").alias("width"), F.lit(0).cast("long").alias("above"))

    def pairs(state: DataFrame) -> DataFrame:
        packed = state.groupBy("dim", "qb").agg(F.collect_list(F.struct("query", "lo", "width")).alias("state"))
        left = (qblocks.join(packed, ["dim", "qb"])
                .withColumn("cg", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))))
        right = cblocks.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))))
        return left.join(right.hint("shuffle_hash"), ["dim", "qb", "cg"]).select(
            "dim", "qids", "qrows", "qsmall", "qmat", "state", "ids", "rows", "small", "mat")

    width = 2 * span + 1
    while width > 1:
        step = max(1, -(-width // BINS))
        hist = (pairs(state).mapInArrow(_histogram(k), "query long, bin long, n long")
                .groupBy("query", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("query").orderBy(F.desc("bin"))
        found = (hist.join(state, "query").withColumn("cum", F.col("above") + F.sum("n").over(down))
                 .where(F.col("cum") >= k).groupBy("query")
                 .agg(F.max(F.struct("bin", "cum", "n")).alias("x")))
        # without a k-th score everything above the lowest possible one is kept
        state = reliable(state.join(found, "query", "left").select(
            "dim", "qb", "query",
            F.when(F.col("x").isNull(), F.lit(-span - 1)).otherwise(F.col("lo") + F.col("x.bin") * step)
            .cast("long").alias("lo"),
            F.when(F.col("x").isNull(), F.lit(1)).otherwise(step).cast("long").alias("width"),
            F.coalesce(F.col("x.cum") - F.col("x.n"), F.lit(0)).cast("long").alias("above")))
        width = step
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (pairs(state).mapInArrow(_select(k), "query long, query_id long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
