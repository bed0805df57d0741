"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of every text (each byte shifts the hash by two
bits, so it depends on the last 16 bytes). A chunk ends where the hash is the
lowest of its neighbourhood, moved on to the next word start; so the cuts move
with the content and an insertion changes only the chunks around it. Chunks are
about 35 bytes; after 256 bytes without a lowest hash (text of short period) a cut is made
anyway.

A single chunk may well stand elsewhere by chance, so repeats are judged by windows of
``WINDOW`` neighbouring chunks: a window whose digest stands at more than one place
(row and position, so also twice in one document) is repeated, and its first place
is in the document with the smallest id. Runs of windows that have an earlier place each are reported
with ``kept`` false if they have at least ``min_words`` words; the places that
come first, with ``kept`` true, if their whole run has. So the first document that holds a
passage keeps all of it, even where shorter parts stand in still earlier ones. Edges of
a passage that share a chunk with other text fall away, so ``min_words`` lies well under
the length of the passages to be found.

Window digests are computed once and written to the shared folder; all are shuffled once to
count them (pre-aggregated, so one that all documents hold is one row per task), the repeated
ones once more to find their places. Digests have 64 bits.

Defined results: null and empty texts have no chunks, and texts of fewer chunks than a window no
repeats; a document is an id, rows that repeat an id and a text count once; rows with a null id
count as documents named by a hash of their text; other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm import hashing
from eventlake.llm.collocations import Bits, bit_table
from eventlake.llm.common import reliable
from eventlake.llm.hashing import SpanHash, text_slices, word_spans
from eventlake.session import scratch_path

NEAR = 16  # bytes on either side over which a cut's hash is the lowest
LONGEST = 256
MIN_WORDS = 25
WINDOW = 3  # neighbouring chunks that are compared together

WINDOWS = "doc_id long, text long, seq int, start int, end int, before int, upto int, digest long"
FILTER_BITS = 1 << 27


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum over the last 16 bytes of value(byte) << 2 * distance, modulo 2**32."""
    h = hashing.byte_values(9).astype(np.uint32)
    h[0] = 0
    h = h[data]
    for shift in (1, 2, 4, 8):
        h[shift:] += h[:-shift] << np.uint32(2 * shift)
    return h


def _lowest_behind(h: np.ndarray, n: int) -> np.ndarray:
    """The lowest of the ``n`` (a power of two) values that end at each place."""
    low, have = h.copy(), 1
    while have < n:
        low[have:] = np.minimum(low[have:], low[:-have])
        have *= 2
    return low


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places of all cuts, as a sorted array. Rows are set apart by zero bytes, so
    a row's cuts do not depend on its neighbours."""
    n, rows = len(data), len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    place = np.arange(n) + (row + 1) * (NEAR + 1)
    padded = np.zeros(n + (rows + 1) * (NEAR + 1), np.uint8)
    padded[place] = data
    h = gear_hash(padded)
    gap = np.ones(len(padded), bool)
    gap[place] = False
    h[gap] = np.uint32(0xFFFFFFFF)
    behind = _lowest_behind(h, NEAR)
    left = np.full(len(h), 0xFFFFFFFF, np.uint32)
    left[1:] = behind[:-1]
    right = _lowest_behind(h[::-1], NEAR)[::-1]
    here = (h < left) & (h == right)
    return np.flatnonzero(here[place])


def chunks_of(data: np.ndarray, offsets: np.ndarray):
    """start, end, row, number of words and digest of every chunk; a chunk runs from a
    word's start to a word's end."""
    ws, we, wrow = word_spans(data, offsets)
    if not len(ws):
        return (np.empty(0, np.int64),) * 5
    at = np.unique(np.searchsorted(ws, cuts(data, offsets), side="right"))
    first = np.concatenate([[True], wrow[1:] != wrow[:-1]])
    begin = first.copy()
    begin[at[at < len(ws)]] = True
    b = np.flatnonzero(begin)
    # cut what is still too long at words LONGEST bytes on
    nxt = np.append(b[1:], len(ws))
    if len(long := np.flatnonzero(we[nxt - 1] - ws[b] > 2 * LONGEST)):
        for k in long:
            inner = ws[b[k]:nxt[k]]
            grid = np.arange(inner[0] + LONGEST, inner[-1] + 1, LONGEST)
            more = b[k] + np.searchsorted(inner, grid)
            begin[more[more < nxt[k]]] = True
        b = np.flatnonzero(begin)
        nxt = np.append(b[1:], len(ws))
    start, end = ws[b], we[nxt - 1]
    return start, end, wrow[b], nxt - b, SpanHash(data, 13).of(start, end)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, text) -> windows of chunks: the number of the first chunk, bytes from and to,
    words of the text before the window and up to its end, digest."""
    names, types = zip(*[x.split() for x in WINDOWS.split(", ")])
    for b in batches:
        ids, texts = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for a, z, data, offsets in text_slices(b.column(2)):
            start, end, row, words, digest = chunks_of(data, offsets)
            if len(start) < WINDOW:
                continue
            lo = np.searchsorted(row, np.arange(z - a))
            i = np.flatnonzero(row[:len(row) - WINDOW + 1] == row[WINDOW - 1:])
            j = i + WINDOW - 1
            mixed = digest[i]
            for k in range(1, WINDOW):
                mixed = hashing.splitmix(mixed * np.uint64(0x9E3779B97F4A7C15) ^ digest[i + k])
            sums = np.concatenate([[0], np.cumsum(words)])
            base = sums[lo[row[i]]]
            cols = (ids[a + row[i]], texts[a + row[i]], i - lo[row[i]], start[i] - offsets[row[i]], end[j] - offsets[row[i]],
                    sums[i] - base, sums[j + 1] - base, mixed.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64 if t == "long" else np.int32)) for c, t in zip(cols, types)], names=names)


def _perhaps_repeated(shared):
    """The windows whose digest the bit table does not deny."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(shared.value, FILTER_BITS)
        for b in batches:
            digest = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield b.filter(pa.array(bits.has(digest)))

    return run


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every run of repeated windows in every document of ``docs`` (doc_id, text):
    doc_id, start and length (bytes), words, first_doc_id (smallest id that has a
    window of it) and kept (this is the first place)."""
    ship_by_value(__name__)
    text = F.col("text").cast("string")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("doc_id"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))
    path = scratch_path(docs.sparkSession, "chunk-windows")
    spark = docs.sparkSession
    rows.mapInArrow(_windows, WINDOWS).write.option("compression", "zstd").parquet(path)
    windows = spark.read.schema(WINDOWS).parquet(path)
    shared = reliable(windows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
                      .where("n > 1").select("digest", "first"))
    # what is not repeated does not travel: a bit table of fixed size tells (it lets a few others through)
    bits = spark.sparkContext.broadcast(bit_table(shared.select(F.col("digest").alias("x")), FILTER_BITS))
    found = windows.mapInArrow(_perhaps_repeated(bits), WINDOWS).join(shared, "digest")
    # of rows with the same id and text one counts; the first place of a digest in its first document
    found = found.groupBy("digest", "doc_id", "text", "seq").agg(
        *[F.min(c).alias(c) for c in ("start", "end", "before", "upto", "first")])
    places = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.when(F.col("doc_id") == F.col("first"), F.struct(
        "text", "seq"))).alias("place")).where("n > 1")
    found = found.join(places.select("digest", "place"), "digest")
    found = found.withColumn("kept", (F.col("doc_id") == F.col("first")) & (F.col("place") == F.struct("text", "seq"))).drop("place", "digest")
    by = ["doc_id", "text"]
    found = found.withColumn("run", F.col("seq") - F.row_number().over(Window.partitionBy(*by).orderBy("seq")))
    whole = Window.partitionBy(*by, "run")
    found = found.withColumn("total", F.max("upto").over(whole) - F.min("before").over(whole)).where(F.col("total") >= min_words)
    found = found.withColumn("piece", F.col("seq") - F.row_number().over(Window.partitionBy(*by, "run", "kept").orderBy("seq")))
    return (found.groupBy(*by, "run", "kept", "piece")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first_doc_id"),
                 (F.max("upto") - F.min("before")).alias("words"))
            .where(F.col("kept") | (F.col("words") >= min_words))
            .select("doc_id", "start", (F.col("end") - F.col("start")).alias("length"), "words", "first_doc_id", "kept"))


def remove_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` without the spans that are not ``kept`` (they may overlap); of rows with one id, spans are cut from all. Texts without such spans stay as they are; columns as given."""
    gone = (spans.where(~F.col("kept")).groupBy("doc_id")
            .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("__gone"))
            .withColumnRenamed("doc_id", "__doc"))
    # texts travel as bytes, one character per byte, since spans count bytes
    raw = F.decode(F.col("text").cast("binary"), "ISO-8859-1")
    step = lambda a, g: F.struct(
        F.concat(a["s"], F.substring(raw, (a["at"] + 1).cast("int"), (g["start"] - a["at"]).cast("int"))).alias("s"),
        F.greatest(a["at"], g["start"] + g["length"]).alias("at"))
    zero = F.struct(F.lit("").alias("s"), F.lit(0).cast("long").alias("at"))
    cut = F.aggregate("__gone", zero, step, lambda a: F.concat(
        a["s"], F.substring(raw, (a["at"] + 1).cast("int"), F.length(raw))))
    out = docs.join(gone, F.coalesce(F.col("doc_id"), F.xxhash64("text")) == F.col("__doc"), "left")
    return out.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(
        F.encode(cut, "ISO-8859-1").cast("string"))).select(*docs.columns)
