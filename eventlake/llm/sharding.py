"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of ``cells`` cells; a row's key
hashes to a cell and belongs to the first shard clockwise from it. A shard
takes rows up to its capacity; what overflows continues clockwise to the next
shard with room. With ``epsilon`` = e the capacity is (1 + e) times the mean,
which leaves slack so that little moves when a shard is added; with ``epsilon``
= 0 capacities are the mean rounded down or up, and counts differ by one at most.

Who goes where follows from the number of rows per cell alone, so the driver
sees ``cells`` counts (a fixed bound), walks the ring once per filled shard, and
hands back one piece (cell, from, to, shard, first slot) per cell, plus one for
each shard that fills up inside a cell. Rows find their piece by their rank in
their cell. All of it is DataFrame operations on narrow rows; equal rows are
counted before the shuffle and dealt out again after it.

Defined results: a null key is a key like any other; a null text has no bytes
(size 1, CRC 0); repeated rows are ranked after each other and each gets a slot;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import reliable

CHUNK = 10_000  # copies of one row that are dealt out from one array


def ring_points(n_shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes in clockwise order; the points of a
    shard do not depend on how many others there are."""
    points = []
    for s in range(n_shards):
        for v in range(vnodes):
            h = hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(h, "big") % cells, s))
    return sorted(points)


def capacities(rows: int, n_shards: int, epsilon: float) -> list[int]:
    if epsilon > 0:
        return [math.ceil((1 + epsilon) * rows / n_shards)] * n_shards
    return [rows // n_shards + (s < rows % n_shards) for s in range(n_shards)]


def walk(counts: dict[int, int], n_shards: int, vnodes: int, cells: int,
         epsilon: float) -> list[tuple[int, int, int, int]]:
    """Pieces (cell, from, to, shard): in each round the rows not yet placed go to
    the first shard clockwise that still has room, in clockwise order."""
    room = capacities(sum(counts.values()), n_shards, epsilon)
    points = [p for p in ring_points(n_shards, vnodes, cells) if room[p[1]] > 0]
    pending = [(c, 0, n) for c, n in sorted(counts.items()) if n > 0]
    pieces = []
    while pending:
        at, rest = [p[0] for p in points], []
        for cell, lo, hi in pending:
            s = points[bisect.bisect_left(at, cell) % len(points)][1]
            take = min(hi - lo, room[s])
            if take:
                pieces.append((cell, lo, lo + take, s))
                room[s] -= take
            if lo + take < hi:
                rest.append((cell, lo + take, hi))
        pending, points = rest, [p for p in points if room[p[1]] > 0]
    return sorted(pieces)


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def assign_shards(docs: DataFrame, n_shards: int = 8, vnodes: int = 128, epsilon: float = 0.0,
                  cells: int = 1 << 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs`` (doc_id,
    text). Slots count from 0 without gaps in each shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    cell = F.pmod(F.xxhash64(F.lit(17), F.col("doc_id")), F.lit(cells)).cast("int")
    units = reliable(docs.select(cell.alias("cell"), "doc_id", text_size(F.col("text")).alias("size"),
                                 F.crc32(text.cast("binary")).alias("text_crc32"))
                     .groupBy("cell", "doc_id", "text_crc32", "size").agg(F.count("*").alias("n")))
    counts = {r["cell"]: r["n"] for r in units.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    slots, rows = [0] * n_shards, []
    for c, lo, hi, s in walk(counts, n_shards, vnodes, cells, epsilon):
        rows.append((c, lo, hi, s, slots[s]))
        slots[s] += hi - lo
    pieces = spark.createDataFrame(rows, "cell int, lo long, hi long, shard int, base long")
    in_cell = (Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = units.withColumn("to", F.sum("n").over(in_cell)).withColumn("from", F.col("to") - F.col("n"))
    placed = (ranked.join(F.broadcast(pieces), "cell")  # at most cells + shards pieces
              .where((F.col("from") < F.col("hi")) & (F.col("to") > F.col("lo")))
              .withColumn("a", F.greatest("from", "lo")).withColumn("b", F.least("to", "hi")))
    dealt = (placed.withColumn("a", F.explode(F.sequence("a", F.col("b") - 1, F.lit(CHUNK).cast("long"))))
             .withColumn("at", F.explode(F.sequence("a", F.least(F.col("a") + CHUNK, "b") - 1))))
    return dealt.select("doc_id", "size", "text_crc32", "shard",
                        (F.col("base") + F.col("at") - F.col("lo")).alias("slot"))
