"""Phrase collocations by broadcast double-array tries.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and
pieces into words at spaces and tabs. Everything is counted per language. Phrases
are up to ``longest`` words inside a piece.

*Candidates, Apriori-safe.* Level by level, 64-bit hashes of the phrases are counted
per task and summed; a phrase takes part in the next level only if both phrases one
word shorter may be frequent. That is asked of a bit table of fixed size made from the
hashes with enough occurrences: it never denies a frequent phrase. With the counts goes
the smallest fingerprint (one byte) of a text that holds the phrase; in a last pass the phrases with enough
occurrences are spelled out by the texts of that fingerprint alone, one and a 256th of the others (asked of a bit table
again, so now and then by another one too) and made distinct: the frequent phrases, and little more (hashes may collide).
What a step has shuffled goes from the disks when the step is done, its broadcasts too.

*Counting.* The candidates, single words included, are cut by their order into shards
of at most about ``trie_bytes`` of text. Each shard becomes a double-array trie over
bytes (``base``, ``check``), built level by level from the sorted candidates as arrays;
its size is bounded by the shard, so it can be broadcast. numpy advances the states
of all word positions of a batch at the same time, one byte per level; where a word
ends in an accepting state its phrase is counted (``bincount``), and the counts of the
tasks are summed. One pass over the texts per shard: the number of shards grows with the
number of frequent phrases, the memory does not.

*Scores.* A phrase of ``a`` occurrences cut into two parts of ``l`` and ``r`` scores
floor(10^6 a a / (l r)) in decimals of 38 digits; the lowest cut counts, ties go to the
first. Phrases inside a longer candidate with at least half their occurrences go.

Defined results: null and empty texts have no words, a null language is ``und``,
repeated rows count each, words may hold any character but the separators, other
columns are not read, an empty table gives no phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm.common import reliable
from eventlake.llm.hashing import SpanHash, spans, splitmix, text_slices
from eventlake.llm.packing import gather
from eventlake.session import done_shuffles_removed, scratch_path

MIN_COUNT, LONGEST, TOP = 10, 3, 2000
TRIE_BYTES = 24_000_000  # candidate text of one shard
FILTER_BITS = 1 << 28
SLICE = 300_000  # bytes of text worked on together
HELD = 500_000  # different hashes a task holds before it passes them on
SEEN = 500_000  # phrases a task remembers to have spelled out

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[ord(c) for c in ".,;:!?"] + [*range(10, 14)]] = True
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[32, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEED = 12
LANG_END = b"\xff"  # never in UTF-8


class Pieces:
    """The words of some texts in one array: lower-cased, one space between words of a
    piece, a line end behind the last word of a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array):
        data = _LOWER[data]
        start, end, row = spans(data, offsets, ~(_SEPARATOR | _BETWEEN))
        n = len(start)
        stops = np.concatenate([[0], np.cumsum(_SEPARATOR[data])])
        # the next word is in the same piece
        joined = np.zeros(n, bool)
        if n:
            joined[:-1] = (stops[start[1:]] == stops[end[:-1]]) & (row[1:] == row[:-1])
        self.data, size = gather(np.append(data, np.uint8(0)), start, end - start + 1)
        self.end = np.cumsum(size) - 1
        self.start = self.end - size + 1
        self.data[self.end] = np.where(joined, 32, 10)
        #: words that follow in the piece, up to LONGEST - 1
        self.follow = np.zeros(n, np.int64)
        for _ in range(LONGEST - 1):
            self.follow[:-1] = np.where(joined[:-1], np.minimum(self.follow[1:] + 1, LONGEST - 1), 0)
        coded = langs.cast(pa.string()).fill_null("und").dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        self.lang = coded.indices.to_numpy()[row] if n else np.empty(0, np.int64)
        self.sums = SpanHash(self.data, _SEED)
        # a fingerprint of the text of every word
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if n else np.empty(0, np.int64)
        last = np.append(first[1:], n) - 1 if n else first
        prints = (self.sums.of(self.start[first], self.end[last]) >> np.uint64(56)).astype(np.int32)
        self.text = np.repeat(prints, last - first + 1)
        salt = np.array([splitmix(np.array([SpanHash(np.frombuffer(x.encode() + LANG_END, np.uint8), _SEED)
                                            .of(np.array([0]), np.array([len(x.encode()) + 1]))[0]]))[0]
                         for x in self.langs], np.uint64)
        self.salt = salt[self.lang] if n else np.empty(0, np.uint64)

    def phrases(self, k: int) -> np.ndarray:
        """Positions of the first words of all phrases of ``k`` words."""
        return np.flatnonzero(self.follow >= k - 1)

    def hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        """62 bits of a hash, and the number of words."""
        h = splitmix(self.sums.of(self.start[at], self.end[at + k - 1]) ^ self.salt[at])
        return (h << np.uint64(2)) | np.uint64(k)


def held_by(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A hash of a phrase's hash and a text's fingerprint."""
    x = (h ^ (text.astype(np.uint64) * np.uint64(0x9E3779B1))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Pieces]:
    for b in batches:
        for i, j, data, offsets in text_slices(b.column(1), SLICE):
            yield Pieces(data, offsets, b.column(0).slice(i, j - i))


class Bits:
    """A bit table: has a hash been put in? Never denies one that has."""

    def __init__(self, words: np.ndarray, size: int = FILTER_BITS):
        self.words, self.mask = words, np.uint64(size - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


class Summed:
    """Hashes with counts and the smallest fingerprint, merged as they come; passed on when there are many."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, h: np.ndarray, text: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(h):
            return
        self.parts.append(self.merged(h, np.ones(len(h), np.int64), text))
        self.held += len(self.parts[-1][0])
        if self.held > HELD:
            self.parts = [self.merged(*self.taken())]
            self.held = len(self.parts[0][0])
            if self.held > HELD // 2:
                yield from self.rest()

    def taken(self) -> list[np.ndarray]:
        """All that is held, column by column; it is held no longer."""
        parts, self.parts, self.held = [list(p) for p in self.parts], [], 0
        return [np.concatenate([p.pop(0) for p in parts]) for _ in range(3)]

    @staticmethod
    def merged(h: np.ndarray, n: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(h)
        h = h[order]
        new = np.ones(len(h), bool)
        np.not_equal(h[1:], h[:-1], out=new[1:])
        first = np.flatnonzero(new)
        return h[first], np.add.reduceat(n[order], first), np.minimum.reduceat(text[order], first)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            h, n, text = self.merged(*self.taken())
            for i in range(0, len(h), 100_000):
                z = i + 100_000
                yield pa.RecordBatch.from_arrays([pa.array(h[i:z].view(np.int64)), pa.array(n[i:z]), pa.array(text[i:z], pa.int32())],
                                                 names=["h", "n", "text"])


def _hash_counts(sizes: list[int], shared):
    """Counts of the hashes of all phrases of ``sizes`` words whose parts one word shorter pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, bits = Summed(), Bits(shared.value) if shared is not None else None
        for p in _pieces(batches):
            for k in sizes:
                at = p.phrases(k)
                if bits is not None:
                    ok = np.zeros(len(p.start) + 1, bool)
                    part = p.phrases(k - 1)
                    ok[part] = bits.has(p.hashes(part, k - 1) >> np.uint64(2))
                    at = at[ok[at] & ok[at + 1]]
                yield from sums.add(p.hashes(at, k), p.text[at])
        yield from sums.rest()

    return run


def _spelled(shared, longest: int):
    """(language, phrase, hash) of the frequent phrases that a text has to spell out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(shared.value)
        seen: set[int] = set()
        for p in _pieces(batches):
            raw = None
            for k in range(1, longest + 1):
                at = p.phrases(k)
                h = p.hashes(at, k)
                on = bits.has(held_by(h, p.text[at]))
                h, first = np.unique(h[on], return_index=True)
                at = at[on][first]
                new = np.array([x not in seen for x in h.tolist()], bool)
                if not new.any():
                    continue
                h, at = h[new], at[new]
                if len(seen) > SEEN:
                    seen.clear()
                seen.update(h.tolist())
                raw = raw if raw is not None else p.data.tobytes()
                text = [raw[s:e] for s, e in zip(p.start[at].tolist(), p.end[at + k - 1].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p.langs[x] for x in p.lang[at]], pa.string()), pa.array(text, pa.binary()).cast(pa.string()),
                     pa.array(h.view(np.int64))], names=["lang", "phrase", "h"])

    return run


class Trie:
    """A double-array trie over bytes. Keys are numbered in their (byte) order; the
    child of state s by byte c is t = base[s] + code[c] if check[t] = s. Codes follow the
    bytes' frequency, so the children of a state lie close together."""

    ROOT = 256

    def __init__(self, base: np.ndarray, check: np.ndarray, accept: np.ndarray, code: np.ndarray, n: int):
        self.base, self.check, self.accept, self.code, self.n = base, check, accept, code, n

    @classmethod
    def of(cls, flat: np.ndarray, offsets: np.ndarray) -> Trie:
        """``flat``, ``offsets``: the bytes of sorted, different keys. States are laid out
        level by level: several children of a state take the range of their codes, an only
        child takes a hole in the ranges so far while there is one."""
        n, size = len(offsets) - 1, np.diff(offsets)
        code = np.empty(256, np.int32)
        code[np.argsort(-np.bincount(flat, minlength=256), kind="stable")] = np.arange(256)
        holes = np.empty(0, np.int64)
        live, state = np.arange(n), np.full(n, cls.ROOT, np.int64)
        levels, cursor, depth = [], cls.ROOT + 1, 0
        final = np.full(n, cls.ROOT, np.int64)
        while len(live):
            live, parent = live[size[live] > depth], state[size[live] > depth]
            if not len(live):
                break
            byte = flat[offsets[live] + depth]
            new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1])])
            of, by = parent[new], code[byte[new]].astype(np.int64)
            head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            children = np.diff(np.append(head, len(by)))
            low, only = np.minimum.reduceat(by, head), np.flatnonzero(children == 1)
            width = np.where(children > 1, np.maximum.reduceat(by, head) - low + 1, 0)
            base = cursor + np.cumsum(width) - width - low
            end = cursor + int(width.sum())
            if end > cursor:
                free = np.ones(end - cursor, bool)
                free[(np.repeat(base, children) + by)[np.repeat(children > 1, children)] - cursor] = False
                holes = np.concatenate([holes, np.flatnonzero(free) + cursor])
            cursor = end + max(0, len(only) - len(holes))
            if cursor > end:
                holes = np.concatenate([holes, np.arange(end, cursor)])
            base[only], holes = holes[:len(only)] - low[only], holes[len(only):]
            child = np.repeat(base, children) + by
            levels.append([x.astype(np.int32) for x in (of[head], base, child, of)])
            state = child[np.cumsum(new) - 1]
            final[live] = state
            depth += 1
        arrays = np.zeros(cursor + 256, np.int32), np.full(cursor + 256, -1, np.int32), np.full(cursor + 256, -1, np.int32)
        for owner, base, child, parents in levels:
            arrays[0][owner], arrays[1][child] = base, parents
        arrays[2][final] = np.arange(n)
        arrays[2][cls.ROOT] = -1
        return cls(*arrays, code, n)

    def walk(self, key: bytes) -> int:
        """The state after ``key``, -1 if there is none."""
        s = self.ROOT
        for c in key:
            t = int(self.base[s] + self.code[c])
            if self.check[t] != s:
                return -1
            s = t
        return s

    def count(self, p: Pieces) -> np.ndarray:
        """Occurrences of every key among the phrases of ``p``."""
        begin = np.array([self.walk(x.encode() + LANG_END) for x in p.langs], np.int64)
        state = begin[p.lang] if len(p.lang) else np.empty(0, np.int64)
        at = p.start[state >= 0]
        state = state[state >= 0]
        found = [np.empty(0, np.int32)]
        while len(at):
            c = p.data[at]
            key = self.accept[state[(c == 32) | (c == 10)]]
            found.append(key[key >= 0])
            child = self.base[state] + self.code[c]
            on = (self.check[child] == state) & (c != 10)
            state, at = child[on], at[on] + 1
        return np.bincount(np.concatenate(found), minlength=self.n)


def _occurrences(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, total = Trie(*shared.value), None
        for p in _pieces(batches):
            got = trie.count(p)
            total = got if total is None else total + got
        if total is not None:
            i = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total[i])], names=["i", "n"])

    return run


def _word_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, int] = {}
    for p in _pieces(batches):
        for lang, n in zip(p.langs, np.bincount(p.lang, minlength=len(p.langs))):
            total[lang] = total.get(lang, 0) + int(n)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["lang", "n"])


def bit_table(hashes: DataFrame, size: int | None = None) -> np.ndarray:
    """The bit table of the hashes ``x`` (FILTER_BITS bits unless given): a 64th as many rows reach the driver at most."""
    size = size or FILTER_BITS
    at = F.col("x").bitwiseAND(F.lit(size - 1))
    rows = (hashes.select(F.shiftright(at, 6).alias("word"), F.expr("shiftleft(1L, int(x & 63))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    words = np.zeros(size // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = held_by(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), b.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64))], names=["x"])


def _summed(rows: DataFrame) -> DataFrame:
    """The counts and smallest fingerprints of the rows of :class:`Summed`, per hash. They are dealt out as they
    come: their tasks have merged them, and to hold them once more before the shuffle takes most of an executor's heap."""
    return rows.repartition("h").groupBy("h").agg(F.min("text").alias("text"), F.sum("n").alias("n"))


def candidates(texts: DataFrame, min_count: int, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase), kept reliably: every phrase of 1 to ``longest`` words that may occur ``min_count`` times. ``texts``: lang, text."""
    spark = texts.sparkSession
    hashed = lambda sizes, shared: reliable(
        _summed(texts.mapInArrow(_hash_counts(sizes, shared), "h long, n long, text int"))
        .where(F.col("n") >= min_count).select("h", "text"))
    frequent = level = hashed([1, 2], None)
    for k in range(3, longest + 1):
        shorter = level.where(F.col("h").bitwiseAND(F.lit(3)) == k - 1).select(F.shiftrightunsigned("h", 2).alias("x"))
        shared = spark.sparkContext.broadcast(bit_table(shorter))
        level = hashed([k], shared)
        shared.destroy()
        frequent = frequent.unionByName(level)
    owners = spark.sparkContext.broadcast(bit_table(frequent.mapInArrow(_owners, "x long")))
    spelled = texts.mapInArrow(_spelled(owners, longest), "lang string, phrase string, h long")
    found = reliable(spelled.distinct().join(frequent.select("h"), "h", "left_semi").select("lang", "phrase"))
    owners.destroy()
    return found


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the sorted rows of a partition."""
    at = 0
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.arange(at, at + b.num_rows))], names=[*b.schema.names, "i"])
        at += b.num_rows


def phrase_counts(texts: DataFrame, min_count: int, longest: int = LONGEST, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """lang, phrase, f of every phrase of 1 to ``longest`` words with at least ``min_count`` occurrences."""
    spark = texts.sparkSession
    found = candidates(texts, min_count, longest)
    size = found.agg(F.sum(F.octet_length("phrase") + F.octet_length("lang") + 1)).first()[0] or 0
    shards = max(1, -(-size // trie_bytes))
    path = scratch_path(spark, "collocations")
    (found.repartitionByRange(shards, "lang", "phrase").sortWithinPartitions("lang", "phrase")
     .withColumn("shard", F.spark_partition_id())
     .mapInArrow(_numbered, "lang string, phrase string, shard int, i long").write.parquet(path))
    table = spark.read.schema("lang string, phrase string, shard int, i long").parquet(path)
    parts = []
    for s in range(shards):
        own = table.where(F.col("shard") == s)
        rows = own.orderBy("i").select(F.concat(F.encode("lang", "utf-8"), F.unhex(F.lit("FF")), F.encode("phrase", "utf-8"))
                                       .alias("key")).toArrow()["key"].combine_chunks()  # bounded by ``trie_bytes``
        if not len(rows):
            continue
        rows = rows.cast(pa.large_binary())
        offsets = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset:rows.offset + len(rows) + 1]
        trie = Trie.of(np.frombuffer(rows.buffers()[2], np.uint8), offsets)
        shared = spark.sparkContext.broadcast((trie.base, trie.check, trie.accept, trie.code, trie.n))
        counts = (texts.mapInArrow(_occurrences(shared), "i long, n long").groupBy("i").agg(F.sum("n").alias("f"))
                  .where(F.col("f") >= min_count))
        parts.append(reliable(counts.join(own, "i").select("lang", "phrase", "f")))
        shared.destroy()
    if not parts:
        return spark.createDataFrame([], "lang string, phrase string, f long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scored(counts: DataFrame) -> DataFrame:
    """Every phrase of two or more words with its lowest cut: lang, phrase, words, a, l, r, score."""
    many = counts.withColumn("ws", F.split("phrase", " ")).where(F.size("ws") > 1)
    cut = F.transform(F.sequence(F.lit(1), F.size("ws") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("ws", F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice("ws", k + 1, F.size("ws")), " ").alias("right")))
    many = (many.select("lang", "phrase", F.size("ws").alias("words"), F.col("f").alias("a"), F.explode(cut).alias("cut"))
            .select("lang", "phrase", "words", "a", "cut.*"))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = many.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = lambda c: f"cast({c} as decimal(14, 0))"
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    low = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k"))
    return (cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(low.alias("low"))
            .select("lang", "phrase", "words", "a", "low.*"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of every language in
    ``docs`` (lang, text) by score, occurrences and phrase."""
    ship_by_value(__name__)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    with done_shuffles_removed(docs.sparkSession):
        counts = phrase_counts(texts, min_count, LONGEST, trie_bytes)
        scored = reliable(_scored(counts))
    totals = texts.mapInArrow(_word_totals, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    words = F.split("phrase", " ")
    inside = (scored.where(F.col("words") > 2)
              .select("lang", "a", F.explode(F.array(
                  F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "),
                  F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (scored.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
