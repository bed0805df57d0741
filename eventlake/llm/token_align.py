"""Alignment of two tokenizers' tokens over the bytes of every document.

Side A is a byte-level BPE (tokenizers), side B a piece model (sentencepiece, which
puts a space before the text); both see a space and then the text. A token of
either side covers a byte range. A binary search finds for each token's start the
other side's token that covers it; the union of both directions is the set of
overlapping pairs (two ranges overlap exactly if one holds the other's start).
Offsets where tokens of both sides end cut a document into groups.

Tokens. Neither tokenizer joins a white-space run to what stands before it, so a
text is cut before each space, tab or newline that follows something else. Tokens of
both sides end at every cut, so no link and no group crosses one: each different
chunk is tokenized and aligned once and kept in a bounded cache, and a document is
the sequence of its chunks. For the same reason new chunks are tokenized many in one
string. Where that would not hold (a piece of the model with white space behind
other characters, a text with Unicode white space) the whole text is one chunk, and
tokenized alone. The tokens of both sides are compared with the text's bytes.

Counts over the corpus: the first pass writes each document's different (A id, B id)
pairs with their links as compact arrays to a table in the shared folder; a pair's
count is the number of documents that hold it, summed per task before the shuffle.
The counts go back to the documents in shards of at most ``PAIRS_AT_ONCE`` pairs, a
broadcast of bounded size each; sums over the shards are exact. No document is split or
shuffled, so a hot source or group of copies makes no hot key.

Defined results: texts that are null or empty, and texts that B does not spell as
they are (U+2581 in them), have no tokens: zeros and an empty digest; special tokens'
strings are plain text; repeated rows are documents of their own; a null doc_id stays
null; other columns are not read; an empty table gives an empty one."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm.common import reliable
from eventlake.llm.hashing import text_slices
from eventlake.llm.packing import gather, numbered, words_of
from eventlake.session import scratch_path

PAIRS_AT_ONCE = 8_000_000
B_IDS = 1 << 20  # a pair is one number: A id * B_IDS + B id
PAIR_IDS = B_IDS << 20
CACHE, KEPT = 150_000, 50_000  # chunks a worker holds at most, and those in most use that it keeps then
HELD = 64_000_000  # bytes of ids, links and group texts of the chunks that a worker holds at most
AT_ONCE, JOINED = 5_000, 500  # chunks given to a tokenizer together, and in one string
SLICE = 500_000  # bytes of text aligned together

_CUT = np.zeros(256, bool)
_CUT[[32, 9, 10]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: white space outside ASCII, and the separators U+001C to U+001F
_ODD = "\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_ODD_SPACE = re.compile(f"[{_ODD}]")
#: chunks with these are tokenized alone: a side may not spell them as they are
_ALONE = re.compile(f"[{_ODD}\\x00▁]")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 for itself, the others in order from U+0100."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {**{chr(b): b for b in keep}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Sides:
    """Both tokenizers, and for each id of either the bytes that it spells."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet, vocabulary = byte_alphabet(), self.a.get_vocab()
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            spelled[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.a_bytes = Spelling(spelled)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = Spelling([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                 for i, p in enumerate(pieces)])
        self.space = self.b.piece_to_id("▁")
        # a piece with white space behind another character would cross a cut
        self.cuts = not any(re.search("[^▁\\s][▁\t\n]|[▁\\s][\t\n]", p) for p in pieces)
        self.known = numbered()
        # of every known chunk: ids of both sides, pairs of its links, number and text of its groups
        self.tokens = [Runs(np.int32), Runs(np.int32)]
        self.links = Runs(np.int64)
        self.n_groups, self.texts = np.empty(0, np.int64), []
        self.spells, self.uses = np.empty(0, bool), np.empty(0, np.int64)
        self.held = 0

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts that begin with white space, on both sides."""
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        # the model puts a space before: it stands for the text's own, or is dropped
        b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        b = [ids or [self.space] if c[0] == " " else ids[1:] for c, ids in zip(chunks, b)]
        return a, b

    def _alone(self, chunks: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Per side (ids, ids per chunk), and whether both sides spell the chunk; each chunk by itself."""
        both = self.encode(chunks)
        ok = [self.a_bytes.join(x) == c.encode() == self.b_bytes.join(y) for c, x, y in zip(chunks, *both)]
        return [(_flat_ids(ids), np.array([len(x) for x in ids], np.int64)) for ids in both], np.array(ok, bool)

    def _joined(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Per side (ids, ids per chunk) of chunks that may stand behind one another; None if a side does not
        spell them or a token crosses from one to the next."""
        raw, steps = data.tobytes(), [*range(0, len(offsets) - 1, JOINED), len(offsets) - 1]
        out = []
        for ids, spelling in zip(self.encode([raw[offsets[i]:offsets[j]].decode() for i, j in zip(steps, steps[1:])]),
                                 (self.a_bytes, self.b_bytes)):
            ids = _flat_ids(ids)
            stop = np.cumsum(spelling.size[ids])
            if not len(ids) or stop[-1] != len(data) or spelling.of(ids) != raw:
                return None
            last = np.searchsorted(stop, offsets[1:])
            if (stop[last] != offsets[1:]).any():
                return None
            out.append((ids, np.diff(last, prepend=-1)))
        return out

    def _tokenize(self, chunks: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Per side (ids, ids per chunk), and whether both sides spell the chunk."""
        _, _, data, offsets = next(text_slices(chunks, 1 << 62))
        joins = ~_SPACE[data[offsets[1:] - 1]]
        if not self.cuts or _ALONE.search(data.tobytes().decode()):
            joins &= [self.cuts and not _ALONE.search(c) for c in chunks.to_pylist()]
        on, off = np.flatnonzero(joins), np.flatnonzero(~joins)
        size = np.diff(offsets)
        first = self._joined(gather(data, offsets[on], size[on])[0], np.concatenate([[0], np.cumsum(size[on])])) if len(on) else None
        if first is None:
            on, off = off[:0], np.arange(len(chunks))
            first = [(np.empty(0, np.int32), np.empty(0, np.int64))] * 2
        rest, ok = self._alone(chunks.take(pa.array(off)).to_pylist())
        order = np.argsort(np.concatenate([on, off]))
        both = []
        for (x, n), (y, m) in zip(first, rest):
            per = np.concatenate([n, m])
            both.append((gather(np.concatenate([x, y]), (np.cumsum(per) - per)[order], per[order])[0], per[order]))
        return both, np.concatenate([np.ones(len(on), bool), ok])[order]

    def _add(self, chunks: pa.Array) -> None:
        """Tokenize and align new chunks."""
        both, spells = self._tokenize(chunks)
        for k, (ids, per) in enumerate(both):
            if not spells.all():
                ids, per = ids[np.repeat(spells, per)], np.where(spells, per, 0)
                both[k] = ids, per
            self.tokens[k].add(ids, per)
        g = linked(self, both)
        pairs = g.a.ids[g.link_a].astype(np.int64) * B_IDS + g.b.ids[g.link_b]
        doc = g.a.doc[g.link_a]
        self.links.add(pairs[np.argsort(doc, kind="stable")], np.bincount(doc, minlength=g.n))
        self.n_groups = np.concatenate([self.n_groups, np.bincount(g.group_doc, minlength=g.n)])
        texts = group_texts(g)
        self.texts += texts
        self.spells = np.concatenate([self.spells, spells])
        self.held += 8 * len(pairs) + 4 * (len(g.a.ids) + len(g.b.ids)) + sum(map(len, texts))

    def numbers(self, chunks: pa.Array, uses: np.ndarray) -> np.ndarray:
        """The numbers of different ``chunks`` that occur ``uses`` times; new ones are tokenized and aligned."""
        if len(self.known) + len(chunks) > CACHE or self.held > HELD:
            self._forget()
        before = len(self.known)
        out = np.fromiter(map(self.known.__getitem__, chunks.to_numpy(zero_copy_only=False)), np.int64, len(chunks))
        new = chunks.take(pa.array(np.flatnonzero(out >= before)))
        for i in range(0, len(new), AT_ONCE):
            self._add(new.slice(i, AT_ONCE))
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.uses[out] += uses
        return out

    def _forget(self) -> None:
        """Keep the chunks in most use."""
        keep = np.argsort(-self.uses, kind="stable")[:KEPT]
        cost = 8 * self.links.size + 4 * (self.tokens[0].size + self.tokens[1].size) + np.fromiter(map(len, self.texts), np.int64)
        keep = np.sort(keep[np.cumsum(cost[keep]) <= HELD // 2])
        names = list(self.known)
        self.known = numbered([names[k] for k in keep.tolist()])
        self.tokens, self.links = [t.take(keep) for t in self.tokens], self.links.take(keep)
        self.n_groups, self.texts = self.n_groups[keep], [self.texts[k] for k in keep]
        self.spells, self.uses = self.spells[keep], self.uses[keep] // 2
        self.held = int(cost[keep].sum())


def _flat_ids(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int32, sum(map(len, lists)))


class Spelling:
    """The bytes of every id."""

    def __init__(self, spelled: list[bytes]):
        self.spelled, self.size = spelled, np.array([len(s) for s in spelled], np.int64)
        self.flat, self.at = np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(self.size) - self.size

    def join(self, ids: list[int]) -> bytes:
        return b"".join([self.spelled[i] for i in ids])

    def of(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.at[ids], self.size[ids])[0].tobytes()


class Runs:
    """Lists one after another."""

    def __init__(self, kind: type):
        self.flat, self.at, self.size = np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, flat])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.flat, self.at[numbers], self.size[numbers])

    def take(self, keep: np.ndarray) -> Runs:
        out = Runs(self.flat.dtype)
        out.flat, out.size = self.of(keep)
        out.at = np.cumsum(out.size) - out.size
        return out


@dataclass
class Tokens:
    """The tokens of one side of some documents, in order: id, document, first byte and byte after the last."""
    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


@dataclass
class Aligned:
    """Two sides of ``n`` documents; links are pairs of token positions, groups are numbered through all documents."""
    n: int
    a: Tokens
    b: Tokens
    link_a: np.ndarray
    link_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    group_doc: np.ndarray


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (position in ``a``, position in ``b``) whose byte ranges overlap; both cover the same bytes."""
    over_a = np.searchsorted(b.start, a.start, side="right") - 1
    over_b = np.searchsorted(a.start, b.start, side="right") - 1
    # tokens that begin together find each other in both directions: keep one
    later = b.start != a.start[over_b]
    return (np.concatenate([np.arange(len(a.ids)), over_b[later]]),
            np.concatenate([over_a, np.flatnonzero(later)]))


def linked(sides: Sides, both: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
    """Align texts given per side as (ids of all texts, ids per text); both sides of a text spell the same bytes."""
    tokens = []
    for (ids, per), spelling in zip(both, (sides.a_bytes, sides.b_bytes)):
        length = spelling.size[ids]
        stop = np.cumsum(length)
        tokens.append(Tokens(ids, np.repeat(np.arange(len(per)), per), stop - length, stop))
    a, b = tokens
    link_a, link_b = overlaps(a, b) if len(a.ids) else (np.empty(0, np.int64),) * 2
    group_a, group_b = np.searchsorted(b.end, a.end), np.searchsorted(a.end, b.end)
    ends_a, ends_b = b.end[group_a] == a.end, a.end[group_b] == b.end
    # a token's group: the shared ends before its own
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    return Aligned(len(both[0][1]), a, b, link_a, link_b, group_a, group_b, a.doc[ends_a])


def chunked(sides: Sides, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, text) of all chunks in order, of texts that lie in ``data`` at ``offsets``; none of texts without tokens."""
    n, size = len(offsets) - 1, np.diff(offsets)
    data = np.insert(data, offsets[:-1], 32)
    offsets = offsets + np.arange(n + 1)
    cut = _CUT[data] & ~_SPACE[np.concatenate([[0], data[:-1]])]
    if not sides.cuts:
        cut[:] = False
    raw = data.tobytes()
    if cut.any() and _ODD_SPACE.search(raw.decode()):
        for i in range(n):
            if _ODD_SPACE.search(raw[offsets[i]:offsets[i + 1]].decode()):
                cut[offsets[i]:offsets[i + 1]] = False
    cut[offsets[:-1]] = True
    start = np.flatnonzero(cut)
    coded = words_of(data, start, np.append(start[1:], len(data))).dictionary_encode()
    of = coded.indices.to_numpy()
    number = sides.numbers(coded.dictionary, np.bincount(of, minlength=len(coded.dictionary)))[of]
    doc = np.searchsorted(offsets, start, side="right") - 1
    good = (np.bincount(doc, weights=~sides.spells[number], minlength=n) == 0) & (size > 0)
    on = good[doc]
    return number[on], doc[on]


def align(sides: Sides, data: np.ndarray, offsets: np.ndarray) -> Aligned:
    """Align the texts that lie in ``data`` at ``offsets``."""
    number, doc = chunked(sides, data, offsets)
    both = []
    for runs in sides.tokens:
        ids, per = runs.of(number)
        both.append((ids, np.bincount(doc, weights=per, minlength=len(offsets) - 1).astype(np.int64)))
    return linked(sides, both)


class Decimals:
    """Ids as decimal text with a spare byte behind each, made once per worker."""

    flat = at = size = None

    @classmethod
    def upto(cls, most: int) -> type[Decimals]:
        if cls.size is None or len(cls.size) <= most:
            text = [b"%d0" % i for i in range(2 * most + 2)]
            cls.size = np.array([len(x) for x in text], np.int64)
            cls.at = np.cumsum(cls.size) - cls.size
            cls.flat = np.frombuffer(b"".join(text), np.uint8)
        return cls


def group_texts(g: Aligned) -> list[bytes]:
    """Per text ``a1,a2|b1;a3|b2,b3;``; empty without tokens."""
    n_groups = len(g.group_doc)
    sa, sb = np.bincount(g.group_a, minlength=n_groups), np.bincount(g.group_b, minlength=n_groups)
    to_a, to_b = np.cumsum(sa), np.cumsum(sb)
    at_a = np.arange(len(g.group_a)) + (to_b - sb)[g.group_a]
    at_b = np.arange(len(g.group_b)) + to_a[g.group_b]
    total = len(at_a) + len(at_b)
    ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
    ids[at_a], ids[at_b] = g.a.ids, g.b.ids
    mark[to_a + to_b - sb - 1] = ord("|")
    mark[to_a + to_b - 1] = ord(";")
    ten = Decimals.upto(int(ids.max(initial=1 << 15)))
    size = ten.size[ids]
    flat, _ = gather(ten.flat, ten.at[ids], size)
    stop = np.concatenate([[0], np.cumsum(size)])
    flat[stop[1:] - 1] = mark
    last = np.cumsum(np.bincount(g.a.doc, minlength=g.n) + np.bincount(g.b.doc, minlength=g.n))
    raw, ends = flat.tobytes(), [0, *stop[last].tolist()]
    return [raw[i:j] for i, j in zip(ends, ends[1:])]


def _over_slices(a_path: str, b_path: str, rows: Callable[[Sides, np.ndarray, np.ndarray, pa.Array], pa.RecordBatch]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = None
        for batch in batches:
            sides = sides or Sides(a_path, b_path)
            for i, j, data, offsets in text_slices(batch.column(1), SLICE):
                yield rows(sides, data, offsets, batch.column(0).slice(i, j - i))

    return run


def _lists(values: np.ndarray, doc: np.ndarray, n: int, kind: pa.DataType = pa.int32()) -> pa.Array:
    """One list per document of ``values`` in the documents' order."""
    cuts = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(values, kind))


def _links(sides: Sides, data: np.ndarray, offsets: np.ndarray, doc_id: pa.Array) -> pa.RecordBatch:
    g = align(sides, data, offsets)
    base_a, base_b = (np.searchsorted(t.doc, np.arange(g.n)) for t in (g.a, g.b))
    base_g = np.searchsorted(g.group_doc, np.arange(g.n))
    order = np.lexsort((g.link_b, g.link_a))
    la, lb = g.link_a[order], g.link_b[order]
    doc = g.a.doc[la]
    return pa.RecordBatch.from_arrays(
        [doc_id, _lists(g.a.ids, g.a.doc, g.n), _lists(g.b.ids, g.b.doc, g.n),
         _lists(g.group_a - base_g[g.a.doc], g.a.doc, g.n), _lists(g.group_b - base_g[g.b.doc], g.b.doc, g.n),
         _lists(la - base_a[doc], doc, g.n), _lists(lb - base_b[doc], doc, g.n)],
        names=["doc_id", "a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b"])


def _inputs(docs: DataFrame) -> DataFrame:
    ship_by_value(__name__)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def token_links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the ids of both sides, each token's group, and
    the links as positions of the linked tokens."""
    return _inputs(docs).mapInArrow(_over_slices(a_path, b_path, _links), (
        "doc_id long, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, "
        "link_a array<int>, link_b array<int>"))


def _pairs(sides: Sides, data: np.ndarray, offsets: np.ndarray, doc_id: pa.Array) -> pa.RecordBatch:
    """Counts and digest per document, and its different pairs with their links."""
    n = len(offsets) - 1
    number, doc = chunked(sides, data, offsets)
    cuts = np.searchsorted(doc, np.arange(n + 1))
    sums = lambda x: pa.array(_exact(doc, x[number], n))
    texts, sha = [sides.texts[k] for k in number.tolist()], []
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        sha.append(hashlib.sha256(b"".join(texts[i:j])[:-1]).hexdigest() if j > i else "")
    # the documents that have tokens, and so bytes, are few enough for one number with the pair
    having = np.flatnonzero(np.diff(cuts))
    pair, links = sides.links.of(number)
    pair += np.repeat(np.searchsorted(having, doc), links) * PAIR_IDS
    pair.sort()
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    links = np.diff(first, append=len(pair))
    pair = pair[first]
    holder = having[pair // PAIR_IDS]
    return pa.RecordBatch.from_arrays(
        [doc_id, sums(sides.tokens[0].size), sums(sides.tokens[1].size), sums(sides.n_groups), sums(sides.links.size),
         pa.array(sha, pa.string()), _lists(pair % PAIR_IDS, holder, n, pa.int64()), _lists(links, holder, n)],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists, row of each)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), np.diff(offsets))


def _documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, documents of this task that hold it)."""
    keys, counts, held = [], [], 0

    def summed():
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)

    for b in batches:
        key, count = np.unique(_flat(b.column(0))[0], return_counts=True)
        keys.append(key)
        counts.append(count)
        held += len(key)
        if held > 4_000_000:
            key, count = summed()
            keys, counts, held = [key], [count], len(key)
            if held > 2_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], names=["pair", "n"])
                keys, counts, held = [], [], 0
    if keys:
        key, count = summed()
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], names=["pair", "n"])


def pair_counts(table: DataFrame) -> DataFrame:
    """pair, n (documents that hold it), best (no pair of its A id has more)."""
    counts = table.select("pairs").mapInArrow(_documents_with, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = reliable(counts.withColumn("a", F.floor(F.col("pair") / F.lit(B_IDS))))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _summed(shared):
    """Adds up a document's links over the pairs of one shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for b in batches:
            key, row = _flat(b.column(b.num_columns - 2))
            links = _flat(b.column(b.num_columns - 1))[0].astype(np.int64)
            at = np.minimum(np.searchsorted(pair, key), max(0, len(pair) - 1))
            on = pair[at] == key if len(pair) else np.zeros(len(key), bool)
            at, row, links = at[on], row[on], links[on]
            total = lambda x: pa.array(_exact(row, x, b.num_rows))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], total(links * best[at]), total(links * n[at])],
                                             names=[*b.schema.names[:-2], "n_best", "count_sum"])

    return run


def _exact(row: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Integer sums of ``x`` per row (rows in order)."""
    sums = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    cuts = np.searchsorted(row, np.arange(n + 1))
    return sums[cuts[1:]] - sums[cuts[:-1]]


def alignment_digests(docs: DataFrame, a_path: str, b_path: str, pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    path = scratch_path(spark, "token-align")
    (_inputs(docs).mapInArrow(_over_slices(a_path, b_path, _pairs),
                              "doc_id long, " + ", ".join(f"{c} long" for c in counts) +
                              ", groups_sha256 string, pairs array<long>, links array<int>")
     .withColumn("row", F.monotonically_increasing_id()).write.parquet(path))
    table = spark.read.parquet(path)
    pairs = reliable(pair_counts(table))
    shards = max(1, -(-pairs.count() // pairs_at_once))
    own = ["doc_id", *counts, "groups_sha256"]
    types = ", ".join(f"{c} string" if c == "groups_sha256" else f"{c} long" for c in ["row", *own])
    parts = []
    for s in range(shards):
        part = pairs if shards == 1 else pairs.where(F.pmod(F.xxhash64("pair"), F.lit(shards)) == s)
        got = part.toArrow().sort_by("pair")  # bounded by ``pairs_at_once``
        shared = spark.sparkContext.broadcast(tuple(got[c].to_numpy() for c in ("pair", "n", "best")))
        parts.append(table.select("row", *own, "pairs", "links").mapInArrow(
            _summed(shared), f"{types}, n_best long, count_sum long"))
    if shards == 1:
        out = parts[0]
    else:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("row", *own).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.select("doc_id", *counts, "n_best", "count_sum", "groups_sha256")
