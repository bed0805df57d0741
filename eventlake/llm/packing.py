"""Packing by power-of-two decomposition.

A document of L tokens is cut into pieces whose lengths are powers of two: as
many of ``max_length`` as fit, then the binary digits of the rest, longest
first. Every piece is a sequence of its own, so no sequence crosses documents
and none needs padding; equal lengths form the buckets that a trainer batches
from (``write_buckets`` lays them out as one folder per length).

The tokens come from a public tokenizer file, read by every worker from
``tokenizer_path``. BPE works on single parts of words. Words of printable Latin-1 are
lower-cased and cut into those parts as arrays; other words stay whole. Parts and whole
words are dictionary encoded, each different one is tokenized once per worker, and the ids of
the texts are gathered by array operations. One pass, no
shuffle; memory per task is one batch of texts plus the bounded caches: ``CACHE``
different words, of which those in most use outlast a full cache, and ``PARTS`` parts beyond ASCII.

Defined results: a null text is empty; an empty text has the end id alone;
repeated rows are packed each for itself; a row's other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm.hashing import text_slices, word_spans

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"

CACHE, KEPT = 300_000, 100_000  # words a worker holds at most, and those in most use that it keeps then
PARTS = 100_000  # parts of words beyond ASCII it holds at most
SLICE = 1_000_000  # bytes of text tokenized together

#: words of printable Latin-1 characters take the short way; its classes are those of the tokenizer
_PLAIN, _PLAIN_LINES = re.compile("[!-~¡-¬®-ÿ]+"), re.compile("[!-~¡-¬®-ÿ\n]+")
_L = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_N = "0-9²³¹¼-¾"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\\s{_L}{_N}]+|\n")  # a line end closes a word
AT_ONCE = 4_000  # new words taken apart together

#: the same classes by code point: 1 letter, 2 digit, 3 other; 0 is not printable Latin-1. And what is added to a capital's last byte
_CLASS = np.array([0 if not _PLAIN.fullmatch(chr(c)) else 1 if re.fullmatch(f"[{_L}]", chr(c)) else 2 if re.fullmatch(f"[{_N}]", chr(c)) else 3
                   for c in range(256)], np.uint8)
_CASE = np.array([32 if "A" <= chr(c) <= "Z" or "À" <= chr(c) <= "Þ" and c != 0xD7 else 0 for c in range(256)], np.uint8)
_ASCII = np.where(np.arange(256) < 128, _CLASS, 0).astype(np.uint8)
_LOWER = np.where(np.arange(256) < 128, np.arange(256) + _CASE, np.arange(256)).astype(np.uint8)


class WordTokenizer:
    """Ids of whole texts by the tokenizer file's own BPE model, word by word.

    The file lowers case and drops white space, and its pre-tokenizer never
    crosses white space, so the ids of a text are those of its words in order.
    Words outside printable Latin-1 go through the whole tokenizer, as do whole
    texts that contain the string of a special token, which may span words."""

    def __init__(self, path: str, cache_words: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.limit = cache_words
        # parts of words met: number by text, the line end is 0 and without ids; ids as those of words
        self._forget_parts()
        # words met: number by text; ids of word k are flat[at[k]:at[k] + size[k]]; slices it was in
        self.words = numbered()
        self.flat, self.at, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)
        # byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...; line ends stay between parts
        keep = [10, *range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep or b == 10]
        self.alphabet = {**{b: 256 + i for i, b in enumerate(rest)}, **{b: b for b in keep}}

    def _part_numbers(self, parts: list[str]) -> np.ndarray:
        """The numbers of ``parts``; new ones are tokenized."""
        known = len(self.parts)
        out = np.fromiter(map(self.parts.__getitem__, parts), np.int64, len(parts))
        new = [*islice(reversed(self.parts), len(self.parts) - known)][::-1]
        if new:
            tokenize = self.model.tokenize
            spelled = "\n".join(new).encode().decode("latin-1").translate(self.alphabet)
            ids = [[t.id for t in tokenize(s)] for s in spelled.split("\n")]
            size = np.array([len(x) for x in ids], np.int64)
            self.part_at = np.concatenate([self.part_at, len(self.part_flat) + np.cumsum(size) - size])
            self.part_size = np.concatenate([self.part_size, size])
            self.part_flat = np.concatenate([self.part_flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))])
        return out

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, ids per word). Words of printable ASCII are single parts."""
        tokenize = self.model.tokenize
        ids = [[t.id for t in tokenize(w)] if w.isascii() and w.isprintable() else None for w in words]
        other = [k for k, x in enumerate(ids) if x is None]
        if other:
            flat, per = self._ids_of_parts([words[k] for k in other])
            flat = flat.tolist()
            stop = np.cumsum(per).tolist()
            for k, a, z in zip(other, [0, *stop], stop):
                ids[k] = flat[a:z]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _ids_of_parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that are taken apart first."""
        text = "\n".join(words)
        plain = _PLAIN_LINES.fullmatch(text) is not None or [bool(_PLAIN.fullmatch(w)) for w in words]
        short = words if plain is True else [w if p else "" for w, p in zip(words, plain)]
        parts = _PARTS.findall("".join([w + "\n" for w in short]).lower())
        number = self._part_numbers(parts)
        ids, size = gather(self.part_flat, self.part_at[number], self.part_size[number])
        per = np.diff(np.cumsum(size)[number == 0], prepend=0)
        if len(self.parts) > min(self.limit, PARTS):
            self._forget_parts()
        if plain is not True:
            odd = [k for k, p in enumerate(plain) if not p]
            long = [e.ids for e in self.whole.encode_batch_fast([words[k] for k in odd], add_special_tokens=False)]
            ids = np.insert(ids, np.repeat(np.cumsum(per)[odd], [len(x) for x in long]), [i for x in long for i in x])
            per[odd] = [len(x) for x in long]
        return ids, per

    def _forget_parts(self) -> None:
        self.parts = numbered("\n")
        self.part_flat, self.part_at, self.part_size = np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of different ``words``; new ones are tokenized."""
        if len(self.words) + len(words) > self.limit:
            self._forget()
        known = len(self.words)
        out = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        new = [words[k] for k in np.flatnonzero(out >= known).tolist()]
        if new:
            some = [self._ids(new[i:i + AT_ONCE]) for i in range(0, len(new), AT_ONCE)]
            size = np.concatenate([s for _, s in some])
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, *[ids for ids, _ in some]])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.uses[out] += 1
        return out

    def _forget(self) -> None:
        """Keep the words in most use."""
        kept = min(KEPT, self.limit // 3)
        keep = np.sort(np.argsort(-self.uses, kind="stable")[:kept])
        keep = keep[self.uses[keep] > 1]
        names = list(self.words)
        self.words = numbered([names[k] for k in keep.tolist()])
        self.flat, self.size = gather(self.flat, self.at[keep], self.size[keep])
        self.at = np.cumsum(self.size) - self.size
        self.uses = self.uses[keep] // 2

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text) of texts that lie in ``data`` at ``offsets``."""
        start, end, row = word_spans(data, offsets)
        raw = data.tobytes()
        odd = [i for i in range(len(offsets) - 1)
               if any(s in raw[offsets[i]:offsets[i + 1]] for s in self.special)] if any(s in raw for s in self.special) else []
        if odd:
            keep = ~np.isin(row, odd)
            start, end, row = start[keep], end[keep], row[keep]
        data, start, end, row = latin_parts(data, start, end, row)
        coded = words_of(data, start, end).dictionary_encode()
        number = self.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        ids, size = gather(self.flat, self.at[number], self.size[number])
        per_text = np.bincount(row, weights=size, minlength=len(offsets) - 1).astype(np.int64)
        if odd:
            cut = np.cumsum(per_text)[odd]
            extra = [self.whole.encode(raw[offsets[i]:offsets[i + 1]].decode(), add_special_tokens=False).ids for i in odd]
            ids = np.insert(ids, np.repeat(cut, [len(x) for x in extra]), [i for x in extra for i in x])
            per_text[odd] = [len(x) for x in extra]
        return ids, per_text


def numbered(names: Iterable[str] = ()) -> defaultdict[str, int]:
    """The numbers of ``names`` in order; a name that is asked for gets the next one."""
    known = {name: k for k, name in enumerate(names)}
    return defaultdict(count(len(known)).__next__, known)


def latin_parts(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """(data, start, end, row): words of printable Latin-1 lower-cased and cut as ``_PARTS`` cuts them, other words whole and as they are."""
    if not len(start):
        return data, start, end, row
    low = _LOWER[data]
    kind = _ASCII[data]
    lead = np.flatnonzero((data == 0xC2) | (data == 0xC3))  # these have one byte behind them
    code = (data[lead] & 3) * np.uint8(64) + data[lead + 1] - np.uint8(128)
    low[lead + 1] += _CASE[code]
    kind[lead] = kind[lead + 1] = _CLASS[code]
    strange = np.concatenate([[0], np.cumsum(kind == 0)])
    odd = np.flatnonzero(strange[end] != strange[start])
    at, _ = gather(np.arange(len(data)), start[odd], end[odd] - start[odd])
    low[at], kind[at] = data[at], 4
    first = np.zeros(len(data) + 3, bool)  # does a part start here?
    first[1:len(data)] = (kind[1:] != kind[:-1]) | ((kind[1:] == 2) & (data[1:] & 0xC0 != 0x80))
    inside = np.zeros(len(data) + 1, np.int8)  # white space is in no word; a word may end where another text starts
    inside[start] += 1
    inside[end] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    first[:len(data)] &= inside
    first[start] = True
    # 's 't 'm 'd 're 've 'll where the apostrophe starts a part
    quote = np.flatnonzero((low == 39) & (kind == 3) & first[:len(data)])
    if len(quote):
        stop = end[np.searchsorted(start, quote, side="right") - 1]
        a, b = (np.where(quote + k < stop, low[np.minimum(quote + k, len(low) - 1)], 0) for k in (1, 2))
        size = np.where(np.isin(a, [115, 116, 109, 100]), 1, 0)
        size[((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)] = 2
        quote, stop, size = quote[size > 0], stop[size > 0], size[size > 0]
        first[quote + 1] = False
        after = quote + 1 + size
        first[after[after < stop]] = True
    part = np.flatnonzero(first)
    word = np.searchsorted(start, part, side="right") - 1
    return low, part, np.minimum(np.append(part[1:], len(data)), end[word]), row[word]


def words_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of ``data`` as strings."""
    size = end - start
    flat, _ = gather(data, start, size)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(flat))


def gather(values: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[at:at + size]`` one after another, and their sizes."""
    first = np.cumsum(size) - size
    place = np.repeat(at - first, size)
    place += np.arange(len(place))
    return values[place], size


def piece_lengths(n: int, max_length: int) -> list[int]:
    """``n`` as multiples of ``max_length`` (a power of two), then its lower binary digits."""
    return cut(np.array([n]), max_length)[1].tolist()


def cut(total: np.ndarray, max_length: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, length) of the pieces of documents with ``total`` tokens, in the documents' order, longest first."""
    doc = np.arange(len(total))
    docs, lengths, p = [np.repeat(doc, total // max_length)], [], max_length >> 1
    lengths.append(np.full(len(docs[0]), max_length, np.int64))
    while p:
        on = doc[total & p > 0]
        docs.append(on)
        lengths.append(np.full(len(on), p, np.int64))
        p >>= 1
    docs, lengths = np.concatenate(docs), np.concatenate(lengths)
    order = np.argsort(docs, kind="stable")
    return docs[order], lengths[order]


def _pack(path: str, end_id: int, max_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = None
        for b in batches:
            tok = tok or WordTokenizer(path)
            for a, z, data, offsets in text_slices(b.column(1), SLICE):
                ids, per_text = tok.batch(data, offsets)
                ids = np.insert(ids, np.cumsum(per_text), end_id).astype("<u4")
                total = per_text + 1
                doc, length = cut(total, max_length)
                at = np.cumsum(length) - length
                begin = (np.cumsum(total) - total)[doc]
                stops = np.append(at, len(ids)) * 4
                binary = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(length), [None, pa.py_buffer(stops), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a).take(pa.array(doc)), pa.array(at - begin), pa.array(length), binary,
                     pa.array(total[doc])], names=["doc_id", "start", "length", "ids", "doc_tokens"])

    return run


def pack_power_of_two(docs: DataFrame, tokenizer_path: str, end_id: int = 1,
                      max_length: int = 2048) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text): doc_id, start, length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (0). The
    sequence id is unique in the result; it needs no counting pass."""
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    ship_by_value(__name__)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = out.mapInArrow(_pack(tokenizer_path, end_id, max_length), PIECES)
    return out.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length."""
    pieces.withColumn("bucket", F.col("length")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def digest_rows(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
