"""Secrets in texts: fixed token shapes, and values in credential context that are hard to guess.

Three shapes are found as they stand (``assign``, ``access``, ``hex``). Beyond them, the
value that follows a credential word (``password is ...``, ``pwd: ...``, ``API key = ...``)
is judged by what it would cost to guess. A value is cut into words, dates,
repeats, keyboard walks and brute-force characters; every span has a price (log10 of
guesses), and dynamic programming over the end positions finds the cheapest cut. What
costs at least ``min_cost`` is reported as kind ``guess``; prose after a credential
word, references and placeholders are cheap and are not.

Word prices are ranks in the corpus' own frequency list: words between white space
(punctuation at their ends aside) counted over all texts, credential values left out,
so that a secret does not make itself cheap. The list has at most ``MAX_WORDS`` words of
at most ``WORD_CHARS`` letters, a proven bound, so it is sent to the tasks.

One pass reads the texts; it writes the shapes, the credential values and the task's word
counts to a table in the shared folder. Values are judged in a second pass over that
small table. Texts are searched whole; memory is one batch of texts, and the prices
of a value of n characters take time proportional to n.

Positions are code points. Spans of kind ``guess`` cover the value; one that lies inside
a span of a fixed shape adds nothing and is left out.

Defined results: a null or empty text has no spans, a null doc_id stays null, repeated
rows are each searched, other columns are not read, an empty table gives an empty one."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.shipping import ship_by_value
from eventlake.llm.common import reliable
from eventlake.llm.hashing import text_slices
from eventlake.session import scratch_path

# The shapes, in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex")
GUESS = "guess"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: a credential word, something that says "is", and the value up to white space, a quote or a bracket
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_\x20-]?key|access[_\x20-]?key|private[_\x20-]?key"""
    r"""|client[_\x20-]?secret|credentials?|login)s?["'`]?(?:\x20*(?::=|=>|=|:)\x20*|\x20+(?:is|was)\x20+)["'`]?([^\s"'`<>,;]+)""",
    re.ASCII | re.IGNORECASE)
#: calls, variables and addresses are references, not values
REFERENCE = re.compile(r"[\w.]+\(.*|\$\{?\w+\}?|\{\{.*|%\w*%|[a-z]+://[^@]*|[*•x_.#-]+", re.ASCII | re.IGNORECASE)
_ENDS = ".,;:!?)]}"

MAX_WORDS, WORD_CHARS = 50_000, 24
MIN_COST = 9.0  # log10 of guesses
SWITCH = 0.3  # a further span: one bit

WORD = re.compile(r"(?<!\S)[\"'(\[]*([A-Za-zÀ-ÖØ-öø-ÿ]{3,%d})[\"')\].,;:!?]*(?!\S)" % WORD_CHARS)

# Rows of keys as they lie on keyboards, and the alphabet.
LAYOUTS = (("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"),
           ("^1234567890ß´", "qwertzuiopü+", "asdfghjklöä#", "yxcvbnm,.-"),
           ("²&é\"'(-è_çà)=", "azertyuiop^$", "qsdfghjklmù*", "wxcvbn,;:!"),
           ("789", "456", "123", "0"),
           ("abcdefghijklmnopqrstuvwxyz",))
SHIFTED = dict(zip("~!@#$%^&*()_+{}|:\"<>?", "`1234567890-=[]\\;',./"))
LEET = dict(zip("4@8361!|05$7+2", "aabegiiioosstz"))
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:1[0-2]|0?[1-9])\1(?:[12]\d|3[01]|0?[1-9])"
                  r"|(?:[12]\d|3[01]|0?[1-9])([-/._]?)(?:1[0-2]|0?[1-9])\2(?:(?:19|20)?\d\d)"
                  r"|(?:1[0-2]|0?[1-9])([-/._])(?:[12]\d|3[01]|0?[1-9])\3(?:(?:19|20)?\d\d))")
YEAR = re.compile(r"(?:19|20)\d\d")
YEARS, DAYS = 120, 366
REPEAT, WALK = 32, 64  # longest repeated block and walk; longer ones are several spans


def neighbours() -> set[tuple[str, str]]:
    """Pairs of keys side by side on a layout, in a row or between rows."""
    out = set()
    for rows in LAYOUTS:
        for y, row in enumerate(rows):
            for x, c in enumerate(row):
                for dy, dx in ((0, 1), (1, 0), (1, -1), (1, 1)):
                    if y + dy < len(rows) and 0 <= x + dx < len(rows[y + dy]):
                        d = rows[y + dy][x + dx]
                        out |= {(c, d), (d, c)}
    return out


def _single(c: str) -> float:
    """Price of one character by brute force: log10 of the size of its class."""
    if c.islower() and c.isascii() or c.isupper() and c.isascii():
        return math.log10(26)
    if c.isdigit():
        return 1.0
    return math.log10(33) if c.isascii() else 2.0


class GuessCost:
    """Prices of values for a ranked word list (word -> rank from 1)."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks, self.adjacent = ranks, neighbours()
        self.longest = max(map(len, ranks), default=0)

    def word(self, s: str) -> float:
        """A word of the list, perhaps with capitals or look-alike characters."""
        low = s.lower()
        plain = "".join(LEET.get(c, c) for c in low)
        rank = self.ranks.get(low)
        extra = 0.0
        if rank is None and plain != low:
            rank, extra = self.ranks.get(plain), 0.5 * sum(a != b for a, b in zip(low, plain))
        if rank is None:
            return math.inf
        upper = sum(c.isupper() for c in s)
        if upper:
            extra += math.log10(2) if upper == len(s) or upper == 1 and s[0].isupper() else math.log10(math.comb(len(s), upper) + 1)
        return math.log10(rank + 1) + extra

    def spans(self, value: str) -> Iterator[tuple[int, int, float, str]]:
        """All spans (start, end, price, sort) of ``value`` that are cheaper to name than to try."""
        n = len(value)
        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                if (price := self.word(value[i:j])) < math.inf:
                    yield i, j, price, "word"
            if value[i].isdigit():
                for pattern, price in ((DATE, math.log10(YEARS * DAYS)), (YEAR, math.log10(YEARS))):
                    if m := pattern.match(value, i):
                        yield i, m.end(), price + (0.0 if m.group().isdigit() else 0.6), "date"
        key = "".join(SHIFTED.get(c, c) for c in value.lower())
        way = [ord(b) - ord(a) if (a, b) in self.adjacent else None for a, b in zip(key, key[1:])]
        turns = [0, *[int(a != b) for a, b in zip(way, way[1:])]]
        for i in range(n - 2):
            bent = 0
            for j in range(i + 1, min(n, i + WALK)):
                if way[j - 1] is None:
                    break
                bent += turns[j - 1] if j > i + 1 else 0
                if j > i + 1:
                    yield i, j + 1, math.log10(47) + math.log10(j + 1 - i) + 0.7 * bent, "walk"
        for p in range(1, min(REPEAT, n // 2) + 1):
            same = 0
            for j in range(p, n):
                same = same + 1 if value[j] == value[j - p] else 0
                copies = same // p
                if copies and p * (copies + 1) >= 3:
                    i = j + 1 - p * (copies + 1)
                    block = sum(map(_single, value[i:i + p]))
                    if 2 < p <= self.longest:
                        block = min(block, self.word(value[i:i + p]))
                    yield i, j + 1, block + math.log10(copies + 1), "repeat"

    def cheapest(self, value: str) -> tuple[float, list[tuple[str, int, int]]]:
        """(log10 of guesses, spans (sort, start, end)) of the cheapest cut. A further span
        costs ``SWITCH``; characters by brute force next to each other are one span."""
        n = len(value)
        ends: list[list[tuple[int, float, str]]] = [[] for _ in range(n + 1)]
        for i, j, price, sort in self.spans(value):
            ends[j].append((i, price, sort))
        # cheapest cut of value[:j] whose last span is by brute force, or named; where and what it is
        tried: list[tuple[float, int]] = [(math.inf, 0)]
        named: list[tuple[float, int, str]] = [(0.0, 0, "")]
        best = lambda j: min(tried[j][0], named[j][0])
        for j in range(1, n + 1):
            price = _single(value[j - 1])
            begin = best(j - 1) + price + (SWITCH if j > 1 else 0.0)
            tried.append(min((tried[j - 1][0] + price, tried[j - 1][1]), (begin, j - 1)))
            named.append(min(((best(i) + price + (SWITCH if i else 0.0), i, sort) for i, price, sort in ends[j]),
                             default=(math.inf, 0, "")))
        out, j = [], n
        while j:
            sort, i = ("brute", tried[j][1]) if tried[j][0] <= named[j][0] else (named[j][2], named[j][1])
            out.append((sort, i, j))
            j = i
        return best(n), out[::-1]


def context_values(text: str) -> list[tuple[int, int]]:
    """Where the values in credential context stand."""
    out = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        while end > start and text[end - 1] in _ENDS:
            end -= 1
        if end - start >= 4 and not REFERENCE.fullmatch(text, start, end):
            out.append((start, end))
    return out


def shapes(text: str, assign: bool = True, access: bool = True, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed shapes, sorted."""
    out = []
    if assign:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if access:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if hexes:
        # runs are maximal, so long ones can be asked for at once
        out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]{%d,}" % LEAST["hex"], text)]
    return sorted(out)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_VALUE = pa.struct([("value", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
FOUND = ("row int, doc_id long, shapes array<struct<kind:string,start:long,end:long>>, "
         "values array<struct<value:string,start:long,end:long>>, word string, n long")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its shapes and credential values; per task the counts of words."""
    counts: dict[str, int] = {}
    schema = pa.schema([("row", pa.int32()), ("doc_id", pa.int64()), ("shapes", pa.list_(_SPAN)), ("values", pa.list_(_VALUE)),
                        ("word", pa.string()), ("n", pa.int64())])

    def words() -> pa.RecordBatch:
        n = len(counts)
        out = pa.RecordBatch.from_arrays(
            [pa.array([0] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(_SPAN)), pa.nulls(n, pa.list_(_VALUE)),
             pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)
        counts.clear()
        return out

    for b in batches:
        column = b.column(1).fill_null("")
        # a cheap search by arrays tells which texts the patterns need to see
        may = [pc.match_substring_regex(column, p).to_pylist() for p in
               ("(?i)pass|pwd|secret|token|key|credential|login", "AKIA[A-Z0-9]", "[0-9a-f]{%d}" % LEAST["hex"])]
        for i, j, _, _ in text_slices(column):
            found, values = [], []
            for k in range(i, j):
                text = column[k].as_py()
                found.append([{"kind": KINDS[kind], "start": s, "end": e} for s, kind, e in shapes(text, *(m[k] for m in may))]
                             if may[0][k] or may[1][k] or may[2][k] else [])
                spans = context_values(text) if may[0][k] else []
                values.append([{"value": text[s:e], "start": s, "end": e} for s, e in spans])
                at = 0
                for s, e in [*spans, (len(text), 0)]:  # the text without its credential values
                    for w in WORD.findall(text[at:s].lower() if spans else text.lower()):
                        counts[w] = counts.get(w, 0) + 1
                    at = e
            n = j - i
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * n, pa.int32()), b.column(0).slice(i, n), pa.array(found, pa.list_(_SPAN)),
                 pa.array(values, pa.list_(_VALUE)), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], schema=schema)
            if len(counts) > 1_000_000:
                yield words()
    if counts:
        yield words()


def _judged(shared, min_cost: float):
    """The spans of a row: its shapes, and its values that are hard to guess."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, known = GuessCost(shared.value), {}
        order = {k: i for i, k in enumerate((*KINDS, GUESS))}
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]))
        for b in batches:
            out = []
            for fixed, values in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                spans = [dict(s, cost=None) for s in fixed or ()]
                for v in values or ():
                    if any(s["start"] <= v["start"] and v["end"] <= s["end"] for s in fixed or ()):
                        continue
                    cost = known.get(v["value"])
                    if cost is None:
                        if len(known) > 100_000:
                            known.clear()
                        cost = known[v["value"]] = judge.cheapest(v["value"])[0]
                    if cost >= min_cost:
                        spans.append({"kind": GUESS, "start": v["start"], "end": v["end"], "cost": cost})
                out.append(sorted(spans, key=lambda s: (s["start"], order[s["kind"]])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, span)], names=["doc_id", "spans"])

    return run


def word_ranks(counts: DataFrame, most: int = MAX_WORDS) -> dict[str, int]:
    """word -> rank of the most frequent words in ``counts`` (word, n): all words of the classes of
    frequency (sixteenths of an octave) that fit into ``most`` words as a whole."""
    total = reliable(counts.groupBy("word").agg(F.sum("n").alias("n")))
    total = total.withColumn("class", F.floor(16 * F.log2("n")))
    least, room = None, most
    for r in sorted(total.groupBy("class").count().collect(), reverse=True):  # some hundred classes
        if r["count"] > room:
            break
        least, room = r["class"], room - r["count"]
    if least is None:
        return {}
    top = total.where(F.col("class") >= least).select("word", "n").collect()  # at most ``most`` rows
    return {r["word"]: k for k, r in enumerate(sorted(top, key=lambda r: (-r["n"], r["word"])), 1)}


def find_secrets(docs: DataFrame, min_cost: float = MIN_COST, most_words: int = MAX_WORDS) -> DataFrame:
    """doc_id and spans (kind, start, end, cost; sorted) of every row of ``docs`` (doc_id, text)."""
    ship_by_value(__name__)
    spark = docs.sparkSession
    path = scratch_path(spark, "secrets")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
     .mapInArrow(_found, FOUND).write.partitionBy("row").parquet(path))
    found = spark.read.schema(FOUND).parquet(path)
    shared = spark.sparkContext.broadcast(word_ranks(found.where("row = 0").select("word", "n"), most_words))
    return found.where("row = 1").select("doc_id", "shapes", "values").mapInArrow(
        _judged(shared, min_cost), "doc_id long, spans array<struct<kind:string,start:long,end:long,cost:double>>")


def span_list(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest_rows(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind> of the fixed shapes, base_sha256 of their list, and the list of all spans."""
    base = F.filter("spans", lambda s: s["kind"] != GUESS)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(span_list(base), 256).alias("base_sha256"),
                        span_list(F.col("spans")).alias("spans"))
