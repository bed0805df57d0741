"""Phrase collocations (12) against a brute-force version."""

import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventlake.llm import collocations
from eventlake.session import SHUFFLE_CLEANUP
from tests.llm.conftest import sentence

SCHEMA = "doc_id long, text string, lang string, rank int, score string"


def brute(rows, min_count=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = []
    for p, a in cand.items():
        lang, w = p[0], p[1:]
        if any(q[0] == lang and len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(w)] == w for i in range(1, len(q)))
               for q, b in cand.items()):
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])])
                             for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    at = Counter()
    return [(x[0], at[x[0]], *x[1:]) for x in out if not at.update([x[0]]) and at[x[0]] <= top]


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    common = ["new york city", "machine learning", "la la la", "été indien", "New\tYork", "a\x1cb c", "x\xa0y z", "😀 ok"]
    out = [(None, None), ("en", ""), ("en", " \t\n"), ("", "one two three"), (None, "null lang " * 12), ("de", "the the the the " * 30),
           ("en", "hot pair " * 3000), ("en", "Hot, pair: hot\npair\x0bhot\x0cpair\rhot pair")]
    for i in range(160):
        words = sentence(rng, rng.randint(5, 40)).split() + rng.choices(["of", "the", "in"], k=10)
        rng.shuffle(words)
        words.insert(rng.randrange(len(words)), rng.choice(common))
        words.insert(rng.randrange(len(words)), rng.choice([",", "...", "! ", "york city."]))
        out.append((rng.choice(["en", "en", "fr", None]), "  ".join(words)))
    return out + out[10:60]


@pytest.mark.parametrize("trie_bytes", [collocations.TRIE_BYTES, 700])
def test_equals_brute_force(spark, rows, trie_bytes):
    df = spark.createDataFrame([(i, t, lang, 1, "x") for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(5)
    assert got(collocations.collocations(df, trie_bytes=trie_bytes)) == brute(rows)


def test_low_support_and_cap(spark, rows):
    df = spark.createDataFrame([(i, t, lang, 1, "x") for i, (lang, t) in enumerate(rows[:60])], SCHEMA).repartition(2)
    assert got(collocations.collocations(df, min_count=2, top=20)) == brute(rows[:60], 2, 20)


def test_small_filter_never_loses_a_phrase(spark, rows, monkeypatch):
    # a saturated bit table lets more through, and the result stays
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 8)
    monkeypatch.setattr(collocations.Bits.__init__, "__defaults__", (1 << 8,))
    df = spark.createDataFrame([(i, t, lang, 1, "x") for i, (lang, t) in enumerate(rows[:90])], SCHEMA)
    assert got(collocations.collocations(df)) == brute(rows[:90])


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_trie_finds_its_keys():
    rng = random.Random(3)
    keys = sorted({bytes(rng.choices(b"abc \xc3\xa9\x00\xff", k=rng.randint(1, 9))) for _ in range(400)})
    offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    trie = collocations.Trie.of(np.frombuffer(b"".join(keys), np.uint8), offsets)
    assert [trie.accept[trie.walk(k)] for k in keys] == list(range(len(keys)))
    assert all(trie.walk(k + b"q") == -1 for k in keys)
    assert len(trie.base) < 256 * 2 + sum(len(k) for k in keys) * 60


def test_trie_of_phrases_has_few_empty_slots():
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlucmfwypvbgkjqxz", range(26, 0, -1), k=rng.randint(1, 8))) for _ in range(3000)]
    keys = sorted({b"en\xff" + " ".join(rng.choices(words, range(3000, 0, -1), k=rng.randint(1, 3))).encode() for _ in range(20000)})
    offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    trie = collocations.Trie.of(np.frombuffer(b"".join(keys), np.uint8), offsets)
    assert [trie.accept[trie.walk(k)] for k in keys] == list(range(len(keys)))
    states = len({k[:i] for k in keys for i in range(1, len(k) + 1)})
    assert (trie.check >= 0).sum() == states
    assert len(trie.base) < 1.6 * states + 1024


def test_counts_are_not_held_again_before_the_shuffle(spark, rows, monkeypatch):
    plans, reliable = [], collocations.reliable
    monkeypatch.setattr(collocations, "reliable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or reliable(df))
    texts = spark.createDataFrame([("en", t) for _, t in rows[:90]], "lang string, text string")
    assert collocations.candidates(texts, 10).count()
    counted = [p for p in plans if "sum(n" in p]
    assert len(counted) == 2
    assert not any("Aggregate" in p[p.index("Exchange"):] for p in counted)


def test_scores_beyond_64_bits(spark):
    big = 10**12
    counts = spark.createDataFrame([("x", "a", big), ("x", "b", big + 7), ("x", "a b", big - 3)], "lang string, phrase string, f long")
    r = collocations._scored(counts).first()
    assert r.score == 1_000_000 * (big - 3)**2 // (big * (big + 7))


def test_counting_holds_little_at_a_time():
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(500)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    tracemalloc.start()
    n = sum(sum(b.column(1).to_pylist()) for b in collocations._hash_counts([1, 2], None)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 3000 * (500 + 499)  # all occurrences, however often the task passes its counts on
    assert peak < 100e6


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return {f for f in files.split() if "/shuffle_" in f}


def test_done_steps_leave_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    rows = [("en", f"a b c{i % 3}. d e") for i in range(60)]
    out = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"))
    for _ in range(100):  # files go in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert got(out) == brute(rows)


def test_fingerprints_of_texts_are_one_byte():
    texts = [f"text {i} of some. words" for i in range(2000)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    prints = collocations.Pieces(np.frombuffer(b"".join(raw), np.uint8), offsets, pa.array(["en"] * len(texts))).text
    assert 0 <= prints.min() < 8 and 248 <= prints.max() < 256
