"""Top-k search (3), near-duplicates (4) and substring dedup (10)."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from eventlake.llm import chunk_dedup, near_dedup, topk
from eventlake.llm.components import connected_components
from tests.llm.conftest import DOCS, sentence


def brute_topk(rows, k, query):
    """Every row is a candidate, and a query if its id is one; results may repeat."""
    out = Counter()
    for i, (q, v) in enumerate(rows):
        if query(q):
            best = sorted((-int(np.dot(v, w)), c) for j, (c, w) in enumerate(rows) if j != i and len(w) == len(v))[:k]
            out.update((q, rank, c, -s) for rank, (s, c) in enumerate(best, 1))
    return out


def test_topk_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(230)]
    rows += [(i, rows[7][1]) for i in range(300, 330)] + [(i, [0.25] * 3) for i in range(400, 403)]
    rows += [(500, None), (501, [None] * 6), (502, [float("nan")] * 6), (None, [0.5] * 6), (503, [float("inf")] * 6), (50, rows[50][1])]
    rows += [(60, [rng.uniform(-1, 1) for _ in range(6)]) for _ in range(3)] + [(40, rows[40][1])] * 7  # ids that repeat
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = df.where(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), topk.quantized(F.col("embedding")).alias("v"))
    got = Counter(tuple(r) for r in topk.top_k(v, F.col("id") % 20 == 0, k=5, query_block=7, candidate_block=16)
                  .select("query_id", "rank", "vec_id", "score").collect())
    good = [(i, np.array([math.floor(256 * x) for x in e])) for i, e in rows
            if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    assert got == brute_topk(good, 5, lambda i: i % 20 == 0)


def test_topk_large_values_and_empty(spark):
    v = spark.createDataFrame([(0, [2**30, 1]), (1, [2**31, 5]), (2, [-(2**31), 0])], "id long, v array<long>")
    got = [tuple(r) for r in topk.top_k(v, F.col("id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**61 + 5), (0, 2, 2, -(2**61))]
    assert topk.top_k(v.limit(0), F.col("id") == 0).count() == 0


def shingles(t):
    w = (t or "").replace("\n", " ").replace("\t", " ").split(" ")
    w = [x for x in w if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute_classes(rows, t=0.8):
    s = [shingles(x) for _, x in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and len(s[i] & s[j]) >= t * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return {d: min(g) for g in groups.values() for d in g}


def mutated(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = sentence(rng, 1)
    return " ".join(out)


def test_classes_equal_brute_force(spark):
    rng = random.Random(2)
    rows, base = [], sentence(rng, 150).split()
    # independent changes of one text: many pairs lie on either side of the threshold
    rows += [(i, mutated(rng, base, rng.randint(0, 5))) for i in range(150)]
    rows += [(200 + i, " ".join(base)) for i in range(5)]
    rows += [(300 + i, sentence(rng, 40)) for i in range(80)]
    rows += [(400 + i, "three word text") for i in range(3)] + [(410, "three word texts")]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicate_classes(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute_classes(rows)


def test_repeated_blocks_do_not_hide_a_link(spark):
    rng, rows = random.Random(12), []
    for k in range(120):
        block, tail = sentence(rng, 50), sentence(rng, 54).split()
        rows.append((2 * k, f"{block} {' '.join(tail)}"))
        tail[25], tail[-4] = sentence(rng, 1), sentence(rng, 1)
        rows.append((2 * k + 1, f"{' '.join([block] * 60)} {' '.join(tail)}"))
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.8 <= len(a & b) / len(a | b) < 0.82
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicate_classes(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute_classes(rows)


def test_bucket_rest_finds_links_that_no_pivot_has(spark):
    # a pivot far from two texts that are near each other, all in one bucket
    def node(i, comp, elements):
        return {"node": i, "comp": comp, "bands": [7, i], "sh": np.sort(np.array(elements, np.uint64)).tobytes()}
    left = [node(2, 2, range(100)), node(4, 4, range(500, 600))]
    right = [node(2, 2, range(100)), node(3, 3, range(5, 105)), node(5, 5, range(5, 104)), node(4, 4, range(500, 600))]
    assert near_dedup.block_links(left, right, 7, 0.8) == [(2, 3), (2, 5)]
    assert near_dedup.block_links(left, right, 8, 0.8) == []


def test_prob_min_hash_estimates_probability_jaccard():
    rng = np.random.default_rng(0)
    x = {int(e): w for e, w in zip(range(60), rng.uniform(1, 3, 60))}
    y = {e: w for e, w in [*list(x.items())[:40], *[(100 + i, 1.5) for i in range(15)]]}
    x_only = dict(x)
    true = sum(1 / sum(max(x.get(d, 0) / x[e], y.get(d, 0) / y[e]) for d in {*x, *y}) for e in x if e in y)
    el = np.array([*x_only, *y], np.uint64)
    sig = near_dedup.prob_min_hash(el, np.array([*x_only.values(), *y.values()]), np.repeat([0, 1], [len(x), len(y)]), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.04


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (202, 201)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}


def test_near_dedup_odd_rows(spark, odd_docs, no_docs):
    rows = near_dedup.near_duplicate_classes(odd_docs).collect()
    assert len(rows) == 10
    by = Counter((r.doc_id, r.class_id) for r in rows)
    assert by[5, 5] == 1 and by[6, 5] == 1 and by[7, 7] == 2 and by[2, 2] == 1 and by[3, 3] == 1
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7]
    assert near_dedup.near_duplicate_classes(no_docs).count() == 0 and near_dedup.keep_one(no_docs).count() == 0


def test_repeated_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(4)
    rows = []
    for k in range(60):
        passage = sentence(rng, 51 + k % 20)
        for j in range(2):
            rows.append((2 * k + j, f"{sentence(rng, rng.randint(5, 90))} {passage} {sentence(rng, rng.randint(5, 90))}"))
    clean = [(1000 + k, sentence(rng, 200)) for k in range(60)]
    df = spark.createDataFrame(rows + clean, DOCS)
    spans = chunk_dedup.repeated_spans(df)
    got = spans.collect()
    assert {r.doc_id for r in got} == {d for d, _ in rows}
    assert all(r.kept == (r.doc_id % 2 == 0) and r.first_doc_id == r.doc_id // 2 * 2 for r in got)
    texts = dict(rows)
    for r in got:
        span = texts[r.doc_id].encode()[r.start:r.start + r.length].decode()
        assert len(span.split()) == r.words and span in texts[r.first_doc_id]
    left = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(df, spans).collect()}
    for d, t in rows + clean:
        want = t.encode()
        for r in sorted((r for r in got if r.doc_id == d and not r.kept), key=lambda r: -r.start):
            want = want[:r.start] + want[r.start + r.length:]
        assert left[d] == want.decode()


def test_first_document_of_a_whole_passage_keeps_all_of_it(spark):
    rng = random.Random(21)
    for _ in range(4):
        passage = sentence(rng, 80).split()
        own = lambda n: sentence(rng, n)
        texts = {1: f"{own(30)} {' '.join(passage[30:50])} {own(30)}", 5: f"{own(40)} {' '.join(passage)} {own(40)}",
                 9: f"{own(20)} {' '.join(passage)} {own(20)}", 12: own(200)}
        df = spark.createDataFrame(list(texts.items()), DOCS)
        spans = chunk_dedup.repeated_spans(df)
        left = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(df, spans).collect()}
        assert all(left[d] == texts[d] for d in (1, 5, 12))
        cut = set(texts[9].split()) - set(left[9].split())
        assert len(set(passage) & cut) >= 60 and not cut - set(passage)


def test_passage_twice_in_one_document(spark):
    rng = random.Random(22)
    passage, between = sentence(rng, 60), sentence(rng, 50)
    text = f"{sentence(rng, 20)} {passage} {between} {passage} {sentence(rng, 20)}"
    df = spark.createDataFrame([(3, text), (4, sentence(rng, 150))], DOCS)
    spans = chunk_dedup.repeated_spans(df)
    assert {(r.doc_id, r.kept) for r in spans.collect()} == {(3, True), (3, False)}
    left = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(df, spans).collect()}
    assert left[3].startswith(text[:text.index(passage) + len(passage) + len(between)]) and left[3].count(passage) == 1


def brute_repeats(texts, n):
    """Word n-grams that stand at more than one place, with their places (document, word number)."""
    at = {}
    for d, t in texts.items():
        w = t.split()
        for i in range(len(w) - n + 1):
            at.setdefault(tuple(w[i:i + n]), []).append((d, i))
    return {g: p for g, p in at.items() if len(p) > 1}


def test_against_brute_force(spark):
    """Every passage of 51 words that stands twice is caught behind its first place but for its edges, every
    passage stays somewhere, and words outside repeats of 10 words stay."""
    rng = random.Random(23)
    shared = [sentence(rng, rng.randint(51, 140)) for _ in range(25)]
    texts = {d: " ".join(rng.choice([rng.choice(shared), sentence(rng, rng.randint(20, 90))]) for _ in range(rng.randint(1, 5))) for d in range(90)}
    df = spark.createDataFrame(list(texts.items()), DOCS)
    spans = chunk_dedup.repeated_spans(df)
    gone = {d: set() for d in texts}
    for r in spans.collect():
        if not r.kept:
            first = len(texts[r.doc_id].encode()[:r.start].decode().split())
            gone[r.doc_id] |= set(range(first, first + r.words))
    long, short = brute_repeats(texts, 51), brute_repeats(texts, 10)
    for g, places in long.items():
        for d, i in sorted(places)[1:]:
            assert len(gone[d] & set(range(i + 8, i + 43))) >= 25, (d, i)
    covered = {d: set() for d in texts}
    for g, places in short.items():
        for d, i in places:
            covered[d] |= set(range(i, i + 10))
    assert all(gone[d] <= covered[d] for d in texts)
    left = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(df, spans).collect()}
    assert all(any(p in t for t in left.values()) for p in shared if any(p in t for t in texts.values()))


def test_cuts_follow_the_content():
    rng = random.Random(6)
    body = sentence(rng, 400).encode()

    def digests(b):
        data = np.frombuffer(b, np.uint8)
        return chunk_dedup.chunks_of(data, np.array([0, len(data)]))[4]

    a, b = digests(body), digests(b"a few words more " + body)
    assert len(set(a) - set(b)) <= 2 and 20 < len(body) / len(a) < 60
    # neighbours in a batch do not matter
    two = np.frombuffer(body + body, np.uint8)
    row = chunk_dedup.chunks_of(two, np.array([0, len(body), 2 * len(body)]))
    assert (row[4][row[2] == 1] == a).all()
    # short periods are cut at a bounded length
    data = np.frombuffer(b"to " * 50_000, np.uint8)
    start, end, *_ = chunk_dedup.chunks_of(data, np.array([0, len(data)]))
    assert (end - start).max() <= 2 * chunk_dedup.LONGEST + 3


def test_chunk_dedup_odd_rows(spark, odd_docs, no_docs):
    rows = chunk_dedup.repeated_spans(odd_docs).collect()
    # 5 and 6 are one word all over: the first place stays, the rest repeats it
    assert {r.doc_id for r in rows} == {5, 6} and [r.kept for r in rows if r.doc_id == 5 and r.start == 0] == [True]
    assert {r.kept for r in rows if r.doc_id == 6} == {False}
    out = chunk_dedup.remove_repeats(odd_docs, chunk_dedup.repeated_spans(odd_docs))
    assert out.columns == odd_docs.columns and out.count() == 10
    assert chunk_dedup.repeated_spans(no_docs).count() == 0
