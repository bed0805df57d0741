"""Cross-tokenizer alignment (13) against a brute-force version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from eventlake.llm import token_align
from tests.llm.conftest import DOCS

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def spelled(sides, text):
    """Tokens (id, start, end) of both sides by encoding the whole text; None where they do not spell it."""
    import sentencepiece
    from tokenizers import Tokenizer
    if not sides:
        a = Tokenizer.from_file(A)
        a.encode_special_tokens = True
        sides += [a, sentencepiece.SentencePieceProcessor(model_file=B)]
    if not text:
        return None
    alphabet = token_align.byte_alphabet()
    ids = sides[0].encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(alphabet[c] for c in sides[0].id_to_token(i))) for i in ids]
    right = []
    for i in sides[1].encode(text):
        p = sides[1].id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if sides[1].is_byte(i) else p.replace("▁", " ").encode()))
    if not b"".join(x for _, x in left) == b"".join(x for _, x in right) == (" " + text).encode():
        return None
    out = []
    for side in (left, right):
        at, toks = 0, []
        for i, x in side:
            toks.append((i, at, at + len(x)))
            at += len(x)
        out.append(toks)
    return out


def brute(rows):
    sides, held, per = [], Counter(), []
    for doc, text in rows:
        got = spelled(sides, text)
        if got is None:
            per.append((doc, 0, 0, 0, [], ""))
            continue
        a, b = got
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, lo = [], 0
        for e in ends:
            groups.append(",".join(str(x[0]) for x in a if lo < x[2] <= e) + "|" + ",".join(str(y[0]) for y in b if lo < y[2] <= e))
            lo = e
        held.update(set(links))
        per.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return Counter((doc, na, nb, ng, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha)
                   for doc, na, nb, ng, links, sha in per)


TEXTS = ["Hello world, tokenization isn't trivial.", "Hello world", "naïve café ① ﬁ — “quotes” 中文字 🙂🙂", "", None, "▁x", " ",
         "  lead and  double\tTab\n\nnew\r\nline;\r\n end ", "a   b  c　", "<|endoftext|> <s> </s> <unk> <0x41> x<s>y", "x\x00y \x1c z",
         "é combining ​ zero ﻿", "é", "� \U0010ffff", "1234567890 12.5% $x_1 == {y}", "\n", "\r", "\t\tx", "word\r next", "a\x85 b"]


def got(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


@pytest.mark.parametrize("at_once", [token_align.PAIRS_AT_ONCE, 40])
def test_digests_equal_brute_force(spark, at_once):
    rows = [*enumerate(TEXTS), (3, "Hello world"), (None, "Hello world"), (None, None), (90, "long word " * 400)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], DOCS + ", n_a string, row int").repartition(3)
    assert got(token_align.alignment_digests(docs, A, B, at_once)) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 7 = 0 and length(text) < 3000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(token_align.alignment_digests(docs, A, B)) == brute(rows)


def test_links_are_overlapping_tokens(spark):
    docs = spark.createDataFrame([(1, TEXTS[2]), (2, None), (3, TEXTS[7])], DOCS)
    out = {r.doc_id: r for r in token_align.token_links(docs, A, B).collect()}
    assert out[2].a_ids == [] and out[2].link_a == []
    for d in (1, 3):
        a, b = spelled([], docs.where(f"doc_id = {d}").first().text)
        r = out[d]
        assert r.a_ids == [x[0] for x in a] and r.b_ids == [x[0] for x in b]
        assert set(zip(r.link_a, r.link_b)) == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]}
        assert len(r.link_a) == len(set(zip(r.link_a, r.link_b))) and max(r.a_group) == max(r.b_group)


def test_empty_table(spark, no_docs):
    assert token_align.alignment_digests(no_docs, A, B).count() == 0


def _slice(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def test_new_words_are_tokenized_many_in_one_string(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéß中.,'9", k=rng.randint(1, 9))) + str(i) for i in range(2500)]
    texts = [" ".join(words[:1500]), "\n".join(words[1000:]) + "\t  ", "\r\n odd\u3000space ▁ end", "x\n\n  y \n", "", "plain x\x00y"]
    sides, given, aligned = token_align.Sides(A, B), [], []
    encode, linked = sides.encode, token_align.linked
    monkeypatch.setattr(sides, "encode", lambda some: (given.append(len(some)), encode(some))[1])
    monkeypatch.setattr(token_align, "linked", lambda *x: (aligned.append(len(x[1][0][1])), linked(*x))[1])
    number, doc = token_align.chunked(sides, *_slice(texts))
    assert sum(given) < 50 and len(number) > 2900  # 2500 words, not a string each
    before = sum(given), sum(aligned)
    again, _ = token_align.chunked(sides, *_slice(texts))
    assert again.tolist() == number.tolist() and (sum(given), sum(aligned)) == before
    # chunk by chunk the same as whole texts
    cache = []
    for d, t in enumerate(texts):
        mine, want = number[doc == d], spelled(cache, t)
        assert bool(len(mine)) == (want is not None)
        for runs, tokens in zip(sides.tokens, want or ([], [])):
            assert runs.of(mine)[0].tolist() == [x[0] for x in tokens]


def test_whole_texts_in_the_cache_are_bounded(monkeypatch):
    monkeypatch.setattr(token_align, "HELD", 60_000)
    sides, cache = token_align.Sides(A, B), []
    for k in range(6):  # texts with Unicode white space are chunks of their own, however long
        texts = [f"text {k} {j} with\u3000space " + "and more words " * 20 for j in range(20)] + ["the same words"]
        number, doc = token_align.chunked(sides, *_slice(texts))
        assert len(sides.known) <= 60
        for d in (0, 19, 20):
            for runs, tokens in zip(sides.tokens, spelled(cache, texts[d])):
                assert runs.of(number[doc == d])[0].tolist() == [x[0] for x in tokens]
