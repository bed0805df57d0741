"""Toxicity (5), packing (6), mixing (8) and page text (9)."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import html_template, mixing, packing, toxicity
from tests.llm.conftest import DOCS, sentence

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def labelled(spark, n=900):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        toxic, low = i % 5 == 0, i % 7 == 0
        words = sentence(rng, rng.randint(30, 120)).split()
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["grumble", "snarl", "hissing"])
        if low:
            words = [w + "!!" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not low), int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


CATEGORIES = {"low": "quality = 0", "toxic": "toxic = 1"}


def test_chain_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    chain = toxicity.train(docs, labels.where("doc_id < 500"), CATEGORIES)
    rows = [r for r in toxicity.score(docs, chain).collect() if r.doc_id >= 500]
    assert np.mean([r.toxic == (r.doc_id % 5 == 0) for r in rows]) > 0.97
    assert np.mean([r.low == (r.doc_id % 7 == 0) for r in rows]) > 0.97


def test_chain_feeds_earlier_probabilities(spark):
    # the second category is the first one where the text says nothing: only the chain can tell it
    docs, labels = labelled(spark, 400)
    chain = toxicity.train(docs, labels, {"toxic": F.col("toxic") == 1, "again": F.col("toxic") == 1})
    assert len(chain.models[1].dense) == len(chain.models[0].dense) + 1
    assert chain.models[1].dense[-1] > 0.5


def test_chain_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.train(odd_docs, none, CATEGORIES)
    rows = toxicity.score(odd_docs, chain).collect()
    assert len(rows) == 10 and all(r.p_toxic == 0.0 and not r.toxic for r in rows)
    odd = spark.createDataFrame([(1, 1, None), (5, 1, 1), (5, 1, 0), (None, 1, 1), (77, 0, 1)], none.schema)
    assert toxicity.score(odd_docs, toxicity.train(odd_docs, odd, CATEGORIES)).count() == 10
    assert toxicity.score(no_docs, chain).count() == 0


def test_pieces_are_the_tokenizer_s_ids(spark, odd_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)  # with its defaults: special tokens written out in a text become their ids
    texts = ["a <|endoftext|><|startoftext|> b<|endoftext|>", "plain one", "x <|ENDOFTEXT|> <| y", "It's NOT 12½ µm; İstanbul ΣΑΣ ς x y été <|endoftext|> 中文字 a\x1cb \x85c d­ 'S 's", "…“quoted”—dash", "",
             "word " * 3000, "über straße\nnaïve\tçà\r\nfin"]
    df = spark.createDataFrame(list(enumerate(texts, 100)), DOCS).unionByName(odd_docs.select("doc_id", "text").where("doc_id < 7"))
    rows = packing.pack_power_of_two(df, WORDS).collect()
    want = {r.doc_id: np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in df.collect()}
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(want) and len({r.sequence_id for r in rows}) == len(rows)
    for d, pieces in by.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length <= 2048 and r.length & (r.length - 1) == 0 and r.offset == 0
            assert bytes(r.ids) == want[d][at:at + r.length].tobytes() and r.doc_tokens == len(want[d])
            at += r.length
        assert at == len(want[d])
    digest = packing.digest_rows(packing.pack_power_of_two(df, WORDS)).where("doc_id = 2").first()
    assert digest.ids_crc32 == zlib.crc32(np.array([1], "<u4").tobytes())


def _slice_of(words):
    raw = " ".join(words).encode()
    return np.frombuffer(raw, np.uint8), np.array([0, len(raw)])


def test_tokenizer_caches_stay_small_and_right():
    tok = packing.WordTokenizer(WORDS, cache_words=60)
    whole = tok.whole
    for k in range(12):  # the cache runs over again and again; words of every slice stay
        words = ["the", "The", "cat's", "naïve", "日本", "x²", "don't!"] + [f"w{k}q{j}" for j in range(k, 50)]
        ids, per_text = tok.batch(*_slice_of(words))
        assert ids.tolist() == whole.encode(" ".join(words), add_special_tokens=False).ids and per_text.tolist() == [len(ids)]
        assert len(tok.words) <= 120 and len(tok.parts) <= 60
    assert "the" in tok.words
    rng = random.Random(3)
    tok = packing.WordTokenizer(WORDS)
    slices = [_slice_of(["".join(rng.choices("abcdefghij", k=9)) for _ in range(60_000)]) for _ in range(8)]
    tracemalloc.start()
    for s in slices:
        tok.batch(*s)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tok.words) <= packing.CACHE and len(tok.parts) <= packing.CACHE
    assert peak < 120e6


def test_new_words_are_taken_apart_many_at_once(monkeypatch):
    class Counted:
        calls = 0

        def __init__(self, pattern):
            self.pattern = pattern

        def __getattr__(self, name):
            Counted.calls += 1
            return getattr(self.pattern, name)

    rng = random.Random(8)
    latin = ["".join(rng.choices("abcXYZàÉßµ12½.,'-st", k=rng.randint(1, 9))) for _ in range(3000)]
    mixed = [w + rng.choice(["", "", "中", "İ", "\x1c", "\xad", "e\u0301"]) for w in latin[:300]]
    tok = packing.WordTokenizer(WORDS)
    monkeypatch.setattr(packing, "_PARTS", Counted(packing._PARTS))
    for words in (latin, mixed, ["it's", "I'LL", "'", "x'", "s'"]):
        ids, per_text = tok.batch(*_slice_of(words))
        assert ids.tolist() == tok.whole.encode(" ".join(words), add_special_tokens=False).ids and per_text.tolist() == [len(ids)]
    assert Counted.calls < 10  # 3000 words, not a call each
    ids, _ = packing.WordTokenizer(WORDS, cache_words=20).batch(*_slice_of(latin))  # the parts run over
    assert ids.tolist() == tok.whole.encode(" ".join(latin), add_special_tokens=False).ids


def test_parts_are_tokenized_once_in_all_their_words():
    tok = packing.WordTokenizer(WORDS)
    words = [w + mark for w in ("the", "The", "THE", "naïve", "NAÏVE", "12½", "x'", "it's", "'suns", "a''s", "'Ré", "'rest", "h\u0331", "H\u0331", "\xa0c", "ΣΑΣ")
             for mark in ("", ",", ".", "!!", "'LL", "'s't", "-the")]
    ids, per_text = tok.batch(*_slice_of(words))
    assert ids.tolist() == tok.whole.encode(" ".join(words), add_special_tokens=False).ids and per_text.tolist() == [len(ids)]
    plain = [w for w in tok.words if packing._PLAIN.fullmatch(w)]
    assert all(packing._PARTS.fullmatch(w) and w == w.lower() for w in plain)  # no capitals, no punctuation but on its own
    assert len(plain) < 30  # of 84 different words


def test_parts_end_with_their_text():
    texts = ["it'", "s", "é", "É'", "'LL", "", "a\xad", "b12", "34"]  # nothing between texts but their bounds
    raw = [t.encode() for t in texts]
    tok = packing.WordTokenizer(WORDS)
    ids, per_text = tok.batch(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    want = [tok.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(want, []) and per_text.tolist() == [len(w) for w in want]


def test_packing_odd_rows_and_buckets(spark, odd_docs, no_docs, tmp_path):
    pieces = packing.pack_power_of_two(odd_docs, WORDS)
    assert pieces.where("doc_id is null").groupBy("doc_tokens").count().count() == 2
    assert pieces.where("doc_id = 7 and start = 0").count() == 2
    packing.write_buckets(pieces, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where("bucket <> length").count() == 0 and back.count() == pieces.count()
    assert packing.pack_power_of_two(no_docs, WORDS).count() == 0
    assert packing.piece_lengths(2048 * 2 + 7, 2048) == [2048, 2048, 4, 2, 1] and packing.piece_lengths(0, 8) == []


DOMAINS = {"clean": "quality = 1 and toxic = 0", "low": "quality = 0 and toxic = 0", "toxic": "toxic = 1"}


def test_rates_meet_targets(spark):
    docs, labels = labelled(spark)
    out, mix = mixing.mix_to_weights(docs, labels, DOMAINS, {"clean": 0.8, "low": 0.15, "toxic": 0.05})
    rows = out.collect()
    share = np.array([sum(r[mixing.TOKENS] * r.rate * r[mixing.P][k] for r in rows) for k in range(3)])
    assert np.abs(share / share.sum() - [0.8, 0.15, 0.05]).max() < 1e-3 and min(r.rate for r in rows) >= 0
    copies = np.array([sum(r[mixing.TOKENS] * r.copies * r[mixing.P][k] for r in rows) for k in range(3)])
    assert np.abs(copies / copies.sum() - [0.8, 0.15, 0.05]).max() < 0.03
    assert np.mean([r[mixing.P][2] > 0.5 for r in rows if r.doc_id % 5 == 0]) > 0.97


def brute_rates(t, p, target, steps=20_000):
    """Plain projected gradient in the same metric, tiny steps."""
    r, g = np.ones(len(t)), (p * t[:, None]).T @ p
    for _ in range(steps):
        total = (p * (t * r)[:, None]).sum(axis=0)
        r = np.maximum(0, r - 0.05 * p @ np.linalg.solve(g, total - target))
    return r


def test_rates_equal_brute_force_least_squares(spark):
    rng = np.random.default_rng(3)
    t, p = rng.integers(5, 500, 80).astype(float), rng.dirichlet([0.3, 0.3, 0.3], 80)
    rows = spark.createDataFrame([(i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(t, p))],
                                 f"i int, {mixing.TOKENS} long, {mixing.P} array<double>")
    mix = mixing.fit_rates(rows, {"a": 0.5, "b": 0.3, "c": 0.2}, anchor="a", max_rate=1e9, tolerance=1e-10, max_steps=60)
    got = np.array([r[0] for r in rows.join(mix.rates, mixing.P).orderBy("i").select(mixing.RATE).collect()])
    s = (p * t[:, None]).sum(axis=0)
    want = brute_rates(t, p, np.array([0.5, 0.3, 0.2]) / 0.5 * s[0], 3000)
    assert np.abs(got - want).max() < 1e-2


def test_scarce_domains_meet_their_targets(spark):
    # a domain with half a percent of the tokens shall have five
    rows = [(100, [0.98, 0.02] if i % 200 else [0.05, 0.95]) for i in range(2000)]
    df = spark.createDataFrame(rows, f"{mixing.TOKENS} long, {mixing.P} array<double>")
    mix = mixing.fit_rates(df, {"clean": 0.93, "toxic": 0.07})
    assert mix.reached and max(r[mixing.RATE] for r in mix.rates.collect()) > 4
    assert np.abs(np.array(mix.totals) - mix.targets).max() / sum(mix.targets) < 1e-4
    with pytest.warns(UserWarning, match="not reached"):
        mix = mixing.fit_rates(df, {"clean": 0.5, "toxic": 0.5}, max_rate=1.0)
    assert not mix.reached and mix.miss() > 0.1 and mix.steps <= mixing.MAX_STEPS


def test_bounded_rates_reach_targets_within_headroom(spark):
    # rates of at most 1 can only take away: a toxic share of 8 % falls to 2 %, clean text stays but for 2 %
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(20, 400)), [1 - x, x]) for x in [*rng.beta(1, 60, 1900), *rng.beta(60, 2, 160)]]
    df = spark.createDataFrame([(t, [float(x) for x in p]) for t, p in rows], f"{mixing.TOKENS} long, {mixing.P} array<double>")
    mix = mixing.fit_rates(df, {"clean": 0.98, "toxic": 0.02}, anchor="clean", max_rate=1.0, headroom=0.02)
    assert mix.reached and mix.steps <= 20
    rates = [r for r in mix.rates.collect()]
    assert all(0 <= r[mixing.RATE] <= 1 for r in rates)
    assert min(r[mixing.RATE] for r in rates if r[mixing.P][1] < 0.1) > 0.8


def test_scoring_classes_share_a_rate():
    p = mixing.on_grid(np.random.default_rng(1).dirichlet([0.2, 1, 3], 500))
    assert np.allclose(p.sum(axis=1), 1) and np.allclose(p * mixing.GRID, np.round(p * mixing.GRID))


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    w = {"clean": 1.0, "low": 1.0, "toxic": 1.0}
    out = mixing.sampled(odd_docs, none, DOMAINS, w)
    assert out.columns == odd_docs.columns and out.count() == 10
    assert mixing.sampled(no_docs, none, DOMAINS, w).count() == 0
    _, labels = labelled(spark, 50)
    assert mixing.sampled(odd_docs, labels, DOMAINS, w, max_rate=1.0).count() <= 10


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


def test_main_text_of_several_templates(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(24):
        paras = [sentence(rng, rng.randint(20, 60)) for _ in range(rng.randint(1, 4))]
        menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in sentence(rng, rng.randint(3, 6)).split())
        noise = sentence(rng, 30)
        if i % 3 == 0:  # article, open paragraphs, comments
            body = (f"<nav><ul>{menu}</ul></nav><div class='ad'>{noise}</div><article><h1>T{i}</h1>" + "".join(f"<p><b>{p}<br>" for p in paras)
                    + f"</article><div id='comments'><p>{noise}</p></div><footer>f</footer>")
            rows.append((i, f"http://a.org/{i}", page(body)))
            want[i] = [f"T{i}", *paras]
        elif i % 3 == 1:  # no semantic tags: the slot with the running text, a fixed text in it
            body = (f"<div class='top'><ul>{menu}</ul></div><div class='box'><div class='inner'><p>Always the same line here.</p>"
                    + "".join(f"<p>{p} &amp; x&nbsp; y</p>" for p in paras) + f"</div></div><div class='sidebar'>{noise}</div><form>q <input></form>")
            rows += [(1000 * k + i, f"https://user@B.org:80/{i}?k={k}", page(body)) for k in (0, 1)]
            want[i] = want[1000 + i] = [f"{p} & x y" for p in paras]
        else:  # main with a list
            body = f"<header>Site {noise}</header><main><header><h2>H</h2></header><ul>" + "".join(f"<li>{p}" for p in paras) + "</ul></main>"
            rows.append((i, f"http://c.org/{i}", page(body)))
            want[i] = ["H", *paras]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (20_000, 0):  # broadcast, and the shuffle beyond its bound
        got = {r.page_id: r.text for r in html_template.extract_main_text(df, broadcast_hosts=limit).collect()}
        assert got == {i: "\n\n".join(w) for i, w in want.items()}


def test_a_paragraph_on_every_page_is_main_text_of_articles(spark):
    rng, rows = random.Random(31), []
    same = sentence(rng, 25)
    for host, n in (("a", 2), ("b", 9), ("c", 10), ("d", 51)):
        for i in range(n):
            rows.append((len(rows), f"http://{host}.org/{i}", page(f"<nav>menu</nav><article><p>{sentence(rng, 40)}</p><p>{same}</p></article>")))
    rows.append((len(rows), "http://d.org/x", None))
    out = html_template.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(same in r.text for r in out if r.page_id < len(rows) - 1)


def test_fixed_text_of_a_deduced_container_whatever_the_number_of_pages(spark):
    rng, rows, want = random.Random(32), [], {}
    for host, n in (("a", 3), ("b", 9), ("c", 10), ("d", 30)):
        for i in range(n):
            text = sentence(rng, 60)
            want[len(rows)] = text
            rows.append((len(rows), f"http://{host}.org/{i}", page(f"<div class='top'>x</div><div class='box'><p>All rights stay here.</p><p>{text}</p></div>")))
    rows.append((len(rows), "http://d.org/x", None))
    out = html_template.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out if r.page_id in want} == want


def test_copies_of_one_page_keep_their_text(spark):
    html = page("<nav><a href='/'>menu</a></nav><article><h1>T</h1><p>one</p><p>two</p></article>")
    df = spark.createDataFrame([(i, f"http://h/{i}", html) for i in range(15)], "page_id long, url string, html string")
    assert {r.text for r in html_template.extract_main_text(df).collect()} == {"T\n\none\n\ntwo"}


def test_main_text_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "http://y/", "plain <b>te</b>xt &lt;only&gt;"), (None, "http://y/", "<p>" + "long word " * 50_000),
            (4, "http://z", "<nav>menu</nav>"), (5, "http://z", "<article>a</p></div><!-- <p>no</p> -->b<!-- open"), (5, "http://z", "<article>a</p></div>b"),
            (6, "http://q/", "a < b <a title='x>y'>c</a> <script>if (a<b) {}")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = html_template.extract_main_text(df)
    assert out.columns == ["page_id", "url", "text"]
    got = sorted(((r.page_id or 0), r.text) for r in out.collect())
    assert [g for g in got if g[0]] == [(1, ""), (2, ""), (3, "plain text <only>"), (4, ""), (5, "ab"), (5, "ab"), (6, "a < b c")]
    assert len(got[0][1]) == 10 * 50_000 - 1
    assert html_template.extract_main_text(df.limit(0)).count() == 0


def test_names_do_not_take_the_article(spark):
    text = "the article has a good many words"
    art = f"<article><p>{text}</p><p>x <math><mi>y</mi></math></p></article>"
    side = "<div class='sidebar'>s</div><div id='site-footer'>f</div>"
    bodies = {
        "no-sidebar": f"<div class='no-sidebar'>{art}{side}</div>", "overflow": f"<div class='overflow-hidden'>{art}</div>{side}",
        "has-sidebar": f"<main class='has-sidebar'>{art}</main>{side}", "result": art.replace("<article", "<article class='search-result'") + side,
        "own-name": art.replace("<article", "<article class='widget'") + side, "main-name": f"<main class='hidden'>{art}</main>{side}",
        "ancestor": f"<p>Top</p><div class='hidden'>{art}{side}</div>", "in-main": f"<main><h1>H</h1><div class='search'>{art}</div></main>",
        "inside": art.replace("</article>", "<article class='comment'>c</article><div class='share-box'>s</div></article>"),
        "no-tags": f"<div class='widget'><div>{art.replace('article>', 'section>')}</div>{side}</div>"}
    rows = [(10 * i + j, f"http://{name}/{j}", page(body)) for i, (name, body) in enumerate(bodies.items()) for j in range(2)]
    rows += [(900, "http://body/", f"<html><body class='sidebar' style='visibility: hidden'>{art}{side}</body></html>")]
    got = html_template.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.url: r.text for r in got} == {u: f"{text}\n\nx y" for _, u, _ in rows}
