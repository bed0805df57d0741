"""The corpus pipeline, stage by stage and as a whole, with odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import sentence

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean, low and toxic documents, copies, personal data, nulls, empty and long texts, in one folder."""
    rng, rows, labels = random.Random(77), [], []
    for i in range(240):
        words = sentence(rng, rng.randint(70, 140)).split()
        toxic, low = i % 6 == 0, i % 8 == 1
        if toxic:
            words[::9] = [rng.choice(["grumble", "snarl", "hissing"]) for _ in words[::9]]
        if low:
            words = ["##"] * 30 + words[:8] * 6
        text = " ".join(words)
        rows.append((i, text, "en", "src", len(text)))
        labels.append((i, int(not low), int(toxic)))
    copy = rows[2][1]
    rows += [(1000 + k, copy, "en", "src", len(copy)) for k in range(20)]  # exact copies
    rows += [(1100 + k, copy + " " + sentence(rng, 2), "en", None, None) for k in range(5)]  # near copies
    rows += [(1200, rows[3][1] + " mail jane.roe@mail.org now", "en", "src", 0), (1201, "word " * 30_000, "en", "src", 1),
             (1202, None, None, None, None), (1203, "", "en", "src", 0), (None, "x y z", None, None, None), (None, None, None, None, None),
             rows[4], rows[4]]
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels + [(None, 1, 0), (3, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet")
    return root


def test_stages_keep_the_columns_and_take_effect(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "personal data", "mixing", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, corpus)
        if name != "packing":
            assert out.columns == docs.columns, name
            assert dict(out.dtypes) == dict(docs.dtypes), name
        path = f"{corpus}/stage-{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name == "quality rules":  # short texts fail the base rule, clean ones stay
            assert all(r.text and len(r.text.split()) >= 50 for r in after) and len({r.doc_id for r in after} & set(range(240))) > 150
        elif name == "near duplicates":
            texts = [r.text for r in after]
            assert len(texts) == len(set(texts)) and sum(t.startswith(before[0].text[:20]) for t in texts) <= 1
            assert len({r.doc_id for r in after if r.doc_id is not None and (r.doc_id == 2 or r.doc_id >= 1000) and r.doc_id < 1200}) == 1
        elif name == "personal data":
            assert len(after) == len(before) and not any("jane.roe" in r.text for r in after)
            assert all(r.n_chars == len(r.text) for r in after if r.doc_id == 1200)
        elif name == "mixing":
            kept = Counter(r.doc_id for r in after)
            assert max(kept.values()) == 1  # nothing is repeated
            clean = [r.doc_id for r in before if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 6]
            toxic = [r.doc_id for r in before if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 6 == 0]
            assert np.mean([d in kept for d in clean]) > 0.9 and np.mean([d in kept for d in toxic]) < 0.5
        else:
            import public_tokenizers
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = {r.doc_id: np.array([*tok.encode(r.text, add_special_tokens=False).ids, 1], "<u4") for r in before}
            for r in after:
                ids = want[r.doc_id]
                assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            assert sum(r.length for r in after) == sum(len(x) for x in want.values())


def test_run_is_the_stages(spark, corpus):
    out = corpus_pipeline.run(spark, corpus)
    assert set(out.columns) >= {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    whole = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).where("n <> t")
    assert out.count() > 100 and whole.count() == 0


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
