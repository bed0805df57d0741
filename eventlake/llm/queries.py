"""Registered queries of the corpus operators: each applies one operator with
production parameters to its whole table. ``ORACLE`` has DuckDB SQL where SQL
can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (chunk_dedup, collocations, html_template, mixing, near_dedup, packing, pii, quality_rules, secrets,
                           sharding, token_align, topk, toxicity)
from eventlake.llm.common import table


#: surrogate key of the registered queries; a real corpus has its own, kept secret
PII_KEY = "registered-query-key"


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_entities")


def op2_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards, capacity = mean (rounded down or up): law ``rows``."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), n_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    vectors = (table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & topk.usable(e))
               .select(F.col("vec_id").cast("long").alias("id"), topk.quantized(e).alias("v")))
    return topk.top_k(vectors, F.col("id") % 50 == 0, k=5)


def op4_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the smallest doc_id of its near-duplicate class."""
    return near_dedup.near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op5_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's category probabilities. The label table has two judgements,
    so the chain is: low quality, toxic, and toxic in otherwise good text."""
    docs, quality, toxic = table(spark, sf_dir, "documents"), F.col("quality"), F.col("toxic")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), {
        "low_quality": quality == 0, "toxic_in_good_text": (toxic == 1) & (quality == 1), "toxic": toxic == 1})
    return toxicity.score(docs, chain)


def op6_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.digest_rows(packing.pack_power_of_two(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit_quality_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_quality_rules(docs, rules).select(
        "doc_id", *quality_rules.BASE, "base_failed", "kept")


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, rate and copies for 90 % clean, 5 % low-quality and 5 % toxic
    tokens, with the greatest miss of a total as a share of all targets."""
    quality, toxic = F.col("quality"), F.col("toxic")
    domains = {"clean": (quality == 1) & (toxic == 0), "low_quality": (quality == 0) & (toxic == 0), "toxic": toxic == 1}
    out, mix = mixing.mix_to_weights(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"),
                                     domains, {"clean": 0.90, "low_quality": 0.05, "toxic": 0.05}, drop=("text",))
    p = F.col(mixing.P)
    return out.select("doc_id", F.col(mixing.TOKENS).alias("tokens"),
                      *[F.get(p, F.lit(k)).alias(f"p_{n}") for k, n in enumerate(domains)], "rate", "copies",
                      F.lit(mix.miss()).alias("miss"))


def op9_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by the template of its host."""
    return html_template.extract_main_text(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op10_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that several documents share, wherever it stands."""
    return chunk_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op11_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed shapes, and values in credential context that cost 10^9 guesses or more."""
    return secrets.digest_rows(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's first 2000 phrases of 2 or 3 words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two public tokenizers aligned over the bytes of every document."""
    import public_tokenizers

    return token_align.alignment_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                         public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_surrogates": op1_surrogates,
    "op2_bounded_ring": op2_bounded_ring,
    "op3_histogram_topk": op3_histogram_topk,
    "op4_prob_minhash": op4_prob_minhash,
    "op5_classifier_chain": op5_classifier_chain,
    "op6_power_of_two_packing": op6_power_of_two_packing,
    "op8_soft_mixing": op8_soft_mixing,
    "op7_decision_list": op7_decision_list,
    "op9_template_text": op9_template_text,
    "op10_gear_chunks": op10_gear_chunks,
    "op11_guess_cost_secrets": op11_guess_cost_secrets,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op3_histogram_topk": """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row AS query, q.id AS query_id, c.id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.v) = len(c.v)
  WHERE q.id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",

    "op12_phrase_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, doc, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
q AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM p),
g AS (
  SELECT lang, len(ws) AS n, ws, unnest(range(1, len(ws) + 1)) AS i FROM q),
f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS k, ws[i] AS phrase FROM g
    UNION ALL SELECT lang, 2, ws[i] || ' ' || ws[i + 1] FROM g WHERE i + 1 <= n
    UNION ALL SELECT lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM g WHERE i + 2 <= n) u
  GROUP BY ALL HAVING count(*) >= 10),
tot AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (
  SELECT lang, k, phrase, a, 1 AS cut, ws[1] AS lp, array_to_string(ws[2:], ' ') AS rp FROM c
  UNION ALL SELECT lang, k, phrase, a, 2, ws[1] || ' ' || ws[2], ws[3] FROM c WHERE k = 3),
s AS (
  SELECT cuts.*, x.f AS l, y.f AS r,
    (1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, ws[1] || ' ' || ws[2] AS phrase FROM c WHERE k = 3
    UNION ALL SELECT lang, a, ws[2] || ' ' || ws[3] FROM c WHERE k = 3) u
  GROUP BY ALL),
kept AS (
  SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase)
  WHERE inside.longer IS NULL OR 100 * inside.longer < 50 * low.a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, tot.n AS n, CAST(score AS BIGINT) AS score
FROM r JOIN tot USING (lang) WHERE rank <= 2000""",
}
