"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes what each stage keeps as Parquet in the shared
folder and hands the reread table to the next. All but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import mixing, near_dedup, packing, pii, quality_rules
from eventlake.llm.common import table
from eventlake.llm.queries import PII_KEY
from eventlake.session import scratch_path

#: token shares after mixing; toxic text fades to 2 % and nothing is repeated, so that
#: rates of 1 at most can reach the targets, clean tokens may lose ``HEADROOM`` of their total
WEIGHTS = {"clean": 0.98, "toxic": 0.02}
HEADROOM = 0.02


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    rules = quality_rules.fit_quality_rules(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.apply_quality_rules(docs, rules, prefix="__q_")
    return judged.where(F.col("__q_kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return near_dedup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities get surrogates; ``n_chars`` follows the new text."""
    out = pii.replace_pii(docs, PII_KEY)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic text down to its target weight; rates stop at 1, so no document is repeated."""
    domains = {"clean": F.col("toxic") == 0, "toxic": F.col("toxic") == 1}
    return mixing.sampled(docs, table(spark, sf_dir, "labels"), domains, WEIGHTS, anchor="clean", max_rate=1.0,
                          headroom=HEADROOM)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document, one per sequence."""
    import public_tokenizers

    return packing.digest_rows(packing.pack_power_of_two(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("personal data", personal_data),
          ("mixing", mix), ("packing", pack)]

#: learned rules, sketches, keyed hashes and tokenizers are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
