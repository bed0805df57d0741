"""Word count: tokenise -> drop empty -> count per word -> ``word: n``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.text import words_of
from eventlake.operators.aggregates import count_per_element


def words(df: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per non-empty word of every (whole) text (tokenize +
    drop_empty in one regex pass)."""
    return df.select(F.explode(words_of(F.col(text_col))).alias("word"))


def format_pair(df: DataFrame, key: str = "word", n: str = "n") -> DataFrame:
    return df.withColumn("formatted", F.concat_ws(": ", F.col(key), F.col(n).cast("string")))


def count_words(df: DataFrame, text_col: str = "value") -> DataFrame:
    return format_pair(count_per_element(words(df, text_col), "word", "n"))
