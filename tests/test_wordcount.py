from pyspark.sql import functions as F

from eventlake.functions.text import tokenize
from eventlake.operators.wordcount import count_words


def test_word_count_sample(spark):
    df = spark.createDataFrame([(s,) for s in ["blue sea", "sea", "deep blue sea", "", "deep sea"]],
                               "value string")
    got = {r.formatted for r in count_words(df).collect()}
    assert got == {"sea: 4", "blue: 2", "deep: 2"}


def test_tokenizer_cases(spark):
    df = spark.createDataFrame([("  two   gaps here  now",), ("   ",)], "value string")
    rows = df.select(F.filter(tokenize(F.col("value")), lambda w: w != "").alias("w")).collect()
    assert [len(r.w) for r in rows] == [4, 0]
