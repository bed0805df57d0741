"""Helpers shared by the corpus operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import ensure_checkpoint_dir

#: a word: a maximal run of characters other than space and \t \n \v \f \r
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder: later
    jobs reread it even when the executors that computed it are gone."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times in ``fn``, also inside inner
    lambdas; a plain column expression would be evaluated again per element."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def words(text: Column) -> Column:
    """The words of ``text`` in order; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != F.lit(""))


def sample_fraction(df: DataFrame, key: Column, bound: int, seed: int = 7) -> DataFrame:
    """About ``bound`` rows of ``df`` by a hash of ``key`` (all rows when there are
    no more than that); the choice is the same in every run."""
    n = df.count()
    if n <= bound:
        return df
    keep = int(bound / n * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < F.lit(keep))


def crc32_of(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
