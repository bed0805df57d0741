"""Readers for the given parquet tables and plain text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan as it is: the session's split size alone decides its tasks."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)
