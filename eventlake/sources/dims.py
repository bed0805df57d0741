"""Dimension (lookup) table readers."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.schemas import DIMENSION

log = logging.getLogger(__name__)

DIM_QUERY = "select dim1, dim1_val, updated_at from t_dim1"


def read_dimension(spark: SparkSession, *, jdbc_url: str | None = None,
                   driver: str | None = None, user: str | None = None,
                   password: str | None = None, table: str | None = None,
                   path: str | None = None, fmt: str = "parquet",
                   query: str = DIM_QUERY) -> DataFrame:
    """Read ``(dim1, dim1_val)`` from JDBC (pushed-down query), a catalog
    table, or files."""
    if jdbc_url:
        r = (spark.read.format("jdbc").option("url", jdbc_url).option("query", query))
        for k, v in (("driver", driver), ("user", user), ("password", password)):
            if v is not None:
                r = r.option(k, v)
        df = r.load()
    elif table:
        df = spark.table(table)
    elif path:
        df = spark.read.format(fmt).load(path)
    else:
        raise ValueError("give jdbc_url, table or path")
    cols = [F.col("dim1").cast("string"), F.col("dim1_val").cast("string")]
    if "updated_at" in df.columns:  # lets the lookup resolve duplicate keys: latest row wins
        cols.append(F.col("updated_at"))
    return df.select(*cols)


def read_dimension_or_empty(spark: SparkSession, **kw) -> DataFrame:
    """Like ``read_dimension`` but any failure yields an empty lookup (every
    key then resolves to the not-found default). Duplicate keys: the row with
    the latest ``updated_at`` wins when that column exists."""
    try:
        df = read_dimension(spark, **kw)
        df.schema  # force analysis so a missing table fails here
        return df
    except Exception as exc:  # noqa: BLE001 - the documented contract is "empty on error"
        log.warning("dimension read failed, using empty lookup: %s", exc)
        return spark.createDataFrame([], DIMENSION)


# Test lookup (event type -> area of the site); 'error' is left out on purpose
# so the not-found default occurs.
FIXTURE_DIM = [("click", "navigation"), ("purchase", "checkout"), ("signup", "account"), ("view", "catalog")]


def fixture_dimension(spark: SparkSession) -> DataFrame:
    """The test lookup as a local relation (built through Arrow), so the
    optimizer knows its exact size."""
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame(FIXTURE_DIM, columns=DIMENSION.fieldNames()), DIMENSION)
