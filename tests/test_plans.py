"""Plan-shape checks: the properties the operators rely on at scale."""

from pyspark.sql import functions as F

from eventlake.operators.aggregates import latest_n_per_key, window_stats
from eventlake.operators.enrich import enrich, plan_bytes
from eventlake.plans import fixtures as fx
from eventlake.settings import Settings
from eventlake.sources.dims import fixture_dimension

from conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrich_broadcasts_checked_dimension(spark):
    valid = fx.enriched(spark, SF001)
    assert "BroadcastHashJoin" in plan(valid)
    # above the byte bound, or of unknown size (RDD-backed), there is no hint and
    # the join shuffles
    dim = spark.createDataFrame([("click", "a"), ("view", "b")], "dim1 string, dim1_val string")
    assert "SortMergeJoin" in plan(enrich(valid.drop("dim1_val"), dim, Settings()))
    assert plan_bytes(fx.fixture_dimension(spark)) < 1000
    e = enrich(valid.drop("dim1_val"), fx.fixture_dimension(spark), Settings(broadcast_max_bytes=1))
    assert e._jdf.queryExecution().analyzed().toString().count("ResolvedHint") == 1  # that of ``valid`` alone


def test_window_stats_partial_aggregation(spark):
    p = plan(window_stats(fx.enriched(spark, SF001), fx.FIXTURE))
    assert "partial_count" in p and "partial_sum" in p and "partial_min" in p


def test_top_n_limits_before_shuffle(spark):
    p = plan(latest_n_per_key(fx.enriched(spark, SF001), 3, "dim1", ["process_ts", "seq"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_word_count_prunes_columns(spark):
    from eventlake.operators.wordcount import count_words
    from eventlake.sources.tables import load_table
    p = plan(count_words(load_table(spark, SF001, "documents"), "text"))
    assert "ReadSchema: struct<text:string>" in p and "partial_count" in p


def test_pane_replay_reads_materialized_partials(spark):
    from pane_model import pane_replay_accumulating
    p = plan(pane_replay_accumulating(fx.enriched(spark, SF001), fx.FIXTURE))
    assert "FileScan" not in p  # rows were aggregated once into a checkpoint


def test_filter_pushdown_on_source(spark):
    from eventlake.sources.tables import load_table
    ev = load_table(spark, SF001, "events").filter(F.col("event_type") == "click")
    p = plan(ev.select("event_id"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p
