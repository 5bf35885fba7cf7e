"""Plans and results that must hold when a short list of keys becomes millions of rows."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.entities import lineage_graph
from tidemark.operators.timeline import looked_up
from tidemark.plans import registry
from tidemark.plans.bindings import FEEDS_AT_ONCE, feed_keys

DATA = Path("/root/testdata/sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_looked_up_is_a_left_join(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.randint(0, 5), i) for i in range(60)]
    told = [(k, n, k and f"{k}{n}", None if n == 2 else n) for k in ("a", "c", None) for n in range(0, 5, 2)]
    df, table = spark.createDataFrame(rows, "k string, n int, i int"), spark.createDataFrame(told, "k string, n int, said string, v int")
    got = sorted(map(tuple, looked_up(df, table, ["k", "n"]).collect()), key=lambda x: x[2])
    assert got == sorted(map(tuple, df.join(table, ["k", "n"], "left").collect()), key=lambda x: x[2])


@pytest.mark.parametrize(
    "name",
    [
        "measurement_hourly_availability",
        "schedule_coverage_daily",
        "schedule_evaluation_daily",
        "coverage_rollup_weekly",
        "gated_by_coverage_daily_all",
        "coverage_read",
    ],
)
def test_rows_made_of_keys_are_never_broadcast(spark, name):
    assert "Broadcast" not in plan(registry.QUERIES[name](spark, str(DATA)))


def test_coverage_of_a_series_is_not_shuffled(spark):
    told = plan(registry.QUERIES["gated_by_coverage_daily_all"](spark, str(DATA)))
    assert told.count("SortMergeJoin") == 1


def test_more_feeds_make_more_tasks_not_larger_ones(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("id event_id", "timestamp'2024-01-02' ts", "id user_id", "'view' event_type", "1.0d value", "'' props")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    keys = feed_keys(spark, str(tmp_path))
    held = [r["count"] for r in keys.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 40_000 and max(held) < 1.25 * FEEDS_AT_ONCE


def test_whole_lineage_has_a_row_for_every_node(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    nodes = registry.QUERIES["lineage_nodes_all"](spark, str(DATA))
    assert nodes.columns == ["entity_key", "depth", "node_type", "node_key"]
    assert nodes.where("node_type = 'OBSERVATION'").distinct().count() == events.select("event_id").distinct().count()
    assert "<= 1000000" not in registry.ORACLES["lineage_nodes_all"]


def test_lineage_graph_meets_by_entity_once(spark):
    told = plan(registry.QUERIES["lineage_graph_nodes"](spark, str(DATA)))
    assert "SortMergeJoin" not in told and told.count("BroadcastHashJoin") == 2


def test_lineage_graph_of_an_entity_with_two_histories(spark):
    at = "timestamp'2024-01-01'"
    history = spark.sql("select * from values (1, 'a'), (1, 'b'), (2, 'c') t(entity_key, history_id)")
    seen = spark.sql(f"select 1 entity_key, 'o' observation_id, cast(null as string) canonical_id, 'r' raw_id, 's' source_key, {at} at union all select 3, 'p', 'c', 'r', 's', {at}")
    buckets = spark.sql(f"select 1 entity_key, 'k' bucket_id, {at} at")
    findings = spark.sql(f"select 1 entity_key, id finding_id, b bucket_id, {at} at from values ('f', 'k'), ('g', 'lost') t(id, b)")
    nodes, edges = lineage_graph(history, seen, buckets, findings)
    assert [r.node_id for r in nodes.where("entity_key = 1").orderBy("position").collect()] == ["entity:1", "history:a", "history:b", "observation:o", "raw:r", "source:s", "activity:k", "finding:f", "finding:g"]
    assert [(r.source, r.target) for r in edges.where("entity_key = 1").orderBy("position").collect()] == [("entity:1", "history:a"), ("entity:1", "history:b"), ("observation:o", "entity:1"), ("raw:r", "source:s"), ("entity:1", "activity:k"), ("activity:k", "finding:f")]
    assert {(r.entity_key, r.truncated) for r in nodes.collect()} == {(1, False), (2, False)}
