"""Rules of coverage and parity that the tables of the queries don't reach."""

from pyspark.sql import functions as F

from tidemark.operators import coverage as C
from tidemark.operators import parity as P


def at(spark, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns if c.endswith(("_from", "_to", "_at", "_for", "_start", "_end"))})


def evaluated(spark, schedule, runs, now):
    columns = "s string, effective_from string, effective_to string, anchor_at string, interval_s int, enabled boolean, grace_s long, origin string"
    own = at(spark, [("a", *schedule)], columns)
    done = at(spark, [("a", t, t, f"r{i}", state, trigger, "LIVE_INCREMENTAL") for i, (t, state, trigger) in enumerate(runs)], "s string, scheduled_for string, created_at string, run_id string, state string, trigger string, purpose string")
    days = at(spark, [("a", "2024-01-02")], "s string, bucket_start string")
    return C.schedule_evaluation(own, done, days, ["s"], "2024-01-02", "2024-01-03", 86400, F.lit(now).cast("timestamp")).first()


def test_expected_times_are_counted_from_the_anchor(spark):
    row = evaluated(spark, ("2024-01-01", None, "2024-01-01 05:00:00", 28800, True, 60, None), [("2024-01-02 05:00:00", "SUCCEEDED", "SCHEDULED"), ("2024-01-02 13:00:00", "RUNNING", "SCHEDULED")], "2024-01-09")
    assert (row.expected, row.satisfied, row.missing, row.status) == (3, 1, 2, "PARTIAL")
    assert row.reasons == ["EXPECTED_RUN_MISSING", "SCHEDULED_RUN_NOT_TERMINAL", "SCHEDULED_RUN_SUCCEEDED"]


def test_times_that_are_not_mature_leave_a_bucket_open(spark):
    row = evaluated(spark, ("2024-01-01", None, None, 86400, True, 60, None), [], "2024-01-02 00:00:30")
    assert (row.expected, row.status, row.evaluation, row.reasons) == (0, "NO_COVERAGE", "PROVISIONAL", ["NO_MATURE_EXPECTED_OPPORTUNITY"])


def test_sources_that_are_off_are_final_and_unknown_ones_are_not(spark):
    off = evaluated(spark, ("2024-01-01", None, None, 86400, False, 60, None), [], "2024-01-02 00:00:30")
    assert (off.expectation, off.evaluation, off.reasons) == ("NOT_EXPECTED", "FINAL", ["SOURCE_NOT_EXPECTED"])
    unknown = evaluated(spark, ("2024-01-01", None, None, 86400, False, 60, "UNKNOWN"), [], "2024-01-02 00:00:30")
    assert (unknown.expectation, unknown.evaluation, unknown.reasons) == ("UNKNOWN", "PROVISIONAL", ["SCHEDULE_EXPECTATION_UNKNOWN"])


def test_semantic_differences(spark):
    ddl = "k string, source_class string, basis string, window_start string, window_end string"
    left = at(spark, [("moving", "A", "X", "2024-01-01", None), ("same", "A", "ENRICHED", None, None), ("other", "A", "ENRICHED", None, None)], ddl)
    right = at(spark, [("moving", "A", "X", "2024-01-01", None), ("same", "B", "PUBLISHED", None, None), ("other", "A", "PUBLISHED", None, None)], ddl)
    got = {(r.k, r.field, r.classification) for r in P.semantic_differences(left, right, "k", F.col("k") == "moving", F.col("k") == "same").collect()}
    assert got == {("moving", "window", "REGRESSION"), ("same", "source_class", "REGRESSION"), ("same", "basis", "SEMANTICALLY_EQUIVALENT"), ("other", "basis", "REGRESSION")}


def test_unmatched_records_of_other_snapshots_are_unclassified(spark):
    left, right = spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("b", 1)], "k string, v int")
    out = P.parity_differences(left, right, "k", ["v"])
    assert {(r.kind, r.k, r.classification) for r in out.collect()} == {("LEFT_ONLY", "a", "UNCLASSIFIED"), ("RIGHT_ONLY", "b", "UNCLASSIFIED")}
    assert P.parity_accepted(out).first().accepted is False
    assert P.parity_accepted(P.parity_differences(left, left, "k", ["v"])).first().accepted is True
