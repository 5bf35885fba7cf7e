"""Queries of invariants and readiness over a store made of events, in which some rows break each rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import invariants as I
from tidemark.plans.bindings import EVENTS, events
from tidemark.plans.registry import query


def store(spark, d):
    """The store's tables, a row of each for every event; the number of the event says what is wrong with its rows."""
    e = events(spark, d)
    x = lambda *columns: e.selectExpr(*columns)
    day, end = "date_trunc('day', ts) AS bucket_start", "date_trunc('day', ts) + interval 1 day AS bucket_end"
    return {
        "definition_heads": x("event_id AS active_calculation_id", "IF(event_id % 31 = 0, 'x', event_type) AS active_definition_id"),
        "calculations": x("event_id AS calculation_id", "event_type AS definition_id"),
        "facts": x("event_id AS fact_id", "event_type AS calculation_id", "concat('f', event_id) AS fact_key", "IF(event_id % 7 = 0, 'RETRACTED', 'ACTIVE') AS fact_state", "IF(event_type <> 'signup' OR event_id % 101 = 0, ts, NULL) AS event_time", "IF(event_type = 'signup' OR event_id % 101 = 0, date(ts), NULL) AS event_date", "IF((event_type = 'signup') = (event_id % 103 <> 0), 'DATE', 'INSTANT') AS time_precision"),
        "fact_heads": x("event_id AS current_fact_id", "IF(event_id % 89 = 0, 'x', event_type) AS calculation_id", "concat('f', event_id) AS fact_key", "IF(event_id % 97 = 0, 'x', IF(event_id % 7 = 0, 'RETRACTED', 'ACTIVE')) AS fact_state"),
        "fact_inputs": x("event_id AS fact_id", "event_id AS raw_record_id", "IF(event_id % 83 = 0, event_id, NULL) AS canonical_record_id", "CAST(NULL AS BIGINT) AS run_id", "CAST(NULL AS BIGINT) AS history_id").where("fact_id % 5 <> 0"),
        "bucket_revisions": x("event_id AS revision_id", "event_type AS calculation_id", "'DAY' AS granularity", day, end, "'ALL' AS scope_key", "IF(event_id % 3 = 0, 'NO_COVERAGE', 'COMPLETE') AS coverage", "IF(event_id % 2 = 0, 'UNAVAILABLE', 'AVAILABLE') AS availability", "IF(event_id % 5 = 0, value, NULL) AS value"),
        "bucket_heads": x("event_id AS current_revision_id", "event_type AS calculation_id", "IF(event_id % 79 = 0, 'HOUR', 'DAY') AS granularity", day, end, "'ALL' AS scope_key"),
        "coverage_revisions": x("event_id AS revision_id", "user_id AS source_key", "'DAY' AS granularity", day, end, "IF(event_id % 2 = 0, 'COMPLETE', 'PARTIAL') AS coverage", "IF(event_id % 71 = 0, 'UNKNOWN', 'EXPECTED') AS expectation", "event_id % 6 AS expected", "event_id % 6 - IF(event_id % 73 = 0, 1, 0) AS satisfied"),
        "coverage_heads": x("event_id AS current_revision_id", "IF(event_id % 67 = 0, user_id + 1, user_id) AS source_key", "'DAY' AS granularity", day, end),
        "observation_revisions": x("event_id AS revision_id", "event_id AS observation_key", "user_id AS entity_key", "'USER' AS entity_type", "'ACTIVE' AS state"),
        "observation_heads": x("event_id AS current_revision_id", "event_id AS observation_key", "user_id AS entity_key", "'USER' AS entity_type", "IF(event_id % 41 = 0, 'RETRACTED', 'ACTIVE') AS state"),
        "history_revisions": x("event_id AS revision_id", "user_id AS entity_key", "'USER' AS entity_type"),
        "history_heads": x("event_id AS current_revision_id", "IF(event_id % 43 = 0, NULL, IF(event_id % 47 = 0, user_id + 1, user_id)) AS entity_key", "'USER' AS entity_type"),
        "projection_jobs": x("IF(event_id % 50 = 0, 'FAILED', IF(event_id % 50 = 1, 'QUEUED', 'DONE')) AS state"),
        "coverage_jobs": x("IF(event_id % 60 = 0, 'RUNNING', 'DONE') AS state"),
        "dirty_buckets": x("event_id").where("event_id % 500 = 0"),
        "dirty_coverage": x("event_id").where("event_id < 0"),
        "runs": x("event_id AS run_id", "concat(event_type, '/', user_id) AS source_key", "IF(event_id % 20 = 0, 'RUNNING', IF(event_id % 20 = 1, 'FAILED', 'SUCCEEDED')) AS state", "IF(event_id % 40 = 0, 'MANUAL', 'SCHEDULED') AS trigger"),
        "raw_records": x("event_id AS raw_record_id", "concat(event_type, '/', user_id) AS source_key", "user_id AS source_record_id", "IF(event_id % 3 = 0, 'same', CAST(event_id AS STRING)) AS payload_sha256"),
        "canonical_records": x("IF(event_id % 59 = 0, -event_id, event_id) AS raw_record_id", "IF(event_id % 53 = 0, 'x', concat(event_type, '/', user_id)) AS source_key", "user_id AS source_record_id", "1 AS normalization_version", "concat('k', event_id) AS canonical_key", "'IOC_REPORT' AS record_kind"),
        "normalization_jobs": x("IF(event_id % 61 = 0, NULL, IF(event_id % 64 = 0, event_id - 1, event_id)) AS raw_record_id", "concat(event_type, '/', user_id) AS source_key", "1 AS normalization_version", "IF(event_id % 90 = 0, 'FAILED', IF(event_id % 90 = 1, 'RUNNING', IF(event_id % 90 = 2, 'QUEUED', 'DONE'))) AS state"),
        "checkpoints": x("concat(event_type, '/', user_id) AS source_key", "IF(event_id % 37 = 0, -event_id, IF(event_id % 38 = 0, event_id - 1, event_id)) AS updated_by_run_id"),
    }


N = lambda name, where: f"SELECT '{name}' AS invariant, count(*) AS violations FROM v WHERE {where}"
GROUPS = lambda name, key, where="TRUE": f"SELECT '{name}', count(*) FROM (SELECT 1 FROM v WHERE {where} GROUP BY {key} HAVING count(*) > 1)"
VIEW = f"{EVENTS}, v AS (SELECT event_id AS id, user_id AS u, event_type AS k, event_type || '/' || user_id AS s, lag(event_type || '/' || user_id) OVER (ORDER BY event_id) AS before FROM ev)"
COUNTED = " UNION ALL ".join(
    [
        N("measurement_definition_head_mismatch", "id % 31 = 0"), N("measurement_fact_head_mismatch", "id % 89 = 0 OR id % 97 = 0"), N("measurement_fact_without_provenance", "id % 5 = 0"),
        N("measurement_fact_input_exactly_one_violation", "id % 5 <> 0 AND id % 83 = 0"), N("measurement_bucket_head_mismatch", "id % 79 = 0"), N("coverage_bucket_head_mismatch", "id % 67 = 0"),
        N("complete_coverage_count_contradiction", "id % 2 = 0 AND (id % 71 = 0 OR id % 6 = 0 OR id % 73 = 0)"), N("entity_observation_head_mismatch", "id % 41 = 0"), N("entity_history_head_mismatch", "id % 43 <> 0 AND id % 47 = 0"),
        N("invalid_no_coverage_numeric_value", "id % 30 = 0"), N("invalid_fact_time_precision", "id % 101 = 0 OR id % 103 = 0"), N("failed_projection_jobs", "id % 50 = 0"), N("active_projection_jobs", "id % 50 = 1"), N("failed_coverage_jobs", "FALSE"), N("active_coverage_jobs", "id % 60 = 0"),
        N("dirty_measurement_buckets", "id % 500 = 0"), N("dirty_coverage_buckets", "FALSE"), "SELECT 'active_backfill_requests', NULL", GROUPS("duplicate_active_runs", "s", "id % 20 = 0"), GROUPS("duplicate_active_scheduled_runs", "s", "id % 40 = 20"),
        GROUPS("duplicate_raw_revisions", "s, u", "id % 3 = 0"), GROUPS("duplicate_normalization_jobs", "CASE WHEN id % 61 = 0 THEN NULL WHEN id % 64 = 0 THEN id - 1 ELSE id END"), GROUPS("duplicate_canonical_records", "id"), N("canonical_without_raw", "id % 59 = 0 AND id <> 0"), N("normalization_without_raw", "id % 61 = 0 OR (id % 64 = 0 AND before IS NULL)"),
        N("canonical_source_mismatch", "(id % 59 <> 0 OR id = 0) AND id % 53 = 0"), N("normalization_source_mismatch", "id % 61 <> 0 AND id % 64 = 0 AND before <> s"), N("normalization_queued", "id % 90 = 2"), N("normalization_running", "id % 90 = 1"), N("normalization_failed", "id % 90 = 0"),
        N("checkpoint_without_run", "(id % 37 = 0 AND id <> 0) OR (id % 37 <> 0 AND id % 38 = 0 AND before IS NULL)"), N("checkpoint_of_another_source", "id % 37 <> 0 AND id % 38 = 0 AND before <> s"),
    ]
)


@query("store_invariants", f"WITH {VIEW}, c AS ({COUNTED}) SELECT invariant, violations, coalesce(violations = 0, false) AS accepted FROM c")
def store_invariants(spark, d):
    """Every named invariant with the rows that break it; there is no table of backfill requests, so nobody looked at these."""
    return I.invariants(store(spark, d))


@query(
    "source_readiness",
    f"""WITH {VIEW}, f AS (SELECT s, any_value(u) AS u, any_value(k) AS k, count(*) FILTER (WHERE id % 20 > 1) AS good, count(*) AS n, count(*) FILTER (WHERE id % 90 = 2) AS q, count(*) FILTER (WHERE id % 90 = 1) AS r, count(*) FILTER (WHERE id % 90 = 0) AS bad,
      count(*) FILTER (WHERE id % 61 <> 0 AND id % 64 = 0 AND before <> s) AS sm, count(*) FILTER (WHERE id % 53 <> 0) AS ca FROM v GROUP BY 1)
    SELECT s AS source_key, u % 7 <> 0 AS registered, u % 11 <> 0 AS definition_present, u % 11 <> 0 AND k <> 'error' AS semantic_contract_matches, u % 11 <> 0 AND u % 3 <> 0 AS admission_complete, CAST(good AS BIGINT) AS successful_runs, ca AS canonical_records, q AS normalization_queued, r AS normalization_running, bad AS normalization_failed, sm AS source_mismatches,
      u % 7 <> 0 AND u % 11 <> 0 AND k <> 'error' AND u % 3 <> 0 AND u % 5 <> 0 AND good > 0 AND q + r + bad + sm = 0 AS ready FROM f""",
)
def source_readiness(spark, d):
    """What the readiness of each feed hangs on."""
    e, u = events(spark, d).select("event_type", "user_id").distinct(), F.col("user_id")
    feeds = e.withColumn("source_key", F.concat_ws("/", "event_type", "user_id"))
    contracts = feeds.select("source_key", F.lit("CLASS").alias("source_class"), F.lit("BASIS").alias("observation_basis"), (u % 7 != 0).alias("registered"))
    own = feeds.where(u % 11 != 0).select("source_key", F.lit("CLASS").alias("source_class"), F.when(F.col("event_type") == "error", "OTHER").otherwise("BASIS").alias("observation_basis"), (u % 5 == 0).alias("enabled_by_default"), *[(F.when(u % 3 == 0, " ").otherwise("said") if c == "represents" else F.lit("said")).alias(c) for c in I.ADMISSION])
    out = I.readiness(own, contracts, store(spark, d))
    return out.select("source_key", "registered", "definition_present", "semantic_contract_matches", "admission_complete", "successful_runs", "canonical_records", "normalization_queued", "normalization_running", "normalization_failed", "source_mismatches", "ready")
