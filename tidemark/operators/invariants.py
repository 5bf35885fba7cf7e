"""Invariants of the store as data: each names what would break it, and one run counts the rows that do.

Checks of one table's rows are conditions of one aggregation, so a table is scanned once however many there are. Heads, orphans
and lineage are joins that Spark plans, one for each pair of tables; duplicates are groups of a key.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rows:
    """Rows of a table that meet the condition."""

    name: str
    table: str
    broken: str


@dataclass(frozen=True)
class Pairs:
    """Rows of `child` that meet the condition together with the row of `parent` they point to: c and p in the condition."""

    name: str
    child: str
    parent: str
    key: str
    broken: str


@dataclass(frozen=True)
class Missing:
    """Rows of `child` that point to no row of `parent`. key is `child column = parent column`."""

    name: str
    child: str
    parent: str
    key: str


@dataclass(frozen=True)
class Repeated:
    """Keys that more than one row (of those that meet `where`) has."""

    name: str
    table: str
    key: tuple[str, ...]
    where: str = "true"


def differs(*columns: str) -> str:
    return " OR ".join(f"c.{x} <> p.{x}" for x in columns)


ACTIVE = "state IN ('QUEUED', 'RUNNING')"
#: The invariants.
CHECKS = (
    Pairs("measurement_definition_head_mismatch", "definition_heads", "calculations", "active_calculation_id = calculation_id", "p.definition_id <> c.active_definition_id"),
    Pairs("measurement_fact_head_mismatch", "fact_heads", "facts", "current_fact_id = fact_id", differs("calculation_id", "fact_key", "fact_state")),
    Missing("measurement_fact_without_provenance", "facts", "fact_inputs", "fact_id = fact_id"),
    Rows("measurement_fact_input_exactly_one_violation", "fact_inputs", "int(raw_record_id IS NOT NULL) + int(canonical_record_id IS NOT NULL) + int(run_id IS NOT NULL) + int(history_id IS NOT NULL) <> 1"),
    Pairs("measurement_bucket_head_mismatch", "bucket_heads", "bucket_revisions", "current_revision_id = revision_id", differs("calculation_id", "granularity", "bucket_start", "bucket_end", "scope_key")),
    Pairs("coverage_bucket_head_mismatch", "coverage_heads", "coverage_revisions", "current_revision_id = revision_id", differs("source_key", "granularity", "bucket_start", "bucket_end")),
    Rows("complete_coverage_count_contradiction", "coverage_revisions", "coverage = 'COMPLETE' AND (expectation <> 'EXPECTED' OR expected = 0 OR satisfied <> expected)"),
    Pairs("entity_observation_head_mismatch", "observation_heads", "observation_revisions", "current_revision_id = revision_id", differs("observation_key", "entity_key", "entity_type", "state")),
    Pairs("entity_history_head_mismatch", "history_heads", "history_revisions", "current_revision_id = revision_id", differs("entity_key", "entity_type")),
    Rows("invalid_no_coverage_numeric_value", "bucket_revisions", "coverage = 'NO_COVERAGE' AND availability IN ('UNAVAILABLE', 'UNKNOWN') AND value IS NOT NULL"),
    Rows("invalid_fact_time_precision", "facts", "(event_time IS NULL) = (event_date IS NULL) OR (time_precision = 'INSTANT' AND event_time IS NULL) OR (time_precision = 'DATE' AND event_date IS NULL)"),
    Rows("failed_projection_jobs", "projection_jobs", "state = 'FAILED'"),
    Rows("failed_coverage_jobs", "coverage_jobs", "state = 'FAILED'"),
    Rows("active_projection_jobs", "projection_jobs", ACTIVE),
    Rows("active_coverage_jobs", "coverage_jobs", ACTIVE),
    Rows("dirty_measurement_buckets", "dirty_buckets", "true"),
    Rows("dirty_coverage_buckets", "dirty_coverage", "true"),
    Rows("active_backfill_requests", "backfill_requests", ACTIVE),
    Repeated("duplicate_active_runs", "runs", ("source_key",), ACTIVE),
    Repeated("duplicate_active_scheduled_runs", "runs", ("source_key",), f"{ACTIVE} AND trigger IN ('SCHEDULED', 'BOOTSTRAP')"),
    Repeated("duplicate_raw_revisions", "raw_records", ("source_key", "source_record_id", "payload_sha256")),
    Repeated("duplicate_normalization_jobs", "normalization_jobs", ("raw_record_id", "normalization_version")),
    Repeated("duplicate_canonical_records", "canonical_records", ("raw_record_id", "normalization_version", "canonical_key", "record_kind")),
    Missing("canonical_without_raw", "canonical_records", "raw_records", "raw_record_id = raw_record_id"),
    Missing("normalization_without_raw", "normalization_jobs", "raw_records", "raw_record_id = raw_record_id"),
    Pairs("canonical_source_mismatch", "canonical_records", "raw_records", "raw_record_id = raw_record_id", differs("source_key", "source_record_id")),
    Pairs("normalization_source_mismatch", "normalization_jobs", "raw_records", "raw_record_id = raw_record_id", differs("source_key")),
    Rows("normalization_queued", "normalization_jobs", "state = 'QUEUED'"),
    Rows("normalization_running", "normalization_jobs", "state = 'RUNNING'"),
    Rows("normalization_failed", "normalization_jobs", "state = 'FAILED'"),
    Missing("checkpoint_without_run", "checkpoints", "runs", "updated_by_run_id = run_id"),
    Pairs("checkpoint_of_another_source", "checkpoints", "runs", "updated_by_run_id = run_id", differs("source_key")),
)


def sides(check: Pairs | Missing) -> tuple[str, str]:
    child, parent = check.key.split(" = ")
    return child, parent


def invariants(tables: Mapping[str, DataFrame], checks: tuple = CHECKS) -> DataFrame:
    """One row for each check: invariant, violations, accepted. A check of a table that isn't given has null violations and isn't
    accepted, since nobody looked. A null pointer points to no row; comparisons with a null tell no difference."""
    parts, by_table, by_pair = [], defaultdict(list), defaultdict(list)
    told = lambda df, names: df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("invariant"), F.col(n).cast("long").alias("violations")) for n in names])).alias("x")).select("x.*")
    absent = []
    for c in checks:
        wanted = [c.table] if isinstance(c, (Rows, Repeated)) else [c.child, c.parent]
        if any(t not in tables for t in wanted):
            absent.append(c.name)
        elif isinstance(c, Rows):
            by_table[c.table].append(c)
        elif isinstance(c, Pairs):
            by_pair[c.child, c.parent, c.key].append(c)
        elif isinstance(c, Missing):
            a, b = sides(c)
            parents = tables[c.parent].select(F.col(b).alias(a)).where(F.col(a).isNotNull()).distinct()
            parts.append(told(tables[c.child].join(parents, a, "left_anti").agg(F.count("*").alias(c.name)), [c.name]))
        else:
            groups = tables[c.table].where(c.where).groupBy(*c.key).agg(F.count("*").alias("n")).where("n > 1")
            parts.append(told(groups.agg(F.count("*").alias(c.name)), [c.name]))
    for table, own in by_table.items():
        parts.append(told(tables[table].agg(*[F.count_if(F.expr(c.broken)).alias(c.name) for c in own]), [c.name for c in own]))
    for (child, parent, key), own in by_pair.items():
        a, b = key.split(" = ")
        met = tables[child].alias("c").join(tables[parent].alias("p"), F.col(f"c.{a}") == F.col(f"p.{b}"))
        parts.append(told(met.agg(*[F.count_if(F.expr(c.broken)).alias(c.name) for c in own]), [c.name for c in own]))
    if absent:
        one = next(iter(tables.values())).sparkSession.createDataFrame([(n,) for n in absent], "invariant string")
        parts.append(one.select("invariant", F.lit(None).cast("long").alias("violations")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn("accepted", F.coalesce(F.col("violations") == 0, F.lit(False)))


#: What a source is asked for, besides its records: texts that may not be empty.
ADMISSION = ("license_class", "terms_reference", "represents", "does_not_represent", "semantic_contract_version")


def readiness(definitions: DataFrame, contracts: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every source of `contracts` (source_key, source_class, observation_basis, registered) with what its readiness hangs on:
    definition_present, semantic_contract_matches, admission_complete, enabled_by_default, successful_runs, checkpoint_present,
    raw_records, canonical_records, normalization_queued, _running and _failed, provenance_mismatches, source_mismatches, ready.

    definitions: source_key, source_class, observation_basis, enabled_by_default and ADMISSION. tables: runs, checkpoints,
    raw_records, canonical_records, normalization_jobs. Each table is counted by source once.
    """
    count = lambda df, **of: df.groupBy("source_key").agg(*[F.count_if(F.expr(x)).alias(n) for n, x in of.items()])
    raw = tables["raw_records"].select("raw_record_id", F.col("source_key").alias("raw_source"), F.col("source_record_id").alias("raw_id"))
    canonical = tables["canonical_records"].join(raw, "raw_record_id", "left")
    jobs = tables["normalization_jobs"].join(raw, "raw_record_id", "left")
    parts = [
        count(tables["runs"], successful_runs="state = 'SUCCEEDED'"),
        count(tables["checkpoints"], checkpoints="true"),
        count(tables["raw_records"], raw_records="true"),
        count(canonical, canonical_records="true", provenance_mismatches="raw_source <> source_key OR raw_id <> source_record_id"),
        count(jobs, normalization_queued="state = 'QUEUED'", normalization_running="state = 'RUNNING'", normalization_failed="state = 'FAILED'", source_mismatches="raw_source <> source_key"),
    ]
    said = F.lit(True)
    for c in ADMISSION:
        said = said & F.coalesce(F.trim(c) != "", F.lit(False))
    own = definitions.select("source_key", F.col("source_class").alias("_class"), F.col("observation_basis").alias("_basis"), "enabled_by_default", said.alias("_said"), F.lit(True).alias("_there"))
    out = contracts.join(own, "source_key", "left")
    for part in parts:
        out = out.join(part, "source_key", "left")
    counts = ["successful_runs", "checkpoints", "raw_records", "canonical_records", "provenance_mismatches", "normalization_queued", "normalization_running", "normalization_failed", "source_mismatches"]
    out = out.fillna(0, counts)
    yes = lambda c: F.coalesce(c, F.lit(False))
    out = out.withColumns({"definition_present": yes(F.col("_there")), "semantic_contract_matches": yes((F.col("_class") == F.col("source_class")) & (F.col("_basis") == F.col("observation_basis"))), "admission_complete": yes(F.col("_said")), "checkpoint_present": F.col("checkpoints") > 0})
    none = F.lit(True)
    for c in counts[4:]:
        none = none & (F.col(c) == 0)
    ready = yes(F.col("registered")) & F.col("definition_present") & F.col("semantic_contract_matches") & F.col("admission_complete") & yes(~F.col("enabled_by_default")) & (F.col("successful_runs") > 0) & F.col("checkpoint_present") & (F.col("raw_records") > 0) & none
    return out.withColumn("ready", ready).select("source_key", F.coalesce("registered", F.lit(False)).alias("registered"), "definition_present", "semantic_contract_matches", "admission_complete", "enabled_by_default", "successful_runs", "checkpoint_present", "raw_records", "canonical_records", "normalization_queued", "normalization_running", "normalization_failed", "provenance_mismatches", "source_mismatches", "ready")
