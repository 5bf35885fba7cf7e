"""Did we look? Schedules as slowly changing rows, expected times, matching with runs, coverage of buckets.

Schedules, runs and buckets are often made of a short list of keys by formulas. Spark's estimate of such rows is that of the list,
so joins of them would be broadcast, millions of rows by way of the driver; unions and windows, or a merge, do without. A source
has a run for each step of its cadence at most: its axis is ordered as a whole, and what lies by key stays where it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import is_live
from tidemark.operators.revisions import valid_to
from tidemark.operators.routing import next_event
from tidemark.operators.timeline import islands, last_said, looked_up


def schedule_revisions(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Schedule rows that differ from the one before, with their grace: a quarter of the interval, 60 to 900 seconds."""
    w = Window.partitionBy(*key).orderBy("effective_from")
    before = F.lag(F.struct("enabled", "interval_s")).over(w)
    kept = changes.withColumn("_before", before).where(~F.struct("enabled", "interval_s").eqNullSafe(F.col("_before")))
    grace = F.least(F.greatest(F.floor(F.coalesce("interval_s", F.lit(0)) / 4), F.lit(60)), F.lit(900)).cast("long")
    return kept.drop("_before").withColumn("grace_s", grace)


def schedule_segments(revisions: DataFrame, key: Sequence[str]) -> DataFrame:
    return valid_to(revisions, key, "effective_from")


def match_runs(expected: DataFrame, runs: DataFrame, key: Sequence[str]) -> DataFrame:
    """expected (key, expected_at) with the run scheduled for exactly that time: the first terminal one, else the last."""
    pending = ~F.col("state").isin("SUCCEEDED", "PARTIAL", "FAILED", "CANCELLED")
    order = F.struct(pending.alias("p"), F.when(pending, -F.unix_micros("created_at")).otherwise(F.unix_micros("created_at")).alias("t"), "run_id")
    one = runs.groupBy(*key, F.col("scheduled_for").alias("expected_at")).agg(F.min_by(F.struct("state", "trigger", "purpose"), order).alias("run"))
    return looked_up(expected, one, [*key, "expected_at"])


#: Kinds of rows on the axis of a source's schedule, in the order in which those of one time are heard.
ASKED, BEGINS, RAN = 0, 1, 2


def anchors(schedules: DataFrame, runs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every anchor of every schedule row: key, schedule (struct of the row), anchor, ran, next (the schedule's next anchor).

    Anchors are the start of a schedule, or its anchor_at, and every run that its cadence or bootstrap made inside it. Schedules
    and runs are united on one time axis: a run hears the schedule that it lies in, and each anchor the run that comes next.
    Schedule rows of one key don't overlap (`schedule_segments` makes them so).
    """
    row = F.struct("effective_from", "effective_to", "enabled", "interval_s", "grace_s", "origin", "anchor_at")
    own = known_origin(schedules).select(*key, row.alias("_row"))
    initial = F.coalesce("_row.anchor_at", "_row.effective_from")
    # A first anchor before its schedule hears the schedule's first run, even one at the very start.
    heard = F.when(initial >= F.col("_row.effective_from"), initial).otherwise(F.timestamp_micros(F.unix_micros("_row.effective_from") - 1))
    natural = runs.where(F.col("trigger").isin("SCHEDULED", "BOOTSTRAP") & F.col("scheduled_for").isNotNull()).select(*key, F.col("scheduled_for").cast("timestamp").alias("_at")).distinct()
    axis = (
        own.select(*key, F.col("_row.effective_from").alias("_at"), F.lit(ASKED).alias("_what"), "_row", F.lit(None).cast("timestamp").alias("anchor"))
        .unionByName(own.select(*key, heard.alias("_at"), F.lit(BEGINS).alias("_what"), "_row", initial.alias("anchor")))
        .unionByName(natural.select(*key, "_at", F.lit(RAN).alias("_what"), F.lit(None).cast(own.schema["_row"].dataType).alias("_row"), F.col("_at").alias("anchor")))
    )
    heard_by = last_said(axis, key, "_at", F.when(F.col("_what") == ASKED, F.col("_row")), "_in", F.col("_what"), span=None)
    ahead = next_event(heard_by, key, "_at", F.col("_what") == RAN, "_next", span=None).where(F.col("_what") != ASKED)
    ahead = ahead.withColumn("schedule", F.when(F.col("_what") == RAN, F.col("_in")).otherwise(F.col("_row")))
    inside = (F.col("_what") == BEGINS) | F.col("schedule.effective_to").isNull() | (F.col("_at") < F.col("schedule.effective_to"))
    ahead = ahead.where(F.col("schedule").isNotNull() & inside)
    begins = F.coalesce("schedule.anchor_at", "schedule.effective_from")
    run = F.when(F.col("schedule.effective_to").isNull() | (F.col("_next") < F.col("schedule.effective_to")), F.col("_next"))
    later = F.least(run, F.when(begins > F.col("anchor"), begins))
    return ahead.select(*key, "schedule", "anchor", (F.col("_what") == RAN).alias("ran"), later.alias("next"))


def expected_times(schedules: DataFrame, runs: DataFrame, key: Sequence[str], start: str, end: str, now: Column, by_schedule: bool = False) -> DataFrame:
    """Mature expected times of [start, end): key, expected_at, grace_s (and effective_from of its schedule, if by_schedule).

    From each anchor the interval is counted up to the next one. A time within the grace of the next anchor is absorbed by it;
    runs are expected at their own times. A schedule that is off, has no interval, or whose origin is UNKNOWN expects nothing.
    """
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    rows = anchors(schedules, runs, key).select(*key, "schedule.*", "anchor", "ran", "next").where("enabled and interval_s is not null and origin <> 'UNKNOWN'")
    live = rows.withColumns({"_from": F.greatest("effective_from", a), "_to": F.least(F.coalesce("effective_to", b), b)}).where("_from < _to")
    t = lambda c: F.unix_timestamp(c)
    first = F.greatest(F.lit(0), F.ceil((t("_from") - t("anchor")) / F.col("interval_s")))
    stop = F.least(t("_to"), F.coalesce(t("next"), t("_to")))
    begin = t("anchor") + first * F.col("interval_s")
    counted = live.where(begin < stop).withColumn("_s", F.explode(F.sequence(begin, stop - 1, F.col("interval_s").cast("bigint"))))
    counted = counted.where(F.col("next").isNull() | (F.abs(t("next") - F.col("_s")) > F.col("grace_s"))).withColumn("expected_at", F.timestamp_seconds("_s"))
    own = live.where("ran and anchor >= _from and anchor < _to").withColumn("expected_at", F.col("anchor"))
    out = [*key, "effective_from", "expected_at"] if by_schedule else [*key, "expected_at"]
    every = counted.select(*out, "grace_s").union(own.select(*out, "grace_s"))
    return every.where(t("expected_at") + F.col("grace_s") <= F.unix_timestamp(now)).groupBy(*out).agg(F.max("grace_s").alias("grace_s"))


def known_origin(schedules: DataFrame) -> DataFrame:
    """schedules with the optional columns origin (null: known) and anchor_at."""
    origin = F.coalesce("origin", F.lit("KNOWN")) if "origin" in schedules.columns else F.lit("KNOWN")
    return schedules.withColumns({"origin": origin, "anchor_at": F.col("anchor_at") if "anchor_at" in schedules.columns else F.lit(None).cast("timestamp")})


def outcome(run: Column) -> Column:
    """What a matched run says of its expected time."""
    return (
        F.when(run.isNull() | ~is_live(run["trigger"], run["purpose"]), "MISSING")
        .when(run["state"] == "SUCCEEDED", "SATISFIED")
        .when(run["state"] == "PARTIAL", "PARTIAL")
        .when(run["state"].isin("FAILED", "CANCELLED"), "FAILED")
        .otherwise("MISSING")
    )


def coverage_status(total: Column, satisfied: Column, partial: Column, failed: Column) -> Column:
    return (
        F.when(F.coalesce(total, F.lit(0)) == 0, "NO_COVERAGE")
        .when(satisfied == total, "COMPLETE")
        .when(satisfied + partial > 0, "PARTIAL")
        .when(failed > 0, "DEGRADED")
        .otherwise("NO_COVERAGE")
    )


def schedule_coverage(schedules: DataFrame, runs: DataFrame, buckets: DataFrame, key: Sequence[str], start: str, end: str, size_s: int, now: Column) -> DataFrame:
    """buckets (key, bucket_start) with expected, satisfied, partial, failed, missing, status and evaluation."""
    matched = match_runs(expected_times(schedules, runs, key, start, end, now), runs, key).withColumn("_o", outcome(F.col("run")))
    seconds = F.unix_timestamp("expected_at")
    placed = matched.withColumn("bucket_start", F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(size_s))))
    kinds = {"satisfied": "SATISFIED", "partial": "PARTIAL", "failed": "FAILED", "missing": "MISSING"}
    sums = placed.groupBy(*key, "bucket_start").agg(F.count("*").alias("expected"), F.max("grace_s").alias("grace_s"), *[F.count_if(F.col("_o") == v).alias(k) for k, v in kinds.items()])
    out = looked_up(buckets, sums, [*key, "bucket_start"]).fillna(0, ["expected", *kinds])
    open_end = F.unix_timestamp("bucket_start") + size_s + F.coalesce("grace_s", F.lit(60))
    return out.withColumns(
        {"status": coverage_status(F.col("expected"), F.col("satisfied"), F.col("partial"), F.col("failed")), "evaluation": F.when(F.unix_timestamp(now) < open_end, "PROVISIONAL").otherwise("FINAL")}
    ).drop("grace_s")


#: Why a bucket is covered as it is.
RUN_MISSING, NOT_LIVE, NOT_TERMINAL, RUN = "EXPECTED_RUN_MISSING", "NON_LIVE_RUN_DOES_NOT_PROVE_COVERAGE", "SCHEDULED_RUN_NOT_TERMINAL", "SCHEDULED_RUN_"
NONE_MATURE, ORIGIN_UNKNOWN, NO_CADENCE, NOT_EXPECTED = "NO_MATURE_EXPECTED_OPPORTUNITY", "SCHEDULE_EXPECTATION_UNKNOWN", "NO_SCHEDULED_CADENCE", "SOURCE_NOT_EXPECTED"


def reason(run: Column) -> Column:
    """The reason code of an expected time by its matched run."""
    done = run["state"].isin("SUCCEEDED", "PARTIAL", "FAILED", "CANCELLED")
    return F.when(run.isNull(), RUN_MISSING).when(~is_live(run["trigger"], run["purpose"]), NOT_LIVE).when(done, F.concat(F.lit(RUN), run["state"])).otherwise(NOT_TERMINAL)


def schedule_evaluation(schedules: DataFrame, runs: DataFrame, buckets: DataFrame, key: Sequence[str], start: str, end: str, size_s: int, now: Column) -> DataFrame:
    """Every bucket (key, bucket_start) under every schedule row that overlaps it: key, bucket_start, effective_from,
    expectation, status, evaluation, counts, and the sorted reasons. `combine_segments` makes one row a bucket of them.

    A bucket hears the schedule row that its start lies in, and meets those that begin inside it. An UNKNOWN origin leaves the expectation open; a schedule that is off or
    without an interval expects nothing, and is final at once.
    """
    counts = {"satisfied": "SATISFIED", "partial": "PARTIAL", "failed": "FAILED", "missing": "MISSING"}
    t = lambda c: F.unix_timestamp(c)
    own = known_origin(schedules)
    columns = [c for c in own.columns if c not in key]
    said = own.select(*key, F.col("effective_from").alias("_at"), F.lit(0).alias("_what"), F.struct(*columns).alias("_row"))
    asks = buckets.select(*key, F.col("bucket_start").alias("_at"), F.lit(1).alias("_what"), F.lit(None).cast(said.schema["_row"].dataType).alias("_row"))
    heard = last_said(said.unionByName(asks), key, "_at", F.col("_row"), "_in", F.col("_what"), span=None).where("_what = 1")
    heard = heard.where(F.col("_in").isNotNull() & (F.col("_in.effective_to").isNull() | (F.col("_in.effective_to") > F.col("_at")))).select(*key, F.col("_at").alias("bucket_start"), "_in.*")
    placed_at = F.timestamp_seconds(t("effective_from") - F.pmod(t("effective_from"), F.lit(size_s)))
    begun = own.withColumn("bucket_start", placed_at).where(F.col("effective_from") > F.col("bucket_start")).join(buckets.select(*key, "bucket_start").hint("merge"), [*key, "bucket_start"])
    rows = heard.unionByName(begun.select(heard.columns))
    matched = match_runs(expected_times(schedules, runs, key, start, end, now, by_schedule=True), runs, key)
    seconds = t("expected_at")
    placed = matched.select(*key, "effective_from", F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(size_s))).alias("bucket_start"), outcome(F.col("run")).alias("_o"), reason(F.col("run")).alias("_r"))
    sums = placed.groupBy(*key, "effective_from", "bucket_start").agg(F.count("*").alias("expected"), *[F.count_if(F.col("_o") == v).alias(k) for k, v in counts.items()], F.array_sort(F.collect_set("_r")).alias("_reasons"))
    out = looked_up(rows, sums, [*key, "effective_from", "bucket_start"]).fillna(0, ["expected", *counts])
    unknown, idle = F.col("origin") == "UNKNOWN", ~F.col("enabled") | F.col("interval_s").isNull()
    open_end = t("bucket_start") + size_s + F.col("grace_s")
    why = (
        F.when(unknown, F.array(F.lit(ORIGIN_UNKNOWN)))
        .when(idle, F.array(F.when(F.col("enabled"), NO_CADENCE).otherwise(NOT_EXPECTED)))
        .when(F.col("expected") == 0, F.array(F.lit(NONE_MATURE)))
        .otherwise(F.col("_reasons"))
    )
    return out.select(
        *key,
        "bucket_start",
        "effective_from",
        F.when(unknown, "UNKNOWN").when(idle, "NOT_EXPECTED").otherwise("EXPECTED").alias("expectation"),
        coverage_status(F.col("expected"), F.col("satisfied"), F.col("partial"), F.col("failed")).alias("status"),
        F.when(idle & ~unknown, "FINAL").when(F.unix_timestamp(now) < open_end, "PROVISIONAL").otherwise("FINAL").alias("evaluation"),
        "expected",
        *counts,
        why.alias("reasons"),
    )


def combine_segments(segments: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row a bucket from its schedule segments (expectation, status, counts): EXPECTED if any is, else UNKNOWN, else NOT."""
    e = F.col("expectation") == "EXPECTED"
    expectation = F.when(F.bool_or(e), "EXPECTED").when(F.bool_or(F.col("expectation") == "UNKNOWN"), "UNKNOWN").otherwise("NOT_EXPECTED")
    own = lambda *s: F.bool_or(e & F.col("status").isin(*s))
    complete = F.bool_or(e) & F.bool_and(~e | (F.col("status") == "COMPLETE")) & ~F.bool_or(F.col("expectation") == "UNKNOWN")
    status = F.when(complete, "COMPLETE").when(own("COMPLETE", "PARTIAL"), "PARTIAL").when(own("DEGRADED"), "DEGRADED").otherwise("NO_COVERAGE")
    return segments.groupBy(*key).agg(expectation.alias("expectation"), status.alias("status"), *[F.sum(c).alias(c) for c in ("expected", "satisfied", "partial", "failed", "missing") if c in segments.columns])


#: What a window's availability says of recovery, and availabilities from the worst to the best.
RECOVERY = {"AVAILABLE": "COMPLETE", "PARTIAL": "PARTIAL", "UNAVAILABLE": "UNRECOVERABLE"}
WORST_FIRST = ("UNAVAILABLE", "PARTIAL", "AVAILABLE")
#: The time axis that each kind of rule proves.
AXES = {"WORK_UNITS": "UPSTREAM_UPDATED_TIME", "MANIFEST": "SOURCE_DATASET_DATE", "DATASET_DATE": "SOURCE_DATASET_DATE", "INTERVAL": "SOURCE_EFFECTIVE_TIME", "SNAPSHOT": "NODE_RECEIVED_TIME"}
MANIFEST_KIND = "EPSS_DATASET_MANIFEST"


def unit_availability(state: Column) -> Column:
    return F.when(state == "SUCCEEDED", "AVAILABLE").when(state.isin("FAILED", "CANCELLED"), "UNAVAILABLE").otherwise("PARTIAL")


def acquisition_windows(runs: DataFrame, rules: DataFrame, units: DataFrame | None = None, manifests: DataFrame | None = None) -> DataFrame:
    """Windows that runs prove, by the rule of their source: source_key, run_id, kind, axis, start, end, dataset_date,
    availability, recovery.

    rules: source_key, kind, horizon_s. INTERVAL is a fixed horizon before the run, SNAPSHOT its time, DATASET_DATE its own date.
    WORK_UNITS takes the windows of the run's units (run_id, unit_id, state, window_start, window_end), each as available as its
    own state says, and MANIFEST the dataset dates of the manifests that it brought (run_id, kind, dataset_date); units or
    manifests without a window or date prove nothing. Other kinds of a run that neither succeeded nor is PARTIAL prove nothing.
    """
    at = F.coalesce("scheduled_for", "created_at").cast("timestamp")
    ruled = runs.join(rules.select("source_key", "kind", "horizon_s"), "source_key").select("source_key", "run_id", "state", at.alias("at"), "kind", "horizon_s")
    none = lambda kind: F.lit(None).cast(kind)
    done = ruled.where(F.col("state").isin("SUCCEEDED", "PARTIAL"))
    horizon = F.timestamp_seconds(F.unix_timestamp("at") - F.col("horizon_s"))
    parts = [
        done.where(F.col("kind").isin("INTERVAL", "SNAPSHOT", "DATASET_DATE")).select(
            "source_key", "run_id", "kind",
            F.when(F.col("kind") == "INTERVAL", horizon).when(F.col("kind") == "SNAPSHOT", F.col("at")).alias("start"),
            F.when(F.col("kind").isin("INTERVAL", "SNAPSHOT"), F.col("at")).alias("end"),
            F.when(F.col("kind") == "DATASET_DATE", F.to_date("at")).alias("dataset_date"),
            unit_availability(F.col("state")).alias("availability"),
        )
    ]
    if units is not None:
        own = units.where("window_start is not null and window_end is not null").select("run_id", F.col("state").alias("_state"), "window_start", "window_end")
        met = ruled.where(F.col("kind") == "WORK_UNITS").join(own, "run_id")
        parts.append(met.select("source_key", "run_id", "kind", F.col("window_start").alias("start"), F.col("window_end").alias("end"), none("date").alias("dataset_date"), unit_availability(F.col("_state")).alias("availability")))
    if manifests is not None:
        dates = manifests.where((F.col("kind") == MANIFEST_KIND) & F.col("dataset_date").isNotNull()).select("run_id", F.col("dataset_date").cast("date").alias("dataset_date")).distinct()
        met = ruled.where(F.col("kind") == "MANIFEST").join(dates, "run_id")
        parts.append(met.select("source_key", "run_id", "kind", none("timestamp").alias("start"), none("timestamp").alias("end"), "dataset_date", unit_availability(F.col("state")).alias("availability")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    of = lambda names, c: F.coalesce(*[F.when(F.col(c) == k, v) for k, v in names.items()])
    return whole.withColumns({"axis": of(AXES, "kind"), "recovery": of(RECOVERY, "availability")})


def merged_windows(windows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Overlapping or touching windows (start, end, availability) as one, as available as the worst of them: key, start, end, n,
    availability. Sources with many windows are dealt by time."""
    rank = F.array_position(F.array(*[F.lit(x) for x in WORST_FIRST]), F.col("availability"))
    worst = F.element_at(F.array(*[F.lit(x) for x in WORST_FIRST]), F.min(rank).cast("int"))
    return islands(windows, key, "start", "end", {"availability": worst})
