"""Measurement: bucket aggregation, the zero-or-unknown gate, availability, series, distributions, period comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import GRANULARITY, bucket_end, bucket_start, members
from tidemark.operators.revisions import heads
from tidemark.operators.timeline import looked_up

LIVE_POLICIES = ("SOURCE_COVERAGE_REQUIRED", "SNAPSHOT_CONFIRMATION_REQUIRED")


def in_period(df: DataFrame, start: str, end: str, time_col: str = "event_time", date_col: str | None = None) -> DataFrame:
    """Rows with event_time in [start, end), or, without a time, event_date in [date of start, date of end)."""
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    on = (F.col(time_col) >= a) & (F.col(time_col) < b)
    if date_col:
        on = on | (F.col(time_col).isNull() & (F.col(date_col) >= F.to_date(a)) & (F.col(date_col) < F.to_date(b)))
    return df.where(on)


def with_buckets(df: DataFrame, at: str, granularities: Sequence[str]) -> DataFrame:
    """A row for each granularity: granularity, bucket_start, bucket_end."""
    spots = F.array(*[F.struct(F.lit(g).alias("granularity"), bucket_start(at, g).alias("bucket_start")) for g in granularities])
    out = df.withColumn("_b", F.explode(spots)).withColumns({"granularity": F.col("_b.granularity"), "bucket_start": F.col("_b.bucket_start")})
    return out.drop("_b").withColumn("bucket_end", bucket_end("bucket_start", F.col("granularity")))


def aggregate_expr(kind: str, entity: str = "entity_key", value: str = "value", order: Sequence[str] = ("event_time", "fact_key")) -> Column:
    """The raw value of a bucket by aggregation kind."""
    if kind in ("COUNT_EVENTS", "DISTRIBUTION_COUNT"):
        return F.count("*")
    if kind in ("COUNT_DISTINCT", "FIRST_SEEN_DISTINCT"):
        return F.count_distinct(entity)
    if kind in ("SNAPSHOT_LAST", "DATASET_COUNT"):
        return F.coalesce(F.max_by(value, F.struct(*order)), F.lit(0.0))
    raise ValueError(kind)


def aggregate(facts: DataFrame, key: Sequence[str], at: str, granularities: Sequence[str], **named: str) -> DataFrame:
    """One row for each (key, granularity, bucket): a column for each name=kind. Only buckets with facts appear."""
    placed = with_buckets(facts, at, granularities)
    return placed.groupBy(*key, "granularity", "bucket_start").agg(*[aggregate_expr(kind).alias(name) for name, kind in named.items()])


def spine(keys: DataFrame, start: str, end: str, granularity: str) -> DataFrame:
    """Every bucket of [start, end) for every key."""
    size = GRANULARITY[granularity]
    seconds = F.sequence(F.unix_timestamp(F.lit(start).cast("timestamp")), F.unix_timestamp(F.lit(end).cast("timestamp")) - 1, F.lit(size).cast("bigint"))
    return keys.withColumn("_s", F.explode(seconds)).withColumn("bucket_start", F.timestamp_seconds("_s")).drop("_s")


def carried_forward(keys: DataFrame, facts: DataFrame, key: Sequence[str], start: str, end: str, granularity: str, value: str = "value") -> DataFrame:
    """The last fact before each bucket's end, of any age. Facts are reduced to the last one of each bucket before anything is
    ordered, so a busy key is a row for each bucket, not one for each fact."""
    grid = spine(keys, start, end, granularity)
    last = facts.groupBy(*key, bucket_start("event_time", granularity).alias("bucket_start")).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct("event_time", "fact_key")).alias("_last"))
    rows = grid.withColumn("_kind", F.lit(1)).join(last, [*key, "bucket_start"], "full_outer")
    w = Window.partitionBy(*key).orderBy("bucket_start").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last(F.when(F.col("_last.v").isNotNull(), F.col("_last.v")), ignorenulls=True).over(w)
    return rows.withColumn("value", found).where("_kind = 1").select(*key, "bucket_start", "value")


def gate(raw: Column, policy: Column, coverage: Column, availability: Column) -> Column:
    """raw 0 becomes 0 only where zero is proven, else NULL; raw > 0 stays only where numbers are allowed."""
    live = policy.isin(*LIVE_POLICIES)
    zero_ok = F.when(live, F.coalesce(coverage, F.lit("NO_COVERAGE")) == "COMPLETE").otherwise(F.coalesce(availability, F.lit("UNAVAILABLE")) == "AVAILABLE")
    num_ok = F.when(live, F.coalesce(coverage, F.lit("NO_COVERAGE")) != "NO_COVERAGE").otherwise(F.coalesce(availability, F.lit("UNAVAILABLE")).isin("AVAILABLE", "PARTIAL"))
    return F.when((raw == 0) & zero_ok, F.lit(0)).when((raw > 0) & num_ok, raw)


def overlap(intervals: DataFrame, key: Sequence[str], start: str, end: str, granularity: str) -> DataFrame:
    """A row for each bucket that an interval touches, clipped to it: an interval is expanded to its buckets, so the join
    with buckets is on equal starts."""
    size = F.lit(GRANULARITY[granularity]).cast("bigint")
    a, b = F.unix_timestamp(start), F.unix_timestamp(end)
    touched = intervals.where(F.col(end) > F.col(start)).withColumn("_s", F.explode(F.sequence(a - F.pmod(a, size), b - 1, size)))
    out = touched.withColumn("bucket_start", F.timestamp_seconds("_s"))
    return out.withColumns({"clip_start": F.greatest(F.col(start), F.col("bucket_start")), "clip_end": F.least(F.col(end), F.timestamp_seconds(F.col("_s") + size))}).drop("_s")


def interval_availability(buckets: DataFrame, windows: DataFrame, key: Sequence[str], granularity: str, status: str = "availability") -> DataFrame:
    """buckets with `available`: AVAILABLE, PARTIAL or UNAVAILABLE, by a sweep over the clipped windows in (start, end) order.

    A gap or an end short of the bucket's makes it PARTIAL; so does a PARTIAL window met before the bucket is full. Windows expanded
    to their buckets are many more than Spark estimates, so they are looked up and not joined, which might broadcast them.
    """
    on = [*key, "bucket_start"]
    clipped = overlap(windows.where(F.col(status).isin("AVAILABLE", "PARTIAL")), key, "start", "end", granularity)
    w = Window.partitionBy(*on).orderBy("clip_start", "clip_end", status).rowsBetween(Window.unboundedPreceding, -1)
    size = GRANULARITY[granularity]
    finish = F.timestamp_seconds(F.unix_timestamp("bucket_start") + size)
    swept = clipped.withColumn("_pm", F.coalesce(F.max("clip_end").over(w), F.col("bucket_start"))).withColumn("_met", F.col("_pm") < finish)
    per = swept.groupBy(*on).agg(
        F.bool_or(F.col("_met") & (F.col("clip_start") > F.col("_pm"))).alias("_gap"),
        F.max("clip_end").alias("_end"),
        F.bool_or(F.col("_met") & (F.col(status) == "PARTIAL")).alias("_part"),
    )
    joined = looked_up(buckets, per, on)
    state = F.when(F.col("_end").isNull(), "UNAVAILABLE").when(F.col("_gap") | (F.col("_end") < finish) | F.col("_part"), "PARTIAL").otherwise("AVAILABLE")
    return joined.withColumn("available", state).drop("_gap", "_end", "_part")


def dataset_availability(windows: DataFrame, key: Sequence[str], date: str, status: str = "availability") -> DataFrame:
    """The best status of each date: AVAILABLE before PARTIAL before the rest."""
    rank = F.when(F.col(status) == "AVAILABLE", 0).when(F.col(status) == "PARTIAL", 1).otherwise(2)
    return windows.groupBy(*key, date).agg(F.min_by(F.col(status), F.struct(rank, F.col(status))).alias("available"))


def distribution(facts: DataFrame, key: Sequence[str], dimension: str, top: int | None, include_other: bool = True) -> DataFrame:
    """rank, member, n, share and is_other of each key: the top members (None: all), and OTHER for what remains, if it is asked
    for. Multi-valued members are split on |; order is by count, then member; shares are those of the rows that are shown."""
    split = facts.withColumn("member", F.explode(members(dimension)))
    counts = split.groupBy(*key, "member").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("n"), F.asc("member"))))
    total = F.sum("n").over(Window.partitionBy(*key))
    if top is None or not include_other:
        shown = ranked if top is None else ranked.where(F.col("r") <= top)
        shown = shown.select(*key, F.col("r").cast("int").alias("rank"), "member", "n", F.lit(False).alias("is_other"))
        return shown.withColumn("share", F.col("n") / total)
    other = F.col("r") > top
    shown = ranked.groupBy(*key, F.when(other, top + 1).otherwise(F.col("r")).cast("int").alias("rank")).agg(
        F.when(F.max(other.cast("int")) == 1, "OTHER").otherwise(F.max("member")).alias("member"), F.sum("n").alias("n"), (F.max(other.cast("int")) == 1).alias("is_other")
    )
    return shown.withColumn("share", F.col("n") / total)


def series_as_of(revisions: DataFrame, key: Sequence[str], as_of: Column) -> DataFrame:
    """The newest revision of each bucket that was calculated by a time."""
    return heads(revisions.where(F.col("calculated_at") <= as_of), key, [F.desc("calculated_at"), F.desc("revision")])


def series(keys: DataFrame, buckets: DataFrame, key: Sequence[str], start: str, end: str, granularity: str, policy: str, available: DataFrame) -> DataFrame:
    """The gap-filled series: a bucket's own value, or 0 where a zero is proven, or NULL. available: key, bucket_start,
    available and, for live policies, coverage; one row a bucket. It is looked up before buckets are joined, as it often lies where
    the keys do, and then needs no shuffle."""
    on = [*key, "bucket_start"]
    grid = looked_up(spine(keys, start, end, granularity), available, on).join(buckets.hint("merge"), on, "left")
    coverage = F.col("coverage") if "coverage" in available.columns else F.lit(None).cast("string")
    known = F.col("available") if "available" in available.columns else F.lit(None).cast("string")
    if policy == "SOURCE_TIME_AVAILABILITY_REQUIRED":  # a bucket with facts was looked at, whatever its windows say
        known = F.when((F.coalesce(known, F.lit("UNAVAILABLE")) == "UNAVAILABLE") & (F.col("value") > 0), "PARTIAL").otherwise(known)
    return grid.withColumn("gated", gate(F.coalesce("value", F.lit(0)), F.lit(policy), coverage, known))


def period_value(kind: str, on: Column, entity: str = "entity_key", value: str = "value") -> Column:
    """An aggregate over the rows where `on` holds, by comparison kind."""
    if kind == "SUM_EVENTS":
        return F.count_if(on)
    if kind == "EXACT_DISTINCT_QUERY":
        return F.count_distinct(F.when(on, F.col(entity)))
    if kind == "LAST_VALUE":
        return F.max_by(F.when(on, F.col(value)), F.when(on, F.struct("event_time", "fact_key")))
    return F.lit(None).cast("double")


def compare(facts: DataFrame, covered: DataFrame, key: Sequence[str], kind: str, previous: str, start: str, end: str) -> DataFrame:
    """Current [start, end) against previous [previous, start): value, previous, delta, percent and status, in one pass over
    the facts. covered: key, current_ok, previous_ok. Nothing is compared unless both periods are covered; percent is NULL
    where the previous value is 0. The keys are those of covered, so a covered key without facts is a true zero."""
    p, s, e = (F.lit(x).cast("timestamp") for x in (previous, start, end))
    t = F.col("event_time")
    sums = facts.where((t >= p) & (t < e)).groupBy(*key).agg(period_value(kind, t >= s).alias("_cur"), period_value(kind, t < s).alias("_prev"))
    joined = covered.join(sums, list(key), "left")
    zero = F.lit(0) if kind != "LAST_VALUE" else F.lit(None).cast("double")
    cur = F.when(F.col("current_ok"), F.coalesce("_cur", zero))
    prev = F.when(F.col("previous_ok"), F.coalesce("_prev", zero))
    both = F.col("current_ok") & F.col("previous_ok")
    status = F.when(~F.col("current_ok"), "CURRENT_NOT_COVERED").when(~F.col("previous_ok"), "PREVIOUS_NOT_COVERED").otherwise("COMPARABLE")
    out = joined.withColumns({"value": cur, "previous_value": prev, "status": status})
    return out.withColumns(
        {"delta": F.when(both, F.col("value") - F.col("previous_value")), "percent": F.when(both & (F.col("previous_value") != 0), (F.col("value") - F.col("previous_value")) / F.col("previous_value") * 100)}
    ).drop("_cur", "_prev")


#: Verdicts of a published comparison, in the order in which they are looked for, and their reasons.
NO_POLICY, NOT_COVERED, OTHER_MODEL, NO_VALUE = "COMPARISON_POLICY_NONE", "CURRENT_OR_PREVIOUS_PERIOD_NOT_FULLY_COVERED", "SOURCE_MODEL_OR_POPULATION_PROFILE_CHANGED", "COMPARISON_VALUE_UNAVAILABLE"


def compare_published(facts: DataFrame, covered: DataFrame, key: Sequence[str], kind: str, previous: str, start: str, end: str, same_model: bool = False, same_profile: bool = False) -> DataFrame:
    """`compare` with the published verdicts: status, reason, value, previous_value, delta, percent. facts have model and profile
    (null or empty: none). Values are only told where the periods are covered and, if asked for, the sets of models and of
    profiles are those of the period before; one pass over the facts gives all of it."""
    p, s, e = (F.lit(x).cast("timestamp") for x in (previous, start, end))
    t = F.col("event_time")
    now, before = t >= s, t < s
    known = lambda c, on: F.array_sort(F.collect_set(F.when(on & (F.col(c) != ""), F.col(c))))
    sums = facts.where((t >= p) & (t < e)).groupBy(*key).agg(
        period_value(kind, now).alias("_cur"), period_value(kind, before).alias("_prev"), *[known(c, on).alias(f"_{c}_{n}") for c in ("model", "profile") for n, on in (("c", now), ("p", before))]
    )
    joined = covered.join(sums, list(key), "left")
    zero = F.lit(0) if kind != "LAST_VALUE" else F.lit(None).cast("double")
    cur, prev = F.coalesce("_cur", zero), F.coalesce("_prev", zero)
    none = F.array().cast("array<string>")
    differs = lambda c: F.coalesce(f"_{c}_c", none) != F.coalesce(f"_{c}_p", none)
    other = (differs("model") if same_model else F.lit(False)) | (differs("profile") if same_profile else F.lit(False))
    uncovered = ~(F.coalesce("current_ok", F.lit(False)) & F.coalesce("previous_ok", F.lit(False)))
    reason = F.when(F.lit(kind == "NONE"), NO_POLICY).when(uncovered, NOT_COVERED).when(other, OTHER_MODEL).when(cur.isNull() | prev.isNull(), NO_VALUE)
    status = F.when(F.col("reason").isNull(), "AVAILABLE").when(F.col("reason") == NOT_COVERED, "INSUFFICIENT_COVERAGE").when(F.col("reason") == OTHER_MODEL, "INCOMPATIBLE_SOURCE_MODEL").otherwise("UNSUPPORTED")
    # A value that is there is told even where the other one isn't.
    shown = F.col("reason").isNull() | (F.col("reason") == NO_VALUE)
    out = joined.withColumn("reason", reason).withColumns({"status": status, "value": F.when(shown, cur), "previous_value": F.when(shown, prev)})
    change = F.when(F.col("reason").isNull(), F.col("value") - F.col("previous_value"))
    return out.withColumns({"delta": change, "percent": F.when(F.col("previous_value") != 0, change / F.col("previous_value") * 100)}).drop("_cur", "_prev", "_model_c", "_model_p", "_profile_c", "_profile_p")


#: The periods of a summary, in days.
PERIODS = {"24H": 1, "7D": 7, "30D": 30}


def period_summary(facts: DataFrame, days: DataFrame, key: Sequence[str], kind: str, end: str, periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """The value of each period that ends at `end`, from days (key, bucket_start, covered): NULL and INSUFFICIENT_COVERAGE unless
    every day of it is covered, UNSUPPORTED for kind NONE, UNAVAILABLE where the kind finds no value. A fact is expanded to the
    periods that hold it, which are as many as the summary has."""
    stop = F.lit(end).cast("timestamp")
    spans = F.array(*[F.struct(F.lit(p).alias("period"), F.lit(n).alias("days")) for p, n in periods.items()])
    age = lambda at: (F.unix_timestamp(stop) - F.unix_timestamp(at)) / 86400
    inside = lambda at: F.filter(spans, lambda x: (age(at) <= x["days"]) & (F.col(at) < stop))
    held = days.where("covered").select(*key, F.explode(inside("bucket_start")).alias("_p")).groupBy(*key, "_p").agg(F.count("*").alias("_held"))
    grid = days.select(*key).distinct().withColumn("_p", F.explode(spans))
    values = facts.select("*", F.explode(inside("event_time")).alias("_p")).groupBy(*key, "_p").agg(period_value(kind, F.lit(True)).alias("_value"))
    out = grid.join(held, [*key, "_p"], "left").join(values, [*key, "_p"], "left")
    whole = F.coalesce("_held", F.lit(0)) == F.col("_p.days")
    value = F.col("_value") if kind in ("LAST_VALUE", "NONE") else F.coalesce("_value", F.lit(0))
    reason = F.lit("COMPARISON_POLICY_NONE") if kind == "NONE" else F.when(~whole, "PERIOD_NOT_FULLY_COVERED").when(value.isNull(), "SUMMARY_VALUE_UNAVAILABLE")
    status = F.lit("UNSUPPORTED") if kind == "NONE" else F.when(~whole, "INSUFFICIENT_COVERAGE").when(value.isNull(), "UNAVAILABLE").otherwise("AVAILABLE")
    return out.select(*key, F.col("_p.period").alias("period"), F.when(whole, value).alias("value"), status.alias("status"), reason.alias("reason"))


def coverage_rollup(df: DataFrame, key: Sequence[str], status: str) -> DataFrame:
    """Status of a range: NO_COVERAGE if any bucket has none, PARTIAL if any is partial or degraded, else COMPLETE."""
    s = F.col(status)
    state = F.when(F.bool_or(s == "NO_COVERAGE"), "NO_COVERAGE").when(F.bool_or(s.isin("PARTIAL", "DEGRADED")), "PARTIAL").when(F.bool_and(s == "COMPLETE"), "COMPLETE").otherwise("NO_COVERAGE")
    return df.groupBy(*key).agg(state.alias("coverage"))


def provenance(buckets: DataFrame, facts: DataFrame, key: Sequence[str], granularity: str) -> DataFrame:
    """The facts that a bucket knew: of each fact the newest revision created by the bucket's calculation, and only then
    those that are active and lie in the bucket. The join is on the bucket of any revision, so it stays an equi join."""
    spots = facts.select(*key, "fact_key", bucket_start("event_time", granularity).alias("bucket_start")).distinct()
    known = buckets.join(spots, [*key, "bucket_start"]).join(facts, [*key, "fact_key"]).where(F.col("created_at") <= F.col("calculated_at"))
    newest = heads(known, [*key, "bucket_start", "fact_key"], [F.desc("revision")])
    return newest.where((F.col("state") == "ACTIVE") & (bucket_start("event_time", granularity) == F.col("bucket_start")))
