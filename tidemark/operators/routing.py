"""Routing observations: exact set-valued minutes, their coverage, rollups, recovery.

Sets are kept exact. Distinct counts are taken from exploded (bucket, member) rows, which Spark pre-aggregates, so no task
gathers the members of a busy minute from all rows; arrays are built from these distinct rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import bucket_start
from tidemark.operators.measure import GRANULARITY, overlap

#: Minutes that a complete rollup has, and the lateness of a minute.
MINUTES = {"MINUTE": 1, "FIVE_MINUTES": 5, "HOUR": 60, "DAY": 1440}
LATENESS_S = 180
#: Failures that are recovered by themselves, and the event that plans one.
REASONS = ("PROVIDER_DISCONNECT", "BACKPRESSURE_LIMIT", "DB_UNAVAILABLE", "FORCED_TERMINATE")
DRAIN = "DRAIN_REQUESTED"
#: How a minute was acquired, and by which channel.
LIVE, RECOVERED, BACKFILL = "LIVE_STREAM", "MRT_RECOVERY", "HISTORICAL_BACKFILL"
CHANNELS = {LIVE: "RIS_LIVE_WEBSOCKET", RECOVERED: "RIS_MRT_UPDATE", BACKFILL: "RIS_MRT_UPDATE"}
SETS = ("announced", "withdrawn", "origins", "peers", "rrcs")


def tagged(kind: str, members: Column) -> Column:
    """Members as structs of the set's name and the member as text."""
    return F.transform(members, lambda x: F.struct(F.lit(kind).alias("kind"), x.cast("string").alias("member")))


def member_rows(obs: DataFrame, at: str, granularity: str, keep: Sequence[str] = ()) -> DataFrame:
    """Distinct (bucket, kind, member) rows of the sets of all observations."""
    as_text = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: x.cast("string"))
    own = {"announced": as_text("announced"), "withdrawn": as_text("withdrawn"), "origins": as_text("origins"), "peers": F.array(F.col("peer").cast("string")), "rrcs": F.array("rrc")}
    every = F.concat(*[tagged(k, v) for k, v in own.items()])
    rows = obs.select(bucket_start(at, granularity).alias("bucket_start"), *keep, F.explode(every).alias("m")).select("bucket_start", *keep, "m.kind", "m.member")
    return rows.where("member is not null").distinct()


def set_columns(rows: DataFrame, key: Sequence[str], arrays: bool = False) -> DataFrame:
    """Sizes (and sorted members) of each set, and of announced and withdrawn together."""
    prefix = F.col("kind").isin("announced", "withdrawn")
    out = [F.count_distinct(F.when(prefix, F.col("member"))).alias("n_prefixes")]
    for s in SETS:
        on = F.when(F.col("kind") == s, F.col("member"))
        out.append(F.count_if(F.col("kind") == s).alias(f"n_{s}"))
        if arrays:
            out.append(F.array_sort(F.collect_list(on)).alias(s))
    return rows.groupBy(*key).agg(*out)


def routing_minutes(obs: DataFrame, at: str = "observed_at", granularity: str = "MINUTE", arrays: bool = False) -> DataFrame:
    """Message and prefix-event counts and the sizes of the exact sets of each minute."""
    b = bucket_start(at, granularity).alias("bucket_start")
    size = lambda c: F.size(F.coalesce(F.col(c), F.array()))
    every = F.concat(F.coalesce("announced", F.array().cast("array<string>")), F.coalesce("withdrawn", F.array().cast("array<string>")))
    v6 = F.size(F.filter(every, lambda p: F.instr(p, ":") > 0))
    counts = obs.groupBy(b).agg(F.count("*").alias("messages"), F.sum(size("announced")).alias("announcements"), F.sum(size("withdrawn")).alias("withdrawals"), F.sum(F.size(every) - v6).alias("v4_events"), F.sum(v6).alias("v6_events"))
    return counts.join(set_columns(member_rows(obs, at, granularity), ["bucket_start"], arrays), "bucket_start", "left")


def combine_deltas(deltas: DataFrame, key: Sequence[str], counters: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """Counters summed and sets united over the segments of a minute."""
    sums = deltas.groupBy(*key).agg(*[F.sum(c).alias(c) for c in counters], F.count("*").alias("segments"))
    every = F.concat(*[tagged(s, F.col(s)) for s in sets])
    rows = deltas.select(*key, F.explode(every).alias("m")).select(*key, "m.*").distinct()
    united = rows.groupBy(*key).agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == s, F.col("member")))).alias(s) for s in sets])
    return sums.join(united, list(key), "left")


def minute_coverage(minutes: DataFrame, sessions: DataFrame, data: DataFrame) -> DataFrame:
    """minutes (bucket_start) with coverage and availability.

    sessions: start, end, profile, degraded. data: bucket_start, rejected, profile (null: not known). A minute is complete if
    its sessions leave no gap and all carry the one profile; rejects or a degraded session make it DEGRADED.
    """
    clipped = overlap(sessions, [], "start", "end", "MINUTE")
    w = Window.partitionBy("bucket_start").orderBy("clip_start", "clip_end").rowsBetween(Window.unboundedPreceding, -1)
    swept = clipped.withColumn("_pm", F.coalesce(F.max("clip_end").over(w), F.col("bucket_start")))
    per = swept.groupBy("bucket_start").agg(
        F.bool_or(F.col("clip_start") > F.col("_pm")).alias("_gap"), F.max("clip_end").alias("_end"), F.bool_or("degraded").alias("_bad"), F.collect_set("profile").alias("_p"), F.count_if(F.col("profile").isNull()).alias("_none")
    )
    own = data.groupBy("bucket_start").agg(F.sum("rejected").alias("_rejected"), F.collect_set("profile").alias("_dp"), F.count_if(F.col("profile").isNull()).alias("_dnone"))
    joined = minutes.join(per, "bucket_start", "left").join(own, "bucket_start", "left")
    empty = F.array().cast("array<string>")
    profiles = F.array_union(F.coalesce("_p", empty), F.coalesce("_dp", empty))
    one = (F.size(profiles) == 1) & (F.coalesce("_none", F.lit(0)) == 0) & (F.coalesce("_dnone", F.lit(0)) == 0)
    whole = F.col("_end").isNotNull() & ~F.col("_gap") & (F.unix_timestamp("_end") >= F.unix_timestamp("bucket_start") + 60)
    coverage = (
        F.when((F.coalesce("_rejected", F.lit(0)) > 0) | F.coalesce("_bad", F.lit(False)), "DEGRADED")
        .when(whole & one, "COMPLETE")
        .when(F.col("_end").isNotNull() | F.col("_dnone").isNotNull(), "PARTIAL")
        .otherwise("NO_COVERAGE")
    )
    out = joined.withColumn("coverage", coverage).withColumn("profile", F.when(F.size(profiles) == 1, profiles[0]))
    available = F.when(F.col("coverage") == "COMPLETE", "AVAILABLE").when(F.col("coverage") == "NO_COVERAGE", "UNAVAILABLE").otherwise("PARTIAL")
    return out.withColumn("availability", available).select(*minutes.columns, "coverage", "availability", "profile")


def routing_rollup(minutes: DataFrame, obs: DataFrame, granularity: str, at: str = "observed_at") -> DataFrame:
    """Rollup of materialised minutes (bucket_start, messages, coverage, availability, profile): complete only if every
    minute is there, complete, and of one profile; else the values are NULL. Sets are united from the observations."""
    big = bucket_start("bucket_start", granularity)
    good = (F.col("coverage") == "COMPLETE") & (F.col("availability") == "AVAILABLE")
    per = minutes.groupBy(big.alias("bucket")).agg(
        F.count("*").alias("rows"),
        F.count_if(good).alias("satisfied"),
        F.count_if(F.col("coverage") == "PARTIAL").alias("partial"),
        F.count_if(F.col("coverage") == "DEGRADED").alias("degraded"),
        (F.bool_and(good) & (F.count_distinct("profile") == 1) & (F.count("profile") == F.count("*"))).alias("_same"),
        F.sum("messages").alias("_messages"),
    )
    sets = set_columns(member_rows(obs, at, granularity), ["bucket_start"]).withColumnRenamed("bucket_start", "bucket")
    complete = (F.col("rows") == MINUTES[granularity]) & F.col("_same")
    coverage = F.when(complete, "COMPLETE").when(F.col("rows") == 0, "NO_COVERAGE").when(F.col("degraded") > 0, "DEGRADED").otherwise("PARTIAL")
    out = per.join(sets, "bucket", "left").withColumns({"coverage": coverage, "complete": complete, "expected": F.lit(MINUTES[granularity])})
    values = {"messages": F.when(F.col("complete"), F.col("_messages"))}
    values |= {c: F.when(F.col("complete"), F.coalesce(c, F.lit(0))) for c in ("n_prefixes", *(f"n_{s}" for s in SETS))}
    return out.withColumns(values).withColumn("missing", F.col("expected") - F.col("rows")).drop("_same", "_messages")


def due_buckets(buckets: DataFrame, granularity: str, now: Column) -> DataFrame:
    """Buckets that may be materialised: minutes always, larger ones once they have ended."""
    if granularity == "MINUTE":
        return buckets
    return buckets.where(F.unix_timestamp("bucket_start") + MINUTES[granularity] * 60 <= F.unix_timestamp(now))


def final_minutes(buckets: DataFrame, now: Column, lateness_s: int = LATENESS_S) -> DataFrame:
    """Minutes whose end lies lateness_s or more before now."""
    return buckets.where(F.unix_timestamp("bucket_start") + 60 + lateness_s <= F.unix_timestamp(now))


def late_minutes(obs: DataFrame, minutes: DataFrame, at: str = "observed_at") -> DataFrame:
    """bucket_start of minutes that hold other observations than their materialised row counted: late ones came since, or the
    row is missing."""
    seen = obs.groupBy(bucket_start(at, "MINUTE").alias("bucket_start")).agg(F.count("*").alias("_seen"))
    both = seen.join(minutes.select("bucket_start", F.col("messages").alias("_had")), "bucket_start", "left")
    return both.where(~F.col("_seen").eqNullSafe(F.col("_had"))).select("bucket_start")


def revised_minutes(obs: DataFrame, minutes: DataFrame, at: str = "observed_at", touched: DataFrame | None = None) -> DataFrame:
    """Minutes with late observations, counted anew from all that is kept of them; other minutes give no row. touched, the
    minutes (bucket_start) of newly arrived segments, spares the count of all observations: only these can be late."""
    dirty = late_minutes(obs, minutes, at) if touched is None else touched.select("bucket_start").distinct()
    own = obs.withColumn("_m", bucket_start(at, "MINUTE")).join(dirty.withColumnRenamed("bucket_start", "_m"), "_m", "left_semi").drop("_m")
    return routing_minutes(own, at)


def next_event(rows: DataFrame, key: Sequence[str], at: str, wanted: Column, name: str, span: str | None = "HOUR") -> DataFrame:
    """The time of the first wanted row later than each row of its key (forward as-of join; a row of the same time isn't later).

    Rows are ordered inside a span of time only, newest first, by a running minimum; what lies in later spans comes from one
    row for each span. So a busy key is dealt by time, and the work is linear. Without a span a key is ordered as a whole, as
    in `last_said`.
    """
    if span is None:
        whole = Window.partitionBy(*key).orderBy(F.unix_micros(F.col(at).cast("timestamp")).desc()).rangeBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, F.min(F.when(wanted, F.col(at))).over(whole))
    rows = rows.withColumns({"_span": bucket_start(at, span), "_w": F.when(wanted, F.col(at))})
    after = Window.partitionBy(*key).orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    later = rows.groupBy(*key, "_span").agg(F.min("_w").alias("_first")).withColumn("_later", F.min("_first").over(after)).drop("_first")
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    inside = Window.partitionBy(*key, "_span").orderBy(micros.desc()).rangeBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("_own", F.min("_w").over(inside)).join(later, [*key, "_span"])
    return found.withColumn(name, F.coalesce("_own", "_later")).drop("_span", "_w", "_own", "_later")


def recovery_candidates(events: DataFrame, key: Sequence[str], now: Column, most_s: int = 1800, settle_s: int = LATENESS_S, requested: DataFrame | None = None) -> DataFrame:
    """Gaps to recover. events: key (of the source), session, event_id, type, at.

    A gap is a failure of one of REASONS until the source's next SUBSCRIBED, by any session. It is left out if its session
    was asked to drain by then, if it is longer than most_s or not settled for settle_s, or if `requested` has its event_id.
    gap_start and gap_end are whole minutes around it.
    """
    drained = events.where(F.col("type") == DRAIN).groupBy(*key, "session").agg(F.min("at").alias("_drain"))
    gaps = next_event(events, key, "at", F.col("type") == "SUBSCRIBED", "resumed").where(F.col("type").isin(*REASONS) & F.col("resumed").isNotNull())
    gaps = gaps.join(drained, [*key, "session"], "left").where(F.col("_drain").isNull() | (F.col("_drain") > F.col("at")))
    if requested is not None:
        gaps = gaps.join(requested.select("event_id").distinct(), "event_id", "left_anti")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    gaps = gaps.where((micros("resumed") - micros("at") <= most_s * 1_000_000) & (micros("resumed") <= F.unix_micros(now) - settle_s * 1_000_000))
    end = F.timestamp_seconds(F.ceil(micros("resumed") / 60_000_000) * 60)
    return gaps.select("event_id", *key, "session", F.col("type").alias("reason"), bucket_start("at", "MINUTE").alias("gap_start"), end.alias("gap_end"))


def recovery_deltas(obs: DataFrame, spine: DataFrame, at: str = "observed_at") -> DataFrame:
    """Minute deltas of a recovered artefact over the whole spine: a minute without a message is a valid zero row."""
    return spine.join(routing_minutes(obs, at), "bucket_start", "left").fillna(0)


def recovery_completeness(projected: DataFrame, request: DataFrame, key: Sequence[str]) -> DataFrame:
    """Minutes with the collectors that a request expects and that were projected: missing ones, and the state."""
    seen = projected.groupBy(*key).agg(F.array_sort(F.collect_set("rrc")).alias("got"), F.sum("rejected").alias("rejected"))
    joined = request.join(seen, list(key), "left").withColumn("missing", F.array_except("expected", F.coalesce("got", F.array().cast("array<string>"))))
    state = F.when(F.coalesce("rejected", F.lit(0)) > 0, "DEGRADED").when(F.size("missing") == 0, "COMPLETE").otherwise("PARTIAL")
    return joined.withColumn("state", state)


def promote(live: DataFrame, recovered: DataFrame, key: Sequence[str]) -> DataFrame:
    """The effective row of each minute: live COMPLETE first, then complete recovery, then live, then other recovery. The live
    coverage stays in live_coverage."""
    l = live.select(*key, *[F.col(c).alias(f"l_{c}") for c in ("coverage", "messages")], F.lit(1).alias("_l"))
    r = recovered.select(*key, *[F.col(c).alias(f"r_{c}") for c in ("coverage", "messages")], F.lit(1).alias("_r"))
    both = l.join(r, list(key), "full_outer")
    use_live = (F.col("l_coverage") == "COMPLETE") | (F.col("_l").isNotNull() & ~F.coalesce(F.col("r_coverage") == "COMPLETE", F.lit(False)))
    pick = lambda c: F.when(F.coalesce(use_live, F.lit(False)), F.col(f"l_{c}")).otherwise(F.col(f"r_{c}"))
    basis = F.when(F.coalesce(use_live, F.lit(False)), LIVE).otherwise(RECOVERED)
    return both.select(*key, basis.alias("basis"), pick("coverage").alias("coverage"), pick("messages").alias("messages"), F.col("l_coverage").alias("live_coverage"))


def channel(basis: str) -> Column:
    """The channel of a basis; any other basis is its own."""
    return F.coalesce(*[F.when(F.col(basis) == b, c) for b, c in CHANNELS.items()], F.col(basis))


def routing_read(minutes: DataFrame, recovery: DataFrame, n: int = 120) -> DataFrame:
    """The newest n minutes as they are shown: minutes (bucket_start, basis, coverage, live_coverage, ...) with channel,
    recovered and recovery, which is the head of `recovery` (bucket_start, status, expected, projected, missing) where the
    minute was recovered. live_coverage stays what the live stream had: null means that of a live minute, else NO_COVERAGE."""
    heads = recovery.select("bucket_start", F.struct("status", "expected", "projected", "missing").alias("_head"))
    recovered = F.col("basis") == RECOVERED
    out = minutes.join(heads, "bucket_start", "left").withColumns(
        {"channel": channel("basis"), "recovered": recovered, "recovery": F.when(recovered, F.col("_head")), "live_coverage": F.coalesce("live_coverage", F.when(F.col("basis") == LIVE, F.col("coverage")).otherwise("NO_COVERAGE"))}
    )
    return out.drop("_head").orderBy(F.desc("bucket_start")).limit(n)
