"""Queries of the measurement and coverage operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import score_band
from tidemark.operators import coverage as C
from tidemark.operators import measure as M
from tidemark.plans.bindings import DAYS, END, EVENTS, FEEDS, KEYS, RUNS, START, WINDOWS, events, facts, feed_keys, runs, schedules, source_keys, stamp, table, windows
from tidemark.plans.registry import query

S = "'%Y-%m-%d %H:%M:%S'"
KEY = ["source_key"]
NOW = "2024-01-31 12:00:00"
AVAILABLE = f"""{KEYS}, {DAYS}, {WINDOWS}, av AS (SELECT t.source_key, d, CASE WHEN w_end IS NULL THEN 'UNAVAILABLE' WHEN w_end < d + INTERVAL 1 DAY OR availability = 'PARTIAL' THEN 'PARTIAL' ELSE 'AVAILABLE' END AS available
  FROM types t CROSS JOIN days LEFT JOIN win w ON w.source_key = t.source_key AND w.w_start = d)"""


@query(
    "measurement_daily_buckets",
    f"""WITH {AVAILABLE}, per AS (SELECT event_type, date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT a.source_key, strftime(a.d, {S}) AS bucket, a.available,
      CAST(CASE WHEN coalesce(n, 0) = 0 THEN CASE WHEN available = 'AVAILABLE' THEN 0 END ELSE n END AS BIGINT) AS value
    FROM av a LEFT JOIN per p ON p.event_type = a.source_key AND p.d = a.d""",
)
def daily_buckets(spark, d):
    """Gap-filled daily counts: zero only where a window proves that somebody looked."""
    buckets = M.aggregate(facts(spark, d), KEY, "event_time", ["DAY"], value="COUNT_EVENTS").drop("granularity")
    grid = M.spine(source_keys(spark, d), START, END, "DAY")
    available = M.interval_availability(grid, windows(spark, d), KEY, "DAY")
    out = M.series(source_keys(spark, d), buckets, KEY, START, END, "DAY", "SOURCE_TIME_AVAILABILITY_REQUIRED", available)
    return out.select("source_key", stamp("bucket_start").alias("bucket"), "available", F.col("gated").cast("bigint").alias("value"))


@query(
    "measurement_hourly_availability",
    f"""WITH {FEEDS}, {DAYS}, {WINDOWS}, hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS h)
    SELECT t.source_key, strftime(h, {S}) AS bucket, CASE WHEN w_end IS NULL THEN 'UNAVAILABLE' WHEN availability = 'PARTIAL' THEN 'PARTIAL' ELSE 'AVAILABLE' END AS available
    FROM types t CROSS JOIN hours LEFT JOIN win w ON w.source_key = t.source_key AND w_start < h + INTERVAL 1 HOUR AND w_end > h""",
)
def hourly_availability(spark, d):
    """Interval-overlap join of windows and hours, swept for gaps."""
    keys = feed_keys(spark, d)
    grid = M.spine(keys, START, END, "HOUR")
    return M.interval_availability(grid, windows(spark, d, keys), KEY, "HOUR").select("source_key", stamp("bucket_start").alias("bucket"), "available")


@query(
    "bucket_aggregates",
    f"""WITH g AS (SELECT * FROM (VALUES ('FIVE_MINUTES', 300), ('HOUR', 3600), ('DAY', 86400)) v(granularity, s))
    SELECT event_type AS source_key, granularity, strftime(make_timestamp(CAST(floor(epoch(ts) / s) * s AS BIGINT) * 1000000), {S}) AS bucket,
      count(*) AS n, count(DISTINCT user_id) AS entities, arg_max(value, (ts, event_id)) AS last_value
    FROM events, g GROUP BY 1, 2, 3""",
)
def bucket_aggregates(spark, d):
    """Counts, exact distinct entities and last values in 5-minute, hour and day buckets."""
    out = M.aggregate(facts(spark, d), KEY, "event_time", ["FIVE_MINUTES", "HOUR", "DAY"], n="COUNT_EVENTS", entities="COUNT_DISTINCT", last_value="SNAPSHOT_LAST")
    return out.select("source_key", "granularity", stamp("bucket_start").alias("bucket"), "n", "entities", "last_value")


@query(
    "first_seen_distinct",
    f"""WITH f AS (SELECT event_type, user_id, min(ts) AS t FROM events GROUP BY 1, 2)
    SELECT event_type AS source_key, strftime(date_trunc('day', t), {S}) AS bucket, count(*) AS first_seen FROM f GROUP BY 1, 2""",
)
def first_seen(spark, d):
    """Distinct entities by the day of their first fact in each source."""
    first = facts(spark, d).groupBy("source_key", "entity_key").agg(F.min("event_time").alias("event_time"))
    out = M.aggregate(first, KEY, "event_time", ["DAY"], first_seen="FIRST_SEEN_DISTINCT")
    return out.select("source_key", stamp("bucket_start").alias("bucket"), "first_seen")


@query(
    "carried_forward_daily",
    f"""WITH {KEYS}, {DAYS} SELECT t.source_key, strftime(d, {S}) AS bucket,
      (SELECT arg_max(value, (ts, event_id)) FROM events e WHERE e.event_type = t.source_key AND e.ts < d + INTERVAL 1 DAY) AS value FROM types t, days""",
)
def carried(spark, d):
    """The last value before each day's end, of any age, of all facts."""
    out = M.carried_forward(source_keys(spark, d), facts(spark, d), KEY, START, END, "DAY")
    return out.select("source_key", stamp("bucket_start").alias("bucket"), "value")


@query(
    "carried_forward_daily_all",
    f"""WITH {FEEDS}, {DAYS}, e AS (SELECT event_type || '/' || user_id AS source_key, ts, event_id, value FROM events), l AS (SELECT source_key, date_trunc('day', ts) AS d, arg_max(value, (ts, event_id)) AS v FROM e GROUP BY 1, 2),
    g AS (SELECT t.source_key, days.d, l.v FROM types t CROSS JOIN days LEFT JOIN l ON l.source_key = t.source_key AND l.d = days.d)
    SELECT source_key, strftime(d, {S}) AS bucket, last_value(v IGNORE NULLS) OVER (PARTITION BY source_key ORDER BY d) AS value FROM g""",
)
def carried_feeds(spark, d):
    """The last value before each day's end of every feed of a type and a user."""
    rows = facts(spark, d).withColumn("source_key", F.concat_ws("/", "source_key", "entity_key"))
    out = M.carried_forward(feed_keys(spark, d), rows, KEY, START, END, "DAY")
    return out.select("source_key", stamp("bucket_start").alias("bucket"), "value")


@query(
    "distribution_daily",
    f"""WITH c AS (SELECT date_trunc('day', ts) AS b, event_type AS member, count(*) AS n FROM events GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY n DESC, member) AS r FROM c),
    s AS (SELECT b, least(r, 4) AS rank, CASE WHEN max(r) > 3 THEN 'OTHER' ELSE max(member) END AS member, sum(n) AS n, max(r) > 3 AS is_other FROM r GROUP BY b, least(r, 4))
    SELECT strftime(b, {S}) AS bucket, CAST(rank AS INTEGER) AS rank, member, CAST(n AS BIGINT) AS n, is_other, round(n / sum(n) OVER (PARTITION BY b), 9) AS share FROM s""",
)
def distribution_daily(spark, d):
    """Top three members a day, the rest as OTHER, with rank and share."""
    rows = M.with_buckets(facts(spark, d), "event_time", ["DAY"])
    out = M.distribution(rows, ["bucket_start"], "source_key", 3)
    return out.select(stamp("bucket_start").alias("bucket"), "rank", "member", "n", "is_other", F.round("share", 9).alias("share"))


@query(
    "score_distribution",
    """SELECT CASE WHEN s < 0.2 THEN '0.0-0.2' WHEN s < 0.4 THEN '0.2-0.4' WHEN s < 0.6 THEN '0.4-0.6' WHEN s < 0.8 THEN '0.6-0.8' ELSE '0.8-1.0' END AS band, count(*) AS n
    FROM (SELECT (p_retailprice % 100) / 100 AS s FROM part) GROUP BY 1""",
)
def score_distribution(spark, d):
    """Records by score band."""
    scored = table(spark, d, "part").select(score_band((F.col("p_retailprice") % 100) / 100).alias("band"))
    return scored.groupBy("band").agg(M.aggregate_expr("DISTRIBUTION_COUNT").alias("n"))


@query(
    "dataset_availability",
    f"""WITH {FEEDS}, {DAYS}, {WINDOWS}, d2 AS (SELECT source_key, CAST(date_trunc('week', w_start) AS DATE) AS wk, availability FROM win)
    SELECT source_key, strftime(wk, '%Y-%m-%d') AS dataset_date, CASE WHEN bool_or(availability = 'AVAILABLE') THEN 'AVAILABLE' ELSE 'PARTIAL' END AS available FROM d2 GROUP BY 1, 2""",
)
def dataset_availability(spark, d):
    """The best status of each week's datasets."""
    w = windows(spark, d, feed_keys(spark, d)).withColumn("dataset_date", F.to_date(F.date_trunc("week", "start")))
    out = M.dataset_availability(w, KEY, "dataset_date")
    return out.select("source_key", F.date_format("dataset_date", "yyyy-MM-dd").alias("dataset_date"), "available")


SUMMARY_END = "2024-01-29 00:00:00"
COVERED = f"""{KEYS}, {DAYS}, {WINDOWS}, ok AS (SELECT t.source_key, count(*) FILTER (WHERE availability = 'AVAILABLE' AND w_start >= TIMESTAMP '2024-01-09') >= 3 AS cur, count(*) FILTER (WHERE availability = 'AVAILABLE' AND w_start < TIMESTAMP '2024-01-09') >= 4 AS prev
  FROM types t LEFT JOIN win w ON w.source_key = t.source_key AND w_start >= TIMESTAMP '2024-01-02' AND w_start < TIMESTAMP '2024-01-16' GROUP BY 1)"""


def compare_sql(value: str) -> str:
    return f"""WITH {COVERED}, v AS (SELECT event_type, {value.format(on="ts >= TIMESTAMP '2024-01-09'")} AS c, {value.format(on="ts < TIMESTAMP '2024-01-09'")} AS p FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1)
    SELECT source_key, CAST(CASE WHEN cur THEN coalesce(c, 0) END AS BIGINT) AS value, CAST(CASE WHEN prev THEN coalesce(p, 0) END AS BIGINT) AS previous_value,
      CASE WHEN NOT cur THEN 'CURRENT_NOT_COVERED' WHEN NOT prev THEN 'PREVIOUS_NOT_COVERED' ELSE 'COMPARABLE' END AS status,
      CAST(CASE WHEN cur AND prev THEN coalesce(c, 0) - coalesce(p, 0) END AS BIGINT) AS delta,
      round(CASE WHEN cur AND prev AND p <> 0 THEN (c - p) / p * 100 END, 6) AS percent
    FROM ok LEFT JOIN v ON event_type = source_key"""


def compared(spark, d, kind):
    w = windows(spark, d).where("start >= '2024-01-02' and start < '2024-01-16' and availability = 'AVAILABLE'")
    late = F.col("start") >= F.lit("2024-01-09").cast("timestamp")
    n = w.groupBy("source_key").agg(F.count_if(late).alias("c"), F.count_if(~late).alias("p"))
    ok = source_keys(spark, d).join(n, "source_key", "left").select("source_key", (F.coalesce("c", F.lit(0)) >= 3).alias("current_ok"), (F.coalesce("p", F.lit(0)) >= 4).alias("previous_ok"))
    out = M.compare(facts(spark, d), ok, KEY, kind, "2024-01-02 00:00:00", "2024-01-09 00:00:00", "2024-01-16 00:00:00")
    return out.select("source_key", F.col("value").cast("bigint").alias("value"), F.col("previous_value").cast("bigint").alias("previous_value"), "status", F.col("delta").cast("bigint").alias("delta"), F.round("percent", 6).alias("percent"))


@query("period_comparison_sum", compare_sql("count(*) FILTER (WHERE {on})"))
def comparison_sum(spark, d):
    """A week against the week before; covered periods only."""
    return compared(spark, d, "SUM_EVENTS")


@query("period_comparison_distinct", compare_sql("count(DISTINCT user_id) FILTER (WHERE {on})"))
def comparison_distinct(spark, d):
    return compared(spark, d, "EXACT_DISTINCT_QUERY")


@query(
    "period_summary",
    f"""WITH {KEYS}, {DAYS}, {WINDOWS}, p AS (SELECT * FROM (VALUES ('24H', 1), ('7D', 7), ('30D', 30)) v(period, n)), r AS (SELECT period, TIMESTAMP '{SUMMARY_END}' - n * INTERVAL 1 DAY AS a, n FROM p),
    ok AS (SELECT source_key, period, a, n, (SELECT count(*) FROM win w WHERE w.source_key = t.source_key AND availability = 'AVAILABLE' AND w_end = w_start + INTERVAL 1 DAY AND w_start >= a AND w_start < TIMESTAMP '{SUMMARY_END}') = n AS covered FROM types t, r),
    x AS (SELECT ok.*, count(event_id) AS c FROM ok LEFT JOIN events e ON e.event_type = ok.source_key AND ts >= a AND ts < TIMESTAMP '{SUMMARY_END}' GROUP BY ALL)
    SELECT source_key, period, CASE WHEN covered THEN c END AS value, CASE WHEN covered THEN 'AVAILABLE' ELSE 'INSUFFICIENT_COVERAGE' END AS status, CASE WHEN NOT covered THEN 'PERIOD_NOT_FULLY_COVERED' END AS reason FROM x""",
)
def period_summary(spark, d):
    """Values of the last day, week and month, only where windows cover the whole period."""
    grid = M.spine(source_keys(spark, d), START, END, "DAY")
    days = M.interval_availability(grid, windows(spark, d), KEY, "DAY").withColumn("covered", F.col("available") == "AVAILABLE")
    return M.period_summary(facts(spark, d), days, KEY, "SUM_EVENTS", SUMMARY_END).select("source_key", "period", F.col("value").cast("bigint").alias("value"), "status", "reason")


@query(
    "period_range_dual_precision",
    f"""WITH {EVENTS} SELECT event_type, count(*) AS n, count(*) FILTER (WHERE event_type = 'signup') AS dated FROM ev
    WHERE (event_type <> 'signup' AND ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 12:00:00') OR (event_type = 'signup' AND CAST(ts AS DATE) >= DATE '2024-01-05' AND CAST(ts AS DATE) < DATE '2024-01-09') GROUP BY 1""",
)
def dual_precision(spark, d):
    """A half-open range over instants and dates at once."""
    e = events(spark, d)
    dated = F.col("event_type") == "signup"
    rows = e.select("event_type", F.when(~dated, F.col("ts")).alias("event_time"), F.when(dated, F.to_date("ts")).alias("event_date"))
    inside = M.in_period(rows, "2024-01-05 06:00:00", "2024-01-09 12:00:00", date_col="event_date")
    return inside.groupBy("event_type").agg(F.count("*").alias("n"), F.count("event_date").alias("dated"))


def bucket_history(spark, d):
    """Revisions of daily counts: calculated on the day after and again three days later with late facts."""
    f = M.with_buckets(facts(spark, d), "event_time", ["DAY"])
    early = f.where("fact_key % 10 <> 3").groupBy("source_key", "bucket_start").agg(F.count("*").alias("value")).withColumns({"revision": F.lit(1), "calculated_at": F.timestamp_seconds(F.unix_timestamp("bucket_start") + 90000)})
    late = f.groupBy("source_key", "bucket_start").agg(F.count("*").alias("value")).withColumns({"revision": F.lit(2), "calculated_at": F.timestamp_seconds(F.unix_timestamp("bucket_start") + 345600)})
    return early.unionByName(late)


@query(
    "series_as_of",
    f"""WITH f AS (SELECT event_type, date_trunc('day', ts) AS b, event_id FROM events), h AS (SELECT event_type, b, count(*) AS v, 1 AS r, b + INTERVAL 25 HOUR AS c FROM f WHERE event_id % 10 <> 3 GROUP BY 1, 2
      UNION ALL SELECT event_type, b, count(*), 2, b + INTERVAL 96 HOUR FROM f GROUP BY 1, 2)
    SELECT event_type AS source_key, strftime(b, {S}) AS bucket, CAST(max(r) AS INTEGER) AS revision, arg_max(v, r) AS value FROM h WHERE c <= TIMESTAMP '2024-01-15 02:00:00' GROUP BY 1, 2""",
)
def as_of(spark, d):
    """What the daily series said at a moment."""
    out = M.series_as_of(bucket_history(spark, d), ["source_key", "bucket_start"], F.lit("2024-01-15 02:00:00").cast("timestamp"))
    return out.select("source_key", stamp("bucket_start").alias("bucket"), "revision", "value")


@query(
    "bucket_provenance",
    f"""WITH {EVENTS}, rev AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS revision FROM ev),
    k AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY revision DESC) AS rn FROM rev WHERE ts <= date_trunc('day', ts) + INTERVAL 18 HOUR)
    SELECT event_type AS source_key, strftime(date_trunc('day', ts), {S}) AS bucket, count(*) AS facts, CAST(sum(revision) AS BIGINT) AS revisions FROM k WHERE rn = 1 AND event_id % 7 <> 0 GROUP BY 1, 2""",
)
def bucket_provenance(spark, d):
    """Facts that a daily bucket calculated at 18:00 knew: newest revision known by then, and only if it was active."""
    from tidemark.plans.bindings import fact_revisions

    r = fact_revisions(spark, d).select(F.col("event_type").alias("source_key"), F.concat_ws("|", "user_id", "event_type", "day").alias("fact_key"), "revision", "state", F.col("ts").alias("event_time"), F.col("ts").alias("created_at"))
    b = M.spine(source_keys(spark, d), START, END, "DAY").withColumn("calculated_at", F.timestamp_seconds(F.unix_timestamp("bucket_start") + 64800))
    out = M.provenance(b, r, KEY, "DAY").groupBy("source_key", "bucket_start").agg(F.count("*").alias("facts"), F.sum("revision").cast("bigint").alias("revisions"))
    return out.select("source_key", stamp("bucket_start").alias("bucket"), "facts", "revisions")


#: After the 15th runs come twice as often as the schedule asks, so each of them is an anchor and no time falls between two.
OF_KEYS = f"""{DAYS}, {RUNS}, ex AS (SELECT source_key, t FROM types, (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 18:00:00', INTERVAL 6 HOUR)) AS t)
    WHERE t <= TIMESTAMP '2024-01-15' OR EXISTS (SELECT 1 FROM runs r WHERE r.source_key = types.source_key AND r.scheduled_for = t)),
  oc AS (SELECT ex.source_key, date_trunc('day', t) AS d, CASE WHEN r.state IS NULL OR trigger_kind <> 'SCHEDULED' THEN 'MISSING' WHEN r.state = 'SUCCEEDED' THEN 'SATISFIED' ELSE r.state END AS o FROM ex LEFT JOIN runs r ON r.source_key = ex.source_key AND r.scheduled_for = ex.t),
  cov AS (SELECT source_key, d, count(*) AS expected, count(*) FILTER (WHERE o = 'SATISFIED') AS satisfied, count(*) FILTER (WHERE o = 'PARTIAL') AS partial, count(*) FILTER (WHERE o = 'FAILED') AS failed, count(*) FILTER (WHERE o = 'MISSING') AS missing FROM oc GROUP BY 1, 2),
  st AS (SELECT *, CASE WHEN satisfied = expected THEN 'COMPLETE' WHEN satisfied + partial > 0 THEN 'PARTIAL' WHEN failed > 0 THEN 'DEGRADED' ELSE 'NO_COVERAGE' END AS status FROM cov)"""


EXPECTED, EXPECTED_FEEDS = f"{KEYS}, {OF_KEYS}", f"{FEEDS}, {OF_KEYS}"


def day_coverage(spark, d, keys):
    grid = M.spine(keys, START, END, "DAY")
    return C.schedule_coverage(schedules(spark, d, keys), runs(spark, d, keys), grid, KEY, START, END, 86400, F.lit(NOW).cast("timestamp"))


@query("schedule_coverage_daily", f"WITH {EXPECTED_FEEDS} SELECT source_key, strftime(d, {S}) AS bucket, expected, satisfied, partial, failed, missing, status, 'FINAL' AS evaluation FROM st")
def schedule_coverage_daily(spark, d):
    """Expected times of a changing schedule against runs: counts, status and evaluation of each day."""
    return day_coverage(spark, d, feed_keys(spark, d)).select("source_key", stamp("bucket_start").alias("bucket"), "expected", "satisfied", "partial", "failed", "missing", "status", "evaluation")


@query(
    "schedule_evaluation_daily",
    f"""WITH {EXPECTED_FEEDS}, rs AS (SELECT ex.source_key, date_trunc('day', t) AS d, array_to_string(list_sort(list_distinct(list(CASE WHEN r.state IS NULL THEN 'EXPECTED_RUN_MISSING' WHEN trigger_kind <> 'SCHEDULED' THEN 'NON_LIVE_RUN_DOES_NOT_PROVE_COVERAGE' ELSE 'SCHEDULED_RUN_' || r.state END))), ',') AS reasons
      FROM ex LEFT JOIN runs r ON r.source_key = ex.source_key AND r.scheduled_for = ex.t GROUP BY 1, 2),
    k AS (SELECT *, split_part(source_key, '/', 1) AS kind FROM st JOIN rs USING (source_key, d))
    SELECT source_key, strftime(d, {S}) AS bucket, CASE WHEN d < TIMESTAMP '2024-01-15' THEN '2024-01-01' ELSE '2024-01-15' END AS schedule, CASE kind WHEN 'error' THEN 'UNKNOWN' WHEN 'signup' THEN 'NOT_EXPECTED' WHEN 'view' THEN 'NOT_EXPECTED' ELSE 'EXPECTED' END AS expectation,
      CASE WHEN kind IN ('error', 'signup', 'view') THEN 'NO_COVERAGE' ELSE status END AS status, 'FINAL' AS evaluation, CASE WHEN kind IN ('error', 'signup', 'view') THEN 0 ELSE expected END AS expected, CASE WHEN kind IN ('error', 'signup', 'view') THEN 0 ELSE missing END AS missing,
      CASE kind WHEN 'error' THEN 'SCHEDULE_EXPECTATION_UNKNOWN' WHEN 'signup' THEN 'SOURCE_NOT_EXPECTED' WHEN 'view' THEN 'NO_SCHEDULED_CADENCE' ELSE reasons END AS reasons FROM k""",
)
def schedule_evaluation(spark, d):
    """Every day of every feed under its schedule, with reasons; some feeds are off, without a cadence, or of unknown origin."""
    keys = feed_keys(spark, d)
    kind = F.substring_index("source_key", "/", 1)
    own = schedules(spark, d, keys).withColumns({"enabled": kind != "signup", "interval_s": F.when(kind != "view", F.col("interval_s")), "origin": F.when(kind == "error", "UNKNOWN").otherwise("KNOWN")})
    out = C.schedule_evaluation(own, runs(spark, d, keys), M.spine(keys, START, END, "DAY"), KEY, START, END, 86400, F.lit(NOW).cast("timestamp"))
    return out.select("source_key", stamp("bucket_start").alias("bucket"), F.date_format("effective_from", "yyyy-MM-dd").alias("schedule"), "expectation", "status", "evaluation", "expected", "missing", F.array_join("reasons", ",").alias("reasons"))


@query(
    "coverage_rollup_weekly",
    f"""WITH {EXPECTED_FEEDS} SELECT source_key, strftime(date_trunc('week', d), {S}) AS week, CASE WHEN bool_or(status = 'NO_COVERAGE') THEN 'NO_COVERAGE' WHEN bool_or(status IN ('PARTIAL', 'DEGRADED')) THEN 'PARTIAL' ELSE 'COMPLETE' END AS coverage FROM st GROUP BY 1, 2""",
)
def coverage_weekly(spark, d):
    rows = day_coverage(spark, d, feed_keys(spark, d)).withColumn("week", stamp(F.date_trunc("week", "bucket_start")))
    return M.coverage_rollup(rows, ["source_key", "week"], "status")


@query(
    "gated_by_coverage_daily",
    f"""WITH {EXPECTED}, per AS (SELECT event_type, date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT s.source_key, strftime(s.d, {S}) AS bucket, CAST(CASE WHEN coalesce(n, 0) = 0 THEN CASE WHEN status = 'COMPLETE' THEN 0 END WHEN status <> 'NO_COVERAGE' THEN n END AS BIGINT) AS value FROM st s LEFT JOIN per p ON p.event_type = s.source_key AND p.d = s.d""",
)
def gated_by_coverage(spark, d):
    """A live policy: zero needs complete coverage, numbers need some."""
    buckets = M.aggregate(facts(spark, d), KEY, "event_time", ["DAY"], value="COUNT_EVENTS").drop("granularity")
    cov = day_coverage(spark, d, source_keys(spark, d)).select("source_key", "bucket_start", F.col("status").alias("coverage"))
    out = M.series(source_keys(spark, d), buckets, KEY, START, END, "DAY", "SOURCE_COVERAGE_REQUIRED", cov)
    return out.select("source_key", stamp("bucket_start").alias("bucket"), F.col("gated").cast("bigint").alias("value"))


@query(
    "gated_by_coverage_daily_all",
    f"""WITH {EXPECTED_FEEDS}, per AS (SELECT event_type || '/' || user_id AS source_key, date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT s.source_key, strftime(s.d, {S}) AS bucket, CAST(CASE WHEN coalesce(n, 0) = 0 THEN CASE WHEN status = 'COMPLETE' THEN 0 END WHEN status <> 'NO_COVERAGE' THEN n END AS BIGINT) AS value FROM st s LEFT JOIN per p ON p.source_key = s.source_key AND p.d = s.d""",
)
def gated_feeds(spark, d):
    """The live policy for every feed of a type and a user."""
    keys = feed_keys(spark, d)
    rows = facts(spark, d).withColumn("source_key", F.concat_ws("/", "source_key", "entity_key"))
    buckets = M.aggregate(rows, KEY, "event_time", ["DAY"], value="COUNT_EVENTS").drop("granularity")
    cov = day_coverage(spark, d, keys).select("source_key", "bucket_start", F.col("status").alias("coverage"))
    out = M.series(keys, buckets, KEY, START, END, "DAY", "SOURCE_COVERAGE_REQUIRED", cov)
    return out.select("source_key", stamp("bucket_start").alias("bucket"), F.col("gated").cast("bigint").alias("value"))


@query(
    "combined_segments",
    f"""WITH {FEEDS}, {DAYS}, s AS (SELECT source_key, date_trunc('week', d) AS w, CASE WHEN dayofmonth(d) % 5 = 0 THEN 'NOT_EXPECTED' WHEN dayofmonth(d) % 13 = 0 THEN 'UNKNOWN' ELSE 'EXPECTED' END AS e,
      CASE (dayofmonth(d) + length(source_key)) % 6 WHEN 0 THEN 'PARTIAL' WHEN 1 THEN 'DEGRADED' ELSE 'COMPLETE' END AS st FROM types, days)
    SELECT source_key, strftime(w, {S}) AS week, CASE WHEN bool_or(e = 'EXPECTED') THEN 'EXPECTED' WHEN bool_or(e = 'UNKNOWN') THEN 'UNKNOWN' ELSE 'NOT_EXPECTED' END AS expectation,
      CASE WHEN bool_or(e = 'EXPECTED') AND bool_and(e <> 'EXPECTED' OR st = 'COMPLETE') AND NOT bool_or(e = 'UNKNOWN') THEN 'COMPLETE' WHEN bool_or(e = 'EXPECTED' AND st IN ('COMPLETE', 'PARTIAL')) THEN 'PARTIAL'
        WHEN bool_or(e = 'EXPECTED' AND st = 'DEGRADED') THEN 'DEGRADED' ELSE 'NO_COVERAGE' END AS status FROM s GROUP BY 1, 2""",
)
def combined_segments(spark, d):
    """Segments of differing expectation put together, week by week."""
    grid = M.spine(feed_keys(spark, d), START, END, "DAY")
    day = F.dayofmonth("bucket_start")
    m = (day + F.length("source_key")) % 6
    rows = grid.select("source_key", stamp(F.date_trunc("week", "bucket_start")).alias("week"), F.when(day % 5 == 0, "NOT_EXPECTED").when(day % 13 == 0, "UNKNOWN").otherwise("EXPECTED").alias("expectation"), F.when(m == 0, "PARTIAL").when(m == 1, "DEGRADED").otherwise("COMPLETE").alias("status"))
    return C.combine_segments(rows, ["source_key", "week"])


@query(
    "acquisition_windows",
    f"""WITH {FEEDS}, {RUNS} SELECT source_key, CASE WHEN split_part(source_key, '/', 1) IN ('click', 'view') THEN 'INTERVAL' WHEN split_part(source_key, '/', 1) = 'error' THEN 'SNAPSHOT' ELSE 'DATASET_DATE' END AS kind,
      CASE WHEN split_part(source_key, '/', 1) IN ('click', 'view') THEN strftime(scheduled_for - INTERVAL 6 HOUR, {S}) WHEN split_part(source_key, '/', 1) = 'error' THEN strftime(scheduled_for, {S}) END AS w_start,
      CASE WHEN split_part(source_key, '/', 1) IN ('click', 'view', 'error') THEN strftime(scheduled_for, {S}) END AS w_end,
      CASE WHEN split_part(source_key, '/', 1) IN ('purchase', 'signup') THEN strftime(scheduled_for, '%Y-%m-%d') END AS dataset_date, CASE WHEN state = 'SUCCEEDED' THEN 'AVAILABLE' ELSE 'PARTIAL' END AS availability FROM runs WHERE state <> 'FAILED'""",
)
def acquisition_windows(spark, d):
    """Windows that runs prove, by a rule for each source."""
    k, keys = F.substring_index("source_key", "/", 1), feed_keys(spark, d)
    rules = keys.select("source_key", F.when(k.isin("click", "view"), "INTERVAL").when(k == "error", "SNAPSHOT").otherwise("DATASET_DATE").alias("kind"), F.lit(21600).alias("horizon_s"))
    out = C.acquisition_windows(runs(spark, d, keys), rules)
    return out.select("source_key", "kind", stamp("start").alias("w_start"), stamp("end").alias("w_end"), F.date_format("dataset_date", "yyyy-MM-dd").alias("dataset_date"), "availability")


UNITS = """un AS (SELECT o_custkey AS run, o_orderkey AS unit, CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'CANCELLED' ELSE 'FAILED' END ELSE 'RUNNING' END AS state, o_orderdate AS a, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + (o_orderkey % 40) * INTERVAL 1 DAY END AS b FROM orders),
  uw AS (SELECT run % 50 AS src, run, unit, a, b, CASE WHEN state = 'SUCCEEDED' THEN 'AVAILABLE' WHEN state = 'RUNNING' THEN 'PARTIAL' ELSE 'UNAVAILABLE' END AS availability FROM un WHERE b IS NOT NULL AND run % 4 <> 3)"""


def order_windows(spark, d):
    """Customers are runs of fifty sources, their orders work units of 0 to 39 days; lines of the first number bring manifests."""
    o, n = table(spark, d, "orders"), F.col("o_orderkey")
    state = F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(F.col("o_orderstatus") == "O", F.when(n % 3 == 0, "CANCELLED").otherwise("FAILED")).otherwise("RUNNING")
    begin = F.col("o_orderdate").cast("timestamp")
    units = o.select(F.col("o_custkey").alias("run_id"), n.alias("unit_id"), state.alias("state"), begin.alias("window_start"), F.when(n % 11 != 0, F.timestamp_seconds(F.unix_timestamp(begin) + (n % 40) * 86400)).alias("window_end"))
    c = F.col("c_custkey")
    own = table(spark, d, "customer").select(c.alias("run_id"), (c % 50).cast("string").alias("source_key"), F.when(c % 4 == 3, "FAILED").otherwise("SUCCEEDED").alias("state"), F.lit("2024-01-01").cast("timestamp").alias("scheduled_for"), F.lit("2024-01-01").cast("timestamp").alias("created_at"))
    rules = own.select("source_key").distinct().select("source_key", F.lit("WORK_UNITS").alias("kind"), F.lit(None).cast("int").alias("horizon_s"))
    return C.acquisition_windows(own.where("run_id % 4 <> 3"), rules, units)


@query("work_unit_windows", f"WITH {UNITS} SELECT CAST(src AS VARCHAR) AS source_key, run AS run_id, strftime(a, {S}) AS w_start, strftime(b, {S}) AS w_end, availability, CASE availability WHEN 'AVAILABLE' THEN 'COMPLETE' WHEN 'PARTIAL' THEN 'PARTIAL' ELSE 'UNRECOVERABLE' END AS recovery, 'UPSTREAM_UPDATED_TIME' AS axis FROM uw")
def work_unit_windows(spark, d):
    """The windows that work units prove, each by its own state."""
    return order_windows(spark, d).select("source_key", "run_id", stamp("start").alias("w_start"), stamp("end").alias("w_end"), "availability", "recovery", "axis")


@query(
    "merged_windows",
    f"""WITH {UNITS}, r AS (SELECT *, max(b) OVER (PARTITION BY src ORDER BY epoch(a) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM uw WHERE b > a), i AS (SELECT *, max(CASE WHEN reach IS NULL OR reach < a THEN a END) OVER (PARTITION BY src ORDER BY a RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM r)
    SELECT CAST(src AS VARCHAR) AS source_key, strftime(island, {S}) AS w_start, strftime(max(b), {S}) AS w_end, count(*) AS n, CASE WHEN bool_or(availability = 'UNAVAILABLE') THEN 'UNAVAILABLE' WHEN bool_or(availability = 'PARTIAL') THEN 'PARTIAL' ELSE 'AVAILABLE' END AS availability FROM i GROUP BY src, island""",
)
def merged_windows(spark, d):
    """Windows of each source that overlap or touch, as one; the worst of them counts."""
    return C.merged_windows(order_windows(spark, d), KEY).select("source_key", stamp("start").alias("w_start"), stamp("end").alias("w_end"), "n", "availability")


@query(
    "manifest_windows",
    """SELECT CAST(l_suppkey % 20 AS VARCHAR) AS source_key, l_suppkey AS run_id, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS dataset_date, CASE l_suppkey % 3 WHEN 0 THEN 'AVAILABLE' WHEN 1 THEN 'PARTIAL' ELSE 'UNAVAILABLE' END AS availability
    FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL""",
)
def manifest_windows(spark, d):
    """The dataset dates that the manifests of each run name, once each; lines of other numbers are records of other kinds."""
    s = F.col("s_suppkey")
    own = table(spark, d, "supplier").select(s.alias("run_id"), (s % 20).cast("string").alias("source_key"), F.when(s % 3 == 0, "SUCCEEDED").when(s % 3 == 1, "PARTIAL").otherwise("FAILED").alias("state"), F.lit("2024-01-01").cast("timestamp").alias("scheduled_for"), F.lit("2024-01-01").cast("timestamp").alias("created_at"))
    rules = own.select("source_key").distinct().select("source_key", F.lit("MANIFEST").alias("kind"), F.lit(None).cast("int").alias("horizon_s"))
    brought = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("run_id"), F.when(F.col("l_linenumber") == 1, C.MANIFEST_KIND).otherwise("SCORE").alias("kind"), F.col("l_shipdate").cast("date").alias("dataset_date"))
    out = C.acquisition_windows(own, rules, manifests=brought)
    return out.select("source_key", "run_id", F.date_format("dataset_date", "yyyy-MM-dd").alias("dataset_date"), "availability")


@query(
    "coverage_read",
    f"""WITH {EXPECTED_FEEDS} SELECT source_key, 'COVERAGE' AS kind, strftime(d, {S}) AS at, status FROM st WHERE d >= TIMESTAMP '2024-01-10' AND d < TIMESTAMP '2024-01-13'
    UNION ALL SELECT source_key, 'WINDOW', strftime(w_start, {S}), availability FROM (WITH {FEEDS}, {DAYS}, {WINDOWS} SELECT * FROM win) WHERE w_start < TIMESTAMP '2024-01-13' AND w_end > TIMESTAMP '2024-01-10'""",
)
def coverage_read(spark, d):
    """Coverage of the buckets of a range, and the windows that overlap it."""
    a, b = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-13").cast("timestamp")
    keys = feed_keys(spark, d)
    own = M.in_period(day_coverage(spark, d, keys), "2024-01-10", "2024-01-13", "bucket_start").select("source_key", F.lit("COVERAGE").alias("kind"), stamp("bucket_start").alias("at"), "status")
    near = windows(spark, d, keys).where((F.col("start") < b) & (F.col("end") > a))
    return own.unionByName(near.select("source_key", F.lit("WINDOW").alias("kind"), stamp("start").alias("at"), F.col("availability").alias("status")))


@query(
    "distribution_read",
    f"""WITH c AS (SELECT date_trunc('day', ts) AS b, user_id, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY n DESC, CAST(user_id AS VARCHAR)) AS r FROM c)
    SELECT strftime(b, {S}) AS bucket, CAST(r AS INTEGER) AS rank, CAST(user_id AS VARCHAR) AS member, n FROM r WHERE r <= 5""",
)
def distribution_read(spark, d):
    """The first five ranks of each day's users (the length that the reader asks for)."""
    rows = M.with_buckets(facts(spark, d), "event_time", ["DAY"])
    out = M.distribution(rows, ["bucket_start"], "entity_key", 20).where("rank <= 5 and not is_other")
    return out.select(stamp("bucket_start").alias("bucket"), "rank", "member", "n")


@query(
    "measurement_fan_out",
    """SELECT m AS measurement_key, count(*) AS n, count(DISTINCT user_id) AS entities FROM events, (VALUES ('received', 1), ('published', 2), ('updated', 3)) v(m, o) WHERE event_type IN ('click', 'purchase') AND (o < 3 OR event_id % 3 = 0) GROUP BY 1""",
)
def fan_out(spark, d):
    """Records times the measurements of their source, each on its own time axis."""
    from tidemark.plans.catalogue import Measurement, definitions_frame
    from tidemark.plans.catalogue import fan_out as fan

    axes = {"received": "RECEIVED", "published": "PUBLISHED", "updated": "UPSTREAM_UPDATED"}
    own = [Measurement(f"{s}.{m}", "COUNT_EVENTS", a, ("DAY",), "SOURCE_TIME_AVAILABILITY_REQUIRED") for s in ("click", "purchase") for m, a in axes.items()]
    e = events(spark, d)
    records = e.select(F.col("event_type").alias("source_key"), "user_id", F.col("ts").alias("received_at"), F.col("ts").alias("published_at"), F.when(F.col("event_id") % 3 == 0, F.col("ts")).alias("updated_at"), F.lit(None).cast("timestamp").alias("effective_at"))
    rows = fan(records, definitions_frame(spark, own))
    return rows.groupBy(F.element_at(F.split("measurement_key", "[.]"), 2).alias("measurement_key")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("entities"))


@query(
    "distribution_without_other",
    f"""WITH c AS (SELECT date_trunc('day', ts) AS b, event_type AS member, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY n DESC, member) AS r FROM c)
    SELECT 'top' AS kind, strftime(b, {S}) AS bucket, CAST(r AS INTEGER) AS rank, member, n, round(n / sum(n) OVER (PARTITION BY b), 9) AS share FROM (SELECT * FROM r WHERE r <= 2) UNION ALL SELECT 'all', strftime(b, {S}), CAST(r AS INTEGER), member, n, round(n / sum(n) OVER (PARTITION BY b), 9) FROM r""",
)
def distribution_without_other(spark, d):
    """The first two members a day without the rest, and all of them; shares are those of what is shown."""
    rows = M.with_buckets(facts(spark, d), "event_time", ["DAY"])
    parts = [M.distribution(rows, ["bucket_start"], "source_key", top, include_other=False).withColumn("kind", F.lit(kind)) for kind, top in (("top", 2), ("all", None))]
    return parts[0].unionByName(parts[1]).select("kind", stamp("bucket_start").alias("bucket"), "rank", "member", "n", F.round("share", 9).alias("share"))


@query(
    "published_comparison",
    """WITH e AS (SELECT event_type || '/' || user_id AS source_key, user_id AS u, ts >= TIMESTAMP '2024-01-16' AS now, value, ts, event_id, CASE WHEN user_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-16' THEN 'm2' WHEN user_id % 3 > 0 THEN 'm1' END AS model, CASE WHEN user_id % 7 = 0 AND event_id % 2 = 0 THEN 'p2' ELSE 'p1' END AS profile FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-30'),
    k AS (SELECT DISTINCT event_type || '/' || user_id AS source_key, user_id AS u FROM events), g AS (SELECT source_key, arg_max(value, (ts, event_id)) FILTER (WHERE now) AS c, arg_max(value, (ts, event_id)) FILTER (WHERE NOT now) AS p,
      list_sort(list_distinct(list(model) FILTER (WHERE now))) AS mc, list_sort(list_distinct(list(model) FILTER (WHERE NOT now))) AS mp, list_sort(list_distinct(list(profile) FILTER (WHERE now))) AS pc, list_sort(list_distinct(list(profile) FILTER (WHERE NOT now))) AS pp FROM e GROUP BY 1),
    r AS (SELECT k.source_key, c, p, CASE WHEN u % 11 = 0 OR u % 13 = 0 THEN 'CURRENT_OR_PREVIOUS_PERIOD_NOT_FULLY_COVERED' WHEN coalesce(list_filter(mc, lambda x: x IS NOT NULL), []) <> coalesce(list_filter(mp, lambda x: x IS NOT NULL), []) OR coalesce(pc, []) <> coalesce(pp, []) THEN 'SOURCE_MODEL_OR_POPULATION_PROFILE_CHANGED' WHEN c IS NULL OR p IS NULL THEN 'COMPARISON_VALUE_UNAVAILABLE' END AS reason FROM k LEFT JOIN g USING (source_key))
    SELECT source_key, CASE WHEN reason IS NULL THEN 'AVAILABLE' WHEN reason LIKE 'CURRENT%' THEN 'INSUFFICIENT_COVERAGE' WHEN reason LIKE 'SOURCE%' THEN 'INCOMPATIBLE_SOURCE_MODEL' ELSE 'UNSUPPORTED' END AS status, reason, CASE WHEN reason IS NULL OR reason LIKE 'COMPARISON%' THEN c END AS value, CASE WHEN reason IS NULL OR reason LIKE 'COMPARISON%' THEN p END AS previous_value,
      round(CASE WHEN reason IS NULL AND p <> 0 THEN (c - p) / p * 100 END, 6) AS percent FROM r""",
)
def published_comparison(spark, d):
    """The last value of two weeks against that of the two before, for every feed: covered, of one model and one profile."""
    u, late = F.col("entity_key"), F.col("event_time") >= F.lit("2024-01-16").cast("timestamp")
    rows = facts(spark, d).withColumns({"model": F.when((u % 5 == 0) & late, "m2").when(u % 3 > 0, "m1"), "profile": F.when((u % 7 == 0) & (F.col("fact_key") % 2 == 0), "p2").otherwise("p1"), "source_key": F.concat_ws("/", "source_key", "entity_key")})
    n = F.substring_index("source_key", "/", -1).cast("long")
    covered = feed_keys(spark, d).select("source_key", (n % 11 != 0).alias("current_ok"), (n % 13 != 0).alias("previous_ok"))
    out = M.compare_published(rows, covered, KEY, "LAST_VALUE", "2024-01-02", "2024-01-16", "2024-01-30", same_model=True, same_profile=True)
    return out.select("source_key", "status", "reason", "value", "previous_value", F.round("percent", 6).alias("percent"))


@query(
    "definition_reasons",
    """WITH d AS (SELECT p_partkey AS n FROM part), r AS (SELECT n, unnest(list_filter([CASE WHEN n % 7 = 0 THEN 'MEASUREMENT_KEY_PATTERN' END, CASE WHEN n % 5 = 0 THEN 'CONTRACT_VERSION_PATTERN' END, CASE WHEN n % 11 = 0 THEN 'SOURCE_KEYS_COUNT' END, CASE WHEN n % 13 = 0 THEN 'GRANULARITY_UNKNOWN' END,
      CASE WHEN n % 2 = 0 AND (n % 3 = 0 OR n % 13 = 0) THEN 'DATE_PRECISION_FINER_THAN_DAY' END, CASE WHEN n % 4 = 1 AND n % 9 > 0 THEN 'DISTRIBUTION_WITHOUT_DIMENSION' END], lambda x: x IS NOT NULL)) AS reason FROM d) SELECT reason, count(*) AS n FROM r GROUP BY 1""",
)
def definition_reasons(spark, d):
    """Definitions that break the contract, by reason: patterns, counts, and rules between columns."""
    from tidemark.operators.contracts import validate_definitions

    n = F.col("p_partkey")
    text = F.lit("x")
    fine = F.when(n % 13 == 0, F.array(F.lit("WEEK"))).when(n % 3 == 0, F.array(F.lit("HOUR"), F.lit("DAY"))).otherwise(F.array(F.lit("DAY")))
    rows = table(spark, d, "part").select(
        F.concat(F.when(n % 7 == 0, "A.").otherwise("a."), n).alias("measurement_key"), F.when(n % 5 == 0, "2").otherwise("v2").alias("contract_version"), F.lit("COUNT").alias("unit"), *[text.alias(c) for c in ("display_label", "description", "represents", "does_not_represent")],
        F.when(n % 11 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("NVD_CVE"))).alias("source_keys"), F.array().cast("array<string>").alias("record_kinds"), fine.alias("granularities"), F.when(n % 9 == 0, F.array(F.lit("D"))).otherwise(F.array().cast("array<string>")).alias("dimensions"),
        F.when(n % 4 == 1, "DISTRIBUTION").otherwise("COUNT").alias("value_kind"), F.when(n % 2 == 0, "DATE").otherwise("INSTANT").alias("time_precision"),
    )
    return validate_definitions(rows)[1].select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "fact_reasons",
    """WITH r AS (SELECT unnest(list_filter([CASE WHEN event_id % 10 IN (0, 1) THEN 'TIME_EXACTLY_ONE' END, CASE WHEN event_id % 10 = 1 OR event_id % 10 = 2 THEN 'INSTANT_WITHOUT_TIME' END, CASE WHEN event_id % 10 = 3 THEN 'DATE_WITHOUT_DATE' END, CASE WHEN event_id % 10 = 4 THEN 'PRECISION_UNKNOWN' END, CASE WHEN event_id % 7 = 0 THEN 'STATE_UNKNOWN' END, CASE WHEN event_id % 9 = 0 THEN 'VALUE_NOT_FINITE' END], lambda x: x IS NOT NULL)) AS reason FROM events) SELECT reason, count(*) AS n FROM r GROUP BY 1""",
)
def fact_reasons(spark, d):
    """Facts that break the contract, by reason: both times or none, times of another precision, unknown states, no number."""
    from tidemark.operators.contracts import validate_facts

    e = events(spark, d)
    k = F.col("event_id") % 10
    rows = e.select(
        F.when(~k.isin(1, 2), F.col("ts")).alias("event_time"), F.when(k.isin(0, 2), F.to_date("ts")).alias("event_date"), F.when(k == 3, "DATE").when(k == 4, "WEEK").otherwise("INSTANT").alias("time_precision"),
        F.when(F.col("event_id") % 7 == 0, "GONE").otherwise("ACTIVE").alias("fact_state"), F.when(F.col("event_id") % 18 == 0, float("nan")).when(F.col("event_id") % 9 == 0, float("inf")).otherwise(F.col("value")).alias("value"),
    )
    return validate_facts(rows)[1].select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "fan_out_by_kind",
    """SELECT m AS measurement_key, count(*) AS n FROM events, (VALUES ('any', ''), ('clicks', 'click'), ('both', 'click,view')) v(m, kinds) WHERE kinds = '' OR list_contains(string_split(kinds, ','), event_type) GROUP BY 1""",
)
def fan_out_by_kind(spark, d):
    """Records times the measurements that take their kind."""
    from tidemark.plans.catalogue import fan_out as fan

    kinds = {"any": [], "clicks": ["click"], "both": ["click", "view"]}
    definitions = spark.createDataFrame([("s", m, "EFFECTIVE", k) for m, k in kinds.items()], "source_key string, measurement_key string, axis string, record_kinds array<string>")
    none = F.lit(None).cast("timestamp")
    records = events(spark, d).select(F.lit("s").alias("source_key"), F.col("event_type").alias("record_kind"), F.col("ts").alias("effective_at"), none.alias("received_at"), none.alias("published_at"), none.alias("updated_at"))
    return fan(records, definitions).groupBy("measurement_key").agg(F.count("*").alias("n"))
