"""Queries of the routing operators over observations made of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import canonical_prefix, ip_version
from tidemark.operators import measure as M
from tidemark.operators import prefixes as PX
from tidemark.operators import routing as R
from tidemark.operators import routing_sets as RS
from tidemark.operators.revisions import heads
from tidemark.plans.bindings import END, EVENTS, ROUTING, START, events, routing, sessions, stamp, whole_sessions
from tidemark.plans.registry import query
from tidemark.streaming import routing_state as RT

S = "'%Y-%m-%d %H:%M:%S'"


def sets_sql(bucket: str) -> str:
    """Counters and set sizes of a bucket of ro."""
    return f"""SELECT {bucket} AS b, count(*) AS messages, count(*) FILTER (WHERE event_type <> 'error') * 2 AS announcements, count(*) FILTER (WHERE event_type = 'view') AS withdrawals,
      count(DISTINCT origin) AS n_origins, count(DISTINCT peer) AS n_peers, count(DISTINCT rrc) AS n_rrcs,
      count(DISTINCT CASE WHEN event_type <> 'error' THEN small END) + count(DISTINCT CASE WHEN event_type <> 'error' THEN big END) AS n_prefixes,
      count(DISTINCT CASE WHEN event_type = 'view' THEN small END) AS n_withdrawn FROM ro GROUP BY 1"""


@query(
    "routing_minutes",
    f"WITH {ROUTING}, x AS ({sets_sql('m')}) SELECT strftime(b, {S}) AS minute, messages, announcements, withdrawals, n_prefixes, n_withdrawn, n_origins, n_peers, n_rrcs FROM x",
)
def routing_minutes(spark, d):
    """Exact set-valued minutes: events and sizes of the sets."""
    out = R.routing_minutes(routing(spark, d))
    return out.select(stamp("bucket_start").alias("minute"), "messages", "announcements", "withdrawals", "n_prefixes", "n_withdrawn", "n_origins", "n_peers", "n_rrcs")


@query(
    "routing_combined_deltas",
    f"""WITH {ROUTING}, seg AS (SELECT date_trunc('hour', ts) AS b, event_id % 3 AS seg, count(*) AS messages FROM ro GROUP BY 1, 2), a AS (SELECT b, count(*) AS segments, CAST(sum(messages) AS BIGINT) AS messages FROM seg GROUP BY 1),
    p AS (SELECT date_trunc('hour', ts) AS b, array_to_string(list_sort(list_distinct(list(CAST(origin AS VARCHAR)))), ',') AS origins, array_to_string(list_sort(list_distinct(list(rrc))), ',') AS rrcs FROM ro GROUP BY 1)
    SELECT strftime(b, {S}) AS hour, segments, messages, origins, rrcs FROM a JOIN p USING (b)""",
)
def combined_deltas(spark, d):
    """Segment deltas of each hour: counters summed, sets united."""
    rows = routing(spark, d).withColumn("segment", F.col("event_id") % 3).withColumn("hour", F.date_trunc("hour", "observed_at"))
    key = ["hour", "segment"]
    origins = rows.select(*key, F.explode("origins").alias("o")).distinct().groupBy(*key).agg(F.collect_list("o").alias("origins"))
    deltas = rows.groupBy(*key).agg(F.count("*").alias("messages"), F.collect_set("rrc").alias("rrcs")).join(origins, key)
    out = R.combine_deltas(deltas, ["hour"], ["messages"], ["origins", "rrcs"])
    return out.select(stamp("hour").alias("hour"), "segments", "messages", F.array_join("origins", ",").alias("origins"), F.array_join("rrcs", ",").alias("rrcs"))


def minutes_with_coverage(spark, d):
    """Every minute of the range with its messages and coverage; minutes of the 20th have rejects."""
    obs = routing(spark, d)
    b = M.bucket_start("observed_at", "MINUTE").alias("bucket_start")
    counts = obs.groupBy(b).agg(F.count("*").alias("messages"))
    day = F.dayofmonth("bucket_start")
    data = counts.select("bucket_start", F.when(day == 20, 1).otherwise(0).alias("rejected"), F.when(day < 15, "p1").otherwise("p2").alias("profile"))
    spine = M.spine(spark.range(1).select(F.lit(1).alias("one")), START, END, "MINUTE").select("bucket_start")
    return R.minute_coverage(spine, sessions(spark, d), data).join(counts, "bucket_start", "left").fillna(0, ["messages"])


MINUTES = f"""{ROUTING}, mi AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:59:00', INTERVAL 1 MINUTE)) AS b), ct AS (SELECT m AS b, count(*) AS n FROM ro GROUP BY 1),
  mc AS (SELECT mi.b, coalesce(n, 0) AS messages, CASE WHEN (n > 0 AND dayofmonth(mi.b) = 20) OR (dayofmonth(mi.b) % 9 = 0 AND hour(mi.b) < 23) THEN 'DEGRADED' WHEN hour(mi.b) < 23 THEN 'COMPLETE' WHEN n > 0 THEN 'PARTIAL' ELSE 'NO_COVERAGE' END AS coverage FROM mi LEFT JOIN ct USING (b))"""


@query("routing_minute_coverage", f"WITH {MINUTES} SELECT strftime(b, {S}) AS minute, messages, coverage, CASE coverage WHEN 'COMPLETE' THEN 'AVAILABLE' WHEN 'NO_COVERAGE' THEN 'UNAVAILABLE' ELSE 'PARTIAL' END AS availability FROM mc")
def minute_coverage(spark, d):
    """Coverage of every minute from sessions, rejects and data; zero minutes included."""
    return minutes_with_coverage(spark, d).select(stamp("bucket_start").alias("minute"), "messages", "coverage", "availability")


def covered_minutes(spark, d, watched):
    """Every minute of the range with its counters, sets and coverage, from one scan of the observations."""
    day = F.dayofmonth("bucket_start")
    rows = RS.minute_rows(routing(spark, d)).withColumns({"rejected": F.when(day == 20, 1).otherwise(0), "data_profile": F.when(day < 15, "p1").otherwise("p2")})
    spine = M.spine(spark.range(1).select(F.lit(1).alias("one")), START, END, "MINUTE").select("bucket_start")
    return RS.covered(spine.join(rows, "bucket_start", "left").fillna(0, list(RS.COUNTERS)), watched)


def rollup_sql(bucket: str, n: int, watched: str) -> str:
    """Rollups of n minutes; watched says when a minute lies in a session."""
    value = lambda c, name: f"CAST(CASE WHEN satisfied = {n} THEN coalesce({c}, 0) END AS BIGINT) AS {name}"
    return f"""WITH {ROUTING}, mi AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:59:00', INTERVAL 1 MINUTE)) AS b), ct AS (SELECT m AS b, count(*) AS n FROM ro GROUP BY 1),
      mc AS (SELECT mi.b, coalesce(n, 0) AS messages, CASE WHEN (n > 0 AND dayofmonth(mi.b) = 20) OR (dayofmonth(mi.b) % 9 = 0 AND ({watched})) THEN 'DEGRADED' WHEN {watched} THEN 'COMPLETE' WHEN n > 0 THEN 'PARTIAL' ELSE 'NO_COVERAGE' END AS coverage FROM mi LEFT JOIN ct USING (b)),
      h AS (SELECT {bucket.format("b")} AS h, count(*) AS n_rows, count(*) FILTER (WHERE coverage = 'COMPLETE') AS satisfied, count(*) FILTER (WHERE coverage = 'PARTIAL') AS partial, count(*) FILTER (WHERE coverage = 'DEGRADED') AS degraded FROM mc GROUP BY 1),
      x AS ({sets_sql(bucket.format("ts"))})
      SELECT strftime(h, {S}) AS bucket, n_rows, satisfied, partial, degraded, CASE WHEN satisfied = {n} THEN 'COMPLETE' WHEN degraded > 0 THEN 'DEGRADED' ELSE 'PARTIAL' END AS coverage,
        {", ".join(value(f"x.{c}", c) for c in ("messages", "announcements", "withdrawals", "n_prefixes", "n_withdrawn", "n_origins", "n_peers", "n_rrcs"))}, {value("x.announcements + x.withdrawals", "v4_events")}
      FROM h LEFT JOIN x ON x.b = h.h"""


def rolled(spark, d, granularity, watched):
    out = RS.rollup(covered_minutes(spark, d, watched), granularity)
    return out.select(stamp("bucket").alias("bucket"), F.col("rows").alias("n_rows"), "satisfied", "partial", "degraded", "coverage", "messages", "announcements", "withdrawals", "n_prefixes", "n_withdrawn", "n_origins", "n_peers", "n_rrcs", "v4_events")


EVEN_DAYS = "hour(mi.b) < 23 OR dayofmonth(mi.b) % 2 = 0"


@query("routing_five_minute_rollup", rollup_sql("time_bucket(INTERVAL 5 MINUTE, {})", 5, "hour(mi.b) < 23"))
def five_minute_rollup(spark, d):
    """Five minutes as ORs of minutes: complete or NULL."""
    return rolled(spark, d, "FIVE_MINUTES", sessions(spark, d))


@query("routing_hour_rollup", rollup_sql("date_trunc('hour', {})", 60, "hour(mi.b) < 23"))
def hour_rollup(spark, d):
    """Hours as ORs of minutes: complete or NULL; distinct counts from the identities."""
    return rolled(spark, d, "HOUR", sessions(spark, d))


@query("routing_day_rollup", rollup_sql("date_trunc('day', {})", 1440, EVEN_DAYS))
def day_rollup(spark, d):
    """Days as ORs of minutes; even days are watched until midnight and complete, unless degraded."""
    return rolled(spark, d, "DAY", whole_sessions(spark, d))


@query(
    "routing_merged_segments",
    f"WITH {ROUTING}, x AS ({sets_sql('m')}), k AS (SELECT m AS b, count(DISTINCT event_id % 3) AS segments FROM ro GROUP BY 1) SELECT strftime(b, {S}) AS minute, segments, messages, announcements, withdrawals, n_withdrawn, n_origins, n_peers, n_rrcs FROM x JOIN k USING (b)",
)
def merged_segments(spark, d):
    """Minutes of three segments apiece, coded by one dictionary, merged by OR."""
    obs = routing(spark, d).withColumn("segment", F.col("event_id") % 3)
    codes = RS.dictionary(RS.set_rows(obs))
    out = RS.set_sizes(RS.merge(RS.minute_rows(obs, known=codes, keep=["segment"])))
    return out.select(stamp("bucket_start").alias("minute"), "segments", "messages", "announcements", "withdrawals", "n_withdrawn", "n_origins", "n_peers", "n_rrcs")


CLOSED_AT = "2024-01-30 12:34:56"


def closed_sql(size: int, unit: str) -> str:
    """Buckets of each collector that have closed, zeros included; every 97th event is a rejected line."""
    count = lambda c, on="TRUE": f"count(DISTINCT CASE WHEN {on} THEN {c} END)"
    return f"""WITH {ROUTING}, z AS (SELECT floor((epoch(TIMESTAMP '{CLOSED_AT}') - 180) / 60) * 60 AS e), f AS (SELECT rrc, epoch(min(m)) AS a FROM ro GROUP BY 1),
      sp AS (SELECT rrc, a, unnest(generate_series(CAST(floor(a / {size}) * {size} AS BIGINT), CAST(e - {size} AS BIGINT), {size})) AS s FROM f, z),
      x AS (SELECT rrc, CAST(epoch(date_trunc('{unit}', ts)) AS BIGINT) AS s, count(*) AS messages, 2 * count(*) FILTER (WHERE event_type <> 'error') AS announcements, count(*) FILTER (WHERE event_type = 'view') AS withdrawals,
        {count("small", "event_type <> 'error'")} + {count("big", "event_type <> 'error'")} AS n_prefixes, {count("small", "event_type = 'view'")} AS n_withdrawn, {count("origin")} AS n_origins, {count("peer")} AS n_peers FROM ro WHERE event_id % 97 <> 0 GROUP BY 1, 2),
      r AS (SELECT rrc, CAST(epoch(date_trunc('{unit}', ts)) AS BIGINT) AS s, count(*) AS rejected FROM ro WHERE event_id % 97 = 0 GROUP BY 1, 2)
      SELECT sp.rrc, strftime(make_timestamp(sp.s * 1000000), {S}) AS bucket, CAST((sp.s + {size} - greatest(sp.s, a)) // 60 AS BIGINT) AS minutes, (sp.s + {size} - greatest(sp.s, a)) // 60 = {size // 60} AND coalesce(rejected, 0) = 0 AS complete,
        coalesce(rejected, 0) AS rejected, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("messages", "announcements", "withdrawals", "n_prefixes", "n_withdrawn", "n_origins", "n_peers"))}
      FROM sp LEFT JOIN x ON x.rrc = sp.rrc AND x.s = sp.s LEFT JOIN r ON r.rrc = sp.rrc AND r.s = sp.s"""


def closed_buckets(spark, d, granularity):
    obs = routing(spark, d).withColumn("rejected", F.col("event_id") % 97 == 0)
    out = RT.closed(RT.keyed(obs, F.lit("ris")), granularity, F.lit(CLOSED_AT).cast("timestamp"))
    return out.select("rrc", stamp("bucket_start").alias("bucket"), "minutes", "complete", "rejected", "messages", "announcements", "withdrawals", "n_prefixes", "n_withdrawn", "n_origins", "n_peers")


@query("routing_closed_minutes", closed_sql(60, "minute"))
def closed_minutes(spark, d):
    """What the stateful stream says of each collector's minutes: closed ones, zeros and rejects included."""
    return closed_buckets(spark, d, "MINUTE")


@query("routing_closed_hours", closed_sql(3600, "hour"))
def closed_hours(spark, d):
    """The stream's hours, from closed minutes."""
    return closed_buckets(spark, d, "HOUR")


@query(
    "covering_prefix",
    f"""WITH {ROUTING}, ip AS (SELECT DISTINCT '10.' || (user_id % 12) || '.' || (event_id % 40) || '.' || (event_id % 200) AS ip FROM events),
    px AS (SELECT small AS prefix, 24 AS len FROM ro WHERE event_type <> 'error' UNION SELECT big, 16 FROM ro WHERE event_type <> 'error'),
    m AS (SELECT ip, prefix, len FROM ip JOIN px ON (len = 24 AND regexp_extract(ip, '^(\\d+\\.\\d+\\.\\d+)\\.', 1) || '.0/24' = prefix) OR (len = 16 AND regexp_extract(ip, '^(\\d+\\.\\d+)\\.', 1) || '.0.0/16' = prefix))
    SELECT ip.ip, arg_max(prefix, len) AS covering FROM ip LEFT JOIN m USING (ip) GROUP BY 1""",
)
def covering_prefix(spark, d):
    """Longest-prefix match of addresses."""
    e = events(spark, d)
    ips = e.select(F.concat_ws(".", F.lit("10"), F.col("user_id") % 12, F.col("event_id") % 40, F.col("event_id") % 200).alias("ip")).distinct()
    return PX.covering_prefix(ips, routing(spark, d).select(F.explode("announced").alias("prefix")))


@query(
    "covering_minutes",
    f"""WITH {ROUTING}, ip AS (SELECT DISTINCT '10.' || (user_id % 12) || '.' || (event_id % 40) || '.1' AS ip FROM events),
    px AS (SELECT m, small AS prefix, 24 AS len, bool_or(event_type <> 'error') AS announced, bool_or(event_type = 'view') AS withdrawn FROM ro WHERE event_type <> 'error' GROUP BY 1, 2
      UNION ALL SELECT m, big, 16, true, false FROM ro WHERE event_type <> 'error' GROUP BY 1, 2),
    ips AS (SELECT ip, regexp_extract(ip, '^(\\d+\\.\\d+\\.\\d+)\\.', 1) || '.0/24' AS p FROM ip UNION ALL SELECT ip, regexp_extract(ip, '^(\\d+\\.\\d+)\\.', 1) || '.0.0/16' FROM ip),
    b AS (SELECT ip, m, prefix, announced, withdrawn FROM ips JOIN px ON p = prefix QUALIFY row_number() OVER (PARTITION BY ip, m ORDER BY len DESC) = 1)
    SELECT ip, strftime(m, {S}) AS minute, prefix AS covering, announced, withdrawn FROM b""",
)
def covering_minutes(spark, d):
    """The most specific prefix of each minute for each address."""
    ips = events(spark, d).select(F.concat_ws(".", F.lit("10"), F.col("user_id") % 12, F.col("event_id") % 40, F.lit("1")).alias("ip")).distinct()
    return PX.covering_minutes(ips, routing(spark, d)).select("ip", stamp("bucket_start").alias("minute"), "covering", "announced", "withdrawn")


@query(
    "covering_prefix_v6",
    """WITH ip AS (SELECT DISTINCT user_id % 300 AS u, event_id % 50 AS e FROM events), px AS (SELECT DISTINCT user_id % 40 AS u, event_id % 20 AS e FROM events)
    SELECT '2001:db8:' || lower(to_hex(u)) || '::' || lower(to_hex(e)) AS ip, CASE WHEN (u, e) IN (SELECT (u, e) FROM px) THEN '2001:DB8:' || lower(to_hex(u)) || '::' || lower(to_hex(e)) || '/128' WHEN u IN (SELECT u FROM px) THEN '2001:0db8:' || lower(to_hex(u)) || '::/48' END AS covering FROM ip""",
)
def covering_prefix_v6(spark, d):
    """Longest-prefix match of IPv6 addresses, written in other ways than the prefixes."""
    e = events(spark, d)
    low = lambda c, n: F.lower(F.hex(F.col(c) % n))
    ips = e.select(F.concat(F.lit("2001:db8:"), low("user_id", 300), F.lit("::"), low("event_id", 50)).alias("ip")).distinct()
    host = F.concat(F.lit("2001:DB8:"), low("user_id", 40), F.lit("::"), low("event_id", 20), F.lit("/128"))
    net = F.concat(F.lit("2001:0db8:"), low("user_id", 40), F.lit("::/48"))
    return PX.covering_prefix(ips, e.select(F.explode(F.array(host, net)).alias("prefix")))


@query(
    "geo_assertions_by_prefix",
    """WITH e AS (SELECT event_id, user_id % 12 AS a, event_id % 40 AS b FROM events), s AS (SELECT *, CASE WHEN a = 5 AND b < 20 THEN '10.' || a || '.' || b || '.0/24' WHEN a = 7 AND b % 2 = 0 THEN '10.7.' || b || '.0/24' WHEN a < 10 THEN '10.' || a || '.0.0/16' END AS covering FROM e)
    SELECT event_id, covering, CASE WHEN a = 5 AND b < 20 THEN 'C' || (b % 5) ELSE 'N' || a END AS country FROM s WHERE covering IS NOT NULL AND NOT (a = 7 AND b % 2 = 0) AND NOT (a = 5 AND b < 20 AND b % 5 = 4)""",
)
def geo_by_prefix(spark, d):
    """Countries by the most specific prefix: some narrow ones are bogons or have no country, and hide the wider one's."""
    e = events(spark, d)
    a, b = F.col("user_id") % 12, F.col("event_id") % 40
    obs = e.select("event_id", F.concat_ws(".", F.lit("10"), a, b, F.col("event_id") % 200).alias("ip"))
    rows = e.select(a.alias("a"), b.alias("b")).distinct()
    wide = rows.where("a < 10").select(F.concat(F.lit("10."), "a", F.lit(".0.0/16")).alias("prefix"), F.concat(F.lit("N"), "a").alias("country"), F.lit(None).cast("boolean").alias("bogon"))
    at = F.concat(F.lit("10."), "a", F.lit("."), "b", F.lit(".0/24"))
    narrow = rows.where("a = 5 and b < 20").select(at, F.when(F.col("b") % 5 != 4, F.concat(F.lit("C"), F.col("b") % 5)), F.lit(False)).union(rows.where("a = 7 and b % 2 = 0").select(at, F.lit("X"), F.lit(True)))
    return PX.geo_by_prefix(obs, wide.distinct().union(narrow)).select("event_id", "covering", "country")


@query(
    "revised_minutes",
    f"""WITH {ROUTING}, late AS (SELECT DISTINCT m FROM ro WHERE event_id % 3 = 0), x AS ({sets_sql('m')}) SELECT strftime(b, {S}) AS minute, messages, announcements, n_prefixes, n_origins FROM x JOIN late ON b = m""",
)
def revised_minutes(spark, d):
    """Minutes that late observations make dirty, counted anew; every third event comes late."""
    obs = routing(spark, d)
    had = R.routing_minutes(obs.where("event_id % 3 <> 0"))
    return R.revised_minutes(obs, had).select(stamp("bucket_start").alias("minute"), "messages", "announcements", "n_prefixes", "n_origins")


@query(
    "final_and_due",
    f"""WITH {ROUTING}, now AS (SELECT TIMESTAMP '2024-01-20 12:30:30' AS t), a AS (SELECT 'MINUTE' AS granularity, m AS b FROM ro, now WHERE epoch(m) + 240 <= floor(epoch(t)) GROUP BY 2 UNION ALL SELECT 'HOUR', date_trunc('hour', ts) FROM ro, now GROUP BY 2, t HAVING epoch(date_trunc('hour', any_value(ts))) + 3600 <= floor(epoch(t))
      UNION ALL SELECT 'DAY', date_trunc('day', ts) FROM ro, now GROUP BY 2, t HAVING epoch(date_trunc('day', any_value(ts))) + 86400 <= floor(epoch(t)))
    SELECT granularity, count(*) AS n, strftime(max(b), {S}) AS last FROM a GROUP BY 1""",
)
def final_and_due(spark, d):
    """Minutes past their lateness, and hours and days that have ended, at one moment."""
    obs = routing(spark, d)
    now = F.lit("2024-01-20 12:30:30").cast("timestamp")
    parts = []
    for g in ("MINUTE", "HOUR", "DAY"):
        own = obs.select(F.date_trunc(g, "observed_at").alias("bucket_start")).distinct()
        due = R.final_minutes(own, now) if g == "MINUTE" else R.due_buckets(own, g, now)
        parts.append(due.select(F.lit(g).alias("granularity"), "bucket_start"))
    return parts[0].union(parts[1]).union(parts[2]).groupBy("granularity").agg(F.count("*").alias("n"), stamp(F.max("bucket_start")).alias("last"))


#: Fixed values of the fixture: errors are failures of these types in turn (the last is none that is recovered), by event id.
FAILED = ["PROVIDER_DISCONNECT", "BACKPRESSURE_LIMIT", "DB_UNAVAILABLE", "FORCED_TERMINATE", "DRAIN_REQUESTED", "CLOSED"]


def session_events(spark, d):
    """Errors are failures or drain requests, signups subscriptions; one source for every third user, a session a user."""
    e = events(spark, d).where("event_type in ('error', 'signup')")
    kind = F.when(F.col("event_type") == "signup", "SUBSCRIBED").otherwise(F.get(F.array(*[F.lit(x) for x in FAILED]), (F.col("event_id") % len(FAILED)).cast("int")))
    return e.select("event_id", (F.col("user_id") % 3).alias("rrc"), F.col("user_id").alias("session"), F.col("ts").alias("at"), kind.alias("type"))


FAILURES = f"""{EVENTS}, fe AS (SELECT event_id, user_id % 3 AS rrc, user_id AS session, ts AS t0, CASE WHEN event_type = 'signup' THEN 'SUBSCRIBED' ELSE {FAILED}[event_id % {len(FAILED)} + 1] END AS type FROM ev WHERE event_type IN ('error', 'signup')),
  nx AS (SELECT *, min(CASE WHEN type = 'SUBSCRIBED' THEN t0 END) OVER (PARTITION BY rrc ORDER BY epoch_us(t0) RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS resumed FROM fe)"""


@query("next_event", f"WITH {FAILURES} SELECT rrc, type, count(*) AS n, count(resumed) AS resumed, round(avg(epoch(resumed) - epoch(t0)), 3) AS mean_s FROM nx WHERE type <> 'SUBSCRIBED' GROUP BY 1, 2")
def next_event(spark, d):
    """Forward as-of join: the first subscription after each failure."""
    rows = R.next_event(session_events(spark, d), ["rrc"], "at", F.col("type") == "SUBSCRIBED", "resumed").where("type <> 'SUBSCRIBED'")
    gap = (F.unix_micros("resumed") - F.unix_micros("at")) / 1e6
    return rows.groupBy("rrc", "type").agg(F.count("*").alias("n"), F.count("resumed").alias("resumed"), F.round(F.avg(gap), 3).alias("mean_s"))


@query(
    "recovery_candidates",
    f"""WITH {FAILURES}, g AS (SELECT event_id, rrc, session, type AS reason, date_trunc('minute', t0) AS a, CASE WHEN resumed = date_trunc('minute', resumed) THEN resumed ELSE date_trunc('minute', resumed) + INTERVAL 1 MINUTE END AS b FROM nx
      WHERE type IN ('PROVIDER_DISCONNECT', 'BACKPRESSURE_LIMIT', 'DB_UNAVAILABLE', 'FORCED_TERMINATE') AND resumed - t0 <= INTERVAL 1800 SECOND AND resumed + INTERVAL 180 SECOND <= TIMESTAMP '2024-01-25' AND event_id % 7 <> 0
        AND NOT EXISTS (SELECT 1 FROM fe q WHERE q.session = nx.session AND q.type = 'DRAIN_REQUESTED' AND q.t0 <= nx.t0))
    SELECT event_id, rrc, session, reason, strftime(a, {S}) AS gap_start, strftime(b, {S}) AS gap_end FROM g""",
)
def recovery_candidates(spark, d):
    """Short settled gaps that nobody planned or asked for yet (every seventh event has a request)."""
    rows = session_events(spark, d)
    out = R.recovery_candidates(rows, ["rrc"], F.lit("2024-01-25").cast("timestamp"), requested=rows.where("event_id % 7 = 0"))
    return out.select("event_id", "rrc", "session", "reason", stamp("gap_start").alias("gap_start"), stamp("gap_end").alias("gap_end"))


@query(
    "recovered_minutes_with_zeros",
    f"""WITH {ROUTING}, mi AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-10 06:00:00', TIMESTAMP '2024-01-10 11:59:00', INTERVAL 1 MINUTE)) AS b), x AS ({sets_sql('m')})
    SELECT strftime(mi.b, {S}) AS minute, coalesce(messages, 0) AS messages, coalesce(announcements, 0) AS announcements, coalesce(n_prefixes, 0) AS n_prefixes FROM mi LEFT JOIN x USING (b)""",
)
def recovered_minutes(spark, d):
    """A recovered artefact projected on its minutes: an empty minute is a valid zero."""
    spine = M.spine(spark.range(1).select(F.lit(1).alias("one")), "2024-01-10 06:00:00", "2024-01-10 12:00:00", "MINUTE").select("bucket_start")
    obs = M.in_period(routing(spark, d), "2024-01-10 06:00:00", "2024-01-10 12:00:00", "observed_at")
    return R.recovery_deltas(obs, spine).select(stamp("bucket_start").alias("minute"), "messages", "announcements", "n_prefixes")


@query(
    "recovery_completeness",
    f"""WITH {ROUTING}, g AS (SELECT date_trunc('hour', ts) AS b, list_sort(list_distinct(list(rrc))) AS got, count(*) FILTER (WHERE event_id % 97 = 0) AS rejected FROM ro GROUP BY 1), hr AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS b)
    SELECT strftime(hr.b, {S}) AS hour, array_to_string(list_filter(['rrc00', 'rrc01', 'rrc02'], lambda x: NOT list_contains(coalesce(got, []), x)), ',') AS missing,
      CASE WHEN coalesce(rejected, 0) > 0 THEN 'DEGRADED' WHEN len(coalesce(got, [])) = 3 THEN 'COMPLETE' ELSE 'PARTIAL' END AS state FROM hr LEFT JOIN g USING (b)""",
)
def recovery_completeness(spark, d):
    """Collectors that a recovery expected and didn't bring, hour by hour."""
    projected = routing(spark, d).select(F.date_trunc("hour", "observed_at").alias("hour"), "rrc", F.when(F.col("event_id") % 97 == 0, 1).otherwise(0).alias("rejected"))
    request = M.spine(spark.range(1).select(F.lit(1).alias("one")), START, END, "HOUR").select(F.col("bucket_start").alias("hour"), F.array(*[F.lit(f"rrc0{i}") for i in range(3)]).alias("expected"))
    out = R.recovery_completeness(projected, request, ["hour"])
    return out.select(stamp("hour").alias("hour"), F.array_join("missing", ",").alias("missing"), "state")


PROMOTED = f"""{ROUTING}, l AS (SELECT m, count(*) AS n, CASE extract(minute FROM m) % 3 WHEN 0 THEN 'COMPLETE' WHEN 1 THEN 'PARTIAL' ELSE 'DEGRADED' END AS c FROM ro WHERE event_id % 4 <> 0 GROUP BY 1),
    r AS (SELECT m, count(*) AS n, CASE WHEN extract(minute FROM m) % 5 = 0 THEN 'PARTIAL' ELSE 'COMPLETE' END AS c FROM ro GROUP BY 1),
    pm AS (SELECT r.m, CASE WHEN l.c = 'COMPLETE' OR (l.c IS NOT NULL AND r.c <> 'COMPLETE') THEN 'LIVE_STREAM' ELSE 'MRT_RECOVERY' END AS basis, CASE WHEN l.c = 'COMPLETE' OR (l.c IS NOT NULL AND r.c <> 'COMPLETE') THEN l.c ELSE r.c END AS coverage,
      CASE WHEN l.c = 'COMPLETE' OR (l.c IS NOT NULL AND r.c <> 'COMPLETE') THEN l.n ELSE r.n END AS messages, l.c AS live_coverage FROM r LEFT JOIN l USING (m))"""


def promoted_minutes(spark, d):
    obs = routing(spark, d).withColumn("minute", F.date_trunc("minute", "observed_at"))
    k = F.minute("minute") % 3
    live = obs.where("event_id % 4 <> 0").groupBy("minute").agg(F.count("*").alias("messages")).withColumn("coverage", F.when(k == 0, "COMPLETE").when(k == 1, "PARTIAL").otherwise("DEGRADED"))
    rec = obs.groupBy("minute").agg(F.count("*").alias("messages")).withColumn("coverage", F.when(F.minute("minute") % 5 == 0, "PARTIAL").otherwise("COMPLETE"))
    return R.promote(live, rec, ["minute"])


@query("promoted_minutes", f"WITH {PROMOTED} SELECT strftime(m, {S}) AS minute, basis, coverage, messages, live_coverage FROM pm")
def promoted(spark, d):
    """Live and recovered minutes merged without counting twice."""
    return promoted_minutes(spark, d).withColumn("minute", stamp("minute"))


@query(
    "routing_read_model",
    f"""WITH {PROMOTED}, rr AS (SELECT m, count(DISTINCT rrc) AS projected, array_to_string(list_filter(['rrc00', 'rrc01', 'rrc02'], lambda x: NOT list_contains(list(DISTINCT rrc), x)), ',') AS missing FROM ro GROUP BY 1)
    SELECT strftime(m, {S}) AS minute, messages, basis, CASE basis WHEN 'MRT_RECOVERY' THEN 'RIS_MRT_UPDATE' ELSE 'RIS_LIVE_WEBSOCKET' END AS channel, coalesce(live_coverage, CASE WHEN basis = 'LIVE_STREAM' THEN coverage ELSE 'NO_COVERAGE' END) AS live_coverage, basis = 'MRT_RECOVERY' AS recovered,
      CASE WHEN basis = 'MRT_RECOVERY' THEN CASE WHEN projected = 3 THEN 'COMPLETE' ELSE 'PARTIAL' END END AS recovery_status, CASE WHEN basis = 'MRT_RECOVERY' THEN projected END AS projected, CASE WHEN basis = 'MRT_RECOVERY' THEN missing END AS missing
    FROM pm JOIN rr USING (m) ORDER BY m DESC LIMIT 500""",
)
def read_model(spark, d):
    """The newest minutes with their channel, and the recovery of those that were recovered."""
    seen = routing(spark, d).groupBy(F.date_trunc("minute", "observed_at").alias("bucket_start")).agg(F.collect_set("rrc").alias("rrcs"))
    expected = F.array(*[F.lit(f"rrc0{i}") for i in range(3)])
    heads_ = seen.select("bucket_start", F.when(F.size("rrcs") == 3, "COMPLETE").otherwise("PARTIAL").alias("status"), F.size(expected).alias("expected"), F.size("rrcs").alias("projected"), F.array_except(expected, "rrcs").alias("missing"))
    out = R.routing_read(promoted_minutes(spark, d).withColumnRenamed("minute", "bucket_start"), heads_, 500)
    return out.select(stamp("bucket_start").alias("minute"), "messages", "basis", "channel", "live_coverage", "recovered", F.col("recovery.status").alias("recovery_status"), F.col("recovery.projected").alias("projected"), F.array_join("recovery.missing", ",").alias("missing"))


@query(
    "routing_read_latest",
    f"""WITH {MINUTES} SELECT strftime(b, {S}) AS minute, messages, coverage, CASE WHEN dayofmonth(b) < 15 THEN 'p1' ELSE 'p2' END AS profile FROM (SELECT * FROM mc WHERE hour(b) < 23 ORDER BY b DESC LIMIT 120)""",
)
def routing_read(spark, d):
    """The newest two hours of covered minutes with their profile."""
    rows = minutes_with_coverage(spark, d).where(F.hour("bucket_start") < 23)
    return rows.orderBy(F.desc("bucket_start")).limit(120).select(stamp("bucket_start").alias("minute"), "messages", "coverage", "profile")


@query(
    "latest_prefix_per_peer",
    f"WITH {ROUTING} SELECT peer, arg_max(small, (ts, event_id)) AS prefix FROM ro WHERE event_type <> 'error' GROUP BY 1",
)
def latest_prefix(spark, d):
    """The newest announcement of every peer."""
    rows = routing(spark, d).where("size(announced) > 0")
    return heads(rows, ["peer"], [F.desc("observed_at"), F.desc("event_id")]).select("peer", F.col("announced")[0].alias("prefix"))


@query(
    "canonical_prefixes",
    """WITH x AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN ' 10.' || user_id % 256 || '.1.0/24 ' WHEN 1 THEN '2001:DB8:' || user_id || '::/48' WHEN 2 THEN '10.0.0.0' WHEN 3 THEN repeat('1', 70) || '/8' ELSE '10.0.0.' || user_id || '/33x' END AS p, event_id % 5 AS k FROM events)
    SELECT event_id, CASE WHEN k < 2 THEN lower(trim(p)) END AS prefix, CASE k WHEN 0 THEN 4 WHEN 1 THEN 6 END AS version FROM x""",
)
def canonical_prefixes(spark, d):
    """Prefixes in lower case with their family; what doesn't look like one is null."""
    n, u = F.col("event_id") % 5, F.col("user_id")
    text = F.when(n == 0, F.concat(F.lit(" 10."), u % 256, F.lit(".1.0/24 "))).when(n == 1, F.concat(F.lit("2001:DB8:"), u, F.lit("::/48"))).when(n == 2, "10.0.0.0").when(n == 3, "1" * 70 + "/8").otherwise(F.concat(F.lit("10.0.0."), u, F.lit("/33x")))
    out = events(spark, d).select("event_id", canonical_prefix(text).alias("prefix"))
    return out.withColumn("version", F.when(F.col("prefix").isNotNull(), ip_version("prefix")))
