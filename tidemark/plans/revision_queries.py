"""Queries of the revision algebra, change feeds, parity, audits and source status."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import acquisition_basis, fingerprint, is_live
from tidemark.operators import measure as M
from tidemark.operators import parity as P
from tidemark.operators import revisions as R
from tidemark.operators.coverage import schedule_revisions, schedule_segments
from tidemark.plans.bindings import EVENTS, FEEDS, KEYS, REVISIONS, RUNS, events, fact_revisions, facts, feed_keys, runs, stamp, table
from tidemark.plans.registry import ORACLES, query

S = "'%Y-%m-%d %H:%M:%S'"
FACT = ["user_id", "event_type", "day"]


@query("revision_heads", f"WITH {REVISIONS} SELECT user_id, event_type, strftime(day, '%Y-%m-%d') AS day, event_id, revision, state FROM (SELECT *, max(revision) OVER (PARTITION BY user_id, event_type, day) AS top FROM rev) WHERE revision = top")
def revision_heads(spark, d):
    """The head of every fact."""
    out = R.heads(fact_revisions(spark, d), FACT, [F.desc("revision")])
    return out.select("user_id", "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id", F.col("revision").cast("bigint").alias("revision"), "state")


@query("previous_revisions", f"WITH {REVISIONS} SELECT event_id, lag(event_id) OVER w AS prev_event_id, lag(value) OVER w AS prev_value FROM rev WINDOW w AS (PARTITION BY user_id, event_type, day ORDER BY revision)")
def previous(spark, d):
    return R.with_previous(fact_revisions(spark, d), FACT, [F.asc("revision")], ["event_id", "value"]).select("event_id", "prev_event_id", "prev_value")


@query("validity_intervals", f"WITH {EVENTS} SELECT event_id, strftime(lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts), {S}) AS effective_to FROM ev")
def validity(spark, d):
    """SCD2 end of each row: the next start of its key."""
    return R.valid_to(events(spark, d), ["user_id", "event_type"], "ts").select("event_id", stamp("effective_to").alias("effective_to"))


@query("running_gaps", f"WITH {EVENTS}, m AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM ev) SELECT user_id, count(*) AS gaps FROM m WHERE ts > pm + INTERVAL 12 HOUR GROUP BY 1")
def running_gaps(spark, d):
    """Silences of more than twelve hours by a running maximum."""
    out = R.running_max(events(spark, d), ["user_id"], [F.asc("ts"), F.asc("event_id")], "ts", "pm")
    return out.where(F.unix_micros("ts") > F.unix_micros("pm") + 43200000000).groupBy("user_id").agg(F.count("*").alias("gaps"))


@query("carried_values", f"WITH {EVENTS} SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM ev")
def carried(spark, d):
    rows = events(spark, d).withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value")))
    return R.carry_forward(rows, ["user_id"], [F.asc("ts"), F.asc("event_id")], "p", "last_purchase").select("event_id", "last_purchase")


@query("rank_share_in_day", f"WITH c AS (SELECT date_trunc('day', ts) AS b, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT strftime(b, {S}) AS bucket, event_type, CAST(row_number() OVER (PARTITION BY b ORDER BY n DESC, event_type) AS INTEGER) AS rank, round(n / sum(n) OVER (PARTITION BY b), 9) AS share FROM c")
def rank_share(spark, d):
    counts = events(spark, d).groupBy(F.date_trunc("day", "ts").alias("b"), "event_type").agg(F.count("*").alias("n"))
    out = R.rank_share(counts, ["b"], [F.desc("n"), F.asc("event_type")], "n")
    return out.select(stamp("b").alias("bucket"), "event_type", "rank", F.round("share", 9).alias("share"))


@query("appended_revisions", f"""WITH {REVISIONS}, old AS (SELECT user_id, event_type, day, max(revision) AS r, arg_max(value, revision) AS v FROM rev WHERE ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1, 2, 3),
  cand AS (SELECT rev.*, o.r, coalesce(lag(rev.value) OVER (PARTITION BY rev.user_id, rev.event_type, rev.day ORDER BY ts, event_id), o.v) AS before, o.r IS NOT NULL OR lag(rev.value) OVER (PARTITION BY rev.user_id, rev.event_type, rev.day ORDER BY ts, event_id) IS NOT NULL AS has FROM rev LEFT JOIN old o USING (user_id, event_type, day) WHERE ts >= TIMESTAMP '2024-01-20 12:00:00')
  SELECT event_id, CAST(coalesce(r, 0) + row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts, event_id) AS INTEGER) AS revision FROM cand WHERE NOT has OR value IS DISTINCT FROM before""")
def appended(spark, d):
    """Candidates after a moment appended to the revisions before it, repeats dropped."""
    rows = fact_revisions(spark, d).withColumn("fp", F.col("value").cast("string"))
    cut = F.lit("2024-01-20 12:00:00").cast("timestamp")
    out = R.append_revisions(rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut).drop("revision"), FACT, "fp", [F.asc("ts"), F.asc("event_id")])
    return out.select("event_id", "revision")


@query("retracted_facts", f"WITH {REVISIONS}, h AS (SELECT *, max(revision) OVER (PARTITION BY user_id, event_type, day) AS top FROM rev) SELECT user_id, event_type, strftime(day, '%Y-%m-%d') AS day, CAST(revision + 1 AS INTEGER) AS revision, 'RETRACTED' AS state FROM h WHERE revision = top AND state = 'ACTIVE' AND user_id % 10 = 4")
def retracted(spark, d):
    """Retraction by identity: every tenth user's active facts."""
    head = R.heads(fact_revisions(spark, d), FACT, [F.desc("revision")])
    ids = events(spark, d).where("user_id % 10 = 4").select("user_id", "event_type", F.to_date("ts").alias("day"))
    out = R.retract(head, ids, FACT)
    return out.select("user_id", "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("revision").cast("int").alias("revision"), "state")


@query("revised_facts", f"WITH a AS (SELECT event_type, user_id, max(ts) AS t, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2), b AS (SELECT event_type, user_id, max(ts) AS t, count(*) AS n FROM events GROUP BY 1, 2) SELECT b.event_type, b.user_id, CASE WHEN a.n IS NULL THEN 1 ELSE 2 END AS revision FROM b LEFT JOIN a USING (event_type, user_id) WHERE a.n IS DISTINCT FROM b.n")
def revised(spark, d):
    """Facts of (type, user) counted before and after ten more days: those that changed."""
    key = ["event_type", "user_id"]
    count = lambda df: df.groupBy(*key).agg(F.max("ts").alias("event_time"), F.count("*").cast("string").alias("fp"))
    e = events(spark, d)
    head = count(e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))).withColumn("revision", F.lit(1))
    return R.revise(head, count(e), key, "fp", "event_time", "DAY")[0].select("event_type", "user_id", "revision")


@query("revised_dirty_buckets", f"WITH a AS (SELECT event_type, user_id, max(ts) AS t, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2), b AS (SELECT event_type, user_id, max(ts) AS t, count(*) AS n FROM events GROUP BY 1, 2), x AS (SELECT a.t AS o, b.t AS w FROM b LEFT JOIN a USING (event_type, user_id) WHERE a.n IS DISTINCT FROM b.n) SELECT DISTINCT strftime(date_trunc('day', t), {S}) AS bucket FROM (SELECT o AS t FROM x UNION ALL SELECT w FROM x) WHERE t IS NOT NULL")
def revised_dirty(spark, d):
    """Day buckets of the old and new positions of revised facts."""
    key = ["event_type", "user_id"]
    count = lambda df: df.groupBy(*key).agg(F.max("ts").alias("event_time"), F.count("*").cast("string").alias("fp"))
    e = events(spark, d)
    head = count(e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))).withColumn("revision", F.lit(1))
    return R.revise(head, count(e), key, "fp", "event_time", "DAY")[1].select(stamp("bucket_start").alias("bucket"))


@query("dirty_buckets", f"SELECT DISTINCT event_type, g AS granularity, strftime(CASE g WHEN 'HOUR' THEN date_trunc('hour', ts) ELSE date_trunc('day', ts) END, {S}) AS bucket FROM events, (VALUES ('HOUR'), ('DAY')) v(g) WHERE value > 50")
def dirty(spark, d):
    """Hours and days that changed facts touch."""
    return R.dirty_buckets(events(spark, d).where("value > 50"), "ts", ["HOUR", "DAY"], ["event_type"]).select("event_type", "granularity", stamp("bucket_start").alias("bucket"))


@query("emitted_buckets", f"""WITH f AS (SELECT event_type, date_trunc('day', ts) AS b, event_id FROM events), o AS (SELECT event_type, b, count(*) AS v FROM f WHERE event_id % 50 <> 3 AND b < TIMESTAMP '2024-01-28' GROUP BY 1, 2), n AS (SELECT event_type, b, count(*) AS v FROM f GROUP BY 1, 2)
  SELECT n.event_type AS source_key, strftime(n.b, {S}) AS bucket, n.v AS value, CASE WHEN o.v IS NULL THEN 1 ELSE 2 END AS revision, CASE WHEN n.b + INTERVAL 1 DAY > TIMESTAMP '2024-01-29 12:00:00' THEN 'PROVISIONAL' WHEN o.v IS NOT NULL THEN 'REVISED' ELSE 'SETTLED' END AS state FROM n LEFT JOIN o USING (event_type, b) WHERE o.v IS DISTINCT FROM n.v""")
def emitted(spark, d):
    """Bucket revisions only where the value changed, with their state."""
    f = M.with_buckets(facts(spark, d), "event_time", ["DAY"])
    count = lambda df: df.groupBy("source_key", "bucket_start", "bucket_end").agg(F.count("*").alias("value"))
    old = count(f.where("fact_key % 50 <> 3 and bucket_start < timestamp'2024-01-28'")).withColumn("revision", F.lit(1))
    out = R.emit_buckets(old, count(f), ["source_key", "bucket_start"], ["value"], "bucket_end", F.lit("2024-01-29 12:00:00").cast("timestamp"), F.lit(False))
    return out.select("source_key", stamp("bucket_start").alias("bucket"), "value", "revision", "state")


@query("rebuild_range", f"SELECT 'HOUR' AS granularity, strftime(h, {S}) AS bucket FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', (SELECT date_trunc('day', max(ts)) FROM events), INTERVAL 1 HOUR)) AS h) WHERE h < (SELECT date_trunc('day', max(ts)) FROM events)")
def rebuild(spark, d):
    """All hours from the first day to the day of the newest event."""
    span = events(spark, d).agg(F.lit("2024-01-01").cast("timestamp").alias("start"), F.date_trunc("day", F.max("ts")).alias("end"))
    return R.rebuild_range(span, "HOUR", 3600).select("granularity", stamp("bucket_start").alias("bucket"))


@query("new_records_only", "SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE ts < TIMESTAMP '2024-01-03')")
def new_records(spark, d):
    """Insert if absent on a natural key."""
    e, cut = events(spark, d), F.lit("2024-01-03").cast("timestamp")
    return R.new_only(e.where(F.col("ts") >= cut).select("user_id", "event_type"), e.where(F.col("ts") < cut), ["user_id", "event_type"])


@query("pending_inputs", "SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type <> 'error' AND event_id % 3 = 0)")
def pending(spark, d):
    """Inputs without a receipt."""
    e = events(spark, d)
    return R.pending(e.select("event_id"), e.where("event_type <> 'error' and event_id % 3 = 0"), ["event_id"])


@query("snapshot_removals", f"WITH m AS (SELECT date_trunc('day', ts) AS b, user_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2), dd AS (SELECT b, lead(b) OVER (ORDER BY b) AS nb FROM (SELECT DISTINCT b FROM m)) SELECT strftime(nb, {S}) AS bucket, user_id AS member FROM m JOIN dd USING (b) WHERE nb IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m q WHERE q.b = nb AND q.user_id = m.user_id)")
def removals(spark, d):
    """Members of each day's manifest that the next one lacks."""
    m = events(spark, d).where("event_type = 'purchase'").select(F.lit("purchase").alias("source_key"), F.date_trunc("day", "ts").alias("at"), F.col("user_id").alias("member"))
    return R.removals(m, ["source_key"], "at", "member").select(stamp("at").alias("bucket"), "member")


@query("changed_content", "SELECT c_custkey AS path, 'CHANGED_OR_NEW' AS kind FROM customer WHERE c_custkey > 0 AND (c_custkey % 10 = 0 OR c_custkey % 13 = 0) UNION ALL SELECT -c_custkey, 'REMOVED' FROM customer WHERE c_custkey % 17 = 0 AND c_custkey > 0")
def changed_content(spark, d):
    """Rows that are new or changed by (path, content hash), and rows that went."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("path"), fingerprint("c_name", "c_mktsegment").alias("content")).where("path > 0")
    old = c.where("path % 10 <> 0").withColumn("content", F.when(F.col("path") % 13 == 0, F.lit("x")).otherwise(F.col("content"))).unionByName(c.where("path % 17 = 0 and path > 0").withColumn("path", -F.col("path")))
    new, gone = R.changed(c, old, "path", "content")
    return new.select("path", F.lit("CHANGED_OR_NEW").alias("kind")).unionByName(gone.select("path", F.lit("REMOVED").alias("kind")))


@query("merged_newest", f"WITH r AS (SELECT user_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, CASE event_type WHEN 'click' THEN 0 ELSE 1 END, event_id) AS r FROM events WHERE event_type IN ('click', 'view')) SELECT user_id, strftime(date_trunc('day', ts), {S}) AS modified, event_type FROM r WHERE r = 1")
def merged_newest(spark, d):
    """The newest row of two feeds; on a tie the first feed's."""
    e = events(spark, d).withColumn("modified", F.date_trunc("day", "ts")).select("user_id", "modified", "event_type").distinct()
    return R.merge_newest([e.where("event_type = 'click'"), e.where("event_type = 'view'")], ["user_id"], "modified").select("user_id", stamp("modified").alias("modified"), "event_type")


@query("change_feed_page", f"WITH {EVENTS} SELECT event_id, strftime(ts, {S}) AS at FROM ev WHERE event_type = 'purchase' AND (ts, event_id) < (TIMESTAMP '2024-01-20 00:00:00', 0) ORDER BY ts DESC, event_id DESC LIMIT 51")
def change_feed(spark, d):
    """A page of fifty changes after a cursor, and one more row to tell whether others follow."""
    return R.page(events(spark, d).where("event_type = 'purchase'"), "ts", "event_id", ("2024-01-20 00:00:00", 0), 50).select("event_id", stamp("ts").alias("at"))


@query("keyset_orders_page", f"SELECT o_orderkey, strftime(o_orderdate, {S}) AS at FROM orders WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1997-06-15', 500) ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 101")
def keyset_orders(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    return R.page(rows, "o_orderdate", "o_orderkey", ("1997-06-15 00:00:00", 500), 100).select("o_orderkey", stamp("o_orderdate").alias("at"))


@query("top_scores", "SELECT p_partkey AS id, (p_retailprice % 100) / 100 AS score, p_size / 50.0 AS percentile FROM part WHERE (p_retailprice % 100) / 100 >= 0.1 ORDER BY score DESC, percentile DESC, id LIMIT 2500")
def top_scores(spark, d):
    """The 2,500 best scores of at least 0.1 (the report's own length)."""
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), ((F.col("p_retailprice") % 100) / 100).alias("score"), (F.col("p_size") / F.lit(50.0)).alias("percentile"))
    return R.top_k(rows, F.col("score") >= 0.1, [F.desc("score"), F.desc("percentile"), F.asc("id")], 2500)


@query("top_users_per_type", "WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS r FROM c) SELECT event_type, user_id, n FROM r WHERE r <= 5")
def top_users(spark, d):
    counts = events(spark, d).groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return R.top_n_per(counts, ["event_type"], [F.desc("n"), F.asc("user_id")], 5)


@query("snapshot_as_known", f"WITH {REVISIONS}, k AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY revision DESC) AS r FROM rev WHERE ts <= TIMESTAMP '2024-01-18 09:30:00') SELECT user_id, event_type, strftime(day, '%Y-%m-%d') AS day, event_id FROM k WHERE r = 1")
def as_known(spark, d):
    """The newest revision of each record as it was known at a moment."""
    out = R.merge_snapshot(fact_revisions(spark, d), F.lit("2024-01-18 09:30:00").cast("timestamp"), "ts", FACT, [F.desc("revision")])
    return out.select("user_id", "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id")


@query("purged_payloads", "SELECT event_id, event_id IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-05' ORDER BY ts, event_id LIMIT 1000) AS purged FROM events")
def purged(spark, d):
    """The thousand oldest expired payloads (the batch of the feature), and all that stay."""
    kept, gone = R.purge_expired(events(spark, d), ["event_id"], "ts", F.lit("2024-01-05").cast("timestamp"), 1000)
    return kept.select("event_id", F.lit(False).alias("purged")).unionByName(gone.select("event_id", F.lit(True).alias("purged")))


@query("missing_observations", "WITH a AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-10'), c AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-14') SELECT user_id, event_type FROM a WHERE user_id IN (SELECT user_id FROM c) AND (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM c)")
def missing_observations(spark, d):
    """Active observations that the newest projection of their record lacks."""
    e = events(spark, d)
    part = lambda a, b: M.in_period(e, a, b, "ts").select("user_id", "event_type").distinct()
    return R.retract_missing(part("2024-01-01", "2024-01-10"), part("2024-01-10", "2024-01-14"), ["user_id"], "event_type")


@query("schedule_revisions", f"WITH {FEEDS}, v AS (SELECT * FROM (VALUES (TIMESTAMP '2024-01-01', 21600), (TIMESTAMP '2024-01-05', 21600), (TIMESTAMP '2024-01-15', 200), (TIMESTAMP '2024-01-20', 2400)) t(f, i)) SELECT source_key, strftime(f, {S}) AS effective_from, i AS interval_s, CAST(greatest(60, least(900, i // 4)) AS BIGINT) AS grace_s, strftime(CASE f WHEN TIMESTAMP '2024-01-01' THEN TIMESTAMP '2024-01-15' WHEN TIMESTAMP '2024-01-15' THEN TIMESTAMP '2024-01-20' END, {S}) AS effective_to FROM types, v WHERE f <> TIMESTAMP '2024-01-05'")
def schedule_history(spark, d):
    """Schedule changes as revisions: repeats dropped, grace clamped, ends from the next start."""
    rows = F.array(*[F.struct(F.lit(f).cast("timestamp").alias("effective_from"), F.lit(i).alias("interval_s")) for f, i in (("2024-01-01", 21600), ("2024-01-05", 21600), ("2024-01-15", 200), ("2024-01-20", 2400))])
    changes = feed_keys(spark, d).select("source_key", F.explode(rows).alias("r")).select("source_key", "r.*", F.lit(True).alias("enabled"))
    out = schedule_segments(schedule_revisions(changes, ["source_key"]), ["source_key"])
    return out.select("source_key", stamp("effective_from").alias("effective_from"), "interval_s", "grace_s", stamp("effective_to").alias("effective_to"))


@query("parity_diff", "SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'LEFT_ONLY' WHEN c_custkey % 13 = 0 THEN 'VALUE_MISMATCH' ELSE 'MATCH' END AS verdict, CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 13 = 0 THEN 'c_mktsegment' ELSE '' END AS fields FROM customer")
def parity_diff(spark, d):
    """Two snapshots of customers: dropped rows, rounding noise, a changed field."""
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_acctbal")
    b = a.where("id % 10 <> 0").withColumns({"c_acctbal": F.when(F.col("id") % 11 == 0, F.col("c_acctbal") + 1e-13).otherwise(F.col("c_acctbal")), "c_mktsegment": F.when(F.col("id") % 13 == 0, F.lit("?")).otherwise(F.col("c_mktsegment"))})
    return P.parity(a, b, "id", ["c_name", "c_mktsegment"], ["c_acctbal"])


CHANGED = """WITH x AS (SELECT c_custkey AS id, c_custkey % 10 = 0 AS gone, c_custkey % 13 = 0 AS renamed, c_custkey % 7 = 0 AS later, c_custkey % 7 <> 0 AND c_custkey % 17 = 0 AS earlier, c_custkey % 19 = 0 AS twice, c_custkey % 20 = 0 AS said FROM customer),
    df AS (SELECT 'LEFT_ONLY' AS kind, id, NULL AS field, CASE WHEN said THEN 'INTENTIONAL_DIFFERENCE' ELSE 'REGRESSION' END AS classification FROM x WHERE gone
    UNION ALL SELECT 'FACT_MISMATCH', id, 'c_mktsegment', 'REGRESSION' FROM x WHERE NOT gone AND renamed UNION ALL SELECT 'FACT_MISMATCH', id, 'last_seen', 'TEMPORAL_SKEW' FROM x WHERE NOT gone AND later
    UNION ALL SELECT 'FACT_MISMATCH', id, 'last_seen', 'REGRESSION' FROM x WHERE NOT gone AND earlier UNION ALL SELECT 'DUPLICATE_IDENTITY', id, 'RIGHT', 'REGRESSION' FROM x WHERE NOT gone AND twice)"""


def changed(spark, d):
    """Customers against a later snapshot: dropped, renamed, seen later or earlier, repeated; some drops are intended."""
    tags = lambda *names: F.array(*[F.lit(n) for n in names])
    day = lambda s: F.lit(s).cast("timestamp")
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_acctbal", tags("a", "b").alias("tags"), day("2024-01-01").alias("last_seen"))
    b = a.where("id % 10 <> 0").withColumns({
        "c_mktsegment": F.when(F.col("id") % 13 == 0, F.lit("?")).otherwise(F.col("c_mktsegment")), "tags": tags("b", "a"),
        "last_seen": F.when(F.col("id") % 7 == 0, day("2024-01-02")).when(F.col("id") % 17 == 0, day("2023-12-31")).otherwise(F.col("last_seen")),
    })
    manual = a.where("id % 20 = 0").select(F.lit("LEFT_ONLY").alias("side"), "id", F.lit("INTENTIONAL_DIFFERENCE").alias("classification"))
    right = b.unionByName(b.where("id % 19 = 0"))
    return P.parity_differences(a, right, "id", ["c_name", "c_mktsegment"], ["c_acctbal"], ["tags"], ["last_seen"], left_first=True, same_snapshot=True, manual=manual)


@query("parity_differences", f"{CHANGED} SELECT * FROM df")
def parity_differences(spark, d):
    """Classified differences of two snapshots."""
    return changed(spark, d).select("kind", "id", "field", "classification")


@query("parity_accepted", f"{CHANGED} SELECT count(*) FILTER (WHERE classification = 'REGRESSION') AS blocking, count(*) FILTER (WHERE classification = 'UNCLASSIFIED') AS unexplained, count(*) FILTER (WHERE classification IN ('REGRESSION', 'UNCLASSIFIED')) = 0 AS accepted FROM df")
def parity_accepted(spark, d):
    return P.parity_accepted(changed(spark, d))


@query("population_guard", "WITH s AS (SELECT user_id, date_trunc('day', ts) AS b, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY b) AS pn FROM s) SELECT user_id, strftime(b, '%Y-%m-%d') AS day, n AS n_rows, CASE WHEN n < floor(pn * 0.75) THEN 'REJECT_DROP' ELSE 'ACCEPT' END AS verdict FROM p")
def guard(spark, d):
    """Daily populations of each user that fell by more than a quarter."""
    snaps = events(spark, d).groupBy(F.col("user_id").alias("source_key"), F.to_date("ts").alias("dataset_date")).agg(F.count("*").alias("rows"))
    out = P.population_guard(snaps.withColumn("model", F.lit("m")), "dataset_date")
    return out.select(F.col("source_key").alias("user_id"), F.date_format("dataset_date", "yyyy-MM-dd").alias("day"), F.col("rows").alias("n_rows"), "verdict")


@query("population_guard_all", "WITH s AS (SELECT date_trunc('day', ts) AS b, count(*) AS n FROM events GROUP BY 1), p AS (SELECT *, lag(n) OVER (ORDER BY b) AS pn FROM s) SELECT strftime(b, '%Y-%m-%d') AS day, n AS n_rows, CASE WHEN n < floor(pn * 0.75) THEN 'REJECT_DROP' ELSE 'ACCEPT' END AS verdict FROM p")
def guard_all(spark, d):
    """Daily populations of all users together."""
    snaps = events(spark, d).groupBy(F.to_date("ts").alias("dataset_date")).agg(F.count("*").alias("rows"))
    out = P.population_guard(snaps.withColumns({"model": F.lit("m"), "source_key": F.lit("s")}), "dataset_date")
    return out.select(F.date_format("dataset_date", "yyyy-MM-dd").alias("day"), F.col("rows").alias("n_rows"), "verdict")


@query(
    "snapshot_fingerprints",
    """WITH t AS (SELECT c_mktsegment, [CAST(c_custkey AS VARCHAR), c_name, CAST(c_acctbal AS VARCHAR)] AS v FROM customer), d AS (SELECT c_mktsegment, sha256(array_to_string(list_transform(v, lambda x: len(x) || ':' || x), ';')) AS h FROM t),
    w AS (SELECT c_mktsegment, i, sum(('0x' || substr(h, 8 * i + 1, 8))::BIGINT) % 4294967296 AS s FROM d, range(8) r(i) GROUP BY 1, 2), n AS (SELECT c_mktsegment, count(*) AS n FROM d GROUP BY 1)
    SELECT c_mktsegment AS segment, n AS n_rows, true AS same, sha256(n || '.' || string_agg(CAST(s AS BIGINT), '.' ORDER BY i)) AS fp FROM w JOIN n USING (c_mktsegment) GROUP BY 1, 2""",
)
def fingerprints(spark, d):
    """Fingerprints of each segment's customers; they don't depend on the order or partitioning of rows."""
    c = table(spark, d, "customer")
    a = P.snapshot_fingerprint(c, ["c_mktsegment"], "c_custkey", ["c_name", "c_acctbal"])
    b = P.snapshot_fingerprint(c.repartition(7, "c_name"), ["c_mktsegment"], "c_custkey", ["c_name", "c_acctbal"]).select("c_mktsegment", F.col("fp").alias("fp2"))
    return a.join(b, "c_mktsegment").select(F.col("c_mktsegment").alias("segment"), F.col("rows").alias("n_rows"), (F.col("fp") == F.col("fp2")).alias("same"), "fp")


@query("invariant_audit", """SELECT 'duplicate_event_ids' AS invariant, count(*) AS violations, count(*) = 0 AS accepted FROM (SELECT event_id FROM events GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'orphan_orders', count(*), count(*) = 0 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'negative_values', count(*), count(*) = 0 FROM events WHERE value < 0
  UNION ALL SELECT 'orders_without_lines', count(*), count(*) = 0 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def audit(spark, d):
    """Invariants with the number of rows that break each."""
    e, o = events(spark, d), table(spark, d, "orders")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return P.audit({"duplicate_event_ids": P.duplicates(e, ["event_id"]), "orphan_orders": P.orphans(o, customers, ["o_custkey"]), "negative_values": e.where("value < 0"), "orders_without_lines": P.orphans(o, lines, ["o_orderkey"])})


@query("source_status", f"""WITH {FEEDS}, {RUNS}, p AS (SELECT source_key, max(CASE WHEN state = 'SUCCEEDED' THEN scheduled_for END) AS ls, count(*) AS runs, count(*) FILTER (WHERE state = 'FAILED') AS failed, arg_max(state, scheduled_for) AS last FROM runs GROUP BY 1)
  SELECT source_key, strftime(ls, {S}) AS last_success, runs, failed, CASE WHEN TIMESTAMP '2024-01-31' - ls <= INTERVAL 12 HOUR THEN 'FRESH' ELSE 'STALE' END AS freshness, CASE WHEN last = 'FAILED' THEN 'DEGRADED' ELSE 'READY' END AS readiness FROM p""")
def status(spark, d):
    """Readiness and freshness of every source."""
    keys = feed_keys(spark, d)
    out = P.source_status(keys.withColumn("poll_seconds", F.lit(21600)), runs(spark, d, keys), F.lit("2024-01-31").cast("timestamp"))
    return out.select("source_key", stamp("last_success").alias("last_success"), "runs", "failed", "freshness", "readiness")


BASES = {"SCHEDULED": ["LIVE_INCREMENTAL"], "BOOTSTRAP": ["INITIAL_BOOTSTRAP", "LIVE_INCREMENTAL"], "MANUAL": ["HISTORICAL_BACKFILL", "RESYNC", "REPAIR"], "RECOVERY": ["LIVE_INCREMENTAL"]}
KINDS = [(t, p) for t, ps in BASES.items() for p in ps]
KIND_SQL = ", ".join(f"({i}, '{t}', '{p}')" for i, (t, p) in enumerate(KINDS))


@query("acquisition_bases", f"""SELECT trigger_kind, purpose, count(*) AS n, CASE WHEN purpose = 'INITIAL_BOOTSTRAP' OR trigger_kind = 'BOOTSTRAP' THEN 'INITIAL_BOOTSTRAP' WHEN purpose <> 'LIVE_INCREMENTAL' THEN purpose WHEN trigger_kind = 'RECOVERY' THEN 'RECOVERY' ELSE 'LIVE_INCREMENTAL' END AS fact_basis,
  CASE WHEN purpose <> 'LIVE_INCREMENTAL' THEN purpose WHEN trigger_kind = 'RECOVERY' THEN 'RECOVERY' ELSE 'LIVE_INCREMENTAL' END AS window_basis, trigger_kind = 'SCHEDULED' AND purpose = 'LIVE_INCREMENTAL' AS live
  FROM events JOIN (VALUES {KIND_SQL}) v(i, trigger_kind, purpose) ON event_id % {len(KINDS)} = i GROUP BY 1, 2""")
def acquisition_bases(spark, d):
    """The basis of facts and of windows for every trigger and purpose that runs have."""
    kinds = F.array(*[F.struct(F.lit(t).alias("trigger"), F.lit(p).alias("purpose")) for t, p in KINDS])
    rows = events(spark, d).select(F.get(kinds, (F.col("event_id") % len(KINDS)).cast("int")).alias("k")).select("k.*")
    per = rows.groupBy("trigger", "purpose").agg(F.count("*").alias("n"))
    return per.select(F.col("trigger").alias("trigger_kind"), "purpose", "n", acquisition_basis("trigger", "purpose").alias("fact_basis"), acquisition_basis("trigger", "purpose", False).alias("window_basis"), is_live("trigger", "purpose").alias("live"))


@query("acquisition_summary", """WITH x AS (SELECT user_id, date_trunc('day', ts) AS b, CASE WHEN event_type IN ('error', 'signup') THEN 'MRT_RECOVERY' ELSE 'LIVE_STREAM' END AS basis FROM events)
  SELECT user_id, strftime(b, '%Y-%m-%d %H:%M:%S') AS day, array_to_string(list_sort(list_distinct(list(basis))), ',') AS bases, CASE WHEN count(DISTINCT basis) = 1 THEN max(basis) ELSE 'MIXED' END AS kind FROM x GROUP BY 1, 2""")
def acquisition(spark, d):
    """How each user's day was acquired: live, recovered, or both."""
    rows = events(spark, d).select("user_id", F.date_trunc("day", "ts").alias("day"), F.when(F.col("event_type").isin("error", "signup"), "MRT_RECOVERY").otherwise("LIVE_STREAM").alias("basis"))
    return P.acquisition_summary(rows, ["user_id", "day"], "basis").select("user_id", stamp("day").alias("day"), F.array_join("bases", ",").alias("bases"), "kind")
