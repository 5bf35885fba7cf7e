"""Logical tables bound to the driver's tables, each in two forms: a DataFrame and a SQL common table expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The range that all bound tables cover.
START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
#: How many times as many partitions feeds have as other tables, at least, and how many feeds a task holds, about.
WIDER, FEEDS_AT_ONCE = 4, 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(c: Column | str) -> Column:
    """A time as text, the form that both engines compare."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", F.regexp_extract("props", '"k": *([0-9]+)', 1).alias("k"))


EVENTS = """ev AS (SELECT event_id, ts, user_id, event_type, value, regexp_extract(props, '"k": *([0-9]+)', 1) AS k FROM events)"""


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Instant facts: source_key is the event type, the entity is the user."""
    e = events(spark, d)
    return e.select(F.col("event_type").alias("source_key"), F.col("event_id").alias("fact_key"), F.col("ts").alias("event_time"), F.col("user_id").alias("entity_key"), "value", "k")


def source_keys(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select(F.col("event_type").alias("source_key")).distinct()


def feed_keys(spark: SparkSession, d: str) -> DataFrame:
    """A feed for every type and user, so that windows, runs and schedules made for feeds grow with the events.

    A feed becomes some hundred rows behind this, so the keys are dealt wider than their own size asks for; what is made of them
    lies by feed and isn't shuffled again. They are counted first, so that more feeds make more tasks, not larger ones, whatever
    the number of shuffle partitions.
    """
    keys = events(spark, d).select(F.concat_ws("/", "event_type", "user_id").alias("source_key"))
    feeds = keys.agg(F.approx_count_distinct("source_key")).first()[0]
    parts = max(WIDER * int(spark.conf.get("spark.sql.shuffle.partitions")), feeds // FEEDS_AT_ONCE + 1)
    return keys.distinct().repartition(parts, "source_key")


FEEDS = "types AS (SELECT DISTINCT event_type || '/' || user_id AS source_key FROM events)"
KEYS = "types AS (SELECT DISTINCT event_type AS source_key FROM events)"
DAYS = "days AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS d)"


def sources(spark: SparkSession, d: str) -> DataFrame:
    """The source dimension: origin and class of each event type."""
    k = F.col("source_key")
    origin = F.when(k.isin("click", "view"), "web").when(k.isin("purchase", "signup"), "shop").otherwise("ops")
    kind = F.when(k.isin("click", "view"), "BEHAVIOUR").when(k == "purchase", "COMMERCE").when(k == "signup", "IDENTITY").otherwise("CONTEXT_KNOWLEDGE")
    return source_keys(spark, d).select("source_key", origin.alias("origin"), kind.alias("source_class"), F.lit(21600).alias("poll_seconds"))


SOURCES = """src AS (SELECT source_key, CASE WHEN source_key IN ('click','view') THEN 'web' WHEN source_key IN ('purchase','signup') THEN 'shop' ELSE 'ops' END AS origin,
  CASE WHEN source_key IN ('click','view') THEN 'BEHAVIOUR' WHEN source_key = 'purchase' THEN 'COMMERCE' WHEN source_key = 'signup' THEN 'IDENTITY' ELSE 'CONTEXT_KNOWLEDGE' END AS source_class
  FROM (SELECT DISTINCT event_type AS source_key FROM events))"""


def windows(spark: SparkSession, d: str, keys: DataFrame | None = None) -> DataFrame:
    """One acquisition window for most (type, day) pairs; some partial, odd days only 18 hours long."""
    grid = (source_keys(spark, d) if keys is None else keys).withColumn("day", F.explode(F.sequence(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-30").cast("timestamp"), F.expr("interval 1 day"))))
    m = (F.dayofyear("day") + F.length("source_key")) % 4
    hours = F.when(F.dayofyear("day") % 2 == 0, 24).otherwise(18)
    end = F.timestamp_seconds(F.unix_timestamp("day") + hours * 3600)
    return grid.where(m != 0).select("source_key", F.col("day").alias("start"), end.alias("end"), F.when(m == 1, "PARTIAL").otherwise("AVAILABLE").alias("availability"))


WINDOWS = """win AS (SELECT source_key, d AS w_start, d + CASE WHEN dayofyear(d) % 2 = 0 THEN INTERVAL 24 HOUR ELSE INTERVAL 18 HOUR END AS w_end,
  CASE WHEN (dayofyear(d) + length(source_key)) % 4 = 1 THEN 'PARTIAL' ELSE 'AVAILABLE' END AS availability
  FROM types, days WHERE (dayofyear(d) + length(source_key)) % 4 <> 0)"""


def fact_revisions(spark: SparkSession, d: str) -> DataFrame:
    """Events of one (user, type, day) in time order are the revisions of one fact; some end retracted."""
    from tidemark.operators.revisions import revision_number

    e = events(spark, d).withColumn("day", F.to_date("ts"))
    key = ["user_id", "event_type", "day"]
    numbered = revision_number(e, key, [F.asc("ts"), F.asc("event_id")])
    return numbered.withColumn("state", F.when(F.col("event_id") % 7 == 0, "RETRACTED").otherwise("ACTIVE"))


REVISIONS = f"""{EVENTS}, rev AS (SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS revision,
  CASE WHEN event_id % 7 = 0 THEN 'RETRACTED' ELSE 'ACTIVE' END AS state FROM ev)"""


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Entity observations: the user is the entity, signups are dates, the rest instants."""
    e = events(spark, d)
    dated = F.col("event_type") == "signup"
    return e.select(
        F.col("user_id").alias("entity_key"),
        F.col("event_type").alias("source_key"),
        F.col("event_id").alias("observation_key"),
        F.when(~dated, F.col("ts")).alias("observed_time"),
        F.when(dated, F.to_date("ts")).alias("observed_date"),
    )


OBSERVATIONS = f"""{EVENTS}, {SOURCES}, obs AS (SELECT user_id AS entity_key, event_type AS source_key, event_id AS observation_key, origin, source_class,
  CASE WHEN event_type <> 'signup' THEN ts END AS observed_time, CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END AS observed_date,
  CASE WHEN event_type = 'signup' THEN date_trunc('day', ts) ELSE ts END AS t0 FROM ev JOIN src ON event_type = source_key)"""


def routing(spark: SparkSession, d: str) -> DataFrame:
    """Routing observations made of events: two announced prefixes, sometimes one withdrawn."""
    e = events(spark, d)
    small = F.concat(F.lit("10."), F.col("user_id") % 8, F.lit("."), F.col("event_id") % 32, F.lit(".0/24"))
    big = F.concat(F.lit("10."), F.col("user_id") % 8, F.lit(".0.0/16"))
    none = F.array().cast("array<string>")
    return e.select(
        "event_id",
        F.col("ts").alias("observed_at"),
        F.concat(F.lit("rrc0"), F.col("user_id") % 3).alias("rrc"),
        (F.col("user_id") % 50).alias("peer"),
        F.when(F.col("event_type") != "error", F.array(small, big)).otherwise(none).alias("announced"),
        F.when(F.col("event_type") == "view", F.array(small)).otherwise(none).alias("withdrawn"),
        F.array((F.lit(64500) + F.col("user_id") % 20).cast("bigint")).alias("origins"),
    )


ROUTING = """ro AS (SELECT event_id, ts, date_trunc('minute', ts) AS m, 'rrc0' || (user_id % 3) AS rrc, user_id % 50 AS peer, 64500 + user_id % 20 AS origin, event_type,
  '10.' || (user_id % 8) || '.' || (event_id % 32) || '.0/24' AS small, '10.' || (user_id % 8) || '.0.0/16' AS big FROM events)"""


def sessions(spark: SparkSession, d: str) -> DataFrame:
    """One session a day from 00:00 to 23:00; the profile changes on the 15th, every ninth day is degraded."""
    day = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-30").cast("timestamp"), F.expr("interval 1 day"))).alias("start"))
    return day.select("start", F.timestamp_seconds(F.unix_timestamp("start") + 23 * 3600).alias("end"), F.when(F.dayofmonth("start") < 15, "p1").otherwise("p2").alias("profile"), (F.dayofmonth("start") % 9 == 0).alias("degraded"))


def whole_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The sessions, those of even days until midnight."""
    longer = F.when(F.dayofmonth("start") % 2 == 0, 24).otherwise(23)
    return sessions(spark, d).withColumn("end", F.timestamp_seconds(F.unix_timestamp("start") + longer * 3600))


def schedules(spark: SparkSession, d: str, keys: DataFrame | None = None) -> DataFrame:
    """Two schedule revisions a source: every six hours, from the 15th every twelve."""
    from tidemark.operators.coverage import schedule_revisions, schedule_segments

    two = F.array(F.struct(F.lit("2024-01-01").cast("timestamp").alias("effective_from"), F.lit(21600).alias("interval_s")), F.struct(F.lit("2024-01-15").cast("timestamp").alias("effective_from"), F.lit(43200).alias("interval_s")))
    rows = (source_keys(spark, d) if keys is None else keys).select("source_key", F.explode(two).alias("r")).select("source_key", "r.*", F.lit(True).alias("enabled"))
    return schedule_segments(schedule_revisions(rows, ["source_key"]), ["source_key"])


def runs(spark: SparkSession, d: str, keys: DataFrame | None = None) -> DataFrame:
    """A run for most expected times: state by day, hour and source; the first day's were a bootstrap."""
    at = F.sequence(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-30 18:00:00").cast("timestamp"), F.expr("interval 6 hours"))
    grid = (source_keys(spark, d) if keys is None else keys).withColumn("scheduled_for", F.explode(at))
    m = (F.dayofyear("scheduled_for") * 3 + F.hour("scheduled_for") + F.length("source_key")) % 11
    state = F.when(m == 0, "FAILED").when(m == 1, "PARTIAL").when(m != 2, "SUCCEEDED")
    boot = F.to_date("scheduled_for") == F.lit("2024-01-01").cast("date")
    return grid.withColumn("state", state).where("state is not null").select(
        "source_key",
        "scheduled_for",
        F.col("scheduled_for").alias("created_at"),
        F.concat_ws("|", "source_key", stamp("scheduled_for")).alias("run_id"),
        "state",
        F.when(boot, "BOOTSTRAP").otherwise("SCHEDULED").alias("trigger"),
        F.when(boot, "INITIAL_BOOTSTRAP").otherwise("LIVE_INCREMENTAL").alias("purpose"),
    )


RUNS = """runs AS (SELECT * FROM (SELECT source_key, t AS scheduled_for, CASE (dayofyear(t) * 3 + hour(t) + length(source_key)) % 11 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PARTIAL' WHEN 2 THEN NULL ELSE 'SUCCEEDED' END AS state,
  CASE WHEN CAST(t AS DATE) = DATE '2024-01-01' THEN 'BOOTSTRAP' ELSE 'SCHEDULED' END AS trigger_kind
  FROM types, (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 18:00:00', INTERVAL 6 HOUR)) AS t)) WHERE state IS NOT NULL)"""
