"""Routing minutes on Structured Streaming: parsing with rejects, dedupe, watermarked exact minutes, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.scalars import bucket_start
from tidemark.operators.parity import snapshot_fingerprint
from tidemark.operators.routing import LATENESS_S
from tidemark.sources.feeds import parse_messages


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A stream of message lines from files (a Kafka source has the same `value` column after a cast to text)."""
    return parse_messages(spark.readStream.text(path))


def parse_stream(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good observations, and rejects with their raw line."""
    return messages.where("not rejected"), messages.where("rejected").select("raw")


def dedupe_stream(obs: DataFrame, row_id: str = "message_id", at: str = "observed_at", lateness_s: int = LATENESS_S) -> DataFrame:
    """Each message once, within the lateness."""
    return obs.withWatermark(at, f"{lateness_s} seconds").dropDuplicatesWithinWatermark([row_id])


def minute_stream(obs: DataFrame, at: str = "observed_at", lateness_s: int = LATENESS_S) -> DataFrame:
    """Minutes that close `lateness_s` after their end: counters, and sets from one state row for each distinct member. Later
    rows are not in them; `revised_minutes` over the written segments tells which minutes they change, and counts these anew.

    The first aggregation keeps one state row for each (minute, set, member); the second, on the same window, counts them,
    so the sizes are exact and no state row holds a whole set.
    """
    text = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: x.cast("string"))
    kind = lambda name, members: F.transform(members, lambda x: F.struct(F.lit(name).alias("kind"), x.alias("member"), F.lit(0).alias("one")))
    message = F.array(F.struct(F.lit("message").alias("kind"), F.lit("").alias("member"), F.lit(1).alias("one")))
    every = F.concat(message, kind("announced", text("announced")), kind("withdrawn", text("withdrawn")), kind("origins", text("origins")), kind("rrcs", F.array("rrc")))
    rows = obs.withWatermark(at, f"{lateness_s} seconds").select(at, F.explode(every).alias("m")).select(at, "m.*")
    distinct = rows.groupBy(F.window(at, "1 minute").alias("w"), "kind", "member").agg(F.count("*").alias("n"))
    per = distinct.groupBy(F.window(F.window_time("w"), "1 minute").alias("w2")).agg(
        F.sum(F.when(F.col("kind") == "message", F.col("n")).otherwise(0)).alias("messages"),
        F.sum(F.when(F.col("kind") == "announced", F.col("n")).otherwise(0)).alias("announcements"),
        F.sum(F.when(F.col("kind") == "withdrawn", F.col("n")).otherwise(0)).alias("withdrawals"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("announced", "withdrawn", "origins", "rrcs")],
    )
    return per.select(F.col("w2.start").alias("bucket_start"), "messages", "announcements", "withdrawals", "n_announced", "n_withdrawn", "n_origins", "n_rrcs")


def rejected_minutes(lines: DataFrame, received: str) -> DataFrame:
    """Rejected lines of each minute as `minute_coverage` takes them, which makes the minute DEGRADED: bucket_start, rejected,
    profile (null). A line counts in the minute of its own time, or in that of its receipt where it says none."""
    bad = parse_messages(lines, keep=[received]).where("rejected")
    minute = bucket_start(F.coalesce("observed_at", received), "MINUTE").alias("bucket_start")
    return bad.groupBy(minute).agg(F.count("*").alias("rejected")).withColumn("profile", F.lit(None).cast("string"))


def write_minutes(minutes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed minutes as parquet; all that is there is read, then the query ends."""
    return minutes.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


MANIFEST = "first_at timestamp, last_at timestamp, received_first timestamp, received_last timestamp, messages long, first_id string, last_id string, minutes array<timestamp>, content string"


def describe(segment: DataFrame) -> DataFrame:
    """One row about a written segment: times of the source and of receipt, counts, ids, the minutes that it touches, and
    `content`, a digest of what its messages say that depends neither on their order nor on their files; a message that is in
    it twice counts twice."""
    received = "received_at" if "received_at" in segment.columns else None
    edge = lambda f, c: f(c) if c else F.lit(None).cast("timestamp")
    told = segment.agg(
        F.min("observed_at").alias("first_at"), F.max("observed_at").alias("last_at"), edge(F.min, received).alias("received_first"), edge(F.max, received).alias("received_last"),
        F.count("*").alias("messages"), F.min("message_id").alias("first_id"), F.max("message_id").alias("last_id"), F.array_sort(F.collect_set(bucket_start("observed_at", "MINUTE"))).alias("minutes"),
    )
    said = [c for c in ("observed_at", "rrc", "peer", "announced", "withdrawn", "origins") if c in segment.columns]
    content = snapshot_fingerprint(segment, [], "message_id", [F.unix_micros(c) if c == "observed_at" else F.to_json(c) if c in ("announced", "withdrawn", "origins") else F.col(c) for c in said])
    # Two rows side by side.
    return told.withColumn("_one", F.lit(1)).join(content.select(F.col("fp").alias("content"), F.lit(1).alias("_one")), "_one").drop("_one")


def commit_segment(spark: SparkSession, path: str, number: int) -> None:
    """Describe the written segment of a batch and commit its manifest, unless one of another batch has the same content."""
    told = describe(spark.read.parquet(f"{path}/segments/batch={number}"))
    known = spark.read.schema(f"{MANIFEST}, batch long").parquet(f"{path}/manifests").where(F.col("batch") != number).select("content")
    told.where("messages > 0").join(known, "content", "left_anti").select(*[c.split(" ")[0] for c in MANIFEST.split(", ")]).write.mode("overwrite").parquet(f"{path}/manifests/batch={number}")


def write_segments(obs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch as an immutable segment, written once, and then a manifest taken from what was written. A batch that is
    run again overwrites its own segment; a batch of the same content as an earlier one gets no manifest. Segments without a
    manifest (repeated ones, or those of a run that failed between the two writes) aren't there for readers."""
    obs.sparkSession.createDataFrame([], MANIFEST).write.mode("ignore").parquet(f"{path}/manifests/batch=-1")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("compression", "gzip").parquet(f"{path}/segments/batch={number}")
        commit_segment(batch.sparkSession, path, number)

    return obs.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def segments(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """Manifests of the committed segments, with their batch; those after a batch only, if asked for."""
    return spark.read.schema(f"{MANIFEST}, batch long").parquet(f"{path}/manifests").where(F.col("batch") > after)


def kept(spark: SparkSession, path: str) -> DataFrame:
    """The observations of all committed segments."""
    return spark.read.parquet(f"{path}/segments").join(segments(spark, path).select(F.col("batch").cast("int").alias("batch")), "batch", "left_semi")


def touched_minutes(spark: SparkSession, path: str, after: int) -> DataFrame:
    """bucket_start of the minutes that segments after a batch touch, from their manifests alone."""
    return segments(spark, path, after).select(F.explode("minutes").alias("bucket_start")).distinct()


def redirty(sessions: DataFrame) -> DataFrame:
    """Minutes of failed sessions, to be calculated anew: bucket_start."""
    from tidemark.operators.measure import overlap

    return overlap(sessions.where("failed"), [], "start", "end", "MINUTE").select("bucket_start").distinct()


def fill_minutes(minutes: DataFrame, sessions: DataFrame) -> DataFrame:
    """Minutes that a session covers but that no message made get a valid zero row."""
    from tidemark.operators.measure import overlap

    covered = overlap(sessions, [], "start", "end", "MINUTE").select("bucket_start").distinct()
    counts = [c for c in minutes.columns if c != "bucket_start"]
    return covered.join(minutes, "bucket_start", "left").fillna(0, counts)
