"""Queries of JSON texts: canonical payloads, failures, nested configurations, versions by key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import json_texts as J
from tidemark.plans.bindings import EVENTS, WIDER, events, table
from tidemark.plans.registry import query


def payload() -> Column:
    """A turn as JSON text: keys, spaces and numbers are written in another way in every other turn."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)
    one = F.to_json(F.struct(role.alias("role"), text.alias("text"), F.col("turn"), F.struct(F.col("turn").alias("z"), role.alias("a")).alias("meta")))
    other = F.concat(F.lit('{ "turn" : '), F.col("turn").cast("string"), F.lit('.0,\n "text": '), quoted(text), F.lit(', "meta": {"a" :'), quoted(role), F.lit(', "z":'), F.col("turn").cast("string"), F.lit('e0 }, "role":'), quoted(role), F.lit("}"))
    return F.when(F.col("turn") % 2 == 0, one).otherwise(other)


TOLD = "json_object('meta', json_object('a', coalesce(role, ''), 'z', turn), 'role', coalesce(role, ''), 'text', coalesce(text, ''), 'turn', turn)::VARCHAR"


@query("canonical_payloads", f"SELECT conv_id, turn, strlen({TOLD})::INTEGER AS payload_bytes, sha256({TOLD}) AS payload_sha256 FROM conversations")
def canonical_payloads(spark, d):
    """Every turn's payload as one text with its digest, however its keys and numbers are written."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("record_id"), payload().alias("payload"))
    return J.prepare_records(rows, "record_id", "payload", 1 << 24).select("conv_id", "turn", "payload_bytes", "payload_sha256")


@query(
    "raw_record_failures",
    f"""WITH p AS (SELECT conv_id, turn, strlen({TOLD}) AS n FROM conversations), f AS (SELECT CASE WHEN conv_id % 10 = 7 OR conv_id % 10 IN (3, 5, 8) THEN 'SCHEMA_ERROR' WHEN n > 400 THEN 'PAYLOAD_LIMIT_EXCEEDED' ELSE 'NONE' END AS failure, CASE WHEN conv_id % 10 NOT IN (3, 5, 7, 8) AND n <= 400 THEN n END AS n FROM p)
    SELECT failure, count(*) AS n, coalesce(sum(n), 0)::BIGINT AS payload_bytes FROM f GROUP BY 1""",
)
def raw_record_failures(spark, d):
    """Records that are none: cut short, with a repeated key, a number beyond all bounds or no identity; and those too large."""
    c = F.col("conv_id") % 10
    odd = F.when(c == 3, F.left("payload", F.length("payload") - 1)).when(c == 5, F.concat(F.lit('{"role":1,'), F.substring("payload", 2, 1 << 30), F.lit(""))).when(c == 8, F.concat(F.lit("[1e999,"), F.col("payload"), F.lit("]"))).otherwise(F.col("payload"))
    rows = table(spark, d, "conversations").select("conv_id", F.when(c == 7, "  ").otherwise(F.concat_ws("/", "conv_id", "turn")).alias("record_id"), payload().alias("payload")).withColumn("payload", odd)
    out = J.prepare_records(rows, "record_id", "payload", 400)
    return out.groupBy(F.coalesce("failure", F.lit("NONE")).alias("failure")).agg(F.count("*").alias("n"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).cast("long").alias("payload_bytes"))


NESTED = """cf AS (SELECT event_id, user_id, k, user_id % 12 AS deep, event_id % 4 AS wide, '{"id":' || event_id || ',"configurations":[{"nodes":[' || repeat('{"operator":"OR","cpeMatch":[{"criteria":"c"}],"children":[', CAST(user_id % 12 AS INTEGER)) || '{"cpeMatch":[' || array_to_string(list_transform(generate_series(1, event_id % 4), lambda i: '{"criteria":"x","children":[7]}'), ',') || ']}' || repeat(']}', CAST(user_id % 12 AS INTEGER)) || ']}]}' AS j FROM ev)"""


def nested(spark, d):
    """Configurations nested as deep as the user's number says, with as many criteria at the bottom as the event's."""
    deep, wide = (F.col("user_id") % 12).cast("int"), (F.col("event_id") % 4).cast("int")
    inner = F.concat(F.lit('{"cpeMatch":['), F.array_join(F.array_repeat(F.lit('{"criteria":"x","children":[7]}'), wide), ","), F.lit("]}"))
    text = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"configurations":[{"nodes":['), F.repeat(F.lit('{"operator":"OR","cpeMatch":[{"criteria":"c"}],"children":['), deep), inner, F.repeat(F.lit("]}"), deep), F.lit("]}]}"))
    # An event becomes a text of a kilobyte and is read level by level: events are dealt wider than their own size asks for.
    parts = WIDER * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return events(spark, d).select("event_id", "user_id").repartition(parts, "event_id").select("event_id", text.alias("j"))


@query("configuration_counts_any_depth", f"WITH {EVENTS}, {NESTED} SELECT event_id, 1 + deep AS nodes, len(regexp_extract_all(j, 'criteria')) AS matches FROM cf")
def configuration_counts(spark, d):
    """Nodes and match criteria of configurations of up to thirteen levels."""
    return J.configuration_counts(nested(spark, d), ["event_id"], "j")


KEYED = """kv AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '{"a":[{"cvssMetricV31":[1]}]}' WHEN 1 THEN '{"x":{"CVSSMETRICV2_old":{"cvssmetricv40":0}}}' WHEN 2 THEN '{"a":"cvssMetricV30"}' WHEN 3 THEN '{"a":[[[{"myCvssMetricV30":null}]]],"b":"\\"cvssMetricV2\\": 1"}' WHEN 4 THEN '[]' ELSE '{"cvssMetricV2":{"cvssMetricV31":[]}}' END AS j FROM events)"""


@query("cvss_versions_any_depth", f"WITH {KEYED} SELECT event_id, CASE event_id % 6 WHEN 0 THEN '3.1' WHEN 1 THEN '2.0,4.0' WHEN 2 THEN '' WHEN 3 THEN '3.0' WHEN 4 THEN '' ELSE '2.0,3.1' END AS versions FROM kv")
def cvss_versions(spark, d):
    """Versions named by a key at any depth, in any case; values that look like a key name none."""
    texts = ['{"a":[{"cvssMetricV31":[1]}]}', '{"x":{"CVSSMETRICV2_old":{"cvssmetricv40":0}}}', '{"a":"cvssMetricV30"}', '{"a":[[[{"myCvssMetricV30":null}]]],"b":"\\"cvssMetricV2\\": 1"}', "[]", '{"cvssMetricV2":{"cvssMetricV31":[]}}']
    json = F.get(F.array(*[F.lit(t) for t in texts]), (F.col("event_id") % 6).cast("int"))
    return events(spark, d).select("event_id", F.array_join(J.cvss_versions(json), ",").alias("versions"))
