"""Queries of the text and identity functions over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.functions.hosts import with_ascii_hosts
from tidemark.plans.bindings import events, table
from tidemark.plans.registry import query

IP = r"\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b"


@query(
    "indicators_from_pages",
    """SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/?#\\s@]+([/?#]\\S*)?$') THEN 'NORMALIZED' ELSE 'INVALID_SOURCE_VALUE' END AS url_status, CASE WHEN regexp_matches(url, '^https?://[^/?#\\s@]+([/?#]\\S*)?$') THEN url END AS url_key,
    lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS domain_key, 'UNMAPPED' AS other_status FROM pages""",
)
def indicators(spark, d):
    """Page addresses as url and domain indicators."""
    p = table(spark, d, "pages")
    host = F.concat(F.upper(F.regexp_extract("url", "^https?://([^/?#:]+)", 1)), F.lit("."))
    rows = p.select("page_id", X.normalize_indicator(F.lit("url"), F.col("url")).alias("u"), X.normalize_indicator(F.lit("domain"), host).alias("h"), X.normalize_indicator(F.lit("mutex"), F.col("url")).alias("o"))
    return rows.select("page_id", F.col("u.status").alias("url_status"), F.col("u.key").alias("url_key"), F.col("h.key").alias("domain_key"), F.col("o.status").alias("other_status"))


@query(
    "ports_and_hashes",
    """SELECT event_id, CASE WHEN p BETWEEN 1 AND 65535 THEN 'NORMALIZED' ELSE 'INVALID_SOURCE_VALUE' END AS status, CASE WHEN p BETWEEN 1 AND 65535 THEN ip END AS ip, CAST(CASE WHEN p BETWEEN 1 AND 65535 THEN p END AS INTEGER) AS port, md5(CAST(event_id AS VARCHAR)) AS md5
    FROM (SELECT event_id, '10.0.' || (event_id % 256) || '.' || (user_id % 256) AS ip, event_id * 7 % 70000 AS p FROM events)""",
)
def ports(spark, d):
    """ip:port and md5 indicators made of events; ports beyond the range are invalid."""
    e = events(spark, d)
    address = F.concat(F.lit("10.0."), F.col("event_id") % 256, F.lit("."), F.col("user_id") % 256, F.lit(":"), F.col("event_id") * 7 % 70000)
    rows = e.select("event_id", X.normalize_indicator(F.lit("ip:port"), address).alias("a"), X.normalize_indicator(F.lit("md5_hash"), F.upper(F.md5(F.col("event_id").cast("string").cast("binary")))).alias("m"))
    return rows.select("event_id", F.col("a.status").alias("status"), F.col("a.key").alias("ip"), F.col("a.port").alias("port"), F.col("m.key").alias("md5"))


@query("address_mentions", f"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{IP}'))), ',') AS addresses FROM documents WHERE regexp_matches(text, '{IP}')")
def address_mentions(spark, d):
    """Dotted quads of every document, distinct and sorted."""
    rows = table(spark, d, "documents").select("doc_id", X.extract_ids("text", IP).alias("a"))
    return rows.where("size(a) > 0").select("doc_id", F.array_join("a", ",").alias("addresses"))


@query(
    "harvested_urls",
    r"""WITH h AS (SELECT page_id, regexp_extract_all(html, '(?i)https?://[^\s;]+') AS u FROM pages), t AS (SELECT page_id, list_filter(list_transform(u, lambda x: regexp_replace(x, '[\])},.]+$', '')), lambda x: length(x) <= 2048 AND regexp_matches(x, '(?i)^https?://[a-z0-9._~-]+(:[0-9]{1,5})?([/?#]|$)')) AS u FROM h),
      n AS (SELECT page_id, list_transform(u, lambda x: [lower(regexp_extract(x, '(?i)^(https?://[^/?#]+)', 1)), replace(replace(replace(replace(replace(replace(regexp_replace(x, '(?i)^https?://[^/?#]+', ''), '"', '%22'), '<', '%3C'), '>', '%3E'), '`', '%60'), '{', '%7B'), '}', '%7D')]) AS u FROM t),
      f AS (SELECT page_id, list_transform(u, lambda x: x[1] || CASE WHEN starts_with(x[2], '/') THEN '' ELSE '/' END || x[2]) AS u FROM n) SELECT page_id, CAST(least(len(list_distinct(u)), 63) AS INTEGER) AS n, u[1] AS first FROM f""",
)
def urls(spark, d):
    """Addresses in page sources; the list's cap of 63 is the feature's."""
    rows = table(spark, d, "pages").select("page_id", X.harvest_urls("html").alias("u"))
    return rows.select("page_id", F.size("u").alias("n"), F.get("u", F.lit(0)).alias("first"))


@query("collapsed_text", "SELECT doc_id, length(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS n, md5(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS digest FROM documents")
def collapsed(spark, d):
    """Documents with runs of white space collapsed."""
    rows = table(spark, d, "documents").select("doc_id", X.collapse_ws("text").alias("t"))
    return rows.select("doc_id", F.length("t").cast("bigint").alias("n"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query("scoped_identity_keys", "SELECT conv_id, turn, 'turn:' || sha256(lower(trim(role)) || chr(0) || CAST(conv_id AS VARCHAR)) AS key FROM conversations")
def scoped(spark, d):
    """Identity keys of trimmed, lower-cased parts."""
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", X.scoped_key("turn:", F.concat(F.lit("  "), F.upper("role")), "conv_id").alias("key"))


@query(
    "strict_times",
    """SELECT event_id % 8 AS form, count(*) AS n, count(*) FILTER (WHERE event_id % 8 IN (0, 2, 4, 6)) AS parsed, strftime(min(CASE event_id % 8 WHEN 0 THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 2 THEN date_trunc('second', ts) WHEN 4 THEN date_trunc('second', ts) WHEN 6 THEN date_trunc('second', ts) - INTERVAL 1 HOUR END), '%Y-%m-%d %H:%M:%S') AS first FROM events GROUP BY 1""",
)
def strict_times(spark, d):
    """Instants in four forms, each also in a wrong one that must not parse."""
    e = events(spark, d).withColumn("form", F.col("event_id") % 8)
    t = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    f = F.col("form")
    value = (
        F.when(f == 0, X.parse_instant(F.concat(iso, F.lit("+02:00"))))
        .when(f == 1, X.parse_instant(iso))
        .when(f == 2, X.parse_instant(F.concat(t, F.lit(" UTC")), "UTC_SUFFIX"))
        .when(f == 3, X.parse_instant(t, "UTC_SUFFIX"))
        .when(f == 4, X.parse_instant(t, "ZONELESS"))
        .when(f == 5, X.parse_instant(F.concat(F.lit("2024-02-30"), F.substring(t, 11, 9)), "ZONELESS"))
        .when(f == 6, X.parse_instant(F.concat(t, F.lit(" CET")), "CENTRAL"))
        .otherwise(X.parse_instant(F.concat(t, F.lit(" EST")), "CENTRAL"))
    )
    return e.withColumn("v", value).groupBy("form").agg(F.count("*").alias("n"), F.count("v").alias("parsed"), F.date_format(F.min("v"), "yyyy-MM-dd HH:mm:ss").alias("first"))


@query("strict_dates", "SELECT event_id % 3 AS form, count(*) AS n, count(*) FILTER (WHERE event_id % 3 = 0) AS parsed FROM events GROUP BY 1")
def strict_dates(spark, d):
    """Calendar dates: the right form, an impossible day, another form."""
    f = F.col("event_id") % 3
    text = F.when(f == 0, F.date_format("ts", "yyyy-MM-dd")).when(f == 1, F.concat(F.date_format("ts", "yyyy"), F.lit("-02-31"))).otherwise(F.date_format("ts", "dd.MM.yyyy"))
    return events(spark, d).select(f.alias("form"), X.parse_date(text).alias("v")).groupBy("form").agg(F.count("*").alias("n"), F.count("v").alias("parsed"))


@query("multi_valued_members", "SELECT m AS member, count(*) AS n FROM (SELECT unnest([lower(lang), source]) AS m FROM documents) GROUP BY 1")
def multi_valued(spark, d):
    """A dimension of several values split on | with blanks dropped."""
    rows = table(spark, d, "documents").select(F.explode(X.members(F.concat(F.lit(" "), F.col("lang"), F.lit(" | |"), F.col("source"), F.lit("|")))).alias("member"))
    return rows.groupBy("member").agg(F.count("*").alias("n"))


@query("fact_lookup", """SELECT user_id, sum(CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END) IS NULL AS none, count(*) FILTER (WHERE event_id % 4 <> 0) AS numbers, count(*) FILTER (WHERE event_id % 5 <> 0) AS kinds FROM events GROUP BY 1""")
def fact_lookup(spark, d):
    """Values from attribute lists: the last duplicate wins, blanks and words are no numbers."""
    pair = lambda p, v: F.struct(F.lit(p).alias("predicate"), v.alias("value"))
    number = F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    kind = F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(F.col("event_type"))
    rows = events(spark, d).select("user_id", F.array(pair("value", F.lit("1")), pair("kind", kind), pair("value", number)).alias("facts"))
    got = rows.select("user_id", X.fact("facts", "value", "double").alias("v"), X.fact("facts", "kind").alias("k"))
    return got.groupBy("user_id").agg(F.sum("v").isNull().alias("none"), F.count("v").alias("numbers"), F.count("k").alias("kinds"))


@query("reference_union", "SELECT user_id % 10 AS grp, CAST(count(DISTINCT event_type) AS INTEGER) AS n FROM events GROUP BY 1")
def reference_union(spark, d):
    """Reference lists united in order of first sight, nulls as empty."""
    rows = events(spark, d).groupBy((F.col("user_id") % 10).alias("grp")).agg(F.collect_set("event_type").alias("a"), F.collect_set("event_type").alias("b"))
    return rows.select("grp", F.size(X.union_refs("a", "b", F.lit(None).cast("array<string>"))).alias("n"))


@query("origin_of_paths", "SELECT CASE WHEN event_id % 6 = 0 THEN NULL ELSE 64500 + user_id % 20 END AS origin, count(*) AS n FROM events GROUP BY 1")
def origins(spark, d):
    """Origins of AS paths: the last element, none for a set."""
    last = F.when(F.col("event_id") % 6 == 0, F.lit("{64500,64501}")).otherwise((F.lit(64500) + F.col("user_id") % 20).cast("string"))
    rows = events(spark, d).select(X.origin_asns(F.array(F.lit("3333"), last)).alias("o"))
    return rows.select(F.get("o", F.lit(0)).alias("origin")).groupBy("origin").agg(F.count("*").alias("n"))


@query(
    "contract_rejects",
    """WITH x AS (SELECT doc_id, CASE WHEN source IS NULL THEN 1 ELSE 0 END AS k, coalesce(length(trim(split_part(text, chr(10), 1))), 0) AS n, coalesce(len(list_distinct(regexp_extract_all(text, 'https?://[^\\s<>"]+'))), 0) AS u, len(string_split(text, ' ')) > 512 AS m FROM documents)
    SELECT doc_id, concat_ws(',', CASE WHEN n NOT BETWEEN 1 AND 1024 THEN 'CANONICAL_KEY_LENGTH' END, CASE WHEN doc_id % 10 = 3 THEN 'ENTITY_KIND_UNKNOWN' END, CASE WHEN n NOT BETWEEN 1 AND 1024 THEN 'ENTITY_KEY_LENGTH' END, CASE WHEN m THEN 'TOO_MANY_FACTS' END, CASE WHEN u > 64 THEN 'TOO_MANY_REFERENCES' END) AS reasons
    FROM x WHERE n NOT BETWEEN 1 AND 1024 OR doc_id % 10 = 3 OR m OR u > 64""",
)
def contract_rejects(spark, d):
    """Documents as records (the first line is key and entity, every word a fact), and why some break the contract."""
    from tidemark.sources.canonical import validate

    doc = table(spark, d, "documents")
    first = F.trim(F.coalesce(F.element_at(F.split("text", "\n"), 1), F.lit("")))
    kind = F.when(F.col("doc_id") % 10 == 3, "NOISE").otherwise("REPORT")
    words = F.coalesce(F.split("text", " "), F.array().cast("array<string>"))
    urls = F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("https?://[^\\s<>\"]+"), F.lit(0)))
    rows = doc.select(
        "doc_id",
        F.lit("THREAT_RESEARCH_REPORT").alias("record_kind"),
        first.alias("canonical_key"),
        F.array(F.struct(kind.alias("kind"), first.alias("key"), F.lit(None).cast("string").alias("label"))).alias("entities"),
        F.transform(words, lambda w: F.struct(F.lit("word").alias("predicate"), w.alias("value"))).alias("facts"),
        urls.alias("reference_urls"),
    )
    return validate(rows)[1].select("doc_id", F.array_join("reasons", ",").alias("reasons"))


#: Labels of other letters and their published forms.
LABELS = {"b\u00fccher": "xn--bcher-kva", "m\u00fcnchen": "xn--mnchen-3ya", "fa\u00df": "xn--fa-hia", "\u0440\u0444": "xn--p1ai", "WWW": "www"}
CODED = "CASE page_id % 5 " + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(LABELS.values())) + " END"


@query("ascii_hosts", f"SELECT page_id, {CODED} || '.' || lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages")
def ascii_hosts(spark, d):
    """Hosts of pages under labels of other letters, written in ASCII."""
    label = F.get(F.array(*[F.lit(x) for x in LABELS]), (F.col("page_id") % len(LABELS)).cast("int"))
    rows = table(spark, d, "pages").select("page_id", F.concat(label, F.lit("."), F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1)).alias("name"))
    return with_ascii_hosts(rows, "name", "host").select("page_id", "host")
