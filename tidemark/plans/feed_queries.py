"""Queries of the feeds' readers: events, pages and documents rendered as the documents that feeds send, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.bindings import EVENTS, events, stamp, table
from tidemark.plans.registry import query
from tidemark.sources import feeds as S

FORM = "'%Y-%m-%d %H:%M:%S'"
DAY = "yyyy-MM-dd"


def rendered(rows: DataFrame, text: Column) -> DataFrame:
    """One document for each row."""
    return rows.select(text.alias("value"))


def json(**columns: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]))


def daily(spark, d, member: Column) -> DataFrame:
    """A document's members for each user and day."""
    e = events(spark, d)
    return e.withColumn("m", member).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_list("m")).alias("members"), F.min("event_id").alias("least"))


def cve(n: Column) -> Column:
    return F.concat(F.lit("CVE-2024-"), (1000 + n).cast("string"))


@query(
    "read_catalogue",
    f"""WITH {EVENTS}, m AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, CASE WHEN event_id % 50 = 0 THEN 'NO-1' ELSE 'CVE-2024-' || (1000 + event_id) END AS id, ts FROM ev)
    SELECT id AS cve_id, strftime(ts, '%Y-%m-%d') AS added, CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(ts + INTERVAL 14 DAY, '%Y-%m-%d') END AS due, 'v' || user_id AS version FROM m""",
)
def read_catalogue(spark, d):
    """Entries of catalogue snapshots, with their dates."""
    n = F.col("event_id")
    member = F.struct(F.when(n % 50 == 0, "NO-1").otherwise(cve(n)).alias("cveID"), F.date_format("ts", DAY).alias("dateAdded"), F.when(n % 3 == 0, "soon").otherwise(F.date_format(F.date_add("ts", 14), DAY)).alias("dueDate"))
    docs = rendered(daily(spark, d, member), json(catalogVersion=F.concat(F.lit("v"), "user_id"), count=F.size("members"), vulnerabilities=F.col("members")))
    entries, _, _ = S.scan_catalog(spark, docs)
    return entries.select(F.col("cveID").alias("cve_id"), F.date_format("date_added", DAY).alias("added"), F.date_format("due_date", DAY).alias("due"), F.col("catalogVersion").alias("version"))


@query(
    "catalogue_violations",
    f"""WITH {EVENTS}, m AS (SELECT user_id, CAST(ts AS DATE) AS day, min(event_id) AS least FROM ev GROUP BY 1, 2) SELECT 'COUNT_MISMATCH' AS kind, count(*) AS n FROM m WHERE least % 4 = 0
    UNION ALL SELECT 'DUPLICATE_ID', count(*) FROM (SELECT event_id // 2 FROM ev GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'INVALID_ENTRY', count(*) FROM ev WHERE event_id % 25 = 0""",
)
def catalogue_violations(spark, d):
    """What is wrong with snapshots: counts that don't fit, repeated ids, entries without a date."""
    n = F.col("event_id")
    member = F.struct(cve(F.floor(n / 2)).alias("cveID"), F.when(n % 25 == 0, "never").otherwise(F.date_format("ts", DAY)).alias("dateAdded"))
    docs = rendered(daily(spark, d, member), json(count=F.size("members") + F.when(F.col("least") % 4 == 0, 1).otherwise(0), vulnerabilities=F.col("members")))
    return S.scan_catalog(spark, docs)[2].groupBy("kind").agg(F.count("*").alias("n"))


@query(
    "read_paged",
    f"""WITH {EVENTS} SELECT 'CVE-2024-' || (1000 + event_id) AS cve_id, CASE WHEN event_id % 2 = 0 THEN 'Analyzed' ELSE 'Modified' END AS status, strftime(ts, {FORM}) AS published, CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(ts + INTERVAL 1 DAY, {FORM}) END AS modified, CASE WHEN event_id % 3 = 0 THEN 'CWE-20,CWE-79' ELSE '' END AS cwes, CASE event_id % 4 WHEN 0 THEN '2.0,3.1' WHEN 1 THEN '4.0' ELSE '' END AS cvss FROM ev""",
)
def read_paged(spark, d):
    """Records of a paged feed, with identifiers and versions from any depth of their payload."""
    n = F.col("event_id")
    local = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    metrics = F.when(n % 4 == 0, '{"cvssMetricV31":[{"a":1}],"cvssMetricV2":[]}').when(n % 4 == 1, '{"x":{"cvssMetricV40":[]}}').otherwise("{}")
    weak = F.when(n % 3 == 0, '[{"description":[{"value":"CWE-79"}]},{"deep":{"value":"CWE-20"}}]').otherwise("[]")
    one = F.concat(F.lit('{"cve":{"id":"'), cve(n), F.lit('","vulnStatus":"'), F.when(n % 2 == 0, "Analyzed").otherwise("Modified"), F.lit('","published":"'), local("ts"), F.lit('","lastModified":"'), F.when(n % 7 == 0, "later").otherwise(local(F.timestamp_micros(F.unix_micros("ts") + 86_400_000_000))), F.lit('","metrics":'), metrics, F.lit(',"weaknesses":'), weak, F.lit("}}"))
    docs = rendered(daily(spark, d, one), F.concat(F.lit('{"startIndex":0,"totalResults":5,"vulnerabilities":['), F.array_join("members", ","), F.lit("]}")))
    rows, _ = S.scan_paged(spark, docs)
    return rows.select("cve_id", "status", stamp("published").alias("published"), stamp("modified").alias("modified"), F.array_join("cwes", ",").alias("cwes"), F.array_join("cvss", ",").alias("cvss"))


@query(
    "read_ioc_reports",
    f"""WITH {EVENTS}, m AS (SELECT *, min(event_id) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS least FROM ev) SELECT CAST(event_id AS VARCHAR) AS id, '10.0.0.' || (event_id % 250) || ':80' AS ioc, CASE WHEN event_id % 9 <> 0 THEN strftime(ts, {FORM}) END AS first_seen FROM m WHERE least % 5 <> 0""",
)
def read_ioc_reports(spark, d):
    """Reports of envelopes that are in order; others give none."""
    n = F.col("event_id")
    form = F.when(n % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
    member = F.struct(n.cast("string").alias("id"), F.concat(F.lit("10.0.0."), n % 250, F.lit(":80")).alias("ioc"), F.when(n % 9 == 0, "yesterday").otherwise(form).alias("first_seen"))
    docs = rendered(daily(spark, d, member), json(query_status=F.when(F.col("least") % 5 == 0, "no_result").otherwise("ok"), data=F.col("members")))
    return S.scan_ioc_reports(spark, docs)[0].select("id", "ioc", stamp("first_seen_at").alias("first_seen"))


@query("read_samples", f"""WITH {EVENTS} SELECT count(*) AS "count", count(DISTINCT event_id // 3) AS ids, strftime(min(ts), {FORM}) AS oldest, strftime(max(ts), {FORM}) AS newest FROM ev""")
def read_samples(spark, d):
    """The manifest of samples: how many, how many different, first and last sight."""
    member = F.struct(F.sha2(F.floor(F.col("event_id") / 3).cast("string"), 256).alias("sha256_hash"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))
    docs = rendered(daily(spark, d, member), json(query_status=F.lit("ok"), data=F.col("members")))
    return S.scan_samples(spark, docs)[1].select("count", "ids", stamp("oldest").alias("oldest"), stamp("newest").alias("newest"))


@query("read_endpoints", f"""WITH {EVENTS} SELECT '10.0.' || (event_id % 7) || '.' || (event_id % 250) AS ip_address, CAST(1 + event_id % 1000 AS INTEGER) AS port, count(*) AS n FROM ev GROUP BY 1, 2""")
def read_endpoints(spark, d):
    """Endpoints of a list that is one array, counted by their identity."""
    n = F.col("event_id")
    member = F.struct(F.concat(F.lit("10.0."), n % 7, F.lit("."), n % 250).alias("ip_address"), (1 + n % 1000).cast("int").alias("port"), F.lit("Emotet").alias("malware"), F.lit("2024-01-01 00:00:00").alias("first_seen"))
    docs = rendered(daily(spark, d, member), F.to_json("members"))
    out = S.scan_c2(spark, docs).groupBy("record_id").agg(F.min("ip_address").alias("ip_address"), F.min("port").alias("port"), F.count("*").alias("n"))
    return out.drop("record_id")


@query(
    "read_package_advisories",
    f"""WITH {EVENTS} SELECT 'GHSA-' || event_id AS ghsa_id, CASE event_id % 3 WHEN 0 THEN 'high' ELSE 'low' END AS severity, strftime(ts, {FORM}) AS published, CASE WHEN event_id % 4 > 0 THEN 'npm' END AS ecosystem, CASE WHEN event_id % 4 > 0 THEN 'p' || i END AS package FROM ev, range(4) r(i) WHERE i < greatest(event_id % 4, 1)""",
)
def read_package_advisories(spark, d):
    """A row for each package that an advisory names, one without for those that name none."""
    n = F.col("event_id")
    packages = F.transform(F.filter(F.sequence(F.lit(0), F.lit(2)), lambda i: i < n % 4), lambda i: F.struct(F.struct(F.lit("npm").alias("ecosystem"), F.concat(F.lit("p"), i).alias("name")).alias("package")))
    docs = rendered(events(spark, d), json(ghsa_id=F.concat(F.lit("GHSA-"), n), severity=F.when(n % 3 == 0, "high").otherwise("low"), published_at=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), vulnerabilities=packages))
    return S.scan_advisories(spark, docs).select("ghsa_id", "severity", stamp("published").alias("published"), "ecosystem", "package")


@query(
    "read_advisory_documents",
    """SELECT 'ICSA-' || doc_id AS advisory_id, lang AS title, source AS publisher, 'CVE-2024-' || (1000 + doc_id % 50) AS cves, 'CWE-' || (1 + doc_id % 9) AS cwes, CASE WHEN doc_id % 2 = 0 THEN 'Energy,Water' ELSE '' END AS sectors FROM documents""",
)
def read_advisory_documents(spark, d):
    """Advisory documents: identifiers of their text, sectors of the note that lists them."""
    n = F.col("doc_id")
    notes = F.array(F.struct(F.when(n % 2 == 0, "Critical Infrastructure Sectors").otherwise("Other").alias("title"), F.lit(" Water, Energy ,, Water").alias("text")))
    document = F.struct(F.struct(F.concat(F.lit("ICSA-"), n).alias("id")).alias("tracking"), F.col("lang").alias("title"), F.struct(F.col("source").alias("name")).alias("publisher"), notes.alias("notes"))
    told = F.concat(F.lit("see "), cve(n % 50), F.lit(" and cve-2024-"), (1000 + n % 50).cast("string"), F.lit(" of CWE-"), 1 + n % 9)
    docs = rendered(table(spark, d, "documents"), json(document=document, text=told))
    return S.scan_csaf(spark, docs).select("advisory_id", "title", "publisher", *[F.array_join(c, ",").alias(c) for c in ("cves", "cwes", "sectors")])


@query(
    "read_news_items",
    """SELECT 'JVNDB-' || page_id AS record_id, 'About ' || page_id AS title, '2024-01-02 00:00:00' AS published, CASE WHEN page_id % 2 = 0 THEN 'CVE-2024-' || (1000 + page_id) ELSE '' END AS cves FROM pages""",
)
def read_news_items(spark, d):
    """Items of an RDF feed."""
    n = F.col("page_id")
    text = F.concat(F.lit('<item><title>About '), n, F.lit("</title><link>https://a.b/</link><description>"), F.when(n % 2 == 0, cve(n)).otherwise("nothing"), F.lit("</description><dc:date>2024-01-02T09:00:00+09:00</dc:date><sec:identifier>JVNDB-"), n, F.lit("</sec:identifier></item>"))
    return S.scan_rdf(spark, rendered(table(spark, d, "pages"), text)).select("record_id", "title", stamp("published").alias("published"), F.array_join("cves", ",").alias("cves"))


@query(
    "read_vendor_entries",
    f"""WITH {EVENTS} SELECT CASE WHEN event_id % 3 = 0 THEN 'SSA-' || event_id ELSE 'rolie:' || sha256('entry-' || event_id) END AS record_id, CASE WHEN event_id % 2 = 0 THEN 'CVE-2024-' || (1000 + event_id) ELSE '' END AS cves FROM ev""",
)
def read_vendor_entries(spark, d):
    """Entries of a ROLIE feed: their number, or a key of the entry's id."""
    n = F.col("event_id")
    member = F.struct(F.when(n % 3 == 0, F.concat(F.lit("urn:ssa-"), n)).otherwise(F.concat(F.lit("Entry-"), n)).alias("id"), F.when(n % 2 == 0, cve(n)).otherwise("t").alias("title"))
    docs = rendered(daily(spark, d, member), json(feed=F.struct(F.col("members").alias("entry"))))
    return S.scan_rolie(spark, docs).select("record_id", F.array_join("cves", ",").alias("cves"))


@query(
    "read_techniques",
    f"""WITH {EVENTS} SELECT 'T' || event_id AS external_id, event_type AS name, event_id % 5 = 0 AS revoked, CASE WHEN event_id % 2 = 0 THEN 'access,impact' ELSE 'impact' END AS tactics FROM ev WHERE event_id % 4 <> 0""",
)
def read_techniques(spark, d):
    """Attack patterns of a bundle; objects of other types aren't any."""
    n = F.col("event_id")
    other = F.struct(F.lit("other").alias("source_name"), F.lit("X").alias("external_id"))
    phases = F.when(n % 2 == 0, F.array(F.lit("impact"), F.lit("access"), F.lit("impact"))).otherwise(F.array(F.lit("impact")))
    member = F.struct(F.when(n % 4 == 0, "malware").otherwise("attack-pattern").alias("type"), F.col("event_type").alias("name"), F.when(n % 5 == 0, True).alias("revoked"), F.array(other, F.struct(F.lit("mitre-attack").alias("source_name"), F.concat(F.lit("T"), n).alias("external_id"))).alias("external_references"), F.transform(phases, lambda p: F.struct(p.alias("phase_name"))).alias("kill_chain_phases"))
    docs = rendered(daily(spark, d, member), json(objects=F.col("members")))
    return S.scan_stix(spark, docs).select("external_id", "name", "revoked", F.array_join("tactics", ",").alias("tactics"))


@query(
    "read_messages",
    f"""WITH {EVENTS} SELECT rejected, coalesce(rrc, '') AS rrc, count(*) AS n, CAST(sum(a) AS BIGINT) AS announced, CAST(sum(o) AS BIGINT) AS origins FROM (SELECT event_id % 11 = 0 AS rejected, CASE WHEN event_id % 11 <> 0 THEN 'rrc' || lpad(CAST(user_id % 3 AS VARCHAR), 2, '0') END AS rrc,
      CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS a, CASE WHEN event_id % 11 = 0 OR event_id % 5 = 0 THEN 0 ELSE 1 END AS o FROM ev) GROUP BY 1, 2""",
)
def read_messages(spark, d):
    """Routing messages, and lines that are none; a path that ends in a set names no origin."""
    n = F.col("event_id")
    path = F.when(n % 5 == 0, '[1,"{64496,64497}"]').otherwise(F.concat(F.lit("[1,"), 64500 + F.col("user_id") % 20, F.lit("]")))
    more = F.when(n % 2 == 0, '"10.0.1.0/24","10.0.0.0/24","10.0.1.0/24"').otherwise('"10.0.1.0/24"')
    good = F.concat(F.lit('{"id":"m'), n, F.lit('","timestamp":'), F.unix_timestamp("ts").cast("string"), F.lit(',"host":"rrc'), F.lpad((F.col("user_id") % 3).cast("string"), 2, "0"), F.lit('.x","peer":"1.2.3.4","peer_asn":"7","path":'), path, F.lit(',"announcements":[{"next_hop":"n","prefixes":['), more, F.lit("]}]}"))
    lines = events(spark, d).select(F.when(n % 11 == 0, "no message").otherwise(good).alias("value"))
    out = S.parse_messages(lines)
    return out.groupBy("rejected", F.coalesce("rrc", F.lit("")).alias("rrc")).agg(F.count("*").alias("n"), F.sum(F.size("announced")).alias("announced"), F.sum(F.size("origins")).alias("origins"))
