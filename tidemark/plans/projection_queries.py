"""Queries of canonical records and projected facts: events rendered as the rows that feeds' readers give, by source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.plans.bindings import EVENTS, events, stamp
from tidemark.plans.registry import query
from tidemark.sources import canonical as C
from tidemark.sources import projection as P

S = "'%Y-%m-%d %H:%M:%S'"
#: What every record says of its run: one in four an initial load, one a recovery; revisions 1 to 3.
RUN = """n AS (SELECT event_id AS id, ts, user_id AS u, event_type AS k, ts + INTERVAL 1 HOUR AS got, ['SCHEDULED', 'SCHEDULED', 'BOOTSTRAP', 'RECOVERY'][event_id % 4 + 1] AS trig, 1 + event_id % 3 AS rev, 'CVE-2024-' || (1000 + user_id) AS cve,
  CASE event_id % 4 WHEN 2 THEN 'INITIAL_BOOTSTRAP' WHEN 3 THEN 'RECOVERY' ELSE 'LIVE_INCREMENTAL' END AS basis, event_id % 4 < 2 AS live FROM ev)"""


def runs_of(spark, d, kind: str):
    e, n = events(spark, d).where(F.col("event_type") == kind), F.col("event_id")
    trigger = F.get(F.array(*[F.lit(x) for x in ("SCHEDULED", "SCHEDULED", "BOOTSTRAP", "RECOVERY")]), (n % 4).cast("int"))
    return e.withColumns({"received_at": F.timestamp_micros(F.unix_micros("ts") + 3_600_000_000), "trigger": trigger, "purpose": F.when(n % 4 == 2, "INITIAL_BOOTSTRAP").otherwise("LIVE_INCREMENTAL"), "raw_record_id": F.concat(F.lit("raw-"), n), "revision_number": (1 + n % 3).cast("int"), "cve": F.concat(F.lit("CVE-2024-"), 1000 + F.col("user_id"))})


def facts(spark, d, kind: str, source: str, **columns: Column):
    rows = runs_of(spark, d, kind).withColumns(columns)
    out = P.project_facts(C.normalize(rows, C.mappings()[source]), [r for r in P.rules() if r.source_key == source])
    dims = F.array_join(F.array_sort(F.transform(F.map_entries("dimensions"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return out.select("source_record_id", "measurement_key", "fact_key", "fact_kind", F.coalesce(stamp("event_time"), F.date_format("event_date", "yyyy-MM-dd")).alias("at"), "precision", "value", "entity_key", "entity_type", dims.alias("dims"), "basis", "model")


def fact_sql(record: str, measurement: str, identity: str, kind: str, at: str, entity: str, where: str = "TRUE", precision: str = "INSTANT", value: str = "1.0", entity_type: str = "'CVE'", dims: str = "''", basis: str = "basis", model: str = "NULL") -> str:
    """A select of one rule over r; identity is the SQL of its JSON text."""
    return f"""SELECT {record} AS source_record_id, '{measurement}' AS measurement_key, sha256('{{"identity":' || {identity} || ',"measurementKey":"{measurement}"}}') AS fact_key, '{kind}' AS fact_kind, {at} AS at, '{precision}' AS precision,
      CAST({value} AS DOUBLE) AS value, {entity} AS entity_key, {entity_type} AS entity_type, {dims} AS dims, {basis} AS basis, CAST({model} AS VARCHAR) AS model FROM r WHERE {where}"""


def with_rows(kind: str, columns: str, *selects: str) -> str:
    return f"WITH {EVENTS}, {RUN}, r AS (SELECT *, {columns} FROM n WHERE k = '{kind}') {' UNION ALL '.join(selects)}"


NVD = "json_object('cve', cve)::VARCHAR"


@query(
    "projected_nvd_facts",
    with_rows(
        "click", "ts AS pub",
        fact_sql("cve", "vulnerability.nvd.publications", NVD, "EVENT", f"strftime(ts, {S})", "'cve:' || cve", "id % 11 <> 0", dims="CASE WHEN id % 2 = 0 THEN 'NVD_CVSS_VERSION=2.0|3.1,NVD_CWE=CWE-20|CWE-79,NVD_VULN_STATUS=Analyzed' ELSE 'NVD_VULN_STATUS=Analyzed' END"),
        fact_sql("cve", "vulnerability.nvd.modifications", """json_object('cve', cve, 'lastModified', strftime(ts + INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%S.') || lpad(((epoch_us(ts) // 1000) % 1000)::VARCHAR, 3, '0') || 'Z')::VARCHAR""", "EVENT", f"strftime(ts + INTERVAL 2 DAY, {S})", "'cve:' || cve", "id % 5 <> 0"),
    ),
)
def nvd_facts(spark, d):
    """Publications and modifications; every modification of a vulnerability is a fact of its own."""
    n = F.col("event_id")
    payload = F.when(n % 2 == 0, '{"metrics":{"cvssMetricV31":[{"x":1}],"cvssMetricV2":[]},"weaknesses":[{"description":[{"value":"CWE-79"}]},"CWE-20"]}').otherwise("{}")
    return facts(spark, d, "click", "NVD_CVE", cve_id=F.concat(F.lit("CVE-2024-"), 1000 + F.col("user_id")), status=F.lit("Analyzed"), published=F.when(n % 11 != 0, F.col("ts")), modified=F.when(n % 5 != 0, F.timestamp_micros(F.unix_micros("ts") + 172_800_000_000)), payload=payload)


BAND = "CASE WHEN s < 0.2 THEN '0.10-0.20' WHEN s < 0.4 THEN '0.20-0.40' WHEN s < 0.6 THEN '0.40-0.60' WHEN s < 0.8 THEN '0.60-0.80' ELSE '0.80-1.00' END"


@query(
    "projected_epss_facts",
    with_rows(
        "purchase", "(id % 100) / 100.0 AS s, CASE WHEN id % 3 <> 0 THEN 'P1' END AS prof, strftime(ts, '%Y-%m-%d') AS day",
        fact_sql("cve", "exploitation.epss.score_distribution", "json_object('cve', cve, 'profile', prof, 'scoreDate', day)::VARCHAR", "SNAPSHOT_VALUE", "day", "'cve:' || cve", "id % 6 <> 0", "DATE", "(id % 100) / 100", dims=f"CASE WHEN prof IS NULL THEN '' ELSE 'EPSS_CAPTURE_PROFILE=P1,' END || 'EPSS_SCORE_BAND=' || {BAND}", model="'v3'"),
    ),
)
def epss_facts(spark, d):
    """Scores are facts of their date, in a band, under a profile that may be unknown."""
    n = F.col("event_id")
    return facts(spark, d, "purchase", "FIRST_EPSS", score_text=((n % 100) / 100).cast("string"), percentile=F.lit(0.5), score_date=F.when(n % 6 != 0, F.date_format("ts", "yyyy-MM-dd")), model_version=F.lit("v3"), profile=F.when(n % 3 != 0, "P1"))


@query(
    "projected_ioc_facts",
    with_rows(
        "view", "'10.0.0.' || (id % 250) AS ip, id % 7 <> 0 AS timed, CASE WHEN id % 2 = 1 THEN 'Win.' || u END AS mal",
        fact_sql("id::VARCHAR", "ioc.threatfox.reporting_volume", "json_object('reportId', id::VARCHAR)::VARCHAR", "OBSERVATION", f"strftime(ts, {S})", "'threatfox:ioc:' || id", "timed", entity_type="'REPORT'", dims="CASE WHEN id % 5 = 0 THEN 'IOC_TYPE=md5_hash' ELSE 'IOC_TYPE=ip:port' END || CASE WHEN mal IS NULL THEN '' ELSE ',THREATFOX_MALWARE_LABEL=' || mal END"),
        fact_sql("id::VARCHAR", "ioc.threatfox.distinct_indicators", "json_object('reportId', id::VARCHAR)::VARCHAR", "OBSERVATION", f"strftime(ts, {S})", "ip", "timed AND id % 5 <> 0", entity_type="'IP'", dims="'IOC_TYPE=ip:port'"),
        fact_sql("id::VARCHAR", "ioc.threatfox.report_updates_observed", "json_object('rawRecordId', 'raw-' || id, 'reportId', id::VARCHAR)::VARCHAR", "OBSERVATION", f"strftime(got, {S})", "'threatfox:ioc:' || id", "rev > 1 AND live", entity_type="'REPORT'"),
    ),
)
def ioc_facts(spark, d):
    """Reports, their indicators, and updates that a live run saw; some values are no indicator, some have no time."""
    n = F.col("event_id")
    broken = n % 5 == 0
    return facts(spark, d, "view", "THREATFOX", id=n.cast("string"), ioc=F.when(broken, "none").otherwise(F.concat(F.lit("10.0.0."), n % 250, F.lit(":80"))), ioc_type=F.when(broken, "md5_hash").otherwise("ip:port"), malware=F.when(n % 2 == 1, F.concat(F.lit("Win."), "user_id")), malware_printable=F.lit(None).cast("string"), first_seen_at=F.when(n % 7 != 0, F.col("ts")), reference=F.lit(None).cast("string"))


@query(
    "projected_kev_facts",
    with_rows(
        "signup", "strftime(ts, '%Y-%m-%d') AS day",
        fact_sql("cve", "vulnerability.cisa_kev.additions", NVD, "EVENT", "day", "'cve:' || cve", "id % 9 <> 0", "DATE", basis="CASE basis WHEN 'INITIAL_BOOTSTRAP' THEN 'SNAPSHOT_RECONSTRUCTION' ELSE basis END"),
        fact_sql("cve", "vulnerability.cisa_kev.updates_observed", "json_object('rawRecordId', 'raw-' || id, 'sourceRecordId', cve)::VARCHAR", "OBSERVATION", f"strftime(got, {S})", "'cve:' || cve", "rev > 1 AND live"),
    ),
)
def kev_facts(spark, d):
    """Additions by the catalogue's own dates, which an initial load rebuilds, and updates that a live run saw."""
    return facts(spark, d, "signup", "CISA_KEV", cveID=F.concat(F.lit("CVE-2024-"), 1000 + F.col("user_id")), vendorProject=F.lit("Acme"), product=F.lit("Box"), date_added=F.when(F.col("event_id") % 9 != 0, F.date_trunc("day", "ts")))


@query(
    "projected_c2_facts",
    with_rows(
        "error", """sha256('{"firstSeen":"2024-01-01 00:00:00","ip":"10.0.0.' || (id % 250) || '","malware":"Emotet","port":' || (1 + id % 65535) || '}') AS ident""",
        fact_sql("id::VARCHAR", "ioc.feodo_tracker.new_records_observed", "json_object('endpointIdentity', ident)::VARCHAR", "OBSERVATION", f"strftime(got, {S})", "'10.0.0.' || (id % 250)", "rev = 1 AND live", entity_type="'IP'", dims="CASE WHEN id % 2 = 0 THEN 'FEODO_COUNTRY=DE,' ELSE '' END || 'FEODO_MALWARE_LABEL=Emotet'"),
    ),
)
def c2_facts(spark, d):
    """Endpoints that a live run saw for the first time."""
    n = F.col("event_id")
    return facts(spark, d, "error", "FEODO_TRACKER", record_id=n.cast("string"), ip_address=F.concat(F.lit("10.0.0."), n % 250), port=(1 + n % 65535).cast("int"), malware=F.lit("Emotet"), first_seen=F.lit("2024-01-01 00:00:00"), country=F.when(n % 2 == 0, "DE"))
