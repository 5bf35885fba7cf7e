import hashlib
import json

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import entities
from tidemark.plans import catalogue
from tidemark.sources import canonical, feeds, projection


def test_every_mapped_source_is_known(spark):
    own = canonical.mappings()
    assert len(own) == 13
    made = {r.measurement: r.source_key for r in projection.rules()}
    assert set(made.values()) <= set(own) and set(made) <= {m.key for m in catalogue.CATALOGUE} and len(made) == 17


def test_reports_become_entities_and_facts(spark, tmp_path):
    rows = [{"id": "1", "ioc": "1.2.3.4:80", "ioc_type": "ip:port", "malware": "Win.X", "first_seen": "2024-01-02 03:04:05 UTC", "reference": "https://a.b/"}, {"id": "2", "ioc": "bad", "ioc_type": "md5_hash", "first_seen": "2024-01-02 03:04:05 UTC"}]
    (tmp_path / "r.json").write_text(json.dumps({"query_status": "ok", "data": rows}))
    reports, _, _ = feeds.scan_ioc_reports(spark, str(tmp_path / "r.json"))
    out = {r.source_record_id: r for r in canonical.normalize(reports, canonical.mappings()["THREATFOX"]).collect()}
    assert [(e.kind, e.key) for e in out["1"].entities] == [("IP", "1.2.3.4"), ("MALWARE", "malpedia:win.x")]
    assert out["2"].entities == [] and out["1"].reference_urls == ["https://threatfox.abuse.ch/ioc/1/", "https://a.b/"] and out["1"].canonical_key == "threatfox:ioc:1"
    assert {f.predicate: f.value for f in out["1"].facts}["threatfox.first_seen"] == "2024-01-02T03:04:05.000Z"
    live = {"trigger": F.lit("SCHEDULED"), "purpose": F.lit("LIVE_INCREMENTAL"), "received_at": F.lit("2024-01-03").cast("timestamp"), "raw_record_id": F.lit("w"), "revision_number": F.lit(1)}
    facts = projection.project_facts(canonical.normalize(reports.withColumns(live), canonical.mappings()["THREATFOX"]))
    per = {(r.measurement_key, r.source_record_id): r for r in facts.collect()}
    assert per["ioc.threatfox.reporting_volume", "1"].dimensions == {"IOC_TYPE": "ip:port", "THREATFOX_MALWARE_LABEL": "Win.X"}
    assert per["ioc.threatfox.distinct_indicators", "1"].entity_key == "1.2.3.4" and ("ioc.threatfox.distinct_indicators", "2") not in per
    assert not any(k.endswith("report_updates_observed") for k, _ in per)


def test_first_sights_of_readers_records_are_novelty_facts(spark, tmp_path):
    """From the reader to the measurement: the sources' keys are the same everywhere."""
    rows = [{"id": str(i), "ioc": f"1.2.3.{i}:80", "ioc_type": "ip:port", "first_seen": "2024-01-02 03:04:05 UTC"} for i in range(3)]
    (tmp_path / "r.json").write_text(json.dumps({"query_status": "ok", "data": rows}))
    out = canonical.normalize(feeds.scan_ioc_reports(spark, str(tmp_path / "r.json"))[0], canonical.mappings()["THREATFOX"])
    history = entities.entity_history(entities.project_observations(out), ["entity_type", "entity_key"])
    facts = entities.novelty_changes(history.limit(0), history).collect()
    assert {(r.measurement_key, r.entity_key, r.action) for r in facts} == {("ioc.threatfox.first_seen_indicators", f"1.2.3.{i}", "NEW") for i in range(3)}


def key(measurement, **identity):
    return hashlib.sha256(json.dumps({"identity": identity, "measurementKey": measurement}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def projected(spark, sql, source, **also):
    own = {"trigger": "SCHEDULED", "purpose": "LIVE_INCREMENTAL", "received_at": "2024-05-01 00:00:00", "raw_record_id": "raw", "revision_number": 1} | also
    rows = spark.sql(sql).withColumns({k: F.lit(v).cast({"received_at": "timestamp", "revision_number": "int"}.get(k, "string")) for k, v in own.items()})
    return projection.project_facts(canonical.normalize(rows, canonical.mappings()[source])).orderBy("measurement_key", "fact_key").collect()


KEV = "select 'CVE-2024-1' cveID, 'Acme' vendorProject, 'Box' product, timestamp'2024-02-01' date_added"
NVD = "select 'CVE-2024-1' cve_id, 'Analyzed' status, timestamp'2024-01-01 10:00:00' published, timestamp'{}' modified, '{{\"metrics\":{{\"x\":{{\"cvssMetricV31\":[]}}}},\"weaknesses\":[\"CWE-79\",{{\"d\":\"CWE-20\"}}]}}' payload"


def test_a_catalogue_tells_its_own_dates(spark):
    (r,) = projected(spark, KEV, "CISA_KEV", trigger="BOOTSTRAP", purpose="INITIAL_BOOTSTRAP")
    assert (r.measurement_key, str(r.event_date), r.event_time, r.precision, r.basis, r.entity_key) == ("vulnerability.cisa_kev.additions", "2024-02-01", None, "DATE", "SNAPSHOT_RECONSTRUCTION", "cve:CVE-2024-1")
    assert r.fact_key == key("vulnerability.cisa_kev.additions", cve="CVE-2024-1")
    kinds = lambda **also: [x.measurement_key.rsplit(".")[-1] for x in projected(spark, KEV, "CISA_KEV", **also)]
    assert kinds(revision_number=2) == ["additions", "updates_observed"] and kinds(revision_number=2, trigger="RECOVERY") == ["additions"] and kinds(revision_number=1) == ["additions"]


def test_two_modifications_are_two_facts(spark):
    a, b = (projected(spark, NVD.format(t), "NVD_CVE") for t in ("2024-03-01 00:00:00", "2024-03-02 00:00:00"))
    assert [x.fact_key for x in a][1] == [x.fact_key for x in b][1] == key("vulnerability.nvd.publications", cve="CVE-2024-1")
    assert a[0].fact_key == key("vulnerability.nvd.modifications", cve="CVE-2024-1", lastModified="2024-03-01T00:00:00.000Z") != b[0].fact_key
    assert a[1].dimensions == {"NVD_VULN_STATUS": "Analyzed", "NVD_CWE": "CWE-20|CWE-79", "NVD_CVSS_VERSION": "3.1"}


def test_scores_are_facts_of_their_date(spark):
    sql = "select 'CVE-2024-1' cve, '0.45' score_text, 0.9D percentile, '2024-04-02' score_date, 'v3' model_version, {} profile"
    (r,) = projected(spark, sql.format("'P'"), "FIRST_EPSS")
    assert (str(r.event_date), r.value, r.model, r.dimensions) == ("2024-04-02", 0.45, "v3", {"EPSS_SCORE_BAND": "0.40-0.60", "EPSS_CAPTURE_PROFILE": "P"})
    assert r.fact_key == key("exploitation.epss.score_distribution", cve="CVE-2024-1", scoreDate="2024-04-02", profile="P")
    (r,) = projected(spark, sql.format("cast(null as string)"), "FIRST_EPSS")
    assert r.fact_key == key("exploitation.epss.score_distribution", cve="CVE-2024-1", scoreDate="2024-04-02", profile=None) and r.dimensions == {"EPSS_SCORE_BAND": "0.40-0.60"}
    assert not projected(spark, sql.format("'P'").replace("0.45", "high"), "FIRST_EPSS") and not projected(spark, sql.format("'P'").replace("2024-04-02", ""), "FIRST_EPSS")


def test_first_sights_and_updates_of_lists(spark):
    c2 = "select 'x' record_id, '1.2.3.4' ip_address, 443 port, ' Emotet  Two' malware, '2024-01-01 00:00:00' first_seen, 'DE' country"
    (r,) = projected(spark, c2, "FEODO_TRACKER")
    identity = hashlib.sha256(json.dumps({"firstSeen": "2024-01-01 00:00:00", "ip": "1.2.3.4", "malware": " Emotet  Two", "port": 443}, separators=(",", ":")).encode()).hexdigest()
    assert (r.fact_key, r.entity_key, r.dimensions) == (key("ioc.feodo_tracker.new_records_observed", endpointIdentity=identity), "1.2.3.4", {"FEODO_MALWARE_LABEL": "Emotet  Two", "FEODO_COUNTRY": "DE"})
    assert not projected(spark, c2, "FEODO_TRACKER", revision_number=2) and not projected(spark, c2, "FEODO_TRACKER", trigger="BOOTSTRAP", purpose="INITIAL_BOOTSTRAP")
    cert = "select 'AB' sha1, 'Botnet' reason, timestamp'2024-01-01' listed_at"
    assert [x.entity_key for x in projected(spark, cert, "SSLBL_CERTIFICATE")] == ["sha1:ab"] and not projected(spark, cert, "SSLBL_CERTIFICATE", revision_number=2)
    ghsa = "select 'ghsa-1' ghsa_id, 'CVE-2024-1' cve_id, 'high' severity, '<1' `range`, 'npm' ecosystem, 'x' package, timestamp'2024-01-01' published, timestamp'2024-01-02' updated"
    assert [(x.measurement_key.rsplit(".")[-1], x.entity_key, x.dimensions) for x in projected(spark, ghsa, "GITHUB_ADVISORY_REVIEWED", revision_number=3)] == [(m, "ghsa:GHSA-1", {"GITHUB_ADVISORY_SEVERITY": "high"}) for m in ("publications", "updates_observed")]


def test_manifests_tell_sizes_and_what_left(spark):
    at = "2024-05-01 00:00:00"
    rows = [
        ("CISA_KEV", "__catalog_manifest__", None, "s2", at, "SCHEDULED", "LIVE_INCREMENTAL", 2, "v2", ["a", "b"], "s1", ["a", "c", "d"], None, None, None, None),
        ("CISA_KEV", "__catalog_manifest__", None, "s1", at, "BOOTSTRAP", "INITIAL_BOOTSTRAP", 3, "v1", ["a"], "s0", ["z"], None, None, None, None),
        ("CISA_KEV", "CVE-1", None, "s9", at, "SCHEDULED", "LIVE_INCREMENTAL", 2, "v2", ["a"], "s1", ["q"], None, None, None, None),
        ("FIRST_EPSS", "dataset-manifest", "EPSS_DATASET_MANIFEST", "e1", at, "SCHEDULED", "LIVE_INCREMENTAL", None, None, None, None, None, "2024-04-30", 12, "P", "v3"),
        ("FIRST_EPSS", "dataset-manifest", "OTHER", "e2", at, "SCHEDULED", "LIVE_INCREMENTAL", None, None, None, None, None, "2024-04-30", 12, "P", "v3"),
    ]
    df = spark.createDataFrame(rows, "source_key string, source_record_id string, kind string, payload_sha256 string, received_at string, trigger string, purpose string, count int, catalog_version string, ids array<string>, previous_sha256 string, previous_ids array<string>, dataset_date string, selected_rows int, profile string, model_version string").withColumn("received_at", F.col("received_at").cast("timestamp"))
    got = sorted((r.measurement_key.split(".")[-1], r.value, r.entity_key or "", r.basis, r.fact_key) for r in projection.project_manifests(df).collect())
    removed = "vulnerability.cisa_kev.membership_removals_observed"
    want = [("catalog_size", 2.0, "", "LIVE_INCREMENTAL", key("vulnerability.cisa_kev.catalog_size", payloadSha256="s2")), ("catalog_size", 3.0, "", "INITIAL_BOOTSTRAP", key("vulnerability.cisa_kev.catalog_size", payloadSha256="s1")), ("scored_records", 12.0, "", "LIVE_INCREMENTAL", key("exploitation.epss.scored_records", datasetDate="2024-04-30", profile="P"))]
    want += [("membership_removals_observed", 1.0, f"cve:{x}", "LIVE_INCREMENTAL", key(removed, previous="s1", current="s2", cve=x)) for x in "cd"]
    assert got == sorted(want)


def test_mentioned_ids_follow_the_own_entities(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"feed": {"entry": [{"id": "SSA-123456", "title": "about cve-2024-0001"}]}}))
    rows = feeds.scan_rolie(spark, str(tmp_path / "o.json"))
    own = canonical.normalize(rows, canonical.mappings()["SIEMENS_PRODUCTCERT"])
    assert [(e.kind, e.key) for e in own.first().entities] == [("CVE", "CVE-2024-0001")]
    more = spark.createDataFrame([("SSA-123456", ["CVE-2024-0002"])], "source_record_id string, ids array<string>")
    assert [e.key for e in canonical.with_mentioned(own, more).first().entities] == ["CVE-2024-0001", "CVE-2024-0002"]


def test_contract_tells_every_reason(spark):
    good = ("IOC_REPORT", "k", [("IP", "1.2.3.4", None)], [("p", "v")], ["https://a.b/"])
    rows = [
        (0, *good), (1, "NOISE", *good[1:]), (2, "UNKNOWN", "", *good[2:]), (3, *good[:2], [("ip", "x", None)], *good[3:]), (4, *good[:2], [("IP", "", "y" * 1025)], *good[3:]),
        (5, *good[:3], [("", None)], good[4]), (6, *good[:4], ["no url"]), (7, *good[:2], [("IP", str(i), None) for i in range(257)], [("p", "v")] * 513, ["https://a.b/"] * 65), (8, None, None, None, None, None), (9, "UNKNOWN", "k", None, None, None),
    ]
    df = spark.createDataFrame(rows, f"id int, record_kind string, canonical_key string, entities {canonical.ENTITY}, facts {canonical.FACT}, reference_urls array<string>")
    valid, rejects = canonical.validate(df)
    assert {r.id for r in valid.collect()} == {0, 9}
    assert {r.id: r.reasons for r in rejects.collect()} == {
        1: ["RECORD_KIND_UNKNOWN"], 2: ["CANONICAL_KEY_LENGTH"], 3: ["ENTITY_KIND_UNKNOWN"], 4: ["ENTITY_KEY_LENGTH", "ENTITY_LABEL_LENGTH"], 5: ["PREDICATE_LENGTH"], 6: ["REFERENCE_NO_URL"],
        7: ["TOO_MANY_ENTITIES", "TOO_MANY_FACTS", "TOO_MANY_REFERENCES"], 8: ["RECORD_KIND_UNKNOWN", "CANONICAL_KEY_LENGTH"],
    }


def test_vendors_hashes_and_dates_of_records(spark):
    from tidemark.operators.entities import project_observations

    kev = spark.sql("select 'CVE-2024-1' cveID, ' Acme ' vendorProject, 'Box' product, 'Known' knownRansomwareCampaignUse, '2024-03-01' dueDate, timestamp'2024-02-01' date_added")
    out = canonical.normalize(kev, canonical.mappings()["CISA_KEV"])
    row = out.first()
    assert [e.kind for e in row.entities] == ["CVE", "VENDOR", "PRODUCT"] and row.entities[1].key.startswith("vendor:cisa-kev:") and row.entities[1].label == "Acme"
    seen = project_observations(out, date_facts={"CISA_KEV": "kev.date_added"}).collect()
    assert {(r.precision, str(r.observed_date), r.observed_time) for r in seen} == {("DATE", "2024-02-01", None)}
    assert canonical.validate(out)[1].count() == 0


def test_configuration_counts(spark):
    doc = {"configurations": [{"nodes": [{"cpeMatch": [{"criteria": "a"}, {"criteria": "b"}], "children": [{"cpeMatch": [{"criteria": "c"}]}]}]}, {}]}
    row = spark.createDataFrame([(json.dumps(doc),), ("{}",), (None,)], "v string").select(X.config_counts("v").alias("c")).collect()
    assert [(r.c.nodes, r.c.matches) for r in row] == [(2, 3), (0, 0), (0, 0)]
