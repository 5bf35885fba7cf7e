import gzip
import json

from tidemark.plans import catalogue
from tidemark.sources import feeds


def test_catalogue_snapshot(spark, tmp_path):
    entry = lambda i, day="2024-01-02": {"cveID": i, "vendorProject": "v", "product": "p", "dateAdded": day, "dueDate": "2024-02-01", "extra": 1}
    doc = {"title": "t", "catalogVersion": "1", "dateReleased": "2024-01-02", "count": 4, "vulnerabilities": [entry("CVE-2024-0001"), entry("CVE-2024-0002"), entry("CVE-2024-0002", "2024-02-30")]}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    entries, manifest, wrong = feeds.scan_catalog(spark, str(tmp_path / "c.json"))
    assert entries.count() == 3
    assert manifest.first()["count"] == 3
    assert {(r.kind, r.key) for r in wrong.collect()} == {("COUNT_MISMATCH", "1"), ("DUPLICATE_ID", "CVE-2024-0002"), ("INVALID_ENTRY", "CVE-2024-0002")}


def test_paged_feed(spark, tmp_path):
    for i, total in enumerate((2, 3)):
        page = {"startIndex": i, "resultsPerPage": 1, "totalResults": total, "vulnerabilities": [{"cve": {"id": f"CVE-2024-000{i}", "published": "2024-01-02T03:04:05.000", "vulnStatus": "Analyzed", "metrics": {"cvssMetricV31": []}, "weaknesses": ["CWE-79"]}}]}
        (tmp_path / f"{i}.json").write_text(json.dumps(page))
    rows, totals = feeds.scan_paged(spark, str(tmp_path))
    assert {(r.cve_id, tuple(r.cwes), tuple(r.cvss)) for r in rows.collect()} == {("CVE-2024-0000", ("CWE-79",), ("3.1",)), ("CVE-2024-0001", ("CWE-79",), ("3.1",))}
    assert totals.first().totals == [2, 3]


def test_scores(spark, tmp_path):
    with gzip.open(tmp_path / "s.csv.gz", "wt") as f:
        f.write("#model_version:v1,score_date:2024-01-02T00:00:00+0000\ncve,epss,percentile,more\nCVE-2024-0001,0.5,0.9,x\nCVE-2024-0002,1.5,0.9,\nbad,0.1,0.1,\n")
    rows, metadata, rejected, wrong = feeds.scan_scores(spark, str(tmp_path / "s.csv.gz"))
    assert wrong.count() == 0
    assert [(r.cve, r.score, r.extras) for r in rows.collect()] == [("CVE-2024-0001", 0.5, {"more": "x"})]
    assert {r.key: r.value for r in metadata.collect()} == {"model_version": "v1", "score_date": "2024-01-02T00:00:00+0000"}
    assert rejected.count() == 2


def test_scores_tell_repeated_ids_and_missing_metadata(spark, tmp_path):
    (tmp_path / "s.csv").write_text("#model_version:v1," + "x" * 5000 + ":y\ncve,epss,percentile\nCVE-2024-0001,0.5,0.9\ncve-2024-0001,0.5,0.9\nCVE-2024-0001,0.4,0.9\n")
    rows, metadata, rejected, wrong = feeds.scan_scores(spark, str(tmp_path / "s.csv"))
    assert {(r.kind, r.key) for r in wrong.collect()} == {("METADATA_MISSING", "score_date"), ("DUPLICATE_ID", "CVE-2024-0001")}
    assert {len(r.key) for r in metadata.collect()} == {13, 5000}


def test_an_envelope_of_another_status_is_told(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"query_status": "no_result", "data": []}))
    rows, _, wrong = feeds.scan_samples(spark, str(tmp_path / "r.json"))
    assert rows.count() == 0
    assert [(r.kind, r.key) for r in wrong.collect()] == [("BAD_STATUS", "no_result")]


def test_rdf_items(spark, tmp_path):
    (tmp_path / "f.rdf").write_text('<rdf:RDF xmlns:rdf="r" xmlns:dc="d" xmlns:sec="s"><item><title>T CVE-2024-0001</title><link>l</link><description>and CVE-2023-12345</description><dc:date>2024-01-02T03:04:05+00:00</dc:date><sec:identifier>JVNDB-2024-000001</sec:identifier></item></rdf:RDF>')
    row = feeds.scan_rdf(spark, str(tmp_path / "f.rdf")).first()
    assert (row.record_id, row.cves, str(row.published)) == ("JVNDB-2024-000001", ["CVE-2023-12345", "CVE-2024-0001"], "2024-01-02 03:04:05")


def test_reports_certificates_and_endpoints(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"query_status": "ok", "data": [{"id": "1", "ioc": "a.b", "ioc_type": "domain", "first_seen": "2024-01-02 03:04:05 UTC"}, {"id": "1", "ioc": "c.d", "first_seen": "2024-01-03 03:04:05 UTC"}]}))
    rows, summary, wrong = feeds.scan_ioc_reports(spark, str(tmp_path / "r.json"))
    assert rows.count() == 2 and summary.first().ids == 1
    assert [(r.kind, r.key) for r in wrong.collect()] == [("DUPLICATE_ID", "1")]
    (tmp_path / "c.csv").write_text("# list\n# Last updated: 2024-01-02 03:04:06 UTC\n2024-01-02 03:04:05,ABCD,C&C\n")
    rows, updated = feeds.scan_certs(spark, str(tmp_path / "c.csv"))
    assert rows.first().sha1 == "abcd" and str(updated.first().last_updated) == "2024-01-02 03:04:06"
    (tmp_path / "e.json").write_text(json.dumps([{"ip_address": "1.2.3.4", "port": 80, "malware": "m", "first_seen": "x"}]))
    assert len(feeds.scan_c2(spark, str(tmp_path / "e.json")).first().record_id) == 64


def test_documents_and_xml(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"document": {"title": "T", "tracking": {"id": "ICSA-1"}, "publisher": {"name": "P"}, "notes": [{"title": "Critical Infrastructure Sectors", "text": "Energy, Chemical, , Energy"}, {"title": "Other", "text": "x"}]}, "vulnerabilities": [{"cve": "CVE-2024-0001", "cwe": {"id": "CWE-79"}}]}))
    row = feeds.scan_csaf(spark, str(tmp_path / "a.json")).first()
    assert (row.advisory_id, row.cves, row.cwes, row.sectors) == ("ICSA-1", ["CVE-2024-0001"], ["CWE-79"], ["Chemical", "Energy"])
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>2024-001 old</title><link>l1</link><pubDate>Tue, 02 Jan 2024 03:04:05 +0000</pubDate></item><item><title>2024-001 new</title><link>l2</link><pubDate>Wed, 03 Jan 2024 03:04:05 +0000</pubDate></item></channel></rss>")
    assert [r.link for r in feeds.scan_rss(spark, str(tmp_path / "f.xml")).collect()] == ["l2"]
    (tmp_path / "s.json").write_text(json.dumps({"objects": [{"type": "attack-pattern", "id": "x", "name": "n", "external_references": [{"source_name": "mitre-attack", "external_id": "T1"}], "kill_chain_phases": [{"phase_name": "b"}, {"phase_name": "a"}]}, {"type": "other", "id": "y"}]}))
    row = feeds.scan_stix(spark, str(tmp_path / "s.json")).first()
    assert (row.external_id, row.tactics) == ("T1", ["a", "b"])
    (tmp_path / "o.json").write_text(json.dumps({"feed": {"entry": [{"id": "SSA-123456", "title": "CVE-2024-0001"}, {"id": "other", "title": "t"}]}}))
    ids = sorted(r.record_id for r in feeds.scan_rolie(spark, str(tmp_path / "o.json")).collect())
    assert ids[0] == "SSA-123456" and ids[1].startswith("rolie:")
    (tmp_path / "g.json").write_text(json.dumps([{"ghsa_id": "G", "severity": "high", "published_at": "2024-01-02T03:04:05Z", "vulnerabilities": [{"package": {"ecosystem": "pip", "name": "a"}}]}]))
    assert feeds.scan_advisories(spark, str(tmp_path / "g.json")).first().package == "a"
    (tmp_path / "m.json").write_text(json.dumps({"timestamp": 1704164645.5, "peer_ip": "1.2.3.4", "peer_asn": 1, "announced": ["B/8", "a/8", "a/8"], "origin_asns": [2]}))
    assert feeds.scan_decoded_mrt(spark, str(tmp_path / "m.json"), "rrc00").first().announced == ["a/8", "b/8"]


def test_catalogue_has_thirty_definitions(spark):
    own = catalogue.registry()
    assert len(own) == 30
    records = spark.sql("select 'vulnerability.nvd' as source_key, timestamp'2024-01-01' as published_at, cast(null as timestamp) as updated_at, timestamp'2024-01-02' as received_at, cast(null as timestamp) as effective_at")
    keys = {r.measurement_key for r in catalogue.fan_out(records, catalogue.definitions_frame(spark)).collect()}
    assert keys == {"vulnerability.nvd.publications"}
