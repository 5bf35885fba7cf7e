"""Facts of measurements, projected from canonical records by a table of rules, and from manifests of snapshots.

A rule says of which source's records it makes a fact, under what condition, and what identifies the fact: its key is the digest
of the canonical JSON of measurement and identity, so that the same event is the same fact in every run, and two events of one
record are two. All rules are compiled to one select over the records.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json_texts import cvss_versions
from tidemark.functions.scalars import CWE, acquisition_basis, extract_ids, fact, is_live
from tidemark.sources.canonical import iso

Make = Callable[[], Column]
#: Kinds of facts, what they are made from, and the basis of an initial load that rebuilds a catalogue's past.
EVENT, OBSERVATION, SNAPSHOT_VALUE, STATE_VALUE = "EVENT", "OBSERVATION", "SNAPSHOT_VALUE", "STATE_VALUE"
RECORD, MANIFEST, PAIR = "CANONICAL_RECORD", "RAW_MANIFEST", "RAW_MANIFEST_PAIR"
RECONSTRUCTION = "SNAPSHOT_RECONSTRUCTION"
#: Records that describe a snapshot rather than a member of it.
KEV_MANIFEST, EPSS_MANIFEST, EPSS_MANIFEST_KIND = "__catalog_manifest__", "dataset-manifest", "EPSS_DATASET_MANIFEST"


def said(predicate: str) -> Make:
    return lambda: fact("facts", predicate)


def first_entity(*kinds: str, prefix: str = "") -> Column:
    return F.get(F.filter("entities", lambda e: e["kind"].isin(*kinds) & F.startswith(e["key"], F.lit(prefix))), F.lit(0))


def updated_live() -> Column:
    return (F.col("revision_number") > 1) & is_live("trigger", "purpose")


def first_live() -> Column:
    return (F.col("revision_number") == 1) & is_live("trigger", "purpose")


def always() -> Column:
    return F.lit(True)


def epss_band(score: Column) -> Column:
    bounds = {0.2: "0.10-0.20", 0.4: "0.20-0.40", 0.6: "0.40-0.60", 0.8: "0.60-0.80"}
    out = F.lit("0.80-1.00")
    for bound, name in reversed(bounds.items()):
        out = F.when(score < bound, name).otherwise(out)
    return out


def joined(values: Column) -> Column:
    return F.nullif(F.array_join(values, "|"), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """One fact of a record. needs: predicates without which there is none. at or date: when it happened."""

    measurement: str
    source_key: str
    identity: dict[str, Make]
    needs: tuple[str, ...]
    entity_key: Make
    entity_type: Make
    at: str | None = None
    date: Make | None = None
    kind: str = OBSERVATION
    when: Make = always
    value: Make = lambda: F.lit(1.0)
    dimensions: dict[str, Make] = field(default_factory=dict)
    reconstructs: bool = False
    model: Make = lambda: F.lit(None).cast("string")


def lit(x: str) -> Make:
    return lambda: F.lit(x)


def column(x: str) -> Make:
    return lambda: F.col(x)


def prefixed(prefix: str, predicate: str, upper: bool = False) -> Make:
    return lambda: F.concat(F.lit(prefix), F.upper(fact("facts", predicate)) if upper else fact("facts", predicate))


def rules() -> list[Rule]:
    """The published projections."""
    kev, nvd, fox, bazaar = said("kev.cve_id"), said("nvd.cve_id"), said("threatfox.source_ioc_id"), said("malwarebazaar.sha256")
    raw = column("raw_record_id")
    indicator = lambda: first_entity("IP", "DOMAIN", "URL", "HASH")
    sample = lambda: F.coalesce(first_entity("HASH", prefix="sha256:")["key"], F.concat(F.lit("sha256:"), bazaar()))
    ghsa, ics = said("github_advisory.ghsa_id"), said("cisa_ics.advisory_id")
    severity, publisher = {"GITHUB_ADVISORY_SEVERITY": said("github_advisory.severity")}, {"CISA_ICS_PUBLISHER": said("cisa_ics.publisher")}
    profile = said("capture.profile")
    score = lambda: fact("facts", "epss.score", "double")
    cve = lambda: first_entity("CVE")["key"]
    return [
        Rule("vulnerability.cisa_kev.additions", "CISA_KEV", {"cve": kev}, ("kev.cve_id", "kev.date_added"), prefixed("cve:", "kev.cve_id"), lit("CVE"), date=said("kev.date_added"), kind=EVENT, reconstructs=True),
        Rule("vulnerability.cisa_kev.updates_observed", "CISA_KEV", {"rawRecordId": raw, "sourceRecordId": column("source_record_id")}, (), column("canonical_key"), lit("CVE"), "received_at", when=updated_live),
        Rule("vulnerability.nvd.publications", "NVD_CVE", {"cve": nvd}, ("nvd.cve_id",), prefixed("cve:", "nvd.cve_id"), lit("CVE"), "published_at", kind=EVENT,
             dimensions={"NVD_VULN_STATUS": said("nvd.vuln_status"), "NVD_CWE": lambda: joined(extract_ids(F.coalesce(fact("facts", "nvd.weaknesses"), F.lit("")), CWE)), "NVD_CVSS_VERSION": lambda: joined(cvss_versions(fact("facts", "nvd.cvss_metrics")))}),
        Rule("vulnerability.nvd.modifications", "NVD_CVE", {"cve": nvd, "lastModified": lambda: iso(F.col("updated_at"))}, ("nvd.cve_id",), prefixed("cve:", "nvd.cve_id"), lit("CVE"), "updated_at", kind=EVENT),
        Rule("exploitation.epss.score_distribution", "FIRST_EPSS", {"cve": cve, "profile": profile, "scoreDate": said("epss.score_date")}, ("epss.score_date",), lambda: F.concat(F.lit("cve:"), cve()), lit("CVE"), date=said("epss.score_date"), kind=SNAPSHOT_VALUE,
             when=lambda: score().isNotNull() & cve().isNotNull(), value=score, dimensions={"EPSS_SCORE_BAND": lambda: epss_band(score()), "EPSS_CAPTURE_PROFILE": profile}, model=said("epss.model_version")),
        Rule("ioc.threatfox.reporting_volume", "THREATFOX", {"reportId": fox}, ("threatfox.source_ioc_id",), column("canonical_key"), lit("REPORT"), "effective_at",
             dimensions={"IOC_TYPE": said("threatfox.ioc_type"), "THREATFOX_MALWARE_LABEL": lambda: F.coalesce(fact("facts", "threatfox.malware_printable"), fact("facts", "threatfox.malware"))}),
        Rule("ioc.threatfox.distinct_indicators", "THREATFOX", {"reportId": fox}, ("threatfox.source_ioc_id",), lambda: indicator()["key"], lambda: indicator()["kind"], "effective_at", when=lambda: indicator().isNotNull(), dimensions={"IOC_TYPE": said("threatfox.ioc_type")}),
        Rule("ioc.threatfox.report_updates_observed", "THREATFOX", {"rawRecordId": raw, "reportId": fox}, ("threatfox.source_ioc_id",), column("canonical_key"), lit("REPORT"), "received_at", when=updated_live),
        Rule("malware.malwarebazaar.sample_reporting", "MALWAREBAZAAR", {"sha256": bazaar}, ("malwarebazaar.sha256",), sample, lit("HASH"), "effective_at", dimensions={"MALWAREBAZAAR_FILE_TYPE": said("malwarebazaar.file_type"), "MALWAREBAZAAR_SIGNATURE": said("malwarebazaar.signature")}),
        Rule("malware.malwarebazaar.distinct_hashes", "MALWAREBAZAAR", {"sha256": bazaar}, ("malwarebazaar.sha256",), sample, lit("HASH"), "effective_at"),
        Rule("malware.malwarebazaar.sample_updates_observed", "MALWAREBAZAAR", {"rawRecordId": raw, "sha256": bazaar}, ("malwarebazaar.sha256",), sample, lit("HASH"), "received_at", when=updated_live),
        Rule("ioc.feodo_tracker.new_records_observed", "FEODO_TRACKER", {"endpointIdentity": said("feodo.endpoint_identity")}, ("feodo.endpoint_identity",), lambda: F.coalesce(first_entity("IP")["key"], F.col("canonical_key")), lambda: F.coalesce(first_entity("IP")["kind"], F.lit("IOC_REPORT")), "received_at",
             when=first_live, dimensions={"FEODO_MALWARE_LABEL": said("feodo.malware_label"), "FEODO_COUNTRY": said("feodo.country")}),
        Rule("ioc.sslbl.certificate_listings_observed", "SSLBL_CERTIFICATE", {"sha1": said("sslbl.certificate_sha1")}, ("sslbl.certificate_sha1",), lambda: F.coalesce(first_entity("CERTIFICATE")["key"], prefixed("sha1:", "sslbl.certificate_sha1")()), lit("CERTIFICATE"), "received_at", when=first_live),
        Rule("vulnerability.github_advisory.publications", "GITHUB_ADVISORY_REVIEWED", {"ghsaId": ghsa}, ("github_advisory.ghsa_id",), prefixed("ghsa:", "github_advisory.ghsa_id", True), lit("SECURITY_ADVISORY"), "published_at", kind=EVENT, dimensions=severity),
        Rule("vulnerability.github_advisory.updates_observed", "GITHUB_ADVISORY_REVIEWED", {"ghsaId": ghsa, "rawRecordId": raw}, ("github_advisory.ghsa_id",), prefixed("ghsa:", "github_advisory.ghsa_id", True), lit("SECURITY_ADVISORY"), "received_at", when=updated_live, dimensions=severity),
        Rule("vulnerability.cisa_ics.advisory_publications", "CISA_ICS_CSAF", {"advisoryId": ics}, ("cisa_ics.advisory_id",), prefixed("cisa-ics:", "cisa_ics.advisory_id", True), lit("SECURITY_ADVISORY"), "published_at", kind=EVENT, dimensions=publisher),
        Rule("vulnerability.cisa_ics.advisory_updates_observed", "CISA_ICS_CSAF", {"advisoryId": ics, "rawRecordId": raw}, ("cisa_ics.advisory_id",), prefixed("cisa-ics:", "cisa_ics.advisory_id", True), lit("SECURITY_ADVISORY"), "received_at", when=updated_live, dimensions=publisher),
    ]


def fact_key(measurement: str, identity: dict[str, Column]) -> Column:
    """The digest of the canonical JSON of {identity, measurementKey}; a part that isn't known stays as null."""
    whole = F.struct(F.struct(*[v.cast("string").alias(k) for k, v in sorted(identity.items())]).alias("identity"), F.lit(measurement).alias("measurementKey"))
    return F.sha2(F.to_json(whole, {"ignoreNullFields": "false"}), 256)


def told(measurement: str, kind: str, role: str, key: Column, at: Column | None, date: Column | None, value: Column, entity_key: Column | None, entity_type: Column | None, dimensions: dict[str, Column], basis: Column, model: Column) -> Column:
    """A fact as a struct, the same for all rules. Dimensions that nothing says are left out of the map."""
    none = F.lit(None)
    pairs = [x for k, v in dimensions.items() for x in (F.lit(k), v.cast("string"))]
    named = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    return F.struct(
        F.lit(measurement).alias("measurement_key"),
        key.alias("fact_key"),
        F.lit(kind).alias("fact_kind"),
        (none if at is None else at).cast("timestamp").alias("event_time"),
        (none if date is None else F.try_to_date(date)).cast("date").alias("event_date"),
        F.lit("INSTANT" if date is None else "DATE").alias("precision"),
        value.cast("double").alias("value"),
        (none if entity_key is None else entity_key).cast("string").alias("entity_key"),
        (none if entity_type is None else entity_type).cast("string").alias("entity_type"),
        named.alias("dimensions"),
        basis.alias("basis"),
        model.cast("string").alias("model"),
        F.lit(role).alias("input_role"),
    )


def project_facts(canonical: DataFrame, wanted: list[Rule] | None = None) -> DataFrame:
    """Facts of all records: source_record_id and the columns of `told`.

    canonical: what `normalize` gives, with trigger, purpose, received_at, raw_record_id and revision_number. A record without
    the rule's predicates, or without its time or date, gives no fact; updates count from the second revision on and first
    sights are the first, both in scheduled live runs only. An initial load of a catalogue that tells its own dates rebuilds
    its past, and says so.
    """
    made: dict[str, list[Column]] = {}
    for r in wanted if wanted is not None else rules():
        basis = acquisition_basis("trigger", "purpose")
        if r.reconstructs:
            basis = F.when(basis == "INITIAL_BOOTSTRAP", RECONSTRUCTION).otherwise(basis)
        date = r.date() if r.date else None
        condition = r.when()
        for predicate in r.needs:
            condition = condition & fact("facts", predicate).isNotNull()
        condition = condition & (F.col(r.at).isNotNull() if r.at else F.try_to_date(date).isNotNull())
        made.setdefault(r.source_key, []).append(F.when(F.coalesce(condition, F.lit(False)), told(r.measurement, r.kind, RECORD, fact_key(r.measurement, {k: v() for k, v in r.identity.items()}), F.col(r.at) if r.at else None, date, r.value(), r.entity_key(), r.entity_type(), {k: v() for k, v in r.dimensions.items()}, basis, r.model())))
    # A record is held against the rules of its own source alone.
    every = F.coalesce(*[F.when(F.col("source_key") == source, F.array(*facts)) for source, facts in made.items()])
    return canonical.select("source_record_id", F.explode(F.array_compact(every)).alias("f")).select("source_record_id", "f.*")


def project_manifests(manifests: DataFrame) -> DataFrame:
    """Facts of snapshots' manifests: the size of a catalogue, the members that it lost since the manifest before, and the
    rows of a dated dataset.

    manifests: source_key, source_record_id, kind, payload_sha256, received_at, trigger, purpose, count, catalog_version, ids,
    previous_sha256 and previous_ids (null: there was none before), dataset_date, selected_rows, profile, model_version.
    Members that left are rows of their own, made from the lists of two manifests; they count in scheduled live runs only.
    """
    basis = acquisition_basis("trigger", "purpose")
    kev = (F.col("source_key") == "CISA_KEV") & (F.col("source_record_id") == KEV_MANIFEST)
    epss = (F.col("source_key") == "FIRST_EPSS") & (F.col("source_record_id") == EPSS_MANIFEST) & (F.col("kind") == EPSS_MANIFEST_KIND)
    size, removed, scored = "vulnerability.cisa_kev.catalog_size", "vulnerability.cisa_kev.membership_removals_observed", "exploitation.epss.scored_records"
    sized = F.when(kev & F.col("count").isNotNull(), told(size, STATE_VALUE, MANIFEST, fact_key(size, {"payloadSha256": F.col("payload_sha256")}), F.col("received_at"), None, F.col("count"), None, None, {}, basis, F.col("catalog_version")))
    dated = F.when(
        epss & F.col("dataset_date").isNotNull() & F.col("selected_rows").isNotNull(),
        told(scored, SNAPSHOT_VALUE, MANIFEST, fact_key(scored, {"datasetDate": F.col("dataset_date"), "profile": F.col("profile")}), None, F.col("dataset_date"), F.col("selected_rows"), None, None, {"EPSS_CAPTURE_PROFILE": F.col("profile")}, basis, F.col("model_version")),
    )
    whole = manifests.select("source_record_id", F.explode(F.array_compact(F.array(sized, dated))).alias("f")).select("source_record_id", "f.*")
    none = F.array().cast("array<string>")
    pairs = manifests.where(kev & F.col("previous_sha256").isNotNull() & is_live("trigger", "purpose"))
    gone = pairs.withColumn("cve", F.explode(F.array_except(F.coalesce("previous_ids", none), F.coalesce("ids", none)))).where("cve is not null")
    identity = {"cve": F.col("cve"), "current": F.col("payload_sha256"), "previous": F.col("previous_sha256")}
    left = gone.select("source_record_id", told(removed, OBSERVATION, PAIR, fact_key(removed, identity), F.col("received_at"), None, F.lit(1.0), F.concat(F.lit("cve:"), "cve"), F.lit("CVE"), {}, basis, F.col("catalog_version")).alias("f"))
    return whole.unionByName(left.select("source_record_id", "f.*"))
