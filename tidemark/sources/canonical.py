"""Canonical evidence: a source's records as entities, facts and references, and facts of measurements projected from them.

A mapping is a table of columns, not code for each row: normalize() builds the one select that all sources share. Facts are
(predicate, value) pairs; the payload keeps everything else.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import extract_ids, fingerprint, harvest_urls, normalize_indicator, scoped_key, union_refs

ENTITY = "array<struct<kind:string,key:string,label:string>>"
FACT = "array<struct<predicate:string,value:string>>"

#: Kinds of records and of entities, and the bounds of a record's parts.
RECORD_KINDS = (
    "VULNERABILITY_RECORD", "KNOWN_EXPLOITED_VULNERABILITY", "EXPLOIT_PROBABILITY_SCORE", "IOC_REPORT", "MALWARE_SAMPLE_RECORD", "SECURITY_ADVISORY",
    "CERT_CSIRT_PUBLICATION", "THREAT_RESEARCH_REPORT", "INFRASTRUCTURE_OBSERVATION", "CONTEXT_KNOWLEDGE", "UNKNOWN",
)
ENTITY_KINDS = ("CVE", "IP", "DOMAIN", "URL", "HASH", "MALWARE", "VENDOR", "PRODUCT", "PACKAGE", "ASN", "CERTIFICATE", "ATTACK_TECHNIQUE", "ORGANIZATION", "COUNTRY", "SECTOR", "REPORT")
MAX_KEY, MAX_PREDICATE, MAX_ENTITIES, MAX_FACTS, MAX_REFERENCES = 1024, 256, 256, 512, 64


def validate(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that keep the contract, and the others with `reasons`, all that are broken. record_kind, canonical_key, entities,
    facts and reference_urls are looked at; a null list counts as an empty one."""
    listed = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    entities, facts, urls = listed("entities", ENTITY), listed("facts", FACT), listed("reference_urls", "array<string>")
    sized = lambda x, most: F.coalesce(F.length(x).between(1, most), F.lit(False))
    broken = {
        "RECORD_KIND_UNKNOWN": ~F.coalesce(F.col("record_kind").isin(*RECORD_KINDS), F.lit(False)),
        "CANONICAL_KEY_LENGTH": ~sized(F.col("canonical_key"), MAX_KEY),
        "TOO_MANY_ENTITIES": F.size(entities) > MAX_ENTITIES,
        "ENTITY_KIND_UNKNOWN": F.exists(entities, lambda e: ~F.coalesce(e["kind"].isin(*ENTITY_KINDS), F.lit(False))),
        "ENTITY_KEY_LENGTH": F.exists(entities, lambda e: ~sized(e["key"], MAX_KEY)),
        "ENTITY_LABEL_LENGTH": F.exists(entities, lambda e: e["label"].isNotNull() & ~sized(e["label"], MAX_KEY)),
        "TOO_MANY_FACTS": F.size(facts) > MAX_FACTS,
        "PREDICATE_LENGTH": F.exists(facts, lambda f: ~sized(f["predicate"], MAX_PREDICATE)),
        "TOO_MANY_REFERENCES": F.size(urls) > MAX_REFERENCES,
        "REFERENCE_NO_URL": F.exists(urls, lambda u: ~F.coalesce(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$"), F.lit(False))),
    }
    seen = records.withColumn("reasons", F.array_compact(F.array(*[F.when(bad, F.lit(why)) for why, bad in broken.items()])))
    return seen.where("size(reasons) = 0").drop("reasons"), seen.where("size(reasons) > 0")


def entity(kind: Column | str, key: Column, label: Column | None = None) -> Column:
    """An entity struct, or null where it has no key."""
    name = F.lit(kind) if isinstance(kind, str) else kind
    return F.when(key.isNotNull() & (key != ""), F.struct(name.alias("kind"), key.cast("string").alias("key"), F.coalesce(key if label is None else label, key).cast("string").alias("label")))


def pair(predicate: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(F.lit(predicate).alias("predicate"), value.cast("string").alias("value")))


@dataclass(frozen=True)
class Mapping:
    """How a source's columns become canonical: key, kind, entities (the first is primary), facts, references, times."""

    source_key: str
    record_kind: str
    record_id: Column
    entities: list[Column]
    #: Values by predicate; a column's name stands for the column, and is left out where the rows have none.
    facts: dict[str, Column | str] = field(default_factory=dict)
    #: Arrays of addresses; a column's name stands for the addresses in its text.
    references: list[Column | str] = field(default_factory=list)
    effective: Column | None = None
    published: Column | str | None = None
    updated: Column | None = None
    #: Identifiers of vulnerabilities that a text mentions; each is an entity behind the own ones.
    mentioned: Column | None = None
    #: The published key; without one, a fingerprint of source, kind and id.
    key: Column | None = None


def present(rows: DataFrame, values: dict[str, Column | str]) -> dict[str, Column]:
    return {k: F.col(v) if isinstance(v, str) else v for k, v in values.items() if not isinstance(v, str) or v in rows.columns}


def normalize(rows: DataFrame, m: Mapping) -> DataFrame:
    """Canonical records of a source."""
    at = lambda c: (F.lit(None) if c is None or isinstance(c, str) and c not in rows.columns else F.col(c) if isinstance(c, str) else c).cast("timestamp")
    references = [harvest_urls(r) if isinstance(r, str) else r for r in m.references if not isinstance(r, str) or r in rows.columns]
    listed = F.array_compact(F.array(*m.entities)).cast(ENTITY) if m.entities else F.array().cast(ENTITY)
    if m.mentioned is not None:
        cves = F.transform(m.mentioned, lambda x: F.struct(F.lit("CVE").alias("kind"), x.alias("key"), x.alias("label")))
        listed = F.concat(listed, F.coalesce(cves, F.array().cast(ENTITY)))
    return rows.select(
        F.lit(m.source_key).alias("source_key"),
        F.lit(m.record_kind).alias("record_kind"),
        m.record_id.cast("string").alias("source_record_id"),
        (fingerprint(F.lit(m.source_key), F.lit(m.record_kind), m.record_id) if m.key is None else m.key).alias("canonical_key"),
        listed.alias("entities"),
        (F.array_compact(F.array(*[pair(k, v) for k, v in present(rows, m.facts).items()])).cast(FACT) if m.facts else F.array().cast(FACT)).alias("facts"),
        (union_refs(*references) if references else F.array().cast("array<string>")).alias("reference_urls"),
        at(m.effective).alias("effective_at"),
        at(m.published).alias("published_at"),
        at(m.updated).alias("updated_at"),
        at(F.col("received_at") if "received_at" in rows.columns else None).alias("received_at"),
        *[F.col(c) for c in ("trigger", "purpose", "raw_record_id", "revision_number") if c in rows.columns],
    )


#: Addresses of the published catalogues.
KEV_SEARCH = "https://www.cisa.gov/known-exploited-vulnerabilities-catalog?search_api_fulltext="
FEODO_LIST, SSLBL_LIST = "https://feodotracker.abuse.ch/blocklist/", "https://sslbl.abuse.ch/blacklist/"
IOC_PAGE, SAMPLE_PAGE = "https://threatfox.abuse.ch/ioc/", "https://bazaar.abuse.ch/sample/"


def named(prefix: str, **columns: Column | str) -> dict[str, Column | str]:
    return {f"{prefix}.{k}": v for k, v in columns.items()}


def iso(at: Column) -> Column:
    """A time as published texts have it: UTC, with milliseconds."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def web(c: Column) -> Column:
    return F.when(c.rlike(r"^https?://\S+$"), c)


def feodo_identity() -> Column:
    """The digest of an endpoint's canonical JSON, keys in order."""
    return F.sha2(F.to_json(F.struct(F.col("first_seen").alias("firstSeen"), F.col("ip_address").alias("ip"), "malware", "port")), 256)


def mappings() -> dict[str, Mapping]:
    """The sources whose readers are in tidemark.sources.feeds, by their published keys; built when a session runs, as columns
    need one. Predicates, keys and addresses are the published ones."""
    c = F.col
    one = lambda x: F.array_compact(F.array(x))
    indicator = normalize_indicator("ioc_type", "ioc")
    hashed = indicator["kind"].isin("md5", "sha1", "sha256")
    kind, key = F.when(hashed, "HASH").otherwise(F.upper(indicator["kind"])), F.when(hashed, F.concat_ws(":", indicator["kind"], indicator["key"])).otherwise(indicator["key"])
    malware = F.nullif(F.trim("malware"), F.lit(""))
    label = F.coalesce(F.nullif(F.trim("malware_printable"), F.lit("")), malware)
    digest = lambda x: entity("HASH", F.concat(F.lit(f"{x}:"), F.lower(f"{x}_hash")), F.lower(f"{x}_hash"))
    sha = F.lower("sha256_hash")
    part = lambda path: F.get_json_object("payload", path)
    kev_facts = named("kev", catalog_membership=F.lit("true"), cve_id="cveID", vendor_project="vendorProject", product="product", vulnerability_name="vulnerabilityName", date_added=F.date_format("date_added", "yyyy-MM-dd"), due_date="dueDate", short_description="shortDescription", required_action="requiredAction", known_ransomware_campaign_use="knownRansomwareCampaignUse", notes="notes")
    nvd_facts = named("nvd", cve_id="cve_id", source_identifier=part("$.sourceIdentifier"), vuln_status="status", descriptions=part("$.descriptions"), cvss_metrics=part("$.metrics"), weaknesses=part("$.weaknesses"), cve_tags=part("$.cveTags"), vendor_comments=part("$.vendorComments"), reference_count=F.coalesce(F.json_array_length(part("$.references")), F.lit(0)), configuration_present=part("$.configurations").isNotNull())
    epss_facts = named("epss", score="score_text", percentile="percentile", score_date="score_date", score_date_precision=F.lit("DATE"), model_version="model_version", dataset_content_sha256="content_sha256") | {"capture.profile": "profile"}
    fox_facts = named("threatfox", source_ioc_id="id", ioc_value_raw="ioc", ioc_type="ioc_type", threat_type="threat_type", confidence_level="confidence_level", first_seen=iso(c("first_seen_at")), reporter="reporter", reference="reference", malware="malware", malware_printable="malware_printable", port=indicator["port"]) | {"indicator.normalization_status": indicator["status"]}
    bazaar_facts = named("malwarebazaar", sha256=sha, sha1=F.lower("sha1_hash"), md5=F.lower("md5_hash"), first_seen=iso(c("first_seen_at")), sha3_384="sha3_384_hash", file_name="file_name", file_size_bytes="file_size", file_type="file_type", signature=F.nullif(F.trim("signature"), F.lit("")))
    feodo_facts = named("feodo", ip_address="ip_address", port="port", status="status", hostname="hostname", as_number="as_number", as_name="as_name", country="country", last_online_date="last_online", malware_label=F.trim("malware"), endpoint_identity=feodo_identity())
    found = [
        Mapping("CISA_KEV", "KNOWN_EXPLOITED_VULNERABILITY", c("cveID"), [entity("CVE", c("cveID")), entity("VENDOR", scoped_key("vendor:cisa-kev:", "vendorProject"), F.trim("vendorProject")), entity("PRODUCT", scoped_key("product:cisa-kev:", "vendorProject", "product"), F.trim("product"))], kev_facts, [one(F.concat(F.lit(KEV_SEARCH), "cveID")), "notes"], effective=c("date_added"), key=F.concat(F.lit("cve:"), "cveID")),
        Mapping("NVD_CVE", "VULNERABILITY_RECORD", c("cve_id"), [entity("CVE", c("cve_id"))], nvd_facts, published=c("published"), updated=c("modified"), key=F.concat(F.lit("cve:"), "cve_id")),
        Mapping("FIRST_EPSS", "EXPLOIT_PROBABILITY_SCORE", c("cve"), [entity("CVE", c("cve"))], epss_facts, key=F.concat(F.lit("epss:"), "cve")),
        Mapping("THREATFOX", "IOC_REPORT", c("id"), [entity(kind, key, indicator["key"]), entity("MALWARE", F.concat(F.lit("malpedia:"), F.lower(malware)), label)], fox_facts, [one(F.concat(F.lit(IOC_PAGE), "id", F.lit("/"))), one(web(c("reference")))], effective=c("first_seen_at"), key=F.concat(F.lit("threatfox:ioc:"), "id")),
        Mapping("MALWAREBAZAAR", "MALWARE_SAMPLE_RECORD", c("sha256_hash"), [digest(x) for x in ("sha256", "sha1", "md5")] + [entity("MALWARE", F.concat(F.lit("malwarebazaar:signature:"), F.lower(F.nullif(F.trim("signature"), F.lit("")))), F.trim("signature"))], bazaar_facts, [one(F.concat(F.lit(SAMPLE_PAGE), sha, F.lit("/")))], effective=c("first_seen_at"), key=F.concat(F.lit("malwarebazaar:sample:sha256:"), sha)),
        Mapping("FEODO_TRACKER", "IOC_REPORT", c("record_id"), [entity("IP", c("ip_address")), entity("MALWARE", F.concat(F.lit("feodo-label:"), F.regexp_replace(F.lower(F.trim("malware")), r"\s+", "-")), F.trim("malware"))], feodo_facts, [one(F.lit(FEODO_LIST))], key=F.concat(F.lit("ioc:feodo-c2:"), feodo_identity())),
        Mapping("SSLBL_CERTIFICATE", "IOC_REPORT", c("sha1"), [entity("CERTIFICATE", F.concat(F.lit("sha1:"), F.lower("sha1")), F.lower("sha1"))], named("sslbl", certificate_sha1=F.lower("sha1"), listing_at=iso(c("listed_at")), listing_reason="reason"), [one(F.lit(SSLBL_LIST))], effective=c("listed_at"), key=F.concat(F.lit("ioc:sslbl-certificate:sha1:"), F.lower("sha1"))),
        Mapping("GITHUB_ADVISORY_REVIEWED", "SECURITY_ADVISORY", c("ghsa_id"), [entity("CVE", F.upper("cve_id"))], named("github_advisory", ghsa_id="ghsa_id", severity="severity", vulnerable_range="range", package=F.lower(F.concat_ws("/", "ecosystem", "package"))), published=c("published"), updated=c("updated")),
        Mapping("CISA_ICS_CSAF", "SECURITY_ADVISORY", c("advisory_id"), [], named("cisa_ics", advisory_id="advisory_id", publisher="publisher", title="title", cwes=F.array_join("cwes", "|")), published="published", mentioned=c("cves")),
        Mapping("JVN_IPEDIA", "SECURITY_ADVISORY", c("record_id"), [], {"title": c("title")}, [one(c("link"))], published=c("published"), mentioned=c("cves")),
        Mapping("CERT_EU_PUBLICATIONS", "CERT_CSIRT_PUBLICATION", c("serial"), [], {"title": c("title")}, [one(c("link"))], published=c("published"), mentioned=extract_ids("title")),
        Mapping("SIEMENS_PRODUCTCERT", "SECURITY_ADVISORY", c("record_id"), [], {"title": c("title")}, mentioned=c("cves")),
        Mapping("MITRE_ATTACK_ENTERPRISE", "CONTEXT_KNOWLEDGE", c("external_id"), [entity("ATTACK_TECHNIQUE", c("external_id"), F.concat_ws(" — ", "external_id", "name"))], {"tactics": F.array_join("tactics", "|"), "revoked": c("revoked")}),
    ]
    return {m.source_key: m for m in found}


def with_mentioned(canonical: DataFrame, ids: DataFrame, kind: str = "CVE") -> DataFrame:
    """canonical with the ids that a text mentions (source_record_id, ids) put behind its own entities."""
    extra = F.transform("_ids", lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key"), x.alias("label")))
    joined = canonical.join(ids.select("source_record_id", F.col("ids").alias("_ids")), "source_record_id", "left")
    return joined.withColumn("entities", F.concat("entities", F.coalesce(extra, F.array().cast(ENTITY)))).drop("_ids")
