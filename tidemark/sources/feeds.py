"""Feed readers: explicit schemas, one row a record, unknown fields kept in the payload, bad records told apart.

Every reader returns DataFrames; checks (declared counts, duplicate ids, stable totals) are DataFrames of violations, so
reading stays lazy and nothing is listed on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.json_texts import cvss_versions
from tidemark.functions.scalars import CWE, CVE, extract_ids, fingerprint, parse_date, parse_instant, scoped_key
from tidemark.operators.revisions import heads

ENTRY = "cveID string, vendorProject string, product string, vulnerabilityName string, dateAdded string, shortDescription string, requiredAction string, dueDate string, knownRansomwareCampaignUse string, notes string, cwes array<string>"
CATALOG = f"title string, catalogVersion string, dateReleased string, count long, vulnerabilities array<struct<{', '.join(':'.join(x.split(' ', 1)) for x in ENTRY.split(', '))}>>"
IOC = "id string, ioc string, threat_type string, ioc_type string, malware string, malware_printable string, confidence_level int, first_seen string, last_seen string, reporter string, reference string, tags array<string>"
SAMPLE = "sha256_hash string, sha1_hash string, md5_hash string, sha3_384_hash string, first_seen string, last_seen string, file_name string, file_size long, file_type string, signature string, tags array<string>"
C2 = "ip_address string, port int, status string, hostname string, as_number long, as_name string, country string, first_seen string, last_online string, malware string"
#: Fixed value: the title, in lower case, of the note that lists sectors.
SECTORS = "critical infrastructure sectors"
MESSAGE = "id string, timestamp double, host string, peer string, peer_asn string, path array<string>, announcements array<struct<next_hop:string,prefixes:array<string>>>, withdrawals array<string>"


def struct_of(ddl: str) -> str:
    return "struct<" + ", ".join(":".join(x.split(" ", 1)) for x in ddl.split(", ")) + ">"


def json_docs(spark: SparkSession, path: str | DataFrame, schema: str) -> DataFrame:
    """One row for each JSON document of a file or folder, or of a column `value` of texts; a document that is an array gives a
    row for each member. Every reader of JSON takes either."""
    if isinstance(path, str):
        return spark.read.option("multiLine", True).schema(schema).json(path)
    many = F.from_json("value", f"array<{struct_of_ddl(schema)}>")
    one = F.array(F.from_json("value", schema))
    return path.select(F.explode(F.when(F.trim("value").startswith("["), many).otherwise(one)).alias("d")).select("d.*")


def struct_of_ddl(schema: str) -> str:
    """The type of a row of this schema."""
    return StructType.fromDDL(schema).simpleString()


def manifest(rows: DataFrame, row_id: str) -> DataFrame:
    """Count, sorted ids and membership hash of a snapshot that is one document (so its ids fit one row)."""
    ids = F.array_sort(F.collect_list(row_id))
    return rows.agg(F.count("*").alias("count"), ids.alias("ids"), F.sha2(F.array_join(ids, "\n"), 256).alias("membership"))


def repeated_ids(rows: DataFrame, row_id: str) -> DataFrame:
    return rows.groupBy(row_id).agg(F.count("*").alias("n")).where("n > 1")


def scan_catalog(spark: SparkSession, path: str | DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries, manifest, and violations (a declared count that is wrong, repeated ids) of a catalogue snapshot."""
    docs = json_docs(spark, path, CATALOG)
    entries = docs.select("catalogVersion", "dateReleased", F.explode("vulnerabilities").alias("v")).select("catalogVersion", "dateReleased", "v.*")
    entries = entries.withColumns({"date_added": parse_date("dateAdded"), "due_date": parse_date("dueDate")})
    wrong = docs.where(F.coalesce(F.size("vulnerabilities"), F.lit(0)) != F.col("count")).select(F.lit("COUNT_MISMATCH").alias("kind"), F.col("catalogVersion").alias("key"))
    double = repeated_ids(entries, "cveID").select(F.lit("DUPLICATE_ID").alias("kind"), F.col("cveID").alias("key"))
    bad = entries.where(~F.coalesce(F.col("cveID").rlike(f"^{CVE}$"), F.lit(False)) | F.col("date_added").isNull()).select(F.lit("INVALID_ENTRY").alias("kind"), F.col("cveID").alias("key"))
    return entries, manifest(entries, "cveID"), wrong.union(double).union(bad)


def scan_paged(spark: SparkSession, path: str | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of a paged feed with their payload as text, and the totals if pages disagree on them."""
    docs = json_docs(spark, path, "startIndex long, resultsPerPage long, totalResults long, vulnerabilities array<struct<cve:string>>")
    rows = docs.select("startIndex", F.explode("vulnerabilities.cve").alias("payload"))
    one = lambda p: F.get_json_object("payload", p)
    rows = rows.select(
        one("$.id").alias("cve_id"), one("$.vulnStatus").alias("status"), parse_instant(one("$.published"), "ZONELESS").alias("published"), parse_instant(one("$.lastModified"), "ZONELESS").alias("modified"),
        extract_ids("payload", CWE).alias("cwes"), cvss_versions("payload").alias("cvss"), "payload",
    )
    totals = docs.agg(F.array_sort(F.collect_set("totalResults")).alias("totals")).where("size(totals) > 1")
    return rows, totals


def scan_scores(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows, metadata (of the comment line), rejected rows and violations (repeated ids, metadata that is missing) of a scored
    CSV, gzipped or not."""
    raw = spark.read.option("comment", "#").option("header", True).csv(path)
    score, share = F.col("epss").try_cast("double"), F.col("percentile").try_cast("double")
    good = F.coalesce(F.col("cve").rlike(f"^{CVE}$") & score.between(0, 1) & share.between(0, 1), F.lit(False))
    extra = [c for c in raw.columns if c not in ("cve", "epss", "percentile")]
    pairs = F.create_map(*[x for c in extra for x in (F.lit(c), F.col(c))]) if extra else F.create_map().cast("map<string,string>")
    rows = raw.where(good).select(F.upper("cve").alias("cve"), F.col("epss").alias("score_text"), score.alias("score"), share.alias("percentile"), F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("extras"))
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", "^\ufeff", "")).alias("value")).where(F.col("value").startswith("#"))
    tokens = lines.select(F.explode(F.split(F.expr("substring(value, 2)"), ",")).alias("p")).where(F.instr("p", ":") > 1).select(F.split("p", ":", 2).alias("kv"))
    metadata = tokens.select(F.trim(F.col("kv")[0]).alias("key"), F.trim(F.col("kv")[1]).alias("value"))
    wanted = spark.createDataFrame([("model_version",), ("score_date",)], "key string")
    lacking = wanted.join(metadata.where("value <> ''"), "key", "left_anti").select(F.lit("METADATA_MISSING").alias("kind"), "key")
    double = repeated_ids(rows, "cve").select(F.lit("DUPLICATE_ID").alias("kind"), F.col("cve").alias("key"))
    return rows, metadata, raw.where(~good), lacking.union(double)


def scan_reports(spark: SparkSession, path: str | DataFrame, schema: str, row_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of an envelope {query_status, data[]}, the manifest (count and first and last sight), and violations: envelopes of
    another status than ok, which give no rows, and repeated ids."""
    docs = json_docs(spark, path, f"query_status string, data array<{struct_of(schema)}>")
    rows = docs.where("query_status = 'ok'").select(F.explode("data").alias("d")).select("d.*")
    first = F.coalesce(parse_instant("first_seen", "UTC_SUFFIX"), parse_instant("first_seen", "ZONELESS"))
    rows = rows.withColumn("first_seen_at", first)
    summary = rows.agg(F.count("*").alias("count"), F.count_distinct(row_id).alias("ids"), F.min("first_seen_at").alias("oldest"), F.max("first_seen_at").alias("newest"))
    refused = docs.where("query_status is distinct from 'ok'").select(F.lit("BAD_STATUS").alias("kind"), F.col("query_status").alias("key"))
    double = repeated_ids(rows, row_id).select(F.lit("DUPLICATE_ID").alias("kind"), F.col(row_id).alias("key"))
    return rows, summary, refused.union(double)


def scan_ioc_reports(spark: SparkSession, path: str | DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return scan_reports(spark, path, IOC, "id")


def scan_samples(spark: SparkSession, path: str | DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return scan_reports(spark, path, SAMPLE, "sha256_hash")


def scan_c2(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Endpoints, identified by address, port, malware and first sight."""
    return json_docs(spark, path, C2).withColumn("record_id", fingerprint("ip_address", "port", "malware", "first_seen"))


def scan_certs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Headerless three-column list with # comments, a line of another width fails the read; and when the list was last
    updated, as its comment says (no row: it doesn't)."""
    rows = spark.read.option("comment", "#").option("mode", "FAILFAST").schema("listing_date string, sha1 string, reason string").csv(path)
    said = F.regexp_extract("value", r"^# Last updated:\s*([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}) UTC\s*$", 1)
    updated = spark.read.text(path).select(parse_instant(said, "ZONELESS").alias("last_updated")).where("last_updated is not null")
    return rows.withColumn("listed_at", parse_instant("listing_date", "ZONELESS")).withColumn("sha1", F.lower("sha1")), updated


def scan_advisories(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Package advisories, one row for each vulnerable package."""
    schema = "ghsa_id string, cve_id string, severity string, published_at string, updated_at string, vulnerabilities array<struct<package:struct<ecosystem:string,name:string>,vulnerable_version_range:string>>"
    docs = json_docs(spark, path, schema)
    rows = docs.select("ghsa_id", "cve_id", "severity", parse_instant("published_at").alias("published"), parse_instant("updated_at").alias("updated"), F.explode_outer("vulnerabilities").alias("v"))
    return rows.select("ghsa_id", "cve_id", "severity", "published", "updated", F.col("v.package.ecosystem").alias("ecosystem"), F.col("v.package.name").alias("package"), F.col("v.vulnerable_version_range").alias("range"))


def scan_csaf(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """One row for each advisory document of a folder: identifier, title, sorted CVEs, CWEs and sectors, content hash and path."""
    docs = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name()) if isinstance(path, str) else path.withColumn("path", F.lit(None).cast("string"))
    docs = docs.select("path", F.col("value").alias("payload"))
    one = lambda p: F.get_json_object("payload", p)
    notes = F.from_json(one("$.document.notes"), "array<struct<title:string,text:string>>")
    sectors = F.flatten(F.transform(F.filter(F.coalesce(notes, F.array()), lambda n: F.lower(n["title"]) == SECTORS), lambda n: F.transform(F.split(n["text"], ","), lambda x: F.trim(x))))
    return docs.select(
        one("$.document.tracking.id").alias("advisory_id"), one("$.document.title").alias("title"), one("$.document.publisher.name").alias("publisher"),
        extract_ids("payload").alias("cves"), extract_ids("payload", CWE).alias("cwes"), F.array_sort(F.array_distinct(F.filter(sectors, lambda x: x != ""))).alias("sectors"), F.sha2("payload", 256).alias("content"), "path",
    )


def scan_xml_items(spark: SparkSession, path: str | DataFrame, schema: str, row_tag: str = "item") -> DataFrame:
    """Rows of an XML feed (RDF or RSS) by their element."""
    if isinstance(path, str):
        return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return path.select(F.from_xml("value", schema).alias("x")).select("x.*")


def scan_rdf(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    rows = scan_xml_items(spark, path, "title string, link string, description string, `dc:date` string, `sec:identifier` string")
    return rows.select(F.col("`sec:identifier`").alias("record_id"), "title", "link", parse_instant("`dc:date`").alias("published"), extract_ids(F.concat_ws(" ", "title", "description")).alias("cves"))


def scan_rss(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Items of an RSS feed, the newest of each serial."""
    rows = scan_xml_items(spark, path, "title string, link string, description string, pubDate string, guid string")
    serial = F.coalesce(F.nullif(F.regexp_extract("title", r"([0-9]{4}-[0-9]{3,})", 1), F.lit("")), F.col("guid"), F.col("link"))
    rows = rows.withColumn("serial", serial).withColumn("published", F.try_to_timestamp(F.regexp_replace("pubDate", r"^\w+, ", ""), F.lit("dd MMM yyyy HH:mm:ss Z")))
    return heads(rows, ["serial"], [F.desc_nulls_last("published"), F.desc("link")])


def scan_rolie(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Entries of a ROLIE feed; the advisory number, or a key of the entry's id."""
    entry = "id string, title string, published string, updated string, summary string"
    docs = json_docs(spark, path, f"feed struct<entry:array<{struct_of(entry)}>>")
    rows = docs.select(F.explode("feed.entry").alias("e")).select("e.*")
    number = F.nullif(F.regexp_extract(F.upper("id"), r"(SSA-[0-9]+)", 1), F.lit(""))
    return rows.withColumn("record_id", F.coalesce(number, scoped_key("rolie:", "id"))).withColumn("cves", extract_ids(F.concat_ws(" ", "title", "summary")))


def scan_stix(spark: SparkSession, path: str | DataFrame, source_name: str = "mitre-attack") -> DataFrame:
    """Attack patterns of a STIX bundle with their external id and tactics."""
    schema = "objects array<struct<type:string,id:string,name:string,revoked:boolean,external_references:array<struct<source_name:string,external_id:string>>,kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>>>"
    rows = json_docs(spark, path, schema).select(F.explode("objects").alias("o")).select("o.*").where("type = 'attack-pattern'")
    external = F.get(F.filter("external_references", lambda r: r["source_name"] == source_name), F.lit(0))["external_id"]
    return rows.select("id", "name", F.coalesce("revoked", F.lit(False)).alias("revoked"), external.alias("external_id"), F.array_sort(F.array_distinct(F.transform("kill_chain_phases", lambda p: p["phase_name"]))).alias("tactics"))


def routing_columns(message: Column) -> list[Column]:
    """Columns of a routing observation of a parsed message."""
    last = F.try_element_at(message["path"], F.lit(-1)).try_cast("bigint")
    prefixes = F.flatten(F.transform(F.coalesce(message["announcements"], F.array().cast("array<struct<next_hop:string,prefixes:array<string>>>")), lambda a: a["prefixes"]))
    clean = lambda c: F.array_sort(F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda p: F.lower(p))))
    return [
        message["id"].alias("message_id"),
        F.timestamp_micros((message["timestamp"] * 1000000).cast("bigint")).alias("observed_at"),
        F.regexp_extract(message["host"], r"^(rrc[0-9]+)", 1).alias("rrc"),
        message["peer_asn"].try_cast("bigint").alias("peer"),
        clean(prefixes).alias("announced"),
        clean(message["withdrawals"]).alias("withdrawn"),
        F.when(last.isNotNull(), F.array(last)).otherwise(F.array().cast("array<bigint>")).alias("origins"),
    ]


def parse_messages(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Routing observations of text lines, with `rejected` for lines that aren't a message and the columns of `keep`; works on
    streams too."""
    parsed = lines.withColumn("m", F.from_json(value, MESSAGE))
    bad = F.col("m").isNull() | F.col("m.timestamp").isNull() | F.col("m.host").isNull()
    return parsed.select(*routing_columns(F.col("m")), bad.alias("rejected"), F.col(value).alias("raw"), *keep)


def scan_decoded_mrt(spark: SparkSession, path: str, rrc: str) -> DataFrame:
    """Decoded archive records as routing observations of one collector; the id is a hash of what they say."""
    rows = spark.read.schema("timestamp double, peer_ip string, peer_asn long, announced array<string>, withdrawn array<string>, origin_asns array<long>").json(path)
    clean = lambda c: F.array_sort(F.array_distinct(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda p: F.lower(p))))
    out = rows.select(F.timestamp_micros((F.col("timestamp") * 1000000).cast("bigint")).alias("observed_at"), F.lit(rrc).alias("rrc"), F.col("peer_asn").alias("peer"), "peer_ip", clean("announced").alias("announced"), clean("withdrawn").alias("withdrawn"), F.coalesce("origin_asns", F.array().cast("array<bigint>")).alias("origins"))
    return out.withColumn("message_id", fingerprint(F.unix_micros("observed_at"), "rrc", "peer_ip", F.array_join("announced", ","), F.array_join("withdrawn", ",")))
