"""The measurement catalogue as data, and its expansion over records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measurement:
    key: str
    aggregation: str
    axis: str
    granularities: tuple[str, ...]
    coverage: str
    comparison: str = "SUM_EVENTS"
    dimensions: tuple[str, ...] = ()

    @property
    def source(self) -> str:
        return self.key.rsplit(".", 1)[0]


FIVE, HOURS, DAYS = ("FIVE_MINUTES", "HOUR", "DAY"), ("HOUR", "DAY"), ("DAY",)
ROUTING = ("MINUTE", *FIVE)
TIME, LIVE, SNAPSHOT, DATASET = "SOURCE_TIME_AVAILABILITY_REQUIRED", "SOURCE_COVERAGE_REQUIRED", "SNAPSHOT_CONFIRMATION_REQUIRED", "DATASET_AVAILABILITY_REQUIRED"

#: The definitions.
CATALOGUE = [
    Measurement("vulnerability.cisa_kev.additions", "COUNT_DISTINCT", "DATASET_DATE", DAYS, TIME),
    Measurement("vulnerability.cisa_kev.updates_observed", "COUNT_EVENTS", "RECEIVED", HOURS, LIVE),
    Measurement("vulnerability.cisa_kev.membership_removals_observed", "COUNT_EVENTS", "RECEIVED", HOURS, SNAPSHOT),
    Measurement("vulnerability.cisa_kev.catalog_size", "SNAPSHOT_LAST_CARRY_FORWARD", "RECEIVED", HOURS, SNAPSHOT, "LAST_VALUE"),
    Measurement("vulnerability.nvd.publications", "COUNT_DISTINCT", "PUBLISHED", HOURS, TIME, "SUM_EVENTS", ("STATUS", "CWE", "CVSS")),
    Measurement("vulnerability.nvd.modifications", "COUNT_EVENTS", "UPSTREAM_UPDATED", HOURS, TIME),
    Measurement("exploitation.epss.scored_records", "DATASET_COUNT", "DATASET_DATE", DAYS, DATASET, "LAST_VALUE"),
    Measurement("exploitation.epss.score_distribution", "DISTRIBUTION_COUNT", "DATASET_DATE", DAYS, DATASET, "NONE", ("SCORE_BAND",)),
    Measurement("ioc.threatfox.reporting_volume", "COUNT_EVENTS", "EFFECTIVE", FIVE, TIME, "SUM_EVENTS", ("IOC_TYPE", "MALWARE")),
    Measurement("ioc.threatfox.distinct_indicators", "COUNT_DISTINCT", "EFFECTIVE", FIVE, TIME, "EXACT_DISTINCT_QUERY", ("IOC_TYPE",)),
    Measurement("ioc.threatfox.first_seen_indicators", "FIRST_SEEN_DISTINCT", "EFFECTIVE", FIVE, TIME, "EXACT_DISTINCT_QUERY", ("IOC_TYPE",)),
    Measurement("ioc.threatfox.report_updates_observed", "COUNT_EVENTS", "RECEIVED", HOURS, LIVE),
    Measurement("malware.malwarebazaar.sample_reporting", "COUNT_EVENTS", "EFFECTIVE", FIVE, TIME, "SUM_EVENTS", ("FILE_TYPE", "SIGNATURE")),
    Measurement("malware.malwarebazaar.distinct_hashes", "COUNT_DISTINCT", "EFFECTIVE", FIVE, TIME, "EXACT_DISTINCT_QUERY"),
    Measurement("malware.malwarebazaar.first_seen_hashes", "FIRST_SEEN_DISTINCT", "EFFECTIVE", FIVE, TIME, "EXACT_DISTINCT_QUERY"),
    Measurement("malware.malwarebazaar.sample_updates_observed", "COUNT_EVENTS", "RECEIVED", HOURS, LIVE),
    Measurement("internal.synthetic.events", "COUNT_EVENTS", "EFFECTIVE", FIVE, TIME),
    Measurement("ioc.feodo_tracker.new_records_observed", "COUNT_EVENTS", "RECEIVED", HOURS, LIVE, "SUM_EVENTS", ("MALWARE", "COUNTRY")),
    Measurement("ioc.sslbl.certificate_listings_observed", "COUNT_EVENTS", "RECEIVED", HOURS, LIVE),
    Measurement("vulnerability.github_advisory.publications", "COUNT_EVENTS", "PUBLISHED", HOURS, TIME, "SUM_EVENTS", ("SEVERITY",)),
    Measurement("vulnerability.github_advisory.updates_observed", "COUNT_EVENTS", "RECEIVED", HOURS, LIVE, "SUM_EVENTS", ("SEVERITY",)),
    Measurement("vulnerability.cisa_ics.advisory_publications", "COUNT_EVENTS", "PUBLISHED", HOURS, TIME, "SUM_EVENTS", ("PUBLISHER",)),
    Measurement("vulnerability.cisa_ics.advisory_updates_observed", "COUNT_EVENTS", "RECEIVED", HOURS, LIVE, "SUM_EVENTS", ("PUBLISHER",)),
    *[Measurement(f"routing.ripe_ris.{x}", "COUNT_EVENTS", "OBSERVED", ROUTING, LIVE) for x in ("update_messages", "announcement_prefix_events", "withdrawal_prefix_events")],
    *[Measurement(f"routing.ripe_ris.{x}", "COUNT_DISTINCT", "OBSERVED", ROUTING, LIVE) for x in ("distinct_prefixes_observed", "distinct_announced_prefixes", "distinct_withdrawn_prefixes", "distinct_origin_asns_observed")],
]


def registry(definitions: list[Measurement] = CATALOGUE) -> dict[str, Measurement]:
    """Definitions by key; a repeated key is an error."""
    out: dict[str, Measurement] = {}
    for m in definitions:
        if m.key in out:
            raise ValueError(f"{m.key} is defined twice")
        out[m.key] = m
    return out


def definitions_frame(spark: SparkSession, definitions: list[Measurement] = CATALOGUE) -> DataFrame:
    """The catalogue as a small DataFrame."""
    rows = [(m.key, m.source, m.aggregation, m.axis, list(m.granularities), m.coverage, m.comparison, list(m.dimensions)) for m in definitions]
    return spark.createDataFrame(rows, "measurement_key string, source_key string, aggregation string, axis string, granularities array<string>, coverage string, comparison string, dimensions array<string>")


def fan_out(records: DataFrame, definitions: DataFrame) -> DataFrame:
    """Each record once for every measurement of its source, with the time of the measurement's axis; records without that
    time are left out. Definitions with record_kinds (an empty list or a null: any) take only records of these kinds, by their
    record_kind. The catalogue has as many rows as there are definitions, so it is broadcast."""
    joined = records.join(F.broadcast(definitions), "source_key")
    if "record_kinds" in definitions.columns and "record_kind" in records.columns:
        joined = joined.where(F.col("record_kinds").isNull() | (F.size("record_kinds") == 0) | F.array_contains("record_kinds", F.col("record_kind")))
    axis = F.col("axis")
    at = F.when(axis == "RECEIVED", F.col("received_at")).when(axis == "PUBLISHED", F.col("published_at")).when(axis == "UPSTREAM_UPDATED", F.col("updated_at")).otherwise(F.col("effective_at"))
    return joined.withColumn("event_time", at).where("event_time is not null")
