"""Rules that definitions of measurements and their facts have to keep: patterns, lengths, and conditions between columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Granularities, precisions, and how long or many a definition's parts may be.
GRANULARITIES, PRECISIONS = ("FIVE_MINUTES", "HOUR", "DAY", "ONE_MINUTE"), ("INSTANT", "DATE")
LONGEST = {"measurement_key": (3, 256), "display_label": (1, 256), "description": (1, 2000), "represents": (1, 4000), "does_not_represent": (1, 4000)}
PATTERNS = {"measurement_key": "^[a-z0-9_.]+$", "contract_version": "^v[0-9]{1,31}$", "unit": "^[A-Z0-9_]{1,128}$"}
COUNTS = {"source_keys": (1, 16), "record_kinds": (0, 32), "granularities": (1, 4), "dimensions": (0, 16)}
NAME = "^[A-Z0-9_]{1,128}$"


def reasons(df: DataFrame, broken: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with `reasons`, all that are broken, in the rules' order. A rule that can't be
    decided, as something is null, isn't broken; rules for what has to be there say so themselves."""
    seen = df.withColumn("reasons", F.array_compact(F.array(*[F.when(bad, F.lit(why)) for why, bad in broken.items()])))
    return seen.where("size(reasons) = 0").drop("reasons"), seen.where("size(reasons) > 0")


def no(good: Column) -> Column:
    return ~F.coalesce(good, F.lit(False))


def validate_definitions(definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Definitions that keep the contract, and the others with reasons. Columns: those of LONGEST, PATTERNS and COUNTS,
    value_kind and time_precision."""
    broken = {f"{c.upper()}_LENGTH": no(F.length(c).between(*span)) for c, span in LONGEST.items()}
    broken |= {f"{c.upper()}_PATTERN": no(F.col(c).rlike(p)) for c, p in PATTERNS.items()}
    broken |= {f"{c.upper()}_COUNT": no(F.size(c).between(*span)) for c, span in COUNTS.items()}
    broken |= {f"{c.upper()}_NAME": F.exists(c, lambda x: no(x.rlike(NAME))) for c in ("source_keys", "record_kinds")}
    broken |= {
        "GRANULARITY_UNKNOWN": F.exists("granularities", lambda x: no(x.isin(*GRANULARITIES))),
        "PRECISION_UNKNOWN": no(F.col("time_precision").isin(*PRECISIONS)),
        "DATE_PRECISION_FINER_THAN_DAY": (F.col("time_precision") == "DATE") & F.exists("granularities", lambda x: x != "DAY"),
        "DISTRIBUTION_WITHOUT_DIMENSION": (F.col("value_kind") == "DISTRIBUTION") & (F.coalesce(F.size("dimensions"), F.lit(0)) == 0),
    }
    return reasons(definitions, broken)


def validate_facts(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts of which exactly one of event_time and event_date is there, as time_precision says, whose state is known, and whose
    value is finite; and the others with reasons."""
    exactly_one = F.col("event_time").isNotNull() != F.col("event_date").isNotNull()
    broken = {
        "TIME_EXACTLY_ONE": ~exactly_one,
        "INSTANT_WITHOUT_TIME": (F.col("time_precision") == "INSTANT") & F.col("event_time").isNull(),
        "DATE_WITHOUT_DATE": (F.col("time_precision") == "DATE") & F.col("event_date").isNull(),
        "PRECISION_UNKNOWN": no(F.col("time_precision").isin(*PRECISIONS)),
        "STATE_UNKNOWN": no(F.col("fact_state").isin("ACTIVE", "RETRACTED")),
        "VALUE_NOT_FINITE": F.isnan("value") | (F.abs("value") == float("inf")),
    }
    return reasons(facts, broken)
