"""Snapshot parity, fingerprints, guards, audits and status reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import fingerprint, freshness


#: How a routing minute was acquired.
ROUTING_BASES = ("LIVE_STREAM", "MRT_RECOVERY")


def same_number(a: Column, b: Column, tolerance: float = 1e-12) -> Column:
    return F.coalesce(F.abs(a - b) <= tolerance, a.isNull() & b.isNull())


def parity(left: DataFrame, right: DataFrame, key: str, exact: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Full outer diff: key, verdict (MATCH, VALUE_MISMATCH, LEFT_ONLY, RIGHT_ONLY) and the sorted fields that differ."""
    columns = [*exact, *numeric]
    a = left.select(key, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(1).alias("_a"))
    b = right.select(key, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(1).alias("_b"))
    both = a.join(b, key, "full_outer")
    differ = [F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), c) for c in exact] + [F.when(~same_number(F.col(f"a_{c}"), F.col(f"b_{c}")), c) for c in numeric]
    fields = F.array_sort(F.array_compact(F.array(*differ)))
    verdict = F.when(F.col("_b").isNull(), "LEFT_ONLY").when(F.col("_a").isNull(), "RIGHT_ONLY").when(F.size(fields) > 0, "VALUE_MISMATCH").otherwise("MATCH")
    matched = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return both.select(key, verdict.alias("verdict"), F.when(matched, F.array_join(fields, ",")).otherwise("").alias("fields"))


#: Classes of differences, and two bases of observation that mean the same.
REGRESSION, SKEW, EQUIVALENT, UNCLASSIFIED = "REGRESSION", "TEMPORAL_SKEW", "SEMANTICALLY_EQUIVALENT", "UNCLASSIFIED"
SAME_BASES = ("ENRICHED", "PUBLISHED")


def parity_differences(
    left: DataFrame, right: DataFrame, key: str, exact: Sequence[str], numeric: Sequence[str] = (), sets: Sequence[str] = (), advancing: Sequence[str] = (),
    left_first: bool | None = None, same_snapshot: bool = False, exact_membership: bool = True, manual: DataFrame | None = None,
) -> DataFrame:
    """Classified differences of two snapshots: kind, key, field, left_value, right_value (text), classification.

    Values of `exact` must be equal (null equals null), of `numeric` within 1e-12, of `sets` (arrays) in any order. A time of
    `advancing` may be later, or come first, in the snapshot taken later (left_first: the left one is older; None: both at
    once): TEMPORAL_SKEW, else REGRESSION. A record of one side only takes its class from `manual` (side, key, classification),
    else is a REGRESSION if the snapshot is the same and membership must be exact, else UNCLASSIFIED. An id that is repeated is
    one DUPLICATE_IDENTITY a side, and its least row is compared.
    """
    columns = [*exact, *numeric, *sets, *advancing]
    prepared = lambda df: df.select(key, *exact, *numeric, *advancing, *[F.array_sort(c).alias(c) for c in sets])
    least = lambda df, p: prepared(df).groupBy(key).agg(F.min(F.struct(*columns)).alias(p), F.count("*").alias(f"{p}_n"))
    both = least(left, "a").join(least(right, "b"), key, "full_outer")
    text = lambda c: F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v"))))

    def skew(a: Column, b: Column) -> Column:
        if left_first is None:
            return F.lit(False)
        early, late = (a, b) if left_first else (b, a)
        return late.isNotNull() & F.coalesce(early <= late, F.lit(True))

    items = []
    for c in columns:
        a, b = F.col(f"a.{c}"), F.col(f"b.{c}")
        equal = same_number(a, b) if c in numeric else a.eqNullSafe(b)
        kind = F.when(skew(a, b), SKEW).otherwise(REGRESSION) if c in advancing else F.lit(REGRESSION)
        items.append(F.when(~equal, F.struct(F.lit("FACT_MISMATCH").alias("kind"), F.lit(c).alias("field"), text(a).alias("left_value"), text(b).alias("right_value"), kind.alias("classification"))))
    matched = F.col("a_n").isNotNull() & F.col("b_n").isNotNull()
    facts = both.where(matched).select(key, F.explode(F.array_compact(F.array(*items))).alias("x"))
    columns_out = lambda df: df.select("x.kind", key, "x.field", "x.left_value", "x.right_value", "x.classification")

    alone = both.where(~matched).withColumn("kind", F.when(F.col("b_n").isNull(), "LEFT_ONLY").otherwise("RIGHT_ONLY"))
    rule = REGRESSION if same_snapshot and exact_membership else UNCLASSIFIED
    if manual is not None:
        said = manual.groupBy(F.col("side").alias("kind"), key).agg(F.min("classification").alias("_said"))
        alone = alone.join(said, ["kind", key], "left")
    else:
        alone = alone.withColumn("_said", F.lit(None).cast("string"))
    none = F.lit(None).cast("string")
    unmatched = alone.select("kind", key, none.alias("field"), none.alias("left_value"), none.alias("right_value"), F.coalesce("_said", F.lit(rule)).alias("classification"))
    sides = F.array_compact(F.array(*[F.when(F.col(f"{p}_n") > 1, side) for p, side in (("a", "LEFT"), ("b", "RIGHT"))]))
    double = both.select(key, F.explode(sides).alias("field")).select(F.lit("DUPLICATE_IDENTITY").alias("kind"), key, "field", none.alias("left_value"), none.alias("right_value"), F.lit(REGRESSION).alias("classification"))
    return columns_out(facts).unionByName(unmatched).unionByName(double)


def semantic_differences(left: DataFrame, right: DataFrame, key: str, moving: Column, same_bases: Column) -> DataFrame:
    """Differences of the snapshots' own rows (key, source_class, basis, window_start, window_end): kind, key, field,
    classification. Sources of `moving` need the same window, bounded on both sides; for those of `same_bases`, two bases of
    SAME_BASES are equivalent."""
    fields = ("source_class", "basis", "window_start", "window_end")
    both = left.select(key, F.struct(*fields).alias("a")).join(right.select(key, F.struct(*fields).alias("b")), key)
    window = F.coalesce((F.col("a.window_start") == F.col("b.window_start")) & (F.col("a.window_end") == F.col("b.window_end")), F.lit(False))
    alike = same_bases & F.col("a.basis").isin(*SAME_BASES) & F.col("b.basis").isin(*SAME_BASES)
    told = lambda field, kind: F.struct(F.lit(field).alias("field"), kind.alias("classification"))
    items = F.array(
        F.when(moving & ~window, told("window", F.lit(REGRESSION))),
        F.when(~F.col("a.source_class").eqNullSafe(F.col("b.source_class")), told("source_class", F.lit(REGRESSION))),
        F.when(~F.col("a.basis").eqNullSafe(F.col("b.basis")), told("basis", F.when(alike, EQUIVALENT).otherwise(REGRESSION))),
    )
    return both.select(key, F.explode(F.array_compact(items)).alias("x")).select(F.lit("SEMANTIC_MISMATCH").alias("kind"), key, "x.field", "x.classification")


def parity_accepted(differences: DataFrame) -> DataFrame:
    """blocking, unexplained, accepted: regressions and unclassified differences, and whether there are none."""
    sums = differences.agg(F.count_if(F.col("classification") == REGRESSION).alias("blocking"), F.count_if(F.col("classification") == UNCLASSIFIED).alias("unexplained"))
    return sums.withColumn("accepted", (F.col("blocking") == 0) & (F.col("unexplained") == 0))


def snapshot_fingerprint(df: DataFrame, key: Sequence[str], row_id: str, columns: Sequence[str]) -> DataFrame:
    """rows and a fingerprint of each snapshot that doesn't depend on row order: the sha-256 of the eight sums, modulo 2^32, of
    the 32-bit words of all row digests. Sums are partial aggregates, so no task gathers a snapshot."""
    digest = fingerprint(row_id, *columns)
    words = {f"_w{i}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(8)}
    sums = df.select(*key, *[w.alias(n) for n, w in words.items()]).groupBy(*key).agg(F.count("*").alias("rows"), *[F.sum(n).alias(n) for n in words])
    whole = F.concat_ws(".", F.col("rows"), *[F.pmod(F.col(n), F.lit(1 << 32)) for n in words])
    return sums.select(*key, "rows", F.sha2(whole, 256).alias("fp"))


def population_guard(snapshots: DataFrame, order: str, floor_share: float = 0.75) -> DataFrame:
    """snapshots (model, rows, dataset_date) with verdict: REJECT_DROP if the same model has fewer rows than the share of the
    snapshot before, REJECT_REGRESSION if its date goes back, else ACCEPT."""
    w = Window.partitionBy("source_key").orderBy(order)
    prev = F.lag(F.struct("model", "rows", "dataset_date")).over(w)
    out = snapshots.withColumn("_p", prev)
    drop = (F.col("_p.model") == F.col("model")) & (F.col("rows") < F.floor(F.col("_p.rows") * floor_share))
    verdict = F.when(F.coalesce(F.col("dataset_date") < F.col("_p.dataset_date"), F.lit(False)), "REJECT_REGRESSION").when(F.coalesce(drop, F.lit(False)), "REJECT_DROP").otherwise("ACCEPT")
    return out.withColumn("verdict", verdict).drop("_p")


def audit(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row for each named check: how many rows violate it, and whether that is none."""
    whole = None
    for name, violations in checks.items():
        part = violations.agg(F.count("*").alias("violations")).select(F.lit(name).alias("invariant"), "violations")
        whole = part if whole is None else whole.union(part)
    return whole.withColumn("accepted", F.col("violations") == 0)


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: Sequence[str]) -> DataFrame:
    return child.join(parent.select(*key).distinct(), list(key), "left_anti")


def source_status(sources: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """Last success, runs by state and freshness of every source."""
    per = runs.groupBy("source_key").agg(
        F.max(F.when(F.col("state") == "SUCCEEDED", F.col("scheduled_for"))).alias("last_success"),
        F.count("*").alias("runs"),
        F.count_if(F.col("state") == "FAILED").alias("failed"),
        F.max_by("state", "scheduled_for").alias("last_state"),
    )
    joined = sources.join(per, "source_key", "left").fillna(0, ["runs", "failed"])
    ready = F.when(F.col("last_success").isNull(), "NOT_READY").when(F.col("last_state") == "FAILED", "DEGRADED").otherwise("READY")
    return joined.withColumns({"freshness": freshness("last_success", "poll_seconds", now), "readiness": ready})


def acquisition_summary(rows: DataFrame, key: Sequence[str], basis: str) -> DataFrame:
    """Sorted distinct bases, and their kind: LIVE_STREAM or MRT_RECOVERY where that is the only one, else MIXED."""
    sets = rows.groupBy(*key).agg(F.array_sort(F.collect_set(basis)).alias("bases"))
    alone = (F.size("bases") == 1) & F.get("bases", F.lit(0)).isin(*ROUTING_BASES)
    return sets.withColumn("kind", F.when(alone, F.get("bases", F.lit(0))).otherwise("MIXED"))
