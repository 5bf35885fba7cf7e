"""Append-only revisions: heads, numbering, revising, retracting, change feeds. Keys are shuffled once for each operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import bucket_start


def heads(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key by `order` (DISTINCT ON). Row numbers up to n are a group limit before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def revision_number(df: DataFrame, key: Sequence[str], order: Sequence[Column], name: str = "revision") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def with_previous(df: DataFrame, key: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """prev_<column> of the row before it in its key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns})


def valid_to(df: DataFrame, key: Sequence[str], start: str, name: str = "effective_to", ties: Sequence[str] = ()) -> DataFrame:
    """The next start of the same key, null for the last; rows of one start follow each other by `ties`."""
    return df.withColumn(name, F.lead(start).over(Window.partitionBy(*key).orderBy(start, *ties)))


def running_max(df: DataFrame, key: Sequence[str], order: Sequence[Column], column: str, name: str) -> DataFrame:
    """The largest value of the rows before, null for the first."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.max(column).over(w))


def carry_forward(df: DataFrame, key: Sequence[str], order: Sequence[Column], column: str, name: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(column, ignorenulls=True).over(w))


def rank_share(df: DataFrame, key: Sequence[str], order: Sequence[Column], count: str) -> DataFrame:
    """rank inside the key, and the share of count in the key's sum."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    total = F.sum(count).over(Window.partitionBy(*key))
    return ranked.withColumn("share", F.when(total > 0, F.col(count) / total))


def top_k(df: DataFrame, threshold: Column, order: Sequence[Column], k: int) -> DataFrame:
    """The best k rows past a threshold: a bounded heap in every task."""
    return df.where(threshold).orderBy(*order).limit(k)


def top_n_per(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return heads(df, key, order, n)


def latest(df: DataFrame, order: Sequence[Column], cap: int) -> DataFrame:
    return df.orderBy(*order).limit(cap)


def page(df: DataFrame, at: str, row_id: str, cursor: tuple | None, n: int) -> DataFrame:
    """Newest first, after a cursor (at, id): n + 1 rows, so the caller sees whether more follow."""
    if cursor is not None:
        when, last = F.lit(cursor[0]).cast(df.schema[at].dataType), F.lit(cursor[1])
        df = df.where((F.col(at) < when) | ((F.col(at) == when) & (F.col(row_id) < last)))
    return df.orderBy(F.desc(at), F.desc(row_id)).limit(n + 1)


def new_only(candidates: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Candidates whose natural key isn't there yet, one for each key."""
    return candidates.dropDuplicates(list(key)).join(existing.select(*key).distinct(), list(key), "left_anti")


def pending(inputs: DataFrame, receipts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inputs without a receipt."""
    return inputs.join(receipts.select(*key), list(key), "left_anti")


def append_revisions(existing: DataFrame, candidates: DataFrame, key: Sequence[str], fp: str, order: Sequence[Column]) -> DataFrame:
    """The rows to append: candidates that differ from the head of their key, numbered after it. existing has `revision`.

    Candidates of one key follow each other in `order`; one that repeats the fingerprint before it is dropped.
    """
    head = existing.groupBy(*key).agg(F.max("revision").alias("_rev"), F.max_by(fp, "revision").alias("_fp"))
    w = Window.partitionBy(*key).orderBy(*order)
    joined = candidates.join(head, list(key), "left").withColumn("_before", F.coalesce(F.lag(fp).over(w), F.col("_fp")))
    changed = joined.where(~F.col(fp).eqNullSafe(F.col("_before")))
    number = F.coalesce(F.col("_rev"), F.lit(0)) + F.row_number().over(w)
    return changed.withColumn("revision", number.cast("int")).drop("_rev", "_fp", "_before")


def revise(head: DataFrame, candidates: DataFrame, key: Sequence[str], fp: str, at: str, granularity: str) -> tuple[DataFrame, DataFrame]:
    """New revisions of candidates (one a key) that differ from the head, and the dirty buckets of old and new position."""
    old = head.select(*key, F.col("revision").alias("_rev"), F.col(fp).alias("_fp"), F.col(at).alias("_at"))
    joined = candidates.join(old, list(key), "left").where(~F.col(fp).eqNullSafe(F.col("_fp")))
    revisions = joined.withColumn("revision", (F.coalesce("_rev", F.lit(0)) + 1).cast("int")).drop("_rev", "_fp", "_at")
    spots = F.array_compact(F.array(bucket_start(at, granularity), bucket_start("_at", granularity)))
    dirty = joined.select(F.explode(spots).alias("bucket_start")).distinct()
    return revisions, dirty


def retract(head: DataFrame, ids: DataFrame, key: Sequence[str]) -> DataFrame:
    """RETRACTED revisions of the active heads with these keys."""
    gone = head.where("state = 'ACTIVE'").join(ids.select(*key).distinct(), list(key), "left_semi")
    return gone.withColumns({"revision": F.col("revision") + 1, "state": F.lit("RETRACTED")})


def retract_missing(active: DataFrame, current: DataFrame, record: Sequence[str], key: str) -> DataFrame:
    """Active observations of a re-projected record that its newest projection lacks."""
    again = active.join(current.select(*record).distinct(), list(record), "left_semi")
    return again.join(current.select(*record, key).distinct(), [*record, key], "left_anti")


def dirty_buckets(changes: DataFrame, at: str, granularities: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row for each affected (kept columns, granularity, bucket)."""
    spots = F.array(*[F.struct(F.lit(g).alias("granularity"), bucket_start(at, g).alias("bucket_start")) for g in granularities])
    return changes.select(*keep, F.explode(spots).alias("b")).select(*keep, "b.*").distinct()


def emit_buckets(previous: DataFrame, new: DataFrame, key: Sequence[str], compared: Sequence[str], end: str, now: Column, coverage_provisional: Column) -> DataFrame:
    """Bucket revisions to append: new rows that differ from the head in a compared column, with number and state.

    PROVISIONAL while the bucket or its coverage is open, else REVISED if an earlier revision exists, else SETTLED.
    """
    old = previous.select(*key, F.col("revision").alias("_rev"), *[F.col(c).alias(f"_{c}") for c in compared])
    same = F.lit(True)
    for c in compared:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = new.join(old, list(key), "left").where(F.col("_rev").isNull() | ~same)
    state = F.when((F.col(end) > now) | coverage_provisional, "PROVISIONAL").when(F.col("_rev").isNotNull(), "REVISED").otherwise("SETTLED")
    out = joined.withColumns({"revision": (F.coalesce("_rev", F.lit(0)) + 1).cast("int"), "state": state})
    return out.drop("_rev", *[f"_{c}" for c in compared])


def reconcile(expected: DataFrame, active: DataFrame, key: Sequence[str], fp: str) -> DataFrame:
    """What to append so that the active findings become the expected ones: NEW, REVISED or RETRACTED keys."""
    e = expected.select(*key, F.col(fp).alias("_new"))
    a = active.select(*key, F.col(fp).alias("_old"))
    both = e.join(a, list(key), "full_outer")
    action = F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "RETRACTED").when(F.col("_new") != F.col("_old"), "REVISED")
    return both.withColumn("action", action).where("action is not null").select(*key, "action")


def rebuild_range(spans: DataFrame, granularity: str, size_s: int) -> DataFrame:
    """All buckets of each span (start, end) as dirty, once each: granularity, bucket_start. A span may come from a table, so that
    nothing is read before the buckets are."""
    first, last = F.unix_timestamp("start"), F.unix_timestamp("end") - 1
    begun = first - F.pmod(first, F.lit(size_s))
    rows = spans.where(last >= first).select(F.explode(F.sequence(begun, last, F.lit(size_s).cast("long"))).alias("_s"))
    return rows.distinct().select(F.lit(granularity).alias("granularity"), F.timestamp_seconds("_s").alias("bucket_start"))


def removals(manifests: DataFrame, key: Sequence[str], at: str, member: str) -> DataFrame:
    """Members of a manifest that the next one of the same key lacks: at (of the next), member. A manifest is the rows (key,
    at, member) of one time; only the times of a key are ordered, members meet the next manifest by equality."""
    rows = manifests.select(*key, at, member).distinct()
    times = valid_to(rows.select(*key, at).distinct(), key, at, "_next").where("_next is not null")
    after = rows.join(times, [*key, at]).select(*key, F.col("_next").alias(at), member)
    return after.join(rows, [*key, at, member], "left_anti")


def changed(current: DataFrame, previous: DataFrame, path: str, content: str) -> tuple[DataFrame, DataFrame]:
    """Rows that are new or have another content; rows whose path is gone."""
    return current.join(previous, [path, content], "left_anti"), previous.join(current, path, "left_anti")


def merge_newest(feeds: Sequence[DataFrame], key: Sequence[str], modified: str) -> DataFrame:
    """One row a key: the newest; on a tie the earlier feed's."""
    whole = None
    for i, feed in enumerate(feeds):
        part = feed.withColumn("_feed", F.lit(i))
        whole = part if whole is None else whole.unionByName(part)
    return heads(whole, key, [F.desc(modified), F.asc("_feed")]).drop("_feed")


def purge_expired(payloads: DataFrame, key: Sequence[str], expires: str, now: Column, limit: int) -> tuple[DataFrame, DataFrame]:
    """Payloads kept now, and the oldest `limit` expired ones to drop (ties by key). Expired ones past the limit stay for the
    next batch."""
    gone = payloads.where(F.col(expires) < now).orderBy(expires, *key).limit(limit)
    return payloads.join(gone.select(*key), list(key), "left_anti"), gone


def merge_snapshot(raw: DataFrame, captured_at: Column, received: str, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest revision of each record as it was known at a time."""
    return heads(raw.where(F.col(received) <= captured_at), key, order)
