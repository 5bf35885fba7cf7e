"""Rows of several kinds on one time axis: what was last said before a row, without joining every pair of a key.

A key's rows are dealt by spans of time. Inside a span a window carries values forward; what lies in earlier spans comes from one
row for each span. So a busy key is dealt by time, and the work is linear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import bucket_start


def last_said(rows: DataFrame, key: Sequence[str], at: str, said: Column, name: str, first: Column | None = None, span: str | None = "DAY") -> DataFrame:
    """rows with `name`: the last `said` that isn't null, at or before each row of its key. Of rows of one time those with a
    smaller `first` come before, so that they are heard by the others.

    Without a span a key is ordered as a whole. That is for keys whose rows are few, such as a source's schedule: rows that lie
    by key already aren't moved again.
    """
    rank = F.lit(0) if first is None else first
    if span is None:
        whole = Window.partitionBy(*key).orderBy(F.unix_micros(F.col(at).cast("timestamp")), rank).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn(name, F.last(said, ignorenulls=True).over(whole))
    rows = rows.withColumns({"_span": bucket_start(at, span), "_said": said, "_rank": rank})
    order = F.struct(F.unix_micros(F.col(at).cast("timestamp")), F.col("_rank"))
    spoken = F.col("_said").isNotNull()
    per = rows.groupBy(*key, "_span").agg(F.max_by(F.when(spoken, F.col("_said")), F.when(spoken, order)).alias("_end"))
    before = Window.partitionBy(*key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per.withColumn("_before", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    inside = Window.partitionBy(*key, "_span").orderBy(F.unix_micros(F.col(at).cast("timestamp")), "_rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_own", F.last("_said", ignorenulls=True).over(inside)).join(earlier, [*key, "_span"])
    return found.withColumn(name, F.coalesce("_own", "_before")).drop("_span", "_said", "_rank", "_own", "_before")


def looked_up(rows: DataFrame, told: DataFrame, on: Sequence[str]) -> DataFrame:
    """rows with the other columns of the row of `told` that is equal in `on`, or nulls: a left join with a table of one row for
    each `on`, made of a union and a window. Rows that already lie by a part of `on` stay where they are, and nothing is
    broadcast, however few rows Spark expects."""
    columns = [c for c in told.columns if c not in on]
    known = told.where(" and ".join(f"{c} is not null" for c in on)).select(*on, F.struct(*columns).alias("_told"))
    both = rows.withColumn("_asks", F.lit(True)).unionByName(known, allowMissingColumns=True)
    found = both.withColumn("_told", F.first("_told", ignorenulls=True).over(Window.partitionBy(*on))).where("_asks")
    return found.select(*rows.columns, *[F.col(f"_told.{c}").alias(c) for c in columns])


def greatest_before(rows: DataFrame, key: Sequence[str], at: str, value: Column, name: str, span: str = "DAY") -> DataFrame:
    """rows with `name`: the greatest value of the rows of its key that are earlier than it (rows of the same time aren't)."""
    rows = rows.withColumns({"_span": bucket_start(at, span), "_v": value})
    per = rows.groupBy(*key, "_span").agg(F.max("_v").alias("_end"))
    before = Window.partitionBy(*key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per.withColumn("_before", F.max("_end").over(before)).drop("_end")
    inside = Window.partitionBy(*key, "_span").orderBy(F.unix_micros(F.col(at).cast("timestamp"))).rangeBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("_own", F.max("_v").over(inside)).join(earlier, [*key, "_span"])
    return found.withColumn(name, F.greatest("_own", "_before")).drop("_span", "_v", "_own", "_before")


def islands(intervals: DataFrame, key: Sequence[str], start: str, end: str, kept: dict[str, Column], span: str = "DAY") -> DataFrame:
    """Overlapping or touching intervals of a key as one: key, start, end, n (how many it is made of), and the aggregates of
    `kept`. Intervals without length or with an open end are left out."""
    real = intervals.where(F.col(end) > F.col(start))
    reach = greatest_before(real, key, start, F.col(end), "_reach", span)
    begins = F.col("_reach").isNull() | (F.col("_reach") < F.col(start))
    placed = last_said(reach, key, start, F.when(begins, F.col(start)), "_island", span=span)
    out = placed.groupBy(*key, F.col("_island").alias(start)).agg(F.max(end).alias(end), F.count("*").alias("n"), *[c.alias(name) for name, c in kept.items()])
    return out
