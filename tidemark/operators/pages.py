"""Keyset pages, newest first, for each of many keys at once: an opaque cursor of the whole order, applied as a seek.

A cursor holds every value of the order, so no two rows share one and the next page begins right behind the last; pages of many
keys are cut in one pass, each key at its own cursor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = "_whole"


def values(rows: DataFrame, order: Sequence[str]) -> tuple[Column, T.StructType]:
    """The order's values as a struct whose JSON text loses nothing: times as microseconds, dates as days. Nulls are least."""
    made, fields = [], []
    for i, c in enumerate(order):
        kind = rows.schema[c].dataType
        value, kind = (F.unix_micros(c), T.LongType()) if isinstance(kind, T.TimestampType) else (F.unix_date(c), T.IntegerType()) if isinstance(kind, T.DateType) else (F.col(c), kind)
        made.append(value.alias(f"v{i}"))
        fields.append(T.StructField(f"v{i}", kind))
    return F.struct(*made), T.StructType(fields)


def page(rows: DataFrame, key: Sequence[str], order: Sequence[str], n: int, cursors: DataFrame | None = None) -> DataFrame:
    """The next n rows of every key by `order`, descending, with position (from 1) and next_cursor, which the last row of a page
    carries if more follow. order has to tell the rows of a key apart; rows that are equal in it come in one page or the other.

    cursors (key, cursor): pages begin behind the cursor of their key; keys without a row in it, or with a null, have no
    further page. Without cursors all keys begin at their first row. A text that is no cursor of this order is an error. With no
    key the whole table is one list. Only n + 1 rows a key leave each task.
    """
    own = list(key)
    if not own:
        rows, own = rows.withColumn(WHOLE, F.lit(0)), [WHOLE]
        cursors = cursors.withColumn(WHOLE, F.lit(0)) if cursors is not None else None
    at, schema = values(rows, order)
    if cursors is not None:
        read = F.from_json(F.unbase64("cursor").cast("string"), schema, {"mode": "FAILFAST"})
        seeks = cursors.where("cursor is not null").select(*own, read.alias("_after"))
        rows = rows.join(seeks, own).where(at < F.col("_after")).drop("_after")
    newest = Window.partitionBy(*own).orderBy(*[F.desc(c) for c in order])
    ranked = rows.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= n + 1)
    # More follow if the row behind the page's last one is there; it is among the few rows that are left.
    last = F.max("position").over(Window.partitionBy(*own))
    cursor = F.base64(F.to_json(at))
    out = ranked.withColumn("next_cursor", F.when((F.col("position") == n) & (last > n), cursor)).where(F.col("position") <= n)
    return out.drop(WHOLE)


def cursors_of(pages: DataFrame, key: Sequence[str]) -> DataFrame:
    """The cursors of the keys that have a further page."""
    return pages.where("next_cursor is not null").select(*key, F.col("next_cursor").alias("cursor"))


def nearest(rows: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """All rows of each key that hold one of its first n values of `order`, descending: what n rows of pages are found among.

    Rows are dealt evenly first, whatever their key, and each share keeps only such rows before they meet by key: a key that
    most of the rows have fills no task. Equal rows all stay.
    """
    rank = F.dense_rank().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order]))
    return rows.repartition(*rows.columns).withColumn("_near", rank).where(F.col("_near") <= n).drop("_near")


def walk(rows: DataFrame, key: Sequence[str], order: Sequence[str], n: int, pages: int) -> DataFrame:
    """The first `pages` pages of every key, each sought from the cursor before it, with their number (from 1). A page uses up n
    values of the order at most, so they are sought among the nearest rows, which is a small part of a busy key."""
    return sought(nearest(rows, key, order, n * pages + 1), key, order, n, pages)


def sought(rows: DataFrame, key: Sequence[str], order: Sequence[str], n: int, pages: int) -> DataFrame:
    """`walk` among rows of which none is too far off."""
    whole = now = page(rows, key, order, n).withColumn("page", F.lit(1))
    for number in range(2, pages + 1):
        now = page(rows, key, order, n, cursors_of(now, key)).withColumn("page", F.lit(number))
        whole = whole.unionByName(now)
    return whole


def numbered(rows: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """All rows with the page that each is on, and its position there, as a reader finds them that walks to the end."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])) - 1
    return rows.withColumn("_place", place).withColumns({"page": (F.floor(F.col("_place") / n) + 1).cast("int"), "position": (F.col("_place") % n + 1).cast("int")}).drop("_place")
