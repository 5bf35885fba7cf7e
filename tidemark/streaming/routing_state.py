"""Routing minutes and hours from one stateful stream: minutes close by timers, late rows revise them, hours follow.

State is kept for each collector (source and rrc), so collectors run side by side and an idle one still closes its minutes: its
timers fire as the stream's event time passes. A minute closes `lateness_s` after its end, with zeros if nothing came. A row
that comes later still gives the minute, and its hour if that has closed, a new revision at once. Minutes that are older than
`keep_s` leave the state; rows for them are dropped by the watermark. Rows of collectors merge by sums and unions.

`closed` is the batch twin: what the newest revisions of the stream say, from kept observations.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.scalars import GRANULARITY
from tidemark.operators import routing_sets as RS
from tidemark.operators.routing import LATENESS_S

#: The class of a state store that timers and map states need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY = ("source", "rrc")
COUNTS = (*RS.COUNTERS, "rejected")
MEMBERS = ("announced", "withdrawn", "origins", "peers")
SIZES = ("n_prefixes", *(f"n_{m}" for m in MEMBERS))
STRING, LONG = T.StringType(), T.LongType()
OUTPUT = T.StructType(
    [T.StructField(k, STRING) for k in (*KEY, "granularity")]
    + [T.StructField(k, LONG) for k in ("second", "revision", "minutes")]
    + [T.StructField("complete", T.BooleanType())]
    + [T.StructField(c, LONG) for c in (*COUNTS, *SIZES)]
    + [T.StructField(m, T.ArrayType(STRING)) for m in MEMBERS]
)


def keyed(messages: DataFrame, source: Column, received: str | None = None) -> DataFrame:
    """Parsed messages, good and rejected ones, in the form that the state takes. A rejected line counts in the minute of its own
    time, else in that of its receipt; one of unknown time can't be placed and is left to the rejects' own table."""
    at = F.coalesce("observed_at", received) if received else F.col("observed_at")
    none = F.array().cast("array<string>")
    bad = F.coalesce("rejected", F.lit(False)) if "rejected" in messages.columns else F.lit(False)
    members = [F.when(bad, none).otherwise(F.coalesce(F.col(c).cast("array<string>"), none)).alias(c) for c in ("announced", "withdrawn", "origins")]
    own = messages.where(at.isNotNull())
    return own.select(source.cast("string").alias("source"), F.coalesce("rrc", F.lit("")).alias("rrc"), at.alias("at"), F.unix_timestamp(at).alias("second"), bad.alias("rejected"), *members, F.when(~bad, F.col("peer").cast("string")).alias("peer"))


class Minute:
    """Counters and members of one minute, as the state keeps them."""

    def __init__(self, told: str | None = None) -> None:
        x = json.loads(told) if told else {"n": [0] * len(COUNTS), "m": [[]] * len(MEMBERS), "r": 0}
        self.counts, self.members, self.revision = list(x["n"]), [set(m) for m in x["m"]], x["r"]

    def told(self) -> str:
        return json.dumps({"n": self.counts, "m": [sorted(m) for m in self.members], "r": self.revision})

    def add(self, rejected: bool, announced: Sequence[str], withdrawn: Sequence[str], origins: Sequence[str], peer: str | None) -> None:
        if rejected:
            self.counts[5] += 1
            return
        six = sum(":" in p for p in announced) + sum(":" in p for p in withdrawn)
        for i, n in enumerate((1, len(announced), len(withdrawn), len(announced) + len(withdrawn) - six, six)):
            self.counts[i] += n
        for own, new in zip(self.members, (announced, withdrawn, origins, [peer] if peer is not None else [])):
            own.update(new)

    def join(self, other: Minute) -> None:
        self.counts = [a + b for a, b in zip(self.counts, other.counts)]
        for own, new in zip(self.members, other.members):
            own |= new


class RoutingProcessor(StatefulProcessor):
    """Minutes of one collector. State: minutes by their second, revisions of hours, and the first minute that is still open with
    the first one that there was."""

    def __init__(self, lateness_s: int, keep_s: int) -> None:
        self.lateness_s, self.keep_s = lateness_s, keep_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "second long", "told string")
        self.hours = handle.getMapState("hours", "second long", "revision long")
        self.open = handle.getValueState("open", "second long, first long")

    def close(self) -> None:
        pass

    def due(self, second: int) -> int:
        """When the minute may close, in milliseconds of the watermark, which runs keep_s behind the stream's time."""
        return (second + 60 + self.lateness_s - self.keep_s) * 1000

    def at(self, second: int) -> Minute:
        return Minute(self.minutes.getValue((second,))[0]) if self.minutes.containsKey((second,)) else Minute()

    def revised(self, key: Any, second: int, minute: Minute) -> tuple:
        minute.revision += 1
        self.minutes.updateValue((second,), (minute.told(),))
        return self.row(key, "MINUTE", second, minute.revision, 1, minute, [sorted(m) for m in minute.members])

    def row(self, key: Any, granularity: str, second: int, revision: int, n: int, x: Minute, members: list) -> tuple:
        whole = n == GRANULARITY[granularity] // 60 and not x.counts[5]
        return (*key, granularity, second, revision, n, whole, *x.counts, len(x.members[0] | x.members[1]), *map(len, x.members), *members)

    def hour(self, key: Any, second: int) -> tuple:
        """The hour's next revision, from the minutes that it has."""
        _, first = self.open.get()
        revision = (self.hours.getValue((second,))[0] if self.hours.containsKey((second,)) else 0) + 1
        self.hours.updateValue((second,), (revision,))
        whole, minutes = Minute(), range(max(second, first), second + 3600, 60)
        for m in minutes:
            whole.join(self.at(m))
        return self.row(key, "HOUR", second, revision, len(minutes), whole, [None] * len(MEMBERS))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new: dict[int, Minute] = {}
        for part in rows:
            for second, *x in zip(*(part[c].tolist() for c in ("second", "rejected", "announced", "withdrawn", "origins", "peer"))):
                new.setdefault(second // 60 * 60, Minute()).add(*x)
        least = min(new)
        if not self.open.exists():
            begin = first = least
            self.handle.registerTimer(self.due(begin))
        else:
            begin, first = self.open.get()
        if least < first and begin > first:  # closed minutes get a predecessor: what lies between had nothing
            new |= {m: Minute() for m in range(least, first, 60) if m not in new}
        elif least < first:
            self.handle.deleteTimer(self.due(begin))
            begin = least
            self.handle.registerTimer(self.due(begin))
        first = min(first, least)
        self.open.update((begin, first))
        out, hours = [], set()
        for second, more in sorted(new.items()):
            minute = self.at(second)
            minute.join(more)
            if second < begin:
                out.append(self.revised(key, second, minute))
                hours |= {h for h in (second // 3600 * 3600,) if h + 3600 <= begin}
            else:
                self.minutes.updateValue((second,), (minute.told(),))
        out += [self.hour(key, h) for h in sorted(hours)]
        if out:
            yield pd.DataFrame(out, columns=OUTPUT.names)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        begin, first = self.open.get()
        watermark, out = timerValues.getCurrentWatermarkInMs(), []
        while self.due(begin) <= watermark:
            out.append(self.revised(key, begin, self.at(begin)))
            begin += 60
            if begin % 3600 == 0:
                out.append(self.hour(key, begin - 3600))
        self.open.update((begin, first))
        self.handle.registerTimer(self.due(begin))
        # Hours that no row can reach any more leave the state, once they have closed.
        gone = min(watermark // 1000, begin) // 3600 * 3600
        for state in (self.minutes, self.hours):
            for old in [k for k in state.keys() if k[0] < gone]:
                state.removeKey(old)
        if out:
            yield pd.DataFrame(out, columns=OUTPUT.names)


def closing_stream(rows: DataFrame, lateness_s: int = LATENESS_S, keep_s: int = 86_400) -> DataFrame:
    """Minutes and hours of a stream of `keyed` rows, in revisions. The session's state store must be ROCKSDB."""
    own = rows.withWatermark("at", f"{keep_s} seconds").groupBy(*KEY)
    out = own.transformWithStateInPandas(RoutingProcessor(lateness_s, keep_s), OUTPUT, "Append", "EventTime")
    return out.withColumn("bucket_start", F.timestamp_seconds("second")).drop("second")


def newest(told: DataFrame, granularity: str) -> DataFrame:
    """The last revision of every bucket that a stream has written."""
    own = told.where(F.col("granularity") == granularity)
    last = F.row_number().over(Window.partitionBy(*KEY, "bucket_start").orderBy(F.desc("revision")))
    return own.withColumn("_r", last).where("_r = 1").drop("_r")


def closed(rows: DataFrame, granularity: str, now: Column, lateness_s: int = LATENESS_S) -> DataFrame:
    """Batch twin of `newest`: every MINUTE or HOUR of each collector that has closed at `now`, from the collector's first minute
    on, zeros included, with what all `keyed` rows say, late ones too."""
    size, key = F.lit(GRANULARITY[granularity]).cast("long"), [*KEY, "second"]
    floor = lambda c, to: F.col(c) - F.pmod(F.col(c), to)
    minutes = RS.minute_rows(rows.where("not rejected"), "at", keep=KEY).withColumn("second", F.unix_timestamp("bucket_start"))
    sums = RS.set_sizes(minutes) if granularity == "MINUTE" else RS.sized(minutes.withColumn("second", floor("second", size)), key, {c: F.col(c) for c in RS.COUNTERS})
    bad = rows.groupBy(*KEY, floor("second", size).alias("second")).agg(F.count_if("rejected").alias("rejected"))
    # The minutes that may close end at `_end`.
    spans = rows.groupBy(*KEY).agg(F.min(floor("second", F.lit(60))).alias("_first")).withColumn("_end", F.unix_timestamp(now) - lateness_s).withColumn("_end", floor("_end", F.lit(60)))
    starts = F.sequence(floor("_first", size), F.col("_end") - size, size)
    spine = spans.where(F.col("_end") - size >= floor("_first", size)).select("*", F.explode(starts).alias("second"))
    n = ((F.col("second") + size - F.greatest("second", "_first")) / 60).cast("long")
    out = spine.join(bad, key, "left").join(sums, key, "left").fillna(0, [*COUNTS, *SIZES])
    return out.select(*KEY, F.timestamp_seconds("second").alias("bucket_start"), n.alias("minutes"), ((n == (size / 60).cast("long")) & (F.col("rejected") == 0)).alias("complete"), *COUNTS, *SIZES)
