"""Exact mergeable sets: a minute's identities coded by a dictionary, so that larger buckets are ORs of minutes.

Every identity of a space (prefixes, origins, peers, collectors) has a small number. A minute lists the numbers of its sets, in
blocks of 32,768; what unites minutes holds one bitmap for each block. Counters come from the same rows as the sets, so observations are read once; whatever is built on minutes, of
any length, never sees an observation again. Sets of segments and of minutes merge by OR, counters by sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import bucket_start
from tidemark.operators.measure import overlap
from tidemark.operators.routing import MINUTES, SETS, tagged

#: The space that each set's members are numbered in; announced and withdrawn prefixes share one, so that they unite.
SPACE = {"announced": "prefix", "withdrawn": "prefix", "origins": "origin", "peers": "peer", "rrcs": "rrc"}
COUNTERS = ("messages", "announcements", "withdrawals", "v4_events", "v6_events")
#: Parts of a space that are numbered apart from each other; numbers of part p are p + 1 and every SHARES-th after it.
SHARES = 256


def space_of(kind: Column) -> Column:
    return F.when(kind.isin("announced", "withdrawn"), "prefix").when(kind == "origins", "origin").when(kind == "peers", "peer").otherwise("rrc")


def set_rows(obs: DataFrame, at: str = "observed_at", keep: Sequence[str] = ()) -> DataFrame:
    """A row for each member of each set of a minute (and of `keep`): bucket_start, kind, member, n (how often it occurs). Each
    message has one collector, perhaps null, so that n of these rows counts messages."""
    as_text = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: x.cast("string"))
    own = {"announced": as_text("announced"), "withdrawn": as_text("withdrawn"), "origins": as_text("origins"), "peers": F.array(F.col("peer").cast("string")), "rrcs": F.array("rrc")}
    every = F.concat(*[tagged(k, v) for k, v in own.items()])
    rows = obs.select(*keep, bucket_start(at, "MINUTE").alias("bucket_start"), F.explode(every).alias("m")).select(*keep, "bucket_start", "m.*")
    return rows.where("member is not null or kind = 'rrcs'").groupBy(*keep, "bucket_start", "kind", "member").agg(F.count("*").alias("n"))


def share(space: Column | str, member: Column | str) -> Column:
    return F.pmod(F.xxhash64(space, member), F.lit(SHARES)).cast("int")


def number(place: Column) -> Column:
    """The number of the place-th member (from 1) of its share."""
    return (place - 1) * SHARES + F.col("_share") + 1


def dictionary(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """space, member, code of all members of set rows. Members of `known` keep their codes, others follow in their share, in the
    order of their text: a dictionary only ever grows. A share is numbered by one task, hence SHARES of them."""
    members = rows.where("member is not null").select(space_of(F.col("kind")).alias("space"), "member").distinct().withColumn("_share", share("space", "member"))
    w = Window.partitionBy("space", "_share").orderBy("member")
    if known is None:
        return members.select("space", "member", number(F.row_number().over(w)).cast("long").alias("code"))
    ahead = known.groupBy("space", F.pmod(F.col("code") - 1, F.lit(SHARES)).cast("int").alias("_share")).agg(F.count("*").alias("_had"))
    fresh = members.join(known.select("space", "member"), ["space", "member"], "left_anti").join(ahead, ["space", "_share"], "left")
    place = F.row_number().over(w) + F.coalesce("_had", F.lit(0))
    return known.select("space", "member", "code").unionByName(fresh.select("space", "member", number(place).cast("long").alias("code")))


def minute_rows(obs: DataFrame, at: str = "observed_at", known: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per minute (and `keep`) with COUNTERS, n_prefixes and `sets`, an array of (kind, block, places, bits): here every
    block of a set lists its members' places, and bits are null. So a minute's row is as large as its identities.

    With a dictionary (`known`, of all members) rows of different calls merge; without one numbers hold for this frame alone,
    and come from a rank in the same pass.
    """
    rows = set_rows(obs, at, keep).withColumn("space", space_of(F.col("kind")))
    if known is None:
        rows = rows.withColumn("_share", share("space", "member"))
        rows = rows.withColumn("code", number(F.dense_rank().over(Window.partitionBy("space", "_share").orderBy("member"))).cast("long"))
        rows = rows.withColumn("code", F.when(F.col("member").isNotNull(), F.col("code")))
    else:
        rows = rows.join(known, ["space", "member"], "left")
    key = [*keep, "bucket_start"]
    v6 = F.when(F.instr("member", ":") > 0, F.col("n")).otherwise(0)
    # Members travel as numbers to where the minute's rows are together.
    rows = rows.select(*key, "kind", F.coalesce(F.bitmap_bucket_number("code"), F.lit(0)).alias("block"), F.bitmap_bit_position("code").cast("int").alias("place"), "n", v6.alias("v6")).repartition(*key)
    blocks = rows.groupBy(*key, "kind", "block").agg(F.array_sort(F.collect_list("place")).alias("places"), F.sum("n").alias("n"), F.sum("v6").alias("v6")).withColumn("bits", F.lit(None).cast("binary"))
    of = lambda k, c="n": F.coalesce(F.sum(F.when(F.col("kind") == k, F.col(c))), F.lit(0))
    events = of("announced") + of("withdrawn")
    six = of("announced", "v6") + of("withdrawn", "v6")
    counters = [of("rrcs").alias("messages"), of("announced").alias("announcements"), of("withdrawn").alias("withdrawals"), (events - six).alias("v4_events"), six.alias("v6_events")]
    prefixes = F.flatten(F.transform(F.filter("sets", lambda s: s["kind"].isin("announced", "withdrawn")), lambda s: F.transform(s["places"], lambda p: s["block"] * 32768 + p)))
    return blocks.groupBy(*key).agg(*counters, collected()).withColumn("n_prefixes", F.size(F.array_distinct(prefixes)).cast("long"))


def collected() -> Column:
    """The sets of rows (kind, block, places, bits), in order; places or bits are null."""
    one = F.struct("kind", "block", "places", "bits")
    return F.array_sort(F.collect_list(F.when(F.col("block") > 0, one)), lambda x, y: F.when(F.struct(x["kind"], x["block"]) < F.struct(y["kind"], y["block"]), -1).otherwise(1)).alias("sets")


def ored(rows: DataFrame, key: Sequence[str], sums: dict[str, Column], spans: Sequence[str] = ()) -> DataFrame:
    """rows (key, sets) as one bitmap for each key, kind and block: OR of all their places and bits. sums are added once for each
    row (in one of its blocks); of spans, columns, the block's least (low_) and greatest (high_) values are kept. One shuffle
    brings a key's rows together, small as they are; all that follows, here and by key later on, needs no other."""
    spread = rows.repartition(*key).select("*", F.posexplode_outer("sets").alias("_at", "s")).drop("sets")
    first = F.coalesce(F.col("_at"), F.lit(0)) == 0
    bare = F.struct(F.lit(None).cast("long").alias("place"), F.col("s.bits").alias("bits"))
    parts = F.concat(F.array(bare), F.transform(F.coalesce("s.places", F.array().cast("array<int>")), lambda p: F.struct(p.cast("long").alias("place"), F.lit(None).cast("binary").alias("bits"))))
    items = spread.select("*", F.posexplode(parts).alias("_nth", "p"))
    once = lambda c: F.sum(F.when(first & (F.col("_nth") == 0), c).otherwise(0))
    ends = [f(c).alias(f"{name}_{c}") for c in spans for name, f in (("low", F.min), ("high", F.max))]
    both = items.groupBy(*key, F.col("s.kind").alias("kind"), F.col("s.block").alias("block")).agg(
        F.bitmap_construct_agg("p.place").alias("a"), F.bitmap_or_agg("p.bits").alias("b"), *[once(c).alias(k) for k, c in sums.items()], *ends
    )
    twice = both.withColumn("x", F.explode(F.array("a", "b")))
    return twice.groupBy(*key, "kind", "block").agg(F.bitmap_or_agg("x").alias("bits"), *[F.max(k).alias(k) for k in (*sums, *low_and_high(spans))])


def low_and_high(spans: Sequence[str]) -> list[str]:
    return [f"{name}_{c}" for c in spans for name in ("low", "high")]


def merge(parts: DataFrame, key: Sequence[str] = ("bucket_start",)) -> DataFrame:
    """Parts of minutes (of segments, say) with codes of one dictionary as whole ones: counters summed, sets united (as bitmaps);
    `segments` counts the parts."""
    blocks = ored(parts.select(*key, *COUNTERS, "sets"), key, {"segments": F.lit(1), **{c: F.col(c) for c in COUNTERS}})
    return blocks.withColumn("places", F.lit(None).cast("array<int>")).groupBy(*key).agg(*[F.sum(c).alias(c) for c in (*COUNTERS, "segments")], collected())


def covered(minutes: DataFrame, sessions: DataFrame) -> DataFrame:
    """Minutes with coverage, availability and profile. minutes carry `rejected` and `data_profile`, both null where there is no
    message; sessions: start, end, profile, degraded. Rules are those of `minute_coverage`, here on the rows themselves, which
    therefore are made once."""
    clipped = overlap(sessions, [], "start", "end", "MINUTE")
    w = Window.partitionBy("bucket_start").orderBy("clip_start", "clip_end").rowsBetween(Window.unboundedPreceding, -1)
    swept = clipped.withColumn("_pm", F.coalesce(F.max("clip_end").over(w), F.col("bucket_start")))
    per = swept.groupBy("bucket_start").agg(
        (F.bool_or(F.col("clip_start") > F.col("_pm")) | (F.unix_timestamp(F.max("clip_end")) < F.unix_timestamp("bucket_start") + 60)).alias("_gap"),
        F.bool_or("degraded").alias("_bad"),
        F.min("profile").alias("_p"),
        ((F.min("profile") == F.max("profile")) & (F.count("profile") == F.count("*"))).alias("_one"),
    )
    joined = minutes.join(per, "bucket_start", "left")
    seen, watched = F.col("rejected").isNotNull(), F.col("_gap").isNotNull()
    one = F.when(watched & seen, F.col("_one") & (F.col("_p") == F.col("data_profile"))).when(watched, F.col("_one")).when(seen, F.col("data_profile").isNotNull()).otherwise(F.lit(False))
    one = F.coalesce(one, F.lit(False))
    coverage = (
        F.when((F.coalesce("rejected", F.lit(0)) > 0) | F.coalesce("_bad", F.lit(False)), "DEGRADED")
        .when(watched & ~F.coalesce("_gap", F.lit(True)) & one, "COMPLETE")
        .when(watched | seen, "PARTIAL")
        .otherwise("NO_COVERAGE")
    )
    out = joined.withColumn("coverage", coverage).withColumn("profile", F.when(one, F.coalesce("_p", "data_profile")))
    available = F.when(F.col("coverage") == "COMPLETE", "AVAILABLE").when(F.col("coverage") == "NO_COVERAGE", "UNAVAILABLE").otherwise("PARTIAL")
    return out.withColumn("availability", available).drop("_gap", "_bad", "_p", "_one", "rejected", "data_profile")


def sized(rows: DataFrame, key: Sequence[str], sums: dict[str, Column], spans: Sequence[str] = ()) -> DataFrame:
    """rows (key, sets, and what sums are made of) as one row a key: n_prefixes, the size of each united set, sums added once
    for each row, and the low_ and high_ of spans."""
    blocks = ored(rows, key, sums, spans)
    carried = [F.sum(c).alias(c) for c in sums] + [(F.min if c.startswith("low_") else F.max)(c).alias(c) for c in low_and_high(spans)]
    # Prefixes that are announced and withdrawn count once: their bitmaps meet in one row by space.
    spaces = blocks.groupBy(*key, space_of(F.col("kind")).alias("space"), "block").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("_all"), *[F.sum(F.when(F.col("kind") == k, F.bitmap_count("bits")).otherwise(0)).alias(f"n_{k}") for k in SETS], *carried
    )
    prefixes = F.coalesce(F.sum(F.when((F.col("space") == "prefix") & F.col("block").isNotNull(), F.col("_all"))), F.lit(0))
    return spaces.groupBy(*key).agg(prefixes.alias("n_prefixes"), *[F.sum(f"n_{k}").alias(f"n_{k}") for k in SETS], *carried)


def rollup(minutes: DataFrame, granularity: str) -> DataFrame:
    """Larger buckets from covered minutes (with COUNTERS and sets): complete only if every minute is there, complete, and of one
    profile; else the values are NULL. Columns: bucket, rows, satisfied, partial, degraded, coverage, availability, complete,
    expected, missing, COUNTERS, n_prefixes, and the size of each set. The shuffle by bucket serves every step."""
    good = (F.col("coverage") == "COMPLETE") & (F.col("availability") == "AVAILABLE")
    rows = minutes.select(bucket_start("bucket_start", granularity).alias("bucket"), "coverage", good.alias("_good"), "profile", *COUNTERS, "sets")
    tallies = {"rows": F.lit(1), "satisfied": F.col("_good").cast("int"), "partial": (F.col("coverage") == "PARTIAL").cast("int"), "degraded": (F.col("coverage") == "DEGRADED").cast("int"), "_profiles": F.col("profile").isNotNull().cast("int")}
    per = sized(rows, ["bucket"], tallies | {c: F.coalesce(c, F.lit(0)) for c in COUNTERS}, ["profile"])
    whole = lambda c: F.col(c) == F.col("rows")
    complete = (F.col("rows") == MINUTES[granularity]) & whole("satisfied") & whole("_profiles") & (F.col("low_profile") == F.col("high_profile"))
    out = per.withColumn("complete", F.coalesce(complete, F.lit(False)))
    out = out.withColumn("coverage", F.when(F.col("complete"), "COMPLETE").when(F.col("degraded") > 0, "DEGRADED").otherwise("PARTIAL"))
    out = out.withColumns({c: F.when(F.col("complete"), F.col(c)) for c in (*COUNTERS, "n_prefixes", *[f"n_{k}" for k in SETS])})
    return out.withColumns({"availability": F.when(F.col("complete"), "AVAILABLE").otherwise("PARTIAL"), "expected": F.lit(MINUTES[granularity]), "missing": F.lit(MINUTES[granularity]) - F.col("rows")}).drop("_profiles", "low_profile", "high_profile")


def set_sizes(minutes: DataFrame) -> DataFrame:
    """Minutes with the size of each set instead of its members, row by row and without a shuffle."""
    of = lambda k: F.filter("sets", lambda s: s["kind"] == k)
    total = lambda sets: F.aggregate(sets, F.lit(0).cast("long"), lambda n, s: n + F.coalesce(F.size(s["places"]).cast("long"), F.bitmap_count(s["bits"])))
    return minutes.withColumns({f"n_{k}": total(of(k)) for k in SETS}).drop("sets")
