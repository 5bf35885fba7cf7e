from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import routing_sets as RS
from tidemark.operators.routing import minute_coverage

OBS = "observed_at timestamp, rrc string, peer long, announced array<string>, withdrawn array<string>, origins array<long>, segment int"
START = 1704067200


@pytest.fixture(scope="module")
def obs(spark):
    r = np.random.default_rng(3)
    net = lambda: f"10.{r.integers(0, 6)}.{r.integers(0, 90)}.0/24" if r.random() < 0.8 else f"2001:db8:{r.integers(0, 50):x}::/48"
    rows = [
        (START + float(r.integers(0, 3 * 3600)), None if i % 50 == 0 else f"rrc{i % 3:02d}", None if i % 40 == 0 else int(r.integers(0, 30)), [net() for _ in range(r.integers(0, 4))] if i % 9 else None, [net() for _ in range(r.integers(0, 3))], [int(x) for x in r.integers(64500, 64510, r.integers(0, 3))] if i % 7 else None, i % 4)
        for i in range(900)
    ]
    # One minute that is far fuller than a listed block.
    rows += [(START + 30.0, "rrc00", 1, [f"172.{i % 200}.{i % 256}.0/24" for i in range(k, k + 400)], [], [64500], k % 4) for k in range(0, 1200, 400)]
    return spark.createDataFrame(rows, OBS.replace("observed_at timestamp", "t double")).select(F.timestamp_seconds("t").alias("observed_at"), "*").drop("t")


def brute(rows, size):
    out = defaultdict(lambda: [0, 0, 0, 0, 0, set(), set(), set(), set(), set()])
    for r in rows:
        b = out[int(r.observed_at.timestamp()) // size * size]
        ann, wd = r.announced or [], r.withdrawn or []
        b[0] += 1
        b[1] += len(ann)
        b[2] += len(wd)
        b[4] += sum(":" in p for p in [*ann, *wd])
        b[3] += sum(":" not in p for p in [*ann, *wd])
        for s, x in zip(b[5:], (ann, wd, r.origins or [], [r.peer] if r.peer is not None else [], [r.rrc] if r.rrc else [])):
            s.update(x)
    return {k: (*v[:5], len(v[5] | v[6]), *map(len, v[5:])) for k, v in out.items()}


SIZES = ["n_announced", "n_withdrawn", "n_origins", "n_peers", "n_rrcs"]


def told(df, at, prefixes=True):
    return {int(r[at].timestamp()): tuple(r[c] for c in (*RS.COUNTERS, *(["n_prefixes"] if prefixes else []), *SIZES)) for r in df.collect()}


def without_prefixes(want):
    return {k: (*v[:5], *v[6:]) for k, v in want.items()}


def test_minutes_are_brute_force(obs):
    assert told(RS.set_sizes(RS.minute_rows(obs)), "bucket_start") == brute(obs.collect(), 60)


def test_places_and_bitmaps_unite(obs):
    """Merged minutes (bitmaps) and minutes of other segments (places) make the hour together."""
    codes = RS.dictionary(RS.set_rows(obs))
    part = lambda cond: RS.minute_rows(obs.where(cond), known=codes).select("bucket_start", *RS.COUNTERS, "sets")
    mixed = RS.merge(part("segment < 2")).drop("segments").unionByName(part("segment >= 2"))
    hours = RS.sized(mixed.withColumn("bucket", F.date_trunc("hour", "bucket_start")), ["bucket"], {c: F.col(c) for c in RS.COUNTERS})
    assert told(hours, "bucket") == brute(obs.collect(), 3600)


def test_segments_merge_to_their_minutes(obs):
    codes = RS.dictionary(RS.set_rows(obs))
    parts = RS.minute_rows(obs, known=codes, keep=["segment"])
    assert told(RS.set_sizes(RS.merge(parts)), "bucket_start", False) == without_prefixes(brute(obs.collect(), 60))


def test_a_dictionary_grows_and_keeps_its_codes(obs):
    first = RS.dictionary(RS.set_rows(obs.where("segment < 2")))
    grown = RS.dictionary(RS.set_rows(obs), first)
    a, b = ({(r.space, r.member): r.code for r in df.collect()} for df in (first, grown))
    assert all(b[k] == c for k, c in a.items()) and len(b) > len(a)
    by = defaultdict(list)
    for (space, _), c in b.items():
        by[space].append(c)
    assert all(len(set(c)) == len(c) and min(c) >= 1 for c in by.values())
    whole = RS.minute_rows(obs, known=grown)
    assert told(RS.set_sizes(whole), "bucket_start", False) == without_prefixes(brute(obs.collect(), 60))


def covered(spark, obs, profile="p"):
    spine = spark.range(START, START + 3 * 3600, 60).select(F.timestamp_seconds("id").alias("bucket_start"))
    rows = RS.minute_rows(obs).withColumns({"rejected": F.lit(0), "data_profile": F.lit(profile)})
    sessions = spark.sql(f"select timestamp_seconds({START}) as start, timestamp_seconds({START + 2 * 3600}) as end, 'p' as profile, false as degraded")
    return RS.covered(spine.join(rows, "bucket_start", "left").fillna(0, list(RS.COUNTERS)), sessions)


@pytest.mark.parametrize("granularity, size", [("FIVE_MINUTES", 300), ("HOUR", 3600)])
def test_rollups_are_ors_of_minutes(spark, obs, granularity, size):
    out = RS.rollup(covered(spark, obs), granularity)
    want = brute(obs.collect(), size)
    rows = {int(r.bucket.timestamp()): r for r in out.collect()}
    assert len(rows) == 3 * 3600 // size
    for b, r in rows.items():
        got = tuple(r[c] for c in (*RS.COUNTERS, "n_prefixes", *SIZES))
        if b < START + 2 * 3600:
            assert r.complete and r.coverage == "COMPLETE" and r.satisfied == r.expected == size // 60
            assert got == want.get(b, (0,) * 11)
        else:
            assert not r.complete and set(got) == {None}


def test_a_whole_day_and_mixed_profiles(spark):
    """1,440 compatible minutes make a complete day of exact unions; a missing minute or a second profile doesn't."""
    minute = spark.range(1440).select(
        F.timestamp_seconds(F.lit(START) + F.col("id") * 60 + 1).alias("observed_at"), F.lit("rrc00").alias("rrc"), F.lit(1).cast("long").alias("peer"),
        F.array(F.lit("192.0.2.0/24"), F.concat(F.lit("198.51."), F.col("id") % 10, F.lit(".0/24"))).alias("announced"), F.array(F.lit("2001:db8::/32")).alias("withdrawn"), F.array(F.lit(64500), 64501 + F.col("id") % 5).alias("origins"),
    )
    rows = RS.minute_rows(minute).withColumns({"coverage": F.lit("COMPLETE"), "availability": F.lit("AVAILABLE"), "profile": F.lit("p")})
    r = RS.rollup(rows, "DAY").first()
    assert (r.complete, r.messages, r.announcements, r.withdrawals, r.n_prefixes, r.n_announced, r.n_withdrawn, r.n_origins, r.v6_events) == (True, 1440, 2880, 1440, 12, 11, 1, 6, 1440)
    early = F.timestamp_seconds(F.lit(START + 60))
    for other in (rows.where(F.col("bucket_start") >= early), rows.withColumn("profile", F.when(F.col("bucket_start") < early, "q").otherwise("p")), rows.withColumn("profile", F.when(F.col("bucket_start") >= early, "p"))):
        r = RS.rollup(other, "DAY").first()
        assert (r.complete, r.coverage, r.availability, r.messages, r.n_prefixes) == (False, "PARTIAL", "PARTIAL", None, None)


def test_coverage_is_that_of_the_separate_tables(spark, obs):
    """Gaps inside a minute, several sessions, other profiles and rejects, held against minute_coverage."""
    at = lambda s: f"timestamp_seconds({START + s})"
    sessions = spark.sql(" union all ".join(f"select {at(a)} as start, {at(b)} as end, {p} as profile, {d} as degraded" for a, b, p, d in [(0, 90, "'p'", "false"), (90, 200, "'p'", "false"), (230, 300, "'p'", "false"), (300, 420, "'q'", "false"), (380, 480, "'p'", "false"), (480, 600, "'p'", "true"), (600, 720, "null", "false"), (720, 900, "'q'", "false")]))
    spine = spark.range(START, START + 1200, 60).select(F.timestamp_seconds("id").alias("bucket_start"))
    data = spark.range(START, START + 1020, 120).select(F.timestamp_seconds("id").alias("bucket_start"), F.when(F.col("id") == START + 240, 2).otherwise(0).alias("rejected"), F.when(F.col("id") % 360 != 0, "p").alias("profile"))
    want = {r.bucket_start: (r.coverage, r.availability) for r in minute_coverage(spine, sessions, data).collect()}
    got = {r.bucket_start: (r.coverage, r.availability) for r in RS.covered(spine.join(data.withColumnRenamed("profile", "data_profile"), "bucket_start", "left"), sessions).collect()}
    assert got == want and len(set(want.values())) == 4


def test_observations_are_scanned_once(spark):
    from tidemark.plans.registry import QUERIES

    plan = QUERIES["routing_hour_rollup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_nothing_gives_nothing(obs):
    none = obs.limit(0)
    assert RS.minute_rows(none).count() == 0 and RS.dictionary(RS.set_rows(none)).count() == 0 and RS.merge(RS.minute_rows(none)).count() == 0
