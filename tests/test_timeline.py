import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import coverage as C
from tidemark.operators.timeline import last_said

T0 = 1704067200
SCHEDULES = "k string, effective_from double, effective_to double, enabled boolean, interval_s int, grace_s long, origin string, anchor_at double"


def stamps(df, *columns):
    return df.withColumns({c: F.timestamp_seconds(c) for c in columns})


def test_last_said_is_brute_force(spark):
    r = random.Random(1)
    rows = [(r.choice("abc"), T0 + r.randint(0, 4 * 86400) / r.choice([1, 2]), r.randint(0, 2), r.randint(0, 99) if r.random() < 0.4 else None, i) for i in range(500)]
    rows = [*{(k, t, p): (k, t, p, v, i) for k, t, p, v, i in rows}.values()]
    df = stamps(spark.createDataFrame(rows, "k string, t double, p int, v int, i int"), "t")
    got = {x.i: x.said for x in last_said(df, ["k"], "t", F.col("v"), "said", F.col("p")).collect()}
    for k, t, p, _, i in rows:
        heard = [(t2, p2, v2) for k2, t2, p2, v2, _ in rows if k2 == k and (t2, p2) <= (t, p) and v2 is not None]
        assert got[i] == (max(heard)[2] if heard else None)


def brute_expected(schedules, runs, start, end, now):
    """One schedule row after the other, with all its anchors in a list."""
    out = set()
    for k, a, b, on, step, grace, origin, first in schedules:
        if not on or step is None or origin == "UNKNOWN" or max(a, start) >= min(b or 1e12, end):
            continue
        lo, hi = max(a, start), min(b or 1e12, end)
        ran = sorted({t for k2, t, trigger in runs if k2 == k and trigger in ("SCHEDULED", "BOOTSTRAP") and a <= t < (b or 1e12)})
        anchors = sorted({first if first is not None else a, *ran})
        for i, anchor in enumerate(anchors):
            after = anchors[i + 1] if i + 1 < len(anchors) else None
            t = anchor + max(0, -(-(lo - anchor) // step)) * step
            while t < min(hi, after if after is not None else hi):
                if t + grace <= now and not (after is not None and abs(after - t) <= grace):
                    out.add((k, a, t))
                t += step
        out |= {(k, a, t) for t in ran if lo <= t < hi and t + grace <= now}
    return out


@pytest.mark.parametrize("seed", range(4))
def test_expected_times_are_brute_force(spark, seed):
    r = random.Random(seed)
    schedules, runs = [], []
    for k in map(str, range(25)):
        starts = sorted(r.sample(range(0, 3 * 86400, 900), r.randint(1, 4)))
        for a, b in zip(starts, [*starts[1:], r.choice([None, starts[-1] + 50_000])]):
            step = r.choice([None, 900, 3600, 7000])
            anchor = r.choice([None, None, T0 + a - r.randint(0, 9000), T0 + a + r.randint(0, 9000), T0 + a + 90_000])
            schedules.append((k, T0 + a, b and T0 + b, r.random() < 0.85, step, r.choice([60, 300, 900]), r.choice(["KNOWN", "KNOWN", "UNKNOWN", None]), anchor))
        runs += [(k, T0 + (r.choice(starts) if r.random() < 0.2 else r.randint(-5000, 4 * 86400)), r.choice(["SCHEDULED", "SCHEDULED", "BOOTSTRAP", "MANUAL"])) for _ in range(r.choice([0, 3, 40]))]
    start, end, now = T0 + 10_000, T0 + 3 * 86400 + 5000, T0 + 3 * 86400 + 900
    s = stamps(spark.createDataFrame([tuple(float(x) if isinstance(x, int) and i in (1, 2, 7) else x for i, x in enumerate(row)) for row in schedules], SCHEDULES), "effective_from", "effective_to", "anchor_at")
    ran = stamps(spark.createDataFrame([(k, float(t), g) for k, t, g in runs], "k string, scheduled_for double, trigger string"), "scheduled_for")
    at = lambda t: F.timestamp_seconds(F.lit(t))
    text = lambda t: spark.range(1).select(at(t).cast("string")).first()[0]
    out = C.expected_times(s, ran, ["k"], text(start), text(end), at(now), by_schedule=True)
    got = {(x.k, int(x.effective_from.timestamp()), int(x.expected_at.timestamp())) for x in out.collect()}
    assert got == brute_expected(schedules, runs, start, end, now) and len(got) > 100


def test_buckets_meet_the_schedules_they_overlap(spark):
    r = random.Random(9)
    schedules = []
    for k in map(str, range(12)):
        starts = sorted(r.sample(range(0, 3 * 86400, 1800), 4))
        schedules += [(k, float(T0 + a), None if b is None else float(T0 + b), True, 3600, 60, "KNOWN", None) for a, b in zip(starts, [*starts[1:], None])]
    s = stamps(spark.createDataFrame(schedules, SCHEDULES), "effective_from", "effective_to", "anchor_at")
    none = spark.createDataFrame([], "k string, scheduled_for timestamp, trigger string, purpose string, state string, created_at timestamp, run_id string")
    buckets = s.select("k").distinct().crossJoin(spark.range(T0, T0 + 4 * 86400, 86400).select(F.timestamp_seconds("id").alias("bucket_start")))
    out = C.schedule_evaluation(s, none, buckets, ["k"], "2024-01-01", "2024-01-05", 86400, F.lit("2024-01-06").cast("timestamp"))
    got = {(x.k, int(x.bucket_start.timestamp()), int(x.effective_from.timestamp())): x.expected for x in out.collect()}
    want = {(k, b, int(a)) for k, a, e, *_ in schedules for b in range(T0, T0 + 4 * 86400, 86400) if a < b + 86400 and (e is None or e > b)}
    assert set(got) == want
    per = defaultdict(int)
    for k, a, t in brute_expected([tuple(int(x) if isinstance(x, float) else x for x in row) for row in schedules], [], T0, T0 + 4 * 86400, T0 + 5 * 86400):
        per[k, t // 86400 * 86400, a] += 1
    assert {x: n for x, n in got.items() if n} == dict(per)


def test_no_pair_of_schedules_and_runs_is_made(spark):
    """One busy key: as many rows go in as its runs, not runs times schedules."""
    s = stamps(spark.createDataFrame([("k", float(T0 + i * 600), float(T0 + i * 600 + 600), True, 300, 60, "KNOWN", None) for i in range(300)], SCHEDULES), "effective_from", "effective_to", "anchor_at")
    runs = spark.range(3000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.lit(T0) + F.col("id") * 60).alias("scheduled_for"), F.lit("SCHEDULED").alias("trigger"))
    rows = C.anchors(s, runs, ["k"])
    assert rows.where("ran").count() == 3000 and rows.where("not ran").count() == 300
    import re

    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert all("_span" in line for line in re.findall(r"Join .*", plan))


def test_islands_are_brute_force(spark):
    r = random.Random(5)
    rows = []
    for _ in range(400):
        a = T0 + r.randint(0, 6 * 86400) // 600 * 600
        b = a + r.choice([0, 600, 600, 1200, 5400]) if r.random() > 0.02 else a + 3 * 86400
        rows.append((r.choice("ab"), float(a), float(b) if r.random() > 0.05 else None, r.choice(C.WORST_FIRST)))
    df = stamps(spark.createDataFrame(rows, "k string, start double, end double, availability string"), "start", "end")
    want = []
    for k in "ab":
        own = sorted((a, b, C.WORST_FIRST.index(v)) for k2, a, b, v in rows if k2 == k and b is not None and b > a)
        merged = []
        for a, b, v in own:
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]), merged[-1][2] + 1, min(v, merged[-1][3]))
            else:
                merged.append((a, b, 1, v))
        want += [(k, a, b, n, C.WORST_FIRST[v]) for a, b, n, v in merged]
    got = [(x.k, x.start.timestamp(), x.end.timestamp(), x.n, x.availability) for x in C.merged_windows(df, ["k"]).collect()]
    assert sorted(got) == sorted(want) and len(want) > 10
