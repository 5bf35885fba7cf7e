import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import pages as P


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    data = [(r.choice("abc"), f"2024-01-{r.randint(1, 4):02d} 00:00:00.{r.randint(0, 2):06d}" if r.random() > 0.1 else None, i) for i in range(100)]
    return spark.createDataFrame(data, "k string, t string, id int").withColumn("t", F.col("t").cast("timestamp")).cache()


def walked(rows, key, order, n):
    """Page after page until no key has a further one."""
    out, now, asked = [], P.page(rows, key, order, n).collect(), 0
    spark = rows.sparkSession
    while True:
        out.append(now)
        more = [(*[r[k] for k in key], r.next_cursor) for r in now if r.next_cursor]
        if not more:
            return out
        schema = ", ".join([*(f"{k} string" for k in key), "cursor string"])
        now, asked = P.page(rows, key, order, n, spark.createDataFrame(more, schema)).collect(), asked + 1
        assert asked < 50


@pytest.mark.parametrize("key", [("k",), ()])
@pytest.mark.parametrize("n", [1, 7, 34])
def test_all_pages_are_all_rows(rows, key, n):
    if n == 1 and not key:
        n = 9
    got = walked(rows, key, ("t", "id"), n)
    flat = [r for p in got for r in p]
    assert sorted(r.id for r in flat) == sorted(r.id for r in rows.collect())
    for p in got:
        for k in {tuple(r[c] for c in key) for r in p}:
            own = [r for r in p if tuple(r[c] for c in key) == k]
            assert len(own) <= n and sorted(r.position for r in own) == list(range(1, len(own) + 1))
    whole = {r.id: (r.page, r.position) for r in P.numbered(rows, key or ("k",), ("t", "id"), n).collect()}
    if key:
        assert {r.id: (i + 1, r.position) for i, p in enumerate(got) for r in p} == whole


def test_walk_is_the_first_pages(rows):
    got = sorted((r.k, r.page, r.position, r.id) for r in P.walk(rows, ("k",), ("t", "id"), 5, 3).collect())
    want = sorted((r.k, r.page, r.position, r.id) for r in P.numbered(rows, ("k",), ("t", "id"), 5).where("page <= 3").collect())
    assert got == want


def test_a_busy_key_is_cut_before_its_rows_meet(spark, rows):
    near = P.nearest(rows.union(rows), ("k",), ("t", "id"), 4)
    best = {(r.k, r.id) for r in P.numbered(rows, ("k",), ("t", "id"), 4).where("page = 1").collect()}
    assert sorted((r.k, r.id) for r in near.collect()) == sorted([*best, *best])
    told = P.walk(rows, ("k",), ("t", "id"), 5, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in told and "RepartitionByExpression" in told


def test_keys_without_a_cursor_have_no_further_page(spark, rows):
    one = P.cursors_of(P.page(rows, ("k",), ("t", "id"), 3), ("k",)).where("k = 'a'")
    assert {r.k for r in P.page(rows, ("k",), ("t", "id"), 3, one).collect()} == {"a"}
    assert P.page(rows, ("k",), ("t", "id"), 3, spark.createDataFrame([("a", None)], "k string, cursor string")).count() == 0
    assert P.page(rows.limit(0), ("k",), ("t", "id"), 3).count() == 0


def test_what_is_no_cursor_is_an_error(spark, rows):
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed|parse"):
        P.page(rows, ("k",), ("t", "id"), 3, spark.createDataFrame([("a", "bm8gY3Vyc29y")], "k string, cursor string")).collect()
