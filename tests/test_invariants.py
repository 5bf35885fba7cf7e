import pytest
from pyspark.sql import functions as F

from tidemark.operators import invariants as I
from tidemark.operators import measure as M
from tidemark.operators.contracts import validate_definitions, validate_facts


def test_each_kind_of_check_and_what_nobody_looked_at(spark):
    heads = spark.sql("select 1 head, 1 rev, 'a' k union all select 2, 2, 'x' union all select 3, 9, 'c' union all select 4, null, 'd' union all select 5, 4, null")
    revisions = spark.sql("select 1 id, 'a' k, 5 n union all select 2, 'b', -1 union all select 4, 'e', null union all select 4, 'e', 2")
    checks = (I.Pairs("mismatch", "heads", "revisions", "rev = id", I.differs("k")), I.Missing("orphans", "heads", "revisions", "rev = id"), I.Rows("negative", "revisions", "n < 0"), I.Rows("many", "revisions", "n > 1"), I.Repeated("twice", "revisions", ("id",)), I.Rows("unseen", "nowhere", "true"))
    got = {r.invariant: (r.violations, r.accepted) for r in I.invariants({"heads": heads, "revisions": revisions}, checks).collect()}
    # A null pointer points to nothing; a comparison with a null tells no difference.
    assert got == {"mismatch": (1, False), "orphans": (2, False), "negative": (1, False), "many": (2, False), "twice": (1, False), "unseen": (None, False)}
    clean = I.invariants({"heads": heads.limit(0), "revisions": revisions.limit(0)}, checks[:5]).collect()
    assert {(r.violations, r.accepted) for r in clean} == {(0, True)}


def test_a_table_is_scanned_once(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 as n").write.parquet(f"{tmp_path}/t")
    out = I.invariants({"t": spark.read.parquet(f"{tmp_path}/t")}, tuple(I.Rows(f"n{i}", "t", f"n = {i}") for i in range(3)))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.invariant: r.violations for r in out.collect()} == {"n0": 4, "n1": 3, "n2": 3}


def test_names_are_told_once():
    assert len({c.name for c in I.CHECKS}) == len(I.CHECKS) == 32


FINE = "'a.b' measurement_key, 'v1' contract_version, 'COUNT' unit, 'x' display_label, 'x' description, 'x' represents, 'x' does_not_represent, array('NVD_CVE') source_keys, array('IOC_REPORT') record_kinds, array('DAY') granularities, array('D') dimensions, 'DISTRIBUTION' value_kind, 'DATE' time_precision"


@pytest.mark.parametrize("change, want", [({}, []), ({"measurement_key": "null"}, ["MEASUREMENT_KEY_LENGTH", "MEASUREMENT_KEY_PATTERN"]), ({"granularities": "array('DAY', 'HOUR')"}, ["DATE_PRECISION_FINER_THAN_DAY"]), ({"dimensions": "null"}, ["DIMENSIONS_COUNT", "DISTRIBUTION_WITHOUT_DIMENSION"]), ({"record_kinds": "array('low', null)"}, ["RECORD_KINDS_NAME"]), ({"time_precision": "'WEEK'"}, ["PRECISION_UNKNOWN"])])
def test_definitions(spark, change, want):
    row = spark.sql(f"select {FINE}").withColumns({k: F.expr(v) for k, v in change.items()})
    good, bad = validate_definitions(row)
    assert ([r.reasons for r in bad.collect()] or [[]])[0] == want and good.count() == (not want)


def test_facts_have_one_time(spark):
    rows = spark.sql("select * from values (1, timestamp'2024-01-01', null, 'INSTANT', 'ACTIVE', 1d), (2, null, null, 'DATE', 'ACTIVE', 1d), (3, timestamp'2024-01-01', date'2024-01-01', 'DATE', 'RETRACTED', null), (4, null, date'2024-01-01', 'INSTANT', null, double('NaN')) as t(id, event_time, event_date, time_precision, fact_state, value)")
    good, bad = validate_facts(rows)
    assert [r.id for r in good.collect()] == [1]
    assert {r.id: r.reasons for r in bad.collect()} == {2: ["TIME_EXACTLY_ONE", "DATE_WITHOUT_DATE"], 3: ["TIME_EXACTLY_ONE"], 4: ["INSTANT_WITHOUT_TIME", "STATE_UNKNOWN", "VALUE_NOT_FINITE"]}


def test_verdicts_come_in_their_order(spark):
    old, new = "2024-01-05", "2024-01-12"
    rows = [("same", old, 2.0, "m", "p"), ("same", new, 3.0, "m", "p"), ("model", old, 2.0, "m", "p"), ("model", new, 3.0, "n", "p"), ("none", old, 2.0, "", None), ("none", new, 3.0, None, None), ("new", new, 1.0, "m", "p"), ("zero", old, 0.0, "m", "p"), ("zero", new, 1.0, "m", "p"), ("dark", old, 1.0, "m", "p"), ("dark", new, 1.0, "m", "p")]
    facts = spark.createDataFrame([(k, t, v, m, p, i) for i, (k, t, v, m, p) in enumerate(rows)], "k string, t string, value double, model string, profile string, fact_key int").withColumn("event_time", F.col("t").cast("timestamp"))
    covered = spark.createDataFrame([(k, k != "dark", True) for k in ("same", "model", "none", "new", "zero", "dark", "empty")], "k string, current_ok boolean, previous_ok boolean")
    ask = lambda kind, **also: {r.k: (r.status, r.value, r.previous_value, r.delta, r.percent) for r in M.compare_published(facts, covered, ["k"], kind, "2024-01-01", "2024-01-08", "2024-01-15", **also).collect()}
    got = ask("LAST_VALUE", same_model=True)
    assert got["same"] == ("AVAILABLE", 3.0, 2.0, 1.0, 50.0) and got["none"] == got["same"] and got["zero"] == ("AVAILABLE", 1.0, 0.0, 1.0, None)
    assert got["model"] == got["new"] == ("INCOMPATIBLE_SOURCE_MODEL", None, None, None, None) and got["dark"][0] == "INSUFFICIENT_COVERAGE"
    assert got["empty"] == ("UNSUPPORTED", None, None, None, None)
    assert ask("LAST_VALUE")["new"] == ("UNSUPPORTED", 1.0, None, None, None) and ask("SUM_EVENTS")["empty"] == ("AVAILABLE", 0, 0, 0, None)
    assert {x[0] for x in ask("NONE").values()} == {"UNSUPPORTED"}
