import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import json_texts as J


def one(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, j string")
    return [r[0] for r in df.select("id", expr.alias("x")).orderBy("id").select("x").collect()]


def canonical(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def nested(r, depth):
    if depth == 0 or r.random() < 0.2:
        return r.choice([None, True, False, r.randint(-5, 10**9), "x", 'say "1.0, 2e5" : {', "é漢", "", "a\\b"])
    if r.random() < 0.5:
        return [nested(r, depth - 1) for _ in range(r.randint(0, 3))]
    return {k: nested(r, depth - 1) for k in r.sample(["b", "a", "B", "_", "é", "nodes", "1.0", 'q"', "zz"], r.randint(0, 4))}


def shuffled(r, x):
    if isinstance(x, dict):
        items = [(k, shuffled(r, v)) for k, v in x.items()]
        r.shuffle(items)
        return dict(items)
    return [shuffled(r, v) for v in x] if isinstance(x, list) else x


def test_equal_values_have_one_text(spark):
    r = random.Random(2)
    values = [nested(r, 8) for _ in range(120)]
    texts = [json.dumps(shuffled(r, v), ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])) for v in values]
    assert one(spark, texts, J.canonical_json("j")) == [canonical(v) for v in values]


def test_numbers_and_what_is_no_record(spark):
    texts = ["1.50", "[1.0, -0.0, 1e2, 100]", '{"a":"1.0","b":2.0}', "1e400", '{"a":[-1E309]}', '{"a":"1e400"}', "NaN", '{"a":1,"a":2}', "{", "", None, "[]", "12345678901234567890123", "1e-400"]
    assert one(spark, texts, J.canonical_json("j")) == ["1.5", "[1,0,100,100]", '{"a":"1.0","b":2}', None, None, '{"a":"1e400"}', None, None, None, None, None, "[]", "12345678901234567890123", "0"]


def test_prepared_records(spark):
    rows = [("  r1 ", '{"b": 2, "a": {"y": 2, "x": 1}}'), ("r1", '{"a":{"x":1,"y":2},"b":2}'), (" ", "{}"), ("x" * 513, "{}"), (None, "{}"), ("big", json.dumps({"v": "x" * 100})), ("bad", "{"), ("é", '"é"')]
    out = J.prepare_records(spark.createDataFrame(rows, "id string, p string").coalesce(1), "id", "p", 50).collect()
    want = '{"a":{"x":1,"y":2},"b":2}'
    assert [(r.id, r.payload_json, r.payload_bytes, r.payload_sha256) for r in out[:2]] == [("r1", want, len(want), hashlib.sha256(want.encode()).hexdigest())] * 2
    assert [r.failure for r in out] == [None, None, "SCHEMA_ERROR", "SCHEMA_ERROR", "SCHEMA_ERROR", "PAYLOAD_LIMIT_EXCEEDED", "SCHEMA_ERROR", None]
    assert all(r.payload_json is None and r.payload_bytes is None and r.payload_sha256 is None for r in out if r.failure) and out[-1].payload_bytes == 4


def every(x, depth=0, path="$", name=None):
    yield depth, path, name
    if isinstance(x, dict):
        for k, v in x.items():
            yield from every(v, depth + 1, f"{path}.{k}", k)
    elif isinstance(x, list):
        for i, v in enumerate(x):
            yield from every(v, depth + 1, f"{path}[{i}]")


def test_a_walk_visits_every_value(spark):
    r = random.Random(3)
    values = [nested(r, 9) for _ in range(60)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(900, "{"), (901, None)], "id int, j string")
    got = sorted((x.id, x.depth, x.path, x.name or "") for x in J.walk(df, ["id"], "j").collect())
    assert got == sorted((i, d, p, n or "") for i, v in enumerate(values) for d, p, n in every(v))
    assert max(x[1] for x in got) >= 7
    kinds = {x.path: x.kind for x in J.walk(spark.createDataFrame([(1, '{"a":[1,"x",true,null]}')], "id int, j string"), ["id"], "j").collect()}
    assert kinds["$"] == "OBJECT" and kinds["$.a"] == "ARRAY" and kinds["$.a[1]"] == "STRING" and kinds["$.a[2]"] == "BOOLEAN"


def brute_counts(x):
    nodes = matches = 0

    def visit(v):
        nonlocal nodes, matches
        if isinstance(v, list):
            for i in v:
                visit(i)
        elif isinstance(v, dict):
            for k in ("nodes", "children"):
                if isinstance(v.get(k), list):
                    nodes += len(v[k])
                    visit(v[k])
            if isinstance(v.get("cpeMatch"), list):
                matches += len(v["cpeMatch"])

    visit(x)
    return nodes, matches


def configuration(r, depth):
    x = {"operator": "OR", "cpeMatch": [{"criteria": f"c{i}", "children": [1, 2]} for i in range(r.randint(0, 3))]}
    if depth:
        x[r.choice(["children", "nodes"])] = [configuration(r, depth - 1) for _ in range(r.randint(1, 2))]
    return x


def test_configurations_of_seven_levels_and_more(spark):
    r = random.Random(4)
    values = [{"id": i, "configurations": [{"nodes": [configuration(r, d)]} for d in range(i % 10)]} for i in range(40)]
    values += [{"configurations": {"nodes": {"no": "array"}}}, {"other": 1}, {"configurations": [[{"nodes": [1, [2]]}]]}, {"configurations": []}, []]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(99, "no json")], "id int, j string")
    got = {x.id: (x.nodes, x.matches) for x in J.configuration_counts(df, ["id"], "j").collect()}
    assert got == {i: brute_counts(v.get("configurations") if isinstance(v, dict) else None) for i, v in enumerate(values)}


def test_counts_take_one_pass_and_sum_rows_of_a_key(spark):
    """Without a job for each level; rows of one key, null too, count together."""
    deep = '{"configurations":' + '[{"children":' * 40 + '[{"cpeMatch":[1,null]},null]' + "}]" * 40 + "}"
    rows = [(1, deep), (1, '{"configurations":{"cpeMatch":{"nodes":[{"cpeMatch":[[{"nodes":[1]}]]}]}}}'), (None, deep), (2, "{")]
    out = J.configuration_counts(spark.createDataFrame(rows, "id int, j string"), ["id"], "j")
    assert "UnionLoop" not in out._jdf.queryExecution().executedPlan().toString()
    each = brute_counts(json.loads(deep)["configurations"])
    assert {(r.id, r.nodes, r.matches) for r in out.collect()} == {(1, each[0] + 1, each[1] + 1), (None, *each)}


@pytest.mark.parametrize("text, want", [('{"metrics":{"cvssMetricV31":[]}}', ["3.1"]), ('{"a":[{"b":{"X_CVSSMETRICV2":1,"cvssmetricv40":2}}]}', ["2.0", "4.0"]), ('{"a":"cvssMetricV31"}', []), ('{"a":"say \\"cvssMetricV30\\": 1"}', []), ('{"cvssMetricV30" : 1, "cvssMetricV2":2}', ["2.0", "3.0"]), (None, [])])
def test_versions_by_containment_at_any_depth(spark, text, want):
    assert (one(spark, [text], J.cvss_versions("j"))[0] or []) == want
    if text:
        assert one(spark, [text], J.keys_of("j"))[0] == [k for k in keys(json.loads(text))]


def keys(x):
    if isinstance(x, dict):
        for k, v in x.items():
            yield k
            yield from keys(v)
    elif isinstance(x, list):
        for v in x:
            yield from keys(v)
