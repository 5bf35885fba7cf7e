import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as X


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "kind, value, status, key, port",
    [
        ("domain", "Evil.Example.COM.", "NORMALIZED", "evil.example.com", None),
        ("domain", "no spaces.com", "INVALID_SOURCE_VALUE", None, None),
        ("url", "https://a.b/c", "NORMALIZED", "https://a.b/c", None),
        ("url", "ftp://a.b/c", "INVALID_SOURCE_VALUE", None, None),
        ("ip:port", "10.0.0.1:65535", "NORMALIZED", "10.0.0.1", 65535),
        ("ip:port", "10.0.0.1:65536", "INVALID_SOURCE_VALUE", None, None),
        ("ip:port", "10.0.0.256:80", "INVALID_SOURCE_VALUE", None, None),
        ("ip:port", "[FE80::1]:443", "NORMALIZED", "fe80::1", 443),
        ("md5_hash", "A" * 32, "NORMALIZED", "a" * 32, None),
        ("sha256_hash", "a" * 63, "INVALID_SOURCE_VALUE", None, None),
        ("mutex", "x", "UNMAPPED", None, None),
        ("url", None, "INVALID_SOURCE_VALUE", None, None),
    ],
)
def test_indicators(spark, kind, value, status, key, port):
    row = one(spark, value, X.normalize_indicator(F.lit(kind), F.col("v")))
    assert (row.status, row.key, row.port) == (status, key, port)


def test_instants_need_an_offset(spark):
    assert one(spark, "2024-01-02T03:04:05+02:00", F.date_format(X.parse_instant("v"), "HH:mm")) == "01:04"
    assert one(spark, "2024-01-02T03:04:05", X.parse_instant("v")) is None
    assert one(spark, "2024-02-30T03:04:05Z", X.parse_instant("v")) is None
    assert one(spark, "2024-07-02 03:04:05 CEST", F.date_format(X.parse_instant("v", "CENTRAL"), "HH:mm")) == "01:04"


def test_dates(spark):
    assert one(spark, "2024-02-29", X.parse_date("v").cast("string")) == "2024-02-29"
    assert one(spark, "2023-02-29", X.parse_date("v")) is None
    assert one(spark, "2024-2-9", X.parse_date("v")) is None


def test_ids_members_and_urls(spark):
    assert one(spark, "cve-2024-0001 CVE-2023-12345 cve-2024-0001", X.extract_ids("v")) == ["CVE-2023-12345", "CVE-2024-0001"]
    assert one(spark, None, X.extract_ids("v")) == []
    assert one(spark, " a ||b| ", X.members("v")) == ["a", "b"]
    assert one(spark, "see https://a.b/c), http://u:p@x.y/ and https://a.b/c.", X.harvest_urls("v")) == ["https://a.b/c"]
    assert one(spark, "HTTPS://A.B; (http://x.y:80?q=1), [https://a.b/]} https://ü.de http:///x http://x.y/a\"b " + "http://x.y/" + "z" * 2048, X.harvest_urls("v")) == ["https://a.b/", "http://x.y:80/?q=1", "http://x.y/a%22b"]


def test_fingerprint_tells_null_from_empty(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string").select(X.fingerprint("x", "y").alias("f")).collect()
    assert len({r.f for r in rows}) == 3


def test_fact_takes_the_last_and_no_blank(spark):
    df = spark.sql("select array(struct('p' as predicate, '1' as value), struct('p' as predicate, '' as value), struct('q' as predicate, 'x' as value)) as facts")
    row = df.select(X.fact("facts", "p").alias("p"), X.fact("facts", "q", "double").alias("q"), X.fact("facts", "none").alias("n")).first()
    assert (row.p, row.q, row.n) == (None, None, None)


def test_address_bits_agree_with_the_library(spark):
    import ipaddress

    good = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "::", "::1", "2001:db8::", "2001:DB8:0:1::ff", "1:2:3:4:5:6:7:8", "fe80::1:2", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "64:ff9b::192.0.2.33"]
    bad = ["", "1.2.3", "1.2.3.256", "1:2:3", "1::2::3", ":::", "12345::", "g::1", "1:2:3:4:5:6:7:8:9", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8::", None]
    rows = spark.createDataFrame([(x,) for x in good + bad], "v string").select("v", X.address_bits("v").alias("b")).collect()
    for r in rows:
        if r.v in bad:
            assert r.b is None, r.v
        else:
            a = ipaddress.ip_address(r.v)
            assert r.b == f"{a.version}" + format(int(a), f"0{a.max_prefixlen}b"), r.v


def test_configurations_of_any_depth_are_counted(spark):
    leaf = '{"cpeMatch": [{"criteria": "x"}, {"criteria": "y"}]}'
    text = '{"configurations": [{"nodes": [{"children": [{"children": [%s]}, %s]}, %s]}]}' % (leaf, leaf, leaf)
    assert tuple(one(spark, text, X.config_counts("v"))) == (5, 6)
    assert tuple(one(spark, "{}", X.config_counts("v"))) == (0, 0)


def test_metric_names_count_as_keys_only(spark):
    assert one(spark, '{"cvssMetricV31" : [], "note": "cvssMetricV2"}', X.harvest_cvss("v")) == ["3.1"]


def test_decoded_origin_and_heartbeat(spark):
    paths = [[("AS_SET", [1]), ("AS_SEQUENCE", [2, 3])], [("AS_SEQUENCE", [2]), ("AS_SET", [4])], []]
    rows = spark.createDataFrame([(p,) for p in paths], "v array<struct<kind:string,asns:array<bigint>>>")
    assert [r.o for r in rows.select(X.definitive_origin_asns("v").alias("o")).collect()] == [[3], [], []]
    now = F.lit("2024-01-01 00:01:00").cast("timestamp")
    for at, want in (("2024-01-01 00:00:30", "FRESH"), ("2024-01-01 00:00:29", "STALE"), (None, "UNKNOWN")):
        assert spark.range(1).select(X.heartbeat(F.lit(at).cast("timestamp"), 30, now).alias("h")).first().h == want
