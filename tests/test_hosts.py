import pytest
from pyspark.sql import functions as F

from tidemark.functions import hosts as H
from tidemark.functions.scalars import normalize_indicator

#: Samples that RFC 3492 gives (7.1), and names in common use.
SAMPLES = {
    "ليهمابتكلموشعربي؟": "egbpdaj6bu4bxfgehfvwxn",
    "他们为什么不说中文": "ihqwcrb4cv8a8dqg056pqjye",
    "ひとつ屋根の下2": "2-u9tlzr9756bt3uc0v",
    "そのスピードで": "d9juau41awczczp",
    "bücher": "bcher-kva",
    "münchen": "mnchen-3ya",
    "faß": "fa-hia",
    "рф": "p1ai",
}


@pytest.mark.parametrize("label, code", SAMPLES.items())
def test_published_samples(label, code):
    assert H.ascii_label(label) == f"xn--{code}"


def test_hosts():
    assert H.ascii_host("BÜCHER。Example.") == "xn--bcher-kva.example"
    assert H.ascii_host("bücher.de") == "xn--bcher-kva.de"  # composed first
    assert H.ascii_host("ａｂ.de") == "ab.de"  # wide letters
    for bad in ("a..é", "́a.de", "é x.de", "-é.de".replace("é", "e"), "é" * 60 + ".de", ".".join(["é" * 30] * 9)):
        assert H.ascii_host(bad) is None


def test_only_other_names_reach_python(spark, monkeypatch):
    rows = [(1, "Example.COM."), (2, "bücher.de"), (3, None), (4, "bücher.de"), (5, ""), (6, "́.de")]
    df = spark.createDataFrame(rows, "id int, host string").withColumn("name", F.lit("clash"))
    got = {r.id: r.out for r in H.with_ascii_hosts(df, "host", "out").collect()}
    assert got == {1: "example.com", 2: "xn--bcher-kva.de", 3: None, 4: "xn--bcher-kva.de", 5: "", 6: None}
    assert H.with_ascii_hosts(df.limit(0), "host", "out").count() == 0


def test_converted_domains_are_indicators(spark):
    df = spark.createDataFrame([("bücher.example",), ("plain.example",)], "ioc string")
    out = H.with_ascii_hosts(df, "ioc", "host").select(normalize_indicator(F.lit("domain"), "host").alias("i")).select("i.status", "i.key").collect()
    assert {tuple(r) for r in out} == {("NORMALIZED", "xn--bcher-kva.example"), ("NORMALIZED", "plain.example")}
