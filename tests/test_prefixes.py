import ipaddress
import random

from pyspark.sql import functions as F

from tidemark.operators import prefixes as P


def network(text):
    try:
        return ipaddress.ip_network(text, strict=False) if "/" in text else None
    except ValueError:
        return None


def test_longest_match_is_brute_force(spark):
    r = random.Random(1)
    v4 = lambda: f"{r.choice([10, 192])}.{r.randint(0, 3)}.{r.randint(0, 3)}.{r.randint(0, 255)}"
    v6 = lambda: str(ipaddress.ip_address((0x20010DB8 << 96) + (r.randint(0, 3) << r.choice([0, 30, 63, 64, 65, 80])) + r.randint(0, 2)))
    ips = [v4() for _ in range(150)] + [v6() for _ in range(150)] + ["", "no", "1.2.3", "2001:DB8::1", "::ffff:10.0.0.1", None]
    prefixes = [f"{v4()}/{r.choice([0, 1, 8, 15, 16, 17, 24, 31, 32])}" for _ in range(60)] + [f"{v6()}/{r.choice([0, 1, 32, 63, 64, 65, 96, 127, 128])}" for _ in range(60)]
    prefixes += ["10.0.0.0/33", "x/8", "10.0.0.0", "2001:db8::/129", "2001:0DB8::/32", "10.0.0.0/-1", None]
    got = {x.ip: x.covering for x in P.covering_prefix(spark.createDataFrame([(i,) for i in ips], "ip string"), spark.createDataFrame([(p,) for p in prefixes], "prefix string")).collect()}
    nets = [(network(p), p) for p in prefixes if p and network(p)]
    for ip in ips:
        try:
            at = ipaddress.ip_address(ip)
        except ValueError:
            assert got[ip] is None
            continue
        held = [(n, p) for n, p in nets if n.version == at.version and at in n]
        longest = max((n.prefixlen for n, _ in held), default=None)
        assert got[ip] == min((p for n, p in held if n.prefixlen == longest), default=None)
    assert len({p for p in got.values()}) > 20


def test_only_lengths_that_occur_are_tried(spark):
    ips = spark.range(1000).select(F.concat(F.lit("10.0."), F.col("id") % 256, F.lit("."), (F.col("id") / 4).cast("int")).alias("ip"))
    known = P.networks(spark.createDataFrame([("10.0.0.0/8",), ("10.0.1.0/24",), ("2001:db8::/32",)], "prefix string"), "prefix")
    assert P.tried(ips, "ip", known).count() == 2 * ips.distinct().count()


def test_no_prefixes_and_no_addresses(spark):
    ips, none = spark.createDataFrame([("10.0.0.1",)], "ip string"), spark.createDataFrame([], "prefix string")
    assert P.covering_prefix(ips, none).first().covering is None and P.covering_prefix(ips.limit(0), none).count() == 0
