"""Column functions: strict parsing, normalisation, identity keys, dimension splitting, buckets. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bucket sizes in seconds.
GRANULARITY = {"MINUTE": 60, "FIVE_MINUTES": 300, "HOUR": 3600, "DAY": 86400}

#: Purposes that are a basis of their own.
OWN_BASIS = ("INITIAL_BOOTSTRAP", "HISTORICAL_BACKFILL", "RESYNC", "REPAIR")

CVE = r"(?i)\bCVE-[0-9]{4}-[0-9]{4,}\b"
CWE = r"CWE-[0-9]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fingerprint(*columns: Column | str) -> Column:
    """sha-256 of the values in order; a null has a mark of its own, and lengths keep neighbours apart."""
    parts = [F.coalesce(F.concat(F.length(col(c).cast("string")).cast("string"), F.lit(":"), col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws(";", *parts), 256)


def scoped_key(prefix: str, *columns: Column | str) -> Column:
    """prefix and the sha-256 of the trimmed lower-cased parts, joined by NUL."""
    parts = [F.lower(F.trim(F.coalesce(col(c).cast("string"), F.lit("")))) for c in columns]
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws("\0", *parts), 256))


def parse_instant(c: Column | str, form: str = "RFC3339") -> Column:
    """A timestamp, or null where the text breaks the form's rules. RFC3339 must carry an offset; UTC_SUFFIX is
    `Y-m-d H:M:S UTC`; ZONELESS counts as UTC; CENTRAL ends in CET or CEST."""
    text = F.trim(col(c))
    body = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?"
    if form == "RFC3339":
        return F.when(text.rlike(rf"^{body}(Z|[+-][0-9]{{2}}:[0-9]{{2}})$"), F.try_to_timestamp(text))
    if form == "UTC_SUFFIX":
        return F.when(text.rlike(rf"^{body} UTC$"), F.try_to_timestamp(F.regexp_replace(text, " UTC$", "Z")))
    if form == "ZONELESS":
        return F.when(text.rlike(rf"^{body}Z?$"), F.try_to_timestamp(F.concat(F.regexp_replace(text, "Z$", ""), F.lit("Z"))))
    if form == "CENTRAL":
        offset = F.when(text.endswith("CEST"), "+02:00").otherwise("+01:00")
        return F.when(text.rlike(rf"^{body} (CET|CEST)$"), F.try_to_timestamp(F.concat(F.regexp_replace(text, " CES?T$", ""), offset)))
    raise ValueError(form)


def parse_date(c: Column | str) -> Column:
    """A calendar date of the form yyyy-MM-dd, or null: other forms and impossible days."""
    text = col(c)
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def extract_ids(c: Column | str, pattern: str = CVE) -> Column:
    """All matches, upper-cased, distinct, sorted."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(pattern), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, F.upper)))


#: Marks that are no part of an address behind it, its longest length, and what a path writes in another way.
TRAILING, LONGEST_URL = r"[\])},.]+$", 2048
ESCAPED = {'"': "%22", "<": "%3C", ">": "%3E", "`": "%60", "{": "%7B", "}": "%7D"}


def harvest_urls(c: Column | str, cap: int = 63) -> Column:
    """http(s) addresses of a prose text, in their normal form (scheme and host in lower case, a path of at least /), in order of
    first sight, `cap` at most. Marks behind an address are cut; longer ones than LONGEST_URL, those with credentials, and those
    whose host isn't plain ASCII are left out."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"(?i)https?://[^\s;]+"), F.lit(0))
    trimmed = F.filter(F.transform(found, lambda u: F.regexp_replace(u, TRAILING, "")), lambda u: F.length(u) <= LONGEST_URL)
    plain = F.filter(trimmed, lambda u: u.rlike(r"(?i)^https?://[a-z0-9._~-]+(:[0-9]{1,5})?([/?#]|$)"))

    def normal(u: Column) -> Column:
        begin = F.lower(F.regexp_extract(u, r"(?i)^(https?://[^/?#]+)", 1))
        rest = F.regexp_replace(u, r"(?i)^https?://[^/?#]+", "")
        for mark, code in ESCAPED.items():
            rest = F.replace(rest, F.lit(mark), F.lit(code))
        return F.concat(begin, F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest)))

    return F.slice(F.array_distinct(F.transform(plain, normal)), 1, cap)


def normalize_indicator(kind: Column | str, value: Column | str) -> Column:
    """struct(status, kind, key, port). status is NORMALIZED, INVALID_SOURCE_VALUE, or UNMAPPED for an unknown kind."""
    k, v = F.lower(F.trim(col(kind))), F.trim(col(value))
    domain = F.regexp_replace(F.lower(v), r"\.$", "")
    label = r"[a-z0-9_]([a-z0-9_-]{0,61}[a-z0-9_])?"
    octet = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    v4, v6 = rf"^({octet}(\.{octet}){{3}}):([0-9]{{1,5}})$", r"^\[([0-9A-Fa-f:]+)\]:([0-9]{1,5})$"
    port = F.when(v.rlike(v4), F.regexp_extract(v, r":([0-9]+)$", 1)).when(v.rlike(v6), F.regexp_extract(v, r":([0-9]+)$", 1)).cast("int")
    address = F.when(v.rlike(v4), F.regexp_extract(v, v4, 1)).when(v.rlike(v6), F.lower(F.regexp_extract(v, v6, 1)))
    sizes = {"md5_hash": 32, "sha1_hash": 40, "sha256_hash": 64}
    out = F.struct(F.lit("UNMAPPED").alias("status"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("int").alias("port"))

    def result(good: Column, name: str, key: Column, number: Column) -> Column:
        on = F.coalesce(good, F.lit(False))
        return F.struct(
            F.when(on, "NORMALIZED").otherwise("INVALID_SOURCE_VALUE").alias("status"),
            F.when(on, name).alias("kind"),
            F.when(on, key).alias("key"),
            F.when(on, number).alias("port"),
        )

    none = F.lit(None).cast("int")
    chain = F.when(k == "domain", result((F.length(domain) <= 253) & domain.rlike(rf"^{label}(\.{label})+$"), "domain", domain, none))
    chain = chain.when(k == "url", result(v.rlike(r"^(?i)https?://[^/?#\s@]+([/?#]\S*)?$"), "url", v, none))
    chain = chain.when(k == "ip:port", result(port.between(1, 65535), "ip", address, port))
    for name, size in sizes.items():
        chain = chain.when(k == name, result(v.rlike(f"^[0-9A-Fa-f]{{{size}}}$"), name.removesuffix("_hash"), F.lower(v), none))
    return chain.otherwise(out)


def members(c: Column | str) -> Column:
    """A dimension's members: split on |, trimmed, empties dropped."""
    return F.filter(F.transform(F.split(F.coalesce(col(c).cast("string"), F.lit("")), "[|]"), lambda x: F.trim(x)), lambda x: x != "")


def score_band(c: Column | str) -> Column:
    v = col(c)
    return F.when(v < 0.2, "0.0-0.2").when(v < 0.4, "0.2-0.4").when(v < 0.6, "0.4-0.6").when(v < 0.8, "0.6-0.8").when(v.isNotNull(), "0.8-1.0")


def acquisition_basis(trigger: Column | str, purpose: Column | str, bootstrap_first: bool = True) -> Column:
    """How a fact was acquired; windows, unlike facts, don't take a BOOTSTRAP trigger for the initial load."""
    t, p = col(trigger), col(purpose)
    boot = F.coalesce((t == "BOOTSTRAP") if bootstrap_first else F.lit(False), F.lit(False))
    return F.when(boot, "INITIAL_BOOTSTRAP").when(p.isin(*OWN_BASIS), p).when(t == "RECOVERY", "RECOVERY").otherwise("LIVE_INCREMENTAL")


def is_live(trigger: Column | str, purpose: Column | str) -> Column:
    return F.coalesce((col(trigger) == "SCHEDULED") & (col(purpose) == "LIVE_INCREMENTAL"), F.lit(False))


def fact(facts: Column | str, predicate: str, kind: str = "string") -> Column:
    """The value of the last fact with this predicate; empty text and, for a number, other text are null."""
    value = F.try_element_at(F.filter(col(facts), lambda x: x["predicate"] == predicate), F.lit(-1))["value"]
    value = F.when(value != "", value)
    return value if kind == "string" else value.try_cast(kind)


def collapse_ws(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def canonical_prefix(c: Column | str) -> Column:
    """Lower-cased CIDR text, or null if it doesn't look like one; host bits stay."""
    text = F.lower(F.trim(col(c)))
    return F.when((F.length(text) <= 64) & text.rlike(r"^[0-9a-f.:]+/[0-9]{1,3}$"), text)


def ip_version(c: Column | str) -> Column:
    return F.when(F.instr(col(c), ":") > 0, 6).otherwise(4)


def origin_asns(path: Column | str) -> Column:
    """The last element of an AS path as an array of one, or empty for a set or no number. path: array of strings."""
    last = F.try_element_at(col(path), F.lit(-1)).try_cast("bigint")
    return F.when(last.isNotNull(), F.array(last)).otherwise(F.array().cast("array<bigint>"))


def definitive_origin_asns(segments: Column | str) -> Column:
    """The last number of a decoded path as an array of one, if its last segment is a sequence. segments: array of
    struct(kind, asns)."""
    last = F.try_element_at(col(segments), F.lit(-1))
    value = F.when(last["kind"] == "AS_SEQUENCE", F.try_element_at(last["asns"], F.lit(-1)).cast("bigint"))
    return F.when(value.isNotNull(), F.array(value)).otherwise(F.array().cast("array<bigint>"))


def bucket_start(ts: Column | str, granularity: str) -> Column:
    """Start of the half-open UTC bucket; aligned to the epoch."""
    size = GRANULARITY[granularity]
    seconds = F.unix_timestamp(col(ts).cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(size)))


def bucket_end(start: Column | str, granularity: Column | str) -> Column:
    size = F.create_map(*[F.lit(x) for kv in GRANULARITY.items() for x in kv])
    kind = F.lit(granularity) if isinstance(granularity, str) and granularity in GRANULARITY else col(granularity)
    return F.timestamp_seconds(F.unix_timestamp(col(start)) + size[kind])


def freshness(last: Column | str, interval_s: Column | str, now: Column) -> Column:
    """FRESH within twice the interval, else STALE; UNKNOWN without a success or an interval."""
    age = F.unix_timestamp(now) - F.unix_timestamp(col(last))
    return F.when(col(last).isNull() | col(interval_s).isNull(), "UNKNOWN").when(age <= 2 * col(interval_s), "FRESH").otherwise("STALE")


def heartbeat(last: Column | str, stale_s: Column | int, now: Column) -> Column:
    """FRESH for stale_s seconds after a heartbeat, then STALE; UNKNOWN without one."""
    age = F.unix_micros(now) - F.unix_micros(col(last))
    return F.when(col(last).isNull(), "UNKNOWN").when(age <= stale_s * 1_000_000, "FRESH").otherwise("STALE")


def union_refs(*arrays: Column | str, cap: int = 64) -> Column:
    """The members of the arrays in order of first sight, `cap` at most; a null array counts as empty."""
    return F.slice(F.array_distinct(F.concat(*[F.coalesce(col(a), F.array().cast("array<string>")) for a in arrays])), 1, cap)


def harvest_cvss(json: Column | str) -> Column:
    """CVSS versions by the metric keys that a JSON text holds; the same text as a value is no key."""
    text = F.coalesce(col(json), F.lit(""))
    keys = {"cvssMetricV2": "2.0", "cvssMetricV30": "3.0", "cvssMetricV31": "3.1", "cvssMetricV40": "4.0"}
    return F.array_compact(F.array(*[F.when(text.rlike(rf'"{k}"\s*:'), v) for k, v in keys.items()]))


def config_counts(json: Column | str, depth: int = 5) -> Column:
    """struct(nodes, matches) of the configurations in a JSON text: their nodes, children of up to `depth` levels, and the
    match criteria of all of these."""
    node = "struct<cpeMatch:array<struct<criteria:string>>>"
    for _ in range(depth - 1):
        node = f"struct<cpeMatch:array<struct<criteria:string>>,children:array<{node}>>"
    own = lambda rows, name: F.flatten(F.transform(rows, lambda x: F.coalesce(x[name], F.array())))
    rows, nodes, matches = own(F.from_json(col(json), f"struct<configurations:array<struct<nodes:array<{node}>>>>")["configurations"], "nodes"), F.lit(0), F.lit(0)
    zero = lambda c: F.coalesce(c, F.lit(0))
    for level in range(depth):
        nodes = nodes + zero(F.array_size(rows))
        matches = matches + zero(F.aggregate(rows, F.lit(0), lambda a, n: a + F.coalesce(F.array_size(n["cpeMatch"]), F.lit(0))))
        if level < depth - 1:
            rows = own(rows, "children")
    return F.struct(nodes.alias("nodes"), matches.alias("matches"))


def v4_number(ip: Column | str) -> Column:
    """The address as a number, null if it is none."""
    octet = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    part = F.split(col(ip), r"\.")
    number = sum((part[i].try_cast("bigint") * (256 ** (3 - i)) for i in range(4)), F.lit(0).cast("bigint"))
    return F.when(col(ip).rlike(rf"^{octet}(\.{octet}){{3}}$"), number)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is evaluated once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def address_bits(ip: Column | str) -> Column:
    """The address as text: its family (4 or 6) and its 32 or 128 bits; null if it is none. A prefix of length n holds it if
    their first n + 1 characters agree. IPv6 may be compressed, in either case, with an IPv4 tail."""
    whole = F.lower(col(ip))
    last = F.lpad(F.lower(F.hex(v4_number(F.regexp_extract(whole, r"([0-9.]+)$", 1)))), 8, "0")
    dotted = F.concat(F.regexp_replace(whole, r"[0-9.]+$", ""), let(last, lambda x: F.concat(F.substring(x, 1, 4), F.lit(":"), F.substring(x, 5, 4))))
    plain = F.when(F.instr(whole, ".") > 0, dotted).otherwise(whole)
    groups = lambda half: F.filter(F.split(F.coalesce(half, F.lit("")), ":"), lambda g: g != "")
    shape = r"^([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?(::([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?)?$"
    none = F.array().cast("array<string>")

    def filled(halves: Column) -> Column:
        """The eight groups; fewer or more where the address is none."""
        left, right = groups(F.get(halves, F.lit(0))), groups(F.get(halves, F.lit(1)))
        gap = lambda n: F.when((F.size(halves) > 1) & (n > 0), F.array_repeat(F.lit("0"), n)).when(F.size(halves) > 1, F.array_repeat(F.lit("0"), 9)).otherwise(none)
        return let(F.struct(left.alias("l"), right.alias("r")), lambda x: F.concat(x["l"], gap(F.lit(8) - F.size(x["l"]) - F.size(x["r"])), x["r"]))

    bits = lambda every: F.when(F.size(every) == 8, F.concat(F.lit("6"), F.array_join(F.transform(every, lambda g: F.lpad(F.conv(g, 16, 2), 16, "0")), "")))
    v6 = let(plain, lambda p: F.when(p.rlike(shape), let(filled(F.split(p, "::")), bits)))
    return let(v4_number(ip), lambda n: F.when(n.isNotNull(), F.concat(F.lit("4"), F.lpad(F.bin(n), 32, "0"))).otherwise(v6))
