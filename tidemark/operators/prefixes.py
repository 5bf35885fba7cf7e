"""Longest-prefix match by equality: packed addresses are masked at the lengths that occur in the table, and met there.

An address is two 64-bit numbers. The lengths of a prefix table are at most 33 + 129; those that occur are read first, as two rows,
and each address makes one row for each of them, however many the prefixes are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import address_bits, bucket_start, let
from tidemark.operators.routing import tagged

NET = ("_family", "_n", "_hi", "_lo")


def packed(address: Column) -> Column:
    """struct(family, size, hi, lo) of an address, null if it is none: its bits from the left, zeros behind them."""
    number = lambda bits, start: F.conv(F.substring(bits, start, 64), 2, -10).cast("long")
    return let(
        address_bits(address),
        lambda b: F.when(
            b.isNotNull(),
            let(F.rpad(F.substr(b, F.lit(2)), 128, "0"), lambda x: F.struct(F.left(b, F.lit(1)).alias("family"), (F.length(b) - 1).alias("size"), number(x, 1).alias("hi"), number(x, 65).alias("lo"))),
        ),
    )


def masked(hi: Column, lo: Column, n: Column) -> tuple[Column, Column]:
    """The first n bits of an address, 0 to 128."""
    ones = lambda k: F.call_function("shiftleft", F.lit(-1).cast("long"), k)
    first = F.when(n <= 0, F.lit(0).cast("long")).when(n >= 64, hi).otherwise(hi.bitwiseAND(ones((64 - n).cast("int"))))
    second = F.when(n <= 64, F.lit(0).cast("long")).otherwise(lo.bitwiseAND(ones((128 - n).cast("int"))))
    return first, second


def networks(prefixes: DataFrame, prefix: str) -> DataFrame:
    """prefixes with NET, the packed network of each; host bits are masked. Texts that are no prefix give no row."""
    parts = F.split(prefix, "/")
    length = F.get(parts, F.lit(1)).try_cast("int")
    own = prefixes.withColumn("_p", F.when(F.size(parts) == 2, packed(parts[0]))).withColumn("_n", length)
    own = own.where(F.col("_p").isNotNull() & F.col("_n").between(0, F.col("_p.size")))
    hi, lo = masked(F.col("_p.hi"), F.col("_p.lo"), F.col("_n"))
    return own.withColumns({"_family": F.col("_p.family"), "_hi": hi, "_lo": lo}).drop("_p")


def once(rows: DataFrame, text: str) -> DataFrame:
    """The distinct texts of a column, as an aggregate's output."""
    return rows.groupBy(F.col(text).alias("_text")).agg(F.max(text).alias(text)).select(text)


def tried(ips: DataFrame, ip: str, known: DataFrame) -> DataFrame:
    """Each distinct address with NET of every network that could hold it and whose length occurs in `known`."""
    lengths = known.groupBy("_family").agg(F.collect_set("_n").alias("_lengths"))  # two rows of at most 33 and 129 lengths
    # Packed from an aggregate's output, so that no filter moves below it and packs every row's address.
    none = F.struct(F.lit("").alias("family"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("lo"))
    own = once(ips, ip).withColumn("_p", F.coalesce(packed(F.col(ip)), none)).withColumn("_family", F.col("_p.family"))
    met = own.join(F.broadcast(lengths), "_family").select(ip, "_family", "_p", F.explode("_lengths").alias("_n"))
    hi, lo = masked(F.col("_p.hi"), F.col("_p.lo"), F.col("_n"))
    return met.select(ip, "_family", "_n", hi.alias("_hi"), lo.alias("_lo"))


def longest(ips: DataFrame, ip: str, table: DataFrame, prefix: str, keep: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """The most specific prefix of `table` that holds each distinct address (and of each value of `by`, columns of the table):
    ip, by, covering, and the columns of `keep`. Of one network written in two ways the smaller text is named; an address that
    no prefix holds gives no row."""
    said = F.min(F.struct(F.col(prefix).alias("covering"), *keep)).alias("_said")
    known = networks(table, prefix).groupBy(*by, *NET).agg(said)
    best = tried(ips, ip, known).join(known, list(NET)).groupBy(ip, *by).agg(F.max_by("_said", "_n").alias("_said"))
    return best.select(ip, *by, "_said.*")


def covering_prefix(ips: DataFrame, prefixes: DataFrame, ip: str = "ip", prefix: str = "prefix") -> DataFrame:
    """ips with the most specific prefix that holds each (null: none)."""
    return ips.join(longest(ips, ip, once(prefixes, prefix), prefix), ip, "left")


def covering_minutes(ips: DataFrame, obs: DataFrame, ip: str = "ip", at: str = "observed_at") -> DataFrame:
    """The most specific prefix of each minute that holds each address: ip, bucket_start, covering, announced, withdrawn. A
    minute without such a prefix gives no row."""
    kinds = F.concat(*[tagged(k, F.coalesce(F.col(k), F.array().cast("array<string>"))) for k in ("announced", "withdrawn")])
    rows = obs.select(bucket_start(at, "MINUTE").alias("bucket_start"), F.explode(kinds).alias("m")).groupBy("bucket_start", F.col("m.member").alias("prefix")).agg(
        *[F.bool_or(F.col("m.kind") == k).alias(k) for k in ("announced", "withdrawn")]
    )
    return longest(ips, ip, rows, "prefix", keep=["announced", "withdrawn"], by=["bucket_start"])


def geo_by_prefix(obs: DataFrame, table: DataFrame, ip: str = "ip") -> DataFrame:
    """obs with country and covering: what a table of prefixes (prefix, country, bogon) says of each address. The most specific
    prefix decides: where it is a bogon, or has no country, nothing is asserted, even if a wider one has; such rows, and those
    that no prefix holds, are left out."""
    said = longest(obs, ip, table.select("prefix", "country", F.coalesce("bogon", F.lit(False)).alias("bogon")), "prefix", keep=["country", "bogon"])
    return obs.join(said.where("country is not null and not bogon").drop("bogon"), ip)
