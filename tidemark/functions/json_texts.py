"""JSON texts of any depth: one canonical text for equal values, raw records prepared from it, keys, and walks.

Texts are parsed into Spark's VARIANT, which holds an object's keys in the order of their UTF-16 units; writing it out again
sorts keys at every depth. Strings are told from the rest by patterns that match whole string literals from left to right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import col, let

#: A string literal, escapes included.
LITERAL = r'"(?:[^"\\]|\\.)*+"'
#: Kinds of failures, and the longest identity of a raw record.
SCHEMA_ERROR, TOO_LARGE, LONGEST_ID = "SCHEMA_ERROR", "PAYLOAD_LIMIT_EXCEEDED", 512
#: Versions by what a key contains, in any case.
CVSS = {"cvssmetricv2": "2.0", "cvssmetricv30": "3.0", "cvssmetricv31": "3.1", "cvssmetricv4": "4.0"}


def without_literals(text: Column) -> Column:
    return F.regexp_replace(text, LITERAL, '""')


def finite(text: Column) -> Column:
    """Whether every number with an exponent is finite as a double. Only such numbers can leave the range."""
    big = F.regexp_extract_all(without_literals(text), F.lit(r"-?[0-9]+(?:\.[0-9]+)?[eE]\+?[0-9]{2,}"), F.lit(0))
    return ~F.exists(big, lambda x: F.abs(x.try_cast("double")) == float("inf"))


def canonical_json(json: Column | str) -> Column:
    """The one text of a JSON value: no spaces, keys sorted at every depth, numbers without needless zeros, strings as they are.
    Null for what is no JSON, repeats a key in an object, or holds a number that isn't finite.

    Numbers without an exponent are exact decimals of up to 38 digits (1.50 is 1.5, -0 is 0); others are doubles in the shortest
    form that reads back, whole ones without a fraction.
    """
    text = F.to_json(F.try_parse_json(col(json)))
    whole = F.regexp_replace(text, rf"({LITERAL})|(-?[0-9]+)\.0(?=[,}}\]]|$)", "$1$2")
    return F.when(finite(col(json)), whole)


def prepare_records(df: DataFrame, record_id: str, payload: str, max_bytes: int) -> DataFrame:
    """df with its record id trimmed, payload_json, payload_bytes, payload_sha256, and failure: null, or why the record is none.
    What fails has no payload columns, so that nothing is kept of a part of it."""
    told = canonical_json(payload)
    out = df.withColumn(record_id, F.trim(F.col(record_id).cast("string"))).withColumn("_j", told)
    size = F.octet_length("_j")
    no_id = F.coalesce(F.length(record_id), F.lit(0)).between(1, LONGEST_ID)
    failure = F.when(~no_id | F.col("_j").isNull(), SCHEMA_ERROR).when(size > max_bytes, TOO_LARGE)
    out = out.withColumn("failure", failure)
    good = lambda c: F.when(F.col("failure").isNull(), c)
    return out.withColumns({"payload_json": good(F.col("_j")), "payload_bytes": good(size), "payload_sha256": good(F.sha2("_j", 256))}).drop("_j")


def keys_of(json: Column | str) -> Column:
    """All keys of a JSON text's objects at any depth, in their order, repeated ones too, as they are written (escapes kept).
    A string that stands as a value is no key."""
    found = F.regexp_extract_all(col(json), F.lit(rf"({LITERAL})\s*(:?)"), F.lit(0))
    keys = F.filter(found, lambda x: F.endswith(x, F.lit(":")))
    return F.transform(keys, lambda x: F.regexp_extract(x, r'^"(.*)"\s*:$', 1))


def cvss_versions(json: Column | str) -> Column:
    """Sorted CVSS versions that a key at any depth names: a key counts if it contains the metric's name, in any case."""
    named = lambda part: lambda k: F.contains(k, F.lit(part))
    keys = F.transform(keys_of(json), lambda k: F.lower(k))
    return let(keys, lambda own: F.array_compact(F.array(*[F.when(F.exists(own, named(part)), version) for part, version in CVSS.items()])))


def walk(df: DataFrame, key: Sequence[str], json: str, only: str | None = None, levels: int = 1000) -> DataFrame:
    """Every value inside the JSON texts of df, at any depth: key, depth (0: the whole text), path, name (of a member; null for
    elements and the whole), at (place in its array or object), kind (OBJECT, ARRAY or a scalar's), value (VARIANT).

    `only` is a pattern of member names to go down into; elements of arrays are always visited. A recursive query makes a level
    from the one before it until one is empty; levels bounds it for safety and fails beyond. Texts that aren't JSON give no row.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    own = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], F.try_parse_json(F.col(json)).alias("v")).where("v is not null")
    names = ", ".join(f"k{i}" for i in range(len(key)))
    condition = "" if only is None else "WHERE e.key IS NULL OR e.key RLIKE :only"
    rows = spark.sql(
        f"""WITH RECURSIVE w({names}, depth, path, name, at, v) MAX RECURSION LEVEL {int(levels)} AS (
          SELECT {names}, 0, '$', CAST(NULL AS STRING), 0, v FROM {{own}}
          UNION ALL SELECT {", ".join(f"w.k{i}" for i in range(len(key)))}, w.depth + 1, concat(w.path, CASE WHEN e.key IS NULL THEN concat('[', e.pos, ']') ELSE concat('.', e.key) END), e.key, e.pos, e.value
          FROM w, LATERAL variant_explode(w.v) e {condition})
          SELECT * FROM w""",
        args={} if only is None else {"only": only},
        own=own,
    )
    kind = F.upper(F.regexp_extract(F.schema_of_variant("v"), "^([A-Za-z]+)", 1))
    return rows.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(key)], "depth", "path", "name", "at", kind.alias("kind"), F.col("v").alias("value"))


#: What a value below configurations is.
PLAIN, NODE, MATCH = 0, 1, 2


def inside(value: Column) -> Column:
    """Values one step below a value of configurations, each with what it is; nulls among them where there are none."""
    within = lambda path: F.try_variant_get(value, path, "array<variant>")
    told = lambda v, what: F.struct(v.alias("v"), F.lit(what).alias("what"))
    elements = lambda path, what: F.transform(within(path), lambda x: told(x, what))
    # A member that is no array may hold objects with arrays, but is no node or criterion itself.
    member = lambda name, what: F.coalesce(elements(f"$.{name}", what), F.array(told(F.try_variant_get(value, f"$.{name}", "variant"), PLAIN)))
    return F.coalesce(elements("$", PLAIN), F.concat(member("nodes", NODE), member("children", NODE), member("cpeMatch", MATCH)))


def configuration_counts(df: DataFrame, key: Sequence[str], json: str, root: str = "configurations") -> DataFrame:
    """key, nodes, matches of the configurations that each JSON text holds, nested to any depth: elements of `nodes` and
    `children` count as nodes, elements of `cpeMatch` of every object on the way as match criteria. Texts without any have
    zeros; texts that aren't JSON give no row.

    Each text is gone down by itself, level by level: a level is the array of values that the one before holds. A text has no
    more levels than opening brackets, and levels behind the last are empty.
    """
    count = lambda level, what: F.size(F.filter(level, lambda x: x["what"] == what)).cast("long")

    def down(so_far: Column, _: Column) -> Column:
        below = F.flatten(F.transform(F.filter(so_far["level"], lambda x: (x["what"] != MATCH) & x["v"].isNotNull()), lambda x: inside(x["v"])))
        level = F.filter(below, lambda x: x["v"].isNotNull())
        after = F.struct(level.alias("level"), (so_far["nodes"] + count(so_far["level"], NODE)).alias("nodes"), (so_far["matches"] + count(so_far["level"], MATCH)).alias("matches"))
        return F.when(F.size(so_far["level"]) > 0, after).otherwise(so_far)

    def counted(parsed: Column) -> Column:
        first = F.array(F.struct(F.try_variant_get(parsed, f"$.{root}", "variant").alias("v"), F.lit(PLAIN).alias("what")))
        start = F.struct(first.alias("level"), F.lit(0).cast("long").alias("nodes"), F.lit(0).cast("long").alias("matches"))
        levels = F.length(json) - F.length(F.translate(json, "[{", "")) + 2
        return F.when(parsed.isNotNull(), F.aggregate(F.sequence(F.lit(1), levels), start, down, lambda x: F.struct(x["nodes"], x["matches"])))

    whole = df.select(*key, let(F.try_parse_json(F.col(json)), counted).alias("_n"))
    return whole.groupBy(*key).agg(F.sum("_n.nodes").alias("nodes"), F.sum("_n.matches").alias("matches")).where("nodes is not null")
