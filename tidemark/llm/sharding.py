"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of places. A row's place follows from its id; a shard owns the places before each of its
virtual nodes. What Spark gathers is the bytes and rows of each place (a partial aggregate, at most ring_places rows,
whatever the input); the loads are bounded on that summary: a place whose shard would pass the bound continues clockwise
to the next shard with room, so only overflow moves. Rows are then numbered inside their place, and a place's first
number follows from the summary, so no task sees a whole shard.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written


def ring_order(shards: int, virtual_nodes: int, places: int) -> list[list[int]]:
    """For every place, all shards in the order in which they are met clockwise from it."""
    point = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}:{v}".encode()).digest()[:8], "big") % places
    at: dict[int, list[int]] = {}
    for s in range(shards):
        for v in range(virtual_nodes):
            at.setdefault(point(s, v), []).append(s)
    order: list[int] = list(range(shards))
    out: list[list[int]] = [[]] * places
    for turn in (0, 1):  # the second turn knows what lies beyond place 0
        for p in range(places - 1, -1, -1):
            for s in reversed(at.get(p, [])):
                order = [s, *(x for x in order if x != s)]
            if turn:
                out[p] = order
    return out


def bounded_loads(weights: dict[int, int], shards: int, virtual_nodes: int, places: int, slack: float) -> dict[int, int]:
    """Shard of each place. No shard passes (1 + slack) times the mean unless a place fits nowhere: it then goes to the
    least loaded shard. Heavy places are placed first, so the light ones fill what is left."""
    order, load = ring_order(shards, virtual_nodes, places), [0] * shards
    bound = (1 + slack) * sum(weights.values()) / shards
    out = {}
    for place, weight in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        to = next((s for s in order[place] if load[s] + weight <= bound), None)
        if to is None:
            to = min(range(shards), key=lambda s: (load[s], s))
        load[to] += weight
        out[place] = to
    return out


def shard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    virtual_nodes: int = 256,
    ring_places: int = 65536,
    slack: float = 0.001,
) -> DataFrame:
    """One row per row of docs: id, size, text_crc32, law, shard, slot, grown_shard (null: the law is `bytes`).

    size is the UTF-8 bytes of the text (null: none) plus 8. Rows whose id is null are spread by their text. Rows with
    equal ids share a place, except that a null id counts as no id. Equal texts under different ids fall where their ids do:
    they have one size and text_crc32, and no shard of their own. An empty table gives an empty table; other columns of
    docs are ignored.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("crc")
    )
    turn = F.when(F.col("id").isNull(), F.xxhash64("size", "crc")).otherwise(F.xxhash64("id"))
    base = written(base.withColumn("place", F.pmod(turn, F.lit(ring_places)).cast("int")), "ring")
    seen = base.groupBy("place").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).toPandas().sort_values("place")
    owner = bounded_loads(dict(zip(seen["place"].tolist(), seen["bytes"].tolist())), shards, virtual_nodes, ring_places, slack)
    seen["shard"] = seen["place"].map(owner).astype("int32")
    seen["first"] = seen.groupby("shard")["n"].cumsum() - seen["n"]
    table = spark.createDataFrame(seen[["place", "shard", "first"]].astype({"place": "int32", "first": "int64"}), "place int, shard int, first long") if len(seen) else spark.createDataFrame([], "place int, shard int, first long")
    numbered = base.withColumn("at", F.row_number().over(Window.partitionBy("place").orderBy("id", "crc", "size")) - 1)
    return numbered.join(F.broadcast(table), "place").select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("at")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
