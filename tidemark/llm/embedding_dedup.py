"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Vectors of one label are first grouped into classes of bit-equal vectors, so copies are never compared with each other.
Classes are dealt into tiles of a bounded number of rows; a task multiplies one pair of tiles. Each unit vector x is held
as s*q with q int8; with e = x - s*q, Cauchy-Schwarz gives |x.y - sq_x.sq_y| <= |e_x||sq_y| + |sq_x||e_y| + |e_x||e_y|.
Only pairs whose product plus that bound reaches the threshold are computed again in double precision. A task returns,
for each of its rows, the number of linked vectors and one representative, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, spread, written

#: Room for the rounding of the double-precision bound itself.
SLACK = 1e-9
#: Candidate pairs that are computed again at once.
RECHECK = 1 << 16


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors and norms of their errors."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(unit - decoded, axis=1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their length in double precision; first by their largest part, against overflow."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def tile_links(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i of left, j of right) of the pairs with cosine >= threshold; rows are unit vectors."""
    (ql, sl, nl, el), (qr, sr, nr, er) = quantise(left), quantise(right)
    # float32 holds sums of int8 products exactly up to 2**24, which is 1,040 dimensions; beyond, float64 is used.
    kind = np.float32 if left.shape[1] <= 1040 else np.float64
    rough = (ql.astype(kind) @ qr.astype(kind).T).astype(np.float64) * sl[:, None] * sr[None, :]
    bound = np.outer(el, nr) + np.outer(nl, er) + np.outer(el, er) + SLACK
    i, j = np.nonzero(rough + bound >= threshold)
    keep = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), RECHECK):
        part = slice(at, at + RECHECK)
        keep[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]]) >= threshold
    return i[keep], j[keep]


def smallest_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links i-j, the smallest node reachable from each."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    tile_rows: int = 1024,
) -> DataFrame:
    """One row per vector: its id, n_links, component_id and kept.

    Vectors link when their labels are equal and not null and their cosine is at least threshold. A vector that is null,
    empty, zero, or holds null or non-finite components, links with nothing and is a component of its own; so does one
    of another length. Repeated rows each count as a vector. A null id never names a component unless all ids in it are
    null. Other columns of the input are ignored; an empty table gives an empty table.
    """
    size = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("block"), F.col(vector_col).alias("x")
    ).withColumn("dim", F.size("x"))
    sound = (
        F.col("block").isNotNull()
        & F.col("x").isNotNull()
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists("x", lambda c: c != 0)
    )
    key = F.concat_ws("-", "block", "dim", F.hex(F.xxhash64("x")), F.hex(F.xxhash64(F.lit(1), "x")))
    keyed = size.withColumn("node", F.when(F.coalesce(sound, F.lit(False)), key))
    classes = written(
        keyed.where("node is not null")
        .groupBy("node", "block", "dim")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("x").alias("x")),
        "vector-classes",
    )
    tiles = classes.groupBy("block", "dim").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    dealt = (
        classes.join(tiles, ["block", "dim"])
        .withColumn("own", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("block", "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "copies", "x")
    )

    def links(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable").reset_index(drop=True)
        unit = unit_rows(np.stack(group["x"].to_numpy()).astype(np.float64))
        own, ti, tj = group["own"].to_numpy(), group["i"].iloc[0], group["j"].iloc[0]
        rows_i, rows_j = np.flatnonzero(own == ti), np.flatnonzero(own == tj)
        i, j = tile_links(unit[rows_i], unit[rows_j], threshold)
        i, j = rows_i[i], rows_j[j]
        if ti == tj:
            i, j = i[i < j], j[i < j]
        copies = group["copies"].to_numpy()
        n = np.bincount(i, copies[j], len(own)) + np.bincount(j, copies[i], len(own))
        root, node = smallest_roots(len(own), i, j), group["node"].to_numpy()
        on = np.flatnonzero(n)
        return pd.DataFrame({"node": node[on], "links": n[on].astype(np.int64), "peer": node[root[on]]})

    found = written(
        dealt.groupBy("block", "dim", "i", "j").applyInPandas(links, "node string, links long, peer string"), "vector-links"
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    stats = (
        classes.select("node", "least", "copies")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    )
    named = stats.join(spread(stats.groupBy("root").agg(F.min("least").alias("component")), "root"), "root").select("node", "links", "component")
    out = keyed.select("id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
