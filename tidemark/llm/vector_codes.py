"""Vector codes: a codebook for each part of the vectors, fitted by a dual-tree Lloyd iteration in whole numbers.

Each block of a partition builds a tree over its vectors' parts (boxes, with cached sums and counts) and walks it together
with a tree over the codebook's entries. Bounds on the distance between two nodes prune combinations; where one entry is left
for a node, its cached sum and count go to that entry at once; leaves that stay uncertain compare exact integer distances.
Boxes, bounds and distances are integers, so the result doesn't depend on blocks or partitions. A pass hands on a sum for
each part and entry of a task, and the driver holds the codebooks alone, which are as large as the parameters say.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import spread, written

#: Vectors that one tree is built over, and parts in a leaf.
BLOCK_ROWS, LEAF = 8192, 16
#: Components lie below this, so that integer distances of vectors of any usual size fit 64 bits.
LARGEST = 2**18


class Boxes:
    """A balanced tree over integer points: `order` sorts the points into leaves, and every node is a range of that order.
    Level k has 2**k nodes. low, high, sums and sizes are lists by level; leaves hold at most `leaf` points, or fewer than two
    times as many where the points are no power of two."""

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        depth = max(0, (max(n, 1) // leaf).bit_length() - 1) if leaf > 1 else n.bit_length() - 1
        order = np.arange(n)
        self.starts = [(np.arange(2**k + 1) * n) >> k for k in range(depth + 1)]
        for k in range(depth):
            starts = self.starts[k]
            held = points[order]
            wide = np.maximum.reduceat(held, starts[:-1]) - np.minimum.reduceat(held, starts[:-1])
            node = np.repeat(np.arange(2**k), np.diff(starts))
            order = order[np.lexsort((held[np.arange(n), wide.argmax(1)[node]], node))]
        self.order, self.points, self.depth = order, points[order], depth
        ahead = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(self.points, 0)])
        self.low = [np.minimum.reduceat(self.points, s[:-1]) for s in self.starts]
        self.high = [np.maximum.reduceat(self.points, s[:-1]) for s in self.starts]
        self.sums = [ahead[s[1:]] - ahead[s[:-1]] for s in self.starts]
        self.sizes = [np.diff(s) for s in self.starts]


def near_and_far(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds on the squared distance between any point of one box and any of another, row by row."""
    apart = np.maximum(0, np.maximum(low - high2, low2 - high))
    reach = np.maximum(high - low2, high2 - low)
    return (apart * apart).sum(1), (reach * reach).sum(1)


def firsts(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))


def least_of(values: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """For each run of equal groups, the place of its first smallest value."""
    begins = firsts(groups)
    run = np.cumsum(np.concatenate([[0], groups[1:] != groups[:-1]]))
    smallest = np.flatnonzero(values == np.minimum.reduceat(values, begins)[run])
    return smallest[firsts(run[smallest])]


def children(pairs: np.ndarray) -> np.ndarray:
    return np.repeat(pairs * 2, 2) + np.tile([0, 1], len(pairs))


def assign(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The nearest entry of each point (ties to the lower index), the sums and counts of the points of each entry, and how
    many points were assigned with a whole node. points and entries are integers of one width."""
    n, k = len(points), len(entries)
    # An entry that repeats an earlier one never wins.
    kinds = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    tree, own = Boxes(points, LEAF), Boxes(entries[kinds], 1)
    place = np.empty(n, np.int64)
    sums, counts, whole = np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64), 0

    # Both trees go down together, until a node of the second is one entry.
    p, e, level = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    for own_level in range(own.depth + 1):
        if own_level:
            p, e = np.repeat(p, 2), children(e)
            if level < tree.depth:
                level += 1
                p, e = children(p), np.repeat(e, 2)
                at = np.lexsort((e, p))
                p, e = p[at], e[at]
        near, far = near_and_far(tree.low[level][p], tree.high[level][p], own.low[own_level][e], own.high[own_level][e])
        begins = firsts(p)
        bound = np.repeat(np.minimum.reduceat(far, begins), np.diff(np.append(begins, len(p))))
        p, e = p[near <= bound], e[near <= bound]
    # Ranges of one or two entries become entries.
    spans = own.starts[own.depth]
    size = np.diff(spans)[e]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    p, e = np.repeat(p, size), kinds[own.order[np.repeat(spans[e], size) + inside]]

    while len(p):
        at = np.lexsort((e, p))
        p, e = p[at], e[at]
        low, high = tree.low[level][p], tree.high[level][p]
        _, far = near_and_far(low, high, entries[e], entries[e])
        begins = firsts(p)
        run = np.cumsum(np.concatenate([[0], p[1:] != p[:-1]]))
        best = e[least_of(far, p)][run]
        # The largest lead that any point of the box can give an entry over the best one: it is linear in the point.
        toward = entries[e] - entries[best]
        lead = (entries[best] ** 2).sum(1) - (entries[e] ** 2).sum(1) + 2 * np.where(toward > 0, high * toward, low * toward).sum(1)
        stays = (lead > 0) | ((lead == 0) & (e < best)) | (e == best)
        p, e = p[stays], e[stays]
        begins = firsts(p)
        alone = np.diff(np.append(begins, len(p))) == 1
        for node, entry in zip(p[begins[alone]].tolist(), e[begins[alone]].tolist()):
            a, b = tree.starts[level][node], tree.starts[level][node + 1]
            place[a:b] = entry
            sums[entry] += tree.sums[level][node]
            counts[entry] += b - a
            whole += b - a
        open_ = ~np.repeat(alone, np.diff(np.append(begins, len(p))))
        p, e = p[open_], e[open_]
        if level == tree.depth:
            break
        level += 1
        p, e = children(p), np.repeat(e, 2)

    if len(p):  # uncertain leaves: exact distances to the entries that are left for each
        starts, begins = tree.starts[level], firsts(p)
        per = np.diff(np.append(begins, len(p)))
        nodes = p[begins]
        sizes = starts[nodes + 1] - starts[nodes]
        many = sizes * per
        node = np.repeat(np.arange(len(nodes)), many)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        x = starts[nodes][node] + nth // per[node]
        entry = e[begins[node] + nth % per[node]]
        gap = tree.points[x] - entries[entry]
        pick = least_of((gap * gap).sum(1), x)
        place[x[pick]] = entry[pick]
        np.add.at(sums, entry[pick], tree.points[x[pick]])
        np.add.at(counts, entry[pick], 1)
    out = np.empty(n, np.int64)
    out[tree.order] = place
    return out, sums, counts, whole


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(256 x), followed by zeros up to a width that the parts divide."""
    flat = np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)
    x = np.floor(flat * 256).astype(np.int64)
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined into blocks of BLOCK_ROWS or somewhat more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def sound(vector_col: str) -> Column:
    """Whether a vector has components, all of them finite and below LARGEST."""
    inside = lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False))
    return F.coalesce((F.size(vector_col) > 0) & F.forall(vector_col, inside), F.lit(False))


def fit_codebooks(kept: DataFrame, id_col: str, vector_col: str, parts: int, entries: int, rounds: int) -> np.ndarray | None:
    """Codebooks as an array [part, entry, component], or None of an empty table. kept has sound vectors of one length only."""
    first = kept.select(id_col, vector_col).orderBy(F.asc_nulls_last(id_col), vector_col).limit(entries).collect()
    if not first:
        return None
    start = pa.array([r[vector_col] for r in first], type=pa.list_(pa.float64()))
    width = -(-len(first[0][vector_col]) // parts) * parts
    books = whole_numbers(start, width).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    size = width // parts
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("n", T.LongType())])
    for _ in range(rounds):

        def totals(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for block in blocks(batches):
                x = whole_numbers(block.column(0).chunk(0), width)
                for part in range(parts):
                    _, s, c, _ = assign(np.ascontiguousarray(x[:, part * size : part * size + size]), books[part])
                    sums[part] += s
                    counts[part] += c
            part, entry = np.nonzero(counts)
            told = pa.array(list(sums[part, entry]), type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), told, pa.array(counts[part, entry], pa.int64())], ["part", "entry", "sums", "n"])

        told = kept.select(vector_col).mapInArrow(totals, schema)
        summed = told.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(size)])
        books = books.copy()
        for r in summed.collect():  # at most parts * entries rows
            books[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(size)]
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """One row per kept vector: id, code (two hex digits a part), error (squared distance to what the code stands for),
    label_error (error summed over equal labels, nulls together), codebooks_sha256.

    Codebooks begin as the parts of the `entries` smallest ids; fewer vectors make a smaller codebook. Vectors that are null
    or empty, hold null or non-finite components or one of 2**18 or more, and those of another length than the vector of the
    smallest id have no code and give no row. A length that `parts` doesn't divide is filled up with zeros. A null id comes
    last and gets a code like any other; rows of one id each get theirs, in the order of their vectors where they begin a
    codebook. At most 256 entries have a code of two digits. An empty table gives an empty table; other columns don't matter.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label")).where(sound("v"))
    first = rows.orderBy(F.asc_nulls_last("id"), "v").select(F.size("v")).limit(1).collect()
    length = first[0][0] if first else 0
    kept = rows.where(F.size("v") == length)
    books = fit_codebooks(kept, "id", "v", parts, entries, rounds)
    if books is None:
        books = np.zeros((parts, 1, 1), np.int64)
    size = books.shape[2]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    kind = rows.schema
    schema = T.StructType([kind["id"], kind["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            x = whole_numbers(block.column("v").chunk(0), parts * size)
            codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for part in range(parts):
                own = np.ascontiguousarray(x[:, part * size : part * size + size])
                place = assign(own, books[part])[0]
                codes[:, part] = place
                error += ((own - books[part][place]) ** 2).sum(1)
            text = [row.tobytes().hex() for row in codes]
            yield pa.RecordBatch.from_arrays([block.column("id").chunk(0), block.column("label").chunk(0), pa.array(text, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    coded = written(kept.mapInArrow(encode, schema), "codes")
    per_label = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(spread(per_label, "l"), F.col("label").eqNullSafe(F.col("l")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
