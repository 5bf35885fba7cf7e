"""Self-join of texts by the Jaccard similarity of their word n-gram sets: size-banded tiles with bitmap signatures.

Texts with equal shingle sets are one node. Two nodes with similarity >= t share a shingle among the first
n - ceil(t n) + 1 of each, in any common order of all shingles; the order used puts frequent shingles last, so shared
boilerplate brings hardly any node together. Candidates then fall in two steps, so that a large group of near copies never
yields all its pairs:

1. every node is compared with the smallest node and with its neighbour in size among those that share a shingle;
2. nodes that share a shingle and still lie in different components are put into size-banded tiles, where bitmap signatures
   bound their overlap from above: bits of A that B lacks are missing from the overlap. A tile hands on a spanning forest of
   the components it may tie together, which makes clusters; the nodes of a cluster then meet in tiles with their sorted
   arrays, and a pair that its bitmaps don't rule out is intersected exactly, unless its ends are linked already.

Both steps end in the exact intersection of sorted arrays. No step drops or caps a group: a large one is dealt into tiles, and
a task hands on fewer rows than it holds components, however many pairs it compares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm.common import connected_components, discard, spread, text_batches, written

#: Shingle hashes that a task holds at once.
AT_ONCE = 4_000_000
WORD_MEMORY = 500_000
#: At most this many shingles count as frequent, since each holds more than this share of all.
FREQUENT = 1_000_000
#: Rows of a tile, and bytes of its sorted arrays, on average at most.
TILE_ROWS, TILE_BYTES = 256, 4 << 20
#: Rows of two numbers that are broadcast at most.
BROADCAST_ROWS = 500_000
#: Odd multipliers, one for each place in a shingle.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORD_MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: WordHashes, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text: A-Z lower-cased, words divided at bytes 20 and 09 to 0D."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = len(h) - n + 1
    mixed = h[:size] * PLACES[0]
    for k in range(1, n):
        mixed += h[k : k + size] * PLACES[k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= PLACES[5]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def node_key(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return int(np.array([xxhash.xxh3_64_intdigest(shingles.tobytes())], dtype=np.uint64).view(np.int64)[0])


def least_overlap(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Shingles that a set of n must share with any set it links with."""
    return -(-n * percent // 100)


def linked(size_a, size_b, both, percent: int):
    """100 * intersection >= percent * union."""
    return (100 + percent) * both >= percent * (size_a + size_b)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bits at hash modulo a power of two of at least twice the set's size, 256 at least, as bytes."""
    width = 256
    while width < 2 * len(shingles):
        width *= 2
    bits = np.zeros(width, dtype=bool)
    bits[(shingles % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(bits)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap that `size` bytes would hold: halves put over each other, as the width is a power of two."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def may_link(n_a: int, a: np.ndarray, n_b: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """For bitmaps of one width, a against the rows of b: whether size and missing bits leave a link possible."""
    over = np.minimum(n_a - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64), n_b - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))
    return linked(n_a, n_b, over, percent)


def as_signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def pass_sets(docs: DataFrame, n: int) -> DataFrame:
    """Rows of kind 0: id, text_key, n_shingles, node and bitmap of a document. Rows of kind 1: a shingle that several different
    texts of one task hold, and how many. Alone, a shingle of one text says nothing of frequency and stays in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, pool, held, met, kind = WordHashes(), [], 0, set(), pa.int64()

        def frequent() -> pa.RecordBatch:
            nonlocal held
            value, count = np.unique(np.concatenate(pool), return_counts=True)
            pool.clear()
            met.clear()
            held = 0
            value, count = value[count > 1], count[count > 1]
            size = len(value)
            return pa.RecordBatch.from_arrays([pa.array(np.ones(size, np.int32)), pa.nulls(size, kind), pa.nulls(size, pa.int64()), pa.array(count), as_signed(value), pa.nulls(size, pa.binary())], names=["kind", "id", "text_key", "n", "node", "bits"])

        for batch in batches:
            kind = batch.column(0).type
            size, node, bits = [], [], []
            for text in batch.column(2).to_pylist():
                found = shingle_set(text, hashes, n)
                size.append(len(found))
                node.append(node_key(found) if len(found) else None)
                bits.append(bitmap(found).tobytes() if len(found) else None)
                if len(found) and node[-1] not in met:
                    met.add(node[-1])
                    pool.append(found)
                    held += len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(size), np.int32)), batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary())], names=["kind", "id", "text_key", "n", "node", "bits"]
            )
            if held > AT_ONCE:
                yield frequent()
        if pool:
            yield frequent()

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"kind int, id {id_type}, text_key long, n long, node long, bits binary")


def pass_prefixes(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """A row for each of the first shingles of each node: x, node, n."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, met, late = WordHashes(), set(), frequent.value
        for batch in batches:
            parts, nodes, sizes = [], [], []
            for text in batch.column(0).to_pylist():
                found = shingle_set(text, hashes, n)
                node = node_key(found) if len(found) else None
                if node is None or node in met:
                    continue
                met.add(node)
                if len(met) > AT_ONCE:
                    met.clear()
                first = len(found) - least_overlap(len(found), percent) + 1
                if len(late):
                    at = np.minimum(np.searchsorted(late, found), len(late) - 1)
                    last = late[at] == found
                    found_in_order = np.concatenate([found[~last], found[last]])
                else:
                    found_in_order = found
                parts.append(found_in_order[:first])
                nodes.append(node)
                sizes.append(len(found))
            if parts:
                times = [len(p) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [as_signed(np.concatenate(parts)), pa.array(np.repeat(np.array(nodes, np.int64), times)), pa.array(np.repeat(np.array(sizes, np.int32), times))], names=["x", "node", "n"]
                )

    return docs.select("text").mapInArrow(run, "x long, node long, n int")


def shared_only(rows: DataFrame) -> DataFrame:
    """Of rows sorted by x, n, node within partitions: those whose x is held by two nodes or more, with the first node of
    their x and the one before them. The stream keeps one row back, never a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((0, 3), dtype=np.int64)  # the row held back
        center, behind = (0, 0), None  # first node and size of the running x; the row before the one held back

        def emit(table: np.ndarray, more: np.ndarray | None):
            """table's rows, given the row that follows them."""
            nonlocal center, behind
            x = table[:, 0]
            before = np.concatenate([[behind[0] if behind is not None else 0], x[:-1]])
            first = x != before
            if behind is None:
                first[0] = True
            after = np.concatenate([x[1:], [more[0] if more is not None else 0]])
            last = x != after
            if more is None:
                last[-1] = True
            at = np.where(first, np.arange(len(x)), -1)
            at = np.maximum.accumulate(at)
            own = at >= 0
            cn = np.where(own, table[np.maximum(at, 0), 1], center[0])
            cs = np.where(own, table[np.maximum(at, 0), 2], center[1])
            prev = np.concatenate([[behind[1] if behind is not None else 0], table[:-1, 1]])
            prev_n = np.concatenate([[behind[2] if behind is not None else 0], table[:-1, 2]])
            prev, prev_n = np.where(first, table[:, 1], prev), np.where(first, table[:, 2], prev_n)
            center, behind = (int(cn[-1]), int(cs[-1])), table[-1]
            on = ~(first & last)
            columns = [x, table[:, 1], table[:, 2], cn, cs, prev, prev_n]
            return pa.RecordBatch.from_arrays([pa.array(c[on], pa.int64()) for c in columns], names=["x", "node", "n", "center", "center_n", "prev", "prev_n"])

        def large(parts: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            pool, size = [], 0
            for part in parts:
                pool.append(np.column_stack([part.column(i).to_numpy().astype(np.int64) for i in range(3)]))
                size += part.num_rows
                if size >= 65536:
                    yield np.concatenate(pool)
                    pool, size = [], 0
            if pool:
                yield np.concatenate(pool)

        for rows_of in large(batches):
            table = np.concatenate([kept, rows_of])
            if len(table) > 1:
                same = np.zeros(len(table), dtype=bool)
                same[1:] = (table[1:, 0] == table[:-1, 0]) & (table[1:, 1] == table[:-1, 1])
                table = table[~same]
            if len(table) > 1:
                yield emit(table[:-1], table[-1])
            kept = table[-1:]
        if len(kept):
            yield emit(kept, None)

    schema = "x long, node long, n long, center long, center_n long, prev long, prev_n long"
    return rows.repartition("x").sortWithinPartitions("x", "n", "node").mapInArrow(run, schema)


def distinct_groups(shared: DataFrame) -> DataFrame:
    """Of shingles that the same nodes hold, only one: a passage that two texts share counts once, not once a shingle."""
    sets = shared.groupBy("x").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("t"))
    return shared.join(sets.groupBy("c", "s", "t").agg(F.min("x").alias("x")).select("x"), "x", "left_semi")


def pass_arrays(docs: DataFrame, n: int) -> DataFrame:
    """node and its shingles, of the given documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingle_set(t, hashes, n) for t in batch.column(0).to_pylist()]
            found = [f for f in found if len(f)]
            yield pa.RecordBatch.from_arrays([pa.array([node_key(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())], names=["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node long, shingles binary")


def beside(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """pairs a, b with columns of their nodes: <column>_a and <column>_b."""
    left = rows.select(F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = rows.select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return pairs.join(left, "a").join(right, "b")


def likely_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that their bitmaps don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, ba, bb = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))
            on = []
            for i in range(len(na)):
                x, y = np.frombuffer(ba[i], np.uint8), np.frombuffer(bb[i], np.uint8)
                size = min(len(x), len(y))
                on.append(bool(may_link(na[i], folded(x, size), np.array([nb[i]]), folded(y, size)[None, :], percent)[0]))
            yield batch.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    return beside(pairs, nodes, "n", "bits").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def linked_pairs(likely: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs that link, by the exact intersection of their sorted arrays. One document of each node is read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = []
            for x, y in zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                on.append(bool(linked(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    likely = written(likely, "likely")
    arrays = arrays_of(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct(), nodes, docs, words)
    out = written(beside(likely, arrays, "shingles").select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long"), "links")
    discard(arrays, likely)
    return out


class Forest(dict):
    """Union-find over components: the pairs that join two of its trees number fewer than the components it has met."""

    def find(self, x: int) -> int:
        top = x
        while (up := self.get(top, top)) != top:
            top = up
        while x != top:
            self[x], x = top, self[x]
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)
        return a != b


def size_band(percent: int) -> Column:
    """A band holds sizes within a factor 100/percent."""
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")


def dealt_into_tiles(rows: DataFrame, key: str, weight: Column, percent: int) -> DataFrame:
    """rows (key, node, n, root) dealt into size-banded pairs of tiles i, j, sorted by tile within partitions.

    A node is put into its own band and into the next, so two nodes that can link meet in the band of the larger. The number
    of tiles of a (key, band) is the sum of weight; those with one component, or none of whose nodes is at home there, go.
    """
    put = rows.withColumn("own_band", size_band(percent)).withColumn("band", F.explode(F.array("own_band", F.col("own_band") + 1)))
    home = (F.col("band") == F.col("own_band")).cast("int")
    sizes = put.groupBy(key, "band").agg(F.ceil(F.sum(weight)).cast("int").alias("tiles"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.max(home).alias("home"))
    sizes = sizes.where("lo < hi and home = 1").select(key, "band", "tiles")
    return (
        put.join(sizes.repartition(F.xxhash64(key, "band")), [key, "band"])
        .withColumn("tile", F.pmod(F.hash("node"), "tiles"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(F.col(key).alias("key"), "band", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "node", "n", "root", "own_band")
    )


def tile_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each pair of tiles, from batches sorted by tile."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        key = np.column_stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "band", "i", "j")])
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        for start, stop in zip(new[:-1], new[1:]):
            yield table.slice(start, stop - start)
        rest = table.slice(new[-1])
    if rest is not None:
        yield rest


def compared(group: pa.Table, table: np.ndarray, forest: Forest, percent: int, sure=None) -> list[tuple[int, int]]:
    """Pairs of roots that a group of two tiles ties together, fewer than its roots; table holds its rows' bitmaps.

    sure(k, rows) tells which of those rows link with row k; without it a pair that the bitmaps let pass is a tie.
    """
    tile, n, root, own = (group.column(c).to_numpy() for c in ("tile", "n", "root", "own_band"))
    i, j, band = (group.column(c)[0].as_py() for c in ("i", "j", "band"))
    tree = np.array([forest.find(r) for r in root.tolist()])
    out = []
    for k in range(len(n)):
        on = np.flatnonzero((tree[k + 1 :] != tree[k]) & ((own[k + 1 :] == band) | (own[k] == band))) + k + 1
        if i != j:
            on = on[tile[on] != tile[k]]
        on = on[100 * np.minimum(n[on], n[k]) >= percent * np.maximum(n[on], n[k])]
        if len(on):
            on = on[may_link(int(n[k]), table[k], n[on], table[on], percent)]
        if len(on) and sure is not None:
            on = on[sure(k, on)]
        for h in on.tolist():
            if tree[h] != tree[k]:
                forest.join(int(tree[h]), int(tree[k]))
                low, high = sorted((tree[h], tree[k]))
                tree[tree == high] = low
                out.append((int(root[k]), int(root[h])))
    return out


def ties(groups: Iterator[list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    for pairs in groups:
        if pairs:
            a, b = zip(*pairs)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def candidate_ties(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of roots, a spanning forest in each task of those that the bitmaps of rows (x, node, n, root) let link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def found(group: pa.Table) -> list[tuple[int, int]]:
            root = group.column("root").to_numpy()
            if len({forest.find(r) for r in root.tolist()}) < 2:
                return []
            bits = group.column("bits").to_pylist()
            width = min(map(len, bits))
            return compared(group, np.stack([folded(np.frombuffer(b, np.uint8), width) for b in bits]), forest, percent)

        yield from ties(map(found, tile_groups(batches)))

    dealt = dealt_into_tiles(rows, "x", F.lit(1 / TILE_ROWS), percent).join(nodes.select("node", "bits"), "node")
    return dealt.repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j", "node").mapInArrow(run, "a long, b long")


def cluster_ties(members: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of roots that a link ties together, a spanning forest in each task, from members (cluster, node, n, root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def found(group: pa.Table) -> list[tuple[int, int]]:
            root = group.column("root").to_numpy()
            if len({forest.find(r) for r in root.tolist()}) < 2:
                return []
            n = group.column("n").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            bits = [bitmap(x) for x in sets]
            width = min(map(len, bits))

            def sure(k: int, rows: np.ndarray) -> np.ndarray:
                own, flat = sets[k], np.concatenate([sets[h] for h in rows])
                same = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                both = np.add.reduceat(same, np.concatenate([[0], np.cumsum(n[rows])[:-1]]), dtype=np.int64)
                return linked(int(n[k]), n[rows], both, percent)

            return compared(group, np.stack([folded(b, width) for b in bits]), forest, percent, sure)

        yield from ties(map(found, tile_groups(batches)))

    weight = F.greatest(F.lit(1 / TILE_ROWS), F.col("n") * 8 / TILE_BYTES)
    dealt = dealt_into_tiles(members, "cluster", weight, percent).join(arrays, "node")
    return dealt.repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j", "node").mapInArrow(run, "a long, b long")


def arrays_of(ends: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """A written table of the sorted shingles of the given nodes. One document of each node is read again."""
    wanted = written(nodes.join(ends, "node").select(F.col("d.id").alias("wid"), F.col("d.text_key").alias("wkey")), "wanted")
    few = wanted.count() <= BROADCAST_ROWS  # two numbers a row; beyond that both sides are shuffled
    texts = docs.join(F.broadcast(wanted) if few else wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.col("text_key") == F.col("wkey")), "left_semi")
    out = written(pass_arrays(texts.dropDuplicates(["id", "text_key"]), words), "arrays")
    discard(wanted)
    return out


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: id, n_shingles (size of its set), component_id (smallest id reachable by links).

    Documents link when 100 * intersection >= percent * union of their sets of `words`-word shingles. With fewer words the
    whole sequence is the one shingle; a null, empty or blank text has an empty set, links with nothing and is a component of
    its own. Repeated rows link with each other. A null id never names a component unless all ids in it are null. Other
    columns are ignored; an empty table gives an empty table. Sets are compared by 64-bit hashes of their shingles.
    """
    text_batches(docs.sparkSession)
    own_id = F.col(id_col).cast("long") if isinstance(docs.schema[id_col].dataType, IntegralType) else F.col(id_col)
    slim = docs.select(own_id.alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    first = written(pass_sets(slim, words), "sets")
    sets = first.where("kind = 0").drop("kind", "bits")
    total = sets.agg(F.sum("n")).first()[0] or 0
    often = first.where("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).where(F.col("n") >= max(32, total // FREQUENT))
    frequent = np.sort(often.select("node").toPandas()["node"].to_numpy(np.int64).view(np.uint64))
    nodes = first.where("kind = 0 and node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min(F.struct("id", "text_key")).alias("d"))
    nodes = written(nodes, "nodes")

    every = written(shared_only(pass_prefixes(slim, words, percent, frequent)), "shared")
    shared = written(distinct_groups(every), "groups")
    discard(every)
    ends = shared.select("node", "n", F.col("center").alias("to"), F.col("center_n").alias("to_n")).union(shared.select("node", "n", "prev", "prev_n"))
    near = ends.where(f"node <> to and 100 * least(n, to_n) >= {percent} * greatest(n, to_n)")
    pairs = near.select(F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b")).distinct()
    links = linked_pairs(likely_pairs(pairs, nodes, percent), nodes, slim, words, percent)
    roots = written(connected_components(links), "first-roots")

    rooted = shared.select("x", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The first step has compared all pairs of a shingle with three nodes or fewer.
    mixed = rooted.groupBy("x").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("held")).where("lo < hi and held > 3").select("x")
    rooted = written(rooted.join(spread(mixed, "x"), "x"), "mixed")
    clusters = connected_components(candidate_ties(rooted, nodes, percent)).toDF("root", "cluster")
    members = written(rooted.select("node", "n", "root").distinct().join(spread(clusters, "root"), "root"), "members")
    arrays = arrays_of(members.select("node"), nodes, slim, words)
    # Links found later tie whole components of the first step together.
    second = connected_components(cluster_ties(members, arrays, percent)).toDF("root", "top")
    final = roots.join(spread(second, "root"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = second.join(roots, second["root"] == roots["node"], "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    named = sets.where("node is not null").groupBy("node").agg(F.min("id").alias("least")).join(final.union(alone), "node", "left")
    named = written(named.select("node", "least", F.coalesce("root", "node").alias("root")), "roots")
    component = written(named.join(spread(named.groupBy("root").agg(F.min("least").alias("component")), "root"), "root").select("node", "component"), "components")
    discard(nodes, shared, links, roots, rooted, members, arrays, second, named)
    return sets.join(spread(component, "node"), "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs whose id names its component: one document of each group stays, with all its columns.

    The rows of one id stay or go together; rows with a null id all stay."""
    found = jaccard_components(docs, id_col, text_col, **options)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")
