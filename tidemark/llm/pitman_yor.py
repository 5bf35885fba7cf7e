"""Language-model scores by a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Every distinct previous word has a restaurant of its own (text starts have one too); all share one parent, whose customers
are their tables. The parent's base is continuous, so a word never seen is served by its mass for new dishes. Words are
held as 62-bit hashes. Pairs of context and word are dealt over a grid of shares, a row of it for contexts and a column for
words, so that neither a common context nor a common word lies in one share; a share is a row of packed arrays, and there
are more shares, not larger ones, for more text. Shares tell their sums of each context and word to the bucket where these
meet, and get back the totals they asked for, so no figure for each context or word reaches the driver. A pair seen once
sits at one table in every seating, so only pairs seen more often are seated anew. In a Gibbs sweep all
customers of a dish leave a restaurant and come in again one at a time, given the totals of the sweep before: dishes are
seated in parallel, each against the others as they were. Draws follow from the pair and the sweep alone. Scores average the
predictive probabilities of the kept sweeps. The strengths theta are 1; discounts are estimated from the counts of counts.

Pairs that make up more than 1/FREQUENT_SHARE of all tokens number less than FREQUENT_SHARE whatever the corpus; their
probabilities are broadcast, and only tokens of other pairs are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import groupby
from math import ceil, expm1, isqrt, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, spread, text_batches, written
from tidemark.llm.mil_quality import in_fold

#: Numbers of words, and so of contexts, lie below this.
CONTEXTS = 1 << 62
START = CONTEXTS
#: The end of a text as a word; it holds a space, which no word does.
END = b" "
FREQUENT_SHARE = 50_000
#: Tokens that a task packs at once.
AT_ONCE = 1_500_000
#: Rows of a batch that a task gives out.
ROWS_OUT = 50_000
#: Bytes of text for each share, about, and columns of the grid at most: as many shares hold the pairs of one context.
SHARE_BYTES, COLUMNS = 6_000_000, 8
#: A row of packed arrays. Rows of a share come by kind: its pairs, those seen more than once, totals it gets, texts' tokens.
PACKED = "share long, kind long, chunk long, parts array<binary>, seen array<long>"
PAIRS, SEATS, REPLY_K, REPLY_W, TEXTS, DEALT = range(6)
#: Kinds of what buckets hold: contexts, words.
OF_K, OF_W = 0, 1
#: Customers that are seated draw by draw; for later ones the wait for the next new table is drawn.
ONE_BY_ONE = 48
SUM = np.dtype([("doc", "<u2"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])
TEXT = np.dtype([("doc", "<u2"), ("none", "?"), ("id", "<i8"), ("n", "<i8"), ("known", "<i8"), ("base", "<f8"), ("score", "<f8")])
#: Texts that a task packs at once, so that a text's number takes two bytes.
TEXTS_AT_ONCE = 1 << 16
#: Kinds of payload: rows of TEXT, rows of SUM, numbers of the texts that hold a pair the model lacks.
OF_TEXTS, OF_SUMS, OF_TOKENS = 0, 1, 2
THETA1 = THETA0 = 1.0


def number_of(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little") >> 2


def numbers_of(words: list[bytes]) -> np.ndarray:
    return (np.frombuffer(b"".join([blake2b(word, digest_size=8).digest() for word in words]), dtype="<u8") >> np.uint64(2)).astype(np.int64)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, divided at bytes 20 and 09 to 0D, then the end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def chunks(batches: Iterator[pa.RecordBatch], column: int):
    """Batches of the input put together up to AT_ONCE tokens: (ids, places of all tokens' words, tokens of each text, numbers of the words)."""
    ids, parts, sizes, words, total = [], [], [], [], 0

    def chunk() -> tuple:
        parts.append(pa.array(words, pa.large_binary()))
        coded = pa.concat_arrays(parts).dictionary_encode()
        parts.clear()
        words.clear()
        return ids, coded.indices.to_numpy().astype(np.int64), np.array(sizes), numbers_of(coded.dictionary.to_pylist())

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(column).to_pylist()):
            own = words_of(text)
            ids.append(i)
            words += own
            sizes.append(len(own))
            total += len(own)
            if total >= AT_ONCE or len(ids) >= TEXTS_AT_ONCE:
                yield chunk()
                ids, parts, sizes, words, total = [], [], [], [], 0
        parts.append(pa.array(words, pa.large_binary()))
        words = []
    if ids:
        yield chunk()


def put(values: np.ndarray) -> bytes:
    """An array as bytes, those of equal rank together, which packs small and sorted numbers well."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def got(part: bytes, kind: str = "<i8") -> np.ndarray:
    raw = pa.decompress(part[8:], int.from_bytes(part[:8], "little"), codec="zstd", asbytes=True)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def packed(rows: list[tuple]) -> pa.RecordBatch:
    """A batch of PACKED from (share, kind, chunk, parts, seen)."""
    share, kind, chunk, parts, seen = zip(*rows)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(x, type=k) for x, k in zip((share, kind, chunk, parts, seen), kinds)], names=["share", "kind", "chunk", "parts", "seen"])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield tuple(batch.column(c)[at].as_py() for c in ("share", "kind", "chunk", "parts", "seen"))


def shares_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Shares with their rows, which come sorted."""
    return groupby(rows_of(batches), key=lambda row: row[0])


def starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where another key begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.int64)


def pair_parts(k: np.ndarray, w: np.ndarray) -> list[bytes]:
    """Pairs sorted by k and w: contexts, pairs of each, words, the place of each pair's word."""
    first = starts(k)
    words, at = np.unique(w, return_inverse=True)
    return [put(k[first]), put(np.diff(np.append(first, len(k))).astype("<u4")), put(words), put(at.astype("<u4"))]


class Block:
    """Pairs read back: contexts, words, and for each pair the places of its context and word."""

    def __init__(self, parts: list[bytes]) -> None:
        self.contexts, each, self.words, self.at_w = got(parts[0]), got(parts[1], "<u4"), got(parts[2]), got(parts[3], "<u4").astype(np.int64)
        self.at_k = np.repeat(np.arange(len(each)), each)

    def sums(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of each context and of each word."""
        return tuple(np.bincount(at, values, n).astype(np.int64) for at, n in ((self.at_k, len(self.contexts)), (self.at_w, len(self.words))))


@dataclass
class Grid:
    """Shares and buckets, rows * columns of each. Contexts of a grid row meet in its buckets, words of a column in the column's."""

    rows: int
    columns: int

    @classmethod
    def of(cls, docs: DataFrame) -> Grid:
        shares = ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 1) / SHARE_BYTES)
        columns = min(COLUMNS, isqrt(shares))
        return cls(ceil(shares / columns), columns)

    def __len__(self) -> int:
        return self.rows * self.columns

    def share(self, k: np.ndarray, w: np.ndarray) -> np.ndarray:
        return k % self.rows * self.columns + w % self.columns

    def bucket(self, keys: np.ndarray, of: int) -> np.ndarray:
        if of == OF_K:
            return keys % self.rows * self.columns + keys // self.rows % self.columns
        return keys % self.columns * self.rows + keys // self.columns % self.rows

    def deal(self, df: DataFrame) -> DataFrame:
        return df.repartition(len(self), "share").sortWithinPartitions("share", "kind", "chunk")


def pairs_of(tokens: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context and word numbers of each pair, sorted by both, tokens of each pair, and pair by pair the tokens' texts."""
    numbers = np.append(numbers, START)
    order, size = np.argsort(numbers), len(numbers)
    numbers = numbers[order]
    rank = np.empty(size, dtype=np.int64)
    rank[order] = np.arange(size)
    tokens, doc = rank[tokens], np.repeat(np.arange(len(sizes)), sizes)
    before = np.concatenate([[size - 1], tokens[:-1]])
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = size - 1
    key = before * size + tokens
    del before
    if size <= 1 << 23:
        key <<= 16
        key |= doc
        key.sort()
        doc = (key & 0xFFFF).astype("<u2")
        key >>= 16
    else:
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
    first = starts(key)
    each, key = np.diff(np.append(first, len(key))), key[first]
    return numbers[key // size], numbers[key % size], each, doc


def by_share(grid: Grid, k: np.ndarray, w: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shares with the places of their pairs, in order."""
    share = grid.share(k, w)
    order = np.argsort(share.astype(np.uint16) if len(grid) <= 1 << 16 else share, kind="stable")
    first = starts(share[order])
    for at in np.split(order, first[1:]) if len(first) else []:
        yield int(share[at[0]]), at


def count_pairs(docs: DataFrame, grid: Grid) -> DataFrame:
    """PAIRS and SEATS of each share: tokens of each pair, counted in each task before they are shuffled.

    Behind the pairs, PAIRS have c. SEATS have c, tables, what the last sweep added to them, tables of each context and of
    each word, then the tables of each kept sweep. seen of PAIRS: tokens, pairs seen once and twice, pairs.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, sizes, known in chunks(batches, 1):
            k, w, n, _ = pairs_of(tokens, sizes, known)
            yield packed([(share, DEALT, 0, [*pair_parts(k[on], w[on]), put(n[on])], None) for share, on in by_share(grid, k, w)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for share, rows in shares_of(batches):
            held = []
            for *_, parts, _ in rows:
                block = Block(parts)
                held.append((block.contexts[block.at_k], block.words[block.at_w], got(parts[4])))
            k, w, c = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((w, k))
            k, w, c = k[order], w[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (w[1:] != w[:-1])]))
            k, w, c = k[first], w[first], np.add.reduceat(c, first)
            seen = [int(x) for x in (c.sum(), (c == 1).sum(), (c == 2).sum(), len(c))]
            yield packed([(share, PAIRS, 0, [*pair_parts(k, w), put(c)], seen)])
            on = c > 1
            if on.any():
                parts = pair_parts(k[on], w[on])
                block, one = Block(parts), np.ones(on.sum(), dtype=np.int64)
                yield packed([(share, SEATS, 0, [*parts, put(c[on]), put(one), put(one * 0), *(put(x * 0) for x in (block.contexts, block.words))], None)])

    return grid.deal(docs.mapInArrow(gather, PACKED)).mapInArrow(merge, PACKED)


def told(grid: Grid, share: int, block: Block, values: list[tuple[np.ndarray, np.ndarray]], asks: bool) -> list[tuple]:
    """What a share tells the buckets of its contexts and words: keys and values. It asks for the totals of seats or of pairs."""
    out = []
    for of, keys in ((OF_K, block.contexts), (OF_W, block.words)):
        bucket = grid.bucket(keys, of)
        order = np.argsort(bucket, kind="stable")
        for at in np.split(order, starts(bucket[order])[1:]):
            out.append((int(bucket[at[0]]), of, share, [put(keys[at]), *(put(v[of][at]) for v in values)], [int(asks)]))
    return out


def met(grid: Grid, rows: DataFrame, keep: bool = False) -> DataFrame:
    """Totals of what was told: replies to those who asked, in the order of their keys by bucket, and a row of each bucket.

    seen of the buckets' rows (share -1): keys, those whose total is 1 and 2. If keep, they hold the keys and totals.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, of), part in groupby(rows_of(batches), key=lambda row: row[:2]):
            part = list(part)
            columns = [[got(x) for x in row[3]] for row in part]
            keys, at = np.unique(np.concatenate([x[0] for x in columns]), return_inverse=True)
            totals = [np.bincount(at, np.concatenate(x), len(keys)).astype(np.int64) for x in list(zip(*columns))[1:]]
            ends = np.cumsum([len(x[0]) for x in columns])
            asked = [(row, at[end - len(x[0]) : end]) for row, x, end in zip(part, columns, ends) if row[4][0]]
            for s in range(0, len(asked), 64):
                yield packed([(row[2], REPLY_K + of, bucket, [put(total[on]) for total in totals], None) for row, on in asked[s : s + 64]])
            seen = [len(keys), int((totals[-1] == 1).sum()), int((totals[-1] == 2).sum())]
            yield packed([(-1, of, bucket, [put(keys), *(put(x) for x in totals)] if keep else [], seen)])

    return rows.repartition(len(grid), "share", "kind").sortWithinPartitions("share", "kind").mapInArrow(add, PACKED)


def answers(grid: Grid, keys: np.ndarray, of: int, replies: list[tuple]) -> list[np.ndarray]:
    """Totals in the order of keys, from the replies of the buckets in order."""
    order = np.argsort(grid.bucket(keys, of), kind="stable")
    out = []
    for parts in zip(*(row[3] for row in replies)):
        values = np.empty(len(keys), dtype=np.int64)
        values[order] = np.concatenate([got(x) for x in parts])
        out.append(values)
    return out


@dataclass
class Totals:
    """Figures of one seating: discounts, words, tables in all."""

    d1: float
    d0: float
    words: int
    top: float

    def new_dish(self) -> float:
        """The parent's mass for a word that nobody has ordered."""
        return float((THETA0 + self.d0 * self.words) / (THETA0 + self.top))


@dataclass
class Model:
    """n and the seatings' totals; contexts (k, customers, ups), words (w, cw, ps), an array item a seating; the grid and its shares."""

    n: int
    history: list[Totals]
    contexts: DataFrame
    words: DataFrame
    grid: Grid
    tables: list[DataFrame]

    @property
    def shares(self) -> DataFrame:
        """PAIRS, the tables alone of SEATS, and the totals of contexts and words (customers, tables of each seating)."""
        pairs, seats, totals = self.tables
        tables = seats.withColumn("parts", F.slice("parts", 10, len(self.history)))
        return pairs.union(tables).union(totals.where("share >= 0"))

    @property
    def pairs(self) -> DataFrame:
        """k, w, c, ts of every pair."""
        grid, kept = self.grid, len(self.history)

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, rows in shares_of(batches):
                own = Share(grid, kept, list(rows))
                yield from own.given(own.block, own.c, own.ts)

        return grid.deal(self.shares).mapInArrow(unpack, "k long, w long, c long, ts array<long>")

    def frequent(self, least: float) -> DataFrame:
        """k, w, c, ts of pairs seen more than least times, and more than once."""

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for *_, parts, _ in rows_of(batches):
                block, c = Block(parts), got(parts[4])
                yield from Share.given(block, c, [got(x) for x in parts[9:]], c > least)

        return self.tables[1].mapInArrow(unpack, "k long, w long, c long, ts array<long>")

    def probabilities(self, pairs: DataFrame, contexts: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
        """k, w, cw and the mean predictive probability q of pairs that the model holds."""
        d1 = self.history[0].d1
        met = pairs.join(spread(contexts or self.contexts, "k"), "k").join(spread(words or self.words, "w"), "w")
        each = lambda s: (F.col("c") - d1 * F.col("ts")[s]) / (THETA1 + F.col("customers")) + F.col("ups")[s] * F.col("ps")[s]
        return met.select("k", "w", "cw", (sum((each(s) for s in range(len(self.history))), F.lit(0.0)) / len(self.history)).alias("q"))


class Share:
    """A share of the model: its pairs with c and tables, and for its contexts and words customers and tables of each seating."""

    def __init__(self, grid: Grid, kept: int, rows: list[tuple]) -> None:
        none = put(np.zeros(0, np.int64))
        by = {kind: [row for row in rows if row[1] == kind] for kind in (PAIRS, SEATS, REPLY_K, REPLY_W)}
        parts = by[PAIRS][0][3] if by[PAIRS] else [none, none, none, none, none]
        self.block, self.c = Block(parts), got(parts[4])
        self.ts = [np.ones(len(self.c), dtype=np.int64) for _ in range(kept)]
        for row in by[SEATS]:
            for s in range(kept):
                self.ts[s][self.c > 1] = got(row[3][s])
        empty = [np.zeros(0, np.int64)] * (1 + kept)
        self.of_k = answers(grid, self.block.contexts, OF_K, by[REPLY_K]) or empty
        self.of_w = answers(grid, self.block.words, OF_W, by[REPLY_W]) or empty
        self.code = self.block.at_k * len(self.block.words) + self.block.at_w

    @staticmethod
    def given(block: Block, c: np.ndarray, ts: list[np.ndarray], which: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        on = np.flatnonzero(np.ones(len(c), bool) if which is None else which)
        for s in range(0, len(on), ROWS_OUT):
            at = on[s : s + ROWS_OUT]
            each = np.stack([x[at] for x in ts], axis=1).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(ts)), pa.array(each))
            yield pa.RecordBatch.from_arrays([pa.array(block.contexts[block.at_k[at]]), pa.array(block.words[block.at_w[at]]), pa.array(c[at]), lists], names=["k", "w", "c", "ts"])

    def probability(self, block: Block, history: list[Totals]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether this share knows both context and word, tokens of the word, mean probability) of other pairs."""
        at_k, at_w = place_in(self.block.contexts, block.contexts)[block.at_k], place_in(self.block.words, block.words)[block.at_w]
        here = (at_k >= 0) & (at_w >= 0)
        at_k, at_w = at_k[here], at_w[here]
        at = place_in(self.code, at_k * len(self.block.words) + at_w)
        hit, q = at >= 0, np.zeros(len(at))
        for s, h in enumerate(history):
            p = np.maximum(self.of_w[1 + s][at_w] - h.d0, 0) / (THETA0 + h.top)
            over = np.zeros(len(at))
            over[hit] = self.c[at[hit]] - h.d1 * self.ts[s][at[hit]]
            q += (over + (THETA1 + h.d1 * self.of_k[1 + s][at_k]) * p) / (THETA1 + self.of_k[0][at_k])
        return here, self.of_w[0][at_w], q / len(history)


def place_in(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The place of each number among known, sorted ones, -1 where it is none of them."""
    if not len(known):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, at, -1)


def uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) that follow from a pair's key, the sweep and the step alone, however rows are dealt and batched."""
    with np.errstate(over="ignore"):
        x = key + np.uint64((sweep + 1) * 0x9E3779B97F4A7C15 & 2**64 - 1) + np.uint64((step + 1) * 0xD1B54A32D192ED03 & 2**64 - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / 2**53


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for positive x: Stirling's series eight places further up."""
    y = x + 8
    product = np.ones_like(x)
    for i in range(8):
        product = product * (x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) - np.log(product)


def uniform_of(key: int, sweep: int, step: int) -> float:
    """uniform of one pair."""
    x = key + (sweep + 1) * 0x9E3779B97F4A7C15 + (step + 1) * 0xD1B54A32D192ED03 & 2**64 - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 2**64 - 1
    x = (x ^ x >> 27) * 0x94D049BB133111EB & 2**64 - 1
    x ^= x >> 31
    return ((x >> 11) + 0.5) / 2**53


def late_tables(c: int, j: int, t: int, rest_k: float, rest_w: float, rest_top: float, d1: float, d0: float, key: int, sweep: int) -> int:
    """Tables that customers j to c of a dish with t tables open: the waits between them are drawn."""
    step, before = j - 1, t
    while j < c:
        v = (THETA1 + d1 * (rest_k + t)) * (rest_w + t - d0) / (THETA0 + rest_top + t)
        a, left, drawn = j - d1 * t, c - j, log(uniform_of(key, sweep, step))
        start = lgamma(a + v) - lgamma(a)
        # The least m for which it is no longer so that none of the next m opens a table; the guess takes the law's leading term.
        m = max(1, min(left, int((a + v / 2) * expm1(min(-drawn / v, 50.0))) + 1))
        pace = 1
        if start + lgamma(a + m) - lgamma(a + m + v) > drawn:
            low = m
            while True:
                if low == left:
                    return t - before
                high = min(left, low + pace)
                if start + lgamma(a + high) - lgamma(a + high + v) <= drawn:
                    break
                low, pace = high, 2 * pace
        else:
            high = m
            while True:
                low = max(0, high - pace)
                if not low or start + lgamma(a + low) - lgamma(a + low + v) > drawn:
                    break
                high, pace = low, 2 * pace
        while high - low > 1:
            mid = (low + high) // 2
            if start + lgamma(a + mid) - lgamma(a + mid + v) > drawn:
                low = mid
            else:
                high = mid
        t += 1
        j += high
        step += 1
    return t - before


def seat(c: np.ndarray, rest_k: np.ndarray, rest_w: np.ndarray, rest_top: np.ndarray, d1: float, d0: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of dishes whose c customers come in one at a time. rest_k, rest_w and rest_top are the tables of the other dishes
    of the restaurant, of the word elsewhere, and of all others; a dish's own tables count as they open.

    The first customers draw one by one. After ONE_BY_ONE the wait for the next new table is drawn at once from its law,
    which is the same as one draw for each customer: none of the next m opens one with probability
    G(a + m) G(a + v) / (G(a) G(a + m + v)), a = customers - d1 tables, v the weight of a new table.
    """
    t, j = np.ones(len(c), dtype=np.int64), np.ones(len(c), dtype=np.int64)

    def weight(on: np.ndarray) -> np.ndarray:
        return (THETA1 + d1 * (rest_k[on] + t[on])) * (rest_w[on] + t[on] - d0) / (THETA0 + rest_top[on] + t[on])

    on, step = np.flatnonzero(c > 1), 0
    while len(on) and step < ONE_BY_ONE:
        v = weight(on)
        t[on] += uniform(key[on], sweep, step) * (v + j[on] - d1 * t[on]) < v
        j[on] += 1
        step += 1
        on = on[c[on] > j[on]]
    # Few dishes have more customers, but some of these open thousands of tables: they are followed one by one.
    for i in on.tolist():
        t[i] += late_tables(int(c[i]), int(j[i]), int(t[i]), float(rest_k[i]), float(rest_w[i]), float(rest_top[i]), d1, d0, int(key[i]), sweep)
    return t


def moved(grid: Grid, seats: DataFrame, replies: DataFrame, totals: Totals, keep: bool, sweep: int) -> DataFrame:
    """SEATS with all customers seated anew, once what their contexts and words have gained is added; seen: tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for share, rows in shares_of(batches):
            rows = list(rows)
            parts = next(row[3] for row in rows if row[1] == SEATS)
            block, c, t = Block(parts), got(parts[4]), got(parts[5])
            in_k, in_w = (
                got(part) + answers(grid, keys, of, [row for row in rows if row[1] == REPLY_K + of])[0]
                for part, keys, of in ((parts[7], block.contexts, OF_K), (parts[8], block.words, OF_W))
            )
            key = block.contexts[block.at_k].astype(np.uint64) ^ block.words[block.at_w].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            new = seat(c, in_k[block.at_k] - t, in_w[block.at_w] - t, totals.top - t, totals.d1, totals.d0, key, sweep)
            yield packed([(share, SEATS, 0, [*parts[:5], put(new), put(new - t), put(in_k), put(in_w), *parts[9:], *([put(new)] if keep else [])], [int(new.sum())])])

    return grid.deal(seats.union(replies)).mapInArrow(run, PACKED)


def tell(grid: Grid, table: DataFrame, values, asks: bool) -> DataFrame:
    """told of the values that a function of a share's pairs and parts gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for share, _, _, parts, _ in rows_of(batches):
            block = Block(parts)
            yield packed(told(grid, share, block, [block.sums(x) for x in values(block, parts)], asks))

    return table.mapInArrow(run, PACKED)


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written; first the shuffle files behind what was written before go with the driver's garbage."""
    df.sparkSession._jvm.System.gc()
    return written(df, name)


def fit(docs: DataFrame, burn_in: int = 1, kept: int = 2) -> Model:
    """The model of a table id, text."""
    grid = Grid.of(docs)
    counted = settled(count_pairs(docs, grid), "pairs")
    pairs, seats = (counted.where(F.col("kind") == kind) for kind in (PAIRS, SEATS))
    seen = pairs.agg(*[F.sum(F.col("seen")[i]) for i in range(4)]).first()
    one = lambda block, parts: [np.ones(len(block.at_k), dtype=np.int64)]
    none = lambda block, parts: [np.zeros(len(block.at_k), dtype=np.int64)]
    replies = settled(met(grid, tell(grid, pairs, one, False).union(tell(grid, seats, none, True))), "sums")
    words = replies.where((F.col("share") < 0) & (F.col("kind") == OF_W)).agg(*[F.sum(F.col("seen")[i]) for i in range(3)]).first()
    estimate = lambda a, b: min(0.95, max(0.05, (a or 0) / max(1, (a or 0) + 2 * (b or 0))))
    d1, d0 = estimate(seen[1], seen[2]), estimate(words[1], words[2])
    ones, words = seen[1] or 0, words[0] or 0
    totals = Totals(d1, d0, words, float(seen[3] or 0))
    history, added = [], lambda block, parts: [got(parts[6])]
    for turn in range(burn_in + kept):
        keep = turn >= burn_in
        after = settled(moved(grid, seats, replies.where("share >= 0"), totals, keep, turn), "seating")
        discard(replies, *([seats] if turn else []))
        seats = after
        totals = Totals(d1, d0, words, float(ones + (seats.agg(F.sum(F.col("seen")[0])).first()[0] or 0)))
        if keep:
            history.append(totals)
        if turn + 1 < burn_in + kept:
            replies = settled(met(grid, tell(grid, seats, added, True)), "sums")

    def of_pairs(block: Block, parts: list[bytes]) -> list[np.ndarray]:
        return [got(parts[4]), *[np.ones(len(block.at_k), dtype=np.int64)] * kept]

    def of_seats(block: Block, parts: list[bytes]) -> list[np.ndarray]:
        return [np.zeros(len(block.at_k), dtype=np.int64), *(got(x) - 1 for x in parts[9:])]

    last = settled(met(grid, tell(grid, pairs, of_pairs, True).union(tell(grid, seats, of_seats, False)), True), "totals")

    def tables(of: int, key: str) -> DataFrame:
        names = [key, "customers", *(f"t{s}" for s in range(kept))]

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for *_, parts, _ in rows_of(batches):
                columns = [got(x) for x in parts]
                for s in range(0, len(columns[0]), ROWS_OUT):
                    yield pa.RecordBatch.from_arrays([pa.array(x[s : s + ROWS_OUT]) for x in columns], names=names)

        return last.where((F.col("share") < 0) & (F.col("kind") == of)).mapInArrow(unpack, ", ".join(f"{x} long" for x in names))

    ups = F.array(*[(THETA1 + d1 * F.col(f"t{s}")) / (THETA1 + F.col("customers")) for s in range(kept)])
    ps = F.array(*[F.greatest(F.col(f"t{s}") - d0, F.lit(0.0)) / (THETA0 + h.top) for s, h in enumerate(history)])
    contexts = tables(OF_K, "k").select("k", "customers", ups.alias("ups"))
    known = tables(OF_W, "w").select("w", F.col("customers").alias("cw"), ps.alias("ps"))
    return Model(seen[0] or 0, history, contexts, known, grid, [pairs, seats, last])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 2, folds: int = 7, burn_in: int = 1, kept: int = 2) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Tokens are the words of the lower-cased text and one end. base_score is the add-one unigram log10 probability; score the
    model's. Null and empty texts are the end alone; repeated rows are scored each; a null id counts as the empty text for
    its fold. Without training texts every token is unknown. Other columns are ignored; an empty table gives an empty table.
    """
    text_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    model = fit(slim.where(in_fold(folds) != held_out), burn_in, kept)
    per = weighed(slim, model)
    discard(*model.tables[:2])
    return per.select(
        F.col("id").alias(id_col),
        (in_fold(folds) == held_out).alias("held_out"),
        F.col("n").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n")).alias("perplexity"),
    )


def weighed(slim: DataFrame, model: Model) -> DataFrame:
    """id, n, known, base, score of every row of a table id, text under the model."""
    n, v, samples = model.n, model.history[0].words, len(model.history)
    grid, history = model.grid, model.history
    # Fewer than FREQUENT_SHARE pairs pass this.
    often = written(model.frequent(n / FREQUENT_SHARE), "frequent")
    met_k, met_w = (table.join(F.broadcast(often.select(key).distinct()), key, "left_semi") for table, key in ((model.contexts, "k"), (model.words, "w")))
    top = model.probabilities(often, met_k, met_w).toPandas()
    discard(often)
    shared = slim.sparkSession.sparkContext.broadcast(
        {"at": {p: i for i, p in enumerate(zip(top["k"].tolist(), top["w"].tolist()))}, "log": np.log10(np.maximum(top["q"].to_numpy(float), 1e-300)), "base": np.log10((top["cw"].to_numpy(float) + 1) / (n + v + 1))}
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of texts with what their frequent pairs give, and for each share the other pairs with their texts' numbers."""
        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 24
        place, logs, base = shared.value["at"], shared.value["log"], shared.value["base"]
        wanted = np.sort(np.array([k ^ w for k, w in place], dtype=np.int64))

        for ids, tokens, sizes, known in chunks(batches, 1):
            k, w, each, doc = pairs_of(tokens, sizes, known)
            held = np.full(len(k), -1)
            if len(wanted):
                mixed = k ^ w
                for i in np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, mixed), len(wanted) - 1)] == mixed):
                    held[i] = place.get((int(k[i]), int(w[i])), -1)
            own = np.repeat(held, each)
            on = own >= 0
            rows = np.zeros(len(sizes), dtype=TEXT)
            rows["doc"], rows["n"] = np.arange(len(sizes)), sizes
            rows["none"], rows["id"] = [x is None for x in ids], [x or 0 for x in ids]
            rows["known"] = np.bincount(doc[on], minlength=len(sizes))
            if on.any():
                rows["base"], rows["score"] = np.bincount(doc[on], base[own[on]], len(sizes)), np.bincount(doc[on], logs[own[on]], len(sizes))
            parts = [rows[s : s + 1000].tobytes() for s in range(0, len(rows), 1000)]
            share = (chunk >> 24) + (chunk & 0xFFFFFF)
            yield packed([((share + i) % len(grid), TEXTS, chunk, [part], None) for i, part in enumerate(parts)])
            doc, rare = doc[~on].astype("<u2"), held < 0
            k, w, each = k[rare], w[rare], each[rare]
            first = np.cumsum(each) - each
            for share, on in by_share(grid, k, w):
                own = np.repeat(first[on] - np.cumsum(each[on]) + each[on], each[on]) + np.arange(each[on].sum())
                yield packed([(share, DEALT, chunk, [*pair_parts(k[on], w[on]), put(each[on].astype("<u4")), put(doc[own])], None)])
            chunk += 1

    def summed(pool: list[tuple]) -> tuple[np.ndarray, list[bytes]]:
        """Chunks and their packed sums, from (chunk, doc, known, base, score) of tokens."""
        chunk, doc, known, base, value = (np.concatenate(x) for x in zip(*pool))
        key, inverse = np.unique(chunk.astype(np.int64) << 16 | doc, return_inverse=True)
        rows = np.zeros(len(key), dtype=SUM)
        rows["doc"], rows["known"] = key & 0xFFFF, np.bincount(inverse, known)
        rows["base"], rows["score"] = np.bincount(inverse, base), np.bincount(inverse, value)
        first = np.flatnonzero(np.concatenate([[True], (key[1:] >> 16) != (key[:-1] >> 16)]))
        raw, ends = rows.tobytes(), np.append(first[1:], len(key))
        return key[first] >> 16, [raw[i * SUM.itemsize : j * SUM.itemsize] for i, j in zip(first.tolist(), ends.tolist())]

    names = ["kind", "k", "w", "chunk", "payload"]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of texts as they are; for each chunk the packed sums of tokens whose context and word the share knows, and the others' pairs."""

        def out(kind: int, k: np.ndarray | None, w: np.ndarray | None, chunk: int, payload: list[bytes]) -> pa.RecordBatch:
            m = len(payload)
            numbers = [pa.nulls(m, pa.int64()) if x is None else pa.array(x) for x in (k, w)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(m, kind)), *numbers, pa.array(np.full(m, chunk)), pa.array(payload, pa.binary())], names=names)

        for _, rows in shares_of(batches):
            own, held = None, []
            for row in rows:
                _, kind, chunk, parts, _ = row
                if kind < TEXTS:
                    held.append(row)
                elif kind == TEXTS:
                    yield out(OF_TEXTS, None, None, chunk, parts)
                else:
                    own = own or Share(grid, samples, held)
                    held = []
                    block, each, doc = Block(parts), got(parts[4], "<u4").astype(np.int64), got(parts[5], "<u2")
                    here, c, q = own.probability(block, history)
                    token = np.repeat(here, each)
                    if here.any():
                        on, times = doc[token], each[here]
                        tokens = np.bincount(on)
                        sums = np.zeros(np.count_nonzero(tokens), dtype=SUM)
                        sums["doc"] = np.flatnonzero(tokens)
                        for name, value in (("known", (c > 0).astype(float)), ("base", np.log10((c + 1) / (n + v + 1))), ("score", np.log10(q))):
                            sums[name] = np.bincount(on, np.repeat(value, times))[sums["doc"]]
                        yield out(OF_SUMS, None, None, chunk, [sums.tobytes()])
                    rest = np.flatnonzero(~here)
                    if len(rest):
                        raw, ends = doc[~token].tobytes(), 2 * np.cumsum(each[rest])
                        payload = [raw[i:j] for i, j in zip((ends - 2 * each[rest]).tolist(), ends.tolist())]
                        yield out(OF_TOKENS, block.contexts[block.at_k[rest]], block.words[block.at_w[rest]], chunk, payload)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each chunk with the packed sums of the tokens."""

        def sums() -> pa.RecordBatch:
            chunk, parts = summed(pool)
            m = len(parts)
            return pa.RecordBatch.from_arrays([pa.array(np.full(m, OF_SUMS)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(chunk), pa.array(parts, pa.binary())], names=names)

        pool, held = [], 0
        for batch in batches:
            part = batch
            if not part.num_rows:
                continue
            raw = part.column("payload").to_pylist()
            doc = np.frombuffer(b"".join(raw), dtype="<u2").astype(np.int64)
            row = np.repeat(np.arange(len(raw)), [len(x) // 2 for x in raw])
            c = part.column("cw").to_numpy()
            known, base, value = (c > 0).astype(float), np.log10((c + 1) / (n + v + 1)), np.log10(part.column("q").to_numpy())
            pool.append((part.column("chunk").to_numpy()[row], doc, known[row], base[row], value[row]))
            held += len(doc)
            if held >= AT_ONCE // 2:
                yield sums()
                pool, held = [], 0
        if pool:
            yield sums()

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text: its own row and all sums of its chunk. Rows come by chunk; one chunk is held at a time."""
        now, texts, sums = None, [], []

        def flush() -> pa.RecordBatch:
            own = np.frombuffer(b"".join(texts), dtype=TEXT)
            rows = np.frombuffer(b"".join(sums), dtype=SUM)
            known, base, value = (own[c] + np.bincount(rows["doc"], rows[c], TEXTS_AT_ONCE)[own["doc"]] for c in ("known", "base", "score"))
            return pa.RecordBatch.from_arrays(
                [pa.array(own["id"], mask=own["none"]), pa.array(own["n"]), pa.array(known.astype(np.int64)), pa.array(base), pa.array(value)], names=["id", "n", "known", "base", "score"]
            )

        for batch in batches:
            for kind, chunk, payload in zip(*(batch.column(c).to_pylist() for c in ("kind", "chunk", "payload"))):
                if chunk != now:
                    if now is not None:
                        yield flush()
                    now, texts, sums = chunk, [], []
                (texts if kind == OF_TEXTS else sums).append(payload)
        if now is not None:
            yield flush()

    weigh_schema = "kind long, k long, w long, chunk long, payload binary"
    sums = settled(grid.deal(model.shares.union(slim.mapInArrow(split, PACKED))).mapInArrow(within, weigh_schema), "weighed")
    slim.sparkSession._jvm.System.gc()
    # A share knows the context and word of each pair that it holds. A pair that the model lacks gets its restaurant's share of
    # new tables times the parent's probability.
    other = sums.where(F.col("kind") == OF_TOKENS).select("k", "w", "chunk", "payload")
    other = other.join(spread(model.contexts, "k"), "k", "left").join(spread(model.words, "w"), "w", "left")
    each = [F.coalesce(F.col("ups")[s], F.lit(1.0)) * F.coalesce(F.col("ps")[s], F.lit(h.new_dish())) for s, h in enumerate(model.history)]
    other = other.select("k", "w", "chunk", "payload", F.coalesce("cw", F.lit(0)).alias("cw"), (sum(each, F.lit(0.0)) / samples).alias("q"))
    rows = sums.where(F.col("kind") != OF_TOKENS).unionByName(other.mapInArrow(weigh, weigh_schema)).select("kind", "chunk", "payload")
    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(put_together, "id long, n long, known long, base double, score double")
