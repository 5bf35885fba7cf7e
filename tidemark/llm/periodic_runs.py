"""Periodic runs of words: a suffix automaton whose link tree is a link-cut tree that knows every substring's last end.

Words are appended one by one. The path from the new state to the root holds all suffixes of what was read; a preferred path
of the link-cut tree is a piece of it whose substrings last ended at one common word. Access to the new state walks these
pieces and recolours them with the new end. A piece whose last end lies d words back and whose longest suffix has L >= d words
is a square of period d; the stretch of L + d words has that period, can't be longer to the left, and no smaller period has
it if L >= 2 d (the suffix would have ended later). It is a run if the next word breaks the period.

In a run of three periods and 24 words every 8 words occur again inside the run, at most a period away. Stretches of a text
that lack this can't hold a run or a part of one: the automaton starts anew behind them. This only spares work, and a
collision of the hashes it uses can only make a stretch longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_batches

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words that must occur again inside a run; of 24 words and three periods, up to nine in a row do.
GRAM = 8
#: Rounds of looking for stretches inside stretches.
REFINED = 6
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class LastEnds:
    """Suffix automaton over numbered words. append() returns the pieces of the new state's path: (words, last end)."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        # Splay trees of preferred paths, by depth. Node v is state v - 1, 0 is none. `up` is a parent inside a splay tree, or
        # of its root the state above the path. The colour of a path, its substrings' last end, is kept at the root alone.
        self.left, self.right, self.up, self.colour = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.size = 0, 0

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.left.append(0)
        self.right.append(0)
        self.up.append(0)
        self.colour.append(-1)
        return len(self.length) - 1

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if left[y] == x:
            moved = left[y] = right[x]
            right[x] = y
        else:
            moved = right[y] = left[x]
            left[x] = y
        if moved:
            up[moved] = y
        up[y], up[x] = x, z
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            self.colour[x] = self.colour[y]

    def _splay(self, x: int) -> None:
        """Make x the root of its splay tree; the path's colour and the way up move to it."""
        left, right, up = self.left, self.right, self.up
        while (y := up[x]) and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self._rotate(y if (left[y] == x) == (left[z] == y) else x)
            self._rotate(x)

    def append(self, word: int) -> list[tuple[int, int]]:
        follow, length, link = self.next, self.length, self.link
        end = self.size
        self.size += 1
        new = self._state(length[self.last] + 1, 0, {})
        p = self.last
        while p >= 0 and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        if p >= 0:
            q = follow[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = self._state(length[p] + 1, link[q], dict(follow[q]))
                # The copy stands right above q on q's own path, and so has its colour.
                self._splay(q + 1)
                above = self.left[q + 1]
                self.left[q + 1], self.up[copy + 1], self.left[copy + 1] = copy + 1, q + 1, above
                if above:
                    self.up[above] = copy + 1
                while p >= 0 and follow[p].get(word) == q:
                    follow[p][word] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.up[new + 1] = link[new] + 1
        self.last = new
        return self._access(new + 1, end)

    def _access(self, v: int, end: int) -> list[tuple[int, int]]:
        right, up, colour = self.right, self.up, self.colour
        pieces, x, below = [], v, 0
        while x:
            self._splay(x)
            if colour[x] >= 0 and x > 1:
                pieces.append((self.length[x - 1], colour[x]))
            cut = right[x]
            if cut:  # what hangs below keeps its colour as a path of its own
                colour[cut] = colour[x]
            right[x] = below
            below, x = x, up[x]
        colour[below] = end
        return pieces


def stretches(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of grams, by their codes, that can hold a run: each gram occurs again inside, at most a third of it away."""
    todo = [(0, len(codes), 0)]
    while todo:
        a, b, turn = todo.pop()
        words = b - a + GRAM - 1
        if words < LEAST_WORDS:
            continue
        if turn == REFINED:
            yield a, b
            continue
        order = np.argsort(codes[a:b], kind="stable")
        sorted_ = codes[a:b][order]
        close = (sorted_[1:] == sorted_[:-1]) & (np.diff(order) <= words // LEAST_PERIODS)
        again = np.zeros(b - a + 2, bool)
        again[order[1:][close] + 1] = True
        again[order[:-1][close] + 1] = True
        edges = np.flatnonzero(again[1:] != again[:-1])
        for c, d in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if (c, d) == (0, b - a):
                yield a, b
            else:
                todo.append((a + c, a + d, turn + 1))


def gram_codes(words: list[bytes]) -> np.ndarray:
    x = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    out = np.zeros(len(words) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        out = out * FACTOR + x[i : i + len(out)]
    return out


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) by start, then period."""
    found = []
    n = len(words)
    if n < LEAST_WORDS:
        return found
    for a, b in stretches(gram_codes(words)):
        own = words[a : b + GRAM - 1]
        numbers: dict[bytes, int] = {}
        ids = [numbers.setdefault(w, len(numbers)) for w in own]
        ends = LastEnds()
        for i, word in enumerate(ids):
            for size, last in ends.append(word):
                period = i - last
                if size >= (LEAST_PERIODS - 1) * period and size + period >= LEAST_WORDS and (i + 1 == len(ids) or ids[i + 1] != ids[i + 1 - period]):
                    found.append((a + i - size - period + 1, size + period, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words), bool)
    for start, length, period in runs:
        dropped[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~dropped).tolist()]


RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])
STUDY = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


@F.pandas_udf(STUDY)
def study(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in series:
        rows = []
        for text in part:
            words = (text or "").encode("utf-8", "surrogatepass").split()
            runs = runs_of(words)
            kept = b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")
            rows.append((len(words), [{"start": s, "length": n, "period": p} for s, n, p in runs], kept))
        yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs (array of start, length, period in words, by start and period) and collapsed,
    the words that stay, joined by one space, when each run keeps its first period only.

    Words are what ASCII white space parts, compared as they are. Null and empty texts have no words and no runs, and an empty
    text stays; repeated rows and null ids give a row each; very long texts are read whole, in memory of their repeating
    stretches' size. Other columns don't matter, whatever their names. An empty table gives an empty table.
    """
    text_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), study(F.col(text_col)).alias("x")).select(F.col("id").alias(id_col), "x.n_words", "x.runs", "x.collapsed")
