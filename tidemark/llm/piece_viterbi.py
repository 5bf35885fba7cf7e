"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a word has its characters as boundaries and vocabulary pieces as edges. For a BPE vocabulary an edge may only
follow a piece that it is compatible with: encoding the two pieces' text by merges gives back the two. A path of compatible
edges is the merge order's own result, so the search returns the ids of the published algorithm. The search keeps a window
of boundaries as long as the longest piece: once the backpointer paths of all of them meet in one boundary, everything before
it is committed and forgotten, so a word of any length needs bounded memory. Word starts are such boundaries too: no piece
goes on past one, except runs of the space mark, which merge from the left.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_batches

SPACE = "▁"
#: Known words and piece pairs of a worker; beyond that its memory starts anew.
WORD_MEMORY, PAIR_MEMORY = 800_000, 1_000_000
#: Words longer than this are not kept in memory.
LONG_WORD = 64


class Pieces:
    """The vocabulary of a model file and the two directions."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        size = len(model)
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte_id = {int(names[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.id = {names[i]: i for i in plain}
        self.name = names
        #: A piece's turn among merges: smaller merges earlier.
        self.turn = {i: -model.get_score(i) for i in plain}
        self.raw = [bytes([int(names[i][1:-1], 16)]) if model.is_byte(i) else names[i].encode() if i in self.turn else b"" for i in range(size)]
        if any(x != int(x) for x in self.turn.values()):
            raise ValueError("the scores are no merge turns: only BPE models are read, whose ids the merges fix")
        self.longest = max(len(names[i]) for i in plain)
        self.longest_run = max((len(names[i]) for i in plain if not names[i].strip(SPACE)), default=1)
        self.trie: dict = {}
        for i in plain:
            node = self.trie
            for ch in names[i]:
                node = node.setdefault(ch, {})
            node[""] = i
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.makeable: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def last_merge(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes this one; None for a single character or a piece that merges never make."""
        if piece not in self.parts:
            row, text = [self.id.get(c, -1) for c in self.name[piece]], self.name[piece]
            found = None
            while len(row) > 1:
                joins = [(self.turn[m], k, m) for k in range(len(row) - 1) if row[k] >= 0 and row[k + 1] >= 0 and (m := self.id.get(self.name[row[k]] + self.name[row[k + 1]], -1)) >= 0]
                if not joins:
                    break
                _, k, m = min(joins)
                if len(row) == 2 and self.name[m] == text:
                    found = (row[0], row[1])
                row[k : k + 2] = [m]
            self.parts[piece] = found
        return self.parts[piece]

    def usable(self, piece: int) -> bool:
        known = self.makeable.get(piece)
        if known is None:
            known = self.makeable[piece] = len(self.name[piece]) == 1 or self.last_merge(piece) is not None
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether merges on the joined text of a and b leave the boundary between them: undo the merges that made a and b,
        latest first, and look for an earlier merge across the boundary each time."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) > PAIR_MEMORY:
            self.pairs.clear()
        left, right, before = a, b, (float("inf"), 0)
        good = True
        while True:
            across = self.id.get(self.name[left] + self.name[right])
            # of two merges with one turn the one further left goes first
            if across is not None and (self.turn[across], 1) < before:
                good = False
                break
            l_parts, r_parts = self.last_merge(left), self.last_merge(right)
            if l_parts is None and r_parts is None:
                break
            if r_parts is None or (l_parts is not None and self.turn[left] > self.turn[right]):
                before, left = (self.turn[left], 1), l_parts[1]
            else:
                before, right = (self.turn[right], 2), r_parts[0]
        self.pairs[key] = good
        return good

    def search(self, word: str) -> Iterator[int]:
        """Ids of a word that holds the space mark at its start only, as soon as they are certain."""
        # back[k]: the edge (piece, start) that ends at boundary base + k; a negative piece is a character without one
        base, size = 0, len(word)
        back: list[tuple[int, int] | None] = [(0, 0)]
        i = 0
        while i < size:
            edge = back[i - base]
            if edge is not None:
                node, j, before = self.trie, i, edge[0]
                free = i == 0 or before < 0
                whole = False
                while j < size and (node := node.get(word[j])) is not None:
                    j += 1
                    piece = node.get("")
                    if piece is None:
                        continue
                    whole = whole or j == i + 1
                    if (free or self.compatible(before, piece)) and self.usable(piece):
                        while len(back) <= j - base:
                            back.append(None)
                        back[j - base] = (piece, i)
                if not whole:
                    while len(back) <= i + 1 - base:
                        back.append(None)
                    back[i + 1 - base] = (-1 - ord(word[i]), i)
            i += 1
            if len(back) <= i - base:
                back.append(None)
            if i - base > 4 * self.longest or i == size:
                ends = {size} if i == size else {k for k in range(max(base, i - self.longest), base + len(back)) if back[k - base] is not None}
                while len(ends) > 1:
                    far = max(ends)
                    ends.discard(far)
                    ends.add(max(base, back[far - base][1]))
                meet = min(ends)
                if meet > base:
                    path, k = [], meet
                    while k > base:
                        piece, start = back[k - base]
                        path.append(piece)
                        k = start
                    for piece in reversed(path):
                        if piece >= 0:
                            yield piece
                        else:
                            yield from (self.byte_id[b] for b in chr(-1 - piece).encode("utf-8", "surrogatepass"))
                    back = back[meet - base :]
                    base = meet

    def search_short(self, word: str) -> list[int]:
        """The same search for a word no longer than the window, whose paths need not be committed before its end."""
        size = len(word)
        ends: list[int | None] = [None] * (size + 1)  # the piece that ends at a boundary
        starts = [0] * (size + 1)
        trie, pairs, compatible = self.trie, self.pairs, self.compatible
        for i in range(size):
            before = ends[i] if i else -1
            if before is None:
                continue
            node, whole = trie, False
            for j in range(i, size):
                node = node.get(word[j])
                if node is None:
                    break
                piece = node.get("")
                if piece is None:
                    continue
                if j == i:
                    whole = True
                if before >= 0:
                    good = pairs.get(before << 20 | piece)
                    if good is None:
                        good = compatible(before, piece)
                    if not good:
                        continue
                if self.usable(piece):
                    ends[j + 1], starts[j + 1] = piece, i
            if not whole:
                ends[i + 1], starts[i + 1] = -1 - ord(word[i]), i
        path, k = [], size
        while k:
            piece = ends[k]
            if piece >= 0:
                path.append(piece)
            else:
                path += [self.byte_id[b] for b in reversed(chr(-1 - piece).encode("utf-8", "surrogatepass"))]
            k = starts[k]
        return path[::-1]

    def word_ids(self, word: str) -> bytes:
        """Ids of the space mark and a word, as little-endian 32-bit numbers."""
        known = self.words.get(word)
        if known is None:
            found = self.search_short(SPACE + word) if len(word) < 2 * self.longest else list(self.search(SPACE + word))
            known = struct.pack(f"<{len(found)}I", *found)
            if len(word) <= LONG_WORD:
                if len(self.words) > WORD_MEMORY:
                    self.words.clear()
                self.words[word] = known
        return known

    def run_ids(self, n: int) -> bytes:
        """Ids of n space marks alone: the longest run again and again, then the rest."""
        whole, rest = divmod(n, self.longest_run)
        marks = [self.longest_run] * whole + [rest] * (rest > 0)
        return np.array([self.id[SPACE * m] for m in marks], dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        words = text.replace(SPACE, " ").split(" ")
        if "" not in words:
            return np.frombuffer(b"".join(map(self.word_ids, words)), dtype="<u4")
        out, run = [], 0
        alone = np.array([self.id[SPACE]], dtype="<u4").tobytes()
        for word in words:
            run += 1
            if not word:
                continue
            own = self.word_ids(word)
            if own.startswith(alone):  # the word's first character doesn't merge with the mark, which then joins the run
                out += [self.run_ids(run), own[4:]]
            else:
                out += [self.run_ids(run - 1), own]
            run = 0
        return np.frombuffer(b"".join([*out, self.run_ids(run)]), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes put together, the mark as a space, without the one that encoding put first."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (array of int) of every text; a null or empty text has no ids. Repeated rows are encoded each; other
    columns are ignored; an empty table gives an empty table."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pieces(model_file)
        for part in series:
            yield pd.Series([own.encode(t or "").astype(np.int32) for t in part])

    return docs.select(F.col(id_col).alias(id_col), run(F.col(text_col)).alias("ids"))


def decode_ids(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of every array of ids; null ids give a null text, and null or unknown numbers inside count as nothing.

    Repeated rows and null document ids give a row each, arrays of any length are decoded whole, other columns don't matter, and
    an empty table gives an empty table."""
    text_batches(encoded.sparkSession)

    @F.pandas_udf("string")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pieces(model_file)
        for part in series:
            yield pd.Series([None if x is None else own.decode(np.array([i for i in x if i == i and 0 <= i < len(own.raw)], dtype=np.int64)) for x in part], dtype=object)

    return encoded.select(F.col(id_col).alias(id_col), run(F.col(ids_col)).alias("text"))


def encoding_digest(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_ids, ids_crc32 (little-endian 32-bit ids), decoded_sha256 and round_trip of every whole text (null: empty).

    round_trip says that decoding gives the text back; a text with the mark U+2581 in it comes back with spaces there. Repeated
    rows and null ids give a row each, other columns don't matter, and an empty table gives an empty table.
    """
    text_batches(docs.sparkSession)

    @F.pandas_udf("n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = pieces(model_file)
        for part in series:
            rows = []
            for text in part:
                ids = own.encode(text or "")
                back = own.decode(ids)
                rows.append((len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == (text or "")))
            yield pd.DataFrame(rows, columns=["n_ids", "ids_crc32", "decoded_sha256", "round_trip"])

    return docs.select(F.col(id_col).alias(id_col), run(F.col(text_col)).alias("x")).select(id_col, "x.*")
