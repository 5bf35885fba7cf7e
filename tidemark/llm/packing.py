"""Packing of token sequences as vector bin packing by the dot-product heuristic.

A document's ids are cut where the next one would pass the limit of tokens or of loss-bearing tokens; pieces that fill a limit
are sequences of their own, and the rest is packed under three limits at once: tokens, segments and loss-bearing tokens. In
instruction data only the answers bear loss: a column of character spans says which parts of a text do. A bin takes, again and again, the fitting rest
whose demand vector has the largest dot product with what the bin has left. The work needs no shuffle: every partition
of the input packs its own rests, a bounded pool of them at a time, and hands bins that are not yet full to the next pool.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_batches

END_ID = 1
SPANS = "array<struct<start:int,end:int>>"
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)


@functools.lru_cache(maxsize=4)
def encoder(vocabulary: str):
    """The byte-level BPE as an encoder. The rank file beside the tokenizers file holds the same vocabulary and gives the
    same ids (tests compare them) at four times the speed; a vocabulary without one is read by tokenizers itself."""
    import base64
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    ranks = vocabulary.removesuffix(".json") + ".tiktoken"
    if os.path.exists(ranks):
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    own = Tokenizer.from_file(vocabulary)
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=4)
def id_bytes(vocabulary: str) -> np.ndarray:
    """How many bytes of text each id of a byte-level vocabulary stands for: a character of its name is a byte."""
    from tokenizers import Tokenizer

    names = Tokenizer.from_file(vocabulary).get_vocab()
    out = np.zeros(max(names.values()) + 1, dtype=np.int64)
    for name, i in names.items():
        out[i] = len(name)
    return out


def loss_mask(text: str, ids: np.ndarray, spans: list | None, width: np.ndarray) -> np.ndarray:
    """Which ids of a text and its end bear loss: those whose first byte lies in a span of characters, and the end if the
    last span goes to the text's end. Without spans (null) all do."""
    out = np.ones(len(ids), dtype=bool)
    if spans is not None:
        sizes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        byte = np.concatenate([[0], np.cumsum(1 + (sizes > 0x7F) + (sizes > 0x7FF) + (sizes > 0xFFFF))])
        mark = np.zeros(int(byte[-1]) + 2, dtype=np.int64)
        for start, end in spans:
            start, end = (min(max(0, x), len(sizes)) for x in (start, end))
            if start < end:
                mark[byte[start]] += 1
                mark[byte[end] + (end == len(sizes))] -= 1
        at = np.concatenate([[0], np.cumsum(width[ids[:-1]])])
        out = np.cumsum(mark)[np.minimum(at, byte[-1])] > 0
    return out


def cuts(mask: np.ndarray, max_tokens: int, max_loss_tokens: int) -> list[int]:
    """Where pieces end: each as long as both limits let it be. The first id of a piece has nothing before it to be told
    from, so it bears no loss there."""
    total, ends, start = np.concatenate([[0], np.cumsum(mask)]), [], 0
    while start < len(mask):
        most = int(np.searchsorted(total, total[start + 1] + max_loss_tokens, "right")) - 1
        start = min(len(mask), start + max_tokens, most)
        ends.append(start)
    return ends


def dot_product_bins(demand: np.ndarray) -> list[np.ndarray]:
    """Bins of row numbers; demand has a row for each item and a column for each limit, as shares of the limit."""
    free = np.arange(len(demand))
    bins = []
    while len(free):
        left, chosen = np.ones(demand.shape[1]), []
        fits = np.arange(len(free))
        while len(fits):
            rows = demand[free[fits]]
            best = int(np.argmax(rows @ left))
            chosen.append(fits[best])
            left = left - rows[best]
            fits = np.delete(fits, best)
            fits = fits[(demand[free[fits]] <= left + 1e-12).all(axis=1)]
        bins.append(free[chosen])
        free = np.delete(free, chosen)
    return bins


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 2048,
    max_segments: int = 64,
    max_loss_tokens: int = 2048,
    loss_col: str | None = None,
    pool: int = 2048,
    full_enough: float = 0.99,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    A document's ids are those of its whole text (null: empty) and the end id. loss_col names an array of structs (start,
    end) of characters, the parts that bear loss; without it, or where it is null, all ids do but the first of a piece,
    which has nothing before it to be told from. No sequence passes max_tokens, max_segments or max_loss_tokens (at least
    1). An empty text is a piece of one id; a null doc_id stays null; repeated rows are packed each. Other columns are
    ignored; an empty table gives no pieces.
    """
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        rows: list[tuple] = []
        rests: list[tuple] = []

        def put(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for p in pieces:
                rows.append((*p[:5], number, offset, p[5]))
                offset += p[2]
            number += 1

        def demand() -> np.ndarray:
            """The rests' shares of each limit."""
            length = np.array([p[2] for p in rests], dtype=np.float64)
            return np.column_stack([length / max_tokens, np.full(len(rests), 1 / max_segments), np.array([p[5] for p in rests]) / max_loss_tokens])

        def settle(last: bool) -> None:
            """Place the pool's full bins and keep the rests of the others; at the end, or where half a pool would stay,
            place them all, so that memory stays bounded."""
            nonlocal rests
            need = demand()
            bins = dot_product_bins(need)
            full = [last or need[b].sum(axis=0).max() >= full_enough for b in bins]
            if sum(len(b) for b, f in zip(bins, full) if not f) > pool // 2:
                full = [True] * len(bins)
            for chosen, on in zip(bins, full):
                if on:
                    put([rests[i] for i in chosen])
            rests = [rests[i] for chosen, on in zip(bins, full) if not on for i in chosen]

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 8
            rows.clear()
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            ids_of, texts, spans_of = (batch.column(i).to_pylist() for i in range(3))
            for doc, text, spans in zip(ids_of, texts, spans_of):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                mask = loss_mask(text or "", ids, spans and [(x["start"], x["end"]) for x in spans if x] if spans is not None else None, id_bytes(vocabulary) if spans is not None else None)
                start = 0
                for end in cuts(mask, max_tokens, max_loss_tokens):
                    piece = ids[start:end]
                    entry = (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), int(mask[start + 1 : end].sum()))
                    if len(piece) == max_tokens or entry[5] == max_loss_tokens:
                        put([entry])
                    else:
                        rests.append(entry)
                    start = end
                if len(rests) >= pool:
                    settle(False)
            if len(rows) >= 8192:
                yield flush()
        settle(True)
        yield flush()

    spans = F.col(loss_col).cast(SPANS) if loss_col else F.lit(None).cast(SPANS)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), spans.alias("spans")).mapInArrow(run, SCHEMA)
