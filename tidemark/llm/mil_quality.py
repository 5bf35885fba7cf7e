"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of a fixed number of words. A passage is encoded from hashed words, word shapes and
repetition; a hidden layer maps it to a vector, gated attention (tanh times sigmoid) weighs the passages of a document,
and the weighted vector is scored. Only document labels are needed: the attention learns which passages tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, text_batches, written

PASSAGE_WORDS = 64
HASHED, SHAPES, EXTRA = 512, 64, 5
WIDTH = HASHED + SHAPES + EXTRA
#: Known words of a worker; beyond that the memory of words starts anew.
WORD_MEMORY = 500_000
#: Passages that are encoded at once.
AT_ONCE = 8192


def shape_of(word: bytes) -> int:
    """0..63 from the last character's kind, other symbols inside, digits and length."""
    letters = sum(c >= 128 or 97 <= (c | 32) <= 122 for c in word)
    digits = sum(48 <= c <= 57 for c in word)
    symbols = len(word) - letters - digits
    end = word[-1]
    last = 0 if end >= 128 or 97 <= (end | 32) <= 122 else 1 if 48 <= end <= 57 else 2 if end in b".,;:!?" else 3
    size = (len(word) > 3) + (len(word) > 7) + (len(word) > 14)
    return last * 16 + (symbols > 1) * 8 + (digits > 0) * 4 + size


class WordCodes(dict):
    """64-bit codes of words: a hash whose low six bits are the word's shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORD_MEMORY:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word) & ~63 | shape_of(word)
        return code


def encode(texts: list[str], codes: WordCodes) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors (float32) and how many passages each text has (an empty text has one, all zeros)."""
    rows, sizes = [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split()
        n = len(words)
        count = max(1, -(-n // PASSAGE_WORDS))
        x = np.zeros((count, WIDTH), dtype=np.float32)
        sizes.append(count)
        rows.append(x)
        if not n:
            continue
        code = np.fromiter(map(codes.__getitem__, words), dtype=np.uint64, count=n)
        at = np.arange(n) // PASSAGE_WORDS
        length = np.bincount(at, minlength=count).astype(np.float32)
        hashed = np.bincount(at * HASHED + ((code >> np.uint64(6)) % np.uint64(HASHED)).astype(np.int64), minlength=count * HASHED)
        shapes = np.bincount(at * SHAPES + (code & np.uint64(63)).astype(np.int64), minlength=count * SHAPES)
        x[:, :HASHED] = np.sqrt(hashed.reshape(count, HASHED) / length[:, None])
        x[:, HASHED : HASHED + SHAPES] = 2 * shapes.reshape(count, SHAPES) / length[:, None]
        full = np.full(count * PASSAGE_WORDS, np.uint64(2**64 - 1))
        full[:n] = code
        table = np.sort(full.reshape(count, PASSAGE_WORDS), axis=1)
        fresh = 1 + (table[:, 1:] != table[:, :-1]).sum(axis=1)
        fresh[-1] -= n % PASSAGE_WORDS > 0  # the filler counted as a word
        same = np.bincount(at[1:], code[1:] == code[:-1], minlength=count)
        x[:, -5] = 3 * fresh / length
        x[:, -4] = 3 * same / length
        x[:, -3] = np.log1p(length) / 4
        x[:, -2] = len(text) / n / 8
        x[:, -1] = np.log1p(n) / 8
    return np.concatenate(rows) if rows else np.zeros((0, WIDTH), np.float32), np.array(sizes, dtype=np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionModel:
    """Weights of the encoder, the gated attention and the output; train() is plain minibatch Adam."""

    def __init__(self, hidden: int = 32, gate: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        draw = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.w = {"E": draw(WIDTH, hidden), "e": np.zeros(hidden, np.float32), "V": draw(hidden, gate), "U": draw(hidden, gate), "g": draw(gate, 1), "c": draw(hidden, 1), "b": np.zeros(1, np.float32)}
        self.seed = seed

    def forward(self, x: np.ndarray, first: np.ndarray, bag: np.ndarray) -> dict:
        w = self.w
        h = np.maximum(x @ w["E"] + w["e"], 0)
        t, s = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
        a = ((t * s) @ w["g"])[:, 0]
        a = np.exp(a - np.maximum.reduceat(a, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": sigmoid((z @ w["c"])[:, 0] + w["b"][0])}

    def score(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return self.forward(x, first, np.repeat(np.arange(len(sizes)), sizes))["p"]

    def gradient(self, x, first, bag, y, decay):
        w, f = self.w, self.forward(x, first, bag)
        d = ((f["p"] - y) / len(y)).astype(np.float32)
        dz = d[:, None] * w["c"].T
        da = (dz[bag] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[bag])
        gate = de[:, None] * w["g"].T
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz[bag] + dt @ w["V"].T + ds @ w["U"].T) * (f["h"] > 0)
        g = {"E": x.T @ dh, "e": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "g": (f["t"] * f["s"]).T @ de[:, None], "c": f["z"].T @ d[:, None], "b": d.sum(keepdims=True)}
        return {k: v + decay * w[k] for k, v in g.items()}

    def train(self, x, sizes, y, epochs: int = 20, batch: int = 64, rate: float = 3e-3, decay: float = 1e-4) -> AttentionModel:
        r = np.random.default_rng(self.seed)
        ends = np.cumsum(sizes)
        m, v, step = {k: 0 for k in self.w}, {k: 0 for k in self.w}, 0
        for epoch in range(epochs):
            now = rate * (1 - epoch / epochs)
            order = r.permutation(len(sizes))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                n = sizes[own]
                rows = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in own])
                first = np.concatenate([[0], np.cumsum(n)[:-1]])
                step += 1
                for k, g in self.gradient(x[rows], first, np.repeat(np.arange(len(own)), n), y[own], decay).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.w[k] = (self.w[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, bound: int, id_col: str, text_col: str, max_bytes: int | None = None) -> DataFrame:
    """A written table of id, text and label of at most `bound` labelled rows, the same ones on every run: those with the
    smallest id hashes, as far as whole texts of max_bytes together go (and the one that passes it).

    Rows whose id or label is null, and labels that are not 0 or 1, are left out; of a repeated id the largest label
    holds and one of its texts is taken.
    """
    own = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
    ids = own.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & usable).groupBy("id").agg(F.max("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(bound)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # ids has at most `bound` rows of two numbers
    found = texts.join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    found = written(found, "sample")
    if max_bytes is None:
        return found
    # One row of two numbers for each of at most `bound` texts.
    sizes = found.select("id", F.octet_length("text").alias("size"))
    ahead = F.coalesce(F.sum("size").over(Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.join(F.broadcast(sizes.select("id", ahead.alias("ahead")).where(F.col("ahead") < max_bytes).select("id")), "id")


def in_fold(modulus: int, col: str = "id") -> Column:
    """crc32 of the id as text, modulo modulus."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def quality_scorer(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    held_out: int = 1,
    folds: int = 3,
    max_labelled: int = 4000,
    max_labelled_bytes: int = 32 << 20,
):
    """A pandas UDF from a text to its score, trained in one task on the labelled sample outside the held-out fold: at most
    max_labelled texts, of max_labelled_bytes together.

    Without labels of both kinds every score is the share of label 1 (0.5 without any).
    """
    sample = labelled_sample(docs, labels, label_col, in_fold(folds) != held_out, max_labelled, id_col, text_col, max_labelled_bytes)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for frame in batches for r in zip(frame["id"], frame["text"], frame["label"])]
        rows.sort(key=lambda r: r[0])
        y = np.array([r[2] for r in rows], dtype=np.float32)
        if 0 < y.sum() < len(y):
            weights = AttentionModel().train(*encode([r[1] for r in rows], WordCodes()), y).w
            yield pd.DataFrame({"name": list(weights), "rows": [w.shape[0] for w in weights.values()], "value": [w.astype("<f4").tobytes() for w in weights.values()]})
        yield pd.DataFrame({"name": ["share"], "rows": [1], "value": [np.float32(y.mean() if len(y) else 0.5).tobytes()]})

    fitted = {r["name"]: np.frombuffer(r["value"], "<f4").reshape(r["rows"], -1) for r in sample.repartition(1).mapInPandas(fit, "name string, rows int, value binary").collect()}
    discard(sample)
    share, model = float(fitted.pop("share")[0, 0]) if fitted else 0.5, None
    if fitted:
        model = AttentionModel()
        model.w = {k: v.reshape(model.w[k].shape) for k, v in fitted.items()}

    @F.pandas_udf("double")
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes = WordCodes()
        for part in series:
            texts = part.fillna("").tolist()
            out = np.full(len(texts), share)
            at = 0
            while model is not None and at < len(texts):  # as many texts as make a bounded number of passages
                to, weight = at, 0
                while to < len(texts) and (to == at or weight + len(texts[to]) < AT_ONCE * 4 * PASSAGE_WORDS):
                    weight += len(texts[to])
                    to += 1
                out[at:to] = model.score(*encode(texts[at:to], codes))
                at = to
            yield pd.Series(out)

    text_batches(docs.sparkSession)
    return score


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1, folds: int = 3, **options) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Null and empty texts are scored as a bag of one empty passage; repeated rows are scored each; a null id counts as the
    empty text for its fold. Other columns are ignored; an empty table gives an empty table.
    """
    score = quality_scorer(docs, labels, id_col, text_col, held_out=held_out, folds=folds, **options)
    scored = docs.select(F.col(id_col).alias("id"), score(F.col(text_col)).alias("score"))
    return scored.select(
        F.col("id").alias(id_col),
        (in_fold(folds) == held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all their columns, that score at least 0.5.

    Null and empty texts are one empty passage, repeated rows stay or go together, columns of any name pass through, an
    empty table stays empty. Without labels of both kinds the share of label 1 decides for all rows alike."""
    score = quality_scorer(docs, labels, text_col=text_col, **options)
    return docs.where(score(F.col(text_col)) >= 0.5)
