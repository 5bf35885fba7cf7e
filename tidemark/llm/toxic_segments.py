"""Toxic passages as maximum-scoring segments of token log-odds.

Token log-odds between toxic and clean labelled documents carry an informative Dirichlet prior, the sample's own word
frequencies. Tokens whose log-odds are significant, toxic or clean, score them; what the sample says nothing sure of scores a
small drift below zero. A linear-time scan finds all maximal scoring segments of a text. Under clean text the best segment follows an extreme-value
law: the expected number of segments with score S in m tokens is K m exp(-lambda S). A document's evidence is the sum of
lambda S - ln(K m) over its segments that this law calls significant; a logistic curve on the labels turns it into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, text_batches
from tidemark.llm.mil_quality import in_fold, labelled_sample, sigmoid

#: Bytes of a text to bytes of its tokens: A-Z to lower case, ASCII punctuation and control characters to a space.
TOKEN_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Words of a worker's count table; beyond that they are handed on.
COUNT_MEMORY = 400_000


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TOKEN_BYTES).split()


def maximal_segments(position: list[int], gain: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score); position and gain are those of the tokens that have a
    score of their own, every other token scores -drift.

    Each segment on the list keeps the place of the nearest earlier one with a smaller sum before it, so that the way back
    never passes a segment twice: the scan is linear in the tokens.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before and at the end, place of the smaller one
    total, behind = 0.0, -1
    for at, score in zip(position, gain):
        total -= drift * (at - behind - 1)
        behind = at
        if score <= 0:
            total += score
            continue
        first, left, right = at, total, total + score
        total = right
        k = len(found) - 1
        while k >= 0 and found[k][2] >= left:
            k = found[k][4]
        while k >= 0 and found[k][3] < right:
            first, _, left, _, back = found[k]
            del found[k:]
            k = back
        found.append((first, at, left, right, k))
    return [(a, b, r - lo) for a, b, lo, r, _ in found]


class ToxicModel:
    """Lexicon, drift and the extreme-value law; evidence() is a document's calibrated sum."""

    def __init__(self, lexicon: dict[bytes, float], drift: float, lam: float, k: float):
        self.lexicon, self.drift, self.lam, self.k = lexicon, drift, lam, k
        self.slope, self.base = 1.0, -3.0

    def segments(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        lexicon = self.lexicon
        position = [i for i, w in enumerate(words) if w in lexicon]
        return maximal_segments(position, [lexicon[words[i]] for i in position], self.drift) if position else []

    def significant(self, words: list[bytes], level: float = 0.05) -> list[tuple[int, int, float, float]]:
        """Segments whose chance of occurring in clean text of this length is at most level: with -ln of their count."""
        size = np.log(max(self.k * max(len(words), 1), 1e-300))
        bits = [(a, b, s, self.lam * s - size) for a, b, s in self.segments(words)]
        return [x for x in bits if -np.expm1(-np.exp(-x[3])) <= level]

    def evidence(self, words: list[bytes]) -> float:
        return float(sum(max(0.0, x[3]) for x in self.significant(words)))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * np.log1p(evidence) + self.base)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float, prior_mass: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratios and their z-scores under a Dirichlet prior of that mass in proportion to toxic + clean."""
    prior = prior_mass * (toxic + clean) / max(n_toxic + n_clean, 1)
    a, b = toxic + prior, clean + prior
    delta = np.log(a / (n_toxic + prior_mass - a)) - np.log(b / (n_clean + prior_mass - b))
    return delta, delta / np.sqrt(1 / a + 1 / b)


def segment_rate(lexicon_scores: np.ndarray, share: np.ndarray, drift: float) -> float:
    """The positive lambda with sum(p * exp(lambda * s)) = 1 over clean tokens."""
    rest = max(0.0, 1 - share.sum())
    total = lambda x: float((share * np.exp(x * lexicon_scores)).sum() + rest * np.exp(-x * drift))
    low, high = 1e-6, 1.0
    while total(high) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (low, mid) if total(mid) >= 1 else (mid, high)
    return (low + high) / 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, held_out: int, folds: int, max_labelled: int, prior_share: float = 0.025, least_z: float = 3.0, least_odds: float = 1.0) -> ToxicModel:
    """Train on at most max_labelled labelled rows outside the held-out fold; the sample bounds the lexicon, since a word of
    significant log-odds is in several of its texts."""
    sample = labelled_sample(docs, labels, label_col, in_fold(folds) != held_out, max_labelled, id_col, text_col)
    text_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """How many documents of each kind hold a word, and how often; the word '' counts documents and the word ' ' tokens."""
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        often: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush():
            rows = [(w, n, often[kind][w], kind) for kind, c in seen.items() for w, n in c.items()]
            for c in (*seen.values(), *often.values()):
                c.clear()
            return pd.DataFrame(rows, columns=["word", "n", "tokens", "label"])

        for frame in batches:
            for text, kind in zip(frame["text"], frame["label"]):
                words = tokens(text)
                seen[kind].update(set(words))
                often[kind].update(words)
                seen[kind][b""] += 1
                seen[kind][b" "] += len(words)
            if len(seen[0]) + len(seen[1]) > COUNT_MEMORY:
                yield flush()
        yield flush()

    counted = sample.select("text", "label").mapInPandas(count, "word binary, n long, tokens long, label int")
    per_word = counted.groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
        F.sum(F.when(F.col("label") == 0, F.col("tokens")).otherwise(0)).alias("often"),
    )
    plain = ~F.col("word").isin(bytearray(b""), bytearray(b" "))
    sizes = {bytes(r.word): (r.toxic, r.clean) for r in per_word.where(~plain).collect()}
    (docs_t, docs_c), (_, tokens_c) = sizes.get(b"", (0, 0)), sizes.get(b" ", (0, 0))
    if not docs_t or not docs_c:
        return ToxicModel({}, 0.5, 1.0, 1.0)
    # A word of fewer documents than this can't have a z-score of least_z.
    rows = per_word.where(plain & (F.col("toxic") + F.col("clean") >= 3)).orderBy("word").toPandas()
    toxic, clean = rows["toxic"].to_numpy(float), rows["clean"].to_numpy(float)
    prior_mass = prior_share * (docs_t + docs_c)
    delta, z = log_odds(toxic, clean, docs_t, docs_c, prior_mass)
    # Long documents lend common words a small, significant lean; a telling word is commoner by a factor e at least.
    on = (np.abs(z) >= least_z) & (np.abs(delta) >= least_odds)
    lexicon = dict(zip(map(bytes, rows["word"][on]), delta[on].tolist()))
    if not (delta[on] > 0).any():
        return ToxicModel({}, 0.5, 1.0, 1.0)
    drift = 0.5
    # The law is one of tokens: how often clean text says a word, not in how many documents.
    share = (rows["often"].to_numpy(float)[on] + prior_mass * (toxic + clean)[on] / (docs_t + docs_c) / docs_c) / max(tokens_c, 1)
    model = ToxicModel(lexicon, drift, segment_rate(delta[on], share, drift), 1.0)

    def study(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            words = [tokens(t) for t in frame["text"]]
            best = [[s for _, _, s in model.segments(w)] for w in words]
            yield pd.DataFrame({"label": frame["label"], "m": [len(w) for w in words], "over": [sum(x >= floor for x in b) for b in best]})

    floor = float(np.median(delta[on & (delta > 0)]))
    # K: how often clean training text has a segment of at least a middling score, against the law's exponential.
    m, over = sample.select("text", "label").mapInPandas(study, "label int, m long, over long").where("label = 0").agg(F.sum("m"), F.sum("over")).first()
    model.k = (over + 0.5) / (max(m, 1) * np.exp(-model.lam * floor))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield pd.DataFrame({"label": frame["label"], "evidence": [model.evidence(tokens(t)) for t in frame["text"]]})

    seen = sample.select("text", "label").mapInPandas(weigh, "label int, evidence double").toPandas()
    x, y = np.log1p(seen["evidence"].to_numpy()), seen["label"].to_numpy(float)
    a, b = 1.0, -1.0
    for _ in range(500):  # Newton steps of a logistic curve with a weak prior, so separated data stay finite
        p = sigmoid(a * x + b)
        r, v = p - y, np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(r * x).sum() + 0.01 * a, r.sum() + 0.01 * b])
        curve = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        move = np.linalg.solve(curve, grad)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
        if abs(move).max() < 1e-8:
            break
    model.slope, model.base = float(a), float(b)
    discard(sample)
    return model


def toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 0, folds: int = 5, max_labelled: int = 20_000) -> ToxicModel:
    return fit(docs, labels, id_col, text_col, label_col, held_out, folds, max_labelled)


def evidence_udf(model: ToxicModel):
    """A pandas UDF from a text to its struct of score, number of significant segments and toxic tokens."""

    @F.pandas_udf("score double, passages int, first int, last int")
    def study(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in series:
            rows = []
            for text in part:
                found = model.significant(tokens(text))
                best = max(found, key=lambda x: x[3], default=(-1, -1, 0, 0))
                rows.append((sum(max(0.0, x[3]) for x in found), len(found), best[0], best[1]))
            out = pd.DataFrame(rows, columns=["score", "passages", "first", "last"])
            out["score"] = model.score(out["score"].to_numpy(dtype=float))
            yield out.astype({"passages": "int32", "first": "int32", "last": "int32"})

    return study


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 0, folds: int = 5, **options) -> DataFrame:
    """One row per document: id, held_out, score, predicted (1 if score >= 0.5), passages (significant segments) and the
    first and last token of the most significant one (-1: none).

    Null and empty texts have no segment and get the lowest score; repeated rows are scored each; a null id counts as the
    empty text for its fold. Without labels of both kinds no word is toxic. An empty table gives an empty table.
    """
    model = toxicity_model(docs, labels, id_col, text_col, held_out=held_out, folds=folds, **options)
    seen = docs.select(F.col(id_col).alias("id"), evidence_udf(model)(F.col(text_col)).alias("x"))
    return seen.select(
        F.col("id").alias(id_col),
        (in_fold(folds) == held_out).alias("held_out"),
        F.col("x.score").alias("score"),
        F.when(F.col("x.score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
        F.col("x.passages").alias("passages"),
        F.col("x.first").alias("first_token"),
        F.col("x.last").alias("last_token"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all their columns, whose toxicity score is below 0.5.

    Null and empty texts have no evidence and stay, repeated rows stay or go together, columns of any name pass through, an
    empty table stays empty. Without labels of both kinds every row stays."""
    model = toxicity_model(docs, labels, text_col=text_col, **options)
    return docs.where(evidence_udf(model)(F.col(text_col))["score"] < 0.5)
