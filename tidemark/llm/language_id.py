"""Language identification word by word: known words first, then ever shorter character n-grams.

Words are runs of letters in lower case. A word that training texts hold twice or more scores its log frequency in each
language. Any other word scores the mean log frequency of its n-grams, which see the word's ends, of the greatest n of which any is
known. A text's language has the largest sum over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, text_batches, written
from tidemark.llm.mil_quality import in_fold

#: Runs of letters, and of the few numerals that are neither letters nor digits.
WORDS = re.compile(r"[^\W\d_]+")
#: Longest n-grams, counts that make a word or n-gram known, and what is added to every count.
LONGEST, LEAST_COUNT, ADDED = 5, 2, 0.5
#: Words of a worker's count table, and unseen words whose scores a worker remembers.
COUNT_MEMORY, WORD_MEMORY = 400_000, 300_000
#: Tasks that cut the sample's words into n-grams.
CUTS = 16
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def has_letter(word: str) -> bool:
    return word.isalpha() or any(c.isalpha() for c in word)


def grams(word: str, n: int) -> list[str]:
    """n-grams of the word, marked at both ends unless n is 1."""
    text = f"\x01{word}\x02" if n > 1 else word
    return [text[i : i + n] for i in range(len(text) - n + 1)]


class Rows(dict):
    """Rows of `logs` by word, row 0 being that of words without a letter. A word that isn't there gets a row of its own;
    reserve() makes room, forgetting such words."""

    def __init__(self, known: list[str], logs: np.ndarray, unseen) -> None:
        super().__init__(zip(known, range(1, len(known) + 1)))
        self.logs, self.unseen, self.recent = np.vstack([np.zeros((1, logs.shape[1])), logs]), unseen, []
        self.first = self.next = len(self.logs)

    def reserve(self, n: int) -> None:
        if self.next + n > len(self.logs):
            for w in self.recent:
                del self[w]
            self.recent, self.next = [], self.first
            more = self.first + max(n, WORD_MEMORY) - len(self.logs)
            if more > 0:
                self.logs = np.vstack([self.logs, np.zeros((more, self.logs.shape[1]))])

    def __missing__(self, word: str) -> int:
        self.recent.append(word)
        if not has_letter(word):
            self[word] = 0
            return 0
        at = self[word] = self.next
        self.logs[at] = self.unseen(word)
        self.next += 1
        return at


class LanguageModel:
    """Log frequencies by language of known words and of n-grams (a table for each n)."""

    def __init__(self, languages: list[str], words: tuple[list[str], np.ndarray], tables: list[tuple[list[str], np.ndarray]]):
        self.languages, self.words, self.tables = languages, words, tables
        self.rows = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rows": None}

    def backed_off(self, word: str) -> np.ndarray:
        """Mean log frequencies of the word's known n-grams of the greatest n that has any."""
        for n in range(len(self.tables), 0, -1):
            get = self.places[n - 1].get
            known = [k for g in grams(word, n) if (k := get(g)) is not None]
            if known:
                return np.add.reduce(self.tables[n - 1][1].take(known, 0), 0) / len(known)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language (ties to the first in order) and its share of the languages' likelihoods; `und`, 0 without letters
        or without languages."""
        words = words_of(text)
        if not words or not self.languages:
            return UNKNOWN, 0.0
        if self.rows is None:
            self.places = [dict(zip(names, range(len(names)))) for names, _ in self.tables]
            self.rows = Rows(*self.words, self.backed_off)
        self.rows.reserve(len(words))
        at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        if not at.any():
            return UNKNOWN, 0.0
        sums = np.add.reduce(self.rows.logs.take(at, 0), 0)
        best = int(sums.argmax())
        return self.languages[best], float(1 / np.exp(np.minimum(0, sums - sums[best])).sum())


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, held_out: int, folds: int, per_language: int, max_languages: int, max_bytes: int) -> DataFrame:
    """A written table of text and lang: of each of the max_languages languages with most rows those whose id hash is below
    its share, about per_language rows and an equal part of max_bytes, the same rows on every run."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (in_fold(folds) != held_out))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    many = [r.asDict() for r in sizes.orderBy(F.desc("n"), "lang").limit(max_languages).collect()]
    share = {r["lang"]: min(1, per_language / r["n"], max_bytes / len(many) / max(1, r["bytes"])) for r in many}
    below = F.lit(0.0)
    for lang, part in share.items():
        below = F.when(F.col("lang") == lang, part).otherwise(below)
    return written(usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30) < below).select("text", "lang"), "sample")


def log_frequencies(counted: DataFrame, key: str, languages: list[str]) -> tuple[list[str], np.ndarray]:
    """From counts (key, lang, n): the keys that occur LEAST_COUNT times or more, in order, and log((count + ADDED) / (total +
    ADDED * keys)) by language, totals being those of these keys."""
    kept = counted.groupBy(key).agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("x")).where(F.col("all") >= LEAST_COUNT)
    rows = kept.select(key, F.explode("x").alias("x")).select(key, "x.lang", "x.n").toArrow().to_pandas()
    codes, names = pd.factorize(rows[key], sort=True)
    counts = np.zeros((len(names), len(languages)))
    place = {x: i for i, x in enumerate(languages)}
    np.add.at(counts, (codes, rows["lang"].map(place).to_numpy(dtype=int)), rows["n"].to_numpy(float))
    return list(names), np.log((counts + ADDED) / (counts.sum(0) + ADDED * max(1, len(names))))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 2, folds: int = 4, per_language: int = 2000, max_languages: int = 200, max_bytes: int = 16_000_000) -> LanguageModel:
    """Fit on a bounded sample of labelled rows outside the held-out fold: about per_language texts of each of the max_languages
    commonest languages, of about max_bytes together. The sample bounds the words, the n-grams and the driver's model."""
    spark = docs.sparkSession
    text_batches(spark)
    sample = training_sample(docs, id_col, text_col, lang_col, held_out, folds, per_language, max_languages, max_bytes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(w, g, n) for (w, g), n in seen.items()], columns=["word", "lang", "n"])
            seen.clear()
            return out

        for frame in batches:
            for text, lang in zip(frame["text"], frame["lang"]):
                for w, n in Counter(words_of(text)).items():
                    if has_letter(w):
                        seen[w, lang] += n
            if len(seen) > COUNT_MEMORY:
                yield flush()
        yield flush()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            seen: Counter = Counter()
            for word, lang, n in zip(frame["word"], frame["lang"], frame["n"]):
                for size in range(1, LONGEST + 1):
                    for g in grams(word, size):
                        seen[size, g, lang] += n
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["size", "gram", "lang", "n"])

    counted = sample.mapInPandas(count, "word string, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    counted = written(counted, "words")
    # Dealt anew, as the written table is small and may be one file.
    pieces = counted.repartition(CUTS, "word").mapInPandas(cut, "size int, gram string, lang string, n long").groupBy("size", "gram", "lang").agg(F.sum("n").alias("n"))
    pieces = written(pieces, "pieces")
    languages = [r.lang for r in counted.select("lang").distinct().orderBy("lang").collect()]
    words = log_frequencies(counted, "word", languages)
    tables = [log_frequencies(pieces.where(F.col("size") == n), "gram", languages) for n in range(1, LONGEST + 1)]
    discard(sample, counted, pieces)
    return LanguageModel(languages, words, tables)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 2, folds: int = 4, **options) -> DataFrame:
    """One row per document: id, held_out, lang_pred (a language of the training rows, or `und`), score (0 to 1, the share of
    the predicted language in the sum of all languages' likelihoods).

    A text that is null or has no letter is `und` with score 0, and so is every text if no training row has a language and a
    letter. Where nothing of a text is known all languages tie: the first in order is taken. Repeated rows get a row each; a null id
    counts as the empty text for its fold. Very long texts are read whole. An empty table gives an empty table. Only text and
    language are learnt from, and only outside the held-out fold; other columns don't matter, whatever their names.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, id_col, text_col, lang_col, held_out, folds, **options))

    @F.pandas_udf("lang string, score double")
    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in series:
            yield pd.DataFrame([model.value.predict(t) for t in part], columns=["lang", "score"])

    seen = docs.select(F.col(id_col).alias("id"), predict(F.col(text_col)).alias("x"))
    return seen.select(F.col("id").alias(id_col), (in_fold(folds) == held_out).alias("held_out"), F.col("x.lang").alias("lang_pred"), F.col("x.score").alias("score"))
