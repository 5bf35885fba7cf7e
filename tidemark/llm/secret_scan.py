"""Secret scans: candidate strings judged by a random forest that removes false positives.

Candidates are what follows a credential word and a sign of assignment (six characters or more of any kind but spaces and
quotes), what has the form of a provider's key, and long runs of key characters that are not lower-case letters alone,
which are words. Features of a candidate: length, shares of character kinds, character transitions, dictionary coverage,
path shape, the record's path, and how much the words beside it and its first characters speak for a secret, as counted in
the labelled findings; none of them is the rule that labels. The forest learns from labelled findings; where none are
given, they are labelled by rule from the corpus: provider formats and credential assignments are findings, the rest is
not. Everything runs as DataFrame and SQL expressions; the trained trees become a column expression, so text is judged in
the row that holds it and nothing is shuffled. Tables that hold candidates are deleted once the forest is trained.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, written

NEAR_BEFORE, NEAR_AFTER = 48, 32
#: Beginnings that providers give their keys.
PROVIDER = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^xox[abpr]-|^sk[-_](live|test|proj)?|^AIza[A-Za-z0-9_-]{30,}$|^eyJ[A-Za-z0-9_-]{10,}"
#: Words beside a credential.
CREDENTIAL = r"(pass(word|wd|phrase)?|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth(orization)?|bearer|credential)"
#: Between a credential word and its value.
SIGN = r"[\"']?\s{0,3}[:=]{1,2}>?\s{0,3}[\"']?"
TEST_PATH = r"(test|example|sample|mock|fixture|demo|placeholder)"
#: A value ends before the marks that close a sentence or a bracket. The short look-behinds come first, as they fail soonest.
VALUE = r"[^\s\"'<>]{5,}[^\s\"'<>.,;:)\]}]"
ASSIGNED = r"(?<=[:=>][\s\"']{0,4})(?<=(?i:" + CREDENTIAL + r")" + SIGN + r")(?!(?i:bearer|basic)\s)" + VALUE
BEARER = r"(?<=\s)(?<=(?i:bearer)\s{1,2})(?=\S*[0-9A-Z])" + VALUE
FORMED = r"(?<![A-Za-z0-9])(?:xox[abpr]-|sk[-_])[A-Za-z0-9_-]{6,}|eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]+)*"
RUN = r"[A-Za-z0-9+/_-]{12,}={0,2}"
CANDIDATE = "|".join([ASSIGNED, BEARER, FORMED, RUN])
#: The end of what stands before an assigned value.
BEFORE_VALUE = r"(" + CREDENTIAL + SIGN + r"|bearer\s+)$"
FEATURES = 18
#: A control character that marks candidates.
MARK = "\x01"
#: Findings of a label that is rarer than this are repeated, so that the sample of every tree holds them.
FEWEST = 200


def candidates(text: Column) -> Column:
    """Array of structs (nth, value, before, after) of a text's candidates, in order; empty for a null text.

    One search marks the candidates, and the text is split at the marks (a text that holds the mark itself is searched twice
    instead). A candidate's neighbours are the pieces beside it, so the work is linear in the text.
    """
    body = F.coalesce(text, F.lit(""))
    marked = F.split(F.regexp_replace(body, f"({CANDIDATE})", f"{MARK}$1{MARK}"), MARK)
    found = F.concat(F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)), F.array(F.lit(None).cast("string")))
    apart = F.flatten(F.transform(F.arrays_zip(F.split(body, CANDIDATE).alias("p"), found.alias("f")), lambda x: F.array(x["p"], x["f"])))
    pieces = F.when(F.contains(body, F.lit(MARK)), apart).otherwise(marked)

    def built(p: Column) -> Column:
        count = F.floor((F.size(p) - 1) / 2).cast("int")
        one = lambda i: F.struct(
            i.alias("nth"),
            F.get(p, 2 * i - 1).alias("value"),
            F.right(F.concat(F.coalesce(F.get(p, 2 * i - 3), F.lit("")), F.get(p, 2 * i - 2)), F.lit(NEAR_BEFORE)).alias("before"),
            F.left(F.get(p, 2 * i), F.lit(NEAR_AFTER)).alias("after"),
        )
        none = F.array().cast("array<struct<nth:int,value:string,before:string,after:string>>")
        return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), one)).otherwise(none)

    wanted = lambda c: c["value"].rlike("[^a-z]") | F.lower(c["before"]).rlike(BEFORE_VALUE)
    # The pieces stand in an array of one, so that they are found once.
    return F.filter(F.flatten(F.transform(F.array(pieces), built)), wanted)


def near_words(c: Column) -> Column:
    """The last three words before a candidate, the nearest first."""
    return F.slice(F.reverse(F.filter(F.split(F.lower(c["before"]), "[^a-z]+"), lambda w: F.length(w) >= 2)), 1, 3)


def begins(c: Column) -> Column:
    return F.left(c["value"], F.lit(4))


def share_of(value: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(value, drop, "")) / F.length(value)


def changes(value: Column, at: str) -> Column:
    return (F.length(F.regexp_replace(value, at, " ")) - F.length(value)) / F.length(value)


def evidence_of(table: dict[str, float]):
    """A column of a key's log-odds in a table of a bounded number of keys; 0 for any other."""
    if not table:
        return lambda key: F.lit(0.0)
    held = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return lambda key: F.coalesce(F.try_element_at(held, key), F.lit(0.0))


def feature_array(c: Column, path: Column, dictionary: list[str], beside: dict[str, float], prefixes: dict[str, float]) -> Column:
    """The FEATURES numbers of a candidate struct."""
    value, before = c["value"], F.lower(c["before"])
    told = F.transform(near_words(c), evidence_of(beside))
    runs = F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,}"), F.lit(0))
    words = F.array(*[F.lit(w) for w in dictionary]) if dictionary else F.array().cast("array<string>")
    covered = F.aggregate(F.filter(runs, lambda r: F.array_contains(words, r)), F.lit(0), lambda a, r: a + F.length(r))
    flag = lambda x: x.cast("double")
    numbers = [
        F.length(value),
        share_of(value, "[^0-9]"),
        share_of(value, "[^A-Z]"),
        share_of(value, "[^a-z]"),
        changes(value, "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"),
        changes(value, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        flag(value.rlike("^[0-9a-fA-F]+$")),
        F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        covered / F.length(value),
        share_of(value, "[^_-]"),
        share_of(value, "[^/]"),
        flag(before.rlike(r"[:=]\s*[\"']?$")),
        F.get(told, F.lit(0)),
        F.array_max(told),
        F.array_min(told),
        flag(before.rlike(r"(https?:/?/?|www\.)\S*$")),
        flag(F.coalesce(F.lower(path), F.lit("")).rlike(TEST_PATH)),
        evidence_of(prefixes)(begins(c)),
    ]
    return F.array(*[F.coalesce(x.cast("double"), F.lit(0.0)) for x in numbers])


def rule_label(c: Column) -> Column:
    """1 for a provider's format or an assignment to a credential word, else 0. An assigned value has a letter and is long or
    mixed: a digit, a mark or capitals within; short words and names of code, with or without a call, are none."""
    value = c["value"]
    mixed = (F.length(value) >= 12) | value.rlike("[0-9!@#%^&*?~+=/\\-]|[a-z][A-Z]|[A-Z].*[A-Z]")
    code = value.rlike(r"^[$%{<(]|^[A-Za-z_]+([._][A-Za-z_]+)+$|^[A-Za-z_.]+\(")
    assigned = F.lower(c["before"]).rlike(BEFORE_VALUE) & value.rlike("[A-Za-z]") & mixed & ~code
    return F.when(value.rlike(PROVIDER) | assigned, 1.0).otherwise(0.0)


def forest_expression(printed: str, x: Column) -> Column:
    """The share of trees that say 1, as a column expression over the feature array x, from the printed forest."""
    lines = [line.strip() for line in printed.splitlines()[1:]]
    at = 0

    def node() -> Column:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return F.lit(float(line.split(":")[1]))
        feature, limit = re.match(r"If \(feature (\d+) <= ([-+0-9.eE]+)\)", line).groups()
        low = node()
        at += 1  # the matching Else
        high = node()
        return F.when(x[int(feature)] <= float(limit), low).otherwise(high)

    votes = []
    while at < len(lines):
        if lines[at].startswith("Tree"):
            at += 1
            votes.append(node())
        else:
            at += 1
    total = votes[0]
    for v in votes[1:]:
        total = total + v
    return total / len(votes)


class SecretForest:
    """The trained judge: score(candidate, path) is a column, 0 to 1."""

    def __init__(self, model, constant: float, dictionary: list[str] = (), beside: dict[str, float] | None = None, prefixes: dict[str, float] | None = None):
        self.model, self.constant = model, constant
        self.printed = model.toDebugString if model else None
        self.dictionary, self.beside, self.prefixes = list(dictionary), beside or {}, prefixes or {}

    def features(self, c: Column, path: Column) -> Column:
        return feature_array(c, path, self.dictionary, self.beside, self.prefixes)

    def score(self, c: Column, path: Column) -> Column:
        if self.printed is None:
            return F.lit(self.constant)
        # The features stand in an array of one, so that the trees share one evaluation of them.
        return F.transform(F.array(self.features(c, path)), lambda x: forest_expression(self.printed, x))[0]


def log_odds_of(keys: DataFrame, most: int) -> dict[str, float]:
    """Log-odds of label 1 of the commonest `most` keys of (key, label), of those in five findings or more."""
    seen = keys.groupBy("key").agg(F.sum("label").alias("bad"), F.count("*").alias("n")).where("n >= 5").orderBy(F.desc("n"), "key").limit(most)
    return {r["key"]: float(x) for r in seen.select("key", F.log((F.col("bad") + 0.5) / (F.col("n") - F.col("bad") + 0.5)).alias("x")).collect() for x in [r["x"]]}


def train(labelled: DataFrame, trees: int = 15, depth: int = 6, max_labelled: int = 20_000, dictionary_words: int = 300) -> SecretForest:
    """Fit a forest on at most max_labelled distinct findings (value, before, after, path, label 0/1): of each label half of
    them, those with the smallest hashes. A table whose labels are all of one kind gives that kind's constant; none give 0.
    The dictionary holds the commonest words beside the findings; words and beginnings of values have their log-odds."""
    rows = labelled.where(F.col("label").isin(0, 1) & F.col("value").isNotNull() & (F.length("value") > 0))
    rows = rows.select("value", "before", "after", "path", "label").distinct()
    order = [F.xxhash64("value", "before", "after", "path"), "value", "before", "after", "path"]
    bad, good = (rows.where(F.col("label") == kind).orderBy(*order).limit(max(1, max_labelled // 2)) for kind in (1, 0))
    rows = written(bad.unionByName(good), "findings")
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2:
        discard(rows)
        return SecretForest(None, float(*kinds) if kinds else 0.0)
    near = rows.select(F.explode(F.split(F.lower(F.concat_ws(" ", "before", "after")), r"[^\p{L}]+")).alias("w")).where(F.length("w") >= 3)
    top = near.groupBy("w").count().where("count >= 5").orderBy(F.desc("count"), "w").limit(dictionary_words).collect()
    c = F.struct("value", "before", "after")
    words = rows.select(F.explode(F.array_distinct(near_words(c))).alias("key"), "label")
    forest = SecretForest(None, 0.0, [r.w for r in top], log_odds_of(words, dictionary_words), log_odds_of(rows.select(begins(c).alias("key"), "label"), dictionary_words))
    ready = rows.select(array_to_vector(forest.features(c, F.col("path"))).alias("features"), F.col("label").cast("double").alias("label"))
    for kind, n in kinds.items():
        if n < FEWEST <= max(kinds.values()):
            again = F.explode(F.array_repeat(F.lit(0), -(-FEWEST // n)))
            ready = ready.where(F.col("label") != kind).unionByName(ready.where(F.col("label") == kind).select("features", "label", again.alias("nth")).drop("nth"))
    trees_of = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="sqrt", subsamplingRate=0.8)
    fitted = trees_of.fit(ready)
    discard(rows)
    return SecretForest(fitted, 0.0, forest.dictionary, forest.beside, forest.prefixes)


def found_candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """A row per candidate: id, path, nth, value, before, after."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    return docs.select(F.col(id_col).alias("id"), path.alias("path"), F.explode(candidates(F.col(text_col))).alias("c")).select("id", "path", "c.*")


def forest_of(docs: DataFrame, id_col: str, text_col: str, path_col: str | None, labelled: DataFrame | None) -> SecretForest:
    """The forest of the labelled findings, or of docs' own candidates, labelled by rule."""
    if labelled is not None:
        return train(labelled)
    found = written(found_candidates(docs, id_col, text_col, path_col), "candidates")
    forest = train(found.withColumn("label", rule_label(F.struct("value", "before", "after"))))
    discard(found)  # secrets in plain text do not stay
    return forest


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per candidate: id, nth (of the document's matches), value, before, after, score, secret.

    Null and empty texts have no candidates; repeated rows are scanned each; a null path counts as none. Other columns are
    ignored; an empty table gives an empty table.
    """
    forest = forest_of(docs, id_col, text_col, path_col, labelled)
    judged = found_candidates(docs, id_col, text_col, path_col).withColumn("score", forest.score(F.struct("value", "before", "after"), F.col("path")))
    return judged.select(F.col("id").alias(id_col), "nth", "value", "before", "after", "score", (F.col("score") >= threshold).alias("secret"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None, threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """docs with every judged secret in the text replaced by mark; all rows and columns stay, a null text stays null.

    Repeated rows are masked alike, columns of any name pass through, an empty table stays empty."""
    forest = forest_of(docs, id_col, text_col, path_col, labelled)
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    text = F.col(text_col)
    secrets = F.array_distinct(F.transform(F.filter(candidates(text), lambda c: forest.score(c, path) >= threshold), lambda c: c["value"]))
    # Longer ones first, as a secret can lie in another.
    longest = F.array_sort(secrets, lambda a, b: F.length(b) - F.length(a))
    return docs.withColumn(text_col, F.aggregate(longest, text, lambda t, s: F.replace(t, s, F.lit(mark))))
