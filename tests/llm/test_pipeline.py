"""The pipeline's stages, each on what the one before kept."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.written(stage(spark, rows, SF), name)
        assert rows.columns == columns and rows.count() <= before
        before = rows.count()
    texts = [r.text for r in rows.select("text").collect()]
    assert len(set(texts)) == len(texts) > 0
    assert not any("AKIA" in t for t in texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
    assert packed.select("doc_id").distinct().count() == before


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("aeinorst"), r.integers(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns; and labels for some."""
    rows, labels = [], []
    for i in range(240):
        bad, toxic = i % 3 == 0, i % 10 == 1
        text = " ".join(["buy", "now!!"] * 40) if bad else prose(i, 60) + (" vile Rotten! scoundrel" if toxic else "")
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not bad), int(toxic)))
    key = "AKIA" + "Q7ZX2M4K9P1L8N5T"
    more = [(500, None), (501, ""), (502, " \n "), (503, prose(7, 20_000)), (504, prose(7, 20_000)), (505, prose(8, 50) + f" key {key} " + prose(9, 5)), (None, prose(11, 40)), (None, prose(11, 40)), (506, prose(12, 40)), (506, prose(12, 40)), (507, prose(13, 4))]
    rows += [(i, t, None, None, None) for i, t in more]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["id", "node", "root", "label", "score", "value", "path", "spans", "component_id", "x"]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs.withColumns({c: F.lit("clash") for c in clash}), str(folder), key


def test_every_stage_takes_odd_rows(spark, odd):
    docs, folder, key = odd
    count = lambda df: Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    rows = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = count(rows)
        rows = corpus_pipeline.written(stage(spark, rows, folder), name)
        assert rows.columns == docs.columns
        kept[name] = count(rows)
        if name != "secrets":
            assert not kept[name] - before
    ids = lambda name: {i for i, _ in kept[name]}
    # The classifiers treat equal texts alike, and leave clean documents alone.
    assert not any(i is not None and i < 240 and i % 3 == 0 for i in ids("quality"))
    assert sum(1 for i in range(240) if i % 3 and i in ids("quality")) >= 155
    assert not any(i is not None and i < 240 and i % 10 == 1 for i in ids("toxicity"))
    assert all(kept["toxicity"][r] in (0, n) for r, n in kept["quality"].items())
    # One of the two long texts stays; rows without words or id, and repeated rows of one id, are no copies of others.
    assert {503, 504} & ids("near_copies") <= {503}
    for i in (500, 501, 502, None, 506):
        assert {t: n for (k, t), n in kept["near_copies"].items() if k == i} == {t: n for (k, t), n in kept["toxicity"].items() if k == i}
    assert all(key not in (t or "") for _, t in kept["secrets"]) and ids("secrets") == ids("near_copies")
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, folder)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids("secrets")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_near_copies_are_those_of_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    word = re.compile(rb"[^\x20\x09-\x0D]+")

    def shingles(text):
        w = word.findall((text or "").encode().lower())
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = {rows[i][0] for i in range(len(rows)) if find(i) == i}
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SF).select("doc_id").collect()} == want
