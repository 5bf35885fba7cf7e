"""Periodic runs, language identification and vector codes against brute force, with nulls, empty and very long texts, ties,
repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, periodic_runs, pitman_yor, queries, vector_codes

CLASH = ("id", "x", "v", "l", "label_error", "code", "runs", "score", "lang_pred", "word", "n", "part", "entry")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH})


def brute_runs(w):
    """Every period's maximal stretches; of equal stretches the smallest period is the run's."""
    n, found = len(w), {}
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_words(r):
    w, k, size = [], r.choice([1, 2, 3, 5]), r.choice([30, 80, 200])
    while len(w) < size:
        if r.random() < 0.5:
            block = [r.choice("abcde"[:k]).encode() for _ in range(r.randint(1, 12))]
            w += (block * r.randint(2, 12))[: r.randint(5, 90)]
        else:
            w += [r.choice("abcdexyz"[: k + 3]).encode() for _ in range(r.randint(1, 10))]
    return w


def test_runs_are_brute_force():
    r = random.Random(7)
    for _ in range(400):
        w = periodic_words(r)
        assert periodic_runs.runs_of(w) == brute_runs(w)


def test_the_automaton_finds_the_same_without_stretches(monkeypatch):
    r = random.Random(8)
    words = [periodic_words(r) for _ in range(150)]
    with_stretches = [periodic_runs.runs_of(w) for w in words]
    monkeypatch.setattr(periodic_runs, "stretches", lambda codes: [(0, len(codes))])
    assert [periodic_runs.runs_of(w) for w in words] == with_stretches and sum(map(len, with_stretches)) > 150


def test_pieces_are_the_last_ends_of_all_suffixes():
    r = random.Random(9)
    for _ in range(60):
        w = [r.randint(0, 2) for _ in range(60)]
        ends = periodic_runs.LastEnds()
        for i, word in enumerate(w):
            want = {}
            for size in range(1, i + 1):
                last = max((e for e in range(size - 1, i) if w[e - size + 1 : e + 1] == w[i - size + 1 : i + 1]), default=None)
                if last is not None:
                    want[last] = size
            assert {last: size for size, last in ends.append(word)} == want


def test_long_periodic_texts_stay_near_linear():
    block = [b"%d" % (i * 7919 % 3001) for i in range(3000)]
    assert periodic_runs.runs_of(block * 10) == [(0, 30_000, 3000)]
    assert periodic_runs.runs_of([b"a"] * 50_000) == [(0, 50_000, 1)]


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(3)
    rows = [(i, b" ".join(periodic_words(r)).decode()) for i in range(60)]
    base = " ".join(f"w{i}" for i in range(20_000))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one two"), (104, base), (105, "a b " * 30), (105, "a b " * 30), (None, "c d e " * 20), (None, None), (106, "x\x1cy  z " * 24), (107, "é\tÉ\r\n" * 15)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string"))


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_periodic_runs_of_a_table(texts):
    for r in periodic_runs.periodic_runs(texts).join(texts.select(F.col("doc_id").alias("d"), "text").distinct(), F.col("doc_id").eqNullSafe(F.col("d"))).where("doc_id is not null").collect():
        w = words_of(r.text)
        want = brute_runs(w) if len(w) < 1000 else []
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(w), want)
        assert r.collapsed == b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
    got = periodic_runs.periodic_runs(texts)
    assert got.count() == texts.count() and got.where("doc_id is null").count() == 2
    assert periodic_runs.periodic_runs(texts.limit(0)).count() == 0


def digest(doc_id, text):
    """The contract of op11, row by row."""
    w = words_of(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    found = brute_runs(w)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    told = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha(told.encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op11_is_its_contract(spark, texts, tmp_path):
    hit = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    r = random.Random(4)
    # Texts that get a periodic tail, from none to 300 words.
    more = [(i, " ".join(f"v{r.randint(0, 40)}" for _ in range(k * k // 3))) for k, i in enumerate(hit[40:70])]
    docs = clashing(texts.select("doc_id", "text").where("doc_id is not null").union(spark.createDataFrame([*more, (hit[0], None), (hit[1], ""), (hit[2], "one")], "doc_id long, text string")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter((r.doc_id, *digest(r.doc_id, r.text)) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 50_000)
    got = Counter(tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).where("doc_id <> 104").collect())
    assert got == want and sum(1 for r in got if r[1]) > 40


# Language identification

SYLLABLES = {"aa": "ka lo mi ne ru ta".split(), "bb": "sch ung ein ver kro bal".split(), "cc": "eau oui tre gne cha rou".split()}


def speech(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    r = random.Random(5)
    rows = [(i, speech(r, lang, r.randint(4, 60)), lang) for i in range(400) for lang in [r.choice(list(SYLLABLES))]]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 -- ²", "bb"), (1003, speech(r, "cc", 20_000), None), (1004, speech(r, "aa", 9), None), (1004, speech(r, "aa", 9), None), (None, speech(r, "bb", 12), "bb"), (1005, "漢字だけ", None), (1006, "KALO Lomi", None)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def brute_language(rows, target):
    """Scores of word, then n-gram frequencies, from the training rows in plain Python."""
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 4
    split = lambda t: [w for w in re.findall(r"[^\W\d_]+", (t or "").lower()) if any(c.isalpha() for c in w)]
    words, pieces = Counter(), [Counter() for _ in range(5)]
    for i, t, g in rows:
        if g is not None and t is not None and fold(i) != 2:
            for w in split(t):
                words[w, g] += 1
                for n in range(1, 6):
                    m = f"\1{w}\2" if n > 1 else w
                    for k in range(len(m) - n + 1):
                        pieces[n - 1][m[k : k + n], g] += 1
    langs = sorted({g for _, g in words})

    def table(counts):
        total = Counter()
        for (x, _), n in counts.items():
            total[x] += n
        known = [x for x in total if total[x] >= 2]
        all_ = {g: sum(counts[x, g] for x in known) for g in langs}
        return {x: [math.log((counts[x, g] + 0.5) / (all_[g] + 0.5 * len(known))) for g in langs] for x in known}

    lexicon, grams = table(words), [table(p) for p in pieces]
    out = []
    for i, t, _ in target:
        own = split(t)
        sums = [0.0] * len(langs)
        for w in own:
            scores = [lexicon[w]] if w in lexicon else []
            for n in range(5, 0, -1):
                m = f"\1{w}\2" if n > 1 else w
                scores = scores or [grams[n - 1][m[k : k + n]] for k in range(len(m) - n + 1) if m[k : k + n] in grams[n - 1]]
            for j in range(len(langs)):
                sums[j] += sum(s[j] for s in scores) / len(scores) if scores else 0
        best = max(range(len(langs)), key=lambda j: (sums[j], -j))
        out.append((i, fold(i) == 2, langs[best] if own else "und", 1 / sum(math.exp(min(0, s - sums[best])) for s in sums) if own else 0.0))
    return out


def test_languages_are_brute_force(spoken):
    rows = [tuple(r) for r in spoken.select("doc_id", "text", "lang").collect()]
    want = sorted((str(x) for x in ((i, h, g, round(s, 6)) for i, h, g, s in brute_language(rows, rows))))
    got = sorted(str((r.doc_id, r.held_out, r.lang_pred, round(r.score, 6))) for r in language_id.identify(spoken, per_language=10**6).collect())
    assert got == want
    by = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(spoken).collect()}
    assert by[1000] == by[1001] == by[1002] == ("und", 0.0)
    assert by[1003][0] == "cc" and by[1004][0] == "aa" and by[1006][0] == "aa" and by[1005] == ("aa", pytest.approx(1 / 3))


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right / n >= 0.98


def test_languages_without_labels_or_rows(spoken):
    blind = spoken.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(blind).collect()} == {("und", 0.0)}
    assert language_id.identify(spoken.limit(0)).count() == 0


def test_memory_of_unseen_words_is_bounded(monkeypatch):
    monkeypatch.setattr(language_id, "WORD_MEMORY", 5)
    tables = [(["a", "b"], np.log(np.array([[9.0, 1], [1, 9]]))), *[([], np.zeros((0, 2)))] * 4]
    model = language_id.LanguageModel(["x", "y"], (["known"], np.array([[-1.0, -2.0]])), tables)
    first = [model.predict(t) for t in ("aaa aa a ab known", "bbb bb b known ba", "aaab aabb abbb abab baba aaaa bbbb", "aaa aa a ab known")]
    assert first[0] == first[3] and first[0][0] == "x" and first[1][0] == "y" and len(model.rows) <= 1 + 7


def test_sample_is_bounded(spoken):
    for languages, per in ((200, 20), (2, 5)):
        sizes = {r.lang: r["count"] for r in language_id.training_sample(spoken, "doc_id", "text", "lang", 2, 4, per, languages, 10**9).groupBy("lang").count().collect()}
        assert len(sizes) <= languages and all(n <= 4 * per for n in sizes.values())


# Vector codes


def test_dual_tree_assignment_is_exact():
    r = np.random.default_rng(0)
    for turn in range(300):
        n, d, scale = int(r.integers(1, 500)), int(r.integers(1, 6)), int(r.choice([2, 10, 200]))
        k = int(r.integers(1, min(n, 70) + 1))
        x = r.integers(-scale, scale, (n, d))
        e = x[r.integers(0, n, k)] if turn % 2 else r.integers(-scale, scale, (k, d))
        want = ((x[:, None] - e[None]) ** 2).sum(2).argmin(1)
        place, sums, counts, whole = vector_codes.assign(x, e)
        total = np.zeros((k, d), int)
        np.add.at(total, want, x)
        assert (place == want).all() and (sums == total).all() and (counts == np.bincount(want, minlength=k)).all() and 0 <= whole <= n


def test_whole_nodes_are_assigned_in_clustered_data():
    r = np.random.default_rng(1)
    centres = r.integers(-5000, 5000, (40, 4))
    x = centres[r.integers(0, 40, 8000)] + r.integers(-20, 20, (8000, 4))
    assert vector_codes.assign(x, centres)[3] >= 6000
    same = np.repeat(x[:1], 5000, 0)
    assert vector_codes.assign(same, centres)[3] == 5000


def test_a_tree_covers_its_points():
    r = np.random.default_rng(2)
    for n in (1, 2, 15, 16, 33, 1000):
        x = r.integers(-9, 9, (n, 3))
        tree = vector_codes.Boxes(x, 16)
        assert sorted(tree.order.tolist()) == list(range(n)) and (x[tree.order] == tree.points).all()
        for level, starts in enumerate(tree.starts):
            for k in range(2**level):
                own = tree.points[starts[k] : starts[k + 1]]
                assert (own.min(0) == tree.low[level][k]).all() and (own.max(0) == tree.high[level][k]).all() and (own.sum(0) == tree.sums[level][k]).all()


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, np.floor(np.array(v, float) * 256).astype(int), g) for i, v, g in rows]
    kept = [(i, np.pad(x, (0, -len(x) % parts)), g) for i, x, g in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1].tolist()))[:entries]
    x = np.array([v.reshape(parts, -1) for _, v, _ in kept])
    books = x[order].transpose(1, 0, 2).copy()
    near = lambda p: ((x[:, p, None] - books[p][None]) ** 2).sum(2)
    for _ in range(rounds):
        for p in range(parts):
            place = near(p).argmin(1)
            for e in set(place.tolist()):
                books[p][e] = [int(s) // int((place == e).sum()) for s in x[place == e, p].sum(0)]
    error = sum(near(p).min(1) for p in range(parts))
    code = ["".join(f"{near(p)[k].argmin():02x}" for p in range(parts)) for k in range(len(kept))]
    per = Counter()
    for (_, _, g), e in zip(kept, error):
        per[g] += int(e)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(str((i, c, int(e), per[g], sha)) for (i, _, g), c, e in zip(kept, code, error))


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(6)
    base = r.standard_normal((9, 32)) / 3
    rows = [(i, [float(np.float32(x)) for x in base[i % 9] + r.standard_normal(32) * 0.05], None if i % 11 == 0 else i % 3) for i in range(150)]
    rows += [(200 + i, rows[0][1], 0) for i in range(60)] + [(5, rows[9][1], 1), (5, rows[9][1], 1), (None, rows[4][1], 2), (None, rows[5][1], None)]
    odd = [(300, None, 0), (301, [], 0), (302, [None] + rows[0][1][1:], 0), (303, [float("nan")] * 32, 1), (304, [float("inf")] + rows[0][1][1:], 1), (305, [1.0] * 16, 1), (306, [1e9] * 32, 1)]
    return rows, clashing(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int"))


@pytest.mark.parametrize("block, parts, entries", [(8192, 16, 64), (50, 16, 64), (8192, 3, 5)])
def test_codes_are_brute_force(vectors, monkeypatch, block, parts, entries):
    rows, table = vectors
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", block)
    got = sorted(str((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in vector_codes.compress(table, parts=parts, entries=entries).collect())
    assert got == brute_codes(rows, parts, entries)


def test_codes_of_few_and_no_vectors(vectors):
    rows, table = vectors
    few = table.where("vec_id in (1, 2, 3)")
    got = sorted(str((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in vector_codes.compress(few).collect())
    assert got == brute_codes([r for r in rows if r[0] in (1, 2, 3)])
    assert vector_codes.compress(table.limit(0)).count() == 0
    assert vector_codes.compress(table.where("vec_id >= 300 and vec_id <> 305 and vec_id <> 306")).count() == 0


def test_the_level_of_toxic_segments_is_that_of_clean_text():
    """Clean random texts have a significant segment about as often as the level says: the law is fitted on tokens."""
    from tidemark.llm.toxic_segments import ToxicModel, segment_rate

    r = np.random.default_rng(4)
    words, shares, scores = [b"t", b"u", b"c", b"x"], np.array([0.01, 0.03, 0.2, 0.76]), np.array([3.0, 1.5, -1.0])
    model = ToxicModel(dict(zip(words, scores.tolist())), 0.5, segment_rate(scores, shares[:3], 0.5), 1.0)
    texts = lambda n: [[words[k] for k in r.choice(4, 300, p=shares)] for _ in range(n)]
    floor, sample = 4.0, texts(400)
    over = sum(s >= floor for t in sample for _, _, s in model.segments(t))
    model.k = (over + 0.5) / (400 * 300 * np.exp(-model.lam * floor))
    share = np.mean([bool(model.significant(t)) for t in texts(1500)])
    assert 0.015 <= share <= 0.1


def test_language_model_shares(spark, monkeypatch):
    """Pairs lie packed, a row of them for each share, below 16 bytes a pair; more shares give the scores of one."""
    texts = [" ".join(f"w{(i * 37 + j * j) % 300} the" for j in range(80)) + f" v{i}" for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = []
    for size in (1 << 30, 4000):
        monkeypatch.setattr(pitman_yor, "SHARE_BYTES", size)
        model = pitman_yor.fit(docs)
        pairs = model.tables[0].collect()
        assert len(pairs) <= len(model.grid) and (size > 4000) == (len(model.grid) == 1)
        assert sum(len(part) for r in pairs for part in r.parts) < 16 * sum(r.seen[3] for r in pairs) or len(pairs) > 1
        got.append({r.id: r.score for r in pitman_yor.weighed(docs, model).collect()})
    assert all(math.isclose(got[0][i], got[1][i], rel_tol=1e-9) for i in range(80))
