"""The registered queries of this subpackage: thin calls of the operators with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import let
from tidemark.llm import embedding_dedup, language_id, mil_quality, ngram_join, packing, periodic_runs, piece_viterbi, pitman_yor, progressive_jpeg, secret_scan, sharding, toxic_segments, vector_codes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_quality(spark, sf_dir):
    return mil_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_progressive_jpeg(spark, sf_dir):
    return progressive_jpeg.media_features(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark, sf_dir):
    return piece_viterbi.encoding_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_lm_scores(spark, sf_dir):
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    return toxic_segments.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark, sf_dir):
    """Findings without the secrets themselves: their digest, length and first characters."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "nth", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length"), F.left("value", F.lit(4)).alias("begins"), "score", "secret"
    )


def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def repeated(docs):
    """docs with the contract's periodic tails: where crc32(doc_id) ends in 0, word i >= a becomes word a + (i - a) % p."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def tail(ws):
        n, g = F.size(ws), F.floor(crc / 10)
        a = F.when(n > 0, g % n).otherwise(0).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat(F.slice(ws, F.lit(1), a), F.slice(F.flatten(F.array_repeat(F.slice(ws, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a))

    return docs.withColumn("text", F.when(crc % 10 == 0, F.array_join(let(words, tail), " ")).otherwise(F.col("text")))


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(repeated(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # Lengths and periods are below 2**26, so that equal quotients alone are equal doubles.
    best = F.array_max(F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("n"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("b", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("b.s")).alias("start"),
        F.col("b.n").alias("length"),
        (-F.col("b.p")).alias("period"),
        F.expr("(1000 * b.n) div (-b.p)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_quality": op2_quality,
    "op3_ngram_join": op3_ngram_join,
    "op4_sharding": op4_sharding,
    "op5_progressive_jpeg": op5_progressive_jpeg,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_lm_scores": op7_lm_scores,
    "op8_toxicity": op8_toxicity,
    "op9_secret_scan": op9_secret_scan,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_language_id": op12_language_id,
    "op13_vector_codes": op13_vector_codes,
}


def vector_codes_sql() -> str:
    """Two rounds and the last assignment, each over all pairs of a part and an entry."""
    steps = []
    for turn in range(3):
        steps.append(f"""a{turn} AS (SELECT id, part, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM (SELECT x.id, x.part, b.entry, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM x JOIN b{turn} b ON b.part = x.part) GROUP BY ALL)""")
        if turn < 2:
            steps.append(f"""b{turn + 1} AS (SELECT b.part, b.entry, coalesce(n.v, b.v) AS v FROM b{turn} b LEFT JOIN (SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY i) AS v FROM (SELECT a.part, a.entry, i, sum(x.v[i]) AS s, count(*) AS n FROM a{turn} a JOIN x ON x.id = a.id AND x.part = a.part, range(1, 1 + len(x.v)) r(i) GROUP BY ALL) GROUP BY ALL) n ON n.part = b.part AND n.entry = b.entry)""")
    return f"""WITH k AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      x AS MATERIALIZED (SELECT id, p AS part, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM k, range(16) r(p)),
      b0 AS (SELECT part, entry, v FROM x JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS entry FROM k) USING (id) WHERE entry < 64), {", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
      h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2),
      c AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY 1)
      SELECT id AS vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c JOIN k USING (id), h"""


REACH = "r AS (SELECT id AS a, id AS m FROM every UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.a), c AS (SELECT a, min(m) AS component_id FROM r GROUP BY 1)"
ORACLES: dict[str, str] = {
    "op1_embedding_dedup": f"""WITH RECURSIVE every AS (SELECT vec_id AS id FROM embeddings),
      v AS (SELECT vec_id, label, len(embedding) AS d, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
      l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.d = y.d AND x.vec_id <> y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.93), {REACH}
      SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM every JOIN c ON c.a = id LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY 1) k ON k.a = id""",
    "op3_ngram_join": f"""WITH RECURSIVE every AS (SELECT doc_id AS id FROM documents),
      w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
      s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS x FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
      n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.x = y.x AND x.doc_id <> y.doc_id GROUP BY 1, 2),
      l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)), {REACH}
      SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id FROM every JOIN c ON c.a = id LEFT JOIN n ON n.doc_id = id""",
    # h is CRC-32 bit by bit. A run shows as 8-grams that recur at its period without a break; of equal stretches the smallest
    # period is the run's.
    "op11_periodic_runs": f"""WITH h AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w0, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
          lambda c, b: xor(xor(c, b) // 2, (xor(c, b) % 2) * 3988292384)) AS c FROM documents),
      g AS (SELECT doc_id, w0, len(w0) AS n, xor(c, 4294967295) % 10 AS r, xor(c, 4294967295) // 10 AS g FROM h),
      q AS (SELECT *, r = 0 AND n > 0 AS hit, CASE WHEN n > 0 THEN g % n END AS a FROM g), u AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM q),
      d AS (SELECT doc_id, CASE WHEN hit THEN list_transform(generate_series(0, n - 1), lambda i: CASE WHEN i < a THEN w0[i + 1] ELSE w0[a + (i - a) % p + 1] END) ELSE coalesce(w0, CAST([] AS VARCHAR[])) END AS w FROM u),
      k AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 8], ' ') AS x FROM (SELECT doc_id, w, unnest(generate_series(0, len(w) - 8)) AS i FROM d WHERE len(w) >= 24)),
      m AS (SELECT b.doc_id, b.i, b.i - a.i AS p FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.x = b.x AND a.i < b.i),
      s AS (SELECT doc_id, p, min(i) - p AS start, max(i) - min(i) + 8 + p AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM m) GROUP BY doc_id, p, island),
      runs AS (SELECT doc_id, start, length, min(p) AS period FROM s WHERE length >= greatest(24, 3 * p) GROUP BY ALL),
      t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS told, list(struct_pack(s := start, l := length, p := period) ORDER BY length / period DESC, start, period)[1] AS b, flatten(list(generate_series(start + period, start + length - 1))) AS gone FROM runs GROUP BY 1)
      SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.p AS period, 1000 * b.l // b.p AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
        sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(generate_series(0, len(w) - 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' '), '')) AS collapsed_sha256 FROM d LEFT JOIN t USING (doc_id)""",
    "op13_vector_codes": vector_codes_sql(),
}
