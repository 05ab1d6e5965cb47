"""The registered query of each operator, with production parameters, and
DuckDB SQL where SQL gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchpulse.llm import (
    crf, decontam, hmm, htmltext, idcodec, licenses, neardup, packing, resample, suffixdedup, urlfilter, vptree, whiten,
)

#: The rules of the URL filter.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = crf.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=1.0)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_pages(_table(spark, sf_dir, "pages"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op8_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup_passages(_table(spark, sf_dir, "documents")).drop("kept")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idcodec.read_ids(idcodec.write_ids(_table(spark, sf_dir, "documents"), tokenizer_path()))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_table(spark, sf_dir, "documents")).withColumn("n_places", F.coalesce(F.size("places"), F.lit(0))).drop("places")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(_table(spark, sf_dir, "embeddings"), k=4)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=10, longest=1, buckets=10_000, min_words=20, seed=2024
    )
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_hmm_scores": op2_hmm_scores,
    "op3_toxicity": op3_toxicity,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_nearest": op5_nearest,
    "op6_main_text": op6_main_text,
    "op7_url_filter": op7_url_filter,
    "op8_passage_dedup": op8_passage_dedup,
    "op9_packing": op9_packing,
    "op10_token_ids": op10_token_ids,
    "op11_license_scan": op11_license_scan,
    "op12_whitening": op12_whitening,
    "op13_resampling": op13_resampling,
    "pipeline": pipeline,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(" + _LOWER.format("text") + r", ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[j:j + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS j FROM item WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (
  SELECT doc_id, n, j, array_to_string(w[j:j + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM doc, sizes WHERE len(w) >= n)
),
hit AS (SELECT doc_id, j, n, item FROM place JOIN win USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda x, y: x + y) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

OP7_SQL = f"""
WITH rule(rhost, rpath, rverdict) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
part AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM rest),
url AS (
  SELECT row_number() OVER () AS k, page_id, {_LOWER.format('h')} AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM part
),
best AS (
  SELECT k, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY k ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC) AS n
  FROM url JOIN rule ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM url LEFT JOIN (SELECT * FROM best WHERE n = 1) USING (k)
"""

#: The reflected polynomial of the common CRC-32; its table by eight shifts of each byte.
_SHIFT = "CASE WHEN {0} % 2 = 1 THEN xor({0} // 2, 3988292384) ELSE {0} // 2 END"
OP13_SQL = f"""
WITH RECURSIVE shifted(b, k, v) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, k + 1, {_SHIFT.format('v')} FROM shifted WHERE k < 8
),
tab AS (SELECT list(v ORDER BY b) AS t FROM shifted WHERE k = 8),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
word AS (SELECT r, unnest(w) AS f FROM doc),
bench AS (SELECT unnest({_WORDS}) AS f FROM benchmark),
n AS (
  SELECT f, sum(s) AS s, sum(t) AS t
  FROM (SELECT f, 1 AS s, 0 AS t FROM word UNION ALL SELECT f, 0, 1 FROM bench) GROUP BY f
),
-- one byte of every word at a time
crc(f, h, k, c) AS (
  SELECT f, hex(encode(f)), 1, CAST(4294967295 AS BIGINT) FROM n
  UNION ALL
  SELECT f, h, k + 2, xor(c // 256, t[xor(c % 256, CAST('0x' || h[k:k + 1] AS BIGINT)) + 1]) FROM crc, tab WHERE k < length(h)
),
feature AS (SELECT f, xor(c, 4294967295) % 10000 AS b, s, t FROM crc JOIN n USING (f) WHERE k > length(h)),
bucket AS (SELECT b, sum(s) AS s, sum(t) AS t FROM feature GROUP BY b),
whole AS (SELECT sum(s) AS s, sum(t) AS t FROM bucket),
gain AS (
  SELECT b, CAST(floor(1000 * ln(CAST(bucket.t + 1 AS DOUBLE) * CAST(whole.s + 10000 AS DOUBLE) / (CAST(bucket.s + 1 AS DOUBLE) * CAST(whole.t + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM bucket, whole
),
weight AS (SELECT r, CAST(sum(g) AS BIGINT) AS weight FROM word JOIN feature USING (f) JOIN gain USING (b) GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM doc LEFT JOIN weight USING (r)
),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM scored),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM noisy WHERE n_features >= 20 AND doc_id IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM placed) THEN rank END AS rank
FROM noisy LEFT JOIN placed USING (r)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": OP1_SQL, "op5_nearest": OP5_SQL, "op7_url_filter": OP7_SQL, "op13_resampling": OP13_SQL,
}
