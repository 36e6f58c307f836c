"""The operators over the whole test tables, with their SQL counterparts where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplemart.llm import (
    centroids, divergence, forest, language, mixing, multiset, ngram_scores, packing, secret_scan, simhash, substrings, token_files, wfst)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    found = wfst.round_trip(table(spark, folder, "documents"))
    return found.select("doc_id", "n_ids", "n_bytes", "ids_crc32", "decoded_sha256")


def op2_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return forest.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"))


def op4_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op5_multiset_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return multiset.edited_fingerprints(table(spark, folder, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = language.languages(table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


SUBSTRING_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM docs)),
firsts AS (SELECT gram, min(doc_id) AS first_id FROM windows GROUP BY gram),
covered AS (
  SELECT DISTINCT doc_id, p + k AS p
  FROM windows JOIN firsts USING (gram), range(13) AS t(k)
  WHERE first_id < doc_id),
single AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS text
  FROM single ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_scores.scored(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", F.round("score", 6).alias("score"))


def op9_lm_scores_longer(spark: SparkSession, folder: str) -> DataFrame:
    """Of contexts of two words too, by three words in a row, which the SQL of op9_lm_scores doesn't state."""
    found = ngram_scores.scored(table(spark, folder, "documents"), order=3)
    return found.select("doc_id", "n_words", F.round("score", 6).alias("score"))


LM_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
single AS (SELECT doc_id, p, words[p] AS word, words[p - 1] AS before
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM docs)),
ones AS (SELECT word, count(*) AS n FROM single GROUP BY word),
own_ones AS (SELECT doc_id, word, count(*) AS n FROM single GROUP BY doc_id, word),
twos AS (SELECT before, word, count(*) AS n FROM single WHERE p > 1 GROUP BY before, word),
own_twos AS (SELECT doc_id, before, word, count(*) AS n FROM single WHERE p > 1 GROUP BY doc_id, before, word),
joined AS (
  SELECT s.doc_id, p, a.n - oa.n AS n_word, b.n - ob.n AS n_before, t.n - ot.n AS n_two,
    (SELECT count(*) FROM single) - len(words) AS n_rest
  FROM single s JOIN docs USING (doc_id)
  JOIN ones a ON a.word = s.word JOIN own_ones oa ON oa.doc_id = s.doc_id AND oa.word = s.word
  LEFT JOIN ones b ON b.word = s.before LEFT JOIN own_ones ob ON ob.doc_id = s.doc_id AND ob.word = s.before
  LEFT JOIN twos t ON t.before = s.before AND t.word = s.word
  LEFT JOIN own_twos ot ON ot.doc_id = s.doc_id AND ot.before = s.before AND ot.word = s.word),
valued AS (
  SELECT doc_id, CASE WHEN p > 1 AND n_two > 0 THEN n_two / greatest(n_before, 1)
    ELSE (CASE WHEN p > 1 THEN 0.4 ELSE 1.0 END)::DOUBLE * greatest(n_word, 1) / greatest(n_rest, 1) END AS v FROM joined)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, round(s, 6) AS score
FROM docs LEFT JOIN (SELECT doc_id, avg(ln(v)) AS s FROM valued GROUP BY doc_id) USING (doc_id)"""


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans")


def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM docs GROUP BY source),
filled AS (
  SELECT *, (SELECT sum(source_size) FROM sources) - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
    (SELECT sum(w) FROM sources) - coalesce(sum(w) OVER before, 0) AS rest_w
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, 3 * source_size * rest_w < w * rest AS is_full FROM filled),
open AS (SELECT max(rest) FILTER (NOT is_full) AS rest, max(rest_w) FILTER (NOT is_full) AS rest_w FROM capped),
goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
      ELSE CAST(w * o.rest AS DOUBLE) / CAST(o.rest_w AS DOUBLE) END AS target,
    CASE WHEN is_full THEN 3 * source_size ELSE (2 * w * o.rest + o.rest_w) // (2 * o.rest_w) END AS goal
  FROM capped, open o),
budgets AS (
  SELECT *, goal // nullif(source_size, 0) AS passes, goal % nullif(source_size, 0) AS budget FROM goals),
running AS (
  SELECT d.*, b.source_size, b.target, b.passes, b.budget, sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
    sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CAST(coalesce(size * (passes + CASE
  WHEN upto <= budget OR (upto - own <= budget AND upto - budget < budget - (upto - own)) THEN 1 ELSE 0 END), 0) AS BIGINT) AS taken
FROM running"""


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
single AS (
  SELECT doc_id, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT doc_id, lang, source, unnest(terms) AS term FROM docs)),
kept AS (SELECT lang, term, count(*) AS lang_n FROM single GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_words FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM single JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, source, coalesce(sum(n), 0) AS words FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (s.words + 5 * l.v) AS BIGINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (k.lang_n + 5) // (l.lang_words + 5 * l.v) AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) JOIN sizes s ON s.lang = g.lang AND s.source = g.source
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clustered(table(spark, folder, "embeddings"))


def _cluster_sql(rounds: int = centroids.ROUNDS) -> str:
    """The rounds one after the other, over a row for each component."""
    found = r"""
WITH vectors AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
single AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS i FROM vectors),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM vectors ORDER BY c LIMIT 40),
c0 AS MATERIALIZED (SELECT c, i, x FROM single JOIN first USING (vec_id))"""
    for k in range(rounds + 1):
        found += f""",
d{k} AS (SELECT vec_id, c, CAST(sum((s.x - t.x) * (s.x - t.x)) AS BIGINT) AS d FROM single s JOIN c{k} t USING (i) GROUP BY vec_id, c),
a{k} AS MATERIALIZED (SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{k} GROUP BY vec_id)"""
        if k < rounds:
            found += f""",
m{k} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{k} JOIN single USING (vec_id) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (SELECT c, i, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{k} LEFT JOIN m{k} USING (c, i))"""
    return found + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) USING (c)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_prefix_forest": op2_prefix_forest,
    "op3_token_files": op3_token_files,
    "op4_length_buckets": op4_length_buckets,
    "op5_multiset_fingerprint": op5_multiset_fingerprint,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_lm_scores": op9_lm_scores,
    "op10_secret_scan": op10_secret_scan,
    "op11_source_mix": op11_source_mix,
    "op12_source_divergence": op12_source_divergence,
    "op13_centroid_clusters": op13_centroid_clusters,
}
#: Of the same operators, over more than their queries' SQL states.
FURTHER: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op9_lm_scores_longer": op9_lm_scores_longer}
ORACLE_SQL = {
    "op8_substring_dedup": SUBSTRING_SQL, "op9_lm_scores": LM_SQL, "op11_source_mix": MIX_SQL,
    "op12_source_divergence": DIVERGENCE_SQL, "op13_centroid_clusters": _cluster_sql()}
