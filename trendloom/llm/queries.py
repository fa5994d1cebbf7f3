"""The registered queries ``op<N>_<name>`` and their SQL.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``, ``ORACLES`` to DuckDB SQL with the
same result where SQL can express it. Each query applies its operator to a whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from trendloom.llm import (
    byte_pairs, decontaminate, divergence, jaccard_join, language, maxscore, mixing, passages,
    quality, resampling, sharding, template_sql, url_filter, warc,
)
from trendloom.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("times")).alias("taken"))


@query()
def op5_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source")


@query("""
WITH RECURSIVE listed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'),
    lambda x: x <> '') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS l, unnest(w) AS w, unnest(range(len(w))) AS p FROM listed),
runs AS (
  SELECT doc_id, l, p, w || coalesce(' ' || lead(w, 1) OVER t, '') || coalesce(' ' || lead(w, 2) OVER t, '')
    || coalesce(' ' || lead(w, 3) OVER t, '') || coalesce(' ' || lead(w, 4) OVER t, '') AS shingle
  FROM words WINDOW t AS (PARTITION BY doc_id ORDER BY p)),
distinct_runs AS (
  SELECT DISTINCT doc_id, shingle FROM runs WHERE p = 0 OR p <= l - 5),
shingles AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM distinct_runs),
numbers AS (
  SELECT shingle, row_number() OVER () AS id FROM shingles GROUP BY shingle HAVING count(*) > 1),
shared AS MATERIALIZED (SELECT doc_id, n, id FROM shingles JOIN numbers USING (shingle)),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
  FROM shared a JOIN shared b ON a.id = b.id AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id),
half AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (n + m - common)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
named AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM named LEFT JOIN (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id) USING (doc_id)""")
def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


@query()
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    held_out = quality.fold("doc_id", quality.FOLDS) == quality.HELD_OUT
    scored = quality.score(docs, weights)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query(template_sql.ORACLE)
def op8_decontamination(spark, sf_dir):
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


@query("""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule,
    max_by(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM urls) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, CASE
  WHEN regexp_matches(path, '^/(cgi-bin/|wp-login\\.|tag/|(.|\\n)*/(login|cart|checkout)/)')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN fits USING (host, path)""")
def op1_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


@query("""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))
    AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op3_maxscore(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.search(vectors, vectors.where("vec_id % 50 = 0"))


@query("""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
letters AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((('0x' || substr(hex, 5 * CAST(floor(i / 4) AS INTEGER) + 1, 5))::INTEGER
      // CAST(pow(32, 3 - i % 4) AS INTEGER)) % 32 AS INTEGER), 1), '' ORDER BY i) AS digest
  FROM (SELECT DISTINCT hex FROM payloads) CROSS JOIN (SELECT unnest(range(32)) AS i) GROUP BY hex),
firsts AS (SELECT html, max(page_id) AS first FROM payloads GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN letters USING (hex) JOIN firsts USING (html)""")
def op7_warc(spark, sf_dir):
    path = work_dir(spark, "archives")
    warc.write_archives(warc.records(table(spark, sf_dir, "pages")), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, *language.fit(docs))


@query()
def op2_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query(r"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END
  FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS (
  SELECT row_number() OVER () AS row_id, true AS own, doc_id, text FROM documents
  UNION ALL SELECT row_number() OVER (), false, NULL, text FROM benchmark),
listed AS (
  SELECT row_id, own, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT own, row_id, unnest(w || list_transform(list_zip(w[:-2], w[2:]),
    lambda p: p[1] || ' ' || p[2])) AS feature
  FROM listed),
counted AS MATERIALIZED (
  SELECT own, row_id, feature, count(*) AS n FROM features GROUP BY ALL),
coded AS (
  SELECT feature, list_transform(range(strlen(feature)),
    lambda i: CAST('0x' || substr(hex(feature), 2 * i + 1, 2) AS BIGINT)) AS code
  FROM (SELECT DISTINCT feature FROM counted)),
hashed AS MATERIALIZED (
  SELECT feature, xor(4294967295, list_reduce(list_prepend(4294967295, code),
    lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1]))) % 10000 AS bucket
  FROM coded, crc),
buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (own), 0) AS s, coalesce(sum(n) FILTER (NOT own), 0) AS t
  FROM counted JOIN hashed USING (feature) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM buckets) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM buckets) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM buckets),
weights AS (
  SELECT row_id, CAST(sum(n) AS BIGINT) AS n_features,
    CAST(floor(sum(n * gain)::DOUBLE / sum(n)) AS BIGINT) AS weight
  FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE own GROUP BY row_id),
scored AS (
  SELECT row_id, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM listed LEFT JOIN weights USING (row_id) WHERE own),
ranked AS (
  SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * (SELECT count(*) FROM ranked) // 100
  THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (row_id)""")
def op11_resampling(spark, sf_dir):
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query(r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT row_id) AS docs
  FROM (SELECT row_id, lang, source, unnest(w) AS term FROM docs) GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k ON k.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
totals AS (
  SELECT *, sum(n) OVER g + 5 * count(*) OVER g AS d, sum(lang_n) OVER g + 5 * count(*) OVER g AS lang_d
  FROM grid WINDOW g AS (PARTITION BY lang, source)),
shares AS MATERIALIZED (
  SELECT lang, source, term, n,
    CAST(1 + 1000000000::HUGEINT * (n + 5) // d AS BIGINT) AS p,
    CAST(1 + 1000000000::HUGEINT * (lang_n + 5) // lang_d AS BIGINT) AS q
  FROM totals),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
rows AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op12_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


TOKENIZER = "byte_bpe_multi_50k.tiktoken"


@query()
def op13_byte_pairs(spark, sf_dir):
    vocabulary = byte_pairs.read_vocabulary(public_tokenizers.path(TOKENIZER),
                                            public_tokenizers.PATTERN)
    ids = byte_pairs.encode(table(spark, sf_dir, "documents"), vocabulary)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return byte_pairs.decode(ids, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
