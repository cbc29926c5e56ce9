"""One query for each training-text operator, over the whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import (
    cotrain, decontam, filter_audit, fuzzy_lines, hard_negatives, hyperminhash, lattice, mixing, repetition, token_store,
    toxicity, vector_join, warc,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_latent_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.leaking_documents(documents(spark, sf_dir), benchmark)


@query
def op2_poisson_mix(spark, sf_dir):
    mixed = mixing.mix_sources(documents(spark, sf_dir))
    return mixed.select(
        "doc_id", "source", F.round("rate", 9).alias("rate"), "n_copies", "copy", "shuffle_key", "text"
    )


SQL["op2_poisson_mix"] = """
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, (SELECT sum(size) FROM sizes) * sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) / size AS rate
  FROM sizes
), pmf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cdf FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1) FROM pmf
  WHERE k < rate + 12 * sqrt(rate) + 20
), drawn AS (
  SELECT doc_id, source, text,
         CAST('0x' || substr(md5('mix-1|count|' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM documents
), counted AS (
  SELECT d.doc_id, d.source, d.text, p.rate, count(*) FILTER (p.cdf <= d.u) AS n_copies
  FROM drawn d JOIN pmf p ON d.source IS NOT DISTINCT FROM p.source
  GROUP BY ALL
), copies AS (
  SELECT *, unnest(range(n_copies)) AS copy FROM counted
)
SELECT doc_id, source, round(rate, 9) AS rate, n_copies, copy,
       CAST('0x' || substr(md5('mix-1|order|' || doc_id || '|' || copy), 1, 13) AS BIGINT) AS shuffle_key, text
FROM copies
"""


@query
def op3_noisy_or(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    worst = F.expr("array_max(transform(offending, x -> struct(x.score, -x.start as place, x.end))) as worst")
    return scored.select("*", F.size("offending").alias("n_offending"), worst).select(
        "doc_id", "held_out", "score", "predicted", "n_sentences", "n_offending",
        (-F.col("worst.place")).alias("worst_start"), F.col("worst.end").alias("worst_end"),
    )


@query
def op4_subword_lattice(spark, sf_dir):
    return lattice.lattice_scores(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_fuzzy_lines(spark, sf_dir):
    return fuzzy_lines.dedup_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


@query
def op6_cotraining(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = cotrain.train(docs, labels)
    return cotrain.score_quality(docs, model).select(
        "doc_id", "content_score", "metadata_score", "score", "accepted"
    )


@query
def op7_repetition_coverage(spark, sf_dir):
    return repetition.repetition_rules(documents(spark, sf_dir))


@query
def op8_hyperminhash(spark, sf_dir):
    return hyperminhash.near_duplicates(documents(spark, sf_dir))


@query
def op9_warc_dictionary(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = warc.read_archives(spark, warc.write_archives(pages))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op8_hyperminhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON p.a = x.doc_id JOIN sizes y ON p.b = y.doc_id
  WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS id, doc_id AS node FROM documents
  UNION SELECT r.id, w.b FROM reached r JOIN ways w ON r.node = w.a
), least AS (
  SELECT id, min(node) AS component_id FROM reached GROUP BY id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON d.doc_id = l.id LEFT JOIN sizes s ON d.doc_id = s.doc_id
"""

SQL["op9_warc_dictionary"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
), digests AS (
  SELECT *, array_to_string(list_transform(string_split(sha1(html), ''),
    lambda h: lpad(bin(strpos('0123456789abcdef', h) - 1), 4, '0')), '') AS bits FROM payloads
)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(5), lambda k: CAST(substr(bits, CAST(5 * i + k + 1 AS BIGINT), 1) AS INTEGER) * (1 << CAST(4 - k AS INTEGER))))::BIGINT,
    1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests
"""


@query
def op10_token_store(spark, sf_dir):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    folder = token_store.write_store(documents(spark, sf_dir), tokenizer)
    keys = token_store.stored_keys(spark, folder)
    return token_store.fetch(spark, folder, keys, digest=True).drop("occurrence")


@query
def op11_contingency_audit(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit_filters(documents(spark, sf_dir), labels)


SQL["op11_contingency_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts
), marks AS (
  SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS good, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
     coalesce(s.doc_id > min(s.doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM split s LEFT JOIN marks m ON s.doc_id = m.doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, step, strpos('ABCDE', substr(filter_order, step, 1)) AS own,
    list_transform(string_split(substr(filter_order, 1, step - 1), ''), lambda f: strpos('ABCDE', f)) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), met AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own, n, good, toxic, fails[own] AS fails_own,
    step > 1 AND list_bool_or(list_transform(before, lambda f: fails[f])) AS gone,
    len(list_filter(fails, lambda f: f)) = 1 AS one
  FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails_own), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (gone AND fails_own), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails_own AND one), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails_own), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fails_own), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM counted
"""


@query
def op12_block_join(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vector_join.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


_VECTORS = """
WITH vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
)"""

SQL["op12_block_join"] = f"""{_VECTORS}, whole AS (
  SELECT * FROM vectors WHERE len(list_filter(v, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranks AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranks WHERE rank <= 20
"""


@query
def op13_four_russians(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives.hard_negatives(hard_negatives.turned_labels(vectors))


SQL["op13_four_russians"] = f"""{_VECTORS}, whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(v, lambda x: floor(256 * x)) AS v
  FROM vectors WHERE label IS NOT NULL
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), mined AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
   AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM mined WHERE rank <= 5
"""
