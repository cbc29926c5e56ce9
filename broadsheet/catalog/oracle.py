"""The same results in plain SQL, to check the Spark queries against.

Written for DuckDB over the supplied tables, each in the most direct form there
is, whatever shortcut the Spark side takes.
"""

from __future__ import annotations

from broadsheet.functions.text import STOP_WORDS
from broadsheet.schemas import NUMERIC_FEATURES, STATISTIC_FEATURES

NEWS = r"""
news AS (
  SELECT d.doc_id,
         md5(split_part(d.text, chr(10), 1) || d.text) AS id,
         d.source,
         CASE WHEN l.quality IS NOT NULL THEN 'labeled_data' ELSE 'news_api' END AS source_type,
         split_part(d.text, chr(10), 1) AS title,
         d.text AS content,
         'https://example.com/' || d.doc_id AS url,
         CAST(NULL AS VARCHAR) AS published_date,
         CASE d.doc_id % 3 WHEN 0 THEN '' WHEN 2 THEN 'author_' || d.source END AS author,
         CASE l.quality WHEN 1 THEN 'real' WHEN 0 THEN 'fake' END AS label,
         strftime(DATE '2024-01-01' + CAST(d.doc_id % 30 AS INTEGER), '%Y-%m-%d') AS bronze_date
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

HTML_NEWS = r"""
html_news AS (
  SELECT page_id, md5(regexp_extract(html, '<title>([^<]*)</title>', 1) || html) AS id,
         'web' AS source, 'rss' AS source_type,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS content, url
  FROM pages
)"""

SOCIAL = r"""
social AS (
  SELECT md5('forum' || conv_id || '-' || turn) AS id, 'forum' AS source,
         'social_media' AS source_type, text AS content, role AS author
  FROM conversations
)"""

SILVER = r"""
cleaned AS (
  SELECT doc_id, id, source, source_type, label, url, published_date, author,
         regexp_replace(title, '<[^>]+>', '', 'g') AS title_cleaned,
         regexp_replace(content, '<[^>]+>', '', 'g') AS content_cleaned
  FROM news WHERE content IS NOT NULL AND length(content) > 100
), silver AS (
  SELECT id, source, source_type, title_cleaned, content_cleaned, url, published_date, author,
         len(string_split(content_cleaned, ' ')) AS word_count,
         length(content_cleaned) AS char_count,
         CAST(CASE WHEN author IS NOT NULL AND author <> '' THEN 1 ELSE 0 END AS BIGINT) AS has_author,
         label
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn FROM cleaned)
  WHERE rn = 1
)"""

GOLD = r"""
gold AS (
  SELECT id, source, source_type, label, word_count, char_count, has_author,
         length(title_cleaned) AS title_length,
         length(content_cleaned) - length(replace(content_cleaned, '!', '')) AS exclamation_count,
         length(content_cleaned) - length(replace(content_cleaned, '?', '')) AS question_count,
         CAST(length(regexp_replace(content_cleaned, '[^A-Z]', '', 'g')) AS DOUBLE)
           / nullif(char_count, 0) AS caps_ratio,
         CAST(char_count AS DOUBLE) / nullif(word_count, 0) AS avg_word_length,
         len(string_split_regex(content_cleaned, '[0-9]+')) AS numeric_count,
         len(string_split_regex(content_cleaned, 'https?://\S+')) AS url_count
  FROM silver
)"""

_BASE = f"WITH {NEWS}"
_SILVER = f"{_BASE}, {SILVER}"
_GOLD = f"{_SILVER}, {GOLD}"
_FEED = f"""{_BASE}, {HTML_NEWS}, {SOCIAL}, feed AS (
  SELECT id, source, source_type FROM news
  UNION ALL SELECT id, source, source_type FROM html_news
  UNION ALL SELECT id, source, source_type FROM social
)"""


def _profile(words: str, caps: str, average: str, numbers: str, urls: str) -> str:
    return rf"""{_SILVER}
SELECT id, {words} AS word_count, char_count, has_author, length(title_cleaned) AS title_length,
       length(content_cleaned) - length(replace(content_cleaned, '!', '')) AS exclamation_count,
       length(content_cleaned) - length(replace(content_cleaned, '?', '')) AS question_count,
       round(CAST({caps} AS DOUBLE) / nullif(char_count, 0), 6) AS caps_ratio,
       round(CAST({average}, 6) AS avg_word_length,
       CAST({numbers} AS BIGINT) AS numeric_count, CAST({urls} AS BIGINT) AS url_count
FROM silver"""


_WORDS = r"len(regexp_extract_all(content_cleaned, '\S+'))"
_UPPER = r"length(regexp_replace(content_cleaned, '\P{Lu}', '', 'g'))"

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
_TOKENS = rf"""tokens AS (
  SELECT id, label,
         CASE WHEN content_cleaned <> '' AND regexp_full_match(content_cleaned, '\s+') THEN []
              ELSE string_split_regex(regexp_replace(lower(content_cleaned), '\s+$', ''), '\s') END AS words
  FROM silver
), filtered AS (
  SELECT id, label, list_filter(words, lambda w: w NOT IN ({_STOP})) AS words FROM tokens
)"""
_TFIDF = """tf AS (
  SELECT id, term, count(*) AS tf
  FROM (SELECT id, unnest(words) AS term FROM filtered) WHERE term <> '' GROUP BY id, term
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), weighted AS (
  SELECT tf.id, tf.term, tf.tf, df.df,
         tf.tf * ln(((SELECT count(*) FROM silver) + 1.0::DOUBLE) / (df.df + 1)) AS weight
  FROM tf JOIN df ON tf.term = df.term
)"""

_M = "4294967295::UBIGINT"


def _rotl(x: str, n: int) -> str:
    return f"((({x} << {n}) | ({x} >> {32 - n})) & {_M})"


def _mixed(k: str) -> str:
    """A block of Murmur3 before it enters the state."""
    return f"(({_rotl(f'(({k} * 3432918353) & {_M})', 15)} * 461845907) & {_M})"


def _byte(at: str) -> str:
    return f"CAST('0x' || substr(hx, 2 * ({at}) + 1, 2) AS UBIGINT)"


# Murmur3 (32 bit, seed 42) of each term's UTF-8 bytes, modulo 1000 as a signed number.
_BUCKETS = f"""spelled AS (
  SELECT term, hex(encode(term)) AS hx, strlen(term)::BIGINT AS n
  FROM (SELECT DISTINCT unnest(words) AS term FROM filtered)
), blocks AS (
  SELECT term, n,
         list_transform(range(0, n // 4), lambda i: {_byte("4 * i")} + 256 * {_byte("4 * i + 1")}
           + 65536 * {_byte("4 * i + 2")} + 16777216 * {_byte("4 * i + 3")}) AS body,
         CASE WHEN n % 4 >= 1 THEN {_byte("n - n % 4")} ELSE 0 END
           + CASE WHEN n % 4 >= 2 THEN 256 * {_byte("n - n % 4 + 1")} ELSE 0 END
           + CASE WHEN n % 4 >= 3 THEN 65536 * {_byte("n - n % 4 + 2")} ELSE 0 END AS tail
  FROM spelled
), mixed AS (
  SELECT term, n, list_transform(body, lambda k: {_mixed("k::UBIGINT")}) AS body,
         {_mixed("tail::UBIGINT")} AS tail
  FROM blocks
), state AS (
  SELECT term, xor(xor(list_reduce(list_concat([42::UBIGINT], body),
           lambda h, k: ({_rotl("xor(h, k)", 13)} * 5 + 3864292196) & {_M}), tail), n::UBIGINT) AS h
  FROM mixed
), avalanche AS (
  SELECT term, (xor(h, h >> 16) * 2246822507) & {_M} AS h FROM state
), avalanche2 AS (
  SELECT term, (xor(h, h >> 13) * 3266489909) & {_M} AS h FROM avalanche
), hashed AS (
  SELECT term, xor(h, h >> 16)::BIGINT AS h FROM avalanche2
), buckets AS (
  SELECT term, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 1000 + 1000) % 1000 AS bucket
  FROM hashed
), counts AS (
  SELECT id, bucket, count(*) AS n
  FROM (SELECT id, unnest(words) AS term FROM filtered) JOIN buckets USING (term) GROUP BY id, bucket
)"""

_LABELLED = "labelled AS (SELECT * FROM gold WHERE label IS NOT NULL)"
_BUCKET = "CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 100"
_HASH_SPLIT = f"""hash_split AS (
  SELECT id, label, CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS split FROM labelled
)"""

_VOTED = """voters AS (
  SELECT id, label,
         CASE WHEN coalesce(caps_ratio, 0) > 0.025::DOUBLE THEN 1 ELSE 0 END AS p1,
         CASE WHEN coalesce(avg_word_length, 0) > 6.0::DOUBLE THEN 1 ELSE 0 END AS p2,
         CASE WHEN has_author = 0 THEN 1 ELSE 0 END AS p3
  FROM gold
), voted AS (
  SELECT id, label, CAST(CASE WHEN p1 + p2 + p3 >= 2 THEN 1 ELSE 0 END AS DOUBLE) AS vote,
         (CASE p1 WHEN 1 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END
          + CASE p2 WHEN 1 THEN 0.8::DOUBLE ELSE 0.7::DOUBLE END
          + CASE p3 WHEN 1 THEN 0.55::DOUBLE ELSE 0.95::DOUBLE END) / 3 AS confidence
  FROM voters
), judged AS (
  SELECT label, CASE WHEN vote = 1 THEN 'fake' ELSE 'real' END AS prediction
  FROM voted WHERE label IS NOT NULL
)"""

PREDICTIONS = """
predictions AS (
  SELECT event_id AS id, 'user_' || user_id AS source,
         CASE WHEN event_type = 'error' THEN 'fake' ELSE 'real' END AS prediction,
         ts AS analyzed_at, value AS latency_ms, event_type AS component
  FROM events
)"""
_PRED = f"WITH {PREDICTIONS}"

_PRIOR = """WITH articles AS (
  SELECT doc_id, md5(text) AS content_hash FROM documents
), prior AS (
  SELECT md5(d.text) AS content_hash,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(d.doc_id % 1440 AS INTEGER)) AS analyzed_at,
         CASE WHEN l.quality = 1 THEN 'real' ELSE 'fake' END AS prediction,
         0.9::DOUBLE AS confidence
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
), fresh AS (
  SELECT * FROM prior
  WHERE analyzed_at > TIMESTAMP '2024-01-01 11:00:00' AND analyzed_at <= TIMESTAMP '2024-01-01 12:00:00'
)"""


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _statistics() -> str:
    rows = [
        f"""SELECT '{f}' AS feature, count({f}) AS count, round(avg({f}), 6) AS mean,
  round(stddev_samp({f}), 6) AS stddev, round(CAST(min({f}) AS DOUBLE), 6) AS min,
  round(CAST(max({f}) AS DOUBLE), 6) AS max FROM gold"""
        for f in STATISTIC_FEATURES
    ]
    return f"{_GOLD}\n" + "\nUNION ALL\n".join(rows)


def _scaled() -> str:
    sd = ", ".join(f"stddev_samp({f}) AS {f}" for f in NUMERIC_FEATURES)
    cols = ", ".join(
        f"round(coalesce(coalesce(g.{f}, 0) / nullif(s.{f}, 0), 0), 6) AS {f}" for f in NUMERIC_FEATURES
    )
    return f"{_GOLD}, sd AS (SELECT {sd} FROM gold) SELECT g.id, {cols} FROM gold g, sd s"


def _vector_total() -> str:
    return " + ".join(f"coalesce({f}, 0)" for f in NUMERIC_FEATURES)


SQL: dict[str, str] = {
    # sources
    "social_normalise": f"""WITH {SOCIAL} SELECT id, source, source_type, content, author,
  0::BIGINT AS likes, 0::BIGINT AS shares, 0::BIGINT AS comments FROM social""",
    "labelled_normalise": """SELECT md5(split_part(d.text, chr(10), 1) || d.text) AS id,
  'training_dataset' AS source, 'labeled_data' AS source_type,
  split_part(d.text, chr(10), 1) AS title, d.text AS content,
  CASE WHEN l.quality = 1 THEN 'real' ELSE 'fake' END AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "content_hash": f"{_BASE} SELECT doc_id, id FROM news",
    "source_union": f"""{_FEED} SELECT source_type, count(*) AS n, count(DISTINCT id) AS distinct_ids
FROM feed GROUP BY source_type""",
    "keyed_envelope": f"""{_BASE}, {HTML_NEWS}, {SOCIAL} SELECT id AS key, title, source FROM news
UNION ALL SELECT id, regexp_extract(html, '<title>([^<]*)</title>', 1), 'web' FROM pages JOIN html_news USING (page_id)
UNION ALL SELECT id, '', source FROM social""",
    "ingest_counts": f"{_FEED} SELECT source, source_type, count(*) AS n FROM feed GROUP BY source, source_type",
    "json_decode": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    # silver
    "silver_filter": f"{_BASE} SELECT doc_id FROM news WHERE content IS NOT NULL AND length(content) > 100",
    "strip_tags": f"""WITH {HTML_NEWS} SELECT page_id,
  regexp_replace(title, '<[^>]+>', '', 'g') AS title_cleaned,
  regexp_replace(content, '<[^>]+>', '', 'g') AS content_cleaned FROM html_news""",
    "text_lengths": f"""{_BASE} SELECT doc_id,
  len(string_split(regexp_replace(content, '<[^>]+>', '', 'g'), ' ')) AS word_count,
  length(regexp_replace(content, '<[^>]+>', '', 'g')) AS char_count FROM news""",
    "has_author": f"""{_BASE} SELECT doc_id,
  CAST(CASE WHEN author IS NOT NULL AND author <> '' THEN 1 ELSE 0 END AS BIGINT) AS has_author FROM news""",
    "dedup_by_id": f"{_BASE} SELECT id, min(doc_id) AS doc_id FROM news GROUP BY id",
    "silver": f"{_SILVER} SELECT * FROM silver",
    "incremental_new_ids": f"""{_SILVER} SELECT id FROM silver WHERE id NOT IN (
  SELECT id FROM news WHERE bronze_date <= '2024-01-15' AND length(content) > 100)""",
    # gold
    "gold_features": f"""{_GOLD} SELECT * REPLACE (round(caps_ratio, 6) AS caps_ratio,
  round(avg_word_length, 6) AS avg_word_length) FROM gold""",
    "features_documented": _profile(
        _WORDS,
        _UPPER,
        f"char_count AS DOUBLE) / nullif({_WORDS}, 0)",
        "len(regexp_extract_all(content_cleaned, '[0-9]+'))",
        "len(regexp_extract_all(content_cleaned, 'https?://'))",
    ),
    "features_serving": _profile(
        _WORDS,
        _UPPER,
        f"length(replace(content_cleaned, ' ', '')) AS DOUBLE) / greatest({_WORDS}, 1)",
        r"length(regexp_replace(content_cleaned, '\P{Nd}', '', 'g'))",
        "len(string_split(lower(content_cleaned), 'http')) - 1",
    ),
    "feature_statistics": _statistics(),
    "scaled_features": _scaled(),
    "numeric_vector": f"{_GOLD} SELECT id, 10::BIGINT AS size, round({_vector_total()}, 6) AS total FROM gold",
    # text
    "token_counts": f"""{_SILVER}, {_TOKENS}
SELECT id, len(words) AS n_tokens, len(list_distinct(words)) AS n_distinct FROM tokens""",
    "stopword_filtered": f"""{_SILVER}, {_TOKENS}
SELECT id, len(words) AS n_tokens, len(list_distinct(words)) AS n_distinct FROM filtered""",
    "hashing_tf": f"""{_SILVER}, {_TOKENS}, {_BUCKETS}
SELECT s.id, count(c.bucket) AS n_nonzero, coalesce(sum(c.n), 0)::DOUBLE AS total,
       coalesce(sum(c.n * c.bucket), 0)::DOUBLE AS checksum
FROM silver s LEFT JOIN counts c ON s.id = c.id GROUP BY s.id""",
    "tfidf_vectors": f"""{_SILVER}, {_TOKENS}, {_BUCKETS}, idf AS (
  SELECT bucket, ln(((SELECT count(*) FROM silver) + 1.0::DOUBLE) / (count(*) + 1)) AS idf
  FROM counts GROUP BY bucket
), weighted AS (
  SELECT c.id, c.bucket, c.n * i.idf AS v FROM counts c JOIN idf i ON c.bucket = i.bucket
)
SELECT s.id, count(*) FILTER (WHERE w.v <> 0) AS n_nonzero, round(coalesce(sum(w.v), 0), 6) AS total,
       round(coalesce(sum(w.v * w.bucket), 0), 2) AS checksum
FROM silver s LEFT JOIN weighted w ON s.id = w.id GROUP BY s.id""",
    "term_tfidf": f"""{_SILVER}, {_TOKENS}, {_TFIDF}
SELECT id, term, tf, df, round(weight, 6) AS weight FROM weighted""",
    "top_terms_by_label": f"""{_SILVER}, {_TOKENS}, {_TFIDF}, totals AS (
  SELECT s.label, w.term, round(sum(w.weight), 6) AS weight
  FROM weighted w JOIN silver s ON w.id = s.id WHERE s.label IS NOT NULL GROUP BY s.label, w.term
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, term) AS rank FROM totals
) SELECT label, term, weight, rank FROM ranked WHERE rank <= 20""",
    # quality
    "quality_bronze": f"""{_BASE} SELECT count(*) AS total_records, count(DISTINCT source) AS unique_sources,
  min(bronze_date) AS min_date, max(bronze_date) AS max_date FROM news""",
    "quality_silver": f"""{_SILVER} SELECT count(*) AS total_records,
  round(avg(word_count), 6) AS avg_word_count,
  round(count(*) FILTER (WHERE content_cleaned IS NULL) / nullif(count(*), 0)::DOUBLE, 6) AS null_content_ratio
FROM silver""",
    "label_distribution": f"{_GOLD} SELECT label, count(*) AS n FROM gold GROUP BY label",
    "quality_report": f"""{_GOLD}
SELECT 'bronze' AS layer, 'total_records' AS metric, count(*)::DOUBLE AS value, CAST(NULL AS VARCHAR) AS text FROM news
UNION ALL SELECT 'bronze', 'unique_sources', count(DISTINCT source)::DOUBLE, NULL FROM news
UNION ALL SELECT 'bronze', 'min_date', NULL, min(bronze_date) FROM news
UNION ALL SELECT 'bronze', 'max_date', NULL, max(bronze_date) FROM news
UNION ALL SELECT 'silver', 'total_records', count(*)::DOUBLE, NULL FROM silver
UNION ALL SELECT 'silver', 'avg_word_count', round(avg(word_count), 6), NULL FROM silver
UNION ALL SELECT 'silver', 'null_content_ratio',
  round(count(*) FILTER (WHERE content_cleaned IS NULL) / nullif(count(*), 0)::DOUBLE, 6), NULL FROM silver
UNION ALL SELECT 'gold', 'total_records', count(*)::DOUBLE, NULL FROM gold
UNION ALL SELECT 'gold', 'label_' || coalesce(label, 'none'), count(*)::DOUBLE, NULL FROM gold GROUP BY label""",
    "source_distribution": f"{_SILVER} SELECT source, count(*) AS n FROM silver GROUP BY source",
    "layer_flow": f"""{_GOLD}
SELECT 'Ingestion' AS stage_from, 'Bronze' AS stage_to, count(*) AS records FROM news
UNION ALL SELECT 'Bronze', 'Silver', count(*) FROM silver
UNION ALL SELECT 'Silver', 'Gold', count(*) FROM gold
UNION ALL SELECT 'Gold', 'Model', count(*) FROM gold""",
    # splits
    "labelled_only": f"{_GOLD}, {_LABELLED} SELECT id, label FROM labelled",
    "hash_split": f"{_GOLD}, {_LABELLED}, {_HASH_SPLIT} SELECT id, split FROM hash_split",
    "stratified_split": f"""{_GOLD}, {_LABELLED}, ranked AS (
  SELECT id, row_number() OVER (PARTITION BY label ORDER BY md5(id), id) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM labelled
) SELECT id, CASE WHEN rn <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM ranked""",
    "split_counts": f"""{_GOLD}, {_LABELLED}, {_HASH_SPLIT}
SELECT split, label, count(*) AS n FROM hash_split GROUP BY split, label""",
    # evaluation
    "label_index": f"""{_GOLD}, {_LABELLED} SELECT id, label,
  CASE label WHEN 'real' THEN 0.0::DOUBLE WHEN 'fake' THEN 1.0::DOUBLE END AS label_index FROM labelled""",
    "auc_rank": """WITH s AS (
  SELECT d.n_chars AS score, l.quality AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id
), r AS (
  SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS avg_rank FROM s
), t AS (
  SELECT sum(avg_rank) FILTER (WHERE y = 1) AS ranks, count(*) FILTER (WHERE y = 1)::DOUBLE AS p,
         count(*) FILTER (WHERE y <> 1)::DOUBLE AS n FROM r
) SELECT round((ranks - p * (p + 1) / 2) / (p * n), 6) AS auc FROM t""",
    "majority_vote": f"{_GOLD}, {_VOTED} SELECT id, vote, round(confidence, 6) AS confidence FROM voted",
    "confusion_matrix": f"""{_GOLD}, {_VOTED}
SELECT label, prediction, count(*) AS n FROM judged GROUP BY label, prediction""",
    "classification_metrics": f"""{_GOLD}, {_VOTED}, c AS (
  SELECT count(*)::DOUBLE AS total, count(*) FILTER (WHERE label = prediction)::DOUBLE AS hits,
         count(*) FILTER (WHERE label = 'fake' AND prediction = 'fake')::DOUBLE AS tp,
         count(*) FILTER (WHERE label = 'real' AND prediction = 'fake')::DOUBLE AS fp,
         count(*) FILTER (WHERE label = 'fake' AND prediction = 'real')::DOUBLE AS fn FROM judged
) SELECT round(hits / nullif(total, 0), 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision,
  round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""",
    "ensemble_accuracy": f"""{_GOLD}, {_VOTED}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy FROM judged""",
    # requests and reuse
    "content_preview": f"{_BASE} SELECT doc_id, substr(content, 1, 200) || '...' AS content_preview FROM news",
    "validate_requests": f"""{_BASE} SELECT doc_id, doc_id % 7 <> 0 AS ok, title,
  coalesce(author, '') AS author, CASE WHEN doc_id % 5 <> 0 THEN source ELSE 'api' END AS source FROM news""",
    "unscored_content": f"""{_PRIOR} SELECT doc_id, content_hash FROM articles
WHERE content_hash NOT IN (SELECT content_hash FROM fresh)""",
    "reused_predictions": f"""{_PRIOR}, latest AS (
  SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY analyzed_at DESC, prediction DESC) AS rn FROM fresh
) SELECT a.doc_id, a.content_hash, l.prediction, l.confidence
FROM articles a JOIN latest l ON a.content_hash = l.content_hash AND l.rn = 1""",
    "latest_labels": """WITH v AS (
  SELECT doc_id, quality, 1 AS version FROM labels
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 1 - quality ELSE quality END, 2 FROM labels
), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY version DESC) AS rn FROM v)
SELECT doc_id, quality::BIGINT AS quality FROM r WHERE rn = 1""",
    # monitoring
    "predictions_daily": f"""{_PRED}, d AS (
  SELECT date_trunc('day', analyzed_at) AS day, count(*) AS total,
         count(*) FILTER (WHERE prediction = 'fake') AS fake,
         count(*) FILTER (WHERE prediction = 'real') AS real, avg(latency_ms) AS latency
  FROM predictions GROUP BY 1
) SELECT {_stamp("day")} AS day, total, fake, real, round(fake / total::DOUBLE * 100, 6) AS fake_pct,
  total // 24 AS per_hour, fake // 24 AS fake_per_hour, round(latency, 6) AS avg_response_ms FROM d""",
    "recent_predictions": f"""{_PRED} SELECT id, source, prediction, {_stamp("analyzed_at")} AS analyzed_at,
  round(latency_ms, 6) AS latency_ms, component
FROM (SELECT * FROM predictions ORDER BY predictions.analyzed_at DESC, id DESC LIMIT 10)""",
    "hourly_trend": f"""{_PRED} SELECT {_stamp("date_trunc('hour', analyzed_at)")} AS hour,
  count(*) FILTER (WHERE prediction = 'fake') AS fake, count(*) FILTER (WHERE prediction = 'real') AS real
FROM predictions GROUP BY 1""",
    "latency_by_component": f"""{_PRED} SELECT {_stamp("date_trunc('minute', analyzed_at)")} AS minute,
  component, round(avg(latency_ms), 6) AS avg_latency_ms FROM predictions GROUP BY 1, 2""",
    "prediction_rate": f"""{_PRED} SELECT {_stamp("date_trunc('hour', analyzed_at)")} AS window_start,
  count(*) AS n FROM predictions GROUP BY 1""",
    "prediction_rate_minute": f"""{_PRED} SELECT {_stamp("date_trunc('minute', analyzed_at)")} AS window_start,
  count(*) AS n FROM predictions GROUP BY 1""",
    "prediction_rate_sliding": f"""{_PRED} SELECT
  {_stamp("time_bucket(INTERVAL '10 minutes', analyzed_at) - to_minutes(CAST(10 * step AS INTEGER))")} AS window_start,
  count(*) AS n FROM predictions, range(6) AS steps(step) GROUP BY 1""",
    "ingest_throughput": f"""SELECT {_stamp("date_trunc('minute', ts)")} AS minute, count(*) AS n
FROM events GROUP BY 1""",
    # streams
    "stream_to_bronze": f"""{_BASE} SELECT id, source, source_type, title, label,
  '2024-02-01' AS bronze_date FROM news""",
    "stream_to_silver": _SILVER.replace("ORDER BY doc_id)", "ORDER BY label IS NULL, source, url)")
    + " SELECT * FROM silver",
    "stream_dedup": f"{_BASE} SELECT DISTINCT id FROM news",
}
SQL["live_predictions_daily"] = SQL["predictions_daily"]
SQL["live_hourly_trend"] = SQL["hourly_trend"]
_PHRASES = f"""phrases AS (
  SELECT id, label, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) AS words FROM tokens
)"""
SQL["top_phrases_by_label"] = (
    SQL["top_terms_by_label"].replace(_TOKENS, f"{_TOKENS}, {_PHRASES}").replace("FROM filtered", "FROM phrases")
)
