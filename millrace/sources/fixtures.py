"""Crawl tables derived from the driver's tables, by one SQL text for Spark and for the DuckDB oracle.

Times are microseconds since 1970 (``*_us``), so nothing depends on a session's time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

API_VIDEOS = """
SELECT concat('v', lpad(CAST(d.doc_id AS {S}), 10, '0')) AS id, d.doc_id AS seq,
 CASE d.doc_id % 5 WHEN 0 THEN 'seed' WHEN 1 THEN 'ids-file' WHEN 2 THEN concat('search:q', CAST(d.doc_id % 7 AS {S}))
   WHEN 3 THEN concat('channel:UC', d.source) ELSE concat('expand:UC', d.source) END AS source,
 concat('UC', d.source) AS channel_id,
 concat('PT', CAST(CAST(floor(d.n_chars / 60) AS bigint) AS {S}), 'M', CAST(d.n_chars % 60 AS {S}), 'S') AS duration,
 d.n_chars AS duration_s,
 CASE WHEN d.doc_id % 4 = 0 THEN 'youtube' ELSE 'creativeCommon' END AS license,
 CASE WHEN d.doc_id % 11 = 0 THEN 'live' WHEN d.doc_id % 13 = 0 THEN 'upcoming' ELSE 'none' END AS live,
 coalesce(l.toxic, 0) = 1 AS age_restricted, d.doc_id % 19 = 0 AS made_for_kids,
 CASE WHEN d.doc_id % 23 = 0 THEN 'private' WHEN d.doc_id % 7 = 0 THEN 'unlisted' ELSE 'public' END AS privacy,
 d.lang AS language
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

ATTEMPTS = """
SELECT event_id AS id, {US} AS ts_us, concat('w', CAST(event_id % 4 AS {S})) AS worker,
 concat('p', CAST(user_id % 4 AS {S}), '/', CAST(user_id AS {S})) AS label, concat('p', CAST(user_id % 4 AS {S})) AS provider,
 concat('v', lpad(CAST(event_id % greatest((SELECT count(*) FROM {documents}), 1) AS {S}), 10, '0')) AS video,
 CASE event_type WHEN 'purchase' THEN 'fetched' WHEN 'view' THEN 'fetched' WHEN 'click' THEN 'unavailable' WHEN 'signup' THEN 'failed'
   ELSE CASE WHEN event_id % 2 = 0 THEN 'bot_check' ELSE 'proxy_error' END END AS outcome,
 CASE WHEN event_type IN ('purchase', 'view') THEN CAST(floor(value * 1000) AS bigint) ELSE 0 END AS bytes,
 value AS seconds,
 CASE WHEN event_type IN ('purchase', 'view') THEN CAST(floor(value) AS bigint) ELSE 0 END AS duration_s
FROM {events}
"""

QUEUE_EVENTS = """
SELECT video, ts_us - 1000000 AS at_us, id * 4 AS eid, 'lease' AS kind, worker, 1800 AS hold_s, CAST(NULL AS {S}) AS state, CAST(0 AS bigint) AS bytes FROM {attempts}
UNION ALL SELECT video, ts_us - 500000, id * 4 + 1, 'extend', worker, 1800, CAST(NULL AS {S}), CAST(0 AS bigint) FROM {attempts} WHERE id % 3 = 0
UNION ALL SELECT video, ts_us, id * 4 + 2, 'finish', worker, 0, outcome, bytes FROM {attempts} WHERE outcome IN ('fetched', 'unavailable') AND id % 7 = 0
UNION ALL SELECT video, ts_us, id * 4 + 3, 'requeue', worker, 600, CAST(NULL AS {S}), CAST(0 AS bigint) FROM {attempts} WHERE outcome = 'failed'
"""

CHANNELS = """
SELECT concat('UC', source) AS channel, min(doc_id) AS seq, CASE WHEN min(doc_id) % 3 = 0 THEN 'seed' ELSE 'expand' END AS kind,
 CASE WHEN min(doc_id) % 2 = 0 THEN concat('UC', source) END AS resolved, CASE WHEN min(doc_id) % 2 = 0 THEN concat('UU', source) END AS uploads,
 min(doc_id) % 4 = 0 AS done FROM {documents} GROUP BY source
UNION ALL SELECT concat('@', source), min(doc_id) + 100000000, 'seed', CASE WHEN min(doc_id) % 5 = 0 THEN concat('UC', source) END, CAST(NULL AS {S}), false
 FROM {documents} GROUP BY source HAVING min(doc_id) % 5 < 3
"""

SEARCH_PAGES = """
SELECT concat('q', CAST(doc_id % 7 AS {S})) AS query, CAST(doc_id % 7 AS int) AS query_pos, CAST(floor(doc_id / 7) AS bigint) AS page, doc_id AS page_id FROM {documents}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spark(text: str) -> str:
    return text.replace("{S}", "STRING").replace("{US}", "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")


def duck(text: str) -> str:
    """A derivation as DuckDB reads it."""
    return text.replace("{S}", "VARCHAR").replace("{US}", "epoch_us(ts)").replace("{", "").replace("}", "")


def api_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(API_VIDEOS), documents=table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(ATTEMPTS), events=table(spark, sf_dir, "events"), documents=table(spark, sf_dir, "documents"))


def queue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(QUEUE_EVENTS), attempts=attempts(spark, sf_dir))


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(CHANNELS), documents=table(spark, sf_dir, "documents"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(SEARCH_PAGES), documents=table(spark, sf_dir, "documents"))
