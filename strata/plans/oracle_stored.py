"""DuckDB SQL for the queries of ``queries_stored``."""

from __future__ import annotations

from strata.plans.oracle import API, API_SRC, CDC, CDC_APPLY, CDC_SRC, SQL as BASE, with_
from strata.plans.oracle_state import BRONZE_FIELDS, CDC_EARLY, CDC_M6, SQL as STATE

SQL: dict[str, str] = {
    "upsert_stored": STATE["incremental_refresh"],
    "upsert_partial_stored": STATE["upsert_partial"],
    "delete_stored": with_(*CDC, CDC_APPLY) + "SELECT * FROM cdc_users WHERE id NOT IN (SELECT id FROM cdc_users_apply)",
    "landed_recent_window": BASE["recent_window"],
    "landed_incremental": STATE["incremental_refresh"],
    "json_messages": with_(*API) + "SELECT username, email, birth_year, TIMESTAMP '2024-01-02 03:00:00' AS ingested_at FROM api_users",
    "stream_resume": with_(API_SRC) + f"SELECT {BRONZE_FIELDS} FROM api_src",
    "stream_topics": with_(API_SRC, CDC_SRC) + """
SELECT kafka_topic, kafka_partition, max(kafka_offset) AS source_offset, max(kafka_offset) AS landed_offset, count(*) AS landed,
       CAST(0 AS BIGINT) AS lag, CAST(max(failures) AS INTEGER) AS failures
FROM (SELECT 'users_created' AS kafka_topic, kafka_partition, kafka_offset, 0 AS failures FROM api_src
      UNION ALL SELECT 'postgres.public.users', kafka_partition, kafka_offset, 1 FROM cdc_src)
GROUP BY kafka_topic, kafka_partition""",
    "stream_dedup_ranges": with_(API_SRC) + f"SELECT {BRONZE_FIELDS} FROM api_src",
    "stream_rate_exact": BASE["events_per_minute"],
    "stream_lag": "SELECT count(*) AS rows, CAST(4 AS BIGINT) AS batches, CAST(0 AS BIGINT) AS late_rows FROM orders",
    "delay_sketches": with_(API_SRC) + """
SELECT date_trunc('day', ingested_at) AS day, count(*) AS messages, true AS quantiles_hold, true AS senders_hold
FROM api_src GROUP BY 1""",
    "state_compare": with_(*CDC, CDC_M6, CDC_EARLY) + """
SELECT *, 'only_first' AS side FROM (SELECT id, name, email, department FROM early
  EXCEPT ALL SELECT id, name, email, department FROM cdc_users)
UNION ALL
SELECT *, 'only_second' FROM (SELECT id, name, email, department FROM cdc_users
  EXCEPT ALL SELECT id, name, email, department FROM early)""",
    "gold_users_enriched_hot": with_(*API, *CDC) + """
SELECT a.username, a.full_name, a.gender, a.email, a.birth_year, c.id AS db_id, c.department, c.source_ts AS last_db_update,
       a.ingested_at AS api_ingested_at
FROM api_users a LEFT JOIN (
  SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN (SELECT min(email) FROM api_users) ELSE email END AS email) FROM cdc_users) c
ON lower(a.email) = lower(c.email)""",
    "catalog_lifecycle": with_(*API) + """
, u AS (SELECT username, coalesce(gender, 'none') AS gender FROM api_users),
keep AS (SELECT * FROM u WHERE gender <> 'male' OR username LIKE '%1')
SELECT * FROM (VALUES ('probe', 'before', 'false'), ('probe', 'after', 'true'), ('probe', 'dropped', 'false'),
  ('listed', 'bronze', 'false'), ('listed', 'users', 'false'), ('left', 'bronze', ''), ('described', 'username', 'string'),
  ('described', 'email', 'string'), ('described', 'gender', 'string partition')) AS t(step, what, value)
UNION ALL SELECT 'written', gender, CAST(count(*) AS VARCHAR) FROM u GROUP BY gender
UNION ALL SELECT 'partition replaced', gender, CAST(count(*) AS VARCHAR) FROM keep GROUP BY gender
UNION ALL SELECT 'replaced', gender, CAST(count(*) AS VARCHAR) FROM keep WHERE username LIKE '%1' GROUP BY gender""",
}
