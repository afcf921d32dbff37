"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The feed derivation is restated from the source columns (see the fixed
values in ``strata.sources.feeds``), so each oracle checks the JSON
build-and-parse round trip against plain values, not against itself.
"""

from __future__ import annotations

API_SRC = """
api_src AS (
  SELECT event_id, user_id, event_type, value, ts,
         json_extract_string(props, '$.k') AS k,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS ingested_at,
         date_trunc('millisecond', ts) AS kafka_ts,
         CAST(user_id % 4 AS INTEGER) AS kafka_partition,
         event_id AS kafka_offset,
         CAST(1950 + user_id % 50 AS VARCHAR) || '-' || lpad(CAST(event_id % 12 + 1 AS VARCHAR), 2, '0')
           || '-' || lpad(CAST(event_id % 28 + 1 AS VARCHAR), 2, '0') AS dob_date
  FROM events)"""

API_CLEAN = """
api_clean AS (
  SELECT kafka_offset, kafka_partition, ingested_at,
    upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS first_name,
    'U' || CAST(user_id AS VARCHAR) AS last_name,
    upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' U' || CAST(user_id AS VARCHAR) AS full_name,
    CASE WHEN value < 200 THEN 'male' WHEN value < 400 THEN 'female' END AS gender,
    'user' || CAST(user_id AS VARCHAR)
      || (CASE WHEN user_id % 7 = 0 THEN '@other.org' ELSE '@example.com' END) AS email,
    'user' || CAST(user_id AS VARCHAR) AS username,
    CASE WHEN event_type <> 'signup' THEN CAST(1950 + user_id % 50 AS INTEGER) END AS birth_year,
    CASE WHEN event_type <> 'view'
         THEN '+84 ' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 1000 AS VARCHAR) END AS phone,
    CASE WHEN event_id % 2 = 0 THEN CAST(CAST(k AS INTEGER) AS VARCHAR) ELSE lpad(k, 5, '0') END AS postcode,
    CASE WHEN event_id % 2 = 0 THEN 'VN' END AS nat
  FROM api_src
  WHERE value < 480 AND event_type <> 'error')"""

API_USERS = """
api_users AS (
  SELECT first_name, last_name, full_name, gender, email, username, birth_year, phone, postcode, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY username
                                     ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS rn
        FROM api_clean)
  WHERE rn = 1)"""

CDC_SRC = """
cdc_src AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'r' WHEN '2-HIGH' THEN 'c' WHEN '5-LOW' THEN 'd' ELSE 'u' END AS op,
    CAST(o_custkey % 4 AS INTEGER) AS kafka_partition,
    o_orderkey AS kafka_offset,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey) AS ingested_at
  FROM orders)"""

CDC_CLEAN = """
cdc_clean AS (
  SELECT kafka_offset, kafka_partition, ingested_at, CAST(o_custkey AS BIGINT) AS id,
    'Customer ' || CAST(o_custkey AS VARCHAR) AS name,
    'user' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email,
    CASE o_orderstatus WHEN 'F' THEN 'Finance' WHEN 'O' THEN 'Ops' END AS department,
    op, o_orderdate AS source_ts
  FROM cdc_src
  WHERE o_totalprice >= 3000 AND o_totalprice <= 497000 AND op IN ('c', 'u', 'r')
    AND NOT (op = 'c' AND o_orderstatus = 'P'))"""

CDC_USERS = """
cdc_users AS (
  SELECT id, name, email, department, op, source_ts, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY id
                                     ORDER BY source_ts DESC, kafka_partition DESC, kafka_offset DESC) AS rn
        FROM cdc_clean)
  WHERE rn = 1)"""

CDC_APPLY = """
cdc_apply_events AS (
  SELECT kafka_offset, kafka_partition, ingested_at, CAST(o_custkey AS BIGINT) AS id,
    CASE WHEN op <> 'd' THEN 'Customer ' || CAST(o_custkey AS VARCHAR) END AS name,
    CASE WHEN op <> 'd' THEN 'user' || CAST(o_custkey AS VARCHAR) || '@example.com' END AS email,
    CASE WHEN op <> 'd' THEN (CASE o_orderstatus WHEN 'F' THEN 'Finance' WHEN 'O' THEN 'Ops' END) END
      AS department,
    op, o_orderdate AS source_ts
  FROM cdc_src
  WHERE o_totalprice >= 3000
    AND (op = 'd' OR (o_totalprice <= 497000 AND op IN ('c', 'u', 'r')
                      AND NOT (op = 'c' AND o_orderstatus = 'P')))),
cdc_users_apply AS (
  SELECT id, name, email, department, op, source_ts, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY id
                                     ORDER BY source_ts DESC, kafka_partition DESC, kafka_offset DESC) AS rn
        FROM cdc_apply_events)
  WHERE rn = 1 AND op <> 'd')"""

ENRICHED = """
enriched AS (
  SELECT a.username, a.full_name, a.gender, a.email, a.birth_year, a.phone, a.postcode,
         c.id AS db_id, c.department, c.source_ts AS last_db_update, a.ingested_at AS api_ingested_at
  FROM api_users a LEFT JOIN cdc_users c ON lower(a.email) = lower(c.email))"""

STATS = """
stats AS (
  SELECT coalesce(gender, 'unknown') AS gender, coalesce(department, 'unknown') AS department, birth_year,
         count(*) AS total_users, count(DISTINCT email) AS unique_emails, count(db_id) AS matched_db_users,
         min(api_ingested_at) AS first_seen, max(api_ingested_at) AS last_seen
  FROM enriched
  GROUP BY 1, 2, 3)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


API = (API_SRC, API_CLEAN, API_USERS)
CDC = (CDC_SRC, CDC_CLEAN, CDC_USERS)
GOLD = (*API, *CDC, ENRICHED)

SQL: dict[str, str] = {
    "bronze_api_fields": with_(API_SRC) + """
SELECT 'users_created' AS kafka_topic, kafka_partition, kafka_offset, kafka_ts, ingested_at,
  CASE WHEN value >= 480 THEN NULL
       WHEN event_type <> 'error' THEN 'User' || CAST(user_id AS VARCHAR)
         || (CASE WHEN user_id % 7 = 0 THEN '@Other.ORG' ELSE '@Example.COM' END) END AS email,
  CASE WHEN value >= 480 THEN NULL
       ELSE (CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END) || 'User' || CAST(user_id AS VARCHAR) END
    AS username,
  CASE WHEN value >= 480 THEN NULL WHEN value < 200 THEN 'Male' WHEN value < 400 THEN ' FEMALE ' END
    AS gender
FROM api_src""",
    "kafka_envelope": with_(API_SRC) + """
SELECT kafka_partition, kafka_offset, kafka_ts,
  CASE WHEN value >= 480 THEN NULL
       WHEN event_type <> 'error' THEN 'User' || CAST(user_id AS VARCHAR)
         || (CASE WHEN user_id % 7 = 0 THEN '@Other.ORG' ELSE '@Example.COM' END) END AS email,
  CASE WHEN value >= 480 THEN NULL
       ELSE (CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END) || 'User' || CAST(user_id AS VARCHAR) END
    AS username,
  CASE WHEN value >= 480 THEN NULL WHEN value < 200 THEN 'Male' WHEN value < 400 THEN ' FEMALE ' END
    AS gender
FROM api_src""",
    "silver_api_users_sqlmodel": with_(*API) + "SELECT * FROM api_users",
    "any_rows": with_(*API) + """
SELECT least(5, count(*)) AS n_rows, least(5, count(*)) AS in_table FROM api_users""",
    "api_accounted": with_(API_SRC, API_CLEAN) + """
SELECT (SELECT count(*) FROM api_src) AS bronze, (SELECT count(*) FROM api_clean) AS kept,
  (SELECT count(*) FROM api_src) - (SELECT count(*) FROM api_clean) AS rejected, true AS complete""",
    "cdc_accounted": with_(CDC_SRC, CDC_CLEAN) + """
SELECT (SELECT count(*) FROM cdc_src) AS bronze, (SELECT count(*) FROM cdc_clean) AS kept,
  (SELECT count(*) FROM cdc_src) - (SELECT count(*) FROM cdc_clean) AS rejected, true AS complete""",
    "cdc_accounted_apply": with_(CDC_SRC, CDC_APPLY) + """
SELECT (SELECT count(*) FROM cdc_src) AS bronze, (SELECT count(*) FROM cdc_apply_events) AS kept,
  (SELECT count(*) FROM cdc_src) - (SELECT count(*) FROM cdc_apply_events) AS rejected, true AS complete""",
    "json_first_paths": with_(API_SRC) + """
SELECT kafka_offset,
  CASE WHEN value < 480 THEN (CASE WHEN event_id % 5 = 0 THEN ' ' ELSE '' END)
       || upper(substr(event_type, 1, 1)) || substr(event_type, 2) END AS first_name,
  CASE WHEN value < 480 THEN 'U' || CAST(user_id AS VARCHAR) END AS last_name,
  CASE WHEN value >= 480 THEN NULL
       WHEN event_id % 2 = 0 THEN CAST(CAST(k AS INTEGER) AS VARCHAR) ELSE lpad(k, 5, '0') END AS postcode,
  CASE WHEN value < 480 THEN (CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END)
       || 'User' || CAST(user_id AS VARCHAR) END AS username,
  CASE WHEN value >= 480 THEN NULL
       WHEN event_id % 2 = 0 AND event_type = 'signup'
         THEN '{"age":' || CAST(2024 - (1950 + user_id % 50) AS VARCHAR) || '}'
       WHEN event_id % 2 = 0 THEN dob_date || 'T00:00:00.000Z'
       WHEN event_type = 'signup' THEN 'n/a'
       ELSE dob_date END AS dob,
  CASE WHEN value < 480 AND event_type <> 'view'
       THEN ' +84 ' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 1000 AS VARCHAR) || ' ' END AS phone
FROM api_src""",
    "clean_strings": with_(API_SRC, API_CLEAN) + """
SELECT kafka_offset, first_name, last_name, full_name, gender, email, username, birth_year, phone, postcode
FROM api_clean""",
    "silver_api_users": with_(*API) + "SELECT * FROM api_users",
    "cdc_parse_filter": with_(CDC_SRC, CDC_CLEAN) + """
SELECT kafka_offset, id, name, email, department, op, source_ts, ingested_at FROM cdc_clean""",
    "silver_cdc_users": with_(*CDC) + "SELECT * FROM cdc_users",
    "silver_cdc_users_apply": with_(CDC_SRC, CDC_APPLY) + "SELECT * FROM cdc_users_apply",
    "latest_event_per_user": """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    "latest_order_per_customer": """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
WHERE rn = 1""",
    "gold_users_enriched": with_(*GOLD) + "SELECT * FROM enriched",
    "gold_users_enriched_latest": with_(*API, *CDC) + """
SELECT a.username, a.full_name, a.gender, a.email, a.birth_year, a.phone, a.postcode,
       c.id AS db_id, c.department, c.source_ts AS last_db_update, a.ingested_at AS api_ingested_at
FROM api_users a LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(email)
                                              ORDER BY source_ts DESC NULLS LAST, id DESC NULLS LAST) AS rn_e
                 FROM cdc_users WHERE email IS NOT NULL)
  WHERE rn_e = 1) c
ON lower(a.email) = lower(c.email)""",
    "gold_user_stats": with_(*GOLD, STATS) + "SELECT * FROM stats",
    "gold_user_stats_sqlmodel": with_(*GOLD) + """
SELECT coalesce(g, 'unknown') AS gender, coalesce(d, 'unknown') AS department, birth_year,
       count(*) AS total_users, count(DISTINCT email) AS unique_emails,
       count(DISTINCT db_id) AS matched_db_users,
       min(api_ingested_at) AS first_seen, max(api_ingested_at) AS last_seen
FROM (SELECT gender AS g, department AS d, birth_year, email, db_id, api_ingested_at FROM enriched)
GROUP BY g, d, birth_year""",
    "unmatched_users": with_(*API, *CDC) + """
SELECT username, email, full_name, ingested_at FROM api_users a
WHERE NOT EXISTS (SELECT 1 FROM cdc_users c WHERE lower(a.email) = lower(c.email))""",
    "matched_users": with_(*GOLD) + """
SELECT username, email, department, last_db_update FROM enriched WHERE db_id IS NOT NULL""",
    "has_db_record": with_(*GOLD) + """
SELECT username, email, department, db_id IS NOT NULL AS has_db_record FROM enriched""",
    "op_frequency": with_(CDC_SRC) + """
SELECT op, count(*) AS events
FROM (SELECT CASE WHEN o_totalprice < 3000 THEN NULL ELSE op END AS op FROM cdc_src)
GROUP BY op""",
    "events_per_minute": """
SELECT date_trunc('minute', date_trunc('millisecond', ts)) AS minute, count(*) AS events
FROM events GROUP BY 1""",
    "gender_spread": with_(*API) + """
SELECT gender, count(*) AS total, min(birth_year) AS oldest_birth_year, max(birth_year) AS newest_birth_year
FROM api_users GROUP BY gender""",
    "department_totals": with_(*GOLD, STATS) + """
SELECT department, CAST(sum(total_users) AS BIGINT) AS users FROM stats GROUP BY department""",
    "department_match_pct": with_(*GOLD, STATS) + """
SELECT department, CAST(sum(total_users) AS BIGINT) AS users,
       CAST(sum(matched_db_users) AS BIGINT) AS matched,
       round(CAST(100.0 AS DOUBLE) * CAST(sum(matched_db_users) AS DOUBLE)
             / CAST(sum(total_users) AS DOUBLE), 1) AS match_pct
FROM stats GROUP BY department""",
    "match_rate": with_(*GOLD) + """
SELECT count(*) AS total, count(db_id) AS matched,
       round(CAST(100.0 AS DOUBLE) * CAST(count(db_id) AS DOUBLE) / CAST(count(*) AS DOUBLE), 1) AS match_pct
FROM enriched""",
    "duplicate_usernames": with_(API_SRC, API_CLEAN) + """
SELECT username, count(*) AS copies FROM api_clean GROUP BY username HAVING count(*) > 1""",
    "silver_key_violations": with_(*API) + """
SELECT username, count(*) AS copies FROM api_users GROUP BY username HAVING count(*) > 1""",
    "topk_recent": with_(*API) + """
SELECT username, email, gender, ingested_at FROM api_users ORDER BY ingested_at DESC, username ASC LIMIT 10""",
    "topk_by_name": with_(*API) + """
SELECT username, full_name, email FROM api_users ORDER BY full_name, username LIMIT 20""",
    "topk_by_id": with_(*CDC) + "SELECT * FROM cdc_users ORDER BY id LIMIT 20",
    "layer_counts": with_(*GOLD, STATS) + """
SELECT 'bronze_api' AS layer, CAST(count(*) AS BIGINT) AS records FROM events
UNION ALL SELECT 'bronze_cdc', count(*) FROM orders
UNION ALL SELECT 'silver_api', count(*) FROM api_users
UNION ALL SELECT 'silver_cdc', count(*) FROM cdc_users
UNION ALL SELECT 'gold_enriched', count(*) FROM enriched
UNION ALL SELECT 'gold_stats', count(*) FROM stats""",
    "bronze_vs_silver": with_(*API) + """
SELECT b.bronze, s.silver, b.bronze >= s.silver AS consistent
FROM (SELECT count(*) AS bronze FROM events) b, (SELECT count(*) AS silver FROM api_users) s""",
    "partition_progress": with_(API_SRC, CDC_SRC) + """
SELECT 'users_created' AS kafka_topic, kafka_partition, count(*) AS messages,
       min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset
FROM api_src GROUP BY kafka_partition
UNION ALL
SELECT 'postgres.public.users', kafka_partition, count(*), min(kafka_offset), max(kafka_offset)
FROM cdc_src GROUP BY kafka_partition""",
    "ingest_delay_quantiles": with_(API_SRC) + """
SELECT day, count(*) AS messages,
       quantile_disc(delay, 0.5) AS p50_delay_ms, quantile_disc(delay, 0.95) AS p95_delay_ms,
       quantile_disc(delay, 0.99) AS p99_delay_ms
FROM (SELECT date_trunc('day', ingested_at) AS day, epoch_ms(ingested_at) - epoch_ms(kafka_ts) AS delay
      FROM api_src)
GROUP BY day""",
    "ingest_delay": with_(API_SRC) + """
SELECT date_trunc('day', ingested_at) AS day, count(*) AS messages,
       min(epoch_ms(ingested_at) - epoch_ms(kafka_ts)) AS min_delay_ms,
       max(epoch_ms(ingested_at) - epoch_ms(kafka_ts)) AS max_delay_ms,
       CAST(sum(epoch_ms(ingested_at) - epoch_ms(kafka_ts)) AS BIGINT) AS sum_delay_ms
FROM api_src GROUP BY 1""",
    "recent_window": with_(API_SRC) + """
SELECT kafka_offset, ingested_at FROM api_src
WHERE ingested_at >= (SELECT max(ingested_at) FROM api_src) - INTERVAL 7 DAY""",
}
