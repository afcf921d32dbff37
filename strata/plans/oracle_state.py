"""DuckDB oracle SQL for the state / storage / streaming / quality queries."""

from __future__ import annotations

from strata.plans.oracle import (
    API,
    API_CLEAN,
    API_SRC,
    CDC,
    CDC_CLEAN,
    CDC_SRC,
    ENRICHED,
    GOLD,
    SQL as BASE,
    STATS,
    with_,
)


def mark(name: str, src: str, share: int) -> str:
    """Time point at share/10 of the landing span of ``src`` (whole seconds)."""
    return f"""
{name} AS (
  SELECT lo + to_seconds(CAST(floor(date_diff('second', lo, hi) * {share} / 10) AS BIGINT)) AS m
  FROM (SELECT min(ingested_at) AS lo, max(ingested_at) AS hi FROM {src}))"""


def latest(name: str, src: str, key: str, order: str, cols: str, where: str) -> str:
    return f"""
{name} AS (
  SELECT {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src} WHERE {where})
  WHERE rn = 1)"""


API_COLS = "first_name, last_name, full_name, gender, email, username, birth_year, phone, postcode, ingested_at"
CDC_COLS = "id, name, email, department, op, source_ts, ingested_at"
API_ORD = "ingested_at DESC, kafka_partition DESC, kafka_offset DESC"
CDC_ORD = "source_ts DESC, kafka_partition DESC, kafka_offset DESC"

API_M6 = mark("m6", "api_src", 6)
CDC_M6 = mark("m6", "cdc_src", 6)
API_EARLY = latest("early", "api_clean", "username", API_ORD, API_COLS,
                   "ingested_at <= (SELECT m FROM m6)")
API_LATE = latest("late", "api_clean", "username", API_ORD, API_COLS,
                  "ingested_at > (SELECT m FROM m6)")
CDC_EARLY = latest("early", "cdc_clean", "id", CDC_ORD, CDC_COLS, "ingested_at <= (SELECT m FROM m6)")
CDC_LATE = latest("late", "cdc_clean", "id", CDC_ORD, CDC_COLS, "ingested_at > (SELECT m FROM m6)")

BRONZE_FIELDS = "'users_created' AS kafka_topic, kafka_partition, kafka_offset, kafka_ts, ingested_at"

GENDER_SPREAD = BASE["gender_spread"]
TOPK_BY_NAME = BASE["topk_by_name"]

SQL: dict[str, str] = {
    "high_water_mark": with_(*API) + "SELECT max(ingested_at) AS max_ts FROM api_users",
    "incremental_slice": with_(API_SRC, API_M6) + """
SELECT kafka_offset, ingested_at FROM api_src WHERE ingested_at > (SELECT m FROM m6)""",
    "slice_after_target": with_(API_SRC, API_CLEAN, API_M6) + """
SELECT kafka_offset, ingested_at FROM api_src
WHERE ingested_at > (SELECT coalesce(max(ingested_at), TIMESTAMP '1970-01-01 00:00:00')
                     FROM api_clean WHERE ingested_at <= (SELECT m FROM m6))""",
    "upsert_merge": with_(API_SRC, API_CLEAN, API_M6, API_EARLY, API_LATE) + """
SELECT * FROM late UNION ALL SELECT * FROM early WHERE username NOT IN (SELECT username FROM late)""",
    "upsert_guarded": with_(*CDC) + "SELECT * FROM cdc_users",
    "upsert_plain_cdc": with_(CDC_SRC, CDC_CLEAN, CDC_M6, CDC_EARLY, CDC_LATE) + """
SELECT * FROM late UNION ALL SELECT * FROM early WHERE id NOT IN (SELECT id FROM late)""",
    "upsert_partial": with_(CDC_SRC, CDC_CLEAN, CDC_M6, CDC_EARLY, CDC_LATE) + """
SELECT CASE WHEN t.email IS NOT NULL THEN t.id ELSE u.id END AS id,
       CASE WHEN u.email IS NOT NULL THEN u.name ELSE t.name END AS name,
       coalesce(t.email, u.email) AS email,
       CASE WHEN u.email IS NOT NULL THEN u.department ELSE t.department END AS department
FROM early t FULL JOIN late u ON t.email = u.email""",
    "insert_if_absent": with_(
        CDC_SRC, CDC_CLEAN, CDC_M6, CDC_EARLY,
        latest("late_first", "cdc_clean", "id", "source_ts ASC, kafka_partition ASC, kafka_offset ASC",
               CDC_COLS, "ingested_at > (SELECT m FROM m6)"),
    ) + """
SELECT * FROM early UNION ALL SELECT * FROM late_first WHERE id NOT IN (SELECT id FROM early)""",
    "schema_sync": with_(API_SRC, API_CLEAN, API_M6, API_EARLY, API_LATE) + """
SELECT * FROM late
UNION ALL
SELECT first_name, last_name, full_name, gender, email, username, birth_year, CAST(NULL AS VARCHAR) AS phone,
       postcode, ingested_at
FROM early WHERE username NOT IN (SELECT username FROM late)""",
    "incremental_refresh": with_(*CDC) + "SELECT * FROM cdc_users",
    "layered_refresh": with_(*GOLD, STATS) + "SELECT * FROM stats",
    "as_of_version": with_(API_SRC, mark("m7", "api_src", 7)) + """
SELECT kafka_offset, ingested_at FROM api_src WHERE ingested_at <= (SELECT m FROM m7)""",
    "as_of_timestamp": with_(API_SRC, mark("m3", "api_src", 3)) + """
SELECT kafka_offset, ingested_at FROM api_src WHERE ingested_at <= (SELECT m FROM m3)""",
    "snapshot_history": with_(API_SRC, mark("m3", "api_src", 3), mark("m7", "api_src", 7)) + """
SELECT CAST(0 AS BIGINT) AS version, 'append' AS operation, count(*) AS records
FROM api_src WHERE ingested_at <= (SELECT m FROM m3)
UNION ALL
SELECT 1, 'append', count(*) FROM api_src
WHERE ingested_at > (SELECT m FROM m3) AND ingested_at <= (SELECT m FROM m7)
UNION ALL
SELECT 2, 'append', count(*) FROM api_src WHERE ingested_at > (SELECT m FROM m7)""",
    "compaction_roundtrip": with_(API_SRC) + f"SELECT {BRONZE_FIELDS} FROM api_src",
    "expire_keep_last": with_(API_SRC, mark("m6", "api_src", 6), mark("m8", "api_src", 8)) + """
SELECT CAST(3 AS BIGINT) AS version, count(*) AS records FROM api_src
WHERE ingested_at > (SELECT m FROM m6) AND ingested_at <= (SELECT m FROM m8)
UNION ALL
SELECT 4, count(*) FROM api_src WHERE ingested_at > (SELECT m FROM m8)""",
    "json_scan_stats": GENDER_SPREAD,
    "json_scan_topk": TOPK_BY_NAME,
    "cdc_from_snapshots": """
WITH b AS (SELECT c_custkey AS id, c_mktsegment AS department FROM customer WHERE c_nationkey < 15),
a AS (SELECT c_custkey AS id,
             CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment || '-2' ELSE c_mktsegment END AS department
      FROM customer WHERE c_nationkey >= 5)
SELECT coalesce(b.id, a.id) AS id,
       CASE WHEN b.id IS NULL THEN 'c' WHEN a.id IS NULL THEN 'd' ELSE 'u' END AS op,
       b.department AS before_department, a.department AS after_department
FROM b FULL JOIN a ON b.id = a.id
WHERE b.id IS NULL OR a.id IS NULL OR b.department IS DISTINCT FROM a.department""",
    "snapshot_fold": """
SELECT c_custkey AS id, trim(c_name) AS name,
       lower(trim('c' || CAST(c_custkey AS VARCHAR) || '@example.com')) AS email,
       trim(CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment || '-2' ELSE c_mktsegment END) AS department
FROM customer WHERE c_nationkey >= 5""",
    "stream_ingest": with_(API_SRC) + f"SELECT {BRONZE_FIELDS} FROM api_src",
    "stream_upsert": with_(*CDC) + "SELECT * FROM cdc_users",
    "stream_rate": BASE["events_per_minute"],
    "message_dedup": with_(API_SRC) + f"SELECT {BRONZE_FIELDS} FROM api_src",
    "maintenance_report": with_(*CDC) + """
SELECT 'bronze_api' AS table_name, 'compacted' AS status, CAST(7 AS BIGINT) AS expired_versions,
       (SELECT count(*) FROM events) AS records
UNION ALL SELECT 'silver_cdc', 'skipped', 0, (SELECT count(*) FROM cdc_users)
UNION ALL SELECT 'absent', 'missing', 0, NULL""",
    "incremental_gold_enriched": BASE["gold_users_enriched"],
    "incremental_gold_stats": BASE["gold_user_stats"],
    "stream_message_dedup": with_(API_SRC) + f"SELECT {BRONZE_FIELDS} FROM api_src",
    "duplicate_messages": with_(API_SRC, API_M6) + """
SELECT 'users_created' AS kafka_topic, kafka_partition, kafka_offset, CAST(2 AS BIGINT) AS copies
FROM api_src WHERE ingested_at > (SELECT m FROM m6)""",
    "quarantine_api": with_(API_SRC) + """
SELECT kafka_offset,
       CASE WHEN value >= 480 THEN 'unparseable' ELSE 'missing_email' END AS reason
FROM api_src WHERE value >= 480 OR event_type = 'error'""",
    "quarantine_cdc": with_(CDC_SRC) + """
SELECT kafka_offset, reason FROM (
  SELECT kafka_offset,
         CASE WHEN o_totalprice < 3000 THEN 'no_envelope'
              WHEN op = 'd' THEN 'delete_ignored'
              WHEN o_totalprice > 497000 THEN 'missing_id'
              WHEN op = 'c' AND o_orderstatus = 'P' THEN 'missing_name' END AS reason
  FROM cdc_src)
WHERE reason IS NOT NULL""",
    "source_constraints": with_(*CDC) + """
SELECT 'not_null:department' AS rule, CAST(id AS VARCHAR) AS row_key, CAST(1 AS BIGINT) AS occurrences
FROM cdc_users WHERE department IS NULL
UNION ALL
SELECT 'max_length:name<=12', CAST(id AS VARCHAR), 1 FROM cdc_users WHERE length(name) > 12
UNION ALL
SELECT 'unique:email', email, count(*) FROM cdc_users WHERE email IS NOT NULL
GROUP BY email HAVING count(*) > 1""",
    "idempotence": with_(*CDC) + """
SELECT 1 AS run, count(*) AS silver_rows, CAST(0 AS BIGINT) AS changed_rows FROM cdc_users
UNION ALL
SELECT 2, count(*), 0 FROM cdc_users""",
    "quality_gate": with_(*API, *CDC, ENRICHED) + """
SELECT check_name, violations, violations = 0 AS passed FROM (
  SELECT 'silver_api_unique_username' AS check_name,
         (SELECT count(*) FROM (SELECT username FROM api_users GROUP BY username HAVING count(*) > 1))
           AS violations
  UNION ALL
  SELECT 'silver_cdc_unique_id',
         (SELECT count(*) FROM (SELECT id FROM cdc_users GROUP BY id HAVING count(*) > 1))
  UNION ALL
  SELECT 'enrichment_no_fanout',
         CASE WHEN (SELECT count(*) FROM api_users) <> (SELECT count(*) FROM enriched) THEN 1 ELSE 0 END
  UNION ALL
  SELECT 'cdc_email_present', (SELECT count(*) FROM cdc_users WHERE email IS NULL)
  UNION ALL
  SELECT 'api_birth_year_known', (SELECT count(*) FROM api_users WHERE birth_year IS NULL))""",
    "sql_views_match_rate": BASE["match_rate"],
    "sql_events_per_minute": BASE["events_per_minute"],
    "user_stats_sorted": with_(*GOLD, STATS) + """
SELECT * FROM stats ORDER BY total_users DESC, gender, department, birth_year""",
    "cdc_users_sorted": with_(*CDC) + "SELECT * FROM cdc_users ORDER BY id",
    "full_refresh": with_(*CDC) + "SELECT * FROM cdc_users",
    "late_field_reparse": with_(API_SRC, API_CLEAN) + """
SELECT first_name, last_name, full_name, gender, email, username, birth_year, phone, postcode, ingested_at, nat
FROM (SELECT *, row_number() OVER (PARTITION BY username
                                   ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS rn
      FROM api_clean)
WHERE rn = 1""",
    "describe_table": """
SELECT * FROM (VALUES ('first_name', 'string'), ('last_name', 'string'), ('full_name', 'string'), ('gender', 'string'),
  ('email', 'string'), ('username', 'string'), ('birth_year', 'int'), ('phone', 'string'), ('postcode', 'string'),
  ('ingested_at', 'timestamp_ntz')) AS t(col_name, data_type)""",
}
