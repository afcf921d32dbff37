"""Plan-shape checks: pushed filters, pruned scans, partial top-1 before the
shuffle, partial aggregation, no Python UDF anywhere."""

from helpers import SF_SMALL

from strata.plans import gold, silver
from strata.plans.queries import CDC_LONG, REGISTRY, bronze_api, bronze_cdc, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_filter_is_pushed(spark):
    from strata.operators.incremental import incremental_slice

    ev = table(spark, SF_SMALL, "events")
    p = plan(incremental_slice(ev, "ts", "2024-01-20 00:00:00").select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_latest_per_key_limits_before_shuffle(spark):
    p = plan(silver.api_users(bronze_api(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_rollup_aggregates_partially(spark):
    api = silver.api_users(bronze_api(spark, SF_SMALL))
    cdc = silver.cdc_users(bronze_cdc(spark, SF_SMALL), "ignore", CDC_LONG)
    p = plan(gold.user_stats(gold.users_enriched(api, cdc)))
    assert "partial_count" in p


def test_no_python_udf_in_any_query(spark):
    skip = {"compaction_roundtrip", "compaction_files", "expire_keep_last", "file_inspection",
            "describe_table"}
    for name, q in REGISTRY.items():
        if name in skip:
            continue
        p = plan(q(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_delay_quantiles_merge_sketches_map_side(spark):
    from strata.plans import reports

    p = plan(reports.ingest_delay_quantiles(bronze_api(spark, SF_SMALL), "day"))
    assert "partial_percentile_approx" in p


def test_no_python_udf_in_state_queries(spark):
    from strata.plans.queries_state import REGISTRY as STATE

    cheap = ["incremental_slice", "slice_after_target", "upsert_merge", "upsert_guarded", "upsert_plain_cdc",
             "upsert_partial", "insert_if_absent", "schema_sync", "cdc_from_snapshots", "snapshot_fold",
             "message_dedup", "duplicate_messages", "quarantine_api", "quarantine_cdc", "source_constraints",
             "sql_views_match_rate", "sql_events_per_minute", "user_stats_sorted", "late_field_reparse"]
    for name in cheap:
        p = plan(STATE[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
