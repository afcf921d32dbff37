"""The ordered run: quality gate before Gold, wide ids, parse edge cases."""

import pytest
from pyspark.sql import functions as F

from helpers import bronze_rows
from fixtures import FX1, FX2

from strata.operators.quality import QualityGateFailed
from strata.plans import silver
from strata.plans.queries import CDC_LONG
from strata.plans.refresh import Layout, refresh_all


def land(spark, layout, api=FX1, cdc=FX2):
    for name, topic, rows in (("api_users_raw", "users_created", api), ("cdc_users_raw", "postgres.public.users", cdc)):
        layout.table(spark, f"bronze/{name}").append(bronze_rows(spark, topic, [p for p, _ in rows], [t for _, t in rows]))


def test_gate_stops_before_gold(spark, tmp_path):
    layout = Layout(str(tmp_path / "gate"), buckets=2)
    land(spark, layout)
    three = spark.range(3)
    with pytest.raises(QualityGateFailed) as e:
        refresh_all(spark, layout, checks=lambda *_: {"none": three.limit(0), "some": three})
    assert e.value.gate.failures == {"some": 3}  # true counts
    assert not layout.table(spark, "gold/users_enriched").exists()
    assert refresh_all(spark, layout)["user_stats"] is not None


def test_wide_ids_pass_the_whole_refresh(spark, tmp_path):
    layout = Layout(str(tmp_path / "wide"), buckets=2, cdc_schema=CDC_LONG)
    wide = ('{"after":{"id":3000000000,"name":"Wide","email":"w@mail.test"},"op":"c","ts_ms":1767225600000}', 1)
    land(spark, layout, cdc=[wide])
    refresh_all(spark, layout)
    assert [r["id"] for r in layout.table(spark, "silver/cdc_users").read().collect()] == [3000000000]


def test_every_message_is_kept_or_rejected(spark):
    """What path extraction reads is kept, whatever a stricter JSON parser says."""
    odd = ['{"username":"a","username":"b","email":"x@mail.test"}', "{'username':'q','email':'q@mail.test'}",
           '{"username":"line\nbreak","email":"l@mail.test"}', '{"username":1.0,"email":"n@mail.test"}',
           '{"username":"t","email":"t@mail.test"} trailing', "[1]", "", None, "{"]
    b = bronze_rows(spark, "users_created", odd, [1] * len(odd))
    kept = silver.clean_api(silver.parse_api(b))
    want = {i for i, r in enumerate(b.orderBy("kafka_offset").select(
        F.get_json_object("payload", "$.username").alias("u"), F.get_json_object("payload", "$.email").alias("e")).collect())
        if r["u"] is not None and r["e"] is not None}
    assert {r["kafka_offset"] for r in kept.collect()} == want and len(want) >= 4
    assert {r["kafka_offset"] for r in silver.api_rejects(b).collect()} == set(range(len(odd))) - want
    assert {r["username"] for r in kept.collect()} >= {"1.0", "line\nbreak"}


def test_applied_deletes_are_no_rejects(spark):
    b = bronze_rows(spark, "t", [p for p, _ in FX2], [t for _, t in FX2])
    apply = {r["kafka_offset"]: r["reason"] for r in silver.cdc_rejects(b, deletes="apply").collect()}
    assert apply == {5: "no_envelope", 6: "no_envelope", 7: "missing_id", 8: "missing_name"}
    no_key = bronze_rows(spark, "t", ['{"before":null,"after":null,"op":"d","ts_ms":1}'], [1])
    assert [r["reason"] for r in silver.cdc_rejects(no_key, deletes="apply").collect()] == ["delete_without_id"]


def test_null_propagating_names(spark):
    b = bronze_rows(spark, "users_created", [p for p, _ in FX1], [t for _, t in FX1])
    got = {r["username"]: r["full_name"] for r in silver.api_users(b, null_names=True).collect()}
    assert got["mono"] is None and got["teo.b"] == "Teodor Brandt"


def test_gate_checks_what_silver_has_rewritten(spark, tmp_path):
    from strata.plans.refresh import _passed, silver_checks

    layout = Layout.sized(str(tmp_path / "gate"), 5000, 1000)
    assert layout.buckets == 5
    land(spark, layout)
    refresh_all(spark, layout)
    seen = _passed(layout, spark)
    api_t = layout.table(spark, "silver/api_users", ["username"])
    assert seen["api"] == api_t.latest().version
    p = silver_checks(spark, layout)["silver_api_unique_username"]
    assert p.count() == 0
    # a repeated key that slips into one bucket is found, and found again until it is gone
    row = api_t.read().limit(1)
    mark = api_t.latest().mark
    api_t.merge(row, ["username"], combine=lambda t, u: t.unionByName(u), mark=mark)
    for _ in range(2):
        with pytest.raises(QualityGateFailed) as e:
            refresh_all(spark, layout)
        assert e.value.gate.failures == {"silver_api_unique_username": 1} and _passed(layout, spark) == seen
    api_t.merge(row, ["username"], combine=lambda t, u: t.distinct(), mark=mark)
    refresh_all(spark, layout)
    assert _passed(layout, spark)["api"] == api_t.latest().version


def test_catalog_settings_reach_the_session(spark):
    from strata.session import get_session

    s = get_session("strata-tests", catalog={"name": "lake_t", "impl": "org.example.Catalog", "type": "rest", "uri": "http://host/x"})
    assert s.conf.get("spark.sql.catalog.lake_t") == "org.example.Catalog"
    assert s.conf.get("spark.sql.catalog.lake_t.type") == "rest" and s.conf.get("spark.sql.catalog.lake_t.uri") == "http://host/x"
    for k in ("", ".type", ".uri"):
        s.conf.unset(f"spark.sql.catalog.lake_t{k}")
