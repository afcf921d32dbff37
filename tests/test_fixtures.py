"""Golden scenarios FX1-FX5, FX7 from FIXTURES.md."""

from datetime import datetime

from helpers import bronze_rows, ts
from fixtures import FX1, FX2

from strata.plans import gold, reports, silver
from strata.sources.changes import initial_snapshot, snapshot_changes


def api_bronze(spark, rows=FX1):
    return bronze_rows(spark, "users_created", [p for p, _ in rows], [s for _, s in rows])


def cdc_bronze(spark, rows=FX2):
    return bronze_rows(spark, "postgres.public.users", [p for p, _ in rows], [s for _, s in rows])


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_fx1_api_users(spark):
    got = by_key(silver.api_users(api_bronze(spark)), "username")
    assert set(got) == {"agedob", "iokafor", "kofi", "mono", "teo.b"}
    assert got["teo.b"] == dict(first_name="Teodor", last_name="Brandt", full_name="Teodor Brandt", gender="male",
                                email="teo@mail.test", username="teo.b", birth_year=2001, phone="07-77",
                                postcode="9020", ingested_at=ts(1))
    assert got["iokafor"]["full_name"] == "Ines Silva"  # tie on time: higher offset wins
    assert got["iokafor"]["phone"] == "222"
    assert got["kofi"]["email"] == "kofi@mail.test" and got["kofi"]["birth_year"] == 1984
    assert got["agedob"]["full_name"] == "" and got["agedob"]["birth_year"] is None  # T4, T5
    assert got["mono"]["full_name"] == "Mono" and got["mono"]["birth_year"] is None  # T3
    assert got["mono"]["gender"] is None


def test_fx1_rejects(spark):
    rej = {r["kafka_offset"]: r["reason"] for r in silver.api_rejects(api_bronze(spark)).collect()}
    assert rej == {4: "missing_email", 5: "unparseable"}


def test_fx2_cdc_ignore(spark):
    got = by_key(silver.cdc_users(cdc_bronze(spark)), "id")
    assert set(got) == {11, 12, 14}
    assert got[12]["name"] == "Kofi Zed" and got[12]["email"] == "kofi@mail.test"
    assert got[12]["department"] == "Support"
    assert got[14]["department"] == "Research" and got[14]["op"] == "u"
    assert got[14]["source_ts"] == datetime(2026, 1, 1, 0, 0, 2, 500000)
    assert got[11]["source_ts"] == datetime(2026, 1, 1)


def test_fx2_cdc_apply(spark):
    got = by_key(silver.cdc_users(cdc_bronze(spark), deletes="apply"), "id")
    assert set(got) == {12, 14}


def test_fx2_op_frequency(spark):
    got = {r["op"]: r["events"] for r in reports.op_frequency(cdc_bronze(spark)).collect()}
    assert got == {"r": 2, "c": 3, "u": 2, "d": 1, None: 2}


def test_fx2_rejects(spark):
    rej = {r["kafka_offset"]: r["reason"] for r in silver.cdc_rejects(cdc_bronze(spark)).collect()}
    assert rej == {4: "delete_ignored", 5: "no_envelope", 6: "no_envelope", 7: "missing_id", 8: "missing_name"}


def test_fx4_gold(spark):
    api = silver.api_users(api_bronze(spark))
    cdc = silver.cdc_users(cdc_bronze(spark))
    enriched = gold.users_enriched(api, cdc)
    e = by_key(enriched, "username")
    assert len(e) == 5
    assert (e["kofi"]["db_id"], e["kofi"]["department"]) == (12, "Support")
    assert (e["iokafor"]["db_id"], e["iokafor"]["department"]) == (14, "Research")
    assert all(e[u]["db_id"] is None for u in ("teo.b", "agedob", "mono"))
    rate = reports.overall_match_rate(enriched).first()
    assert (rate["total"], rate["matched"], rate["match_pct"]) == (5, 2, 40.0)
    stats = {(r["gender"], r["department"], r["birth_year"]): r.asDict()
             for r in gold.user_stats(enriched).collect()}
    assert set(stats) == {("male", "unknown", 2001), ("male", "Support", 1984),
                          ("female", "Research", 1979), ("unknown", "unknown", None)}
    u = stats[("unknown", "unknown", None)]
    assert (u["total_users"], u["unique_emails"], u["matched_db_users"]) == (2, 2, 0)
    assert (u["first_seen"], u["last_seen"]) == (ts(3), ts(4))
    raw = gold.user_stats(enriched, distinct_matches=True, raw_groups=True)
    assert raw.filter("gender = 'unknown' AND birth_year IS NULL").count() == 2  # T7 split


def test_fx5_walkthrough(spark):
    users = [("walker0", "male", 1971)] + [(f"walker{i}", "female", 1960 + i) for i in range(1, 6)]
    payloads = [
        f'{{"first_name":"F{u}","last_name":"L","gender":"{g}","email":"{u}@mail.test",'
        f'"username":"{u}","dob":"{y}-01-01"}}' for u, g, y in users
    ]
    api = silver.api_users(bronze_rows(spark, "users_created", payloads, [1] * 6))
    seeds = [
        '{"after":{"id":1,"name":"First Row","email":"row1@mail.test","department":"Ops"},"op":"r","ts_ms":1}',
        '{"after":{"id":2,"name":"Second Row","email":"row2@mail.test","department":"Lab"},"op":"r","ts_ms":1}',
        '{"after":{"id":3,"name":"Third Row","email":"row3@mail.test","department":"Desk"},"op":"r","ts_ms":1}',
    ]
    cdc = silver.cdc_users(bronze_rows(spark, "postgres.public.users", seeds, [1, 1, 1]))
    enriched = gold.users_enriched(api, cdc)
    assert api.count() == 6 and enriched.count() == 6
    assert gold.user_stats(enriched).count() == 6  # not 3 as the walkthrough text says


def test_fx7_snapshot_changes(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id long, v string")
    ch = {r["id"]: r for r in snapshot_changes(before, after, "id", 2000).collect()}
    assert {k: r["op"] for k, r in ch.items()} == {2: "u", 3: "d", 4: "c"}
    assert ch[2]["before"]["v"] == "b" and ch[2]["after"]["v"] == "B"
    assert ch[3]["after"] is None
    first = initial_snapshot(before, "id", 1000).collect()
    assert sorted((r["id"], r["op"]) for r in first) == [(1, "r"), (2, "r"), (3, "r")]
