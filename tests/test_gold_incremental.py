"""Incremental Gold: the second run re-joins only the users a Silver change
reaches, and ends equal to a full rebuild."""

from pyspark.sql import functions as F

from strata.plans import gold
from strata.plans.refresh import Layout, read_silver, refresh_gold_incremental


def api_rows(spark, n=40):
    i = F.col("id")
    return spark.range(n).select(
        F.lit("F").alias("first_name"), F.lit("L").alias("last_name"), F.lit("F L").alias("full_name"),
        F.when(i % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("gender"),
        F.concat(F.lit("u"), i.cast("string"), F.lit("@x.com")).alias("email"),
        F.concat(F.lit("u"), i.cast("string")).alias("username"),
        (F.lit(1980) + i % 5).cast("int").alias("birth_year"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("postcode"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )


def cdc_rows(spark, n=20):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("id"), F.lit("N").alias("name"),
        F.concat(F.lit("U"), i.cast("string"), F.lit("@X.com")).alias("email"),
        F.when(i % 2 == 0, F.lit("Ops")).otherwise(F.lit("Finance")).alias("department"),
        F.lit("c").alias("op"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("source_ts"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_gold_follows_the_change(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), buckets=8)
    api_t = layout.table(spark, "silver/api_users", ["username"])
    cdc_t = layout.table(spark, "silver/cdc_users", ["id"])
    api_t.overwrite(api_rows(spark))
    cdc_t.overwrite(cdc_rows(spark))
    refresh_gold_incremental(spark, layout)  # first run: full build
    # record 3 now carries u25's e-mail; user u30 changes gender
    cdc_t.merge(cdc_rows(spark).filter("id = 3").withColumn("email", F.lit("U25@x.COM")), ["id"])
    api_t.merge(api_rows(spark).filter("username = 'u30'").withColumn("gender", F.lit("x")), ["username"])
    out = refresh_gold_incremental(spark, layout)
    commit = out["users_enriched"]
    assert commit.operation == "refresh" and int(commit.summary["touched_buckets"]) <= 3
    api, cdc = read_silver(spark, layout)
    enriched_t = layout.table(spark, "gold/users_enriched_inc")
    assert rows(enriched_t.read()) == rows(gold.users_enriched(api, cdc))
    by_user = {r["username"]: r for r in enriched_t.read().collect()}
    assert by_user["u3"]["db_id"] is None and by_user["u25"]["db_id"] == 3 and by_user["u30"]["gender"] == "x"
    stats = layout.table(spark, "gold/user_stats_inc").read()
    assert rows(stats) == rows(gold.user_stats(gold.users_enriched(api, cdc)))
    # nothing new: neither Gold table is rewritten
    again = refresh_gold_incremental(spark, layout)
    assert again["users_enriched"].version == commit.version
    assert again["user_stats"].version == out["user_stats"].version


def test_incremental_gold_sees_applied_deletes(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), buckets=8)
    api_t = layout.table(spark, "silver/api_users", ["username"])
    cdc_t = layout.table(spark, "silver/cdc_users", ["id"])
    api_t.overwrite(api_rows(spark))
    cdc_t.overwrite(cdc_rows(spark).withColumn("is_deleted", F.lit(False)))
    refresh_gold_incremental(spark, layout)
    # record 5 is deleted: its tombstone keeps the key, with no e-mail
    tomb = cdc_rows(spark).filter("id = 5").withColumn("email", F.lit(None).cast("string")) \
        .withColumn("op", F.lit("d")).withColumn("is_deleted", F.lit(True))
    cdc_t.merge(tomb, ["id"])
    refresh_gold_incremental(spark, layout)
    api, cdc = read_silver(spark, layout)
    got = layout.table(spark, "gold/users_enriched_inc").read()
    assert rows(got) == rows(gold.users_enriched(api, cdc))
    assert {r["username"]: r["db_id"] for r in got.collect()}["u5"] is None


def test_one_record_change_rewrites_one_gold_bucket(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"), buckets=8)
    api_t = layout.table(spark, "silver/api_users", ["username"])
    cdc_t = layout.table(spark, "silver/cdc_users", ["id"])
    api_t.overwrite(api_rows(spark))
    cdc_t.overwrite(cdc_rows(spark))
    refresh_gold_incremental(spark, layout)
    # record 4 (held by u4) moves department; its Silver bucket holds other, unchanged records
    cdc_t.merge(cdc_rows(spark).filter("id = 4").withColumn("department", F.lit("Legal")), ["id"])
    out = refresh_gold_incremental(spark, layout)
    assert out["users_enriched"].summary["touched_buckets"] == "1"
    by_user = {r["username"]: r for r in layout.table(spark, "gold/users_enriched_inc").read().collect()}
    assert by_user["u4"]["department"] == "Legal" and len(by_user) == 40


def test_users_that_leave_silver_leave_gold(spark, tmp_path):
    layout = Layout(str(tmp_path / "left"), buckets=8)
    api_t = layout.table(spark, "silver/api_users", ["username"])
    cdc_t = layout.table(spark, "silver/cdc_users", ["id"])
    api_t.overwrite(api_rows(spark, 12))
    cdc_t.overwrite(cdc_rows(spark))
    refresh_gold_incremental(spark, layout)
    api_t.overwrite(api_rows(spark, 3))  # a rebuild without most of the users
    refresh_gold_incremental(spark, layout)
    api, cdc = read_silver(spark, layout)
    got = layout.table(spark, "gold/users_enriched_inc").read()
    assert rows(got) == rows(gold.users_enriched(api, cdc)) and got.count() == 3
