"""Hot keys: one key (or e-mail, or message) holding a third of all rows.

Results must stay whole and exact, and the plans must cut a hot group down
on the map side before it crosses the network.
"""

from pyspark.sql import functions as F

from strata.functions.time import add_interval
from strata.operators.dedup import duplicate_messages, latest_per_key, newest_first
from strata.operators.quality import fanout_check
from strata.plans import gold

N = 300  # a third of the rows share the hot key


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def api_users(spark):
    i = F.col("id")
    return spark.range(N).select(
        F.concat(F.lit("u"), i.cast("string")).alias("username"),
        F.lit("Full Name").alias("full_name"),
        F.lit("female").alias("gender"),
        F.when(i % 3 == 0, F.lit("hot@example.com"))
        .otherwise(F.concat(F.lit("u"), i.cast("string"), F.lit("@example.com"))).alias("email"),
        F.lit(1990).alias("birth_year"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("postcode"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )


def cdc_users(spark):
    i = F.col("id")
    return spark.range(N).select(
        i.alias("id"),
        F.lit("Name").alias("name"),
        F.when(i % 3 == 0, F.lit("HOT@Example.com"))
        .when(i % 3 == 1, F.concat(F.lit("u"), i.cast("string"), F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("dept"), i.cast("string")).alias("department"),
        F.lit("c").alias("op"),
        add_interval(F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"), "SECOND", i % 50).alias("source_ts"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )


def test_hot_email_fans_out_under_plain_join(spark):
    api, cdc = api_users(spark), cdc_users(spark)
    joined = gold.users_enriched(api, cdc)
    hot = N // 3
    # the reference's left join: every hot API user once per hot record
    assert joined.filter(F.lower("email") == "hot@example.com").count() == hot * hot
    assert fanout_check(api, joined).count() > 0


def test_hot_email_one_match_keeps_every_user_once(spark):
    api, cdc = api_users(spark), cdc_users(spark)
    joined = gold.users_enriched(api, cdc, match="latest")
    rows = joined.collect()
    assert len(rows) == N and len({r["username"] for r in rows}) == N
    assert fanout_check(api, joined).count() == 0
    # newest hot record: source second 49 is reached by ids 99, 249 (i % 3 == 0); the id breaks the tie
    hot = {r["db_id"] for r in rows if r["email"] == "hot@example.com"}
    assert hot == {249}
    # the e-mail-less records (i % 3 == 2) never match; every other user finds its own record
    matched = {r["username"]: r["db_id"] for r in rows if r["email"] != "hot@example.com"}
    assert all((db is not None) == (int(u[1:]) % 3 == 1) for u, db in matched.items())
    p = plan(joined)
    assert "WindowGroupLimit [_email_key" in p and "Partial" in p


def test_hot_key_latest_state_is_exact(spark):
    i = F.col("id")
    df = spark.range(3 * N).repartition(8).select(
        F.when(i % 3 == 0, F.lit(-1)).otherwise(i).alias("k"),
        i.alias("ts"),
    )
    out = {r["k"]: r["ts"] for r in latest_per_key(df, ["k"], newest_first("ts")).collect()}
    assert len(out) == 2 * N + 1
    assert out[-1] == 3 * N - 3
    assert "WindowGroupLimit" in plan(latest_per_key(df, ["k"], newest_first("ts")))


def test_hot_duplicate_message_counted_whole(spark):
    i = F.col("id")
    df = spark.range(3 * N).repartition(8).select(
        F.lit("t").alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.when(i % 3 == 0, F.lit(7)).otherwise(i + 1000).cast("long").alias("kafka_offset"),
    )
    dup = duplicate_messages(df).collect()
    assert [(r["kafka_offset"], r["copies"]) for r in dup] == [(7, N)]
    assert "partial_count" in plan(duplicate_messages(df))


def test_approx_distinct_emails_within_error(spark):
    i = F.col("id")
    e = spark.range(60000).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.lit("other")).alias("gender"),
        F.lit(None).cast("string").alias("department"), F.lit(1990).alias("birth_year"),
        F.concat(F.lit("e"), (i % 20000).cast("string")).alias("email"),
        F.lit(None).cast("long").alias("db_id"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("api_ingested_at"))
    exact = {r["gender"]: r["unique_emails"] for r in gold.user_stats(e).collect()}
    approx = {r["gender"]: r["unique_emails"] for r in gold.user_stats(e, approx_emails=0.02).collect()}
    assert set(exact) == set(approx)
    assert all(abs(approx[g] - exact[g]) <= 0.06 * exact[g] for g in exact)  # 3 sigma
    p = plan(gold.user_stats(e, approx_emails=0.02))
    assert "partial_approx_count_distinct" in p and p.count("Exchange") == 1  # no (group, e-mail) shuffle
