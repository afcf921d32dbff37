"""State comparison by fingerprints, the split enrichment join, mergeable sketches."""

import random

from pyspark.sql import functions as F

from strata.operators.quality import fingerprint_diff, state_changes, state_diff
from strata.operators.sketches import SketchTable, delay_sketches, figures, merged
from strata.operators.skew import KEY, hot_keys, split_left_join
from strata.plans import gold


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_fingerprints_find_every_change(spark):
    rng = random.Random(1)
    schema = "id long, a string, b string, x double"
    base = [(i, rng.choice(["p", None]), rng.choice(["q", None]), rng.choice([0.0, 1.5, float("nan"), None])) for i in range(300)]
    base += base[:40]  # repeated rows
    one = spark.createDataFrame(base, schema)
    shuffled = spark.createDataFrame(rng.sample(base, len(base)), schema).repartition(5)
    assert fingerprint_diff(one, shuffled, 32).count() == 0 and state_changes(one, shuffled).count() == 0
    assert state_changes(one, shuffled).columns == [*one.columns, "side"]
    for changed in (base[1:], base + base[:1], [(0, "new", None, None), *base[1:]],
                    [(i, b, a, x) for i, a, b, x in base], []):  # one fewer, one more, one other, swapped columns with nulls, none
        other = spark.createDataFrame(changed, schema)
        for keys in (None, ["id"]):
            assert rows(state_changes(one, other, 32, keys)) == rows(state_diff(one, other))
    nulls = spark.createDataFrame([(1, "a", None, None)], schema), spark.createDataFrame([(1, None, "a", None)], schema)
    assert rows(state_changes(*nulls)) == rows(state_diff(*nulls)) and fingerprint_diff(*nulls, keys=["id"]).count() == 1


def test_equal_states_shuffle_only_fingerprints(spark):
    one = spark.range(1000).withColumn("v", F.col("id") * 2)
    p = fingerprint_diff(one, one)._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning(bucket") == 1 and "partial_bit_xor" in p


def test_split_join_equals_the_plain_join(spark):
    left = spark.createDataFrame([(i, ["hot", "HOT", "warm", f"k{i}", None][i % 5]) for i in range(60)], "l long, k string")
    right = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(i, "warm") for i in range(20)]
                                  + [(1, None), (2, "hot"), (2, "hot")], "r long, rk string")
    plain = left.join(right, F.lower("k") == F.col("rk"), "left")
    for above in (1, 25, 1000):
        assert rows(split_left_join(left, right, F.lower("k"), F.col("rk"), above)) == rows(plain)
    hot = {r[KEY]: r["_salts"] for r in hot_keys(right.withColumn(KEY, F.col("rk")), 25).collect()}
    assert hot == {"hot": 9}
    parts = right.filter("rk = 'hot'").groupBy(F.pmod(F.xxhash64("r", "rk"), F.lit(9))).count().collect()
    assert max(r["count"] for r in parts) < 2.2 * 202 / 9
    assert split_left_join(left, right.limit(0), F.lower("k"), F.col("rk"), 5).count() == 60


def test_enrichment_with_a_hot_record_email(spark):
    from test_skew import api_users, cdc_users

    api, cdc = api_users(spark), cdc_users(spark)
    assert rows(gold.users_enriched(api, cdc, split_above=10)) == rows(gold.users_enriched(api, cdc))


def test_sketches_add_up(spark, tmp_path):
    n = 40_000
    i = F.col("id")
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    feed = spark.range(n).select(
        F.timestamp_add("SECOND", (i % 7200).cast("int"), start).alias("ingested_at"), F.pmod(F.xxhash64(i, F.lit(1)), F.lit(10_000)).alias("delay"),
        F.concat(F.lit("u"), i % 3000).alias("who")).withColumn("kafka_ts", F.timestamp_add("MILLISECOND", (-F.col("delay")).cast("int"), F.col("ingested_at")))
    t = SketchTable(spark, str(tmp_path / "s"))
    for k in (0, 1, 2, 1):  # a batch that comes again replaces itself
        t.add(delay_sketches(feed.filter(F.col("delay") % 3 == k), F.col("who")), f"b{k}")
    got = figures(merged(t.read(), "day"), "day").collect()
    assert len(got) == 1 and got[0]["messages"] == n and abs(got[0]["senders"] / 3000 - 1) < 0.06
    exact = [r[0] for r in feed.select("delay").orderBy("delay").collect()]
    for q in (50, 95, 99):
        place = sum(x <= got[0][f"p{q}_delay_ms"] for x in exact) / n
        assert abs(place - q / 100) < 0.02
    hours = figures(merged(t.read(), "hour"), "hour").collect()
    first = sum(x % 7200 < 3600 for x in range(n))
    assert [r["messages"] for r in sorted(hours, key=lambda r: r["hour"])] == [first, n - first]
    assert merged(t.read().limit(0), "day").count() == 0
