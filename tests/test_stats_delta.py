"""User statistics by deltas equal a rebuild after any change (I8)."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import gold
from strata.plans.refresh import Layout
from strata.plans.stats_delta import refresh_stats

SCHEMA = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("username", "full_name", "gender", "email")],
    T.StructField("birth_year", T.IntegerType()), T.StructField("phone", T.StringType()), T.StructField("postcode", T.StringType()),
    T.StructField("db_id", T.LongType()), T.StructField("department", T.StringType()),
    T.StructField("last_db_update", T.TimestampNTZType()), T.StructField("api_ingested_at", T.TimestampNTZType())])


def user(rng, i):
    from helpers import ts

    dept = rng.choice([None, "unknown", "Ops", "Ops", "Ops"])  # one group holds most users
    return (f"u{i}", None, rng.choice([None, "male"]), rng.choice([None, f"e{rng.randrange(12)}", f"E{i}"]),
            rng.choice([None, 1990]), None, None, rng.choice([None, i]), dept, None, rng.choice([None, ts(rng.randrange(50))]))


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def check(spark, layout, table):
    head = refresh_stats(spark, layout, table)
    got = layout.table(spark, "gold/user_stats_inc").read()
    assert rows(got) == rows(gold.user_stats(table.read()))
    return head


def test_any_change_equals_a_rebuild(spark, tmp_path):
    rng = random.Random(8)
    layout = Layout(str(tmp_path / "lake"), buckets=4)
    table = layout.table(spark, "gold/users_enriched_inc", ["username"])
    users = {i: user(rng, i) for i in range(60)}
    frame = lambda ids: spark.createDataFrame([users[i] for i in ids], SCHEMA)
    table.overwrite(frame(users))
    check(spark, layout, table)
    for size in (1, 7, 30):
        changed = rng.sample(sorted(users), size) + [100 * size + k for k in range(3)]
        users.update({i: user(rng, i) for i in changed})
        table.merge(frame(changed), ["username"])
        check(spark, layout, table)
    # users leave: the group of the only 'x' user goes
    users[5] = (*users[5][:2], "x", *users[5][3:])
    table.merge(frame([5]), ["username"])
    assert check(spark, layout, table) and layout.table(spark, "gold/user_stats_inc").read().filter("gender = 'x'").count() == 1
    table.overwrite(frame([i for i in users if i > 20]))
    check(spark, layout, table)
    assert layout.table(spark, "gold/user_stats_inc").read().filter("gender = 'x'").count() == 0


def test_a_small_change_touches_few_buckets_and_an_idle_run_none(spark, tmp_path):
    rng = random.Random(3)
    layout = Layout(str(tmp_path / "lake"), buckets=16)
    table = layout.table(spark, "gold/users_enriched_inc", ["username"])
    table.overwrite(spark.createDataFrame([user(rng, i) for i in range(80)], SCHEMA))
    head = check(spark, layout, table)
    assert check(spark, layout, table).version == head.version  # nothing new
    one = table.read().filter("username = 'u7'").withColumn("birth_year", F.lit(1970))
    table.merge(one, ["username"])
    check(spark, layout, table)
    state, cells = (layout.table(spark, f"gold/user_stats_inc_{n}").latest() for n in ("state", "cells"))
    assert state.operation == cells.operation == "delta"
    assert state.summary["touched_buckets"] == "1" and int(cells.summary["touched_buckets"]) <= 8
    assert int(state.summary["change_rows"]) == 2  # one row out, one in
    # a column the statistics don't read: nothing to add
    table.merge(table.read().filter("username = 'u8'").withColumn("phone", F.lit("1")), ["username"])
    check(spark, layout, table)
    assert layout.table(spark, "gold/user_stats_inc_state").latest().operation == "mark"


def test_a_stopped_run_is_picked_up(spark, tmp_path):
    rng = random.Random(4)
    layout = Layout(str(tmp_path / "lake"), buckets=4)
    table = layout.table(spark, "gold/users_enriched_inc", ["username"])
    table.overwrite(spark.createDataFrame([user(rng, i) for i in range(30)], SCHEMA))
    check(spark, layout, table)
    from strata.plans import stats_delta

    for k in (1, 2, 3):  # stop after the first, second and third table
        table.merge(spark.createDataFrame([user(rng, i) for i in range(k, 30, 4)], SCHEMA), ["username"])
        follow, calls = stats_delta._follow, []

        def stopping(*a, **kw):
            if len(calls) == k:
                raise RuntimeError("stopped")
            calls.append(1)
            return follow(*a, **kw)

        stats_delta._follow = stopping
        try:
            refresh_stats(spark, layout, table)
        except RuntimeError:
            pass
        finally:
            stats_delta._follow = follow
        table.merge(spark.createDataFrame([user(rng, i) for i in range(0, 30, 9)], SCHEMA), ["username"])
        check(spark, layout, table)
