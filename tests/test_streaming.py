"""K1, K2, K5, K6: streaming ingest, resume, replay-safety, streaming upsert."""

import uuid

from pyspark.sql import functions as F

from helpers import SF_SMALL

from strata.operators.upsert import upsert
from strata.plans import silver
from strata.plans.queries import CDC_LONG, bronze_api, bronze_cdc
from strata.sources.feeds import api_feed
from strata.sources.tables import VersionedTable
from strata.streaming.ingest import append_batches, start_bronze
from strata.streaming.upsert_stream import start_upsert


def events_stream(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)


def test_ingest_resume_adds_nothing(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "bronze"))
    for _ in range(2):
        q = start_bronze(api_feed(events_stream(spark)), t, str(tmp_path / "ck"), "bronze_api",
                         {"availableNow": True})
        q.awaitTermination()
    expected = bronze_api(spark, SF_SMALL)
    assert t.read().count() == expected.count()
    assert t.read().select("kafka_offset").exceptAll(expected.select("kafka_offset")).count() == 0


def test_replayed_batch_is_skipped(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "bronze"))
    write = append_batches(t, "q")
    batch = bronze_api(spark, SF_SMALL).limit(10)
    write(batch, 0)
    write(batch, 0)  # replay of the same batch id
    write(batch, 1)
    assert len(t.history().collect()) == 2
    assert t.read().count() == 20


def test_stream_upsert_equals_batch(spark, tmp_path):
    staged = str(tmp_path / f"files-{uuid.uuid4().hex}")
    src = bronze_cdc(spark, SF_SMALL)
    src.repartitionByRange(3, "kafka_offset").write.parquet(staged)
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(staged)
    t = VersionedTable(spark, str(tmp_path / "silver"), buckets=4, bucket_keys=["id"])
    q = start_upsert(stream, t, lambda b: silver.cdc_updates(b, "ignore", CDC_LONG), ["id"],
                     silver.cdc_order(), str(tmp_path / "ck"), "silver_cdc", {"availableNow": True})
    q.awaitTermination()
    assert len(t.history().collect()) >= 2  # several micro-batches
    cols = ["id", "name", "email", "department", "op", "source_ts", "ingested_at"]
    got = t.read().select(*cols)
    want = silver.cdc_users(src, "ignore", CDC_LONG).select(*cols)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_windowed_counts_match_batch(spark, tmp_path):
    from strata.plans import reports
    from strata.streaming.upsert_stream import start_rate

    t = VersionedTable(spark, str(tmp_path / "rate"), buckets=2, bucket_keys=["minute"])
    q = start_rate(api_feed(events_stream(spark)), t, "kafka_ts", str(tmp_path / "ck"), "rate",
                   trigger={"availableNow": True})
    q.awaitTermination()
    want = reports.events_per_minute(bronze_api(spark, SF_SMALL), "kafka_ts")
    got = t.read()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.agg(F.sum("events")).first()[0] == bronze_api(spark, SF_SMALL).count()


def test_upsert_helpers_unique_contract(spark):
    import pytest

    from strata.operators.upsert import DuplicateSourceKeys

    t = spark.createDataFrame([(1, "a")], "k long, v string")
    u = spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string")
    with pytest.raises(DuplicateSourceKeys):
        upsert(t, u, ["k"], strict=True).collect()


def test_two_topics_two_queries(spark, tmp_path):
    from strata.streaming.ingest import await_all, start_topics

    api = api_feed(events_stream(spark))
    orders_schema = spark.read.parquet(f"{SF_SMALL}/orders.parquet").schema
    from strata.sources.feeds import change_feed

    cdc = change_feed(spark.readStream.schema(orders_schema).option("pathGlobFilter", "orders.parquet")
                      .parquet(SF_SMALL))
    tables = {"users_created": VersionedTable(spark, str(tmp_path / "api")),
              "postgres.public.users": VersionedTable(spark, str(tmp_path / "cdc"))}
    qs = start_topics(spark, {"users_created": api, "postgres.public.users": cdc}, tables,
                      str(tmp_path / "ck"), {"availableNow": True})
    await_all(qs)
    assert tables["users_created"].read().count() == bronze_api(spark, SF_SMALL).count()
    assert tables["postgres.public.users"].read().count() == bronze_cdc(spark, SF_SMALL).count()


def test_stream_dedup_keeps_first_copies_however_late(spark, tmp_path):
    from strata.schemas import BRONZE_SCHEMA, MESSAGE_ID
    from strata.streaming.upsert_stream import start_dedup
    from helpers import ts

    def rows(offsets, second, landed):
        return spark.createDataFrame(
            [("{}", "t", 0, o, ts(second), ts(landed)) for o in offsets], BRONZE_SCHEMA)

    landing = str(tmp_path / "landing")
    rows(range(0, 5), 50, 10).coalesce(1).write.mode("append").parquet(landing)
    # copies of 3 and 4, and new messages
    rows([3, 4, 5, 6], 51, 20).coalesce(1).write.mode("append").parquet(landing)
    # first copies whose event time is far behind all that came before
    rows([7, 8], 1, 30).withColumn("kafka_ts", F.lit("2020-01-01").cast("timestamp")) \
        .coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    t = VersionedTable(spark, str(tmp_path / "bronze"), buckets=4, bucket_keys=MESSAGE_ID)
    q = start_dedup(stream, t, str(tmp_path / "ck"), "dedup", {"availableNow": True})
    q.awaitTermination()
    got = sorted((r["kafka_offset"], r["ingested_at"].second) for r in t.read().collect())
    assert got == [(0, 10), (1, 10), (2, 10), (3, 10), (4, 10), (5, 20), (6, 20), (7, 30), (8, 30)]


def test_stream_queries_read_a_folder_of_part_files(spark, tmp_path):
    from strata.plans.queries_state import REGISTRY

    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert REGISTRY["stream_ingest"](spark, str(tmp_path)).count() == bronze_api(spark, SF_SMALL).count()
    assert REGISTRY["stream_rate"](spark, str(tmp_path)).count() > 0
