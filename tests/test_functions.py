"""Column helpers and the semantic traps of SURVEY 1.5."""

from datetime import datetime

from pyspark.sql import functions as F

from strata.functions import (
    clean,
    concat_nullable,
    concat_skip_nulls,
    json_first,
    label_unknown,
    millis_since_epoch,
    ms_to_ts,
    norm,
    parse_struct,
    to_millis_precision,
    truncate,
    year_of,
)
from strata.schemas import CDC_SCHEMA


def one(spark, col, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_year_of_is_guarded(spark):
    got = one(spark, year_of("x"), [("1995-01-15",), ("1_99",), ("19.5",), ("n/a",), ('{"ag',), (None,),
                                    ("2001",)])
    assert got == [1995, None, None, None, None, None, 2001]


def test_concat_variants(spark):
    rows = [("a", "b"), (None, "b"), (None, None)]
    skip = one(spark, concat_skip_nulls(" ", "x", "y"), rows, "x string, y string")
    keep = one(spark, concat_nullable(" ", "x", "y"), rows, "x string, y string")
    assert skip == ["a b", "b", ""]
    assert keep == ["a b", None, None]


def test_trim_spaces_only(spark):
    assert one(spark, F.length(clean("x")), [("\t a ",)]) == [3]
    assert one(spark, norm("x"), [("  MiXeD ",)]) == ["mixed"]


def test_json_first_prefers_nested(spark):
    rows = [('{"name":{"first":"N"},"first_name":"F"}',), ('{"first_name":"F"}',), ("not json",), (None,)]
    assert one(spark, json_first("x", "$.name.first", "$.first_name"), rows) == ["N", "F", None, None]


def test_json_object_and_number_text(spark):
    rows = [('{"dob":{"age":30},"p":70123}',)]
    assert one(spark, json_first("x", "$.dob.date", "$.dob"), rows) == ['{"age":30}']
    assert one(spark, json_first("x", "$.p"), rows) == ["70123"]


def test_from_json_permissive(spark):
    rows = [("garbage",), ("",), (None,), ('{"after":{"id":"7"},"op":"c","ts_ms":"5"}',),
            ('{"after":{"id":7.0},"op":"c"}',)]
    got = spark.createDataFrame(rows, "x string").select(parse_struct("x", CDC_SCHEMA).alias("d")).collect()
    assert got[0]["d"] is not None and got[0]["d"]["op"] is None  # struct of NULLs
    assert got[1]["d"] is None and got[2]["d"] is None
    assert got[3]["d"]["after"]["id"] is None and got[3]["d"]["ts_ms"] is None
    assert got[4]["d"]["after"]["id"] is None


def test_time_helpers_zone_free(spark):
    rows = [(1767225601500,)]
    assert one(spark, ms_to_ts("x"), rows, "x long") == [datetime(2026, 1, 1, 0, 0, 1, 500000)]
    df = spark.createDataFrame([(datetime(2024, 5, 6, 7, 8, 9, 123456),)], "t timestamp_ntz")
    row = df.select(truncate("minute", "t").alias("m"), to_millis_precision("t").alias("ms"),
                    millis_since_epoch("t").alias("e")).first()
    assert row["m"] == datetime(2024, 5, 6, 7, 8)
    assert row["ms"] == datetime(2024, 5, 6, 7, 8, 9, 123000)
    assert df.select(truncate("minute", "t")).schema[0].dataType.typeName() == "timestamp_ntz"
    assert row["e"] == 1714979289123


def test_label_unknown(spark):
    assert one(spark, label_unknown("x"), [(None,), ("a",)]) == ["unknown", "a"]
