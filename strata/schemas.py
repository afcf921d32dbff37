"""Table contracts: the generic Bronze envelope, the change-feed envelope and
the Silver / Gold column lists."""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze keeps each message untouched plus its transport coordinates.
# (topic, partition, offset) identifies a message.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_ts", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]
MESSAGE_ID = ["kafka_topic", "kafka_partition", "kafka_offset"]

# Users-record payload fields kept by the API feed's Silver table.
API_USER_COLUMNS = [
    "first_name",
    "last_name",
    "full_name",
    "gender",
    "email",
    "username",
    "birth_year",
    "phone",
    "postcode",
    "ingested_at",
]

# Default nested-first / flat-second JSON paths for the API feed.
API_USER_PATHS = {
    "first_name": ("$.name.first", "$.first_name"),
    "last_name": ("$.name.last", "$.last_name"),
    "gender": ("$.gender",),
    "postcode": ("$.location.postcode", "$.postcode"),
    "email": ("$.email",),
    "username": ("$.login.username", "$.username"),
    "dob": ("$.dob.date", "$.dob"),
    "phone": ("$.phone",),
}

CDC_USER_COLUMNS = ["id", "name", "email", "department", "op", "source_ts", "ingested_at"]


def row_image(key_type: T.DataType = T.IntegerType()) -> T.StructType:
    """Row image of the source ``users`` table inside a change envelope."""
    return T.StructType(
        [
            T.StructField("id", key_type),
            T.StructField("name", T.StringType()),
            T.StructField("email", T.StringType()),
            T.StructField("department", T.StringType()),
        ]
    )


def change_envelope(image: T.StructType | None = None) -> T.StructType:
    """Partial change-feed envelope: only the fields Silver needs.

    ``before`` is declared (unlike a pure upsert reader) because a delete
    carries its key only there.
    """
    image = image or row_image()
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


CDC_SCHEMA = change_envelope()
