"""Message feeds derived from the warehouse tables.

The library works on any Bronze feed; these two derive realistic feeds from
the TPC-H-like tables so that every query runs over whole tables and grows
with them:

* ``api_feed(events)``   - one users-record JSON message per event, in two
  shapes (nested and flat), with the gaps a real producer has: missing e-mail,
  object-valued or unparseable birth dates, padded and mixed-case keys, and a
  few non-JSON messages.
* ``change_feed(orders)`` - one change envelope per order for customer
  ``o_custkey``, arriving in order-key order while the source time is the
  order date, so arrival and source order disagree (the case where a naive
  high-water mark loses updates).

Fixed values of the derivation (must stay equal in the oracle SQL):
  API topic 'users_created'; change topic 'postgres.public.users';
  4 partitions; nested shape on even event_id; event 'error' has no e-mail,
  e-mail domain '@Other.ORG' when user_id % 7 = 0 else '@Example.COM',
  'signup' has no usable birth date, 'view' has no phone; value >= 480 is a
  non-JSON message; gender 'Male' below 200, ' FEMALE ' below 400, else none;
  birth year 1950 + user_id % 50; landing time = event hour + 1 hour.
  Priority -> op: 1-URGENT r, 2-HIGH c, 3-MEDIUM u, 4-NOT SPECIFIED u,
  5-LOW d; status -> department: F ' Finance ', O 'Ops', P none;
  'c' with status P has no name; total price below 3000 is 'garbage';
  above 497000 the id is sent as text; landing time 2024-01-01 + o_orderkey s.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.time import add_interval, millis_since_epoch, to_millis_precision, truncate

API_TOPIC = "users_created"
CDC_TOPIC = "postgres.public.users"
PARTITIONS = 4


def api_feed(events: DataFrame, topic: str = API_TOPIC, partitions: int = PARTITIONS) -> DataFrame:
    """Bronze rows for the users-record feed, one per event."""
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k")
    first = F.concat(F.when(eid % 5 == 0, F.lit(" ")).otherwise(F.lit("")), F.initcap(etype))
    last = F.concat(F.lit("U"), uid.cast("string"))
    gender = F.when(F.col("value") < 200, F.lit("Male")).when(F.col("value") < 400, F.lit(" FEMALE "))
    domain = F.when(uid % 7 == 0, F.lit("@Other.ORG")).otherwise(F.lit("@Example.COM"))
    email = F.when(etype != "error", F.concat(F.lit("User"), uid.cast("string"), domain))
    username = F.concat(F.when(eid % 3 == 0, F.lit(" ")).otherwise(F.lit("")), F.lit("User"),
                        uid.cast("string"))
    dob_date = F.concat_ws(
        "-",
        (F.lit(1950) + uid % 50).cast("string"),
        F.lpad((eid % 12 + 1).cast("string"), 2, "0"),
        F.lpad((eid % 28 + 1).cast("string"), 2, "0"),
    )
    has_dob = etype != "signup"
    phone = F.when(etype != "view",
                   F.concat(F.lit(" +84 "), uid.cast("string"), F.lit("-"), (eid % 1000).cast("string"),
                            F.lit(" ")))
    nested = F.to_json(
        F.struct(
            F.struct(F.lit("Mx").alias("title"), first.alias("first"), last.alias("last")).alias("name"),
            gender.alias("gender"),
            F.struct(k.cast("int").alias("postcode"), F.lit("Hanoi").alias("city")).alias("location"),
            email.alias("email"),
            F.struct(username.alias("username"), F.md5(uid.cast("string")).alias("uuid")).alias("login"),
            F.struct(
                F.when(has_dob, F.concat(dob_date, F.lit("T00:00:00.000Z"))).alias("date"),
                (F.lit(2024) - (F.lit(1950) + uid % 50)).alias("age"),
            ).alias("dob"),
            phone.alias("phone"),
            F.lit("VN").alias("nat"),
        )
    )
    flat = F.to_json(
        F.struct(
            first.alias("first_name"),
            last.alias("last_name"),
            gender.alias("gender"),
            F.lpad(k, 5, "0").alias("postcode"),
            email.alias("email"),
            username.alias("username"),
            F.when(has_dob, dob_date).otherwise(F.lit("n/a")).alias("dob"),
            phone.alias("phone"),
        )
    )
    payload = (
        F.when(F.col("value") >= 480, F.lit("not json"))
        .when(eid % 2 == 0, nested)
        .otherwise(flat)
    )
    return events.select(
        payload.alias("payload"),
        F.lit(topic).alias("kafka_topic"),
        (uid % partitions).cast("int").alias("kafka_partition"),
        eid.cast("long").alias("kafka_offset"),
        to_millis_precision("ts").alias("kafka_ts"),
        add_interval(truncate("hour", "ts"), "HOUR", 1).alias("ingested_at"),
    )


def change_feed(orders: DataFrame, topic: str = CDC_TOPIC, partitions: int = PARTITIONS) -> DataFrame:
    """Bronze rows for the change feed of the ``users`` source table."""
    key = F.col("o_custkey")
    op = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("r"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("c"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("d"))
        .otherwise(F.lit("u"))
    )
    name = F.when(~((op == "c") & (F.col("o_orderstatus") == "P")),
                  F.concat(F.lit(" Customer "), key.cast("string")))
    email = F.concat(F.lit("USER"), key.cast("string"), F.lit("@Example.com "))
    dept = (
        F.when(F.col("o_orderstatus") == "F", F.lit(" Finance "))
        .when(F.col("o_orderstatus") == "O", F.lit("Ops"))
    )
    text_id = F.col("o_totalprice") > 497000
    after = F.struct(key.alias("id"), name.alias("name"), email.alias("email"), dept.alias("department"))
    after_text_id = F.struct(key.cast("string").alias("id"), name.alias("name"), email.alias("email"),
                             dept.alias("department"))
    before = F.struct(key.alias("id"))
    ts_ms = millis_since_epoch("o_orderdate")

    def envelope(after_image):
        return F.to_json(
            F.struct(
                F.when(op.isin("u", "d"), before).alias("before"),
                F.when(op != "d", after_image).alias("after"),
                op.alias("op"),
                ts_ms.alias("ts_ms"),
                F.struct(F.lit("postgres").alias("connector"), F.lit("users").alias("table")).alias("source"),
            )
        )

    payload = (
        F.when(F.col("o_totalprice") < 3000, F.lit("garbage"))
        .when(text_id, envelope(after_text_id))
        .otherwise(envelope(after))
    )
    landed = add_interval(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "SECOND", F.col("o_orderkey"))
    return orders.select(
        payload.alias("payload"),
        F.lit(topic).alias("kafka_topic"),
        (key % partitions).cast("int").alias("kafka_partition"),
        F.col("o_orderkey").cast("long").alias("kafka_offset"),
        landed.alias("kafka_ts"),
        landed.alias("ingested_at"),
    )
