"""Bronze -> Silver (I3, I5, I6, M7), plus the incremental refresh.

Both builds are pure ``DataFrame -> DataFrame`` functions: parse on read,
require keys, normalise, keep the newest row per key.  Ties on the landing
time are broken by the transport coordinates so the result is deterministic.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.jsonpath import json_first, json_path, parse_struct
from strata.functions.text import clean, concat_nullable, concat_skip_nulls, norm
from strata.functions.time import ms_to_ts, year_of
from strata.operators.dedup import latest_per_key, newest_first
from strata.operators.fence import fenced_select
from strata.operators.upsert import live_rows
from strata.schemas import API_USER_COLUMNS, API_USER_PATHS, CDC_SCHEMA, CDC_USER_COLUMNS

TRANSPORT = ["kafka_partition", "kafka_offset"]
UPSERT_OPS = ("c", "u", "r")


def api_order() -> list[Column]:
    """Newest landing first; transport coordinates break ties."""
    return newest_first("ingested_at", *TRANSPORT)


def cdc_order() -> list[Column]:
    """Newest source time first; transport coordinates break ties."""
    return newest_first("source_ts", *TRANSPORT)


def __getattr__(name: str):
    # ``silver.API_ORDER`` / ``silver.CDC_ORDER``: Columns need a live session,
    # so they are built on access rather than at import.
    if name == "API_ORDER":
        return api_order()
    if name == "CDC_ORDER":
        return cdc_order()
    raise AttributeError(name)


# ----------------------------------------------------------------- API feed
def _api_fields(bronze: DataFrame, paths: dict[str, Sequence[str]], keep: Sequence[str],
                whole: str | None = None) -> DataFrame:
    """Payload fields by JSON paths, each extracted once per row (the fence
    keeps filters on them from extracting again).  ``whole`` also gives the
    document itself, NULL where the payload is no JSON."""
    return fenced_select(
        bronze,
        *[json_first("payload", *p).alias(name) for name, p in paths.items()],
        *([json_path("payload", "$").alias(whole)] if whole else []),
        *keep,
    )


def parse_api(bronze: DataFrame, paths: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Payload fields by shape-tolerant JSON paths (nested first, flat second)."""
    return _api_fields(bronze, paths or API_USER_PATHS, ("ingested_at", *TRANSPORT))


def clean_api(parsed: DataFrame, null_names: bool = False) -> DataFrame:
    """Required keys (checked before trimming), then normalised columns.
    ``null_names`` is the SQL model's full name: NULL if either part is.
    Fields parsed beyond the standard ones (a wider path map, I14) are
    carried through as they are."""
    standard = set(API_USER_PATHS) | {"ingested_at", *TRANSPORT}
    extra = [c for c in parsed.columns if c not in standard]
    return parsed.filter(F.col("username").isNotNull() & F.col("email").isNotNull()).select(
        clean("first_name").alias("first_name"),
        clean("last_name").alias("last_name"),
        (concat_nullable if null_names else concat_skip_nulls)(
            " ", clean("first_name"), clean("last_name")).alias("full_name"),
        norm("gender").alias("gender"),
        norm("email").alias("email"),
        norm("username").alias("username"),
        year_of("dob").alias("birth_year"),
        clean("phone").alias("phone"),
        F.col("postcode"),
        F.col("ingested_at"),
        *TRANSPORT,
        *extra,
    )


def api_updates(bronze: DataFrame, paths: dict[str, Sequence[str]] | None = None,
                null_names: bool = False) -> DataFrame:
    """Newest row per username, keeping the ordering columns for merging."""
    return latest_per_key(clean_api(parse_api(bronze, paths), null_names), ["username"], api_order())


def api_users(bronze: DataFrame, paths: dict[str, Sequence[str]] | None = None,
              null_names: bool = False) -> DataFrame:
    """Silver ``api_users`` from a Bronze slice (I3).  ``paths`` may widen the
    default path map; extra fields follow the standard columns."""
    extra = [c for c in (paths or {}) if c not in API_USER_PATHS]
    return api_updates(bronze, paths, null_names).select(*API_USER_COLUMNS, *extra)


def api_rejects(bronze: DataFrame) -> DataFrame:
    """Messages the API build drops, with the reason (M7): the same parse as the build."""
    keep = ("kafka_topic", *TRANSPORT, "ingested_at", "payload")
    p = _api_fields(bronze, {k: API_USER_PATHS[k] for k in ("username", "email")}, keep, whole="_doc")
    reason = (
        F.when(F.col("_doc").isNull(), F.lit("unparseable"))
        .when(F.col("username").isNull(), F.lit("missing_username"))
        .when(F.col("email").isNull(), F.lit("missing_email"))
    )
    return (
        p.withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select("kafka_topic", *TRANSPORT, "ingested_at", "reason", "payload")
    )


# --------------------------------------------------------------- change feed
def parse_cdc(bronze: DataFrame, schema: T.StructType = CDC_SCHEMA) -> DataFrame:
    """Change envelope with an explicit partial schema, parsed once per row."""
    d = parse_struct("payload", schema)
    return fenced_select(
        bronze.select(d.alias("_d"), "ingested_at", *TRANSPORT),
        F.col("_d.before.id").alias("before_id"),
        F.col("_d.after.id").alias("id"),
        F.col("_d.after.name").alias("name"),
        F.col("_d.after.email").alias("email"),
        F.col("_d.after.department").alias("department"),
        F.col("_d.op").alias("op"),
        F.col("_d.ts_ms").alias("source_ts_ms"),
        "ingested_at",
        *TRANSPORT,
    )


def clean_cdc(parsed: DataFrame, deletes: str = "ignore") -> DataFrame:
    """Keep usable events and normalise them.

    ``deletes="ignore"`` keeps c/u/r with an id and a name (deleted users stay);
    ``deletes="apply"`` also keeps ``d`` events keyed by ``before.id`` and marks
    them ``is_deleted`` (tombstones, hidden by ``live_rows``).
    """
    upsert_ok = F.col("op").isin(*UPSERT_OPS) & F.col("id").isNotNull() & F.col("name").isNotNull()
    if deletes == "ignore":
        kept = parsed.filter(upsert_ok)
        key = F.col("id")
        extra: list[Column] = []
    elif deletes == "apply":
        is_del = (F.col("op") == "d") & F.col("before_id").isNotNull()
        kept = parsed.filter(upsert_ok | is_del)
        key = F.when(F.col("op") == "d", F.col("before_id")).otherwise(F.col("id"))
        extra = [(F.col("op") == "d").alias("is_deleted")]
    else:
        raise ValueError(f"deletes must be 'ignore' or 'apply', not {deletes!r}")
    return kept.select(
        key.alias("id"),
        clean("name").alias("name"),
        norm("email").alias("email"),
        clean("department").alias("department"),
        F.col("op"),
        ms_to_ts("source_ts_ms").alias("source_ts"),
        F.col("ingested_at"),
        *TRANSPORT,
        *extra,
    )


def cdc_updates(bronze: DataFrame, deletes: str = "ignore", schema: T.StructType = CDC_SCHEMA) -> DataFrame:
    """Newest event per id by source time (with tombstones under ``apply``)."""
    return latest_per_key(clean_cdc(parse_cdc(bronze, schema), deletes), ["id"], cdc_order())


def cdc_users(bronze: DataFrame, deletes: str = "ignore", schema: T.StructType = CDC_SCHEMA) -> DataFrame:
    """Silver ``cdc_users`` from a Bronze slice."""
    latest = cdc_updates(bronze, deletes, schema)
    if deletes == "apply":
        latest = live_rows(latest)
    return latest.select(*CDC_USER_COLUMNS)


def cdc_rejects(bronze: DataFrame, schema: T.StructType = CDC_SCHEMA, deletes: str = "ignore") -> DataFrame:
    """Change messages the build drops under the same delete mode, with the reason (M7)."""
    p = fenced_select(
        bronze.select(parse_struct("payload", schema).alias("_d"), "kafka_topic", *TRANSPORT, "ingested_at", "payload"),
        F.col("_d.op").alias("op"), F.col("_d.before.id").alias("before_id"), F.col("_d.after.id").alias("id"),
        F.col("_d.after.name").alias("name"), "kafka_topic", *TRANSPORT, "ingested_at", "payload")
    is_del = F.col("op") == "d"
    reason = F.when(F.col("op").isNull(), F.lit("no_envelope"))
    if deletes == "ignore":
        reason = reason.when(is_del, F.lit("delete_ignored"))
    else:
        reason = (reason.when(is_del & F.col("before_id").isNull(), F.lit("delete_without_id"))
                  .when(is_del, F.lit(None).cast("string")))
    reason = (
        reason.when(~F.col("op").isin(*UPSERT_OPS), F.lit("unknown_op"))
        .when(F.col("id").isNull(), F.lit("missing_id"))
        .when(F.col("name").isNull(), F.lit("missing_name"))
    )
    return (
        p.withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select("kafka_topic", *TRANSPORT, "ingested_at", "reason", "payload")
    )


# ------------------------------------------------------ incremental refresh
def rebuild(bronze, silver, build: Callable[[DataFrame], DataFrame], files_per_bucket: int = 1):
    """Full refresh (I11): rebuild Silver from all of Bronze as a new version
    (older versions stay readable), e.g. after widening the schema (I14)."""
    head = bronze.latest()
    if head is None:
        return None
    seen = Observation("bronze_full")
    rows = bronze.read().observe(seen, F.max("ingested_at").alias("mark"))

    def consumed() -> str:
        m = seen.get["mark"]
        return json.dumps({"bronze_version": head.version, "ingested_at": None if m is None else str(m)})

    return silver.overwrite(build(rows), operation="rebuild", files_per_bucket=files_per_bucket,
                            mark=consumed)


def unconsumed(bronze, mark: str | None, overlap: str | None = None) -> DataFrame | None:
    """Bronze rows a Silver table has not consumed yet, or None if nothing.

    ``mark`` records the Bronze version consumed.  Read are exactly the
    folders that append commits added since then, taken from those commits,
    so no row is lost to an equal or older landing stamp (T10), nor to a
    compaction that has linked its rows into another folder since.  ``overlap`` re-reads,
    besides, rows that landed up to that long before the mark's newest stamp.
    Where a commit of the range has expired, or its folder is gone, all of Bronze is
    read again; the guarded merge makes re-read rows harmless.
    """
    head = bronze.latest()
    if head is None:
        return None
    if mark is None:
        return bronze.read()
    m = json.loads(mark)
    if m["bronze_version"] == head.version:
        return None
    added = _appended_since(bronze, m["bronze_version"], head)
    if added is None:
        return bronze.read()
    frames = [bronze._read_parts(head, added)] if added else []
    if overlap and m.get("ingested_at") is not None:
        bound = F.lit(m["ingested_at"]).cast("timestamp_ntz") - F.expr(f"INTERVAL {overlap}")
        frames.append(bronze.read().filter(F.col("ingested_at") >= bound))
    if not frames:
        return None
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def _appended_since(bronze, since: int, head) -> list[str] | None:
    """Folders that commits after version ``since`` appended, from one Spark read
    of exactly those log entries: an append's own folder is the last it lists.
    Only folder names reach the driver.  None where an entry of the range or
    such a folder no longer exists, or something else than appends and compactions changed the table."""
    from strata.sources.tables import LOG_SCHEMA

    names = {bronze._entry(v) for v in range(since, head.version + 1)}  # the consumed version too
    logged = set(bronze._fs.list_names(bronze._log))  # one listing, not a call for each entry
    if not all(n.rsplit("/", 1)[1] in logged for n in names):
        return None
    log = bronze.spark.read.schema(LOG_SCHEMA).json(sorted(names)).filter(F.col("version") > since)
    rows = log.select("operation", F.when(F.col("operation") == "append", F.element_at("parts", -1)).alias("part")).collect()
    if any(r["operation"] not in ("append", "compact", "mark") for r in rows):
        return None
    added = [r["part"] for r in rows if r["part"]]
    stored = {f"{folder}/{n}" for folder in {p.rsplit("/", 1)[0] for p in added} for n in bronze._fs.list_names(f"{bronze.root}/{folder}")}
    return added if all(p in stored for p in added) else None


def refresh(
    bronze,
    silver,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    order: Sequence[Column] | None,
    overlap: str | None = None,
    files_per_bucket: int = 1,
):
    """One incremental Silver run over versioned tables.

    The consumed mark is stored in the Silver commit itself, so mark and data
    move together (a crash leaves neither).  With ``order`` the merge is
    guarded (newest wins whichever side it is on): re-reading rows is
    harmless and the result does not depend on how the feed was split into
    runs.  ``order=None`` is the plain MERGE (source always wins).
    Returns the new commit, or None when Bronze has nothing new.
    """
    head = silver.latest()
    prev = head.mark if head is not None else None
    bronze_head = bronze.latest()
    fresh = unconsumed(bronze, prev, overlap)
    if fresh is None:
        return None
    seen = Observation("bronze_slice")
    fresh = fresh.observe(seen, F.max("ingested_at").alias("mark"))
    updates = build(fresh)

    def consumed() -> str:
        newest = seen.get["mark"]
        if newest is None and prev is not None:
            newest = json.loads(prev).get("ingested_at")
        return json.dumps({"bronze_version": bronze_head.version,
                           "ingested_at": None if newest is None else str(newest)})

    commit = silver.merge(updates, list(keys), order, operation="merge", mark=consumed,
                          files_per_bucket=files_per_bucket)
    if commit is None or (head is not None and commit.version == head.version):  # every fresh row was rejected: only the mark moves
        commit = silver._commit("mark", head.parts if head else [],
                                silver.schema() if head else updates.schema, base=head, mark=consumed())
    return commit
