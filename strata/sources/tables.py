"""Versioned Parquet tables.

A directory convention, not a storage engine: data is written by Spark's
Parquet writer into a fresh folder per commit, and a commit-log entry names the
folders that make up each version.  Readers resolve the last committed entry,
so a half-written version is never visible and nothing ever overwrites the path
it is reading.

    <root>/_commits/0000000007.json   one JSON entry per version
    <root>/data/0000000007/...        Parquet written by that version
    <root>/data/0000000007/sb=12/     (bucketed tables) one folder per bucket

Bucketed tables hash rows into ``pmod(hash(keys), buckets)``; an upsert
rewrites only the buckets its updates touch and re-links the others, so its
cost follows the change, not the table.  ``keep_first`` adds new rows to their buckets instead.  Several writers may commit: a version
number is created exclusively after the head its folders were linked from, and
a writer that comes second links its folders after the first one's, or merges
again, or raises ``CommitConflict``.

When a catalog with native versioning is configured (Iceberg, Delta), use
``spark.table`` / ``MERGE`` / ``VERSION AS OF`` directly; see ``catalog_*``.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.time import ts_literal
from strata.operators.upsert import assert_unique
from strata.session import scratch_path

BUCKET_COL = "sb"
SUB_COL = "_sub"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("operation", T.StringType()),
        T.StructField("parts", T.ArrayType(T.StringType())),
        T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
        T.StructField("txn", T.StringType()),
        T.StructField("mark", T.StringType()),
        T.StructField("layout", T.MapType(T.StringType(), T.StringType())),
    ]
)


class CommitConflict(RuntimeError):
    """Another writer committed the same version first."""


class _FS:
    """Metadata operations through the session's Hadoop FileSystem, so the
    same code works on HDFS, object stores and local disk."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(root).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def list_names(self, path: str) -> list[str]:
        p = self._path(path)
        if not self.fs.exists(p):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(p)]

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def write_exclusive(self, path: str, text: str) -> None:
        p = self._path(path)
        try:
            out = self.fs.create(p, False)
        except Exception as exc:  # FileAlreadyExistsException from the JVM
            raise CommitConflict(path) from exc
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8")
            )
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def delete(self, path: str) -> bool:
        return bool(self.fs.delete(self._path(path), True))


@dataclass
class Commit:
    version: int
    committed_at: datetime
    operation: str
    parts: list[str]
    summary: dict[str, str] = field(default_factory=dict)
    txn: str | None = None
    mark: str | None = None
    schema: str | None = None
    buckets: int | None = None
    bucket_keys: list[str] | None = None

    def to_json(self) -> str:
        # bucketed tables record their folders as runs of bucket ids per data
        # folder: a merge that rewrote every bucket is one short line, not one
        # path per bucket
        layout = encode_layout(self.parts) if self.buckets else None
        return json.dumps(
            {
                "version": self.version,
                "committed_at": self.committed_at.isoformat(),
                "operation": self.operation,
                "parts": [] if layout is not None else self.parts,
                "layout": layout,
                "summary": self.summary,
                "txn": self.txn,
                "mark": self.mark,
                "schema": self.schema,
                "buckets": self.buckets,
                "bucket_keys": self.bucket_keys,
            }
        )

    @staticmethod
    def from_json(text: str) -> Commit:
        d = json.loads(text)
        d["committed_at"] = datetime.fromisoformat(d["committed_at"])
        layout = d.pop("layout", None)
        if layout is not None:
            d["parts"] = decode_layout(layout)
        return Commit(**d)


def widen(schema: T.StructType, other: T.StructType) -> T.StructType:
    """``schema`` with the columns of ``other`` that it lacks, at its end."""
    have = set(schema.names)
    return T.StructType(schema.fields + [T.StructField(f.name, f.dataType, True) for f in other.fields if f.name not in have])


def encode_layout(parts: list[str]) -> dict[str, str]:
    """Bucket folders ``<folder>/sb=<n>`` as ``{folder: "0-41,43,45-63"}``."""
    by_folder: dict[str, list[int]] = {}
    for p in parts:
        folder, _, b = p.rpartition(f"/{BUCKET_COL}=")
        by_folder.setdefault(folder, []).append(int(b))
    out = {}
    for folder, ids in by_folder.items():
        ids.sort()
        runs, lo = [], ids[0]
        for prev, cur in zip(ids, ids[1:] + [None]):
            if cur is None or cur != prev + 1:
                runs.append(str(lo) if lo == prev else f"{lo}-{prev}")
                lo = cur
        out[folder] = ",".join(runs)
    return out


def decode_layout(layout: dict[str, str]) -> list[str]:
    """Inverse of ``encode_layout``, ordered by bucket id."""
    pairs = []
    for folder, runs in layout.items():
        for run in filter(None, runs.split(",")):
            lo, _, hi = run.partition("-")
            pairs.extend((b, f"{folder}/{BUCKET_COL}={b}") for b in range(int(lo), int(hi or lo) + 1))
    return [p for _, p in sorted(pairs)]


def _folders(by_bucket: dict[int, list[str]], ids=None) -> list[str]:
    """Folders of some buckets (default: all), by bucket."""
    return [p for b in sorted(by_bucket if ids is None else ids) for p in by_bucket.get(b, [])]


def bucket_of(keys: list[str], buckets: int) -> Column:
    """``pmod(hash(keys), buckets)``: the function Spark's hash partitioning
    uses to place rows, which is what lets a bucketed write put exactly one
    bucket slice in every task (see ``VersionedTable._cluster``)."""
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


# Bits in one Spark bitmap (``bitmap_construct_agg``): 4 KB per 32768 ids.
BITMAP_BITS = 32768


def bucket_bitmaps(bucket: Column, buckets: int) -> list[Column]:
    """Aggregates whose results together are the set of bucket ids seen, as
    fixed-size bitmaps: one per block of ``BITMAP_BITS`` ids.  Each task adds
    at most 4 KB per block to an observed metric, however many rows and
    buckets it saw, where a ``collect_set`` would carry every id."""
    return [
        F.bitmap_construct_agg(
            F.when(F.floor(bucket / F.lit(BITMAP_BITS)) == F.lit(k), F.pmod(bucket, F.lit(BITMAP_BITS)))
        ).alias(f"_bm{k}")
        for k in range((buckets + BITMAP_BITS - 1) // BITMAP_BITS)
    ]


def bitmap_ids(bitmaps: list[bytes | None]) -> list[int]:
    """Ids set in the bitmaps from ``bucket_bitmaps`` (bounded: <= buckets)."""
    out = []
    for k, bm in enumerate(bitmaps):
        for i, byte in enumerate(bm or b""):
            if byte:
                out.extend(k * BITMAP_BITS + i * 8 + j for j in range(8) if byte >> j & 1)
    return out


# A change touching at least this share of the buckets is laid out with one
# task per bucket slice over all buckets; below it, over the touched ones.
EXACT_LAYOUT_SHARE = 4
# Rows of a change whose key hashes (8 bytes each) are broadcast in ``keep_first``.
SMALL_CHANGE = 1_000_000


class VersionedTable:
    """A Parquet table with versions, time travel and bucketed upserts.

    ``buckets``/``bucket_keys`` are fixed at creation and stored in every
    commit; pass them only when creating.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int | None = None,
        bucket_keys: list[str] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self._fs = _FS(spark, self.root)
        head = self.latest()
        if head is not None and head.buckets:
            buckets, bucket_keys = head.buckets, head.bucket_keys
        if bool(buckets) != bool(bucket_keys):
            raise ValueError("buckets and bucket_keys go together")
        self.buckets = buckets
        self.bucket_keys = list(bucket_keys) if bucket_keys else None

    # ------------------------------------------------------------------ log
    @property
    def _log(self) -> str:
        return f"{self.root}/_commits"

    def _versions(self) -> list[int]:
        names = self._fs.list_names(self._log)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, version: int) -> str:
        return f"{self._log}/{version:010d}.json"

    def _head_version(self) -> int | None:
        """Newest committed version without listing the log: start from the
        ``_last`` pointer (a hint, possibly stale) and probe forward."""
        pointer = f"{self._log}/_last"
        v = None
        if self._fs.exists(pointer):
            try:
                v = int(self._fs.read_text(pointer).strip())
            except ValueError:  # a pointer that another writer is just replacing
                v = None
        if v is None or not self._fs.exists(self._entry(v)):
            versions = self._versions()
            return versions[-1] if versions else None
        while self._fs.exists(self._entry(v + 1)):
            v += 1
        return v

    def exists(self) -> bool:
        return self._head_version() is not None

    def commit_at(self, version: int) -> Commit:
        # the entry becomes visible with its creation, a moment before its text
        for wait in (0.01, 0.1, 1.0):
            try:
                return Commit.from_json(self._fs.read_text(self._entry(version)))
            except json.JSONDecodeError:
                time.sleep(wait)
        return Commit.from_json(self._fs.read_text(self._entry(version)))

    def _relink(self, operation: str, base: Commit | None, parts_on, schema_on, keep_mark: bool = False,
                **extra) -> Commit:
        """Commit ``parts_on(head)`` on ``base``; where another commit came
        first, on that one, until it holds.  ``parts_on`` raises
        ``CommitConflict`` where the newer head leaves no room for the change."""
        head = base
        while True:
            parts, schema = parts_on(head), schema_on(head)
            if keep_mark:
                extra["mark"] = head.mark
            try:
                return self._commit(operation, parts, schema, base=head, **extra)
            except CommitConflict:
                newer = self.latest()
                if newer is None or (head is not None and newer.version <= head.version):
                    raise
                head = newer

    def latest(self) -> Commit | None:
        v = self._head_version()
        return None if v is None else self.commit_at(v)

    def history(self) -> DataFrame:
        """Snapshot history (J6): version, committed_at, operation, summary,
        read from the log files by Spark itself."""
        return self._log_frame().select("version", "committed_at", "operation", "summary", "txn", "mark")

    def _log_frame(self) -> DataFrame:
        """Every log entry as a row, read by Spark (the ``_last`` pointer is
        not JSON and is skipped by the file filter)."""
        if not self.exists():
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).option("pathGlobFilter", "*.json").json(self._log)

    def _commit(self, operation: str, parts: list[str], schema: T.StructType, *, base: Commit | None,
                **extra) -> Commit:
        """Publish the version after ``base``, the head that ``parts`` was made
        from.  A commit that another writer made meanwhile owns that version
        already, so this raises ``CommitConflict`` and nothing is lost."""
        head = base
        version = 0 if head is None else head.version + 1
        # commit time is strictly increasing even on a coarse clock
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        if head is not None and now <= head.committed_at:
            now = head.committed_at + timedelta(microseconds=1)
        # a mark may be observed while the data is written: resolve it last
        if callable(extra.get("mark")):
            extra["mark"] = extra["mark"]()
        entry = Commit(
            version=version,
            committed_at=now,
            operation=operation,
            parts=parts,
            schema=schema.json(),
            buckets=self.buckets,
            bucket_keys=self.bucket_keys,
            **extra,
        )
        self._fs.write_exclusive(self._entry(version), entry.to_json())
        self._fs.write_text(f"{self._log}/_last", str(version))
        return entry

    def _next_data_dir(self) -> tuple[str, str]:
        """Fresh data folder for the next version.  The random suffix keeps a
        retry after a failed, uncommitted attempt from colliding with the
        orphaned folder (which expiry later removes)."""
        head = self.latest()
        version = 0 if head is None else head.version + 1
        rel = f"data/{version:010d}-{uuid.uuid4().hex[:8]}"
        return rel, f"{self.root}/{rel}"

    def committed_txn(self, txn: str) -> bool:
        """Was a ``<query>:<batch id>`` transaction already committed?

        ``foreachBatch`` replays only the last batch of a query after a
        failure, so walking back from the head to that query's newest commit
        answers it without reading the whole log.
        """
        query, _, batch = txn.rpartition(":")
        v = self._head_version()
        while v is not None and v >= 0 and self._fs.exists(self._entry(v)):
            c = self.commit_at(v)
            if c.txn and c.txn.rpartition(":")[0] == query:
                return int(c.txn.rpartition(":")[2]) >= int(batch)
            v -= 1
        return False

    # ----------------------------------------------------------------- read
    def resolve(self, version: int | None = None, as_of: datetime | str | None = None) -> Commit:
        if version is not None:
            return self.commit_at(version)
        if as_of is not None:
            ts = datetime.fromisoformat(str(as_of)) if not isinstance(as_of, datetime) else as_of
            row = (
                self.history()
                .filter(F.col("committed_at") <= ts_literal(ts))
                .agg(F.max("version").alias("v"))
                .first()
            )
            if row is None or row["v"] is None:
                raise ValueError(f"no version committed at or before {as_of}")
            return self.commit_at(int(row["v"]))
        head = self.latest()
        if head is None:
            raise FileNotFoundError(f"table {self.root} has no commits")
        return head

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.resolve(version).schema))

    def _read_parts(self, commit: Commit, parts: list[str] | None = None,
                    schema: T.StructType | None = None) -> DataFrame:
        schema = schema or T.StructType.fromJson(json.loads(commit.schema))
        parts = commit.parts if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{p}" for p in parts]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None, as_of: datetime | str | None = None) -> DataFrame:
        """Latest state, or the state as of a version / timestamp."""
        return self._read_parts(self.resolve(version, as_of))

    def files(self, version: int | None = None) -> DataFrame:
        """File inspection (J7): path, record_count, file_size_in_bytes."""
        return (
            self.read(version)
            .select(F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_size").alias("file_size_in_bytes"))
            .groupBy("file_path", "file_size_in_bytes")
            .agg(F.count(F.lit(1)).alias("record_count"))
        )

    def partitions(self, version: int | None = None) -> DataFrame:
        """Partition inspection (J7, ``t$partitions``): per bucket, records,
        data files and bytes; an unbucketed table is one partition (bucket
        NULL).  Two aggregations over file metadata, both partial map-side."""
        bucket = (
            F.regexp_extract(F.col("file_path"), f"/{BUCKET_COL}=([0-9]+)/", 1).cast("int")
            if self.buckets else F.lit(None).cast("int")
        )
        return (
            self.files(version)
            .groupBy(bucket.alias("bucket"))
            .agg(
                F.sum("record_count").alias("record_count"),
                F.count(F.lit(1)).alias("file_count"),
                F.sum("file_size_in_bytes").alias("total_size"),
            )
        )

    def _file_listing(self, version: int | None = None) -> DataFrame:
        """(path, length) of every data file of a version, listed by Spark
        (parallel listing over the version's folders; the binary-file source
        reads no content when only the length is selected)."""
        paths = [f"{self.root}/{p}" for p in self.resolve(version).parts]
        if not paths:
            return self.spark.createDataFrame([], "path string, length long")
        return (
            self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(paths)
            .select("path", "length")
        )

    def size_summary(self, version: int | None = None) -> tuple[int, int]:
        """(data files, bytes) of a version: one aggregate over Spark's file
        listing, so the driver gets two numbers whatever the file count."""
        row = self._file_listing(version).agg(
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
        return int(row["files"]), int(row["bytes"])

    def file_sizes(self, version: int | None = None) -> list[tuple[str, int]]:
        """(path, bytes) per data file, for inspection of small tables."""
        return [(r["path"], int(r["length"])) for r in self._file_listing(version).collect()]

    def changed_since(self, version: int) -> tuple[DataFrame, DataFrame] | None:
        """Rows of the buckets rewritten since ``version``, as they were then
        and as they are now (a superset of the changed rows: whole touched
        buckets).  Which buckets changed comes from comparing the two
        commits' bucket folders, so nothing else is read.  None when the
        table is not bucketed or that version has expired."""
        if not self.buckets:
            return None
        try:
            then = self.commit_at(version)
        except Exception:  # expired
            return None
        now = self.latest()
        old, new = self._bucket_map(then), self._bucket_map(now)
        touched = [b for b in sorted(old.keys() | new.keys()) if old.get(b) != new.get(b)]
        return (self._read_parts(then, _folders(old, touched)), self._read_parts(now, _folders(new, touched)))

    def _bucket_map(self, commit: Commit | None) -> dict[int, list[str]]:
        """Folders of each bucket: one, and those that ``keep_first`` added since it was last rewritten."""
        out: dict[int, list[str]] = {}
        for p in commit.parts if commit is not None and self.buckets else []:
            out.setdefault(int(p.rsplit(f"/{BUCKET_COL}=", 1)[1]), []).append(p)
        return out

    def _buckets_in(self, rel: str) -> set[int]:
        """Buckets with rows in a data folder."""
        return {int(n.rpartition("=")[2]) for n in self._fs.list_names(f"{self.root}/{rel}") if n.startswith(f"{BUCKET_COL}=")}

    def _cluster(self, df: DataFrame, n_touched: int, files_per_bucket: int,
                 keys: list[str] | None = None) -> tuple[DataFrame, list[str]]:
        """Shuffle rows so every task holds whole bucket slices; returns the
        frame (with the bucket column) and the columns it is clustered by.

        ``keys`` are the row keys (default: the bucket keys).  When they are
        the bucket keys and the change touches a large share of the buckets
        (a random change set touches nearly all of them), rows are
        hash-partitioned on the bucket keys into ``buckets * files_per_bucket``
        partitions: partition ``p`` then holds exactly the slice
        ``p // buckets`` of bucket ``p % buckets``, so no task carries two
        buckets and every bucket folder gets ``files_per_bucket`` files.

        Otherwise rows are partitioned on (bucket, slice) into touched x
        slices partitions, with the slice hashed from all row keys.  No task
        is scheduled for untouched buckets, and when the bucket keys are only
        part of the row keys, ``files_per_bucket`` splits a hot bucket-key
        value over that many tasks (each row key stays in one task).
        """
        keys = list(keys or self.bucket_keys)
        keyed = df.withColumn(BUCKET_COL, bucket_of(self.bucket_keys, self.buckets))
        f = max(1, files_per_bucket)
        if set(keys) == set(self.bucket_keys) and n_touched * EXACT_LAYOUT_SHARE >= self.buckets:
            cols = list(self.bucket_keys)
            return keyed.repartition(self.buckets * f, *[F.col(k) for k in cols]), cols
        cols = [BUCKET_COL]
        if f > 1:
            keyed = keyed.withColumn(SUB_COL, F.pmod(F.hash(*[F.col(k) for k in keys], F.lit(7)), F.lit(f)))
            cols.append(SUB_COL)
        return keyed.repartition(max(1, n_touched * f), *cols), cols

    def _write_bucketed(self, df: DataFrame, rel: str, path: str, files_per_bucket: int,
                        n_buckets: int) -> None:
        keyed, _ = self._cluster(df, n_buckets, files_per_bucket)
        keyed.drop(SUB_COL).write.partitionBy(BUCKET_COL).parquet(path)

    def overwrite(self, df: DataFrame, operation: str = "overwrite", files_per_bucket: int = 1,
                  **extra) -> Commit:
        """Publish ``df`` as the whole new state (replace-table, A9).  Raises
        ``CommitConflict`` if another commit was made meanwhile."""
        base = self.latest()
        rel, path = self._next_data_dir()
        if self.buckets:
            self._write_bucketed(df, rel, path, files_per_bucket, self.buckets)
            written = self._fs.list_names(path)
            parts = sorted(
                (f"{rel}/{n}" for n in written if n.startswith(f"{BUCKET_COL}=")),
                key=lambda p: int(p.rsplit("=", 1)[1]),
            )
        else:
            df.write.parquet(path)
            parts = [rel]
        return self._commit(operation, parts, df.schema, base=base, **extra)

    def append(self, df: DataFrame, skip_empty: bool = False, **extra) -> Commit | None:
        """Add rows as a new version (Bronze); the row count is observed
        during the write and recorded in the commit summary.  With
        ``skip_empty`` an empty input commits nothing and returns the head
        (its empty folder is never linked; expiry removes it).  Columns the
        table does not have yet are added to its schema (NULL in older rows).
        A commit made meanwhile stays: the folder is linked after it."""
        if self.buckets:
            raise ValueError("append on a bucketed table: use merge")
        head = self.latest()
        rel, path = self._next_data_dir()
        seen = Observation("append")
        df.observe(seen, F.count(F.lit(1)).alias("records")).write.parquet(path)
        if skip_empty and not seen.get["records"]:
            return head
        summary = dict(extra.pop("summary", {}) or {})
        summary["records"] = str(seen.get["records"])
        extra["summary"] = summary
        return self._relink(
            "append", head,
            lambda h: (h.parts if h else []) + [rel],
            lambda h: df.schema if h is None else widen(T.StructType.fromJson(json.loads(h.schema)), df.schema),
            **extra)

    def merge(
        self,
        updates: DataFrame,
        keys: list[str] | None = None,
        order: list[Column] | None = None,
        *,
        combine=None,
        operation: str = "merge",
        files_per_bucket: int = 1,
        **extra,
    ) -> Commit | None:
        """Upsert ``updates`` into the table, rewriting only touched buckets.

        ``order=None`` is the plain MERGE (update rows replace target rows;
        update keys must be unique, else ``DuplicateSourceKeys``).  With ``order`` the merge is guarded: the
        newest row under ``order`` wins whichever side it is on.

        ``updates`` is computed once: it is written to a fresh folder under
        the session's checkpoint root (cutting its lineage, so a lost
        executor does not recompute the feed), and the set of buckets it
        touches is gathered as a metric of that same write, as bitmaps of
        4 KB per 32768 buckets.  Only those buckets of the target are read.
        Target slice and updates are then partitioned by bucket once; the
        latest-row window runs on (bucket, keys), which that partitioning
        already satisfies, and each task writes its buckets directly: a
        single shuffle.  ``combine(target_slice, updates)`` plugs in any
        other row algebra instead (one more shuffle to regroup by bucket).
        Returns the head unchanged when ``updates`` is empty.  New columns of
        ``updates`` are added to the table (NULL in older rows).  Where another
        writer committed meanwhile, the new buckets are linked after that
        commit, or, if it rewrote one of them, merged again onto its rows.
        """
        if not self.buckets:
            raise ValueError("merge needs a bucketed table")
        keys = list(keys or self.bucket_keys)
        if combine is None and not set(self.bucket_keys) <= set(keys):
            raise ValueError("merge keys must include the bucket keys")
        head = self.latest()
        updates = self._aligned(updates, head)
        stage = scratch_path(self.spark, "merge-staging")
        try:
            staged, touched, got = self._staged(updates, stage)
            if not touched:
                return head
            if combine is None and order is None:
                assert_unique(staged, keys)
            extra["summary"] = {**(extra.pop("summary", None) or {}), "touched_buckets": str(len(touched)),
                                "total_buckets": str(self.buckets), "change_rows": str(got["rows"])}
            while True:
                rel, schema = self._write_merge(head, staged, touched, keys, order, combine, files_per_bucket)
                base = self._bucket_map(head)
                # a bucket that lost all its rows has no folder
                written = self._buckets_in(rel)
                gone = set(touched) - written

                def relinked(h: Commit | None) -> list[str]:
                    now = self._bucket_map(h)
                    if any(now.get(b) != base.get(b) for b in touched):
                        raise CommitConflict(f"{self.root}: a touched bucket was rewritten meanwhile")
                    kept = {b: f for b, f in now.items() if b not in gone}
                    return _folders({**kept, **{b: [f"{rel}/{BUCKET_COL}={b}"] for b in written}})

                try:
                    return self._relink(operation, head, relinked,
                                        lambda h: schema if h is None else widen(
                                            T.StructType.fromJson(json.loads(h.schema)), schema), **extra)
                except CommitConflict:
                    newer = self.latest()
                    if newer is None or (head is not None and newer.version <= head.version):
                        raise
                    head = newer  # another writer changed a touched bucket: merge again, onto its state
        finally:
            # the staged change is only an input of this merge: once the merge
            # committed (or failed) it goes, so scratch does not grow per batch
            _FS(self.spark, stage).delete(stage)

    def _aligned(self, updates: DataFrame, head: Commit | None) -> DataFrame:
        """Bucket ids hash the stored key types: an int key and a long key
        of equal value hash apart, so the change gets the table's types first."""
        if head is None:
            return updates
        stored = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(head.schema)).fields}
        given = [(f.name, f.dataType) for f in updates.schema.fields]
        if all(c not in stored or t == stored[c] for c, t in given):
            return updates
        return updates.select(*[
            F.col(c).cast(stored[c]).alias(c) if c in stored and t != stored[c] else F.col(c)
            for c, t in given
        ])

    def _staged(self, updates: DataFrame, stage: str, *metrics: Column) -> tuple[DataFrame, list[int], dict]:
        """``updates`` written to ``stage`` and read from there, the buckets they touch, and what was
        observed in that write."""
        seen = Observation("merge_updates")
        bitmaps = bucket_bitmaps(bucket_of(self.bucket_keys, self.buckets), self.buckets)
        updates.observe(seen, F.count(F.lit(1)).alias("rows"), *bitmaps, *metrics).write.parquet(stage)
        got = seen.get
        touched = bitmap_ids([got[f"_bm{k}"] for k in range(len(bitmaps))]) if got["rows"] else []
        return self.spark.read.schema(updates.schema).parquet(stage), touched, got

    def keep_first(self, updates: DataFrame, first_by: str, keys: list[str] | None = None, *,
                   operation: str = "merge", files_per_bucket: int = 1, **extra) -> Commit | None:
        """The guarded merge under ``first_by`` ascending (NULLs last), for tables whose rows hardly ever
        change: same state as ``merge``, but rows of new keys are added to their buckets as a further
        folder, and only buckets in which an update came before the stored row are rewritten.  Of rows that tie the stored one stays.

        ``updates`` holds a key once.  Of the target only the keys and ``first_by`` are read, in the
        touched buckets and the range of the updates' keys (files outside it are skipped by their statistics);
        up to ``SMALL_CHANGE`` updates, only those whose hash is among the updates' are shuffled.
        So what a batch writes follows the batch, not the table.  Updates that change nothing commit nothing.
        Many batches leave many small folders, which ``compact`` puts together.
        """
        if not self.buckets:
            raise ValueError("keep_first needs a bucketed table")
        keys = list(keys or self.bucket_keys)
        if not set(self.bucket_keys) <= set(keys):
            raise ValueError("merge keys must include the bucket keys")
        order = [F.col(first_by).asc_nulls_last()]
        head = self.latest()
        if head is None:
            return self.merge(updates, keys, order, operation=operation, files_per_bucket=files_per_bucket, **extra)
        updates = self._aligned(updates, head)
        ranged = [f.name for f in updates.schema.fields if f.name in keys and isinstance(f.dataType, (T.IntegralType, T.StringType))]
        bounds = [f(k).alias(f"_{n}_{k}") for k in ranged for n, f in (("lo", F.min), ("hi", F.max))]
        bucket = bucket_of(self.bucket_keys, self.buckets)
        stage = scratch_path(self.spark, "merge-staging")
        try:
            staged, touched, got = self._staged(updates, stage, *bounds)
            if not touched:
                return head
            extra["summary"] = {**(extra.pop("summary", None) or {}), "touched_buckets": str(len(touched)),
                                "total_buckets": str(self.buckets), "change_rows": str(got["rows"])}
            while True:
                base = self._bucket_map(head)
                held = self._read_parts(head, _folders(base, touched))
                for k in ranged:  # a NULL key has no place in the range
                    held = held.filter(F.col(k).isNull() | F.col(k).between(F.lit(got[f"_lo_{k}"]), F.lit(got[f"_hi_{k}"])))
                if got["rows"] <= SMALL_CHANGE:  # few keys go to the stored ones, which then need no shuffle
                    held = held.join(F.broadcast(staged.select(F.xxhash64(*keys).alias("_h_hash"))),
                                     F.xxhash64(*keys) == F.col("_h_hash"), "left_semi")
                held = held.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.col(first_by).alias("_h_first"), F.lit(True).alias("_h_known"))
                same = F.lit(True)
                for k in keys:
                    same &= F.col(k).eqNullSafe(F.col(f"_h_{k}"))
                first, held_first = F.col(first_by), F.col("_h_first")
                change = (F.when(F.col("_h_known").isNull(), "new")
                          .when(first.isNotNull() & (held_first.isNull() | (first < held_first)), "earlier").otherwise("none"))
                # written once: the join is not made again for each kind of change
                seen = Observation("keep_first")
                bitmaps = bucket_bitmaps(F.when(F.col("_h_change") == "earlier", bucket), self.buckets)
                judged_at = f"{stage}-judged"
                (staged.join(held, same, "left").select(*staged.columns, change.alias("_h_change"))
                 .observe(seen, F.count(F.lit(1)).alias("rows"), *bitmaps).write.mode("overwrite").parquet(judged_at))
                judged = self.spark.read.schema(T.StructType([*staged.schema.fields, T.StructField("_h_change", T.StringType())])).parquet(judged_at)
                early = bitmap_ids([seen.get[f"_bm{k}"] for k in range(len(bitmaps))])
                rel, path = self._next_data_dir()
                fresh = judged.filter((F.col("_h_change") == "new") & ~bucket.isin(early)).drop("_h_change")
                self._write_bucketed(fresh, rel, path, files_per_bucket, len(touched))
                added = {b: [f"{rel}/{BUCKET_COL}={b}"] for b in self._buckets_in(rel)}
                rewritten, schema = {}, staged.schema
                if early:
                    changes = judged.filter((F.col("_h_change") != "none") & bucket.isin(early)).drop("_h_change")
                    other, schema = self._write_merge(head, changes, early, keys, order, None, files_per_bucket)
                    rewritten = {b: [f"{other}/{BUCKET_COL}={b}"] for b in early}
                if not added:
                    self._fs.delete(path)
                if not added and not rewritten:
                    return head

                def relinked(h: Commit | None) -> list[str]:
                    now = self._bucket_map(h)
                    if any(now.get(b) != base.get(b) for b in touched):
                        raise CommitConflict(f"{self.root}: a touched bucket was changed meanwhile")
                    return _folders({**now, **{b: now.get(b, []) + f for b, f in added.items()}, **rewritten})

                try:
                    return self._relink(operation, head, relinked,
                                        lambda h: widen(T.StructType.fromJson(json.loads(h.schema)), schema), **extra)
                except CommitConflict:
                    newer = self.latest()
                    if newer is None or newer.version <= head.version:
                        raise
                    head = newer  # another writer changed a touched bucket: compare with its state
        finally:
            _FS(self.spark, stage).delete(stage)
            _FS(self.spark, stage).delete(f"{stage}-judged")

    def _write_merge(self, head: Commit | None, staged: DataFrame, touched: list[int], keys: list[str],
                     order: list[Column] | None, combine, files_per_bucket: int) -> tuple[str, T.StructType]:
        """Write the merged rows of the touched buckets; their folder and schema."""
        current = self._bucket_map(head)
        schema = staged.schema if head is None else widen(T.StructType.fromJson(json.loads(head.schema)), staged.schema)
        if head is not None:
            target = self._read_parts(head, _folders(current, touched), schema)
        else:
            target = self.spark.createDataFrame([], schema)
        rel, path = self._next_data_dir()
        if combine is not None:
            merged = combine(target, staged)
            self._write_bucketed(merged, rel, path, files_per_bucket, len(touched))
        else:
            merged = self._merge_rows(target, staged, keys, order, len(touched), files_per_bucket)
            merged.write.partitionBy(BUCKET_COL).parquet(path)
            merged = merged.drop(BUCKET_COL)
        return rel, merged.schema

    def _merge_rows(self, target: DataFrame, updates: DataFrame, keys: list[str],
                    order: list[Column] | None, n_touched: int, files_per_bucket: int) -> DataFrame:
        """Newest row per key over target slice + updates, clustered by
        bucket with one exchange; the latest-row window runs inside it."""
        from strata.operators.dedup import latest_per_key

        src = "_strata_src"
        both = target.withColumn(src, F.lit(0)).unionByName(
            updates.withColumn(src, F.lit(1)), allowMissingColumns=True)
        both, cols = self._cluster(both, n_touched, files_per_bucket, keys)
        # updates win ties, so the plain MERGE is "updates first"
        rank = [*(order or []), F.col(src).desc()]
        window_keys = [c for c in cols if c not in keys] + list(keys)
        return latest_per_key(both, window_keys, rank).drop(src, SUB_COL)

    # ---------------------------------------------------------- maintenance
    def compact(self, target_file_bytes: int = 134_217_728, min_input_files: int = 5) -> dict:
        """Small-file compaction (J1): rewrite into files of about
        ``target_file_bytes``; skipped below ``min_input_files``.

        An append table rewrites only its folders of small files (average
        below 3/4 of the target), so a daily run reads the day's small
        commits, not the whole log.  A bucketed table is rewritten
        only in the buckets holding more files than their size calls for
        (a merge replaces a bucket's folders, so only ``keep_first`` fragments buckets):
        per-bucket file counts and bytes come from Spark's file listing, at
        most one row per bucket reaches the driver, and the other buckets are
        re-linked untouched.  A daily run over a large, healthy table then
        rewrites nothing.
        """
        head = self.latest()
        if head is None:
            return {"status": "missing", "rewritten_files": 0, "added_files": 0}
        if self.buckets:
            return self._compact_buckets(head, target_file_bytes, min_input_files)
        # append table: only folders whose files average below 3/4 of the
        # target are rewritten; folders of large files stay linked as they are
        per_folder = (
            self._file_listing()
            .select(F.regexp_extract("path", "/(data/[^/]+)/[^/]+$", 1).alias("part"), "length")
            .groupBy("part")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
            .collect()
        )
        small = {r["part"]: r for r in per_folder if r["bytes"] < r["files"] * 0.75 * target_file_bytes}
        n_files = sum(r["files"] for r in small.values())
        if n_files < min_input_files:
            return {"status": "skipped", "rewritten_files": 0, "added_files": 0}
        total = sum(r["bytes"] for r in small.values())
        out_files = max(1, math.ceil(total / target_file_bytes))
        rel, path = self._next_data_dir()
        self._read_parts(head, [p for p in head.parts if p in small]).repartition(out_files).write.parquet(path)

        def relinked(h: Commit) -> list[str]:
            if not set(small) <= set(h.parts):
                raise CommitConflict(f"{self.root}: a compacted folder was replaced meanwhile")
            return [p for p in h.parts if p not in small] + [rel]

        self._relink("compact", head, relinked, lambda h: T.StructType.fromJson(json.loads(h.schema)),
                     keep_mark=True, summary={"rewritten_files": str(n_files)})
        return {"status": "compacted", "rewritten_files": n_files, "added_files": self._files_in(rel)}

    def _files_in(self, rel: str) -> int:
        """Data files under one data folder."""
        return (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                .option("recursiveFileLookup", "true").load(f"{self.root}/{rel}").select("path").count())

    def _compact_buckets(self, head: Commit, target_file_bytes: int, min_input_files: int) -> dict:
        per_bucket = (
            self._file_listing()
            .select(F.regexp_extract("path", f"/{BUCKET_COL}=([0-9]+)/", 1).cast("int").alias("b"), "length")
            .groupBy("b")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
            .collect()
        )
        n_files = sum(r["files"] for r in per_bucket)
        if n_files < min_input_files:
            return {"status": "skipped", "rewritten_files": 0, "added_files": 0}
        wanted = {r["b"]: max(1, math.ceil(r["bytes"] / target_file_bytes)) for r in per_bucket}
        frag = sorted(r["b"] for r in per_bucket if r["files"] > wanted[r["b"]])
        if not frag:
            return {"status": "skipped", "rewritten_files": 0, "added_files": 0}
        rewritten = sum(r["files"] for r in per_bucket if r["b"] in set(frag))
        current = self._bucket_map(head)
        rel, path = self._next_data_dir()
        # slices per bucket from the average, not the largest: the shuffle has
        # (buckets or touched buckets) x slices partitions, so one outsized bucket
        # must not multiply the partition count; total output stays ~ bytes / target
        frag_bytes = sum(r["bytes"] for r in per_bucket if r["b"] in set(frag))
        slices = max(1, math.ceil(frag_bytes / target_file_bytes / len(frag)))
        keyed, _ = self._cluster(self._read_parts(head, _folders(current, frag)), len(frag), slices)
        keyed.drop(SUB_COL).write.partitionBy(BUCKET_COL).parquet(path)

        def relinked(h: Commit) -> list[str]:
            now = self._bucket_map(h)
            if any(now.get(b) != current[b] for b in frag):
                raise CommitConflict(f"{self.root}: a compacted bucket was rewritten meanwhile")
            return _folders({**now, **{b: [f"{rel}/{BUCKET_COL}={b}"] for b in frag}})

        self._relink("compact", head, relinked, lambda h: T.StructType.fromJson(json.loads(h.schema)), keep_mark=True,
                     summary={"rewritten_files": str(rewritten), "rewritten_buckets": str(len(frag))})
        return {"status": "compacted", "rewritten_files": rewritten, "added_files": self._files_in(rel)}

    def expirable(self, older_than: datetime, retain_last: int) -> DataFrame:
        """Versions older than ``older_than`` beyond the ``retain_last`` newest.

        Versions are dense (expiry only ever removes a prefix) and commit
        times rise with them, so the newest ``retain_last`` are the versions
        above ``head - retain_last``: a plain filter on the log that Spark
        reads in parallel, with no ordering of the log.
        """
        head = self._head_version()
        if head is None:
            return self.spark.createDataFrame([], "version long")
        return (
            self.history()
            .filter((F.col("version") <= F.lit(head - retain_last))
                    & (F.col("committed_at") < ts_literal(older_than)))
            .select("version")
        )

    def expire(self, older_than: datetime, retain_last: int = 10) -> dict:
        """Snapshot expiry (J2): drop old log entries and the data folders no
        retained version references.

        The expired versions form a prefix of the log, so one aggregate gives
        its bounds; the folders the retained versions still link are found by
        Spark from the log itself.  Only bounded metadata reaches the driver:
        two version numbers and the names of referenced data folders.
        """
        lo, hi = self.expirable(older_than, retain_last).agg(
            F.min("version"), F.max("version")).first()
        if hi is None:
            return {"expired_versions": 0, "deleted_data_dirs": 0}
        referenced = {
            r[0] for r in self._log_frame()
            .filter(F.col("version") > F.lit(hi))
            .select(F.explode(F.concat(F.coalesce("parts", F.array().cast("array<string>")),
                                       F.coalesce(F.map_keys("layout"), F.array().cast("array<string>"))))
                    .alias("part"))
            .select(F.split(F.col("part"), "/").getItem(1).alias("folder"))
            .distinct()
            .collect()
        }
        for v in range(lo, hi + 1):
            self._fs.delete(self._entry(v))
        deleted = 0
        for name in self._fs.list_names(f"{self.root}/data"):
            if name not in referenced and int(name.split("-")[0]) <= hi:
                self._fs.delete(f"{self.root}/data/{name}")
                deleted += 1
        return {"expired_versions": hi - lo + 1, "deleted_data_dirs": deleted}


# -------------------------------------------------------------------- probe
def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """Table-exists probe (A8): catalog name or versioned-table folder.  Only
    absence is reported as False; other errors propagate."""
    if "/" in name_or_path:
        return VersionedTable(spark, name_or_path).exists()
    return spark.catalog.tableExists(name_or_path)
