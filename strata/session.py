"""Session construction and the shared scratch location.

Scratch data (intermediate tables, lineage cuts, streaming checkpoints) always
goes under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (unit tests, a laptop) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults a user of the library would set on any cluster: adaptive execution
# (runtime coalescing and skew-join splitting), a fixed session zone so that
# zone-less and zoned timestamps never silently shift, no web UI, and an
# off-heap state store for streaming state.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # streaming state (message dedup, windowed counts) lives in RocksDB off
    # the JVM heap and checkpoints only its changes, so large state neither
    # pressures executor memory nor rewrites itself every micro-batch
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(
    app_name: str = "strata",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    catalog: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session.

    ``catalog`` optionally wires a table-format catalog (for example an Iceberg
    REST catalog) the way a deployment would:
    ``{"name": "lake", "impl": "org.apache.iceberg.spark.SparkCatalog",
    "type": "rest", "uri": ..., "warehouse": ...}``.  The jars must already be on
    the classpath; without a catalog every table is a versioned Parquet table.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if catalog:
        name = catalog["name"]
        settings[f"spark.sql.catalog.{name}"] = catalog.get(
            "impl", "org.apache.iceberg.spark.SparkCatalog"
        )
        for key, value in catalog.items():
            if key not in ("name", "impl"):
                settings[f"spark.sql.catalog.{name}.{key}"] = value
        if "extensions" in catalog:
            settings["spark.sql.extensions"] = catalog["extensions"]
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    return spark


_LOCAL_ROOT: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; when unset (tests on a ``local`` master only) a
    private folder is created once per session and registered as the checkpoint
    dir.  A cluster has to name a folder that all its executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_ROOT:
        _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_ROOT[key])
    return _LOCAL_ROOT[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (``local[n]``)."""
    memory = os.environ.get("STRATA_DRIVER_MEMORY", "8g")
    return get_session(
        "strata-local",
        master=f"local[{cores}]",
        conf={
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": memory,
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            "spark.ui.showConsoleProgress": "false",
        },
    )


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the checkpoint root and read it
    back: later uses scan the written files instead of recomputing the
    lineage, and a lost executor cannot force a recomputation either."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
