"""Reading the tables, naming columns, shipping the package to workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(folder, f)
                    z.write(p, os.path.relpath(p, os.path.dirname(top)))
    spark.sparkContext.addPyFile(name)
    _SHIPPED.add(app)


def release() -> None:
    """Hand freed memory back to the system.  A Python worker is kept for later tasks, and what its allocators hold on to counts
    against the executor meanwhile."""
    import gc

    gc.collect()
    trim()


def trim() -> None:
    """``release`` without looking for cycles: cheap enough after every group of rows."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it keeps
        pass


def release_driver(spark: SparkSession) -> None:
    """``release`` in the driver and its JVM, between stages and rounds of many small jobs.  The driver's Python would keep what a
    stage collected for good, and a JVM heap that grew by garbage (plans, task events) gives nothing back before its next full collection."""
    release()
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:  # a remote session has none
        jvm.System.gc()


def lean(run):
    """A function of one group or cogroup (Spark counts its parameters) after which freed memory goes back."""
    def one(t):
        out = run(t)
        trim()
        return out

    def two(left, right):
        out = run(left, right)
        trim()
        return out

    return one if run.__code__.co_argcount == 1 else two


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def id_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so further
    columns of the input can't clash with an operator's own."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one number, from one scan."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
