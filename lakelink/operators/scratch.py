"""Shared intermediate tables: they cut lineage and outlive executors."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .buckets import give_back

_made: list[str] = []
#: Spark deletes the shuffle files of an execution that ends while this holds; otherwise they stay until the driver collects its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; in local mode a temporary one where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.conf.set("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='lakelink-')}")
    return root(spark)


def save(df: DataFrame, *partition_by: str, batch: int | None = None) -> DataFrame:
    """Write df once as a table in the shared folder and return the table. The shuffle files of the writing go at once. batch: rows that Python gets at a time, fewer for long texts."""
    path = f"{root(df.sparkSession)}/lakelink-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    own = {_CLEAN: "true"} | ({_BATCH: str(batch)} if batch else {})
    before = {k: conf.get(k, None) for k in own}
    for k, v in own.items():
        conf.set(k, v)
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    if not _made:
        atexit.register(drop_all)
    _made.append(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    saved._lakelink_path = path
    return saved


def drop(*tables: DataFrame | None) -> None:
    """Delete tables made by save() that no later step reads."""
    for df in tables:
        path = getattr(df, "_lakelink_path", None)
        if path:
            _delete(path)


def _delete(path: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and path in _made:
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        _made.remove(path)


def drop_all() -> None:
    for path in list(_made):
        try:
            _delete(path)
        except Exception:  # the session has ended; nothing is left to ask
            return


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that are no longer referenced."""
    gc.collect()
    give_back()
    spark.sparkContext._jvm.System.gc()
