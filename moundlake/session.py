"""Session helpers.

Cluster settings (``spark.checkpoint.dir``, shuffle partitions, memory) come
from the session the caller already has. Defaults are only filled in where the
setting is unset, which is the case in tests and local benches.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "moundlake") -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("MOUNDLAKE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, taken from ``spark.checkpoint.dir``.

    Only when the session names none (local tests) is a scratch folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster[...] has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(lineage cuts must survive executor loss)")
        conf = tempfile.mkdtemp(prefix="moundlake-ckpt-")  # local mode only (tests, bench)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back (survives executor loss).

    The rows are computed once and lie there once, as Parquet: nothing is held in executor storage beside them, and a reader
    takes only the columns it needs. What Parquet cannot hold (equal column names, columns without a type, intervals) is
    checkpointed."""
    folder = checkpoint_dir(df.sparkSession)
    if not _parquet_holds(df.schema):
        held = df.persist(StorageLevel.MEMORY_AND_DISK)  # else a reliable checkpoint computes its input twice
        try:
            return held.checkpoint(eager=True)
        finally:
            held.unpersist()
    path = f"{folder.rstrip('/')}/moundlake-cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _parquet_holds(schema: T.StructType) -> bool:
    def holds(t: T.DataType) -> bool:
        if isinstance(t, T.StructType):
            names = [f.name.lower() for f in t.fields]
            return bool(names) and len(set(names)) == len(names) and all(holds(f.dataType) for f in t.fields)
        if isinstance(t, T.ArrayType):
            return holds(t.elementType)
        if isinstance(t, T.MapType):
            return holds(t.keyType) and holds(t.valueType)
        return not isinstance(t, T.NullType) and "interval" not in t.typeName()
    return holds(schema)
