"""Sinks (S19, S20): Parquet/CSV tables partitioned by year, bucketed tables, and model persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Files a task keeps open at once when it writes its rows as they come; beyond them it sorts its rows.
OPEN_FILES = 32


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("year",),
                mode: str = "overwrite", gather: bool = True) -> None:
    """Write a table; partitioned by year when the column exists (partition pruning
    for every board that reads one season). Without ``gather`` no row is exchanged: every task writes a file to each partition
    value it holds, which suits a few values (up to ``OPEN_FILES``, written without sorting the task's rows) and large tasks."""
    parts = [c for c in partition_by if c in df.columns]
    # one task per (part of a) partition value instead of every task writing to every folder; a large
    # partition is split by size at run time
    out = df.hint("rebalance", *[F.col(c) for c in parts]) if parts and gather else df
    w = out.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "csv":
        w = w.option("header", True)
    w = w.format(fmt)
    if not parts or gather:
        w.save(path)
        return
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN_FILES)
    try:
        w.save(path)
    finally:
        conf.set(name, before)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, hot: float = 8.0) -> bool:
    """Save ``df`` as the table ``name`` (at ``path``, or in the warehouse), hashed by ``keys`` into ``buckets`` and sorted by them,
    so that groupings and equi-joins on the keys read it without an exchange. A bucket is read by one task; if the fullest one holds more than
    ``hot`` times the average, the table is saved without buckets and plans exchange its rows as usual, where the skew rule can split
    them. Returns whether it is bucketed. Null keys are one key."""
    sizes = df.groupBy(F.pmod(F.hash(*[F.col(c) for c in keys]), F.lit(buckets)).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    most, rows = sizes.agg(F.max("_n"), F.sum("_n")).first()  # one row
    even = rows is None or most <= hot * max(rows / buckets, 1)
    w = df.write
    if even:  # the same hash as the buckets': one task and one file per bucket
        w = df.repartition(buckets, *[F.col(c) for c in keys]).write.bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.mode("overwrite").format("parquet").saveAsTable(name)
    return even


def save_model(model, path: str) -> None:
    """Spark ML persistence (a pipeline model is a directory of Parquet + JSON)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
