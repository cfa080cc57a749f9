"""Helpers shared by the text operators: folders on shared storage, lineage cuts, row locators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from moundlake.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path below the folder every executor shares (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex[:12]}"


def put_down(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: a lineage cut that
    survives the loss of executors."""
    path = shared_path(df.sparkSession, tag)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._llm_path = path  # so that drop_table can remove it
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a table written by :func:`put_down` that no later plan reads."""
    path = getattr(df, "_llm_path", None)
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def text_or_empty(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def _plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` is one file scan with deterministic projections and filters only, so that a row's place in its file tells
    it apart. Anything that multiplies or makes rows (explode, join, union, grouping) is not."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        if not node.deterministic():
            return False
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def with_locator(df: DataFrame, file_col: str = "_llm_file", row_col: str = "_llm_row") -> DataFrame:
    """Add the place of each row: file and row number inside it. Frames that are no plain
    Parquet scan are first written to the shared folder, so that the place is stable and no two rows share one."""
    def located(d: DataFrame) -> DataFrame:
        return d.select("*", F.col("_metadata.file_path").alias(file_col), F.col("_metadata.row_index").alias(row_col))
    if _plain_scan(df):
        try:
            return located(df)
        except AnalysisException:  # a scan of another format, or a column that hides the scan's own
            pass
    return located(put_down(df, "staged"))


def worker_store(name: str) -> dict:
    """A dictionary that outlives the task in a Python worker Spark uses again. The package is shipped by value, so its
    own globals start anew with every task; what a worker keeps hangs on a module of its own. Callers bound its size."""
    import sys
    import types
    holder = sys.modules.setdefault("_moundlake_worker", types.ModuleType("_moundlake_worker"))
    return holder.__dict__.setdefault(name, {})
