"""Exact de-duplication by a stateful stream with disk-backed keyed state.

Texts are equal when they are identical after every run of ASCII white space is replaced by one space.

``dedup_stream`` keeps, for every digest ever seen, the first row in the order of the stable
identifier (with the locator of its content: file and row) and the number of arrivals. The state lives
in RocksDB, has no watermark and never expires, so a row that arrives years later still meets its
copy; a restarted query goes on from its checkpoint.

``dedup_exact`` runs a whole table through that stream, reads the state back, and compares the full
bytes of every hit with the content at the state's locator. Rows whose digest is equal but whose bytes
are not are grouped again by their whole text, so a colliding digest costs work, never a row.

DataFrame operations only. Rows of one digest are combined before the shuffle (partial aggregation);
joins of rows with the state have one state row per digest, so a hot digest is split by the
skew-join rule.

Defined results: a null text counts as empty; the row with the smallest ``doc_id`` stays (null ids
last, then the place of the row decides, so repeated rows keep exactly one); an empty table gives no
rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moundlake.llm.common import drop_table, put_down, shared_path, table, text_or_empty, with_locator

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Copies that are compared with one copy of their group's content; a larger group is cut into parts.
GROUP_PART = 256
#: Native memory that the open state stores of one executor share.
STATE_CACHE_MB = "128"
#: What the state keeps of the row that stays; ordered, so that min() finds it.
KEEPER = ("no_id", "doc_id", "file", "row")


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _state_settings(spark: SparkSession):
    """Disk-backed state; no preallocated log space, which would cost megabytes for each of many small stores. An executor's stores share
    one bounded cache, and each is closed with its task instead of minutes later: their native memory lies beside the heap and the
    Python workers, and a store is open for every partition otherwise."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
              "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
              "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": STATE_CACHE_MB,
              "spark.sql.streaming.stateStore.unloadOnCommit": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup_stream(arrivals: DataFrame, checkpoint: str, digest_col: str = "digest"):
    """Start the stateful query over a stream of (digest, doc_id, file, row).

    Keyed state per digest: the smallest (doc_id, file, row) and the number of arrivals. Returns the
    running query; its state is read with :func:`state_of`. It ends when everything that has arrived is
    taken in and can be started again on the same checkpoint."""
    spark = arrivals.sparkSession
    keyed = arrivals.groupBy(F.col(digest_col).alias("digest")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")).alias("keeper"),
        F.count(F.lit(1)).alias("n"))
    with _state_settings(spark):
        return (keyed.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                .option("checkpointLocation", checkpoint).start())


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stream's state as a table: digest, keeper (struct), n."""
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.names
    return state.select(F.col("key")["digest"].alias("digest"), F.col("value")[value[0]].alias("keeper"),
                        F.col("value")[value[1]].alias("n"))


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per row of ``docs``: file, row (its place), doc_id, digest, keep_id, keep_file, keep_row,
    group_size, kept. ``digest`` maps the normalised text to a string."""
    return _dedup(with_locator(docs), id_col, text_col, digest)


def _dedup(located: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    spark = located.sparkSession
    rows = located.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                          F.col("_llm_file").alias("file"), F.col("_llm_row").alias("row"))
    rows = rows.withColumn("text", normalised(text_or_empty("text")))
    arrivals = put_down(rows.select("doc_id", "file", "row", digest(F.col("text")).alias("digest")), "arrivals")

    checkpoint = shared_path(spark, "dedup-state")
    stream = spark.readStream.schema(arrivals.schema).parquet(arrivals._llm_path)
    dedup_stream(stream, checkpoint).awaitTermination()
    with _state_settings(spark):
        state = put_down(state_of(spark, checkpoint), "dedup-groups")

    placed = arrivals.join(state, "digest").select(
        "doc_id", "file", "row", "digest", F.col("keeper.doc_id").alias("keep_id"),
        F.col("keeper.file").alias("keep_file"), F.col("keeper.row").alias("keep_row"), "n",
        ((F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))).alias("kept"))

    unequal = _full_bytes(rows, placed)
    if unequal.isEmpty():
        drop_table(unequal)
        return placed.withColumnRenamed("n", "group_size")
    return _regroup(placed, unequal)


def _full_bytes(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows that hit a digest of the state but whose whole text differs from the content at its locator."""
    parts = F.ceil(F.col("n") / GROUP_PART).cast("int")
    hits = put_down(placed.where("n > 1").select("file", "row", "keep_file", "keep_row", "kept", "digest", parts.alias("parts")), "hits")
    # one plan at every size: the hits grow with the data, so their join is never left to a broadcast
    texts = rows.select("file", "row", "text").join(hits.hint("merge"), ["file", "row"])
    # a group meets its content in parts, the content once for each: no task holds a large group
    copies = texts.where("not kept").withColumn("part", F.pmod(F.xxhash64("file", "row"), F.col("parts")).cast("int"))
    content = texts.where("kept").select(F.col("file").alias("keep_file"), F.col("row").alias("keep_row"), F.col("text").alias("content"),
                                         F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return put_down(copies.join(content.hint("merge"), ["keep_file", "keep_row", "part"]).where("text != content")
                    .select("file", "row", "digest", "text"), "collisions")


def _regroup(placed: DataFrame, unequal: DataFrame) -> DataFrame:
    """Groups of rows whose digest collided: by their whole text; the state's group loses them."""
    lost = unequal.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    mine = unequal.join(placed.select("file", "row", "doc_id"), ["file", "row"])
    groups = mine.groupBy("digest", "text").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")).alias("own"),
        F.count(F.lit(1)).alias("own_n"))
    own = put_down(mine.join(groups, ["digest", "text"]).select("file", "row", "own", "own_n"), "regrouped")
    both = placed.join(lost, "digest", "left").join(own, ["file", "row"], "left")
    other = F.col("own").isNotNull()
    pick = lambda a, b: F.when(other, F.col(a)).otherwise(F.col(b))
    return both.select(
        "doc_id", "file", "row", "digest", pick("own.doc_id", "keep_id").alias("keep_id"),
        pick("own.file", "keep_file").alias("keep_file"), pick("own.row", "keep_row").alias("keep_row"),
        F.when(other, F.col("own_n")).otherwise(F.col("n") - F.coalesce("lost", F.lit(0))).alias("group_size"),
        F.when(other, (F.col("own.file") == F.col("file")) & (F.col("own.row") == F.col("row")))
        .otherwise(F.col("kept")).alias("kept"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: every column of the row that stays of each group of equal texts."""
    located = with_locator(docs)  # staged once where ``docs`` is no plain scan; the places below are those of this frame
    kept = _dedup(located, id_col, text_col, sha256).where("kept").select(
        F.col("file").alias("_llm_file"), F.col("row").alias("_llm_row"))
    return located.join(kept, ["_llm_file", "_llm_row"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all ``documents`` (contract of operator 10)."""
    found = dedup_exact(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLE_OP10 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
     g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
