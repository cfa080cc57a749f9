"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``bits`` bits (categories by hash, numbers by their logarithm), the
cell's index along the Hilbert curve is computed with a table-driven state machine inside Spark, rows are
ordered by (index, id) and the order is cut into runs of equal row counts (law ``rows``: counts at
most one apart). Neighbours on the curve are neighbours in every dimension, so a file of one run has
narrow minima and maxima in all of them and filters on any of them skip files.

DataFrame operations only. The global row number needs no single task: rows are range partitioned on
(index, id, size, checksum, row) and written; the counts of the partitions (one row each) give their
offsets, and the row number inside a partition is a window over that partition. A hot cell or a hot id
spreads over partitions because the last range key is unique.

Defined results: a null text has no bytes (size 1, checksum 0); a null dimension lies in cell 0 (numbers)
or in the cell of the null hash; equal and repeated rows take neighbouring places; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from moundlake.llm.common import drop_table, put_down, table


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next-state tables of the Hilbert curve in ``dims`` dimensions, from the Gray-code
    construction: a state is (entry corner, direction); index ``state << dims | cell``."""
    size, mask = 1 << dims, (1 << dims) - 1

    def rot_left(x: int, k: int) -> int:
        k %= dims
        return ((x << k) | (x >> (dims - k))) & mask

    def rot_right(x: int, k: int) -> int:
        return rot_left(x, dims - k % dims)

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    rank = {gray(i): i for i in range(size)}

    def entry(i: int) -> int:
        return 0 if i == 0 else gray(2 * ((i - 1) // 2))

    def trailing_ones(i: int) -> int:
        n = 0
        while i & 1:
            i, n = i >> 1, n + 1
        return n

    def direction(i: int) -> int:
        return 0 if i == 0 else trailing_ones(i - 1) % dims if i % 2 == 0 else trailing_ones(i) % dims

    digit, after = [0] * (size * dims * size), [0] * (size * dims * size)
    for e in range(size):
        for d in range(dims):
            for cell in range(size):
                w = rank[rot_right(cell ^ e, d + 1)]
                at = ((e * dims + d) << dims) | cell
                digit[at] = w
                after[at] = (e ^ rot_left(entry(w), d + 1)) * dims + (d + direction(w) + 1) % dims
    return digit, after


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Position along the curve of the cell with these coordinates (each 0 to 2**bits - 1)."""
    dims = len(cells)
    digit, after = curve_tables(dims)
    digits, states = F.array(*map(F.lit, digit)), F.array(*map(F.lit, after))

    def step(acc: Column, level: Column) -> Column:
        corner = F.lit(0)
        for k, c in enumerate(cells):
            corner = corner + _bit(c, bits, level) * F.lit(1 << k)
        at = (acc["state"] * F.lit(1 << dims) + corner).cast("int")
        return F.struct(F.get(states, at).alias("state"),
                        (acc["index"] * F.lit(1 << dims) + F.get(digits, at)).cast("long").alias("index"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), start, step, lambda acc: acc["index"])


def _bit(cell: Column, bits: int, level: Column) -> Column:
    """The bit of ``cell`` at ``level``, the highest first."""
    weight = F.get(F.array(*[F.lit(1 << (bits - 1 - i)) for i in range(bits)]), level)
    return F.floor(cell / weight).cast("int") % F.lit(2)


def category_cell(name: str, bits: int) -> Column:
    """Equal values share a coordinate, whatever their number."""
    return F.pmod(F.xxhash64(F.col(f"`{name}`")), F.lit(1 << bits)).cast("int")


def number_cell(value: Column, bits: int) -> Column:
    """Two steps per doubling; null in cell 0."""
    level = F.floor(2 * F.log2(F.greatest(value.cast("double"), F.lit(0.0)) + 1))
    return F.least(F.coalesce(level, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def assign_shards(docs: DataFrame, shards: int = 16, bits: int = 5, categories: tuple[str, ...] = ("source", "lang"),
                  numbers: tuple[str, ...] = ("n_chars",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, curve (index), shard, slot: every row of ``docs`` in one of ``shards`` runs."""
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)) + 1
    cells = [category_cell(c, bits) for c in categories] + [number_cell(F.col(f"`{c}`"), bits) for c in numbers]
    rows = put_down(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), size.cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")).alias("text_crc32"),
        hilbert_index(cells, bits).alias("curve"), F.monotonically_increasing_id().alias("uid")), "curve")
    order = ["curve", "doc_id", "size", "text_crc32", "uid"]
    ranged = put_down(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "runs")
    drop_table(rows)
    # one row for each range partition: a bounded table, cumulated in one task
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),
                            F.sum("n").over(Window.partitionBy()).alias("total"))
    placed = ranged.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(*order))) \
        .join(F.broadcast(offsets), "part").withColumn("place", F.col("before") + F.col("rank") - 1)
    return cut_runs(placed, shards).select("doc_id", "size", "text_crc32", "curve", "shard", "slot")


def cut_runs(placed: DataFrame, shards: int) -> DataFrame:
    """Shard and slot of the row at ``place`` (0 to ``total`` - 1): run k starts at floor(k * total / shards)."""
    run = placed.withColumn("shard", F.expr(f"cast(((place + 1) * {shards} - 1) div total as int)"))
    return run.withColumn("slot", F.expr(f"cast(place - (shard * total) div {shards} as long)"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, bits: int = 5, **columns) -> None:
    """Write ``docs`` as one folder per shard, rows sorted along the curve, so that the files' minima and
    maxima prune on every dimension. Every row is written once, whatever its id: the places are found for row numbers given here."""
    rows = put_down(docs.withColumn("_llm_uid", F.monotonically_increasing_id()), "shard-rows")
    at = assign_shards(rows, shards, bits, **(columns | {"id_col": "_llm_uid"}))
    at = at.select(F.col("doc_id").alias("_llm_uid"), F.col("shard").alias("_llm_shard"), F.col("slot").alias("_llm_slot"))
    (rows.join(at, "_llm_uid").drop("_llm_uid").repartitionByRange(shards * 4, "_llm_shard", "_llm_slot")
     .sortWithinPartitions("_llm_shard", "_llm_slot").drop("_llm_slot")
     .write.partitionBy("_llm_shard").parquet(path))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 16 runs of the curve over source, language and length (contract of operator 4)."""
    return assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")
