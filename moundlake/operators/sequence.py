"""Order inside groups without putting a group into one task: exact ranks and quantiles of
values, row numbers, trailing means.

A window ``partitionBy(group)`` sorts each group inside one task, so a group holding a third of the
rows is a third of the job on one core. Here rows are range-partitioned on (group, order) and
written to the shared checkpoint folder. A group then lies in neighbouring partitions; what a partition needs
from the ones before it is one number for each group that crosses a boundary (at most two rows per partition, so
that table is bounded by the partition count and broadcast), and everything else is a window over
one partition's slice of a group.

Values are ranked on their counts (one row per group and distinct value, combined before the
shuffle), so a hot value is one row. Null group keys are a group of their own. A missing value (null or NaN)
has no rank, is no part of a quantile, and makes every trailing mean whose window holds it null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moundlake.session import cut_lineage

#: Rows of one group that a trailing-mean task holds (besides the window - 1 rows before them).
CHUNK_ROWS = 100_000


def missing(value: str) -> Column:
    return F.col(value).isNull() | F.isnan(F.col(value).cast("double"))


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null keys equal to each other; the key columns are the left side's."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = same if on is None else on & same
    if on is None:  # no keys: one row beside every row
        return left.crossJoin(F.broadcast(renamed))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _sliced(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned on (by, order) with the partition's number as ``_pid``, written down."""
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    return cut_lineage(df.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()))


def _carry(sliced: DataFrame, by: Sequence[str], rows: Column) -> DataFrame:
    """(_pid, by, _before, _all) of the groups that lie in several partitions: ``rows`` of the group in earlier
    partitions and in all. At most two rows per partition."""
    per = sliced.groupBy("_pid", *by).agg(F.sum(rows).alias("_s"))
    group = Window.partitionBy(*by)
    per = per.withColumns({"_before": F.sum("_s").over(group.orderBy("_pid")) - F.col("_s"),
                           "_all": F.sum("_s").over(group), "_parts": F.count(F.lit(1)).over(group)})
    return per.where("_parts > 1").select("_pid", *by, "_before", "_all")


def value_ranks(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per group and distinct present value: ``by``, ``value``, _count, _below (rows of the group with a
    smaller value) and _n (rows of the group with a value)."""
    by = list(by)
    counts = df.where(~missing(value)).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_count"))
    sliced = _sliced(counts, by, [value])
    carry = F.broadcast(_carry(sliced, by, F.col("_count")))
    slice_ = Window.partitionBy("_pid", *by)
    inside = sliced.withColumns({
        "_below": F.coalesce(F.sum("_count").over(slice_.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_count").over(slice_)})
    out = join_groups(inside, carry, ["_pid", *by], "left")
    return out.select(*by, value, "_count", (F.col("_below") + F.coalesce("_before", F.lit(0))).alias("_below"),
                      F.coalesce("_all", "_n").alias("_n"))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, levels: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (Spark ``percentile`` / SQL ``quantile_cont``) per group: the
    values at positions floor(h) and ceil(h), h = (n - 1) q, picked from the ranked counts in one aggregation.

    Returns one row per group that has a value, with one column per level."""
    by, names = list(by), list(names or [f"q{i}" for i in range(len(levels))])
    ranks = value_ranks(df.select(*by, F.col(value).cast("double").alias("_v")), by, "_v")

    def at(pos: Column) -> Column:
        return F.max(F.when((F.col("_below") <= pos) & (pos < F.col("_below") + F.col("_count")), F.col("_v")))

    picks = [F.max("_n").alias("_m")]
    for i, q in enumerate(levels):
        h = (F.col("_n") - 1) * F.lit(float(q))
        picks += [at(F.floor(h)).alias(f"_lo{i}"), at(F.ceil(h)).alias(f"_hi{i}")]
    got = ranks.groupBy(*by).agg(*picks)
    out = []
    for i, (q, name) in enumerate(zip(levels, names)):
        h = (F.col("_m") - 1) * F.lit(float(q))
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (h - F.floor(h))).alias(name))
    return got.select(*by, *out)


def percent_ranks(df: DataFrame, by: Sequence[str], value: str, flip: str | None = None,
                  alias: str = "percent_rank") -> DataFrame:
    """(rows of the group with a smaller value) / (n - 1), 0 in a group of one; with ``flip`` (a boolean
    column) true, rows with a larger value count instead. Missing values get null and are not in n."""
    by = list(by)
    ranks = value_ranks(df, by, value)
    j = join_groups(df, ranks, [*by, value], "left")
    before = F.col("_below")
    if flip is not None:
        before = F.when(F.col(flip), F.col("_n") - F.col("_below") - F.col("_count")).otherwise(before)
    rank = F.when(F.col("_n") > 1, before / (F.col("_n") - 1)).when(F.col("_n") == 1, F.lit(0.0))
    return j.withColumn(alias, rank).drop("_count", "_below", "_n")


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[str], seq: str = "seq") -> DataFrame:
    """1-based number of each row inside its group, in ``order`` (a total order, nulls first)."""
    by = list(by)
    sliced = _sliced(df, by, order)
    carry = F.broadcast(_carry(sliced, by, F.lit(1)))
    inside = Window.partitionBy("_pid", *by).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    out = join_groups(sliced.withColumn(seq, F.row_number().over(inside).cast("long")), carry, ["_pid", *by], "left")
    return out.withColumn(seq, F.col(seq) + F.coalesce("_before", F.lit(0))).drop("_pid", "_before", "_all")


def trailing_means(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Mapping[str, str],
                   window: int, seq: str = "seq") -> DataFrame:
    """Row number and, for each (name: column) of ``values``, the mean of the last ``window`` rows; null until the
    window is full and while it holds a missing value.

    Each group is cut into chunks of ``CHUNK_ROWS`` consecutive rows; the last window - 1 rows of a chunk are
    copied to the next one, so a chunk's window function needs no other row."""
    by = list(by)
    numbered = row_numbers(df, by, order, seq)
    size = max(CHUNK_ROWS, window)
    chunk = F.floor((F.col(seq) - 1) / size)
    late = (F.col(seq) - 1) % size >= size - (window - 1)
    places = F.when(late, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = numbered.withColumn("_own", chunk).withColumn("_chunk", F.explode(places))
    frame = Window.partitionBy(*by, "_chunk").orderBy(seq).rowsBetween(-(window - 1), Window.currentRow)
    means = {}
    for name, src in values.items():
        present = F.when(~missing(src), F.col(src))
        means[name] = F.when((F.col(seq) >= window) & (F.count(present).over(frame) == window), F.avg(present).over(frame))
    return spread.withColumns(means).where("_chunk = _own").drop("_own", "_chunk")


def first_by_hash(df: DataFrame, key: Sequence[str], n: int | None = None, share: float | None = None, seed: int = 42,
                  flag: str | None = None, prefix_bits: int = 16) -> DataFrame:
    """Exactly ``n`` rows, or exactly ceil(share * rows), chosen by the MD5 of (seed, key); the same rows on any partitioning.

    A histogram of the first ``prefix_bits`` bits of the hashes (at most 2^prefix_bits rows) finds the one bin that the cut falls into; only that bin's
    rows are ranked. All rows below it are taken by a filter, so no top-n passes through one task. Rows with equal
    keys have equal hashes and are told apart by nothing: pass a whole row key. With ``flag`` every row comes back with that
    boolean column instead of only the chosen rows."""
    if (n is None) == (share is None):
        raise ValueError("either n or share")
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in key]).cast("binary")
    hashed = df.withColumn("_hash", F.md5(text))
    digits = prefix_bits // 4
    hashed = hashed.withColumn("_bin", F.conv(F.substring("_hash", 1, digits), 16, 10).cast("int"))
    bins = sorted((r["_bin"], r["n"]) for r in hashed.groupBy("_bin").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(c for _, c in bins)
    want = min(total, n if share is None else -int(-share * total // 1))
    cut, before = -1, 0  # bins below ``cut`` are taken whole, ``want - before`` rows of bin ``cut``
    for b, c in bins:
        cut = b
        if before + c >= want:
            break
        before += c
    edge = cut_lineage(hashed.where(F.col("_bin") == cut).select("_hash"))  # a 2^prefix_bits-th of the rows
    last = edge.orderBy("_hash").offset(max(want - before - 1, 0)).limit(1).first() if want else None
    chosen = F.lit(False) if last is None else F.col("_hash") <= F.lit(last["_hash"])
    out = hashed.withColumn(flag, chosen) if flag else hashed.where(chosen)
    return out.drop("_hash", "_bin")
