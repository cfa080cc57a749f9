"""Distributions: park factor (M16), histogram (M17), letter values (M18),
1-D and 2-D Gaussian KDE (M19, M20), deterministic sample (M21).

KDEs are exact and linear: points are first reduced to distinct values (or
to bins, optionally) with their counts, then each distinct value is combined
with the evaluation grid (in two dimensions: with the grid points in the kernel's reach) and summed per grid point.
Work is at most |distinct| x |grid|, never points x points."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moundlake.functions.mathx import normal_cdf
from moundlake.operators.summary import first_by_time, home_road_pivot


#: Kernel deviations beyond which a point's contribution (below exp(-8.5^2 / 2) of its peak) is left out.
KERNEL_REACH = 8.5


def home_flag(df: DataFrame, game: str = "game_id", team: str = "pitcher_team",
              order: Sequence[str] = ("start_time", "ab_number", "index_play")) -> DataFrame:
    """Home team of a game = pitching team of its first pitch (T23); flag rows."""
    home = first_by_time(df, [game], team, order, alias="home_team")
    return df.join(home, game, "left").withColumn("pitcher_home", F.col(team) == F.col("home_team"))


def park_factor(df: DataFrame, team: str = "pitcher_team", is_home: str = "pitcher_home",
                value: str = "stuff_plus", center: float = 100.0, scale: float = 10.0) -> DataFrame:
    """M16 (A13): home and road means per team; z = (mean - 100) / 10;
    park factor = |Phi(z_home) / Phi(z_road)| x 100 (normal CDF as a native expression)."""
    p = home_road_pivot(df, team, is_home, value)
    zh = (F.col("home_mean") - center) / scale
    zr = (F.col("road_mean") - center) / scale
    return p.withColumn("park_factor", F.abs(normal_cdf(zh) / normal_cdf(zr)) * 100)


def histogram(df: DataFrame, value: str, lo: float = 60.0, hi: float = 140.0, bins: int = 40,
              by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins on [lo, hi], right edge closed; outside values dropped."""
    width = (hi - lo) / bins
    b = F.least(F.lit(bins - 1), F.floor((F.col(value) - lo) / width).cast("int"))
    return (df.filter((F.col(value) >= lo) & (F.col(value) <= hi))
              .groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("bin_lo", F.lit(lo) + F.col("bin") * width)
              .withColumn("bin_hi", F.col("bin_lo") + width))


def letter_values(df: DataFrame, value: str, by: Sequence[str], depth: int = 7) -> DataFrame:
    """Exact quantiles at 2^-i and 1 - 2^-i for i = 1..depth per category (long form)."""
    from moundlake.operators.sequence import exact_quantiles, join_groups, missing
    levels = sorted({0.5 ** i for i in range(1, depth + 1)} | {1 - 0.5 ** i for i in range(1, depth + 1)})
    names = [f"_q{i}" for i in range(len(levels))]
    q = exact_quantiles(df, by, value, levels, names)  # skew-safe exact quantiles
    n = df.where(~missing(value)).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    st = F.explode(F.arrays_zip(F.array(*[F.lit(x) for x in levels]).alias("level"),
                                F.array(*[F.col(c) for c in names]).alias("value")))
    return (join_groups(q, n, list(by)).select(*by, "n", st.alias("s"))
             .select(*by, "n", F.col("s.level").alias("level"), F.col("s.value").alias("value")))


def _grid(spark, name: str, lo: float, hi: float, points: int) -> DataFrame:
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    return spark.range(points).select(F.col("id").cast("int").alias(f"{name}_i"),
                                      (F.lit(lo) + F.col("id") * step).alias(name))


def kde_1d(df: DataFrame, value: str, lo: float, hi: float, points: int = 200,
           bw_factor: float = 0.8, by: Sequence[str] = (), bin_width: float | None = None) -> DataFrame:
    """Gaussian KDE with bandwidth h = bw_factor x sample std (per group).

    density(g) = sum_c count_c exp(-((g - v_c) / h)^2 / 2) / (n h sqrt(2 pi)).
    A distinct value adds to the grid points within ``KERNEL_REACH`` h of it; what lies beyond is below 1e-15 of the kernel's peak, and the
    work does not grow with the whole grid. ``bin_width`` pre-bins values (error <= bin_width / 2 per point) when the distinct count is
    too large; by default distinct values are used (exact). Null, NaN and infinite values are left out; a group without spread (fewer than two
    values, or all equal) has null densities."""
    from moundlake.operators.sequence import join_groups
    from moundlake.session import cut_lineage
    spark, by = df.sparkSession, list(by)
    v = F.col(value) if bin_width is None else (F.floor(F.col(value) / bin_width) + 0.5) * bin_width
    finite = F.abs(F.col(value).cast("double")) < float("inf")  # NaN is above infinity
    vals = df.filter(finite).groupBy(*by, v.cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    stats = cut_lineage(df.filter(finite).groupBy(*by).agg(  # one row per group, read for the values and for the grid
        F.count(value).alias("_n"), F.nullif(F.stddev_samp(value), F.lit(0.0)).alias("_sd")))
    step = (hi - lo) / (points - 1) if points > 1 else 1.0
    h = F.col("_sd") * bw_factor
    first = F.greatest(F.lit(0), F.ceil((F.col("_v") - KERNEL_REACH * h - lo) / step)).cast("int")
    last = F.least(F.lit(points - 1), F.floor((F.col("_v") + KERNEL_REACH * h - lo) / step)).cast("int")
    j = join_groups(vals, stats, by).withColumn("x_i", F.explode(F.when(first <= last, F.sequence(first, last))))
    away = (F.lit(lo) + F.col("x_i") * ((hi - lo) / (points - 1) if points > 1 else 0.0) - F.col("_v")) / h
    sums = j.groupBy(*by, "x_i").agg(F.sum(F.col("_c") * F.exp(-0.5 * away ** 2)).alias("_s"))
    grid = stats.crossJoin(F.broadcast(_grid(spark, "x", lo, hi, points)))  # groups x points rows of the result
    return join_groups(grid, sums, [*by, "x_i"], "left").select(
        *by, "x_i", "x", (F.coalesce("_s", F.lit(0.0)) / (F.col("_n") * h * math.sqrt(2 * math.pi))).alias("density"))


def kde_2d(df: DataFrame, x: str, y: str, x_range: tuple[float, float], y_range: tuple[float, float],
           points: int = 50, bw_adjust: float = 0.9, by: Sequence[str] = (),
           weight: str | None = None, bin_size: float | None = None, common: bool = False) -> DataFrame:
    """2-D Gaussian KDE with full covariance, Scott factor n^(-1/6) x bw_adjust.

    With ``common`` the densities of all groups together have mass 1, each its share of the rows; otherwise each group has mass 1.
    Kernel covariance H = f^2 S (S = sample covariance); the 2x2 inverse and
    determinant are closed form. Optional ``weight`` (unused by the reference).
    Distinct (x, y) pairs (or bins, ``bin_size``) with counts add to the grid points within ``KERNEL_REACH`` kernel
    deviations per axis; what lies beyond is below 1e-15 of the kernel's peak. The kernel narrows as rows are added, so a
    point meets ever fewer grid points."""
    spark = df.sparkSession
    src = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    wcol = F.col(weight) if weight else F.lit(1.0)
    stats = src.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.var_samp(x).alias("_a"),
                                 F.var_samp(y).alias("_d"), F.covar_samp(x, y).alias("_b"),
                                 F.sum(wcol).alias("_wsum"))
    f2 = F.pow(F.col("_n").cast("double"), F.lit(-1.0 / 3.0)) * (bw_adjust ** 2)
    stats = stats.select(*by, "_n", "_wsum", (F.col("_a") * f2).alias("_ha"), (F.col("_b") * f2).alias("_hb"),
                         (F.col("_d") * f2).alias("_hd"))
    stats = stats.withColumn("_det", F.col("_ha") * F.col("_hd") - F.col("_hb") ** 2)
    # distinct pairs (exact) or, with ``bin_size``, bin centres (error <= bin_size / 2 per axis)
    if bin_size:
        bx = (F.floor(F.col(x) / bin_size) + 0.5) * bin_size
        byy = (F.floor(F.col(y) / bin_size) + 0.5) * bin_size
    else:
        bx, byy = F.col(x), F.col(y)
    from moundlake.operators.sequence import join_groups
    from moundlake.session import cut_lineage
    vals = src.groupBy(*by, bx.alias("_x"), byy.alias("_y")).agg(F.sum(wcol).alias("_c"))
    if common:
        stats = stats.crossJoin(F.broadcast(stats.agg(F.sum("_wsum").alias("_mass"))))  # one row
    else:
        stats = stats.withColumn("_mass", F.col("_wsum"))
    stats = cut_lineage(stats)  # one row per group, read for the points and for the grid
    gx = _grid(spark, "gx", x_range[0], x_range[1], points)
    gy = _grid(spark, "gy", y_range[0], y_range[1], points)

    def near(value: str, variance: str, lo: float, hi: float) -> Column:
        """Grid indexes within the kernel's reach of a point; none if it is out of reach of the grid."""
        step = (hi - lo) / (points - 1) if points > 1 else 1.0
        reach = F.lit(KERNEL_REACH) * F.sqrt(variance)
        first = F.greatest(F.lit(0), F.ceil((F.col(value) - reach - lo) / step)).cast("int")
        last = F.least(F.lit(points - 1), F.floor((F.col(value) + reach - lo) / step)).cast("int")
        return F.when(first <= last, F.sequence(first, last))

    j = join_groups(vals, stats, list(by)).withColumn("gx_i", F.explode(near("_x", "_ha", *x_range))) \
        .withColumn("gy_i", F.explode(near("_y", "_hd", *y_range)))
    at = lambda i, lo, hi: F.lit(lo) + F.col(i) * ((hi - lo) / (points - 1) if points > 1 else 0.0)
    dx, dy = at("gx_i", *x_range) - F.col("_x"), at("gy_i", *y_range) - F.col("_y")
    q = (F.col("_hd") * dx * dx - 2 * F.col("_hb") * dx * dy + F.col("_ha") * dy * dy) / F.col("_det")
    sums = j.groupBy(*by, "gx_i", "gy_i").agg(F.sum(F.col("_c") * F.exp(-0.5 * q)).alias("_s"))
    grid = stats.crossJoin(F.broadcast(gx.crossJoin(gy)))  # groups x points^2 rows of the result
    return join_groups(grid, sums, [*by, "gx_i", "gy_i"], "left").select(
        *by, "gx_i", "gy_i", "gx", "gy",
        (F.coalesce("_s", F.lit(0.0)) / (F.col("_mass") * 2 * math.pi * F.sqrt("_det"))).alias("density"))


def mass_levels(density: DataFrame, by: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Per group and share the density threshold of the smallest region of cells that holds at least that share of the
    group's mass, as filled density plots draw them: cells by falling density, cumulated. One row per group and share; groups without mass
    have none. Cells of equal density count together, so the threshold does not depend on their order. A grid's cells are a bounded
    number per group (``points`` squared)."""
    by = list(by)
    cells = density.groupBy(*by, "density").agg(F.sum("density").alias("_m")).where("_m > 0")
    falling = Window.partitionBy(*by).orderBy(F.desc("density"))
    cells = cells.withColumns({"_cum": F.sum("_m").over(falling), "_all": F.sum("_m").over(Window.partitionBy(*by))})
    wanted = cells.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    reached = wanted.where(F.col("_cum") >= F.col("share") * F.col("_all") * (1 - 1e-9))
    return reached.groupBy(*by, "share").agg(F.max("density").alias("level"))


def deterministic_sample(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The n rows with the smallest MD5 of (seed, key columns as text): stable across runs, partitionings and
    engines, without a top-n in one task (``sequence.first_by_hash``). ``key`` must tell rows apart."""
    from moundlake.operators.sequence import first_by_hash
    return first_by_hash(df, [key] if isinstance(key, str) else list(key), n=n, seed=seed)
