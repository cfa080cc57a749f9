"""Aggregations A1-A23 and windows W2/W3.

All aggregations are single ``groupBy``/grouping-set passes: Spark does the
partial (map-side) aggregation before the one exchange, so per-key volume
never crosses the network, and a hot key only costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def share_of_total(g: DataFrame, count_col: str, by: Sequence[str] = (),
                   alias: str = "_total") -> DataFrame:
    """Attach the partition total of ``count_col`` to aggregated rows.

    With partition keys this is a partitioned window. Without keys it is a
    one-row global aggregate broadcast back (size bound: exactly one row), never
    an unpartitioned window that would pull every row into one task. The small
    aggregated rows are checkpointed first, so the input is scanned once."""
    if by:
        return g.withColumn(alias, F.sum(count_col).over(Window.partitionBy(*by)))
    # the aggregated rows feed both sides: written once so the input is scanned once
    from moundlake.session import cut_lineage
    g = cut_lineage(g)
    tot = g.agg(F.sum(count_col).alias(alias))
    return g.crossJoin(F.broadcast(tot))


def arsenal_summary(df: DataFrame, group_cols: Sequence[str], metrics: Mapping[str, str],
                    count_col: str = "is_pitch", share_by: Sequence[str] = ("pitcher_id",),
                    digits: int | Mapping[str, int] | None = 1, share_digits: int | None = 3,
                    ) -> DataFrame:
    """A1 + W2 + O1: per group count of non-null ``count_col`` (T28), rounded means,
    and the share of the ``share_by`` partition total (T27), sorted by share desc.

    The share window runs on the already aggregated rows (one row per group), so
    it never sees raw-row volume; its partition keys are a subset of the
    grouping keys, so AQE reuses the aggregation's partitioning.
    """
    def d(name):
        return digits.get(name) if isinstance(digits, Mapping) else digits

    aggs = [F.count(count_col).alias("pitches")]
    aggs += [_round(F.avg(F.col(src)), d(name)).alias(name) for name, src in metrics.items()]
    g = df.groupBy(*group_cols).agg(*aggs)
    w = Window.partitionBy(*share_by)
    share = F.col("pitches") / F.sum("pitches").over(w)
    return (g.withColumn("proportion", _round(share, share_digits))
             .orderBy(F.desc("proportion"), *[F.asc_nulls_last(c) for c in group_cols]))


def arsenal_rates(df: DataFrame, by: Sequence[str], *, pitch: str = "is_pitch",
                  swing: str = "swing", whiff: str = "whiff", strike: str = "is_strike",
                  zone: str = "zone", means: Mapping[str, str] = (),
                  woba: str | None = None, xwoba: str | None = None,
                  batted: str | None = None, digits: int | None = None,
                  total_by: Sequence[str] = ()) -> DataFrame:
    """A2: sums of pitch/swing/whiff/strike, means, Pitch%, Whiff%, Chase%, Zone%,
    wOBAcon/xwOBAcon, in one pass with conditional aggregates (no per-row scans).

    Chase% = swings with zone > 10 / pitches with zone > 10 (T5); undefined
    ratios are null (formatted as '--' only at presentation time)."""
    out_zone = F.col(zone) > 10
    in_zone = (F.col(zone) < 10) & F.col(pitch)
    aggs = [
        F.count_if(F.col(pitch)).alias("pitches"),  # the pitches, not the rows with a flag
        F.count_if(F.col(swing)).alias("swings"),
        F.count_if(F.col(whiff)).alias("whiffs"),
        F.count_if(F.col(strike)).alias("strikes"),
        F.count_if(in_zone).alias("in_zone"),
        F.count_if(out_zone).alias("out_zone"),
        F.count_if(out_zone & F.col(swing)).alias("chases"),
    ]
    aggs += [_round(F.avg(src), digits).alias(name) for name, src in dict(means).items()]
    if woba is not None:
        bb = F.col(batted) if batted else F.lit(True)
        aggs.append(_round(F.avg(F.when(bb, F.col(woba))), digits).alias("wobacon"))
    if xwoba is not None:
        bb = F.col(batted) if batted else F.lit(True)
        aggs.append(_round(F.avg(F.when(bb, F.col(xwoba))), digits).alias("xwobacon"))
    g = share_of_total(df.groupBy(*by).agg(*aggs), "pitches", total_by)
    return g.select(
        *[c for c in g.columns if c != "_total"],
        _round(F.try_divide(F.col("pitches"), F.col("_total")), digits).alias("pitch_pct"),
        _round(F.try_divide(F.col("whiffs"), F.col("swings")), digits).alias("whiff_pct"),
        _round(F.try_divide(F.col("chases"), F.col("out_zone")), digits).alias("chase_pct"),
        _round(F.try_divide(F.col("in_zone"), F.col("pitches")), digits).alias("zone_pct"),
    ).orderBy(F.desc("pitches"), *[F.asc_nulls_last(c) for c in by])


def game_line(df: DataFrame, by: Sequence[str] = (), *, swing: str = "swing",
              whiff: str = "whiff", description: str = "play_description",
              strike_descriptions: Sequence[str] | None = None, pitch: str = "is_pitch",
              digits: int | None = None) -> DataFrame:
    """A3: Whiff% (0 when no swings), Strike% (0 when no pitches) and total pitches over the frame (or per key)."""
    from moundlake.schemas import STRIKE_DESCRIPTIONS
    sd = list(strike_descriptions or STRIKE_DESCRIPTIONS)
    g = df.groupBy(*by).agg(
        F.count_if(F.col(pitch)).alias("pitches"),
        F.count_if(F.col(swing)).alias("swings"),
        F.count_if(F.col(whiff)).alias("whiffs"),
        F.count_if(F.col(description).isin(sd)).alias("strikes"),
    )
    return g.select(
        *by, "pitches",
        _round(F.when(F.col("swings") > 0, F.col("whiffs") / F.col("swings") * 100).otherwise(0.0),
               digits).alias("whiff_pct"),
        _round(F.when(F.col("pitches") > 0, F.col("strikes") / F.col("pitches") * 100).otherwise(0.0), digits)
        .alias("strike_pct"),
    )


def pitcher_type_totals(df: DataFrame, keys: Sequence[str], type_col: str = "pitch_type",
                        value: str = "stuff_plus", game: str = "game_id",
                        all_label: str = "All", approx_games: bool = False) -> DataFrame:
    """Pitcher totals and per-type totals in ONE aggregation with grouping sets;
    the totals row gets ``pitch_type = 'All'``. One shuffle instead of two + union."""
    games = F.approx_count_distinct(game) if approx_games else F.count_distinct(game)
    g = df.groupingSets([list(keys), [*keys, type_col]], *keys, type_col).agg(
        F.count(value).alias("pitches"),
        games.alias("games"),
        F.avg(value).alias(value),
        F.grouping(type_col).alias("_g"),
    )
    return g.withColumn(type_col, F.when(F.col("_g") == 1, F.lit(all_label)).otherwise(F.col(type_col))).drop("_g")


def type_quantiles(df: DataFrame, by: Sequence[str], value: str,
                   levels: Sequence[float] = (0.001, 0.999), min_count: int | None = None,
                   count_col: str | None = None) -> DataFrame:
    """Mean, sample std, median, min, max and exact (linear) quantiles per group.

    Quantile columns are named by their true level (T15): q0_1, q99_9 ... Missing values (null, NaN) are left
    out. The moments are partial aggregates; the median and the quantiles come from ``exact_quantiles``
    (ranked counts), so a pitch type holding a third of all pitches is never one task's buffer."""
    from moundlake.operators.sequence import exact_quantiles, join_groups, missing
    src = df if min_count is None else df.filter(F.col(count_col) >= min_count)
    names = [_level_name(q) for q in levels]
    v = F.when(~missing(value), F.col(value))
    mom = src.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                               F.min(v).alias("min"), F.max(v).alias("max"))
    qs = exact_quantiles(src, by, value, [0.5, *levels], ["median", *names])
    return join_groups(mom, qs, list(by), "left").select(*by, "n", "mean", "std", "median", "min", "max", *names)


def _level_name(q: float) -> str:
    s = f"{q * 100:.4f}".rstrip("0").rstrip(".").replace(".", "_")
    return f"q{s}"


def role_cube(df: DataFrame, team: str, role: str, value: str, all_label: str = "All") -> DataFrame:
    """Team means overall and split by role (SP/RP) in one CUBE pass."""
    g = df.cube(team, role).agg(F.avg(value).alias("mean_value"), F.count(value).alias("n"),
                                F.grouping(team).alias("_gt"), F.grouping(role).alias("_gr"))
    return g.select(
        F.when(F.col("_gt") == 1, F.lit(all_label)).otherwise(F.col(team).cast("string")).alias(team),
        F.when(F.col("_gr") == 1, F.lit(all_label)).otherwise(F.col(role)).alias(role),
        "mean_value", "n")


def first_by_time(df: DataFrame, key: Sequence[str], value: str, order: Sequence[str],
                  alias: str = "first_value") -> DataFrame:
    """Value of the earliest row per key (tie-break by the later order columns).

    ``min_by`` is a partial aggregate, so hot keys combine map-side."""
    return df.groupBy(*key).agg(F.min_by(F.col(value), F.struct(*order)).alias(alias))


def home_road_pivot(df: DataFrame, team: str, is_home: str, value: str) -> DataFrame:
    """Mean by team for home (true) and road (false) as two columns."""
    return (df.groupBy(team).pivot(is_home, [True, False]).agg(F.avg(value))
              .withColumnRenamed("true", "home_mean").withColumnRenamed("false", "road_mean"))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 2,
                absolute: bool = True) -> DataFrame:
    """All pairwise Pearson correlations in ONE aggregation, then unpivoted to
    (row, col, corr)."""
    pairs = [(a, b) for a in cols for b in cols]
    aggs = [F.corr(a, b).alias(f"{a}__{b}") if a != b else F.lit(1.0).alias(f"{a}__{b}")
            for a, b in pairs]
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"),
                                         F.col(f"{a}__{b}").alias("corr")) for a, b in pairs]))
    long = wide.select(stack.alias("s")).select("s.*")
    v = F.abs(F.col("corr")) if absolute else F.col("corr")
    return long.withColumn("corr", _round(v, digits))


def zone_values(df: DataFrame, zone: str = "zone", value: str = "delta_run_exp",
                hand: str = "p_throws", zones: Sequence[int] = tuple(range(1, 15)),
                skip: Sequence[int] = (10,), all_label: str = "All") -> DataFrame:
    """Run value summed by zone for all pitchers and per hand (ROLLUP on hand),
    right-joined to the zone x hand dimension so empty zones show 0."""
    from moundlake.session import cut_lineage
    # zones x (hands + 1) rows, written once: they give the run values and the hands
    g = cut_lineage(_zone_sums(df, zone, value, hand, zones))
    spark = df.sparkSession
    hands = (g.where((F.col("_gh") == 0) & F.col(hand).isNotNull()).select(hand).distinct()
              .unionByName(spark.createDataFrame([(all_label,)], [hand])))
    sums = (g.filter(F.col(zone).isin(list(zones)))
             .select(zone, F.when(F.col("_gh") == 1, F.lit(all_label)).otherwise(F.col(hand)).alias(hand), "run_value"))
    ztype = df.schema[zone].dataType.simpleString()
    dim = spark.createDataFrame([(int(z),) for z in zones if z not in set(skip)], f"{zone} {ztype}")
    grid = F.broadcast(dim).crossJoin(hands)  # zones x (#hands + 1): tiny, bounded by the zone list
    return (sums.join(grid, [zone, hand], "right")
                .select(zone, hand, F.coalesce(F.col("run_value"), F.lit(0.0)).alias("run_value")))


def _zone_sums(df: DataFrame, zone: str, value: str, hand: str, zones: Sequence[int]) -> DataFrame:
    """Run value per zone and per (zone, hand) in one pass; rows outside ``zones`` count in a null zone, so that a hand
    that never pitches inside them is still known."""
    z = F.when(F.col(zone).isin(list(zones)), F.col(zone)).alias(zone)
    return df.select(z, hand, value).groupingSets([[zone], [zone, hand]], zone, hand).agg(
        F.sum(value).alias("run_value"), F.grouping(hand).alias("_gh"))


def location_ellipse(df: DataFrame, by: Sequence[str], x: str = "px", y: str = "pz",
                     min_count: int = 5, total_by: Sequence[str] = ()) -> DataFrame:
    """Centre, share and covariance ellipse per group.

    Eigenvalues of [[a, b], [b, c]] in closed form (ascending, T20):
    l = (a+c)/2 -/+ sqrt(((a-c)/2)^2 + b^2); width/height = 2 sqrt(l);
    angle = direction of the smaller eigenvector, mod 180. Null when count < min_count
    or when the covariance is undefined (1-row groups, T21)."""
    g = df.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("x_mean"), F.avg(y).alias("y_mean"),
        F.var_samp(x).alias("var_x"), F.var_samp(y).alias("var_y"),
        F.covar_samp(x, y).alias("cov_xy"))
    a, b, c = F.col("var_x"), F.col("cov_xy"), F.col("var_y")
    half = (a + c) / 2
    r = F.sqrt(((a - c) / 2) * ((a - c) / 2) + b * b)
    l_small, l_big = half - r, half + r
    # eigenvector of the smaller eigenvalue: (b, l - a), or axis-aligned when b == 0
    ang = F.when(b != 0, F.degrees(F.atan2(l_small - a, b))).otherwise(
        F.when(a <= c, F.lit(0.0)).otherwise(F.lit(90.0)))
    ok = (F.col("n") >= min_count) & a.isNotNull()
    g = share_of_total(g, "n", total_by)
    return g.select(
        *by, "n", "x_mean", "y_mean",
        (F.col("n") / F.col("_total")).alias("share"),
        F.when(ok, 2 * F.sqrt(F.greatest(l_small, F.lit(0.0)))).alias("width"),
        F.when(ok, 2 * F.sqrt(F.greatest(l_big, F.lit(0.0)))).alias("height"),
        F.when(ok, F.pmod(ang, F.lit(180.0))).alias("angle"),
    )


def league_rollup(df: DataFrame, type_col: str, means: Mapping[str, str], *, swing: str = "swing",
                  whiff: str = "whiff", in_zone: str = "in_zone", out_zone: str = "out_zone",
                  chase: str = "chase", value: str = "delta_run_exp", woba: str | None = None,
                  all_label: str = "All") -> DataFrame:
    """Per-type league table with an 'All' row (ROLLUP): means, counts, usage,
    whiff, zone and chase rates, run value per 100 pitches (negated)."""
    aggs = [F.count(F.lit(1)).alias("pitch")]
    aggs += [F.avg(src).alias(name) for name, src in means.items()]
    aggs += [F.sum(F.col(value)).alias(value),
             F.count_if(F.col(swing)).alias("swing"), F.count_if(F.col(whiff)).alias("whiff"),
             F.count_if(F.col(in_zone)).alias("in_zone"), F.count_if(F.col(out_zone)).alias("out_zone"),
             F.count_if(F.col(chase)).alias("chase")]
    if woba:
        aggs.append(F.avg(woba).alias("xwoba"))
    aggs.append(F.grouping(type_col).alias("_g"))
    from moundlake.session import cut_lineage
    g = cut_lineage(df.rollup(type_col).agg(*aggs))  # one row per type + 1: read twice below
    tot = g.filter(F.col("_g") == 1).select(F.col("pitch").alias("_total"))  # the one grand-total row
    g = g.crossJoin(F.broadcast(tot))
    return g.select(
        F.when(F.col("_g") == 1, F.lit(all_label)).otherwise(F.col(type_col)).alias(type_col),
        *[c for c in g.columns if c not in (type_col, "_g", "_total")],
        (F.col("pitch") / F.col("_total")).alias("pitch_usage"),
        F.try_divide(F.col("whiff"), F.col("swing")).alias("whiff_rate"),
        F.try_divide(F.col("in_zone"), F.col("pitch")).alias("in_zone_rate"),
        F.try_divide(F.col("chase"), F.col("out_zone")).alias("chase_rate"),
        (F.lit(-100.0) * F.col(value) / F.col("pitch")).alias("delta_run_exp_per_100"),
    )


def median_order(df: DataFrame, category: str, value: str) -> DataFrame:
    """Median per category (skew-safe exact quantile), joined back for ordering
    (one row per category, so the join is broadcast by AQE)."""
    from moundlake.operators.sequence import exact_quantiles, join_groups
    med = exact_quantiles(df, [category], value, [0.5], ["category_median"])
    return join_groups(df, med, [category], "left")


def std_grains(df: DataFrame, value: str, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Sample std of ``value`` at several grains (e.g. pitch, pitcher, team).

    Each grain is averaged first, then the std is taken over those means; one row
    per grain name. All grains come from ONE pass: a grouping-sets aggregation
    (the empty set gives the row-level std directly), checkpointed because it is
    small and read once per grain."""
    from moundlake.session import cut_lineage
    names = list(grains)
    sets = [list(grains[n]) for n in names]
    keys = sorted({k for ks in sets for k in ks})
    if not keys:
        return df.agg(F.stddev_samp(value).alias("std"), F.count(value).alias("n")) \
                 .select(F.lit(names[0]).alias("grain"), "std", "n")
    gid = F.grouping_id(*keys).alias("_gid")
    g = cut_lineage(df.groupingSets(sets, *keys).agg(
        F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"), F.count(value).alias("_c"), gid))
    out = None
    for name, ks in zip(names, sets):
        want = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in ks)
        rows = g.filter(F.col("_gid") == want)
        if ks:
            one = rows.agg(F.stddev_samp("_m").alias("std"), F.count("_m").alias("n"))
        else:
            one = rows.select(F.col("_s").alias("std"), F.col("_c").alias("n"))
        one = one.select(F.lit(name).alias("grain"), "std", "n")
        out = one if out is None else out.unionByName(one)
    return out


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of nulls per column, long form."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in cols]))
    return wide.select(stack.alias("s")).select("s.*")


def mean_count(df: DataFrame, value: str) -> DataFrame:
    """Sample size and floored mean of a count column."""
    return df.agg(F.count(value).alias("n"), F.floor(F.avg(value)).alias("mean_floor"))


def rolling_mean(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                 values: Mapping[str, str], window: int = 50, newest_first: bool = False) -> DataFrame:
    """W3 + W7 (+W8): trailing mean over ``window`` rows, null until the window is full and while it holds a
    missing value, oldest first; ``seq`` is the row number inside the partition. One batter holding a third of all rows is
    spread over many tasks (``sequence.trailing_means``)."""
    from moundlake.operators.sequence import trailing_means
    out = trailing_means(df, partition, order, values, window).withColumn("seq", F.col("seq").cast("int"))
    return out.orderBy(*partition, F.desc("seq")) if newest_first else out
