"""Boards and cards as tables: top-k, best per type, rank, unions, stacks,
percentile ranks, league position (O1-O4, W6, W9, W10, U1-U7, P32, P33)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moundlake.functions.columns import normalise_range
from moundlake.operators.joins import broadcast_if_small
from moundlake.schemas import HISTOGRAM_PITCH_TYPES as BEST_PITCH_TYPES
from moundlake.session import cut_lineage


def _ordered(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def top_k(df: DataFrame, order: Sequence[Column | str], k: int, min_col: str | None = None,
          min_value: float | None = None, strict: bool = True) -> DataFrame:
    """O2: optional minimum sample, then the first k rows by ``order`` (a distributed
    TakeOrderedAndProject: each task keeps k rows, the driver merges k x tasks)."""
    src = df
    if min_col is not None:
        src = src.filter(F.col(min_col) > min_value if strict else F.col(min_col) >= min_value)
    return src.orderBy(*_ordered(order)).limit(k)


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key after a total order (deterministic, T7). Planned with a
    map-side group limit, so a hot key keeps one row per task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*_ordered(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def best_per_type(df: DataFrame, type_col: str, grade: str, id_col: str, count_col: str,
                  min_count: int = 150, types: Sequence[str] | None = BEST_PITCH_TYPES) -> DataFrame:
    """O3: among rows of the listed types (no totals row) with count >= min_count, the highest grade per type (tie:
    lowest id), sorted by grade desc."""
    src = df.filter(F.col(count_col) >= min_count)
    if types is not None:
        src = src.filter(F.col(type_col).isin(list(types)))
    best = first_per_group(src, [type_col], [F.desc(grade), F.asc(id_col)])
    return best.orderBy(F.desc(grade), F.asc(type_col))


def ranked(df: DataFrame, order: Sequence[Column | str], k: int | None = None,
           rank_col: str = "rank") -> DataFrame:
    """W9 + O4: printed rank 1..n by ``order`` (give a unique tie-break), optional top k.

    With ``k`` the ranking is a distributed top-k followed by a window over k
    rows; without it, a global rank needs one ordered task, so only use it on
    aggregated (bounded) tables such as 30 teams."""
    src = df.orderBy(*_ordered(order)).limit(k) if k is not None else df
    w = Window.orderBy(*_ordered(order))
    return src.withColumn(rank_col, F.row_number().over(w))


def stack_frames(frames: Mapping[str, DataFrame], label: str = "kind") -> DataFrame:
    """Vertical concat with a literal label column; missing columns -> null."""
    out = None
    for name, f in frames.items():
        g = f.withColumn(label, F.lit(name))
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of same-schema frames, then full-row distinct."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """U4: one row per key, chosen deterministically by ``order`` (not 'any row')."""
    return first_per_group(df, key, order)


def percentile_ranks(long: DataFrame, by: Sequence[str], value: str = "value",
                     flip: str | None = None, alias: str = "percentile") -> DataFrame:
    """W10 (S22): round(100 x percent_rank) of each value among its (season, metric) group, descending for flipped
    (lower-is-better) metrics. A missing value has no percentile and does not count; a (season, metric) group never sits in one task
    (``sequence.percent_ranks``)."""
    from moundlake.operators.sequence import percent_ranks
    out = percent_ranks(long, by, value, flip, "_pr")
    return out.withColumn(alias, F.round(F.col("_pr") * 100).cast("int")).drop("_pr")


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
                    name: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(metrics), name, value)


def league_position(long: DataFrame, ranges: DataFrame, keys: Sequence[str],
                    value: str = "value", fallback: tuple[float, float] = (0.8, 1.2)) -> DataFrame:
    """Position of each metric value inside its league range,
    (v - lo) / (hi - lo), flipped for lower-is-better metrics. Metrics without an
    explicit range use [0.8, 1.2] x the league average. The range table is
    bounded by (metric x pitch type) and is broadcast."""
    r = cut_lineage(ranges.select(*keys, "avg", "lo", "hi", "flip"))  # computed once, then sized and joined
    j = long.join(broadcast_if_small(r), list(keys), "left")
    lo = F.coalesce(F.col("lo"), F.col("avg") * fallback[0])
    hi = F.coalesce(F.col("hi"), F.col("avg") * fallback[1])
    return j.withColumn("position", normalise_range(value, lo, hi, F.coalesce(F.col("flip"), F.lit(False))))


def complete_pairs(stacked: DataFrame, key: Sequence[str], label: str, labels: Sequence[str]) -> DataFrame:
    """Rows of the keys that have every one of ``labels``, from a stacked frame with one row per key and label."""
    w = Window.partitionBy(*key)
    return stacked.filter(F.col(label).isin(list(labels))).withColumn("_n", F.count(F.lit(1)).over(w)) \
        .filter(F.col("_n") == len(labels)).drop("_n")


def actual_projection_pair(actual: DataFrame, projected: DataFrame, key: Sequence[str],
                           stats: Sequence[str], label: str = "row_label") -> DataFrame:
    """Two rows per key, actual and projection, for the chosen stats; only keys
    present on both sides are kept (the card needs both). Each side is read once."""
    both = stack_frames({"actual": actual.select(*key, *stats), "projection": projected.select(*key, *stats)}, label)
    return complete_pairs(both, key, label, ["actual", "projection"])


def pitching_line(game_log: DataFrame, pitches: DataFrame, *, player: str = "player_id",
                  pitcher: str = "pitcher_id", game: str = "game_id", swing: str = "swing",
                  whiff: str = "whiff", description: str = "play_description") -> DataFrame:
    """A3 + S6: the per-game pitching line (renamed IP, PA, ER, H, K, BB, HR) with the
    pitch-level Whiff%, Strike% and pitch count of the same pitcher and game."""
    from moundlake.operators.summary import game_line
    rates = game_line(pitches, [pitcher, game], swing=swing, whiff=whiff, description=description)
    log = game_log.select(F.col(player).alias(pitcher), game, "date", "opponent",
                          F.col("innings_pitched").alias("IP"), F.col("batters_faced").alias("PA"),
                          F.col("earned_runs").alias("ER"), F.col("hits").alias("H"),
                          F.col("strikeouts").alias("K"), F.col("walks").alias("BB"),
                          F.col("home_runs").alias("HR"))
    return log.join(rates, [pitcher, game], "left")
