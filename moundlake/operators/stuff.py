"""Pitch-quality ("plus") scale, grades, models and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moundlake.functions.columns import clip, pitch_position
from moundlake.operators.joins import broadcast_if_small, next_season
from moundlake.operators.sequence import exact_quantiles
from moundlake.operators.summary import corr_matrix, pitcher_type_totals, type_quantiles
from moundlake.session import cut_lineage
from moundlake.schemas import (
    GRADE_CENTER, GRADE_HI, GRADE_LO, GRADE_PITCH_TYPES, GRADE_SCALE, MIN_PITCHES_TYPE_STATS, MIN_PITCHES_YOY,
    PLUS_CENTER, PLUS_SCALE, STARTER_PITCHES_PER_GAME,
)


def plus_scale(df: DataFrame, value: str = "target", reference: Column | None = None,
               alias: str = "stuff_plus", invert: bool = True) -> DataFrame:
    """Z-score against the mean and sample std of a reference subset (e.g. a
    season), applied to every row; plus = 100 - 10 z (lower run value is better),
    or 100 + 10 z with ``invert=False``.

    The statistics are one global aggregate (one row), broadcast back."""
    ref = df if reference is None else df.filter(reference)
    stats = ref.agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    z = (F.col(value) - F.col("_mean")) / F.col("_std")
    plus = F.lit(PLUS_CENTER) - z * PLUS_SCALE if invert else F.lit(PLUS_CENTER) + z * PLUS_SCALE
    return df.crossJoin(F.broadcast(stats)).withColumn(alias, plus).drop("_mean", "_std")


def pitcher_year_scores(df: DataFrame, keys: Sequence[str] = ("pitcher_id", "year"),
                        value: str = "stuff_plus") -> DataFrame:
    """Pitch count and mean plus score per (pitcher, year)."""
    return df.groupBy(*keys).agg(F.count(value).alias("count"), F.avg(value).alias(value))


def pitch_grades(df: DataFrame, keys: Sequence[str] = ("pitcher_id", "year"),
                 type_col: str = "pitch_type", value: str = "stuff_plus", game: str = "game_id",
                 min_pitches: int = MIN_PITCHES_TYPE_STATS,
                 starter_ppg: float = STARTER_PITCHES_PER_GAME,
                 types: Sequence[str] | None = GRADE_PITCH_TYPES) -> DataFrame:
    """A8 + A9 + M15 (+P30): pitcher totals ('All') and per-type rows from one
    grouping-sets pass; per-type distribution of the group means (groups with at
    least ``min_pitches``) gives mean and a robust std (p99.9 - p0.1) / 6; grade =
    clip(50 + 10 (x - mean) / std, 20, 80); SP/RP from the pitcher's totals row
    keyed by (pitcher, year) (T22).

    The type-statistics table has one row per pitch type (bounded by the type
    vocabulary) and is broadcast; the grades never reshuffle the grouped rows."""
    # the grouped rows feed three branches (type statistics, SP/RP, grades): written once
    # to the shared checkpoint folder so the pitch table is aggregated exactly once
    tot = cut_lineage(pitcher_type_totals(df, keys, type_col=type_col, value=value, game=game))
    stats = type_quantiles(tot, [type_col], value, levels=(0.001, 0.999), min_count=min_pitches, count_col="pitches")
    stats = stats.select(type_col, F.col("mean").alias("type_mean"),
                         ((F.col("q99_9") - F.col("q0_1")) / 6).alias("type_std"))
    pos = (tot.filter(F.col(type_col) == "All")
              .select(*keys, pitch_position("pitches", "games", starter_ppg).alias("position")))
    if types is None:
        g = tot.join(broadcast_if_small(stats), type_col, "inner")  # one row per pitch type, size-checked
    else:  # the types of the grade table bound the statistics: at most one row for each
        listed = F.col(type_col).isin(list(types))
        g = tot.filter(listed).join(F.broadcast(stats.filter(listed)), type_col, "inner")
    grade = clip(F.lit(GRADE_CENTER) + GRADE_SCALE * F.try_divide(F.col(value) - F.col("type_mean"),
                                                                    F.col("type_std")), GRADE_LO, GRADE_HI)
    return g.withColumn("pitch_grade", grade).join(pos, list(keys), "left")


def year_over_year(scores: DataFrame, results: DataFrame, key: str, season: str,
                   score_cols: Sequence[str], result_cols: Sequence[str],
                   count_col: str | None = None, min_count: int = MIN_PITCHES_YOY,
                   digits: int | None = 2) -> DataFrame:
    """M22 (J5-J7 + A14): scores of season N joined to results of N and N+1 for
    the same player (min sample), then the absolute correlation matrix."""
    s = scores if count_col is None else scores.filter(F.col(count_col) >= min_count)
    results = cut_lineage(results)  # one row per player-season, read by both sides of the join
    nxt = next_season(results, key, season, result_cols, suffix="_next")
    j = s.join(nxt, [key, season], "inner")
    cols = list(score_cols) + list(result_cols) + [f"{c}_next" for c in result_cols]
    return corr_matrix(j, cols, digits=digits)


def robust_scale(df: DataFrame, features: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """M10 exactly: (x - median) / (third - first quartile) per feature. The quartiles of all features come from one
    ranked-counts pass over the long form; they are one row per feature. A feature without any value, or without a spread between
    its quartiles, has a null column: the schema does not depend on the data."""
    long = df.unpivot([], list(features), "_feature", "_value")
    q = {r["_feature"]: r for r in exact_quantiles(long, ["_feature"], "_value", [0.25, 0.5, 0.75], ["lo", "mid", "hi"]).collect()}
    scaled = {f"{f}{suffix}": F.try_divide(F.col(f) - F.lit(q[f].mid), F.lit(q[f].hi - q[f].lo)) if f in q else F.lit(None).cast("double")
              for f in features}
    return df.withColumns(scaled)


def gbt_pipeline(features: Sequence[str], label: str = "target", max_iter: int = 1000,
                 step_size: float = 0.01, max_depth: int = 5, subsample: float = 0.8,
                 feature_subset: str = "0.8", seed: int = 42, prediction: str = "prediction"):
    """M10 + M11: VectorAssembler -> RobustScaler(centred) -> GBTRegressor.

    Spark has no leaf-count or L1/L2 knobs, so scores agree with the reference's
    trees in rank, not in value. Trees are built distributed over partitions."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import RobustScaler, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    # rows with a missing feature are dropped by the caller (drop_missing), never silently here
    va = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error")
    sc = RobustScaler(inputCol="_raw", outputCol="_features", withCentering=True, withScaling=True)
    gbt = GBTRegressor(featuresCol="_features", labelCol=label, predictionCol=prediction,
                       maxIter=max_iter, stepSize=step_size, maxDepth=max_depth, minInstancesPerNode=20,
                       subsamplingRate=subsample, featureSubsetStrategy=feature_subset, seed=seed)
    return Pipeline(stages=[va, sc, gbt])


def feature_importance(model, features: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) sorted descending, from the fitted tree stage."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, imp)), key=lambda t: (-t[1], t[0]))
