"""Targets: run value (M24 = J1/J2 -> P6 -> J3 -> P9) and whiff."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moundlake.functions.columns import recode
from moundlake.operators.joins import broadcast_if_small
from moundlake.schemas import DESCRIPTION_OUTCOME


def expand_run_values_by_hand(rv: DataFrame, factors: Mapping[str, tuple[float, float]] | None = None,
                              hands: Sequence[str] = ("L", "R")) -> DataFrame:
    """Hand-split run-value table from the plain one: every (pitcher_hand, batter_hand)
    pair; events in ``factors`` are scaled by (same-hand factor, other-hand factor).
    (The reference's adjusted table is the plain one with strikeout and
    swinging-strike rows x1.5 same hand and x2.0 other hand.)"""
    spark = rv.sparkSession
    pairs = spark.createDataFrame([(p, b) for p in hands for b in hands], "pitcher_hand string, batter_hand string")
    out = rv.crossJoin(F.broadcast(pairs))  # rv x 4: bounded by the run-value table
    if factors:
        same = F.col("pitcher_hand") == F.col("batter_hand")
        f = None
        for ev, (fs, fd) in factors.items():
            cond = F.col("event") == ev
            val = F.when(same, F.lit(fs)).otherwise(F.lit(fd))
            f = F.when(cond, val) if f is None else f.when(cond, val)
        out = out.withColumn("delta_run_exp", F.col("delta_run_exp") * F.coalesce(f, F.lit(1.0)))
    return out.select("event", "pitcher_hand", "batter_hand", "balls", "strikes", "delta_run_exp")


def run_value_target(df: DataFrame, run_values: DataFrame, *, event: str = "event_type",
                     description: str = "play_description", count_keys: Sequence[str] = ("balls", "strikes"),
                     hand_keys: Sequence[str] = (), event_map: Mapping[str, str | None] | None = None,
                     description_map: Mapping[str, str | None] = DESCRIPTION_OUTCOME,
                     target: str = "target") -> DataFrame:
    """Run value by (event, count[, hands]); where that finds nothing, by the
    recoded description (``outcome``, a new column: T12); target = first non-null.

    The run-value table is bounded (events x counts x hand pairs) and is broadcast
    after a size check, so the pitch table is never shuffled for these lookups.
    ``event_map`` (off by default, T13) recodes events before the first lookup."""
    keys = list(count_keys) + list(hand_keys)
    # the looked-up run value replaces any run-value column the pitch rows carry
    df = df.drop("delta_run_exp", "delta_run_exp_des", "outcome", target)
    rv = broadcast_if_small(run_values.select("event", *keys, "delta_run_exp"))
    ev = recode(event, event_map) if event_map else F.col(event)
    left = df.withColumns({"_ev": ev, "outcome": recode(description, description_map)})
    j1 = left.join(rv.withColumnRenamed("event", "_ev"), ["_ev", *keys], "left")
    rv2 = rv.select(F.col("event").alias("outcome"), *keys, F.col("delta_run_exp").alias("delta_run_exp_des"))
    j2 = j1.join(rv2, ["outcome", *keys], "left")
    return j2.withColumn(target, F.coalesce("delta_run_exp", "delta_run_exp_des")).drop("_ev")


def whiff_target(df: DataFrame, *, swing: str = "is_swing", whiff: str = "is_whiff",
                 description: str = "play_description", lookup_keys: Sequence[str] = ("balls", "strikes"),
                 target: str = "target") -> DataFrame:
    """1 when the batter swung and missed else 0 (null flags -> 0, P25).

    The reference also left-joins a distinct (description, count, flags) table on
    three keys, which fans rows out; here the right side is made unique on its keys
    first, so the join cannot multiply rows (J15)."""
    look = (df.groupBy(description, *lookup_keys)
              .agg(F.max(F.col(swing).cast("int")).alias(f"{swing}_whiff"),
                   F.max(F.col(whiff).cast("int")).alias(f"{whiff}_whiff")))
    out = df.withColumn("outcome", recode(description, DESCRIPTION_OUTCOME))
    out = out.join(look, [description, *lookup_keys], "left")
    s = F.coalesce(F.col(swing).cast("int"), F.lit(0))
    w = F.coalesce(F.col(whiff).cast("int"), F.lit(0))
    return out.withColumn(target, F.when((s == 1) & (w == 1), 1).otherwise(0))
