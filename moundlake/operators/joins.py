"""Join helpers J1-J15: size-checked broadcast, suffixing, self joins, outer merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it is proven to hold at most this many rows and bytes.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only after counting the rows (a partial count per task, no rows move) and checking
    them against both bounds; a row's bytes are the schema's default width. Beyond the bounds the planner keeps its own
    choice (sort-merge / AQE). The count computes ``df`` once more, so pass small or written frames."""
    n = df.count()
    width = df._jdf.schema().defaultSize()
    return F.broadcast(df) if n <= max_rows and n * width <= max_bytes else df


def join_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                  suffix: str = "_right") -> DataFrame:
    """Join where overlapping non-key names on the right get ``suffix``."""
    overlap = (set(left.columns) & set(right.columns)) - set(on)
    r = right.select(*[F.col(f"`{c}`").alias(f"{c}{suffix}" if c in overlap else c) for c in right.columns])
    return left.join(r, list(on), how)


def next_season(df: DataFrame, key: str, season: str, cols: Sequence[str],
                suffix: str = "_next") -> DataFrame:
    """Each (key, season) row against the same key's next season (inner self join
    on season + 1). Both sides shuffle on ``key`` only once each."""
    nxt = df.select(F.col(key), (F.col(season) - 1).alias(season),
                    *[F.col(f"`{c}`").alias(f"{c}{suffix}") for c in cols])
    return df.join(nxt, [key, season], "inner")


def outer_merge(frames: Sequence[DataFrame], on: Sequence[str],
                suffixes: Sequence[str] | None = None) -> DataFrame:
    """Full outer merge of several tables on ``on``; overlapping value columns get
    the table's suffix; keys are coalesced."""
    suffixes = list(suffixes or [f"_{i}" for i in range(len(frames))])
    seen: dict[str, int] = {}
    for f in frames:
        for c in f.columns:
            if c not in on:
                seen[c] = seen.get(c, 0) + 1
    out = None
    for i, f in enumerate(frames):
        g = f.select(*[F.col(f"`{c}`").alias(c) if c in on or seen[c] == 1
                       else F.col(f"`{c}`").alias(f"{c}{suffixes[i]}") for c in f.columns])
        out = g if out is None else out.join(g, list(on), "full_outer")
    return out


def parent_lookup(df: DataFrame, key: str, parent: str, value: str,
                  alias: str | None = None) -> DataFrame:
    """J8 + P9: attach the parent's ``value`` through a left self join; a null
    parent falls back to the row itself (coalesce)."""
    alias = alias or f"parent_{value}"
    # a parent listed twice: the smallest value, so the result does not depend on the order of rows
    par = df.groupBy(F.col(key).alias("_pk")).agg(F.min(value).alias(alias))
    out = df.withColumn("_pk", F.coalesce(F.col(parent), F.col(key)))
    return out.join(par, "_pk", "left").drop("_pk")
