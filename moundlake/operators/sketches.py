"""Mergeable distinct counts (A8, A12): sketches stored per fine key and united upwards, so that a coarser count reads small rows instead of
the events. The exact counts (``F.count_distinct``) stay the default elsewhere; an estimate lies within ``error_bound`` of the truth but for
one case in some ten thousand. A null is not counted; a group without values has an estimate of 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base-2 logarithm of a sketch's registers: 4,096 of them, at most 4 KB a sketch.
LG_REGISTERS = 12


def error_bound(lg: int = LG_REGISTERS, deviations: float = 4.0) -> float:
    """Relative error within ``deviations`` standard errors of united sketches (1.04 / sqrt(registers))."""
    return deviations * 1.04 / (1 << lg) ** 0.5


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, lg: int = LG_REGISTERS, alias: str = "sketch") -> DataFrame:
    """One sketch of the distinct values of an integer, string or binary column per ``keys``; combined before its shuffle, so a hot key is one row a task."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg)).alias(alias))


def union_sketches(stored: DataFrame, keys: Sequence[str], sketch: str = "sketch") -> DataFrame:
    """The sketches of coarser ``keys`` (none: one row) from stored ones; those of different sizes are united at the smaller one."""
    return stored.groupBy(*keys).agg(F.hll_union_agg(sketch, F.lit(True)).alias(sketch))


def estimate(sketches: DataFrame, alias: str, sketch: str = "sketch") -> DataFrame:
    return sketches.withColumn(alias, F.hll_sketch_estimate(sketch)).drop(sketch)
