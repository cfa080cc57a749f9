"""Projection-level operators P1-P34 as column expressions or small frame steps."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moundlake.schemas import (
    DESCRIPTION_OUTCOME, GRADE_HI, GRADE_LO, PITCH_TYPE_NAMES, STARTER_PITCHES_PER_GAME,
    SWING_CODES, SWING_DESCRIPTIONS, TOTAL_BASES, WHIFF_CODES, WHIFF_DESCRIPTIONS,
)

__all__ = [
    "col_of", "drop_missing", "season", "mirror_by_hand", "recode",
    "case_map", "swing_flag", "whiff_flag", "statcast_flags", "clip", "batted_ball_flag",
    "pitch_position", "total_bases", "woba_value", "normalise_range", "strip_id",
    "strip_column_names", "percent_scale", "format_metric", "is_iso_date", "team_by_half",
    "upper_trim",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with null (or NaN for floating columns) in ``cols``."""
    cond = None
    for c in cols:
        dtype = df.schema[c].dataType.typeName()
        ok = F.col(c).isNotNull()
        if dtype in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df if cond is None else df.filter(cond)


def season(date_col: str | Column) -> Column:
    """P10: year of an ISO date string, date or timestamp."""
    return F.year(F.to_date(col_of(date_col))).cast("long")


def mirror_by_hand(value: str | Column, hand: str | Column, negate_for: str = "L",
                   negate: bool = True) -> Column:
    """``-value`` when hand == negate_for (if negate) else value; the other hand gets the
    opposite. A null hand takes the ``otherwise`` branch, as the reference does."""
    v, h = col_of(value), col_of(hand)
    return F.when(h == negate_for, -v if negate else v).otherwise(v if negate else -v)


def recode(c: str | Column, mapping: Mapping[str, str | None]) -> Column:
    """Dictionary recode; unmatched (and null) -> null. Map literal, no join."""
    items = [x for k, v in mapping.items() if v is not None for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*items), col_of(c))


def case_map(c: str | Column, mapping: Mapping[str, object], default=None) -> Column:
    """Ordered multi-branch CASE with a default."""
    x = col_of(c)
    out = None
    for k, v in mapping.items():
        out = F.when(x == k, F.lit(v)) if out is None else out.when(x == k, F.lit(v))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def total_bases(event: str | Column) -> Column:
    return case_map(event, TOTAL_BASES, 0)


def woba_value(event: str | Column, weights: Mapping[str, float]) -> Column:
    return case_map(event, weights, 0.0)


def swing_flag(code: str | Column, codes: Iterable[str] = SWING_CODES) -> Column:
    """Swing flag from the feed code, true/false (null code -> false)."""
    return F.coalesce(col_of(code).isin(list(codes)), F.lit(False))


def whiff_flag(code: str | Column, codes: Iterable[str] = WHIFF_CODES) -> Column:
    return F.coalesce(col_of(code).isin(list(codes)), F.lit(False))


def statcast_flags(df: DataFrame, description: str = "description", zone: str = "zone",
                   inches: Sequence[str] = ()) -> DataFrame:
    """P14 (+P15): swing, whiff, in_zone, out_zone, chase from statcast rows.

    A null zone is neither in nor out of the zone; a swing at it counts as a
    chase, as in the reference (trap T4)."""
    sw = F.coalesce(F.col(description).isin(SWING_DESCRIPTIONS), F.lit(False))
    wh = F.coalesce(F.col(description).isin(WHIFF_DESCRIPTIONS), F.lit(False))
    iz = F.coalesce(F.col(zone) < 10, F.lit(False))
    oz = F.coalesce(F.col(zone) > 10, F.lit(False))
    out = df.withColumns({"swing": sw, "whiff": wh, "in_zone": iz, "out_zone": oz})
    out = out.withColumn("chase", ~F.col("in_zone") & F.col("swing"))
    if inches:
        out = out.withColumns({c: F.col(c) * 12 for c in inches})
    return out


def clip(c: str | Column, lo: float = GRADE_LO, hi: float = GRADE_HI) -> Column:
    """Clip into [lo, hi]; null stays null."""
    x = col_of(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def batted_ball_flag(launch_speed: str | Column) -> Column:
    """1 when launch speed > 0, else null."""
    return F.when(col_of(launch_speed) > 0, F.lit(1))


def pitch_position(pitches: str | Column, games: str | Column,
                   threshold: float = STARTER_PITCHES_PER_GAME) -> Column:
    """P30: 'SP' when pitches per game >= threshold else 'RP'."""
    return F.when(col_of(pitches) / col_of(games) >= threshold, F.lit("SP")).otherwise(F.lit("RP"))


def normalise_range(value: str | Column, lo: str | Column, hi: str | Column,
                    flip: str | Column | None = None) -> Column:
    """(v - lo) / (hi - lo), flipped to 1 - x for lower-is-better metrics."""
    v, a, b = col_of(value), col_of(lo), col_of(hi)
    x = F.try_divide(v - a, b - a)
    if flip is None:
        return x
    return F.when(col_of(flip), F.lit(1.0) - x).otherwise(x)


def strip_id(c: str | Column) -> Column:
    """Drop an ``xMLBAMID_`` prefix and ``_2020``..``_2024`` suffixes from an id."""
    return F.regexp_replace(F.regexp_replace(col_of(c), r"^xMLBAMID_", ""), r"(_202[0-4])+$", "")


def strip_column_names(df: DataFrame) -> DataFrame:
    """P26."""
    return df.toDF(*[c.strip() for c in df.columns])


def percent_scale(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """x100 on columns whose name holds '%' (or the listed ones)."""
    targets = [c for c in df.columns if "%" in c] if cols is None else list(cols)
    return df.withColumns({c: F.col(f"`{c}`") * 100 for c in targets})


def format_metric(value: str | Column, fmt: str) -> Column:
    """P21: '.0f', '.1f', '.3f', optional trailing '%'; null -> '--'."""
    m = re.fullmatch(r"\.(\d)f(%?)", fmt)
    if not m:
        raise ValueError(f"unsupported format {fmt!r}")
    digits, pct = int(m.group(1)), m.group(2)
    x = col_of(value)
    return F.when(x.isNull() | F.isnan(x), F.lit("--")).otherwise(
        F.format_string(f"%.{digits}f{'%%' if pct else ''}", x))


def is_iso_date(c: str | Column) -> Column:
    """YYYY-MM-DD that also parses as a date."""
    x = col_of(c)
    return x.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).isNotNull()


def team_by_half(is_top: str | Column, home: str | Column, away: str | Column,
                 batting: bool = False) -> Column:
    """Pitching team is home in the top half; batting team is the other."""
    t = col_of(is_top)
    if batting:
        return F.when(t, col_of(away)).otherwise(col_of(home))
    return F.when(t, col_of(home)).otherwise(col_of(away))


def upper_trim(c: str | Column) -> Column:
    """P5."""
    return F.upper(F.trim(col_of(c)))


def describe_outcome(c: str | Column) -> Column:
    return recode(c, DESCRIPTION_OUTCOME)


__all__.append("describe_outcome")


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """P20 as data-frame libraries round: halves go to the even neighbour (``F.round`` takes them away from zero)."""
    return F.bround(col_of(c), digits)


def pitch_type_name(c: str | Column) -> Column:
    """Name of a pitch-type code; unknown codes keep their code."""
    return F.coalesce(recode(c, PITCH_TYPE_NAMES), col_of(c))


__all__ += ["round_half_even", "pitch_type_name"]
