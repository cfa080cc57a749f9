"""Numeric helpers written as native expressions (no Python UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from moundlake.schemas import PLATE_Y

# Abramowitz & Stegun 7.1.26 coefficients for erf (|error| <= 1.5e-7).
# Spark has no erf, so the normal CDF is this polynomial; the oracle SQL uses
# the same one so both engines agree to the last digit.
_AS_P = 0.3275911
_AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x: Column) -> Column:
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_AS_P) * ax)
    a1, a2, a3, a4, a5 = _AS_A
    poly = t * (F.lit(a1) + t * (F.lit(a2) + t * (F.lit(a3) + t * (F.lit(a4) + t * F.lit(a5)))))
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.when(x >= 0, y).otherwise(-y)


def normal_cdf(z: Column) -> Column:
    """Standard normal CDF, Phi(z) = (1 + erf(z / sqrt 2)) / 2."""
    return (F.lit(1.0) + erf(z / F.lit(math.sqrt(2.0)))) / F.lit(2.0)


def erf_sql(x: str) -> str:
    """The same polynomial as SQL text (for oracles and ``F.expr``)."""
    a1, a2, a3, a4, a5 = _AS_A
    t = f"(1.0 / (1.0 + {_AS_P} * abs({x})))"
    poly = f"({t} * ({a1} + {t} * ({a2} + {t} * ({a3} + {t} * ({a4} + {t} * {a5})))))"
    y = f"(1.0 - {poly} * exp(-abs({x}) * abs({x})))"
    return f"(CASE WHEN {x} >= 0 THEN {y} ELSE -{y} END)"


def normal_cdf_sql(z: str) -> str:
    return f"((1.0 + {erf_sql(f'(({z}) / {math.sqrt(2.0)!r})')}) / 2.0)"


def approach_angles(vx0: Column, vy0: Column, vz0: Column, ax: Column, ay: Column,
                    az: Column, y0: Column, plate_y: float = PLATE_Y) -> tuple[Column, Column]:
    """Vertical and horizontal approach angle (degrees) at ``plate_y`` feet.

    vy_f = -sqrt(vy0^2 - 2 ay (y0 - plate_y)); t = (vy_f - vy0) / ay;
    v?_f = v?0 + a? t; angle = -atan(v?_f / vy_f) in degrees.
    A negative radicand or ay = 0 gives null instead of NaN.
    """
    rad = vy0 * vy0 - F.lit(2.0) * ay * (y0 - F.lit(plate_y))
    vy_f = F.when(rad >= 0, -F.sqrt(rad))
    t = F.when(ay != 0, (vy_f - vy0) / ay)
    vz_f = vz0 + az * t
    vx_f = vx0 + ax * t
    vaa = F.when(vy_f != 0, -F.degrees(F.atan(vz_f / vy_f)))
    haa = F.when(vy_f != 0, -F.degrees(F.atan(vx_f / vy_f)))
    return vaa, haa
