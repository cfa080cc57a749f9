"""Scalar column expressions (built-in Spark functions only, codegen-friendly)."""

from moundlake.functions.columns import *  # noqa: F401,F403
from moundlake.functions.mathx import normal_cdf, approach_angles  # noqa: F401
