"""Declared schemas and the fixed values that define the semantics.

Everything under "FIXED VALUES" must equal the reference's values for the
results to agree; they are stated plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference for equal results)
# ---------------------------------------------------------------------------

# Feed pitch codes that count as a swing, and as a swing and miss.
SWING_CODES = ["X", "F", "S", "D", "E", "T", "W"]
WHIFF_CODES = ["S", "T", "W"]

# Statcast descriptions that count as a swing, and as a swing and miss.
SWING_DESCRIPTIONS = [
    "foul_bunt", "foul", "hit_into_play", "swinging_strike", "foul_tip",
    "swinging_strike_blocked", "missed_bunt", "bunt_foul_tip",
]
WHIFF_DESCRIPTIONS = ["swinging_strike", "foul_tip", "swinging_strike_blocked"]

# Feed play descriptions that count as a strike on the game line.
STRIKE_DESCRIPTIONS = [
    "In play, out(s)", "Swinging Strike", "In play, run(s)", "Foul",
    "Foul Tip", "Swinging Strike (Blocked)", "Called Strike", "In play, no out",
]

# Feed play description -> pitch outcome used for the run-value lookup.
DESCRIPTION_OUTCOME = {
    "Ball": "ball",
    "In play, run(s)": "hit_into_play",
    "In play, out(s)": "hit_into_play",
    "In play, no out": "hit_into_play",
    "Called Strike": "called_strike",
    "Foul": "foul",
    "Swinging Strike": "swinging_strike",
    "Blocked Ball": "ball",
    "Swinging Strike (Blocked)": "swinging_strike",
    "Foul Tip": "swinging_strike",
    "Foul Bunt": "foul",
    "Hit By Pitch": "hit_by_pitch",
    "Pitchout": "ball",
    "Missed Bunt": "swinging_strike",
    "Bunt Foul Tip": "swinging_strike",
    "Foul Pitchout": "foul",
    "Ball In Dirt": "ball",
}

# Plate-appearance event -> grouped outcome (declared by the reference but
# never applied there; opt-in here through ``event_map=``). Unlisted -> null.
EVENT_OUTCOME = {
    "game_advisory": None,
    "single": "single",
    "walk": "walk",
    "strikeout": "strikeout",
    "field_out": "field_out",
    "force_out": "field_out",
    "double": "double",
    "hit_by_pitch": "hit_by_pitch",
    "home_run": "home_run",
    "grounded_into_double_play": "field_out",
    "fielders_choice_out": "field_out",
    "fielders_choice": "field_out",
    "field_error": None,
    "double_play": "field_out",
    "sac_fly": "field_out",
    "strikeout_double_play": None,
    "triple": "triple",
    "caught_stealing_2b": None,
    "sac_bunt": "field_out",
    "catcher_interf": None,
    "caught_stealing_3b": None,
    "sac_fly_double_play": "field_out",
    "triple_play": "field_out",
    "other_out": "field_out",
    "pickoff_3b": None,
    "caught_stealing_home": None,
    "pickoff_1b": None,
    "pickoff_2b": None,
    "wild_pitch": None,
    "stolen_base_2b": None,
    "pickoff_caught_stealing_3b": None,
    "pickoff_caught_stealing_2b": None,
    "sac_bunt_double_play": None,
    "passed_ball": None,
    "pickoff_caught_stealing_home": None,
}

# Total bases per batted-ball event; anything else is 0.
TOTAL_BASES = {"single": 1, "double": 2, "triple": 3, "home_run": 4}

# wOBA weights: walk, hit by pitch, single, double, triple, home run.
WOBA_WEIGHTS_A = {"walk": 0.696, "hit_by_pitch": 0.726, "single": 0.883,
                  "double": 1.244, "triple": 1.569, "home_run": 2.004}
WOBA_WEIGHTS_B = {"walk": 0.684, "hit_by_pitch": 0.715, "single": 0.880,
                  "double": 1.261, "triple": 1.604, "home_run": 2.085}

# Fastball pitch types used for the per-pitcher baseline.
FASTBALL_TYPES = ["SI", "FF", "FC"]

# Model features, in order.
MODEL_FEATURES = ["start_speed", "spin_rate", "extension", "az", "ax", "x0", "z0",
                  "speed_diff", "az_diff", "ax_diff"]

# Pitch types shown on the grade table, and on the plus-score histograms.
GRADE_PITCH_TYPES = ["FS", "FO", "SC", "FF", "SI", "SV", "KC", "All", "FC", "SL",
                     "ST", "CU", "CH", "KN"]
HISTOGRAM_PITCH_TYPES = ["FF", "SI", "FC", "SL", "ST", "CH", "FS", "CU", "KC"]

# Names of the pitch types (fixed values).
PITCH_TYPE_NAMES = {
    "FF": "4-Seam Fastball", "FA": "Fastball", "SI": "Sinker", "FC": "Cutter", "CH": "Changeup", "FS": "Splitter",
    "SC": "Screwball", "FO": "Forkball", "SL": "Slider", "ST": "Sweeper", "SV": "Slurve", "KC": "Knuckle Curve",
    "CU": "Curveball", "CS": "Slow Curve", "EP": "Eephus", "KN": "Knuckleball", "PO": "Pitch Out", "UN": "Unknown",
}

# Distance from the plate (ft) at which approach angles are taken.
PLATE_Y = 17.0 / 12.0

# Minimum samples.
MIN_WOBA_PA = 100          # strict ">"
MIN_PITCHES_YOY = 100      # ">="
MIN_PITCHES_BEST = 150     # ">="
MIN_PITCHES_TYPE_STATS = 10  # ">="
STARTER_PITCHES_PER_GAME = 40  # ">=" -> SP

# Plus scale and grade scale.
PLUS_CENTER, PLUS_SCALE = 100.0, 10.0
GRADE_CENTER, GRADE_SCALE, GRADE_LO, GRADE_HI = 50.0, 10.0, 20.0, 80.0

# Reference wOBA line on rolling charts.
WOBA_REFERENCE_LINE = 0.316

# Event overrides applied after the batted-ball expectation.
WALK_EVENTS = ["walk"]
HBP_EVENTS = ["hit_by_pitch"]
STRIKEOUT_EVENTS = ["strikeout", "strikeout_double_play"]

# ---------------------------------------------------------------------------
# Declared schemas of the side tables (no inference in production paths).
# ---------------------------------------------------------------------------

RUN_VALUES = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("balls", T.IntegerType()),
    T.StructField("strikes", T.IntegerType()),
    T.StructField("delta_run_exp", T.DoubleType()),
])

RUN_VALUES_BY_HAND = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("pitcher_hand", T.StringType()),
    T.StructField("batter_hand", T.StringType()),
    T.StructField("balls", T.IntegerType()),
    T.StructField("strikes", T.IntegerType()),
    T.StructField("delta_run_exp", T.DoubleType()),
])

WOBA_WEIGHTS = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("woba", T.DoubleType()),
])

PITCHING_BOARD = T.StructType([
    T.StructField("playerid", T.LongType()),
    T.StructField("xMLBAMID", T.LongType()),
    T.StructField("PlayerName", T.StringType()),
    T.StructField("Season", T.LongType()),
    T.StructField("Team", T.StringType()),
    T.StructField("G", T.LongType()),
    T.StructField("IP", T.DoubleType()),
    T.StructField("K-BB%", T.DoubleType()),
    T.StructField("ERA", T.DoubleType()),
    T.StructField("FIP", T.DoubleType()),
    T.StructField("xFIP", T.DoubleType()),
    T.StructField("TBF", T.LongType()),
    T.StructField("Pitches", T.LongType()),
])

STATCAST = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("zone", T.IntegerType()),
    T.StructField("pfx_x", T.DoubleType()),
    T.StructField("pfx_z", T.DoubleType()),
    T.StructField("plate_x", T.DoubleType()),
    T.StructField("plate_z", T.DoubleType()),
    T.StructField("woba_value", T.DoubleType()),
    T.StructField("estimated_woba_using_speedangle", T.DoubleType()),
    T.StructField("delta_run_exp", T.DoubleType()),
    T.StructField("p_throws", T.StringType()),
    T.StructField("events", T.StringType()),
    T.StructField("batter", T.LongType()),
    T.StructField("game_date", T.DateType()),
    T.StructField("at_bat_number", T.IntegerType()),
    T.StructField("pitch_number", T.IntegerType()),
])

BATTING_BOARD = T.StructType([
    T.StructField("xMLBAMID", T.LongType()),
    T.StructField("Season", T.LongType()),
    T.StructField("PA", T.LongType()),
    T.StructField("HR", T.LongType()),
    T.StructField("K%", T.DoubleType()),
    T.StructField("BB%", T.DoubleType()),
    T.StructField("wOBA", T.DoubleType()),
])
