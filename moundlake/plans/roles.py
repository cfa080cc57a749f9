"""Role mapping of the supplied star-schema tables onto pitch-shaped frames.

The supplied tables hold no pitches, so every pitch column is a deterministic
expression of ``lineitem`` columns (SURVEY 7.3). Unused columns are pruned by
Catalyst before the scan, so a query that needs three roles reads only the
lineitem columns behind them (see ``ReadSchema`` in the plans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Pitch codes and types cycled over lineitem keys (role mapping, not semantics).
PITCH_TYPES_CYCLE = ["FF", "SI", "FC", "SL", "CU", "CH", "ST", "FS"]
CODES_CYCLE = ["B", "C", "S", "F", "X", "T", "W", "D", "*B"]
CODE_DESCRIPTION = {
    "B": "Ball", "C": "Called Strike", "S": "Swinging Strike", "F": "Foul", "X": "In play, out(s)",
    "T": "Foul Tip", "W": "Swinging Strike (Blocked)", "D": "In play, no out", "*B": "Ball In Dirt",
}
CODE_STATCAST = {
    "B": "ball", "C": "called_strike", "S": "swinging_strike", "F": "foul", "X": "hit_into_play",
    "T": "foul_tip", "W": "swinging_strike_blocked", "D": "hit_into_play", "*B": "blocked_ball",
}
IN_PLAY_EVENTS_CYCLE = ["field_out", "single", "double", "home_run", "field_out", "triple"]
EVENT_TYPE_AS_PA = {"signup": "single", "click": "field_out", "view": "strikeout",
                    "purchase": "home_run", "error": "walk"}

# Run-value table by rule: a base value per event, +0.01 per ball, -0.012 per
# strike; 'hit_into_play' is absent, as in the reference's table.
RV_BASE = {"ball": 0.03, "called_strike": -0.045, "foul": -0.035, "swinging_strike": -0.06,
           "hit_by_pitch": 0.2, "single": 0.45, "double": 0.75, "triple": 1.05, "home_run": 1.4,
           "field_out": -0.25, "strikeout": -0.28, "walk": 0.3}


def run_value_rows() -> list[tuple[str, int, int, float]]:
    rows = []
    for ev, base in RV_BASE.items():
        for b in range(4):
            for s in range(3):
                if ev == "walk" and b < 3:
                    continue  # a walk only happens on ball four
                if ev == "strikeout" and s < 2:
                    continue  # a strikeout only happens with two strikes
                rows.append((ev, b, s, round(base + 0.01 * b - 0.012 * s, 6)))
    return rows


def run_values(spark: SparkSession) -> DataFrame:
    from moundlake.schemas import RUN_VALUES
    return spark.createDataFrame(run_value_rows(), RUN_VALUES)


def _cycle(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as pitches (one row per line)."""
    li = table(spark, sf_dir, "lineitem")
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    q, ep, disc, tax = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    # discount and tax in whole percent; measures built from them are integers or
    # binary fractions, so sums are exact and every engine rounds them alike
    dpc, tpc = F.round(disc * 100), F.round(tax * 100)
    code = _cycle(CODES_CYCLE, F.pmod(ok + ln, F.lit(9)))
    balls = F.pmod(pk + ln, F.lit(4)).cast("int")
    strikes = F.pmod(ok, F.lit(3)).cast("int")
    batted = code.isin("X", "D")
    event = (F.when(code == "X", _cycle(IN_PLAY_EVENTS_CYCLE, F.pmod(pk, F.lit(6))))
              .when(code == "D", F.lit("single"))
              .when(code.isin("S", "T", "W", "C") & (strikes == 2), F.lit("strikeout"))
              .when(code.isin("B", "*B") & (balls == 3), F.lit("walk"))
              .when((code == "B") & (F.pmod(sk, F.lit(10)) == 0), F.lit("hit_by_pitch")))
    desc = F.create_map(*[x for k, v in CODE_DESCRIPTION.items() for x in (F.lit(k), F.lit(v))])
    stat = F.create_map(*[x for k, v in CODE_STATCAST.items() for x in (F.lit(k), F.lit(v))])
    return li.select(
        (ok * 8 + ln).alias("pitch_uid"),
        # (order, line) is not unique in lineitem; these make the row key whole
        pk.alias("tb_p"), sk.alias("tb_s"), q.alias("tb_q"), ep.alias("tb_e"),
        ok.alias("game_id"), ln.alias("ab_number"), ln.alias("index_play"),
        sk.alias("pitcher_id"), F.floor(pk / 100).cast("long").alias("batter_id"),
        F.when(F.col("l_linestatus") == "O", "L").otherwise("R").alias("pitcher_hand"),
        F.when(F.pmod(pk, F.lit(3)) == 0, "L").otherwise("R").alias("batter_hand"),
        _cycle(PITCH_TYPES_CYCLE, F.pmod(pk, F.lit(8))).alias("pitch_type"),
        F.to_date("l_shipdate").alias("game_date"),
        F.year("l_shipdate").cast("long").alias("year"),
        F.col("l_shipdate").alias("start_time"),
        (F.pmod(pk, F.lit(31)) != 0).alias("is_pitch"),
        q.alias("start_speed"),
        (ep / 997.0).alias("az"),
        (dpc - 5).alias("ax"),
        (tpc - 4).alias("x0"),
        ln.cast("double").alias("z0"),
        (ep / 0.997).alias("spin_rate"),
        (tpc / 16.0 + 5).alias("extension"),
        balls.alias("balls"), strikes.alias("strikes"),
        F.when(F.pmod(pk, F.lit(29)) != 0, (F.pmod(pk * 7 + ln, F.lit(14)) + 1).cast("int")).alias("zone"),
        code.alias("play_code"),
        F.element_at(desc, code).alias("play_description"),
        F.element_at(stat, code).alias("description"),
        event.alias("event_type"),
        F.when(batted, q + 60).alias("launch_speed"),
        F.when(batted, (F.pmod(pk, F.lit(90)) - 30).cast("double")).alias("launch_angle"),
        ((dpc - 5) / 32.0).alias("px"), (tpc / 16.0 + 1.5).alias("pz"),
        ((dpc - 5) / 2.0).alias("vx0"), (-(q + 100)).alias("vy0"), (tpc / 2.0 - 6).alias("vz0"),
        (ln + 25).cast("double").alias("ay"), F.lit(50.0).alias("y0"),
        ((dpc - 5) / 8.0).alias("delta_run_exp"),
    )


def with_gaps(p: DataFrame) -> DataFrame:
    """Pitches as they arrive: some without a type, spin rates that are null or NaN, and a third of all rows with
    the same spin rate."""
    return p.withColumns({
        "pitch_type": F.when(F.pmod("tb_p", F.lit(37)) != 0, F.col("pitch_type")),
        "spin_rate": F.when(F.pmod("tb_p", F.lit(41)) == 0, F.lit(float("nan"))).when(F.pmod("tb_p", F.lit(43)) == 0, F.lit(None))
                      .when(F.pmod("pitch_uid", F.lit(3)) == 0, F.lit(2000.0)).otherwise(F.col("spin_rate"))})


def pa_with_gaps(pa: DataFrame) -> DataFrame:
    """Plate appearances as they arrive: some without a batter, values that are null or NaN, and one batter with a
    third of all rows."""
    return pa.withColumns({
        "batter_id": F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(7)).when(F.pmod("event_id", F.lit(53)) != 0, F.col("batter_id")),
        "value": F.when(F.pmod("event_id", F.lit(997)) == 0, F.lit(float("nan"))).when(F.pmod("event_id", F.lit(991)) == 0, F.lit(None))
                  .otherwise(F.col("value"))})


def events_as_pa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as plate appearances of batters (user_id)."""
    ev = table(spark, sf_dir, "events")
    m = F.create_map(*[x for k, v in EVENT_TYPE_AS_PA.items() for x in (F.lit(k), F.lit(v))])
    return ev.select("event_id", "ts", F.col("user_id").alias("batter_id"),
                     F.element_at(m, F.col("event_type")).alias("event"), "value", "props")
