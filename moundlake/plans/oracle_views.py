"""The role mappings of ``roles.py`` restated as DuckDB SQL, written independently
of the Spark code, for the oracle queries."""

from __future__ import annotations

from moundlake.plans.roles import (
    CODE_DESCRIPTION, CODE_STATCAST, CODES_CYCLE, EVENT_TYPE_AS_PA, IN_PLAY_EVENTS_CYCLE,
    PITCH_TYPES_CYCLE, run_value_rows,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_idx(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"(CASE {expr} {whens} END)"


def _case_map(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} END)"


_CODE = _case_idx("(l_orderkey + l_linenumber) % 9", CODES_CYCLE)

PITCHES_BASE = f"""
SELECT l.*, {_CODE} AS code,
       CAST((l_partkey + l_linenumber) % 4 AS INTEGER) AS b_,
       CAST(l_orderkey % 3 AS INTEGER) AS s_,
       round(l_discount * 100) AS dpc, round(l_tax * 100) AS tpc
FROM lineitem l
"""

PITCHES = f"""
SELECT
  l_orderkey * 8 + l_linenumber AS pitch_uid,
  l_partkey AS tb_p, l_suppkey AS tb_s, l_quantity AS tb_q, l_extendedprice AS tb_e,
  l_orderkey AS game_id, l_linenumber AS ab_number, l_linenumber AS index_play,
  l_suppkey AS pitcher_id, l_partkey // 100 AS batter_id,
  CASE WHEN l_linestatus = 'O' THEN 'L' ELSE 'R' END AS pitcher_hand,
  CASE WHEN l_partkey % 3 = 0 THEN 'L' ELSE 'R' END AS batter_hand,
  {_case_idx("l_partkey % 8", PITCH_TYPES_CYCLE)} AS pitch_type,
  CAST(l_shipdate AS DATE) AS game_date,
  CAST(year(l_shipdate) AS BIGINT) AS year,
  l_shipdate AS start_time,
  l_partkey % 31 <> 0 AS is_pitch,
  l_quantity AS start_speed,
  l_extendedprice / CAST(997.0 AS DOUBLE) AS az,
  dpc - 5 AS ax,
  tpc - 4 AS x0,
  CAST(l_linenumber AS DOUBLE) AS z0,
  l_extendedprice / CAST(0.997 AS DOUBLE) AS spin_rate,
  tpc / 16.0 + 5 AS extension,
  b_ AS balls, s_ AS strikes,
  CASE WHEN l_partkey % 29 <> 0 THEN CAST((l_partkey * 7 + l_linenumber) % 14 + 1 AS INTEGER) END AS zone,
  code AS play_code,
  {_case_map("code", CODE_DESCRIPTION)} AS play_description,
  {_case_map("code", CODE_STATCAST)} AS description,
  CASE WHEN code = 'X' THEN {_case_idx("l_partkey % 6", IN_PLAY_EVENTS_CYCLE)}
       WHEN code = 'D' THEN 'single'
       WHEN code IN ('S', 'T', 'W', 'C') AND s_ = 2 THEN 'strikeout'
       WHEN code IN ('B', '*B') AND b_ = 3 THEN 'walk'
       WHEN code = 'B' AND l_suppkey % 10 = 0 THEN 'hit_by_pitch' END AS event_type,
  CASE WHEN code IN ('X', 'D') THEN l_quantity + 60 END AS launch_speed,
  CASE WHEN code IN ('X', 'D') THEN CAST(l_partkey % 90 - 30 AS DOUBLE) END AS launch_angle,
  (dpc - 5) / 32.0 AS px, tpc / 16.0 + 1.5 AS pz,
  (dpc - 5) / 2.0 AS vx0, -(l_quantity + 100) AS vy0, tpc / 2.0 - 6 AS vz0,
  CAST(l_linenumber + 25 AS DOUBLE) AS ay, CAST(50.0 AS DOUBLE) AS y0,
  (dpc - 5) / 8.0 AS delta_run_exp
FROM ({PITCHES_BASE}) t
"""

RUN_VALUES = "(VALUES " + ", ".join(
    f"({_q(e)}, {b}, {s}, CAST({v!r} AS DOUBLE))" for e, b, s, v in run_value_rows()
) + ") AS rv(event, balls, strikes, delta_run_exp)"

EVENTS_AS_PA = f"""
SELECT event_id, ts, user_id AS batter_id, {_case_map("event_type", EVENT_TYPE_AS_PA)} AS event,
       value, props
FROM events
"""

PITCHES_WITH_TEAM = f"""
SELECT p.*, s.s_nationkey AS pitcher_team
FROM ({PITCHES}) p JOIN supplier s ON p.pitcher_id = s.s_suppkey
"""


# rows as they arrive; a missing spin rate or value (null or NaN) is null here, which SQL aggregates leave out
PITCHES_GAPS = f"""
SELECT * REPLACE (CASE WHEN tb_p % 37 <> 0 THEN pitch_type END AS pitch_type,
  CASE WHEN tb_p % 41 = 0 OR tb_p % 43 = 0 THEN NULL WHEN pitch_uid % 3 = 0 THEN 2000.0 ELSE spin_rate END AS spin_rate)
FROM ({PITCHES})
"""

PA_GAPS = f"""
SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 53 <> 0 THEN batter_id END AS batter_id,
  CASE WHEN event_id % 997 <> 0 AND event_id % 991 <> 0 THEN value END AS value)
FROM ({EVENTS_AS_PA})
"""


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with CTEs: pitches, pitches_t (with team), pa, rv as requested."""
    defs = {"pitches": PITCHES, "pitches_t": PITCHES_WITH_TEAM, "pa": EVENTS_AS_PA, "pitches_gaps": PITCHES_GAPS, "pa_gaps": PA_GAPS,
            "rv": f"SELECT * FROM {RUN_VALUES}"}
    ctes = ",\n".join(f"{v} AS ({defs[v]})" for v in views)
    if not views:
        return body
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return f"WITH {ctes},\n{b[4:]}"
    return f"WITH {ctes}\n{body}"
