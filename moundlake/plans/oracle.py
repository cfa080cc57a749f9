"""DuckDB oracle SQL for the registered queries (same column names, doubles
rounded to 6 digits). Written from the operator definitions, independently of
the Spark code."""

from __future__ import annotations

from moundlake.functions.mathx import normal_cdf_sql
from moundlake.plans.oracle_views import with_views
from moundlake.schemas import HISTOGRAM_PITCH_TYPES, STRIKE_DESCRIPTIONS


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


R = "round({}, 6)"
SWING = "coalesce(play_code IN ('X','F','S','D','E','T','W'), false)"
WHIFF = "coalesce(play_code IN ('S','T','W'), false)"
WOBA_A = ("CASE event_type WHEN 'walk' THEN 0.696 WHEN 'hit_by_pitch' THEN 0.726 WHEN 'single' THEN 0.883 "
          "WHEN 'double' THEN 1.244 WHEN 'triple' THEN 1.569 WHEN 'home_run' THEN 2.004 ELSE 0.0 END")
TB = ("CASE event_type WHEN 'single' THEN 1 WHEN 'double' THEN 2 WHEN 'triple' THEN 3 "
      "WHEN 'home_run' THEN 4 ELSE 0 END")
OUTCOME = """CASE play_description
  WHEN 'Ball' THEN 'ball' WHEN 'In play, run(s)' THEN 'hit_into_play' WHEN 'In play, out(s)' THEN 'hit_into_play'
  WHEN 'In play, no out' THEN 'hit_into_play' WHEN 'Called Strike' THEN 'called_strike' WHEN 'Foul' THEN 'foul'
  WHEN 'Swinging Strike' THEN 'swinging_strike' WHEN 'Blocked Ball' THEN 'ball'
  WHEN 'Swinging Strike (Blocked)' THEN 'swinging_strike' WHEN 'Foul Tip' THEN 'swinging_strike'
  WHEN 'Foul Bunt' THEN 'foul' WHEN 'Hit By Pitch' THEN 'hit_by_pitch' WHEN 'Pitchout' THEN 'ball'
  WHEN 'Missed Bunt' THEN 'swinging_strike' WHEN 'Bunt Foul Tip' THEN 'swinging_strike'
  WHEN 'Foul Pitchout' THEN 'foul' WHEN 'Ball In Dirt' THEN 'ball' END"""

# run-value target (M24) over pitches
TARGET = f"""
SELECT p.*, r1.delta_run_exp AS delta_run_exp_rv, r2.delta_run_exp AS delta_run_exp_des,
       coalesce(r1.delta_run_exp, r2.delta_run_exp) AS target
FROM (SELECT *, {OUTCOME} AS outcome FROM pitches) p
LEFT JOIN rv r1 ON r1.event = p.event_type AND r1.balls = p.balls AND r1.strikes = p.strikes
LEFT JOIN rv r2 ON r2.event = p.outcome AND r2.balls = p.balls AND r2.strikes = p.strikes
"""

# plus score with reference season 1996
SCORED = f"""
WITH tgt AS ({TARGET}),
t AS (SELECT * FROM tgt WHERE target IS NOT NULL),
st AS (SELECT avg(target) AS m, stddev_samp(target) AS s FROM t WHERE year = 1996)
SELECT t.*, 100 - (t.target - st.m) / st.s * 10 AS stuff_plus FROM t, st
"""

TEAM = "(SELECT s_suppkey AS pitcher_id, s_nationkey AS pitcher_team FROM supplier)"

# kNN predictions for query rows against training rows, both among the batted balls
def _knn(train: str, query: str) -> str:
    return f"""
WITH bb AS (SELECT pitch_uid, tb_p, tb_s, tb_q, tb_e, launch_angle AS x, launch_speed AS y, {TB} AS tb, year
            FROM pitches WHERE launch_speed > 0),
tr AS (SELECT * FROM bb WHERE {train}),
qq AS (SELECT * FROM bb WHERE {query}),
pairs AS (SELECT q.pitch_uid, q.tb_p, q.tb_s, q.tb_q, q.tb_e, q.tb AS qtb, t.tb,
                 (q.x - t.x) * (q.x - t.x) + (q.y - t.y) * (q.y - t.y) AS d2,
                 t.pitch_uid AS t1, t.tb_p AS t2, t.tb_s AS t3, t.tb_q AS t4, t.tb_e AS t5 FROM qq q CROSS JOIN tr t),
topk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pitch_uid, tb_p, tb_s, tb_q, tb_e
                                                     ORDER BY d2, t1, t2, t3, t4, t5) AS rn FROM pairs)
         WHERE rn <= 11),
votes AS (SELECT pitch_uid, tb_p, tb_s, tb_q, tb_e, qtb, tb, count(*) AS v FROM topk GROUP BY ALL),
ev AS (SELECT pitch_uid, tb_p, tb_s, tb_q, tb_e, qtb,
              sum(v / 11.0 * CASE tb WHEN 1 THEN 0.883 WHEN 2 THEN 1.244 WHEN 3 THEN 1.569 WHEN 4 THEN 2.004
                                     ELSE 0.0 END) AS expected,
              arg_max(tb, v * 100 - tb) AS pred_class
       FROM votes GROUP BY ALL)
SELECT pitch_uid, tb_p, tb_s, tb_q, tb_e, qtb AS tb, expected, pred_class FROM ev
"""


# the test split (pmod(uid, 5) = 0) against the 80 % train split; a season against the three before it
KNN = _knn("pitch_uid % 5 <> 0", "pitch_uid % 5 = 0")
KNN_SEASON = _knn("year BETWEEN 1995 AND 1997", "year = 1998")

XWOBA_BOARD = f"""
WITH pr AS ({KNN_SEASON}),
q AS (SELECT p.batter_id, p.event_type, {WOBA_A} AS woba, pr.expected AS woba_pred
      FROM pitches p LEFT JOIN pr USING (pitch_uid, tb_p, tb_s, tb_q, tb_e) WHERE p.year = 1998),
o AS (SELECT batter_id, woba,
             CASE WHEN event_type IN ('strikeout', 'strikeout_double_play') THEN 0.0
                  WHEN event_type = 'hit_by_pitch' THEN 0.726
                  WHEN event_type = 'walk' THEN 0.696 ELSE woba_pred END AS woba_pred FROM q)
SELECT batter_id, count(woba_pred) AS woba_pa, avg(woba) AS woba, avg(woba_pred) AS xwoba
FROM o WHERE woba_pred IS NOT NULL GROUP BY batter_id HAVING count(woba_pred) > 100
"""


def _pitch_grades(keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""
WITH s AS ({SCORED}),
tot AS (
  SELECT {k}, CASE WHEN grouping(pitch_type) = 1 THEN 'All' ELSE pitch_type END AS pitch_type,
         count(stuff_plus) AS pitches, count(DISTINCT game_id) AS games, avg(stuff_plus) AS stuff_plus
  FROM s GROUP BY GROUPING SETS (({k}), ({k}, pitch_type))),
ts AS (SELECT pitch_type, avg(stuff_plus) AS type_mean,
              (quantile_cont(stuff_plus, 0.999) - quantile_cont(stuff_plus, 0.001)) / 6 AS type_std
       FROM tot WHERE pitches >= 10 GROUP BY pitch_type),
pos AS (SELECT {k}, CASE WHEN pitches / games >= {{thr}} THEN 'SP' ELSE 'RP' END AS position
        FROM tot WHERE pitch_type = 'All')
SELECT tot.*, ts.type_mean, ts.type_std,
       CASE WHEN ts.type_std = 0 THEN NULL
            ELSE greatest(20.0, least(80.0, 50 + 10 * (tot.stuff_plus - ts.type_mean) / ts.type_std)) END
         AS pitch_grade,
       pos.position
FROM tot JOIN ts USING (pitch_type) LEFT JOIN pos USING ({k})
"""


def _round_all(cols: list[str], src: str) -> str:
    return f"SELECT {', '.join(cols)} FROM ({src})"


ORACLE: dict[str, str] = {}

ORACLE["arsenal_summary"] = with_views("""
SELECT pitcher_id, pitch_type, count(is_pitch) AS pitches,
       round(avg(start_speed), 6) AS start_speed, round(avg(az), 6) AS az, round(avg(ax), 6) AS ax,
       round(avg(spin_rate), 6) AS spin_rate, round(avg(extension), 6) AS extension,
       round(count(is_pitch) / sum(count(is_pitch)) OVER (PARTITION BY pitcher_id), 6) AS proportion
FROM pitches GROUP BY pitcher_id, pitch_type
""", "pitches")

ORACLE["arsenal_rates"] = with_views(f"""
WITH p AS (SELECT *, {SWING} AS swing, {WHIFF} AS whiff,
                  coalesce(play_description IN ('Called Strike', 'Swinging Strike', 'Foul', 'Foul Tip',
                     'Swinging Strike (Blocked)', 'In play, out(s)', 'In play, no out'), false) AS is_strike,
                  {WOBA_A} AS woba, coalesce(launch_speed > 0, false) AS batted FROM pitches),
g AS (SELECT pitch_type, count(*) FILTER (WHERE is_pitch) AS pitches, count(*) FILTER (WHERE swing) AS swings,
             count(*) FILTER (WHERE whiff) AS whiffs, count(*) FILTER (WHERE is_strike) AS strikes,
             count(*) FILTER (WHERE zone < 10 AND is_pitch) AS in_zone, count(*) FILTER (WHERE zone > 10) AS out_zone,
             count(*) FILTER (WHERE zone > 10 AND swing) AS chases,
             avg(start_speed) AS start_speed, avg(ax) AS ax,
             avg(CASE WHEN batted THEN woba END) AS wobacon
      FROM p GROUP BY pitch_type)
SELECT pitch_type, pitches, swings, whiffs, strikes, in_zone, out_zone, chases,
       round(start_speed, 6) AS start_speed, round(ax, 6) AS ax, round(wobacon, 6) AS wobacon,
       round(pitches / sum(pitches) OVER (), 6) AS pitch_pct,
       round(CASE WHEN swings = 0 THEN NULL ELSE whiffs / swings END, 6) AS whiff_pct,
       round(CASE WHEN out_zone = 0 THEN NULL ELSE chases / out_zone END, 6) AS chase_pct,
       round(CASE WHEN pitches = 0 THEN NULL ELSE in_zone / pitches END, 6) AS zone_pct
FROM g
""", "pitches")

ORACLE["game_line"] = with_views(f"""
WITH g AS (SELECT pitcher_id, year, count(*) FILTER (WHERE is_pitch) AS pitches,
                  count(*) FILTER (WHERE {SWING}) AS swings, count(*) FILTER (WHERE {WHIFF}) AS whiffs,
                  count(*) FILTER (WHERE play_description IN {_in(STRIKE_DESCRIPTIONS)}) AS strikes
           FROM pitches GROUP BY pitcher_id, year)
SELECT pitcher_id, year, pitches,
       round(CASE WHEN swings > 0 THEN whiffs / swings * 100 ELSE 0.0 END, 6) AS whiff_pct,
       round(CASE WHEN pitches > 0 THEN strikes / pitches * 100 ELSE 0.0 END, 6) AS strike_pct
FROM g
""", "pitches")

ORACLE["run_value_target"] = with_views(f"""
SELECT pitch_uid, outcome, round(delta_run_exp_rv, 6) AS delta_run_exp,
       round(delta_run_exp_des, 6) AS delta_run_exp_des, round(target, 6) AS target
FROM ({TARGET})
""", "pitches", "rv")

ORACLE["run_value_by_hand"] = with_views(f"""
WITH h AS (SELECT rv.event, ph.h AS pitcher_hand, bh.h AS batter_hand, rv.balls, rv.strikes,
                  rv.delta_run_exp * CASE WHEN rv.event IN ('strikeout', 'swinging_strike')
                                          THEN (CASE WHEN ph.h = bh.h THEN 1.5 ELSE 2.0 END) ELSE 1.0 END
                    AS delta_run_exp
           FROM rv, (VALUES ('L'), ('R')) ph(h), (VALUES ('L'), ('R')) bh(h)),
p AS (SELECT *, {OUTCOME} AS outcome FROM pitches)
SELECT p.pitch_uid, round(coalesce(h1.delta_run_exp, h2.delta_run_exp), 6) AS target
FROM p
LEFT JOIN h h1 ON h1.event = p.event_type AND h1.balls = p.balls AND h1.strikes = p.strikes
              AND h1.pitcher_hand = p.pitcher_hand AND h1.batter_hand = p.batter_hand
LEFT JOIN h h2 ON h2.event = p.outcome AND h2.balls = p.balls AND h2.strikes = p.strikes
              AND h2.pitcher_hand = p.pitcher_hand AND h2.batter_hand = p.batter_hand
""", "pitches", "rv")

ORACLE["fastball_features"] = with_views("""
WITH m AS (SELECT pitch_uid, pitcher_id, year, pitch_type, start_speed, az,
                  CASE WHEN pitcher_hand = 'L' THEN -ax ELSE ax END AS ax,
                  CASE WHEN pitcher_hand = 'L' THEN x0 ELSE -x0 END AS x0 FROM pitches),
pt AS (SELECT pitcher_id, year, pitch_type, avg(start_speed) AS sp, avg(az) AS a_z, avg(ax) AS a_x, count(*) AS n
       FROM m WHERE pitch_type IN ('SI', 'FF', 'FC') GROUP BY ALL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pitcher_id, year
                                                  ORDER BY n DESC, sp DESC, pitch_type DESC) AS rn FROM pt)
      WHERE rn = 1)
SELECT m.pitch_uid, m.year, round(m.ax, 6) AS ax, round(m.x0, 6) AS x0,
       round(b.sp, 6) AS avg_fastball_speed, round(b.a_z, 6) AS avg_fastball_az, round(b.a_x, 6) AS avg_fastball_ax,
       round(m.start_speed - b.sp, 6) AS speed_diff, round(m.az - b.a_z, 6) AS az_diff,
       round(abs(m.ax - b.a_x), 6) AS ax_diff
FROM m JOIN b USING (pitcher_id, year)
""", "pitches")

ORACLE["outcome_weights"] = with_views(f"""
SELECT batter_id, count(woba) AS woba_pa, round(avg(woba), 6) AS woba, round(avg(tb), 6) AS tb
FROM (SELECT batter_id, {WOBA_A} AS woba, {TB} AS tb FROM pitches WHERE event_type IS NOT NULL)
GROUP BY batter_id HAVING count(woba) > 100
""", "pitches")

ORACLE["approach_angles"] = with_views("""
WITH a AS (SELECT pitch_uid, vx0, vy0, vz0, ax, ay, az,
                  vy0 * vy0 - 2.0 * ay * (y0 - CAST(17.0 AS DOUBLE) / 12.0) AS rad FROM pitches),
b AS (SELECT *, CASE WHEN rad >= 0 THEN -sqrt(rad) END AS vyf FROM a),
c AS (SELECT *, CASE WHEN ay <> 0 THEN (vyf - vy0) / ay END AS t FROM b)
SELECT pitch_uid,
       round(CASE WHEN vyf <> 0 THEN -degrees(atan((vz0 + az * t) / vyf)) END, 6) AS vaa,
       round(CASE WHEN vyf <> 0 THEN -degrees(atan((vx0 + ax * t) / vyf)) END, 6) AS haa
FROM c
""", "pitches")

ORACLE["plus_scale"] = with_views(f"""
SELECT pitcher_id, year, count(stuff_plus) AS count, round(avg(stuff_plus), 6) AS stuff_plus
FROM ({SCORED}) GROUP BY pitcher_id, year
""", "pitches", "rv")

ORACLE["pitch_grades"] = with_views(_round_all(
    ["pitcher_id", "year", "pitch_type", "pitches", "games", "round(stuff_plus, 6) AS stuff_plus",
     "round(type_mean, 6) AS type_mean", "round(type_std, 6) AS type_std",
     "round(pitch_grade, 6) AS pitch_grade", "position"],
    _pitch_grades(["pitcher_id", "year"]).replace("{thr}", "40")), "pitches", "rv")

ORACLE["type_quantiles"] = with_views("""
SELECT pitch_type, count(spin_rate) AS n, round(avg(spin_rate), 6) AS mean,
       round(stddev_samp(spin_rate), 6) AS std, round(median(spin_rate), 6) AS median,
       round(min(spin_rate), 6) AS min, round(max(spin_rate), 6) AS max,
       round(quantile_cont(spin_rate, 0.025), 6) AS q2_5, round(quantile_cont(spin_rate, 0.975), 6) AS q97_5
FROM pitches_gaps GROUP BY pitch_type
""", "pitches_gaps")

_LV = sorted({0.5 ** i for i in range(1, 8)} | {1 - 0.5 ** i for i in range(1, 8)})
ORACLE["letter_values"] = with_views(f"""
SELECT pitch_type, n, round(level, 6) AS level, round(value, 6) AS value
FROM (SELECT pitch_type, count(spin_rate) AS n, unnest({_LV!r}::DOUBLE[]) AS level,
             unnest(quantile_cont(spin_rate, {_LV!r}::DOUBLE[])) AS value
      FROM pitches_gaps GROUP BY pitch_type)
""", "pitches_gaps")

ORACLE["team_role_cube"] = with_views(f"""
WITH s AS ({SCORED}),
tot AS (SELECT pitcher_id, year, count(stuff_plus) AS pitches, count(DISTINCT game_id) AS games
        FROM s GROUP BY pitcher_id, year),
pos AS (SELECT pitcher_id, year, CASE WHEN pitches / games >= 1.05 THEN 'SP' ELSE 'RP' END AS position FROM tot),
j AS (SELECT s.stuff_plus, pos.position, t.pitcher_team FROM s JOIN pos USING (pitcher_id, year)
      JOIN {TEAM} t USING (pitcher_id))
SELECT CASE WHEN grouping(pitcher_team) = 1 THEN 'All' ELSE CAST(pitcher_team AS VARCHAR) END AS pitcher_team,
       CASE WHEN grouping(position) = 1 THEN 'All' ELSE position END AS position,
       round(avg(stuff_plus), 6) AS mean_value, count(stuff_plus) AS n
FROM j GROUP BY CUBE (pitcher_team, position)
""", "pitches", "rv")

ORACLE["home_road_park_factor"] = with_views(f"""
WITH s AS (SELECT sc.*, t.pitcher_team FROM ({SCORED}) sc JOIN {TEAM} t USING (pitcher_id)),
h AS (SELECT game_id, arg_min(pitcher_team, (start_time, ab_number, index_play, tb_p, tb_s, tb_q, tb_e)) AS home_team FROM s GROUP BY game_id),
f AS (SELECT s.pitcher_team, s.pitcher_team = h.home_team AS home, s.stuff_plus FROM s JOIN h USING (game_id)),
m AS (SELECT pitcher_team, avg(stuff_plus) FILTER (WHERE home) AS home_mean,
             avg(stuff_plus) FILTER (WHERE NOT home) AS road_mean FROM f GROUP BY pitcher_team)
SELECT pitcher_team, round(home_mean, 6) AS home_mean, round(road_mean, 6) AS road_mean,
       round(abs({normal_cdf_sql('(home_mean - 100.0) / 10.0')} / {normal_cdf_sql('(road_mean - 100.0) / 10.0')}) * 100, 6)
         AS park_factor
FROM m
""", "pitches", "rv")

_CC = ["start_speed", "az", "ax", "x0", "spin_rate"]
ORACLE["corr_matrix"] = with_views(
    "SELECT * FROM (" + " UNION ALL ".join(
        (f"SELECT '{a}' AS row, '{b}' AS col, CAST(1.0 AS DOUBLE) AS corr" if a == b else
         f"SELECT '{a}' AS row, '{b}' AS col, round(abs(corr({a}, {b})), 6) AS corr FROM pitches")
        for a in _CC for b in _CC) + ")", "pitches")

ORACLE["zone_values"] = with_views("""
WITH f AS (SELECT * FROM pitches WHERE zone BETWEEN 1 AND 14),
g AS (SELECT zone, CASE WHEN grouping(pitcher_hand) = 1 THEN 'All' ELSE pitcher_hand END AS pitcher_hand,
             sum(delta_run_exp) AS run_value
      FROM f GROUP BY ROLLUP (zone, pitcher_hand) HAVING grouping(zone) = 0),
hands AS (SELECT DISTINCT pitcher_hand FROM pitches WHERE pitcher_hand IS NOT NULL UNION SELECT 'All'),
grid AS (SELECT z.zone, h.pitcher_hand FROM range(1, 15) z(zone), hands h WHERE z.zone <> 10)
SELECT CAST(grid.zone AS INTEGER) AS zone, grid.pitcher_hand, round(coalesce(g.run_value, 0.0), 6) AS run_value
FROM grid LEFT JOIN g ON g.zone = grid.zone AND g.pitcher_hand = grid.pitcher_hand
""", "pitches")

ORACLE["location_ellipse"] = with_views("""
WITH g AS (SELECT batter_hand, pitch_type, count(px) AS n, avg(px) AS x_mean, avg(pz) AS y_mean,
                  var_samp(px) AS a, covar_samp(px, pz) AS b, var_samp(pz) AS c FROM pitches
           GROUP BY batter_hand, pitch_type),
e AS (SELECT *, (a + c) / 2 - sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS ls,
                (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS lb,
             n / sum(n) OVER (PARTITION BY batter_hand) AS share FROM g),
f AS (SELECT *, CASE WHEN b <> 0 THEN degrees(atan2(ls - a, b)) WHEN a <= c THEN 0.0 ELSE 90.0 END AS ang,
             n >= 5 AND a IS NOT NULL AS ok FROM e)
SELECT batter_hand, pitch_type, n, round(x_mean, 6) AS x_mean, round(y_mean, 6) AS y_mean, round(share, 6) AS share,
       round(CASE WHEN ok THEN 2 * sqrt(greatest(ls, 0.0)) END, 6) AS width,
       round(CASE WHEN ok THEN 2 * sqrt(greatest(lb, 0.0)) END, 6) AS height,
       round(CASE WHEN ok THEN ((ang % 180.0) + 180.0) % 180.0 END, 6) AS angle
FROM f
""", "pitches")

ORACLE["league_rollup"] = with_views(f"""
WITH p AS (SELECT *, coalesce(description IN ('foul_bunt', 'foul', 'hit_into_play', 'swinging_strike', 'foul_tip',
                      'swinging_strike_blocked', 'missed_bunt', 'bunt_foul_tip'), false) AS swing,
                  coalesce(description IN ('swinging_strike', 'foul_tip', 'swinging_strike_blocked'), false) AS whiff,
                  coalesce(zone < 10, false) AS in_zone, coalesce(zone > 10, false) AS out_zone,
                  {WOBA_A} AS woba FROM pitches),
q AS (SELECT *, NOT in_zone AND swing AS chase FROM p),
g AS (SELECT CASE WHEN grouping(pitch_type) = 1 THEN 'All' ELSE pitch_type END AS pitch_type,
             count(*) AS pitch, avg(start_speed) AS release_speed, avg(ax) AS pfx_x,
             sum(delta_run_exp) AS delta_run_exp, count(*) FILTER (WHERE swing) AS swing,
             count(*) FILTER (WHERE whiff) AS whiff, count(*) FILTER (WHERE in_zone) AS in_zone,
             count(*) FILTER (WHERE out_zone) AS out_zone, count(*) FILTER (WHERE chase) AS chase,
             avg(woba) AS xwoba
      FROM q GROUP BY ROLLUP (pitch_type)),
t AS (SELECT pitch AS total FROM g WHERE pitch_type = 'All')
SELECT pitch_type, pitch, round(release_speed, 6) AS release_speed, round(pfx_x, 6) AS pfx_x,
       round(delta_run_exp, 6) AS delta_run_exp, swing, whiff, in_zone, out_zone, chase, round(xwoba, 6) AS xwoba,
       round(pitch / total, 6) AS pitch_usage,
       round(CASE WHEN swing = 0 THEN NULL ELSE whiff / swing END, 6) AS whiff_rate,
       round(CASE WHEN pitch = 0 THEN NULL ELSE in_zone / pitch END, 6) AS in_zone_rate,
       round(CASE WHEN out_zone = 0 THEN NULL ELSE chase / out_zone END, 6) AS chase_rate,
       round(-100.0 * delta_run_exp / pitch, 6) AS delta_run_exp_per_100
FROM g, t
""", "pitches")

ORACLE["rolling_value"] = with_views("""
SELECT event_id, batter_id,
       CAST(row_number() OVER w AS INTEGER) AS seq,
       round(CASE WHEN count(value) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 50
                  THEN avg(value) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) END, 6) AS rolling_value
FROM pa_gaps WINDOW w AS (PARTITION BY batter_id ORDER BY ts, event_id)
""", "pa_gaps")

ORACLE["knn_expected_value"] = with_views(f"""
SELECT pitch_uid, CAST(tb AS INTEGER) AS tb, round(expected, 6) AS woba_pred, CAST(pred_class AS INTEGER) AS pred_class
FROM ({KNN})
""", "pitches")

ORACLE["xwoba_board"] = with_views(f"""
SELECT batter_id, woba_pa, round(woba, 6) AS woba, round(xwoba, 6) AS xwoba FROM ({XWOBA_BOARD})
""", "pitches")

ORACLE["confusion"] = with_views(f"""
SELECT CAST(tb AS INTEGER) AS tb,
       count(*) FILTER (WHERE pred_class = 0) AS pred_0, count(*) FILTER (WHERE pred_class = 1) AS pred_1,
       count(*) FILTER (WHERE pred_class = 2) AS pred_2, count(*) FILTER (WHERE pred_class = 3) AS pred_3,
       count(*) FILTER (WHERE pred_class = 4) AS pred_4
FROM ({KNN}) GROUP BY tb
""", "pitches")

ORACLE["class_report"] = with_views(f"""
WITH k AS ({KNN}),
cls AS (SELECT * FROM (VALUES (0), (1), (2), (3), (4)) c(cls)),
base AS (SELECT cls, (SELECT count(*) FROM k WHERE tb = cls) AS support,
                (SELECT count(*) FROM k WHERE tb = cls AND pred_class = cls) AS tp,
                (SELECT count(*) FROM k WHERE pred_class = cls) AS predicted FROM cls),
per AS (SELECT CAST(cls AS VARCHAR) AS row,
               CASE WHEN predicted > 0 THEN tp / predicted ELSE 1.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 1.0 END AS recall, support, tp FROM base),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                        ELSE 0.0 END AS f1 FROM per),
tot AS (SELECT CAST(sum(support) AS BIGINT) AS n, sum(tp) AS tp_all, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
               sum(f1 * support) / sum(support) AS wf FROM per2)
SELECT row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per2
UNION ALL SELECT 'accuracy', round(tp_all / n, 6), round(tp_all / n, 6), round(tp_all / n, 6), n FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), n FROM tot
UNION ALL SELECT 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), n FROM tot
""", "pitches")

ORACLE["r2_and_line"] = with_views(f"""
WITH b AS (SELECT round(woba, 6) AS woba, round(xwoba, 6) AS xwoba FROM ({XWOBA_BOARD})),
m AS (SELECT avg(xwoba) AS mu FROM b)
SELECT round(1.0 - sum((xwoba - woba) * (xwoba - woba)) / sum((xwoba - mu) * (xwoba - mu)), 6) AS r2,
       round(regr_slope(woba, xwoba), 6) AS slope, round(regr_intercept(woba, xwoba), 6) AS intercept,
       count(*) AS n
FROM b, m
""", "pitches")

ORACLE["histogram_40"] = with_views(f"""
WITH s AS (SELECT * FROM ({SCORED}) WHERE pitch_type IN {_in(HISTOGRAM_PITCH_TYPES)}
           AND stuff_plus >= 60 AND stuff_plus <= 140),
b AS (SELECT pitch_type, CAST(least(39, floor((stuff_plus - 60.0) / 2.0)) AS INTEGER) AS bin FROM s)
SELECT pitch_type, bin, count(*) AS n, round(CAST(60.0 + bin * 2.0 AS DOUBLE), 6) AS bin_lo,
       round(CAST(60.0 + bin * 2.0 + 2.0 AS DOUBLE), 6) AS bin_hi
FROM b GROUP BY pitch_type, bin
""", "pitches", "rv")

ORACLE["kde_1d"] = with_views(f"""
WITH py AS (SELECT pitcher_id, year, avg(stuff_plus) AS v FROM ({SCORED}) GROUP BY pitcher_id, year),
st AS (SELECT count(v) AS n, stddev_samp(v) AS sd FROM py),
g AS (SELECT CAST(i AS INTEGER) AS x_i, 60.0 + i * (CAST(80.0 AS DOUBLE) / 160) AS x FROM range(0, 161) r(i))
SELECT g.x_i, round(g.x, 6) AS x,
       round(sum(exp(-0.5 * ((g.x - py.v) / (st.sd * 0.8)) * ((g.x - py.v) / (st.sd * 0.8))))
             / (st.n * st.sd * 0.8 * sqrt(2 * pi())), 6) AS density
FROM g, py, st GROUP BY g.x_i, g.x, st.n, st.sd
""", "pitches", "rv")

ORACLE["kde_2d"] = with_views("""
WITH p AS (SELECT pitcher_hand, px, pz FROM pitches WHERE px IS NOT NULL AND pz IS NOT NULL),
st AS (SELECT pitcher_hand, count(*) AS n, var_samp(px) * pow(count(*), -1.0 / 3.0) * 0.81 AS ha,
              covar_samp(px, pz) * pow(count(*), -1.0 / 3.0) * 0.81 AS hb,
              var_samp(pz) * pow(count(*), -1.0 / 3.0) * 0.81 AS hd FROM p GROUP BY pitcher_hand),
st2 AS (SELECT *, ha * hd - hb * hb AS det FROM st),
gx AS (SELECT CAST(i AS INTEGER) AS gx_i, -1.5 + i * (CAST(3.0 AS DOUBLE) / 24) AS gx FROM range(0, 25) r(i)),
gy AS (SELECT CAST(i AS INTEGER) AS gy_i, 0.5 + i * (CAST(4.0 AS DOUBLE) / 24) AS gy FROM range(0, 25) r(i))
SELECT p.pitcher_hand, gx_i, gy_i, round(gx, 6) AS gx, round(gy, 6) AS gy,
       round(sum(exp(-0.5 * (hd * (gx - px) * (gx - px) - 2 * hb * (gx - px) * (gy - pz) + ha * (gy - pz) * (gy - pz)) / det))
             / (n * 2 * pi() * sqrt(det)), 6) AS density
FROM p JOIN st2 USING (pitcher_hand), gx, gy
GROUP BY p.pitcher_hand, gx_i, gy_i, gx, gy, n, det
""", "pitches")

_YC = ["stuff_plus", "rv100", "whiff_rate", "rv100_next", "whiff_rate_next"]
ORACLE["year_over_year"] = with_views(f"""
WITH sc AS (SELECT pitcher_id, year, count(stuff_plus) AS count, avg(stuff_plus) AS stuff_plus
            FROM ({SCORED}) GROUP BY pitcher_id, year),
res AS (SELECT pitcher_id, year, -100.0 * avg(delta_run_exp) AS rv100,
               avg(CAST({WHIFF} AS DOUBLE)) AS whiff_rate FROM pitches GROUP BY pitcher_id, year),
j AS (SELECT sc.stuff_plus, r.rv100, r.whiff_rate, n.rv100 AS rv100_next, n.whiff_rate AS whiff_rate_next
      FROM sc JOIN res r USING (pitcher_id, year) JOIN res n ON n.pitcher_id = sc.pitcher_id AND n.year = sc.year + 1
      WHERE sc.count >= 100)
SELECT * FROM (""" + " UNION ALL ".join(
    (f"SELECT '{a}' AS row, '{b}' AS col, CAST(1.0 AS DOUBLE) AS corr" if a == b else
     f"SELECT '{a}' AS row, '{b}' AS col, round(abs(corr({a}, {b})), 6) AS corr FROM j")
    for a in _YC for b in _YC) + ")", "pitches", "rv")

ORACLE["outer_merge"] = """
WITH a AS (SELECT p_partkey AS key, p_retailprice AS value FROM part),
b AS (SELECT o_custkey AS key, count(*) AS n, max(o_totalprice) AS value FROM orders GROUP BY o_custkey),
c AS (SELECT l_suppkey AS key, count(*) AS n, avg(round(l_discount * 100)) AS rate FROM lineitem GROUP BY l_suppkey)
SELECT coalesce(a.key, b.key, c.key) AS key, round(a.value, 6) AS value_bat, b.n AS n_oaa,
       round(b.value, 6) AS value_oaa, c.n AS n_cfr, round(c.rate, 6) AS rate
FROM a FULL OUTER JOIN b ON a.key = b.key FULL OUTER JOIN c ON coalesce(a.key, b.key) = c.key
"""

ORACLE["parent_lookup"] = """
WITH s AS (SELECT s_suppkey AS team_id, s_name AS name,
                  CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey - s_suppkey % 10 END AS parent_org_id FROM supplier)
SELECT s.team_id, s.name, s.parent_org_id, p.name AS parent_org_name
FROM s LEFT JOIN s p ON p.team_id = coalesce(s.parent_org_id, s.team_id)
"""

ORACLE["dedupe_latest"] = """
SELECT event_id, user_id, event_type, round(value, 6) AS value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""

ORACLE["union_distinct"] = """
SELECT user_id AS id, event_type AS kind FROM events UNION SELECT o_custkey, o_orderpriority FROM orders
"""

ORACLE["actual_vs_projected"] = """
SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS BIGINT) AS year, round(avg(round(l_discount * 100)) / 100 * 100, 6) AS k_pct,
       round(sum(l_quantity), 6) AS war, CASE l_returnflag WHEN 'R' THEN 'actual' ELSE 'projection' END AS kind
FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY l_suppkey, year(l_shipdate), l_returnflag
"""

ORACLE["league_position"] = with_views(f"""
WITH per AS (SELECT pitcher_id, pitch_type, avg(start_speed) AS velo, avg(CAST({WHIFF} AS DOUBLE)) * 100 AS whiff_pct
             FROM pitches GROUP BY pitcher_id, pitch_type),
lng AS (SELECT pitcher_id, pitch_type, 'velo' AS metric, velo AS value FROM per
        UNION ALL SELECT pitcher_id, pitch_type, 'whiff_pct', whiff_pct FROM per),
lg AS (SELECT pitch_type, metric, avg(value) AS a, CASE WHEN metric = 'velo' THEN 4.0 ELSE 8.0 END AS h
       FROM lng GROUP BY pitch_type, metric)
SELECT lng.pitcher_id, lng.pitch_type, lng.metric, round(lng.value, 6) AS value,
       round(CASE WHEN (lg.a + lg.h) - (lg.a - lg.h) = 0 THEN NULL
                  ELSE (lng.value - (lg.a - lg.h)) / ((lg.a + lg.h) - (lg.a - lg.h)) END, 6) AS position
FROM lng LEFT JOIN lg USING (pitch_type, metric)
""", "pitches")

ORACLE["percentile_ranks"] = with_views(f"""
WITH per AS (SELECT batter_id, year, avg(start_speed) AS exit_velo, avg(CAST({WHIFF} AS DOUBLE)) AS whiff_rate
             FROM pitches GROUP BY batter_id, year),
lng AS (SELECT batter_id, year, 'exit_velo' AS metric, exit_velo AS value FROM per
        UNION ALL SELECT batter_id, year, 'whiff_rate', whiff_rate FROM per),
gap AS (SELECT batter_id, CASE WHEN batter_id % 7 <> 0 THEN year END AS year, metric,
               CASE WHEN batter_id % 5 = 0 OR batter_id % 11 = 0 THEN NULL WHEN batter_id % 3 = 0 THEN 0.5 ELSE value END AS value
        FROM lng)
SELECT batter_id, year, metric, round(value, 6) AS value,
       CAST(round(CASE WHEN metric = 'whiff_rate'
                       THEN percent_rank() OVER (PARTITION BY year, metric ORDER BY value DESC)
                       ELSE percent_rank() OVER (PARTITION BY year, metric ORDER BY value ASC) END * 100) AS INTEGER)
         AS percentile
FROM gap WHERE value IS NOT NULL
UNION ALL SELECT batter_id, year, metric, NULL, NULL FROM gap WHERE value IS NULL
""", "pitches")

ORACLE["best_per_type"] = with_views(f"""
WITH g AS ({_pitch_grades(["staff"]).replace("{thr}", "40").replace(
    f"WITH s AS ({SCORED})", f"WITH s AS (SELECT sc.*, t.pitcher_team AS staff FROM ({SCORED}) sc JOIN {TEAM} t USING (pitcher_id))")})
SELECT pitch_type, staff, pitches, round(stuff_plus, 6) AS stuff_plus, round(pitch_grade, 6) AS pitch_grade
FROM (SELECT *, row_number() OVER (PARTITION BY pitch_type ORDER BY pitch_grade DESC, staff ASC) AS rn
      FROM g WHERE pitches >= 150 AND pitch_type IN ('FF', 'SI', 'FC', 'SL', 'ST', 'CH', 'FS', 'CU', 'KC')) WHERE rn = 1
""", "pitches", "rv")

ORACLE["leaderboard"] = with_views(f"""
WITH sc AS (SELECT pitcher_id, count(stuff_plus) AS count, avg(stuff_plus) AS stuff_plus
            FROM ({SCORED}) GROUP BY pitcher_id),
t AS (SELECT * FROM sc WHERE count > 100 ORDER BY stuff_plus DESC, pitcher_id ASC LIMIT 20)
SELECT pitcher_id, count, round(stuff_plus, 6) AS stuff_plus,
       CAST(row_number() OVER (ORDER BY stuff_plus DESC, pitcher_id ASC) AS INTEGER) AS rank
FROM t
""", "pitches", "rv")

ORACLE["json_props"] = """
SELECT event_type, count(*) AS n, count(k) AS n_k, round(avg(k), 6) AS avg_k, CAST(sum(k) AS BIGINT) AS sum_k
FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type
"""

ORACLE["count_before_event"] = with_views("""
WITH p AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY game_id, (ab_number - 1) // 3) AS n,
                  lag(balls) OVER w AS b, lag(strikes) OVER w AS s FROM pitches
           WINDOW w AS (PARTITION BY game_id, (ab_number - 1) // 3 ORDER BY ab_number, tb_p, tb_s, tb_q, tb_e))
SELECT pitch_uid, coalesce(b, 0) AS balls_before, coalesce(s, 0) AS strikes_before, k = n AS is_last,
       CASE WHEN k = n THEN event_type END AS pa_event
FROM p
""", "pitches")

ORACLE["null_counts"] = with_views("""
SELECT 'zone' AS "column", count(*) FILTER (WHERE zone IS NULL) AS nulls FROM pitches
UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_type IS NULL) FROM pitches
UNION ALL SELECT 'launch_speed', count(*) FILTER (WHERE launch_speed IS NULL) FROM pitches
UNION ALL SELECT 'launch_angle', count(*) FILTER (WHERE launch_angle IS NULL) FROM pitches
UNION ALL SELECT 'play_description', count(*) FILTER (WHERE play_description IS NULL) FROM pitches
""", "pitches")

ORACLE["std_grains"] = with_views(f"""
WITH s AS (SELECT sc.*, t.pitcher_team FROM ({SCORED}) sc JOIN {TEAM} t USING (pitcher_id)),
p AS (SELECT pitcher_id, avg(stuff_plus) AS v FROM s GROUP BY pitcher_id),
t AS (SELECT pitcher_team, avg(stuff_plus) AS v FROM s GROUP BY pitcher_team)
SELECT 'pitch' AS grain, round(stddev_samp(stuff_plus), 6) AS std, count(stuff_plus) AS n FROM s
UNION ALL SELECT 'pitcher', round(stddev_samp(v), 6), count(v) FROM p
UNION ALL SELECT 'team', round(stddev_samp(v), 6), count(v) FROM t
""", "pitches", "rv")

ORACLE["median_order"] = with_views("""
SELECT pitch_type, round(median(spin_rate), 6) AS category_median, count(*) AS n FROM pitches_gaps GROUP BY pitch_type
""", "pitches_gaps")

ORACLE["distinct_values"] = with_views("SELECT DISTINCT pitch_type, play_description FROM pitches", "pitches")

ORACLE["mean_count"] = """
SELECT count(pitches) AS n, CAST(floor(avg(pitches)) AS BIGINT) AS mean_floor
FROM (SELECT l_suppkey, count(*) AS pitches FROM lineitem GROUP BY l_suppkey)
"""

ORACLE["whiff_target"] = with_views(f"""
SELECT pitch_type, {OUTCOME} AS outcome, count(*) AS n,
       CAST(sum(CASE WHEN {SWING} AND {WHIFF} THEN 1 ELSE 0 END) AS BIGINT) AS whiffs
FROM pitches GROUP BY ALL
""", "pitches")

ORACLE["player_row"] = with_views(f"""
SELECT pitcher_id, printf('%.1f', avg(spin_rate)) AS spin_txt,
       printf('%.3f%%', avg(CAST({WHIFF} AS DOUBLE)) * 100) AS whiff_txt, '--' AS undefined_txt
FROM pitches GROUP BY pitcher_id
""", "pitches")

ORACLE["feed_flatten"] = """
SELECT o.o_orderkey AS game_id, CAST(o.o_orderdate AS DATE) AS game_date,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                                                             l.l_quantity, l.l_extendedprice) - 1 AS INTEGER) AS ab_number,
       l.l_partkey AS batter_id, l.l_suppkey AS pitcher_id,
       CASE WHEN l.l_partkey % 2 = 0 THEN o.o_orderpriority ELSE o.o_orderstatus END AS pitcher_team,
       CASE WHEN l.l_partkey % 2 = 0 THEN o.o_orderstatus ELSE o.o_orderpriority END AS batter_team,
       l.l_returnflag AS play_description, l.l_linestatus AS play_code,
       round(l.l_quantity, 6) AS start_speed, round(l.l_extendedprice, 6) AS end_speed,
       0 AS balls, 0 AS strikes, coalesce(l.l_linestatus IN ('X','F','S','D','E','T','W'), false) AS is_swing,
       'pitch' AS row_kind
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

ORACLE["schedule_games"] = """
WITH g AS (
  SELECT l_orderkey AS game_id, CAST(l_shipdate AS DATE) AS date,
         l_shipdate + to_hours(CAST(l_linenumber + 12 AS BIGINT)) AS start_utc,
         l_partkey AS away_id, l_suppkey + 1000 AS home_id, l_suppkey AS venue_id,
         l_returnflag AS game_type, l_linestatus AS gameday_type, 'F' AS state
  FROM lineitem WHERE l_linenumber <> 7),
d AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY start_utc, venue_id, away_id, home_id, state) AS rn
      FROM g)
SELECT game_id, date, start_utc,
       strftime(timezone('America/New_York', CAST(strftime(start_utc, '%Y-%m-%d %H:%M:%S') || '+00' AS TIMESTAMPTZ)),
                '%I:%M %p') AS time,
       away_id, home_id, venue_id, game_type, gameday_type, state
FROM d WHERE rn = 1
"""

ORACLE["teams_parent"] = """
WITH t AS (SELECT DISTINCT s_suppkey AS team_id, 'City ' || CAST(s_nationkey AS VARCHAR) AS city, s_name AS name,
                  right(s_name, 3) AS abbreviation,
                  coalesce(CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey - s_suppkey % 10 END, s_suppkey) AS parent_org_id,
                  s_name AS parent_org_raw,
                  CAST(s_nationkey AS BIGINT) AS league_id, CAST(s_nationkey % 3 AS BIGINT) AS sport_id
           FROM supplier)
SELECT t.team_id, t.city, t.name, t.abbreviation, t.parent_org_id,
       t.name AS parent_org,
       p.abbreviation AS parent_org_abbreviation, t.league_id, t.sport_id
FROM t LEFT JOIN t p ON p.team_id = t.parent_org_id
"""

ORACLE["player_games"] = """
SELECT o_custkey AS player_id, o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS date,
       o_orderpriority AS opponent, CAST(floor(o_totalprice / 1000) AS BIGINT) AS outs,
       CAST(floor(o_totalprice / 5000) AS BIGINT) AS strikeouts
FROM orders WHERE year(o_orderdate) = 1996
"""

ORACLE["leaderboard_rows"] = """
SELECT l_suppkey AS xMLBAMID, CAST(year(l_shipdate) AS BIGINT) AS Season, count(DISTINCT l_orderkey) AS G,
       round(sum(l_quantity), 6) AS IP, round(avg(round(l_discount * 100)), 6) AS k_bb_pct, count(*) AS Pitches,
       CAST(NULL AS DOUBLE) AS ERA
FROM lineitem GROUP BY l_suppkey, year(l_shipdate)
"""

ORACLE["stream_ingest"] = """
SELECT l.l_orderkey AS game_id,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                                                             l.l_quantity, l.l_extendedprice) - 1 AS INTEGER) AS ab_number,
       0 AS index_play, l.l_suppkey AS pitcher_id,
       round(l.l_quantity + CASE WHEN l.l_orderkey % 2 = 0 THEN 0.5 ELSE 0.0 END, 6) AS start_speed,
       round(l.l_extendedprice, 6) AS end_speed
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

ORACLE["stream_plays"] = """
WITH p AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) - 1 AS place,
         count(*) OVER (PARTITION BY l.l_orderkey) AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l_orderkey AS game_id, CAST(place AS INTEGER) AS ab_number, 0 AS index_play, l_suppkey AS pitcher_id,
       round(l_quantity + CASE WHEN l_orderkey % 2 = 0 THEN 0.5 ELSE 0.0 END, 6) AS start_speed, round(l_extendedprice, 6) AS end_speed,
       l_orderkey % 5 <> 0 OR n = 1 OR place < n - 1 AS current
FROM p
"""

ORACLE["stream_boards"] = """
WITH p AS (
  SELECT l.l_suppkey AS pitcher_id, l.l_linestatus AS play_code,
         l.l_quantity + CASE WHEN l.l_orderkey % 3 = 0 THEN 1.0 WHEN l.l_orderkey % 2 = 0 THEN 0.5 ELSE 0.0 END AS v
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
league AS (SELECT avg(v) AS m, stddev_samp(v) AS d FROM p)
SELECT pitcher_id, play_code, count(*) AS rows, count(v) AS n_start_speed, round(CAST(sum(v) AS DOUBLE), 6) AS sum_start_speed,
       round(avg(v), 6) AS mean_start_speed, round(stddev_samp(v), 6) AS std_start_speed,
       round(100 + 10 * (avg(v) - any_value(m)) / any_value(d), 6) AS plus_start_speed
FROM p, league GROUP BY pitcher_id, play_code
"""

ORACLE["games_sketch"] = with_views("""
SELECT CASE WHEN grouping(pitcher_id) = 0 THEN 'pitcher' WHEN grouping(pitch_type) = 0 THEN 'type' ELSE 'all' END AS level,
       pitcher_id, pitch_type, count(DISTINCT game_id) AS games, TRUE AS within_bound
FROM pitches GROUP BY GROUPING SETS ((pitcher_id, pitch_type), (pitch_type), ())
""", "pitches")

ORACLE["actual_projection_pair"] = """
WITH g AS (SELECT l_partkey AS player_id, CAST(year(l_shipdate) AS BIGINT) AS year, l_returnflag, sum(l_quantity) AS war,
                  count(*) AS games FROM lineitem GROUP BY ALL),
k AS (SELECT player_id, year FROM g WHERE l_returnflag = 'R' INTERSECT SELECT player_id, year FROM g WHERE l_returnflag = 'A')
SELECT player_id, year, round(war, 6) AS war, games, CASE l_returnflag WHEN 'R' THEN 'actual' ELSE 'projection' END AS row_label
FROM g SEMI JOIN k USING (player_id, year) WHERE l_returnflag IN ('R', 'A')
"""

_SEASON_MEANS = f"""
WITH k AS ({KNN_SEASON}),
j AS (SELECT p.pitcher_id, p.pitch_type, {WOBA_A} AS woba, k.expected
      FROM pitches p JOIN k USING (pitch_uid, tb_p, tb_s, tb_q, tb_e))
SELECT pitcher_id, pitch_type, count(expected) AS bip, round(avg(woba), 6) AS wobacon,
       round(avg(expected), 6) AS xwobacon
FROM j GROUP BY pitcher_id, pitch_type
"""
ORACLE["pitch_type_xwoba"] = with_views(_SEASON_MEANS, "pitches")

ORACLE["pitches_with_xwoba"] = with_views(f"""
SELECT p.pitch_uid, m.bip, m.wobacon, m.xwobacon
FROM pitches p LEFT JOIN ({_SEASON_MEANS}) m ON m.pitcher_id = p.pitcher_id AND m.pitch_type = p.pitch_type
WHERE p.year = 1998
""", "pitches")

ORACLE["xwoba_published"] = with_views(f"""
SELECT b.batter_id, b.woba_pa, round(b.woba, 6) AS woba, round(b.xwoba, 6) AS xwoba, m.woba_pa AS "woba_pa_MLB",
       round(m.woba, 6) AS "woba_MLB"
FROM ({XWOBA_BOARD}) b
LEFT JOIN (SELECT batter_id, count(*) AS woba_pa, avg({WOBA_A}) AS woba FROM pitches
           WHERE year = 1997 AND event_type IS NOT NULL GROUP BY batter_id HAVING count(*) > 180) m USING (batter_id)
""", "pitches")

ORACLE["rolling_woba"] = with_views("""
WITH p AS (SELECT *, CASE event WHEN 'walk' THEN 0.696 WHEN 'hit_by_pitch' THEN 0.726 WHEN 'single' THEN 0.883
                                WHEN 'double' THEN 1.244 WHEN 'triple' THEN 1.569 WHEN 'home_run' THEN 2.004
                                ELSE 0.0 END AS woba, value / 100 AS xwoba FROM pa_gaps)
SELECT event_id, batter_id, CAST(row_number() OVER w AS INTEGER) AS seq,
       round(CASE WHEN count(woba) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 50
                  THEN avg(woba) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) END, 6) AS rolling_woba,
       round(CASE WHEN count(xwoba) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 50
                  THEN avg(xwoba) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) END, 6) AS rolling_xwoba
FROM p WINDOW w AS (PARTITION BY batter_id ORDER BY ts, event_id)
""", "pa_gaps")

ORACLE["box_score_players"] = """
SELECT l_orderkey AS game_id, 'home' AS side,
       concat_ws('-', CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                 CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR)) AS key,
       l_partkey AS player_id, CAST(l_quantity AS BIGINT) AS outs
FROM lineitem
"""

_LAUNCH_KDE = """
WITH p AS (SELECT @TB@ AS tb, launch_angle AS x, launch_speed AS y FROM pitches WHERE launch_speed > 0
           ORDER BY md5(concat_ws('|', '42', pitch_uid, tb_p, tb_s, tb_q::BIGINT, round(tb_e * 100)::BIGINT)),
                    pitch_uid, tb_p, tb_s, tb_q, tb_e LIMIT 10000),
st AS (SELECT tb, count(*) AS n, var_samp(x) * pow(count(*), -1.0 / 3.0) * 1.0 AS ha,
              covar_samp(x, y) * pow(count(*), -1.0 / 3.0) * 1.0 AS hb,
              var_samp(y) * pow(count(*), -1.0 / 3.0) * 1.0 AS hd FROM p GROUP BY tb),
st2 AS (SELECT *, ha * hd - hb * hb AS det FROM st),
gx AS (SELECT CAST(i AS INTEGER) AS gx_i, -30.0 + i * (CAST(90.0 AS DOUBLE) / 19) AS gx FROM range(0, 20) r(i)),
gy AS (SELECT CAST(i AS INTEGER) AS gy_i, 60.0 + i * (CAST(50.0 AS DOUBLE) / 19) AS gy FROM range(0, 20) r(i))
SELECT CAST(p.tb AS INTEGER) AS tb, gx_i, gy_i, round(gx, 6) AS gx, round(gy, 6) AS gy,
       round(sum(exp(-0.5 * (hd * (gx - x) * (gx - x) - 2 * hb * (gx - x) * (gy - y) + ha * (gy - y) * (gy - y)) / det))
             / ((SELECT count(*) FROM p) * 2 * pi() * sqrt(det)), {digits}) AS density
FROM p JOIN st2 USING (tb), gx, gy GROUP BY p.tb, gx_i, gy_i, gx, gy, n, det
""".replace("@TB@", TB)
ORACLE["launch_kde_sample"] = with_views(_LAUNCH_KDE.replace("{digits}", "6"), "pitches")

ORACLE["launch_mass_levels"] = with_views(f"""
WITH cells AS (SELECT tb, density FROM ({_LAUNCH_KDE.replace("{digits}", "9")}) WHERE density > 0),
cum AS (SELECT tb, density, sum(density) OVER (PARTITION BY tb ORDER BY density DESC) AS c, sum(density) OVER (PARTITION BY tb) AS a FROM cells)
SELECT tb, share, round(max(density), 6) AS level
FROM cum, (SELECT i / CAST(10 AS DOUBLE) AS share FROM range(1, 10) r(i)) WHERE c >= share * a * (1 - 1e-9) GROUP BY tb, share
""", "pitches")

ORACLE["exact_split"] = with_views("""
WITH h AS (SELECT year, pitch_uid, row_number() OVER (ORDER BY md5(concat_ws('|', '42', pitch_uid, tb_p, tb_s, tb_q::BIGINT, round(tb_e * 100)::BIGINT)))
                  <= ceil(0.2 * count(*) OVER ()) AS is_test FROM pitches)
SELECT year, is_test, count(*) AS n, sum(pitch_uid)::BIGINT AS uid_sum FROM h GROUP BY year, is_test
""", "pitches")

ORACLE["knn_stored_index"] = with_views(f"""
SELECT pitch_uid, tb_p, tb_s, round(tb_q, 6) AS tb_q, round(tb_e, 6) AS tb_e, tb, round(expected, 6) AS expected, pred_class FROM ({KNN_SEASON})
""", "pitches")

