"""DuckDB oracle SQL of the queries in ``side_driver.py``, written from the operator definitions."""

from __future__ import annotations

from moundlake.functions.mathx import normal_cdf_sql
from moundlake.plans.oracle import KNN_SEASON, OUTCOME, SCORED, SWING, TARGET, TEAM, WHIFF, WOBA_A
from moundlake.plans.oracle_views import with_views
from moundlake.schemas import EVENT_OUTCOME, PITCH_TYPE_NAMES

WOBA_B = ("CASE event_type WHEN 'walk' THEN 0.684 WHEN 'hit_by_pitch' THEN 0.715 WHEN 'single' THEN 0.880 "
          "WHEN 'double' THEN 1.261 WHEN 'triple' THEN 1.604 WHEN 'home_run' THEN 2.085 ELSE 0.0 END")
NAME = "CASE pitch_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PITCH_TYPE_NAMES.items()) + " ELSE pitch_type END"

SIDE_ORACLE: dict[str, str] = {}

SIDE_ORACLE["leagues_sports"] = """
SELECT n_nationkey::BIGINT AS league_id, n_name AS league_name, substr(n_name, 1, 3) AS league_abbreviation,
       r_regionkey::BIGINT AS sport_id, lower(r_name) AS sport_code, r_name AS sport_name, CAST(NULL AS VARCHAR) AS sport_abbreviation
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""

SIDE_ORACLE["game_type_values"] = """
SELECT DISTINCT substr(o_orderpriority, 1, 1) AS game_type, o_orderpriority AS description FROM orders
"""

SIDE_ORACLE["people_rows"] = """
SELECT c_custkey AS player_id, lower(c_mktsegment) AS first_name, c_mktsegment || ' ' || c_name AS name,
       substr(c_mktsegment, 1, 2) AS position, c_nationkey::BIGINT AS team,
       CASE WHEN c_acctbal > 0 THEN floor(c_acctbal)::BIGINT END AS weight, CAST(NULL AS VARCHAR) AS bats, CAST(NULL AS DATE) AS birth_date,
       CASE WHEN n_regionkey = 1 THEN substr(n_name, 1, 3) END AS team_abbr
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O'))
"""

SIDE_ORACLE["player_lookup"] = """
SELECT c_custkey AS player_id, lower(c_mktsegment) AS first_name, c_mktsegment || ' ' || c_name AS name FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
"""

SIDE_ORACLE["games_of_types"] = """
SELECT o_orderkey AS game_id FROM orders WHERE o_orderdate::DATE = DATE '1996-02-14' AND o_orderstatus IN ('F', 'O')
"""

SIDE_ORACLE["game_log_lines"] = """
SELECT o_custkey AS player_id, o_orderkey AS game_id, o_orderdate::DATE AS date, o_orderpriority AS opponent, outs,
       (outs // 3)::VARCHAR || '.' || (outs % 3)::VARCHAR AS innings_pitched, floor(o_totalprice / 5000)::BIGINT AS strikeouts,
       o_orderkey % 4 AS walks, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 6 END AS earned_runs, o_orderkey % 8 AS hits,
       o_custkey % 3 AS home_runs, outs + 5 AS batters_faced
FROM (SELECT *, floor(o_totalprice / 1000)::BIGINT AS outs FROM orders)
"""

SIDE_ORACLE["requested_games"] = """
WITH o AS (SELECT o_custkey AS player_id, o_orderdate::DATE AS date, o_orderkey AS game_id FROM orders),
r AS (SELECT player_id, date FROM o UNION SELECT player_id, date + 1 FROM o),
g AS (SELECT r.player_id, r.date, o.game_id FROM r JOIN o USING (player_id, date)
      UNION ALL SELECT r.player_id, r.date, o.game_id FROM r JOIN o ON o.date = r.date
      WHERE NOT EXISTS (SELECT 1 FROM o x WHERE x.player_id = r.player_id AND x.date = r.date))
SELECT player_id, date, count(*) AS games, min(game_id) AS first_game, max(game_id) AS last_game FROM g GROUP BY player_id, date
"""

_BATTING = f"""
SELECT batter_id AS "xMLBAMID", year AS "Season", count(*) AS "PA", count(*) FILTER (WHERE event_type = 'home_run') AS "HR",
       round(count(*) FILTER (WHERE event_type = 'strikeout') / count(*), 6) AS k_pct,
       round(count(*) FILTER (WHERE event_type = 'walk') / count(*), 6) AS bb_pct, floor(sum(CAST(round(({WOBA_B}) * 1000) AS BIGINT)) * 1000 / count(*)) / CAST(1000000 AS DOUBLE) AS "wOBA"
FROM pitches WHERE event_type IS NOT NULL GROUP BY batter_id, year
"""
SIDE_ORACLE["batting_board"] = with_views(_BATTING, "pitches")
SIDE_ORACLE["csv_round_trip"] = with_views(_BATTING, "pitches")

SIDE_ORACLE["yearly_tables"] = with_views(f"""
SELECT "xMLBAMID", "PA", CASE WHEN "Season" <> 1997 THEN "HR" END AS "HR", k_pct, bb_pct, "wOBA", CAST("Season" AS INTEGER) AS year FROM ({_BATTING})
""", "pitches")
SIDE_ORACLE["feed_quarantine"] = """
SELECT o_orderkey AS game_id, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE count(*) END AS events, o_orderkey % 7 = 0 AS quarantined
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
"""

SIDE_ORACLE["season_tables"] = with_views("""
SELECT year, count(*) AS n, round(avg(start_speed), 6) AS start_speed FROM pitches GROUP BY year
""", "pitches")

_SWING_D = ("coalesce(description IN ('foul_bunt', 'foul', 'hit_into_play', 'swinging_strike', 'foul_tip', "
            "'swinging_strike_blocked', 'missed_bunt', 'bunt_foul_tip'), false)")
SIDE_ORACLE["statcast_rows"] = with_views(f"""
SELECT pitch_uid, game_date, round(ax * 12, 6) AS pfx_x, round(x0 * 12, 6) AS pfx_z, {_SWING_D} AS swing,
       coalesce(description IN ('swinging_strike', 'foul_tip', 'swinging_strike_blocked'), false) AS whiff,
       coalesce(zone < 10, false) AS in_zone, coalesce(zone > 10, false) AS out_zone,
       NOT coalesce(zone < 10, false) AND {_SWING_D} AS chase
FROM pitches WHERE batter_id = 7 AND game_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
""", "pitches")

SIDE_ORACLE["fielding_and_framing"] = with_views("""
WITH a AS (SELECT tb_p AS k, count(*) AS attempts, sum(delta_run_exp) AS runs FROM pitches WHERE launch_speed > 75 GROUP BY tb_p),
b AS (SELECT tb_p AS k, count(*) AS called_pitches, sum(x0) AS runs FROM pitches WHERE description IN ('called_strike', 'ball')
      GROUP BY tb_p HAVING count(*) >= 5)
SELECT coalesce(a.k, b.k) AS "xMLBAMID", attempts, round(a.runs, 6) AS runs_oaa, called_pitches, round(b.runs, 6) AS runs_cfr
FROM a FULL OUTER JOIN b ON a.k = b.k
""", "pitches")

SIDE_ORACLE["qualified_percentiles"] = with_views("""
WITH per AS (SELECT batter_id, year, avg(start_speed) AS exit_velo, avg(ax) AS br FROM pitches GROUP BY batter_id, year HAVING count(*) >= 100),
lng AS (SELECT batter_id, year, 'exit_velo' AS metric, exit_velo AS value FROM per UNION ALL SELECT batter_id, year, 'break', br FROM per)
SELECT batter_id, year, metric, round(value, 6) AS value,
       CAST(round(percent_rank() OVER (PARTITION BY year, metric ORDER BY value) * 100) AS INTEGER) AS percentile
FROM lng
""", "pitches")


def _rates(by: str, total: str, means: str, more: str, source: str) -> str:
    """The arsenal table of ``source`` (rows with swing, whiff, is_strike, woba, batted)."""
    return f"""
g AS (SELECT {by}, pitch_type, count(*) FILTER (WHERE is_pitch) AS pitches, count(*) FILTER (WHERE swing) AS swings,
             count(*) FILTER (WHERE whiff) AS whiffs, count(*) FILTER (WHERE is_strike) AS strikes,
             count(*) FILTER (WHERE zone < 10 AND is_pitch) AS in_zone, count(*) FILTER (WHERE zone > 10) AS out_zone,
             count(*) FILTER (WHERE zone > 10 AND swing) AS chases, {means}
      FROM {source} GROUP BY {by}, pitch_type)
SELECT g.*, round(CASE WHEN sum(pitches) OVER (PARTITION BY {total}) = 0 THEN NULL
                       ELSE pitches / sum(pitches) OVER (PARTITION BY {total}) END, 6) AS pitch_pct,
       round(CASE WHEN swings = 0 THEN NULL ELSE whiffs / swings END, 6) AS whiff_pct,
       round(CASE WHEN out_zone = 0 THEN NULL ELSE chases / out_zone END, 6) AS chase_pct,
       round(CASE WHEN pitches = 0 THEN NULL ELSE in_zone / pitches END, 6) AS zone_pct{more}
FROM g
"""


_INPUT = f"""r AS (SELECT *, {SWING} AS swing, {WHIFF} AS whiff, {WOBA_A} AS woba, coalesce(launch_speed > 0, false) AS batted,
  coalesce(play_description IN ('Called Strike', 'Swinging Strike'), false) AS is_strike,
  vy0 * vy0 - 2.0 * ay * (y0 - CAST(17.0 AS DOUBLE) / 12.0) AS rad FROM pitches),
a AS (SELECT *, CASE WHEN rad >= 0 THEN -sqrt(rad) END AS vyf FROM r),
b AS (SELECT *, CASE WHEN ay <> 0 THEN (vyf - vy0) / ay END AS t FROM a),
p AS (SELECT *, CASE WHEN vyf <> 0 THEN -degrees(atan((vz0 + az * t) / vyf)) END AS vaa,
             CASE WHEN vyf <> 0 THEN -degrees(atan((vx0 + ax * t) / vyf)) END AS haa FROM b)"""

_AVG = lambda c, name=None: f"round(avg({c}), 6) AS {name or c}"
SIDE_ORACLE["arsenal_table"] = with_views(
    f"WITH {_INPUT}, k AS ({KNN_SEASON}), s AS (SELECT p.*, k.expected FROM p LEFT JOIN k USING (pitch_uid, tb_p, tb_s, tb_q, tb_e) "
    "WHERE year = 1998)," + _rates(
        "pitcher_id", "pitcher_id",
        ", ".join([_AVG("start_speed"), _AVG("az", "ivb"), _AVG("ax", "hb"), *map(_AVG, ("x0", "z0", "extension", "spin_rate", "vaa", "haa")),
                   "round(avg(CASE WHEN batted THEN woba END), 6) AS wobacon",
                   "round(avg(CASE WHEN batted THEN expected END), 6) AS xwobacon"]),
        f", {NAME} AS pitch_name", "s"), "pitches")

SIDE_ORACLE["batter_arsenal"] = with_views(
    f"WITH {_INPUT}," + _rates("batter_id", "batter_id", _AVG("start_speed"), "", "p"), "pitches")

SIDE_ORACLE["team_boards"] = with_views(f"""
WITH s AS (SELECT sc.*, t.pitcher_team FROM ({SCORED}) sc JOIN {TEAM} t USING (pitcher_id)),
pos AS (SELECT pitcher_id, year, CASE WHEN count(stuff_plus) / count(DISTINCT game_id) >= 1.05 THEN 'SP' ELSE 'RP' END AS board
        FROM s GROUP BY pitcher_id, year),
j AS (SELECT s.pitcher_team, s.stuff_plus, pos.board FROM s JOIN pos USING (pitcher_id, year)),
h AS (SELECT game_id, arg_min(pitcher_team, (start_time, ab_number, tb_p, tb_s, tb_q, tb_e)) AS home_team FROM s GROUP BY game_id),
m AS (SELECT s.pitcher_team, avg(stuff_plus) FILTER (WHERE s.pitcher_team = h.home_team) AS hm,
             avg(stuff_plus) FILTER (WHERE s.pitcher_team <> h.home_team) AS rm FROM s JOIN h USING (game_id) GROUP BY s.pitcher_team),
u AS (SELECT 'All' AS board, pitcher_team, avg(stuff_plus) AS value FROM j GROUP BY pitcher_team
      UNION ALL SELECT board, pitcher_team, avg(stuff_plus) FROM j GROUP BY board, pitcher_team
      UNION ALL SELECT 'park factor', pitcher_team, abs({normal_cdf_sql('(hm - 100.0) / 10.0')} / {normal_cdf_sql('(rm - 100.0) / 10.0')}) * 100 FROM m),
v AS (SELECT board, CAST(pitcher_team AS VARCHAR) AS pitcher_team, round(value, 6) AS value FROM u)
SELECT board, pitcher_team, value,
       CAST(row_number() OVER (PARTITION BY board ORDER BY value DESC NULLS LAST, pitcher_team) AS INTEGER) AS rank FROM v
""", "pitches", "rv")

SIDE_ORACLE["leaderboard_woba"] = with_views(f"""
WITH sc AS (SELECT pitcher_id, year, count(stuff_plus) AS count, avg(stuff_plus) AS stuff_plus FROM ({SCORED}) GROUP BY pitcher_id, year),
w AS (SELECT pitcher_id, year, count(*) AS woba_pa, avg({WOBA_B}) AS woba FROM pitches
      WHERE event_type IS NOT NULL GROUP BY pitcher_id, year HAVING count(*) > 35)
SELECT pitcher_id, year, count, round(stuff_plus, 6) AS stuff_plus, woba_pa, round(woba, 6) AS woba FROM sc LEFT JOIN w USING (pitcher_id, year)
""", "pitches", "rv")

SIDE_ORACLE["fastball_features_all"] = with_views("""
WITH m AS (SELECT pitch_uid, pitcher_id, year, CASE WHEN pitcher_id % 4 = 0 THEN 'CU' ELSE pitch_type END AS pitch_type, start_speed, az,
                  CASE WHEN pitcher_hand = 'L' THEN -ax ELSE ax END AS ax FROM pitches),
pt AS (SELECT pitcher_id, year, pitch_type, avg(start_speed) AS sp, avg(az) AS a_z, avg(ax) AS a_x, count(*) AS n
       FROM m WHERE pitch_type IN ('SI', 'FF', 'FC') GROUP BY ALL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pitcher_id, year ORDER BY n DESC, sp DESC, pitch_type DESC) AS rn FROM pt)
      WHERE rn = 1),
t AS (SELECT pitcher_id, max(start_speed) AS sp, max(az) AS a_z, max(ax) AS a_x FROM m GROUP BY pitcher_id),
j AS (SELECT m.*, coalesce(b.sp, t.sp) AS fs, coalesce(b.a_z, t.a_z) AS fz, coalesce(b.a_x, t.a_x) AS fx
      FROM m LEFT JOIN b USING (pitcher_id, year) JOIN t USING (pitcher_id))
SELECT pitch_uid, year, round(fs, 6) AS avg_fastball_speed, round(fz, 6) AS avg_fastball_az, round(fx, 6) AS avg_fastball_ax,
       round(start_speed - fs, 6) AS speed_diff, round(az - fz, 6) AS az_diff, round(abs(ax - fx), 6) AS ax_diff
FROM j
""", "pitches")

SIDE_ORACLE["fastball_features_bucketed"] = SIDE_ORACLE["fastball_features_all"]

SIDE_ORACLE["hash_split"] = with_views("""
SELECT year, ('0x' || substr(md5('42|' || pitch_uid), 1, 12))::BIGINT % 100 < 80 AS is_train, count(*) AS n,
       CAST(sum(pitch_uid) AS BIGINT) AS uid_sum
FROM pitches GROUP BY ALL
""", "pitches")

SIDE_ORACLE["scalar_columns"] = """
WITH c AS (SELECT *, (c_custkey % 40) / 8 AS eighths FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 11 <> 0)
SELECT c_custkey AS player, upper(c_mktsegment) AS segment, c_custkey::VARCHAR AS id, round_even(eighths, 2) AS half_even,
       round(eighths, 2) AS half_up, c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AS is_date, CASE WHEN c_acctbal > 0 THEN 1 END AS batted
FROM c
"""

SIDE_ORACLE["whiff_lookup"] = with_views(f"""
WITH p AS (SELECT *, {SWING} AS swing, {WHIFF} AS whiff FROM pitches),
l AS (SELECT play_description, balls, strikes, max(swing::INT) AS s, max(whiff::INT) AS w FROM p GROUP BY ALL)
SELECT pitch_uid, CASE play_description WHEN 'Ball' THEN 'ball' WHEN 'Ball In Dirt' THEN 'ball' WHEN 'Called Strike' THEN 'called_strike'
         WHEN 'Foul' THEN 'foul' WHEN 'Swinging Strike' THEN 'swinging_strike' WHEN 'Foul Tip' THEN 'swinging_strike'
         WHEN 'Swinging Strike (Blocked)' THEN 'swinging_strike' ELSE 'hit_into_play' END AS outcome,
       (swing AND whiff)::INT AS target, l.s AS is_swing_whiff, l.w AS is_whiff_whiff
FROM p JOIN l USING (play_description, balls, strikes)
""", "pitches")

SIDE_ORACLE["feed_events"] = """
WITH l AS (SELECT *, (l_linenumber - 1) // 3 AS pa, l_partkey % 10 AS kind FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
n AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER g AS size, min(l_suppkey) OVER g AS pitcher, min(l_partkey) OVER g AS batter,
             CASE WHEN kind = 2 THEN 4 ELSE l_suppkey % 4 END AS b, l_partkey % 3 AS s, l_orderkey % 3 AS o
      FROM l WINDOW g AS (PARTITION BY l_orderkey, pa), w AS (PARTITION BY l_orderkey, pa
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)),
e AS (SELECT *, lag(b) OVER w AS pb, lag(s) OVER w AS ps, lag(o) OVER w AS po, i = 0 AND kind > 2 AS first, i = size - 1 AS last,
             (l_orderkey + pa) % 11 <> 0 AS known, kind > 2 AND kind <> 9 AS tracked
      FROM n WINDOW w AS (PARTITION BY l_orderkey, pa ORDER BY i))
SELECT l_orderkey AS game_id, o_orderdate::DATE AS game_date, pa::INT AS ab_number, i::INT AS index_play,
       CASE WHEN kind > 2 THEN 'pitch' WHEN kind = 1 THEN 'call' ELSE 'ball_four' END AS row_kind, kind > 2 AS is_pitch,
       CASE WHEN known THEN batter END AS batter_id, CASE WHEN known THEN 'L' END AS batter_hand, CASE WHEN known THEN pitcher END AS pitcher_id,
       CAST(NULL AS VARCHAR) AS pitcher_hand, CASE WHEN pa % 2 = 0 THEN 'HOM' ELSE 'AWY' END AS pitcher_team,
       CASE WHEN pa % 2 = 0 THEN 'AWY' ELSE 'HOM' END AS batter_team, kind > 2 AND l_suppkey % 4 IN (0, 3) AS is_ball,
       CASE WHEN first THEN 0 ELSE pb END::INT AS balls, CASE WHEN first THEN 0 ELSE ps END::INT AS strikes,
       CASE WHEN first THEN o ELSE po END::INT AS outs, b::INT AS balls_after, s::INT AS strikes_after,
       CASE WHEN last THEN 'atBat' END AS type_ab, CASE WHEN last THEN CASE WHEN batter % 2 = 0 THEN 'walk' ELSE 'single' END END AS event_type,
       round(CASE WHEN tracked THEN l_quantity END, 6) AS start_speed, round(CASE WHEN tracked THEN l_discount END, 6) AS release_pos_x,
       round(CASE WHEN tracked THEN l_tax END, 6) AS release_pos_z, round(CASE WHEN tracked THEN l_quantity / 8 END, 6) AS z_release_point
FROM e WHERE kind <> 0
"""

# rows with a target whose pitcher-season has a fastball, with its mean speed
_MODEL = f"""
WITH t AS ({TARGET}),
m AS (SELECT pitch_uid, pitcher_id, year, pitch_type, start_speed, az, CASE WHEN pitcher_hand = 'L' THEN -ax ELSE ax END AS ax, target FROM t),
pt AS (SELECT pitcher_id, year, pitch_type, avg(start_speed) AS sp, count(*) AS n
       FROM m WHERE pitch_type IN ('SI', 'FF', 'FC') GROUP BY ALL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pitcher_id, year ORDER BY n DESC, sp DESC, pitch_type DESC) AS rn FROM pt)
      WHERE rn = 1)
SELECT m.*, start_speed - b.sp AS speed_diff FROM m JOIN b USING (pitcher_id, year) WHERE target IS NOT NULL
"""
SIDE_ORACLE["robust_scaling"] = with_views(
    f"WITH r AS ({_MODEL}), q AS (SELECT " + ", ".join(
        f"median({c}) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_w" for c in ("start_speed", "az", "ax", "speed_diff"))
    + " FROM r) SELECT pitch_uid, " + ", ".join(
        f"round(({c} - {c}_m) / {c}_w, 6) AS {c}_scaled" for c in ("start_speed", "az", "ax", "speed_diff")) + " FROM r, q", "pitches", "rv")

SIDE_ORACLE["model_quality"] = with_views(f"""
SELECT count(*) AS scored, CAST(0 AS BIGINT) AS missing, TRUE AS better_than_mean, CAST(10 AS INTEGER) AS features,
       CAST(1.0 AS DOUBLE) AS importance_sum FROM ({_MODEL})
""", "pitches", "rv")

_GROUPED = "CASE ev " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_OUTCOME.items() if v) + " END"
SIDE_ORACLE["run_value_mapped"] = with_views(f"""
WITH p AS (SELECT *, {OUTCOME} AS outcome, CASE WHEN event_type <> 'field_out' OR event_type IS NULL THEN event_type ELSE
             CASE tb_p % 5 WHEN 0 THEN 'field_out' WHEN 1 THEN 'double_play' WHEN 2 THEN 'field_error' WHEN 3 THEN 'sac_fly'
                           ELSE 'never_seen' END END AS ev FROM pitches),
g AS (SELECT *, {_GROUPED} AS grouped FROM p)
SELECT pitch_uid, outcome, round(coalesce(a.delta_run_exp, b.delta_run_exp), 6) AS target
FROM g LEFT JOIN rv a ON a.event = g.grouped AND a.balls = g.balls AND a.strikes = g.strikes
LEFT JOIN rv b ON b.event = g.outcome AND b.balls = g.balls AND b.strikes = g.strikes
""", "pitches", "rv")

# one tree of three leaves: bins, the best split of the root, the better of its children's best splits
_SOFT = "pow(greatest(abs({g} / CAST(16777216 AS DOUBLE)) - 0.1, 0), 2) / ({n} + CAST(0.2 AS DOUBLE))"
_GAIN = " + ".join((_SOFT.format(g="gl", n="nl"), _SOFT.format(g="(g - gl)", n="(n - nl)"))) + " - " + _SOFT.format(g="g", n="n")
_SPLITS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) AS rn FROM (
    SELECT *, {gain} AS gain FROM (
      SELECT node, f, bin, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER a AS g, sum(n) OVER a AS n
      FROM (SELECT node, f, bin, sum(g) AS g, count(*) AS n FROM {rows} GROUP BY node, f, bin)
      WINDOW w AS (PARTITION BY node, f ORDER BY bin), a AS (PARTITION BY node, f))
    WHERE nl >= 20 AND n - nl >= 20) WHERE gain > 0) WHERE rn = 1"""
_TREE = f"""
m AS (SELECT *, row_number() OVER () AS id FROM ({_MODEL})),
base AS (SELECT round(avg(target), 6) AS p FROM m),
v AS (SELECT id, round((p - target) * 16777216)::BIGINT AS g, f, CASE f WHEN 0 THEN start_speed WHEN 1 THEN az ELSE ax END AS x
      FROM m, base, (VALUES (0), (1), (2)) t(f)),
q AS (SELECT *, (rank() OVER (PARTITION BY f ORDER BY x) - 1) * 64 // count(*) OVER (PARTITION BY f) AS part FROM v),
b AS (SELECT id, g, f, x, dense_rank() OVER (PARTITION BY f ORDER BY part) - 1 AS bin FROM q),
edge AS (SELECT f, bin, min(x) AS least FROM b GROUP BY f, bin),
r1 AS (SELECT 1 AS node, * FROM b),
s1 AS ({_SPLITS.format(gain=_GAIN, rows="r1")}),
side AS (SELECT id, CASE WHEN b.bin <= s1.bin THEN 2 ELSE 3 END AS node FROM b JOIN s1 USING (f)),
r2 AS (SELECT side.node, b.* FROM b JOIN side USING (id)),
s2 AS (SELECT * FROM ({_SPLITS.format(gain=_GAIN, rows="r2")}) ORDER BY gain DESC, node LIMIT 1),
leaf AS (SELECT side.id, CASE WHEN side.node <> s2.node THEN side.node WHEN b.bin <= s2.bin THEN 2 * side.node ELSE 2 * side.node + 1 END AS node
         FROM side, s2 JOIN b ON b.f = s2.f WHERE b.id = side.id),
every AS (SELECT leaf.node, any_value(s.f) AS f, count(*) AS rows, sum(g) AS g FROM leaf JOIN b USING (id), (SELECT 0 AS f) s WHERE b.f = 0 GROUP BY leaf.node),
grown AS (SELECT node, NULL AS f, NULL AS bin, NULL AS gain, rows, g FROM every
          UNION ALL SELECT node, f, bin, gain, n, g FROM s1 UNION ALL SELECT node, f, bin, gain, n, g FROM s2),
nodes AS (SELECT node, grown.f, edge.least AS threshold, gain, rows,
                 -CAST(0.1 AS DOUBLE) * sign(g) * greatest(abs(g / CAST(16777216 AS DOUBLE)) - 0.1, 0) / (rows + CAST(0.2 AS DOUBLE)) AS value
          FROM grown LEFT JOIN edge ON edge.f = grown.f AND edge.bin = grown.bin + 1)
"""
SIDE_ORACLE["leafwise_two_splits"] = with_views(f"""
WITH {_TREE}
SELECT node::BIGINT AS node, rows::BIGINT AS rows, round(value, 6) AS value, ['start_speed', 'az', 'ax'][f + 1] AS feature, round(threshold, 6) AS threshold,
       round(gain, 6) AS gain FROM nodes
""", "pitches", "rv")
SIDE_ORACLE["leafwise_scores"] = with_views(f"""
WITH {_TREE},
share AS (SELECT count(*) FILTER (WHERE f = 0) / 2 AS a, count(*) FILTER (WHERE f = 1) / 2 AS b, count(*) FILTER (WHERE f = 2) / 2 AS c FROM nodes)
SELECT pitch_uid, round(target, 6) AS target, round(p + value, 6) AS prediction, a AS share_start_speed, b AS share_az, c AS share_ax
FROM m JOIN leaf USING (id) JOIN nodes USING (node), base, share
""", "pitches", "rv")
