"""Ingest on synthetic JSON fixtures (shapes of FIXTURES.md; values invented)."""

import json
import os

import pytest

from pyspark.sql import functions as F

from moundlake.sources import feed, reference, schedule, tables


def _ev(i, pitch=True, balls=0, strikes=0, outs=0, code="B", pn=None, breaks=True, pitch_data=True, call=True,
        end="2024-04-01T18:00:00Z"):
    e = {"index": i, "playId": f"p{i}", "startTime": "2024-04-01T17:59:00Z", "endTime": end, "isPitch": pitch,
         "type": "pitch" if pitch else "action", "pitchNumber": pn,
         "count": {"balls": balls, "strikes": strikes, "outs": outs},
         "details": {"description": "Ball" if code == "B" else "Swinging Strike", "code": code, "isInPlay": False,
                     "isStrike": code != "B", "isOut": False, "hasReview": False,
                     "call": {"code": code, "description": "x"} if (pitch and call) else None,
                     "type": {"code": "FF", "description": "Four-Seam Fastball"}}}
    if pitch_data:
        e["pitchData"] = {"startSpeed": 95.0, "endSpeed": 87.0, "zone": 5, "extension": 6.5,
                          "coordinates": {"aX": -5.0, "aY": 30.0, "aZ": -15.0, "vY0": -135.0, "x0": -1.5, "z0": 6.0}}
        if breaks:
            e["pitchData"]["breaks"] = {"spinRate": 2300.0, "spinDirection": 210.0}
    return e


def _game(pk, plays):
    return {"gamePk": pk, "gameData": {"datetime": {"officialDate": "2024-04-01"},
                                       "teams": {"home": {"id": 10, "abbreviation": "HOM"},
                                                 "away": {"id": 20, "abbreviation": "AWY"}}},
            "liveData": {"plays": {"allPlays": plays}}}


def _write(tmp_path, name, obj):
    p = os.path.join(tmp_path, name)
    with open(p, "w") as f:
        json.dump(obj, f)
    return p


def _fixture_games():
    ab0 = {"atBatIndex": 0, "about": {"isTopInning": True},
           "matchup": {"batter": {"id": 1, "fullName": "A B"}, "pitcher": {"id": 2, "fullName": "C D"},
                       "batSide": {"code": "L"}, "pitchHand": {"code": "R"}},
           "result": {"type": "atBat", "event": "Strikeout", "eventType": "strikeout", "rbi": 0, "isOut": True},
           "playEvents": [_ev(0, pn=1, balls=1, code="B"),
                          _ev(1, pitch=False, balls=1, strikes=0, code=None, pitch_data=False),  # pick-off
                          _ev(2, pn=2, balls=1, strikes=1, code="S", breaks=False),
                          _ev(3, pn=3, balls=1, strikes=2, code="S")]}
    ab1 = {"atBatIndex": 1, "about": {"isTopInning": False},  # no matchup at all
           "result": {"type": "atBat", "event": "Walk", "eventType": "walk"},
           "playEvents": [_ev(0, pn=1, balls=1, code="B"), _ev(1, pitch=False, balls=4, code=None, pitch_data=False)]}
    return [_game(100, [ab0, ab1]), _game(101, [])]


def test_flatten_feed_rows_and_nulls(spark, tmp_path):
    paths = [_write(tmp_path, f"g{i}.json", g) for i, g in enumerate(_fixture_games())]
    rows = feed.flatten_feed(feed.read_feed(spark, paths)).orderBy("game_id", "ab_number", "index_play").collect()
    # pick-off (no pitch, no call) is dropped; ball four without a pitch is kept
    assert [(r.ab_number, r.index_play, r.row_kind) for r in rows] == [
        (0, 0, "pitch"), (0, 2, "pitch"), (0, 3, "pitch"), (1, 0, "pitch"), (1, 1, "ball_four")]
    first, second, last = rows[0], rows[1], rows[2]
    assert (first.balls, first.strikes) == (0, 0)           # first pitch: 0-0
    assert (second.balls, second.strikes) == (1, 0)         # count of the previous event (the pick-off)
    assert second.spin_rate is None and first.spin_rate == 2300.0   # missing breaks -> null (T8)
    assert first.event_type is None and last.event_type == "strikeout"  # outcome on last event only
    assert first.pitcher_team == "HOM" and first.batter_team == "AWY"
    assert second.is_swing and second.is_whiff and not first.is_swing
    bf = rows[4]
    assert bf.batter_id is None and bf.pitcher_team == "AWY" and bf.event_type == "walk"
    assert (bf.balls_after, bf.balls) == (4, 1)             # real counts, not swapped (T6)
    rel = feed.flatten_feed(feed.read_feed(spark, paths), release=True)
    assert {"release_pos_x", "release_pos_z", "z_release_point"} <= set(rel.columns)
    assert rel.count() == len(rows)


def test_streaming_ingest_newest_version_wins(spark, tmp_path):
    from moundlake.streaming import current_pitches, start_feed_ingest
    land = os.path.join(tmp_path, "land")
    os.makedirs(land)
    g = _fixture_games()[0]
    _write(land, "v1.json", g)
    table, ckpt = os.path.join(tmp_path, "table"), os.path.join(tmp_path, "ckpt")
    start_feed_ingest(spark, land, table, ckpt).awaitTermination()
    g2 = json.loads(json.dumps(g))
    g2["liveData"]["plays"]["allPlays"][0]["playEvents"][0]["pitchData"]["startSpeed"] = 99.0
    g2["liveData"]["plays"]["allPlays"][0]["playEvents"][0]["endTime"] = "2024-04-01T18:05:00Z"
    _write(land, "v2.json", g2)
    start_feed_ingest(spark, land, table, ckpt).awaitTermination()
    cur = current_pitches(spark, table)
    assert cur.count() == 5
    assert cur.filter("ab_number = 0 AND index_play = 0").first().start_speed == 99.0


def test_schedule_dedupe_and_local_time(spark, tmp_path):
    doc = {"dates": [
        {"date": "2024-07-01", "games": [
            {"gamePk": 1, "gameDate": "2024-07-01T23:05:00Z", "officialDate": "2024-07-01", "gameType": "R",
             "status": {"codedGameState": "F"}, "venue": {"id": 5, "name": "Park"},
             "teams": {"away": {"team": {"id": 1, "name": "A"}}, "home": {"team": {"id": 2, "name": "B"}}}},
            {"gamePk": 1, "gameDate": "2024-07-01T23:05:00Z", "officialDate": "2024-07-01", "gameType": "R"},
            {"gamePk": None, "gameDate": "2024-07-01T20:00:00Z", "officialDate": "2024-07-01"}]},
        {"date": "2024-12-01", "games": [
            {"gamePk": 2, "gameDate": "2024-12-01T18:10:00Z", "officialDate": "2024-12-01", "gameType": "S"}]},
        {"date": "2024-12-02", "games": []}]}
    p = _write(tmp_path, "s.json", doc)
    s = schedule.flatten_schedule(schedule.read_schedule(spark, p))
    rows = s.collect()
    assert [r.game_id for r in rows] == [1, 2]
    assert rows[0].time == "07:05 PM" and rows[1].time == "01:10 PM"   # EDT summer, EST winter
    assert [r.game_id for r in schedule.games_on_date(s, "2024-12-01", ["S"]).collect()] == [2]


def test_player_games_safe_fallback(spark):
    log = spark.createDataFrame([(7, 11, "2024-05-01")], "player_id long, game_id long, date string") \
        .withColumn("date", F.to_date("date"))
    sched = spark.createDataFrame([(21, "2024-05-02"), (22, "2024-05-02"), (11, "2024-05-01")],
                                  "game_id long, date string").withColumn("date", F.to_date("date"))
    req = spark.createDataFrame([(7, "2024-05-01"), (7, "2024-05-02")], "player_id long, date string") \
        .withColumn("date", F.to_date("date"))
    got = sorted((r.date.isoformat(), r.game_id) for r in schedule.player_games_safe(req, log, sched).collect())
    assert got == [("2024-05-01", 11), ("2024-05-02", 21), ("2024-05-02", 22)]


def test_teams_parent_fill(spark, tmp_path):
    doc = {"teams": [
        {"id": 1, "name": "Big Club", "franchiseName": "Big", "abbreviation": "BIG", "sport": {"id": 1}},
        {"id": 2, "name": "Farm", "franchiseName": "Farm Town", "abbreviation": "FRM", "parentOrgId": 1,
         "parentOrgName": "Big Club", "sport": {"id": 11}},
        {"id": 2, "name": "Farm", "franchiseName": "Farm Town", "abbreviation": "FRM", "parentOrgId": 1,
         "parentOrgName": "Big Club", "sport": {"id": 11}},
        {"name": "No id"}]}
    t = reference.teams(spark, _write(tmp_path, "t.json", doc)).collect()
    assert [(r.team_id, r.parent_org_id, r.parent_org_abbreviation, r.city) for r in t] == [
        (1, 1, "BIG", "Big"), (2, 1, "BIG", "Farm Town")]


def test_leaderboard_json_schema(spark, tmp_path):
    doc = {"data": [{"playerid": 1, "xMLBAMID": 100, "PlayerName": "X", "Season": 2024, "Team": "T", "G": 30,
                     "IP": 150.1, "K-BB%": 0.2, "ERA": 3.1, "FIP": 3.3, "xFIP": 3.4, "TBF": 600, "Pitches": 2400}]}
    df = tables.leaderboard_json(spark, _write(tmp_path, "lb.json", doc))
    r = df.first()
    assert r["K-BB%"] == 0.2 and r["Pitches"] == 2400 and df.schema["Season"].dataType.simpleString() == "bigint"


def test_leagues_sports_game_types_people(spark, tmp_path):
    lg = reference.leagues(spark, _write(tmp_path, "l.json", {"leagues": [
        {"id": 103, "name": "American League", "abbreviation": "AL", "sport": {"id": 1}}]})).collect()
    assert [(r.league_id, r.league_abbreviation, r.sport_id) for r in lg] == [(103, "AL", 1)]
    sp = reference.sports(spark, _write(tmp_path, "s.json", {"sports": [{"id": 1, "code": "mlb", "name": "Major"},
                                                                      {"id": 11, "code": "aaa", "name": "Triple-A"}]}))
    assert reference.sport_exists(sp, 11) and not reference.sport_exists(sp, 12)
    gt = reference.game_types(spark, _write(tmp_path, "g.json", [{"id": "R", "description": "Regular Season"},
                                                                {"id": "S", "description": "Spring Training"}]))
    assert sorted(r.game_type for r in gt.collect()) == ["R", "S"]
    ppl = reference.people(spark, _write(tmp_path, "p.json", {"people": [
        {"id": 1, "firstName": "Ann", "lastName": "Lee", "fullName": "Ann Lee", "currentTeam": {"id": 2},
         "birthDate": "1990-05-01"},
        {"id": 2, "firstName": "Bo", "lastName": "Lee", "fullName": "Bo Lee", "currentTeam": {"id": 1},
         "primaryPosition": {"abbreviation": "P"}},
        {"id": 3, "firstName": "Cy", "lastName": "Ray"}]}))
    assert [r.player_id for r in reference.lookup_player(ppl, "LEE", "bo").collect()] == [2]
    assert ppl.filter("player_id = 3").first().position is None  # player without position
    teams_doc = {"teams": [{"id": 1, "name": "Big", "abbreviation": "BIG", "sport": {"id": 1}},
                           {"id": 2, "name": "Farm", "abbreviation": "FRM", "parentOrgId": 1, "sport": {"id": 11}}]}
    t = reference.teams(spark, _write(tmp_path, "t2.json", teams_doc))
    abbr = {r.player_id: r.team_abbr for r in reference.current_team_abbr(ppl, t).collect()}
    assert abbr == {1: None, 2: "BIG", 3: None}  # current team outside the top league -> null
    both = reference.players_union([ppl.select("player_id", "name"), ppl.select("player_id", "name")])
    assert both.count() == 3


def test_box_score_and_csv_and_sinks(spark, tmp_path):
    box = {"teams": {"home": {"players": {"ID1": {"person": {"id": 1, "fullName": "A"},
                                                  "stats": {"pitching": {"outs": "3"}}}}},
                     "away": {"players": {}}}}
    b = tables.box_score(spark, _write(tmp_path, "b.json", box), game_id=5).collect()
    assert [(r.side, r.key, r.player_id, r.game_id) for r in b] == [("home", "ID1", 1, 5)]
    from moundlake.schemas import RUN_VALUES
    csv = os.path.join(tmp_path, "rv.csv")
    with open(csv, "w") as f:
        f.write(",event,balls,strikes,delta_run_exp\n0,ball,0,0,0.03\n1,strikeout,0,2,-0.3\n")
    rv = tables.read_csv(spark, csv, RUN_VALUES, drop_index=True)
    assert rv.columns == ["event", "balls", "strikes", "delta_run_exp"] and rv.count() == 2
    from moundlake.sources.sinks import write_table
    out = os.path.join(tmp_path, "graded")
    df = spark.createDataFrame([(1, 2023, 55.0), (2, 2024, 61.0)], "pitcher_id long, year long, grade double")
    write_table(df, out)
    assert {"year=2023", "year=2024"} <= set(os.listdir(out))
    back = spark.read.parquet(out).filter("year = 2024")
    assert [r.pitcher_id for r in back.collect()] == [2]


def test_gbt_pipeline_fit_persist_and_importance(spark, tmp_path):
    import random
    from moundlake.operators.stuff import feature_importance, gbt_pipeline
    from moundlake.sources.sinks import load_model, save_model
    rnd = random.Random(2)
    rows = [(rnd.random(), rnd.random(), rnd.random()) for _ in range(400)]
    df = spark.createDataFrame([(a, b, c, 2 * a - b + 0.01 * c) for a, b, c in rows], "a double, b double, c double, target double")
    model = gbt_pipeline(["a", "b", "c"], max_iter=5, step_size=0.3).fit(df)
    imp = feature_importance(model, ["a", "b", "c"])
    assert imp[0][0] == "a" and abs(sum(v for _, v in imp) - 1) < 1e-9
    path = os.path.join(tmp_path, "model")
    save_model(model, path)
    again = load_model(path).transform(df).select("prediction").collect()
    assert [r.prediction for r in again] == [r.prediction for r in model.transform(df).select("prediction").collect()]


def _copy_of(game, pk, speed=None, end="2024-04-01T18:00:00Z", date=None, drop_last_play=False):
    g = json.loads(json.dumps(game))
    g["gamePk"] = pk
    if date:
        g["gameData"]["datetime"]["officialDate"] = date
    if speed is not None:
        g["liveData"]["plays"]["allPlays"][0]["playEvents"][0]["pitchData"]["startSpeed"] = speed
    if drop_last_play:
        g["liveData"]["plays"]["allPlays"].pop()
    return g


@pytest.mark.parametrize("keep", ["newest", "first"])
def test_streaming_versions_backlog_and_late_games(spark, tmp_path, keep):
    """Both versions in one backlog, a game that lands after newer ones, an event that the newer file no longer
    holds, a replay of the batch, and compaction."""
    from moundlake.streaming import current_pitches, start_feed_ingest
    from moundlake.streaming.ingest import compact
    land, table, ckpt = (os.path.join(tmp_path, n) for n in ("land", "table", "ckpt"))
    os.makedirs(land)
    game = _fixture_games()[0]
    for k, (name, doc) in enumerate([("b_old.json", _copy_of(game, 100, 90.0)), ("a_new.json", _copy_of(game, 100, 99.0, drop_last_play=True)),
                                     ("c.json", _copy_of(game, 777, 91.0, date="2024-04-02"))]):
        path = _write(land, name, doc)
        os.utime(os.path.join(land, name), (1_700_000_000 + 60 * k,) * 2)
    start_feed_ingest(spark, land, table, ckpt, keep=keep).awaitTermination()
    _write(land, "late.json", _copy_of(game, 999, 95.0, date="2023-04-01"))
    start_feed_ingest(spark, land, table, ckpt, keep=keep).awaitTermination()
    whole = len(flat_rows(spark, game))

    def check():
        cur = current_pitches(spark, table, keep)
        speeds = {r.game_id: r.start_speed for r in cur.filter("ab_number = 0 AND index_play = 0").collect()}
        assert speeds == {100: 99.0 if keep == "newest" else 90.0, 777: 91.0, 999: 95.0}
        n = {r.game_id: r["count"] for r in cur.groupBy("game_id").count().collect()}
        assert n[777] == n[999] == whole and (n[100] < whole if keep == "newest" else n[100] == whole)
        return cur.count()

    rows = check()
    compact(spark, table, keep)
    assert check() == rows == spark.read.parquet(table).count()
    # another version of a compacted game
    _write(land, "z_newer.json", _copy_of(game, 777, 50.0))
    start_feed_ingest(spark, land, table, ckpt, keep=keep).awaitTermination()
    cur = current_pitches(spark, table, keep).filter("game_id = 777 AND ab_number = 0 AND index_play = 0").first()
    assert cur.start_speed == (50.0 if keep == "newest" else 91.0)


def flat_rows(spark, game):
    import tempfile
    d = tempfile.mkdtemp()
    return feed.flatten_feed(feed.read_feed(spark, _write(d, "g.json", game))).collect()


def test_previous_count_marks_one_last_row(spark):
    df = spark.createDataFrame([(1, 1, 1, 0, 0), (1, 1, 2, 1, 0), (1, 1, 2, 1, 1), (1, 2, 1, 0, 0)], "g long, pa long, ab long, balls int, strikes int")
    got = feed.previous_count(df, ["g", "pa"], ["ab", "strikes"]).collect()
    assert sum(r.is_last for r in got) == 2
    assert {(r.pa, r.ab, r.strikes): (r.balls_before, r.strikes_before) for r in got} == {
        (1, 1, 0): (0, 0), (1, 2, 0): (0, 0), (1, 2, 1): (1, 0), (2, 1, 0): (0, 0)}
