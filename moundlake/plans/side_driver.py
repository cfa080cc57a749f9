"""Registered queries on the side tables: reference sources, schedules, CSV and season tables, cards and boards.

The documents of the JSON sources are built from the supplied tables with Spark, rendered as JSON text and parsed
back with the declared schemas, as in ``driver.py``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moundlake.functions import approach_angles, columns as C
from moundlake.operators import boards, distribution, expected, features, summary
from moundlake.plans import roles
from moundlake.plans.driver import _parse, _r, scored_pitches, season_predictions
from moundlake.schemas import BATTING_BOARD, WOBA_WEIGHTS_A, WOBA_WEIGHTS_B
from moundlake.session import checkpoint_dir


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/moundlake-{name}-{uuid.uuid4().hex}"


# -- reference sources ----------------------------------------------------------------------


def _leagues(spark, sf) -> DataFrame:
    from moundlake.sources.reference import LEAGUES_SCHEMA, flatten_leagues
    league = F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
                      F.substring("n_name", 1, 3).alias("abbreviation"),
                      F.struct(F.col("n_regionkey").cast("long").alias("id")).alias("sport"))
    return flatten_leagues(_parse(roles.table(spark, sf, "nation").select(F.array(league).alias("leagues")), LEAGUES_SCHEMA))


def _sports(spark, sf) -> DataFrame:
    from moundlake.sources.reference import SPORTS_SCHEMA, flatten_sports
    sport = F.struct(F.col("r_regionkey").cast("long").alias("id"), F.lower("r_name").alias("code"), F.col("r_name").alias("name"))
    return flatten_sports(_parse(roles.table(spark, sf, "region").select(F.array(sport).alias("sports")), SPORTS_SCHEMA))


def leagues_sports(spark, sf):
    """S8 and S9 on documents built from nation and region; each league beside its sport, if there is one."""
    lg, sp = _leagues(spark, sf), _sports(spark, sf)
    return lg.join(sp, "sport_id", "left").select("league_id", "league_name", "league_abbreviation", "sport_id", "sport_code",
                                                 "sport_name", "sport_abbreviation")


def game_type_values(spark, sf):
    """The order priorities as a JSON array of game types, landed as a file and read back."""
    from moundlake.sources.reference import game_types
    path = _folder(spark, "game-types")
    kinds = roles.table(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).alias("id"),
                                                    F.col("o_orderpriority").alias("description")).distinct()
    # a handful of priorities: one document
    kinds.agg(F.to_json(F.sort_array(F.collect_list(F.struct("id", "description")))).alias("value")).write.text(path)
    return game_types(spark, path)


def _people(spark, sf, status: str) -> DataFrame:
    """People documents of the customers with an order of this status."""
    from moundlake.sources.reference import PEOPLE_SCHEMA, flatten_people
    has = roles.table(spark, sf, "orders").filter(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("c_custkey")).distinct()
    c = roles.table(spark, sf, "customer").join(has, "c_custkey", "left_semi")
    person = F.struct(
        F.col("c_custkey").alias("id"), F.lower("c_mktsegment").alias("firstName"), F.col("c_name").alias("lastName"),
        F.concat_ws(" ", "c_mktsegment", "c_name").alias("fullName"),
        F.struct(F.substring("c_mktsegment", 1, 2).alias("abbreviation")).alias("primaryPosition"),
        F.struct(F.col("c_nationkey").cast("long").alias("id")).alias("currentTeam"),
        F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal")).alias("weight"))
    return flatten_people(_parse(c.select(F.array(person).alias("people")), PEOPLE_SCHEMA))


def people_rows(spark, sf):
    """Pitchers and batters (customers with finished and with open orders) united, with the
    abbreviation of the current team where that team plays in sport 1."""
    from moundlake.sources.reference import current_team_abbr, players_union
    everyone = players_union([_people(spark, sf, "F"), _people(spark, sf, "O")])
    teams = roles.table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("team_id"),
                                                    F.substring("n_name", 1, 3).alias("abbreviation"), F.col("n_regionkey").alias("sport_id"))
    return everyone.select("player_id", "first_name", "name", "position", "team", "weight", "bats", "birth_date").join(
        current_team_abbr(everyone, teams), "player_id")


def player_lookup(spark, sf):
    """People by last name and first name, in any case: one call, for one name, among customers with open orders."""
    from moundlake.sources.reference import lookup_player
    return lookup_player(_people(spark, sf, "O").withColumn("last_name", F.lit("Player")), "PLAYER", "building") \
        .select("player_id", "first_name", "name")


# -- schedule and game logs -----------------------------------------------------------------


def _schedule(spark, sf) -> DataFrame:
    from moundlake.sources.schedule import SCHEDULE_SCHEMA, flatten_schedule
    od = roles.table(spark, sf, "orders")
    game = F.struct(
        F.col("o_orderkey").alias("gamePk"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("gameDate"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("officialDate"), F.col("o_orderstatus").alias("gameType"))
    return flatten_schedule(_parse(od.select(F.array(F.struct(F.lit(None).cast("string").alias("date"), F.array(game).alias("games"))).alias("dates")),
                                   SCHEDULE_SCHEMA))


def games_of_types(spark, sf):
    """The games of one date and two game types (date and types are the call's arguments)."""
    from moundlake.sources.schedule import games_on_date
    return games_on_date(_schedule(spark, sf), "1996-02-14", ["F", "O"])


def _game_log(spark, sf) -> DataFrame:
    from moundlake.sources.schedule import GAME_LOG_SCHEMA, player_game_log
    od = roles.table(spark, sf, "orders")
    outs = F.floor(F.col("o_totalprice") / 1000)
    split = F.struct(
        F.struct(F.col("o_orderkey").alias("gamePk"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).alias("game"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("opponent"),
        F.struct(outs.alias("outs"), F.concat(F.floor(outs / 3).cast("string"), F.lit("."), F.pmod(outs, F.lit(3)).cast("string")).alias("inningsPitched"),
                 F.floor(F.col("o_totalprice") / 5000).alias("strikeOuts"), F.pmod("o_orderkey", F.lit(4)).alias("baseOnBalls"),
                 F.when(F.pmod("o_orderkey", F.lit(9)) != 0, F.pmod("o_orderkey", F.lit(6))).alias("earnedRuns"),
                 F.pmod("o_orderkey", F.lit(8)).alias("hits"), F.pmod("o_custkey", F.lit(3)).alias("homeRuns"),
                 (outs + 5).alias("battersFaced")).alias("stat"))
    docs = od.select(F.array(F.struct(F.col("o_custkey").alias("id"), F.array(F.struct(F.array(split).alias("splits"))).alias("stats"))).alias("people"))
    return player_game_log(_parse(docs, GAME_LOG_SCHEMA))


def game_log_lines(spark, sf):
    """All fields of the pitching line, from game-log documents built from orders."""
    return _game_log(spark, sf).select("player_id", "game_id", "date", "opponent", "outs", "innings_pitched", "strikeouts", "walks",
                                       "earned_runs", "hits", "home_runs", "batters_faced")


def requested_games(spark, sf):
    """For every (player, date) request the logged games, or all scheduled games of the date where the
    player logged none; requests are the order dates and the days after them. One row per request."""
    from moundlake.sources.schedule import player_games_safe
    od = roles.table(spark, sf, "orders").select(F.col("o_custkey").alias("player_id"), F.to_date("o_orderdate").alias("date"))
    requests = od.union(od.select("player_id", F.date_add("date", 1))).distinct()
    return player_games_safe(requests, _game_log(spark, sf).select("player_id", "date", "game_id"), _schedule(spark, sf), per_request=True)


# -- tables and sinks -----------------------------------------------------------------------


def csv_round_trip(spark, sf):
    """Batting lines written as CSV with an index column (several files), read back with the declared
    schema and without the index."""
    from moundlake.sources.sinks import write_table
    from moundlake.sources.tables import read_csv
    path = _folder(spark, "batting-csv")
    board = batting_lines(spark, sf)
    write_table(board.select(F.monotonically_increasing_id().alias("_index"), *board.columns), path, "csv", partition_by=())
    back = read_csv(spark, path, BATTING_BOARD, drop_index=True)
    return _r(back.withColumnsRenamed({"K%": "k_pct", "BB%": "bb_pct"}))


def yearly_tables(spark, sf):
    """Batting lines as one folder of CSV files per season; even seasons in reverse column order with a further column,
    1997 without home runs; united by column name, the season taken from the folder's name."""
    from moundlake.sources.tables import read_csv_by_name
    base = _folder(spark, "yearly")
    board = batting_lines(spark, sf)
    cols = [c for c in board.columns if c != "Season"]
    for r in board.select("Season").distinct().collect():  # seven seasons
        names = ["Team", *reversed(cols)] if r.Season % 2 == 0 else [c for c in cols if c != "HR" or r.Season != 1997]
        season = board.filter(F.col("Season") == r.Season).withColumn("Team", F.lit("x, y"))
        season.select(*[f"`{c}`" for c in names]).write.option("header", True).csv(f"{base}/batting_{r.Season}")
    back = read_csv_by_name(spark, base, BATTING_BOARD, year_col="year", year_pattern=r"batting_(\d{4})/")
    return _r(back.drop("Season").withColumnsRenamed({"K%": "k_pct", "BB%": "bb_pct"}))


def feed_quarantine(spark, sf):
    """Game documents landed as JSON lines, every seventh cut off in the middle; one row per landed game: how many events it gave
    and whether it lies in quarantine."""
    from moundlake.plans.driver import feed_documents
    from moundlake.sources.feed import flatten_feed, read_feed
    base = _folder(spark, "feed-landing")
    docs = feed_documents(spark, sf)
    text = docs.select(F.to_json(F.struct(*docs.columns)).alias("value"), "gamePk")
    broken = F.concat(F.lit('{"game":'), F.col("gamePk").cast("string"), F.lit(","), F.expr("substring(value, 2, length(value) div 2)"))
    text.select(F.when(F.pmod("gamePk", F.lit(7)) == 0, broken).otherwise(F.col("value")).alias("value")).write.text(f"{base}/in", compression="gzip")
    good = read_feed(spark, f"{base}/in", quarantine=f"{base}/bad", multiline=False)
    events = flatten_feed(good).groupBy("game_id").agg(F.count(F.lit(1)).alias("events")).withColumn("quarantined", F.lit(False))
    bad = spark.read.parquet(f"{base}/bad").select(F.regexp_extract("document", r'^\{"game":(\d+)', 1).cast("long").alias("game_id"),
                                                   F.lit(0).cast("long").alias("events"), F.lit(True).alias("quarantined"))
    return events.unionByName(bad)


def batting_lines(spark, sf) -> DataFrame:
    """One row per batter and season with plate appearances, home runs, strikeout and walk shares and wOBA."""
    p = roles.pitches(spark, sf).filter(F.col("event_type").isNotNull())
    ev = F.col("event_type")
    share = lambda kind: F.round(F.count_if(ev == kind) / F.count(F.lit(1)), 6)
    out = p.groupBy(F.col("batter_id").alias("xMLBAMID"), F.col("year").alias("Season")).agg(
        F.count(F.lit(1)).alias("PA"), F.count_if(ev == "home_run").alias("HR"), share("strikeout").alias("K%"),
        share("walk").alias("BB%"),
        # whole thousandths, cut to six digits: exact in every engine
        (F.floor(F.sum(F.round(C.woba_value("event_type", WOBA_WEIGHTS_B) * 1000).cast("long")) * 1000 / F.count(F.lit(1))) / 1e6).alias("wOBA"))
    return out.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in BATTING_BOARD.fields])


def batting_board(spark, sf):
    return batting_lines(spark, sf).withColumnsRenamed({"K%": "k_pct", "BB%": "bb_pct"})


def season_tables(spark, sf):
    """Pitches written as Parquet by year; rows and mean speed read back per year folder."""
    from moundlake.sources.sinks import write_table
    path = _folder(spark, "season-table")
    write_table(roles.pitches(spark, sf).select("pitch_uid", "start_speed", "year"), path)
    back = spark.read.schema("pitch_uid long, start_speed double, year long").parquet(path)
    return _r(back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.avg("start_speed").alias("start_speed")))


def statcast_rows(spark, sf):
    """One batter's rows in a date range (both are the call's arguments), with swing and zone flags (P14) and movement in
    inches (P15)."""
    from moundlake.sources.tables import statcast_batter
    rows = roles.pitches(spark, sf).select(F.col("batter_id").alias("batter"), "game_date", "pitch_uid", "description", "zone",
                                           F.col("ax").alias("pfx_x"), F.col("x0").alias("pfx_z"))
    out = C.statcast_flags(statcast_batter(rows, 7, "1996-01-01", "1998-12-31"), inches=("pfx_x", "pfx_z"))
    return _r(out.select("pitch_uid", "game_date", "pfx_x", "pfx_z", "swing", "whiff", "in_zone", "out_zone", "chase"))


def fielding_and_framing(spark, sf):
    """Fielding of parts outer-merged with framing rows of at least five called pitches."""
    from moundlake.sources.tables import fielding_framing as merge
    p = roles.pitches(spark, sf)
    fielding = p.filter(F.col("launch_speed") > 75).groupBy(F.col("tb_p").alias("xMLBAMID")).agg(
        F.count(F.lit(1)).alias("attempts"), F.sum("delta_run_exp").alias("runs"))
    framing = p.filter(F.col("description").isin("called_strike", "ball")).groupBy(F.col("tb_p").alias("xMLBAMID")).agg(
        F.count(F.lit(1)).alias("called_pitches"), F.sum("x0").alias("runs"))
    return _r(merge(fielding, framing))


# -- boards and cards -----------------------------------------------------------------------


def qualified_percentiles(spark, sf):
    """S22 + W10: percentile ranks among the batter seasons with at least 100 pitches."""
    per = roles.pitches(spark, sf).groupBy("batter_id", "year").agg(
        F.count(F.lit(1)).alias("pitches"), F.avg("start_speed").alias("exit_velo"), F.avg("ax").alias("break"))
    long = boards.unpivot_metrics(per.filter(F.col("pitches") >= 100), ["batter_id", "year"], ["exit_velo", "break"])
    return _r(boards.percentile_ranks(long, ["year", "metric"]))


def _rates_input(df: DataFrame) -> DataFrame:
    vaa, haa = approach_angles(F.col("vx0"), F.col("vy0"), F.col("vz0"), F.col("ax"), F.col("ay"), F.col("az"), F.col("y0"))
    return df.withColumns({
        "swing": C.swing_flag("play_code"), "whiff": C.whiff_flag("play_code"), "vaa": vaa, "haa": haa,
        "is_strike": F.col("play_description").isin("Called Strike", "Swinging Strike"),
        "woba": C.woba_value("event_type", WOBA_WEIGHTS_A), "batted": F.coalesce(C.batted_ball_flag("launch_speed") == 1, F.lit(False))})


def arsenal_table(spark, sf):
    """A2 in full for the 1998 season: per pitcher and type the sums, eleven means with approach angles and expected
    wOBA on contact, and Pitch% of the pitcher's total; P34 names the type."""
    p = _rates_input(season_predictions(spark, sf).drop("woba"))
    out = summary.arsenal_rates(
        p, ["pitcher_id", "pitch_type"], total_by=["pitcher_id"], woba="woba", xwoba="expected", batted="batted",
        # feed fields that the tables lack are stood in for: induced break by az, horizontal break by ax
        means={"start_speed": "start_speed", "ivb": "az", "hb": "ax", "x0": "x0", "z0": "z0", "extension": "extension",
               "spin_rate": "spin_rate", "vaa": "vaa", "haa": "haa"})
    return _r(out.withColumn("pitch_name", C.pitch_type_name("pitch_type")))


def batter_arsenal(spark, sf):
    """What each batter sees: the arsenal table by batter and type."""
    p = _rates_input(roles.pitches(spark, sf))
    return _r(summary.arsenal_rates(p, ["batter_id", "pitch_type"], total_by=["batter_id"], means={"start_speed": "start_speed"}))


def team_boards(spark, sf):
    """O4 + W9: the pitching staffs ranked overall, by role and by park factor; one row per staff and board."""
    s = scored_pitches(spark, sf)
    sup = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pitcher_id"), F.col("s_nationkey").alias("pitcher_team"))
    s = s.join(sup, "pitcher_id")
    tot = summary.pitcher_type_totals(s, ["pitcher_id", "year"]).filter(F.col("pitch_type") == "All")
    pos = tot.select("pitcher_id", "year", C.pitch_position("pitches", "games", 1.05).alias("position"))
    cube = summary.role_cube(s.join(pos, ["pitcher_id", "year"]), "pitcher_team", "position", "stuff_plus") \
        .filter(F.col("pitcher_team") != "All").select(F.col("position").alias("board"), "pitcher_team", F.col("mean_value").alias("value"))
    flagged = distribution.home_flag(s, "game_id", "pitcher_team", ["start_time", "ab_number", "tb_p", "tb_s", "tb_q", "tb_e"])
    park = distribution.park_factor(flagged, "pitcher_team", "pitcher_home", "stuff_plus").select(
        F.lit("park factor").alias("board"), F.col("pitcher_team").cast("string"), F.col("park_factor").alias("value"))
    rows = cube.unionByName(park).withColumn("value", F.round("value", 6))
    w = Window.partitionBy("board").orderBy(F.desc_nulls_last("value"), "pitcher_team")  # a row per staff and board
    return rows.withColumn("rank", F.row_number().over(w))


#: Plate appearances a season must exceed (about what a pitcher of the supplied tables has, so that some qualify and some do not).
WOBA_MIN_PA = 35


def leaderboard_woba(spark, sf):
    """Per-pitcher plus score left-joined to the wOBA of all plate appearances that end against that pitcher (null
    where the season has ``WOBA_MIN_PA`` of them or fewer)."""
    sc = scored_pitches(spark, sf).groupBy("pitcher_id", "year").agg(F.count("stuff_plus").alias("count"), F.avg("stuff_plus").alias("stuff_plus"))
    p = roles.pitches(spark, sf).withColumn("woba", C.woba_value("event_type", WOBA_WEIGHTS_B))
    woba = expected.per_group_means(p.filter(F.col("event_type").isNotNull()), ["pitcher_id", "year"], "woba",
                                    {"woba": "woba"}, min_count=WOBA_MIN_PA, count_alias="woba_pa")
    return _r(sc.join(woba, ["pitcher_id", "year"], "left"))


def fastball_features_all(spark, sf):
    """M23 with the left join (J4) and the maximum fallback (W1); a quarter of the pitchers throws no fastball here."""
    p = roles.pitches(spark, sf).withColumn("pitch_type", F.when(F.pmod("pitcher_id", F.lit(4)) == 0, "CU").otherwise(F.col("pitch_type")))
    out = features.fastball_features(p, keep_without_baseline=True)
    return _r(out.select("pitch_uid", "year", "avg_fastball_speed", "avg_fastball_az", "avg_fastball_ax", "speed_diff", "az_diff", "ax_diff"))


def fastball_features_bucketed(spark, sf):
    """S19 with A4, J4, W1: the pitches of [fastball_features_all] saved as a table bucketed by pitcher, and the features from it, for which
    no pitch row is exchanged."""
    import uuid
    from moundlake.session import checkpoint_dir
    from moundlake.sources.sinks import write_bucketed
    p = roles.pitches(spark, sf).withColumn("pitch_type", F.when(F.pmod("pitcher_id", F.lit(4)) == 0, "CU").otherwise(F.col("pitch_type")))
    name = f"pitches_by_pitcher_{uuid.uuid4().hex[:12]}"
    write_bucketed(p, name, ["pitcher_id"], int(spark.conf.get("spark.sql.shuffle.partitions")), f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    out = features.fastball_features_co_located(spark.table(name), keep_without_baseline=True)
    return _r(out.select("pitch_uid", "year", "avg_fastball_speed", "avg_fastball_az", "avg_fastball_ax", "speed_diff", "az_diff", "ax_diff"))


def hash_split(spark, sf):
    """M4: the hash split, rows per season and side."""
    p = expected.split_flag(roles.pitches(spark, sf), "pitch_uid")
    return p.groupBy("year", "is_train").agg(F.count(F.lit(1)).alias("n"), F.sum("pitch_uid").alias("uid_sum"))


def scalar_columns(spark, sf):
    """P1, P5, P18, P20, P26, P27, P29 on columns made from customer and its names."""
    c = roles.table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" player "), F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  ")).alias("segment "),
        F.concat(F.lit("xMLBAMID_"), F.col("c_custkey").cast("string"),
                 F.when(F.pmod("c_custkey", F.lit(2)) == 0, "_2023").otherwise("_2021_2022")).alias("raw_id"),
        (F.pmod("c_custkey", F.lit(40)) / 8).alias("eighths"),
        F.when(F.pmod("c_custkey", F.lit(5)) == 0, "1997-02-30").when(F.pmod("c_custkey", F.lit(7)) == 0, "1997-2-03")
         .otherwise("1997-02-03").alias("day"),
        F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.lit(float("nan"))).when(F.pmod("c_custkey", F.lit(11)) == 0, F.lit(None))
         .otherwise(F.col("c_acctbal")).alias("speed"))
    c = C.drop_missing(C.strip_column_names(c), ["speed"])
    return c.select("player", C.upper_trim("segment").alias("segment"), C.strip_id("raw_id").alias("id"),
                    C.round_half_even("eighths", 2).alias("half_even"), F.round("eighths", 2).alias("half_up"),
                    C.is_iso_date("day").alias("is_date"), C.batted_ball_flag("speed").alias("batted"))


def whiff_lookup(spark, sf):
    """M25 with the joined columns of its lookup (J15) in the output; the lookup is unique on its keys, so no row is doubled."""
    from moundlake.operators import targets
    p = roles.pitches(spark, sf).withColumns({"is_swing": C.swing_flag("play_code"), "is_whiff": C.whiff_flag("play_code")})
    return targets.whiff_target(p).select("pitch_uid", "outcome", "target", "is_swing_whiff", "is_whiff_whiff")


def feed_events(spark, sf):
    """S1, S1b, S2, W4, W5, P17 on game-feed JSON text built from orders and lineitem: a plate appearance is up to three
    lines of an order; by its part a line is a pitch, a pick-off (neither pitch nor call: not admitted), an event with a call, or
    a ball four without a pitch. Some plays have no matchup, some pitches no pitch data."""
    from moundlake.sources.feed import FEED_SCHEMA, flatten_feed
    li, od = roles.table(spark, sf, "lineitem"), roles.table(spark, sf, "orders")
    pa = F.floor((F.col("l_linenumber") - 1) / 3).cast("int")
    # a plate appearance holds at most a few lines, an order at most three plate appearances; a line's own values are gathered
    # and its event is built from them afterwards
    ordered = F.struct(F.col("l_linenumber").alias("k1"), F.col("l_partkey").alias("k2"), F.col("l_suppkey").alias("k3"),
                       F.col("l_quantity").alias("k4"), F.col("l_extendedprice").alias("k5"), F.col("l_discount").alias("k6"), F.col("l_tax").alias("k7"))

    def numbered_event(x, i):
        kind = F.pmod(x["k2"], F.lit(10))
        pitch = kind > 2
        description = F.when(pitch, roles._cycle(["Ball", "Called Strike", "Foul", "Ball In Dirt"], F.pmod(x["k3"], F.lit(4)))) \
            .when(kind == 1, "Automatic Ball").otherwise("Pickoff 1B")
        return F.struct(
            i.alias("index"), pitch.alias("isPitch"), F.when(pitch, "pitch").otherwise("action").alias("type"), F.when(pitch, i + 1).alias("pitchNumber"),
            F.struct(F.when(kind == 2, 4).otherwise(F.pmod(x["k3"], F.lit(4))).cast("int").alias("balls"),
                     F.pmod(x["k2"], F.lit(3)).cast("int").alias("strikes"), F.pmod("l_orderkey", F.lit(3)).cast("int").alias("outs")).alias("count"),
            F.struct(description.alias("description"), F.when(pitch, "B").alias("code"),
                     F.when(kind == 1, F.struct(F.lit("A").alias("code"))).alias("call")).alias("details"),
            F.when(pitch & (kind != 9), F.struct(x["k4"].alias("startSpeed"), x["k6"].alias("releasePosX"),
                                                 x["k7"].alias("releasePosZ"), (x["k4"] / 8).alias("zReleasePoint"))).alias("pitchData"))

    plays = li.groupBy("l_orderkey", pa.alias("pa")).agg(
        F.array_sort(F.collect_list(ordered)).alias("_events"), F.min("l_suppkey").alias("pitcher"), F.min("l_partkey").alias("batter"))

    def play(x):
        pa, batter = x["k"], x["batter"]
        return F.struct(
            pa.alias("atBatIndex"), F.struct((F.pmod(pa, F.lit(2)) == 0).alias("isTopInning")).alias("about"),
            F.when(F.pmod(F.col("l_orderkey") + pa, F.lit(11)) != 0, F.struct(
                F.struct(batter.alias("id")).alias("batter"), F.struct(x["pitcher"].alias("id")).alias("pitcher"),
                F.struct(F.lit("L").alias("code")).alias("batSide"))).alias("matchup"),
            F.struct(F.lit("atBat").alias("type"), F.when(F.pmod(batter, F.lit(2)) == 0, "walk").otherwise("single").alias("eventType")).alias("result"),
            F.transform(x["events"], numbered_event).alias("playEvents"))

    appearance = F.struct(F.col("pa").alias("k"), "pitcher", "batter", F.col("_events").alias("events"))
    games = plays.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(appearance)).alias("_plays"))
    docs = games.join(od, games.l_orderkey == od.o_orderkey).select(
        F.col("o_orderkey").alias("gamePk"),
        F.struct(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("officialDate")).alias("datetime"),
                 F.struct(F.struct(F.col("o_custkey").alias("id"), F.lit("HOM").alias("abbreviation")).alias("home"),
                          F.struct(F.lit(0).alias("id"), F.lit("AWY").alias("abbreviation")).alias("away")).alias("teams")).alias("gameData"),
        F.struct(F.struct(F.transform("_plays", play).alias("allPlays")).alias("plays")).alias("liveData"))
    flat = flatten_feed(_parse(docs, FEED_SCHEMA), release=True)
    return _r(flat.select("game_id", "game_date", "ab_number", "index_play", "row_kind", "is_pitch", "batter_id", "batter_hand", "pitcher_id",
                          "pitcher_hand", "pitcher_team", "batter_team", "is_ball", "balls", "strikes", "outs", "balls_after", "strikes_after",
                          "type_ab", "event_type", "start_speed", "release_pos_x", "release_pos_z", "z_release_point"))


def run_value_mapped(spark, sf):
    """M24 with the event map (P7): events are grouped before the first lookup, unlisted ones fall through to the
    description."""
    from moundlake.operators import targets
    from moundlake.schemas import EVENT_OUTCOME
    p = roles.pitches(spark, sf).withColumn("event_type", F.when(F.col("event_type") == "field_out", roles._cycle(
        ["field_out", "double_play", "field_error", "sac_fly", "never_seen"], F.pmod("tb_p", F.lit(5)))).otherwise(F.col("event_type")))
    return _r(targets.run_value_target(p, roles.run_values(spark), event_map=EVENT_OUTCOME).select("pitch_uid", "outcome", "target"))


def _model_rows(spark, sf) -> DataFrame:
    from moundlake.operators import targets
    from moundlake.schemas import MODEL_FEATURES
    p = roles.pitches(spark, sf)
    f = features.fastball_features(targets.run_value_target(p, roles.run_values(spark)), source=p, in_place=True)
    return C.drop_missing(f, [*MODEL_FEATURES, "target"]).select("pitch_uid", "year", *MODEL_FEATURES, "target")


def robust_scaling(spark, sf):
    """The model's features scaled by median and quartiles."""
    from moundlake.operators.stuff import robust_scale
    out = robust_scale(_model_rows(spark, sf), ["start_speed", "az", "ax", "speed_diff"])
    return _r(out.select("pitch_uid", "start_speed_scaled", "az_scaled", "ax_scaled", "speed_diff_scaled"))


def model_quality(spark, sf):
    """M11, M12, M13 from one fit: rows scored, rows without a prediction, whether the error is below the target's
    variance, the number of features and the sum of their importances."""
    from moundlake.operators import stuff
    from moundlake.schemas import MODEL_FEATURES
    from moundlake.session import cut_lineage
    rows = cut_lineage(_model_rows(spark, sf))
    model = stuff.gbt_pipeline(MODEL_FEATURES, "target", max_iter=10, step_size=0.1).fit(rows)
    ranked = stuff.feature_importance(model, MODEL_FEATURES)
    wrong = (F.col("target") - F.col("prediction")) ** 2
    return model.transform(rows).agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("prediction").isNull()).alias("missing"),
        (F.avg(wrong) < F.var_pop("target")).alias("better_than_mean"), F.lit(len(ranked)).alias("features"),
        F.lit(round(sum(v for _, v in ranked), 6)).alias("importance_sum"))


LEAFWISE_FEATURES = ["start_speed", "az", "ax"]


def leafwise_two_splits(spark, sf):
    """One tree of three leaves over every model row (64 bins, L1 0.1, L2 0.2, 20 rows a leaf): splits, thresholds, gains, leaf values."""
    from moundlake.operators.trees import fit_leafwise
    from moundlake.session import cut_lineage
    rows = cut_lineage(_model_rows(spark, sf).select(*LEAFWISE_FEATURES, "target"))  # read by every pass of the fit
    model = fit_leafwise(rows, LEAFWISE_FEATURES, rounds=1, step=0.1, leaves=3, max_bins=64, column_share=1.0)
    return _r(model.table(spark).drop("tree"))


def leafwise_scores(spark, sf):
    """The predictions of that tree on every model row, beside the feature share of its two splits."""
    from moundlake.operators.trees import fit_leafwise
    from moundlake.session import cut_lineage
    rows = cut_lineage(_model_rows(spark, sf).select("pitch_uid", *LEAFWISE_FEATURES, "target"))  # read by the fit and the scoring
    model = fit_leafwise(rows, LEAFWISE_FEATURES, rounds=1, step=0.1, leaves=3, max_bins=64, column_share=1.0)
    shares = {f"share_{f}": F.lit(v) for f, v in model.importance()}
    return _r(model.transform(rows).select("pitch_uid", "target", "prediction").withColumns(shares))


SIDE_QUERIES = {f.__name__: f for f in (
    leagues_sports, game_type_values, people_rows, player_lookup, games_of_types, game_log_lines, requested_games, csv_round_trip, yearly_tables, feed_quarantine,
    batting_board, season_tables, statcast_rows, fielding_and_framing, qualified_percentiles, arsenal_table, batter_arsenal,
    team_boards, leaderboard_woba, fastball_features_all, fastball_features_bucketed, hash_split, scalar_columns, whiff_lookup, feed_events, robust_scaling, model_quality, run_value_mapped,
    leafwise_two_splits, leafwise_scores)}
