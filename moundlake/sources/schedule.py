"""Schedule and game lists (S3-S6) from landed schedule / game-log JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _S, _I = T.LongType(), T.StringType(), T.IntegerType()


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


_TEAM_SIDE = _st(("team", _st(("id", _L), ("name", _S), ("abbreviation", _S))))
_GAME = _st(
    ("gamePk", _L), ("gameDate", _S), ("officialDate", _S), ("gameType", _S), ("gamedayType", _S),
    ("status", _st(("codedGameState", _S), ("abstractGameState", _S))),
    ("venue", _st(("id", _L), ("name", _S))),
    ("teams", _st(("away", _TEAM_SIDE), ("home", _TEAM_SIDE))),
)
SCHEDULE_SCHEMA = _st(("dates", T.ArrayType(_st(("date", _S), ("games", T.ArrayType(_GAME))))))

_STAT = _st(("outs", _L), ("inningsPitched", _S), ("strikeOuts", _L), ("baseOnBalls", _L), ("earnedRuns", _L),
            ("hits", _L), ("homeRuns", _L), ("battersFaced", _L))
_SPLIT = _st(("game", _st(("gamePk", _L), ("date", _S))), ("date", _S), ("opponent", _st(("name", _S))),
             ("stat", _STAT))
GAME_LOG_SCHEMA = _st(("people", T.ArrayType(_st(
    ("id", _L), ("stats", T.ArrayType(_st(("splits", T.ArrayType(_SPLIT)))))))))


def read_schedule(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.schema(SCHEDULE_SCHEMA).option("multiLine", True).json(path)


def flatten_schedule(raw: DataFrame, tz: str = "America/New_York", time_format: str = "hh:mm a") -> DataFrame:
    """S3: dates[].games[] -> one row per game; date parsed; start time localised and
    formatted; one row per game_id (deterministic: earliest start, then venue);
    sorted by date. Null game ids are dropped."""
    g = raw.select(F.explode("dates").alias("d")).select(F.explode("d.games").alias("g")).select("g.*")
    # UTC wall clock without a zone, converted explicitly: independent of the session time zone
    ts = F.coalesce(F.to_timestamp_ntz("gameDate", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")),
                    F.to_timestamp_ntz("gameDate"))
    out = g.select(
        F.col("gamePk").alias("game_id"),
        ts.alias("start_utc"),
        F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts), time_format).alias("time"),
        F.to_date("officialDate").alias("date"),
        F.col("teams.away.team.name").alias("away"), F.col("teams.home.team.name").alias("home"),
        F.col("teams.away.team.id").alias("away_id"), F.col("teams.home.team.id").alias("home_id"),
        F.col("status.codedGameState").alias("state"),
        F.col("venue.id").alias("venue_id"), F.col("venue.name").alias("venue_name"),
        F.col("gamedayType").alias("gameday_type"), F.col("gameType").alias("game_type"),
    ).filter(F.col("game_id").isNotNull())
    # one row per game, chosen deterministically (earliest start, then venue, then teams)
    w = Window.partitionBy("game_id").orderBy(*[F.asc_nulls_last(c) for c in
                                                ("start_utc", "venue_id", "away_id", "home_id", "state")])
    out = out.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return out.orderBy("date", "start_utc", "game_id")


def games_on_date(schedule: DataFrame, date: str, game_types: Sequence[str] | None = None) -> DataFrame:
    """Game ids on one date (optionally of some game types), null ids dropped."""
    cond = (F.col("date") == F.to_date(F.lit(date))) & F.col("game_id").isNotNull()
    if game_types:
        cond = cond & F.col("game_type").isin(list(game_types))
    return schedule.filter(cond).select("game_id")


def read_game_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.schema(GAME_LOG_SCHEMA).option("multiLine", True).json(path)


def player_game_log(raw: DataFrame) -> DataFrame:
    """One row per (player, game) with the pitching line; missing stats -> null."""
    p = raw.select(F.explode("people").alias("p"))
    s = p.select(F.col("p.id").alias("player_id"),
                 F.explode_outer(F.col("p.stats")[0]["splits"]).alias("s"))
    return s.select(
        "player_id",
        F.col("s.game.gamePk").alias("game_id"),
        F.to_date(F.coalesce(F.col("s.date"), F.col("s.game.date"))).alias("date"),
        F.col("s.opponent.name").alias("opponent"),
        F.col("s.stat.outs").alias("outs"), F.col("s.stat.inningsPitched").alias("innings_pitched"),
        F.col("s.stat.strikeOuts").alias("strikeouts"), F.col("s.stat.baseOnBalls").alias("walks"),
        F.col("s.stat.earnedRuns").alias("earned_runs"), F.col("s.stat.hits").alias("hits"),
        F.col("s.stat.homeRuns").alias("home_runs"), F.col("s.stat.battersFaced").alias("batters_faced"))


def player_games(log: DataFrame, season: int, start: str | None = None, end: str | None = None) -> DataFrame:
    """A player's game ids within [start, end] (default Jan 1 - Dec 31 of the season)."""
    lo = F.to_date(F.lit(start)) if start else F.make_date(F.lit(season), F.lit(1), F.lit(1))
    hi = F.to_date(F.lit(end)) if end else F.make_date(F.lit(season), F.lit(12), F.lit(31))
    return (log.filter(F.col("date").between(lo, hi) & F.col("game_id").isNotNull())
               .select("player_id", "game_id", "date"))


def player_games_safe(requests: DataFrame, log_games: DataFrame, schedule: DataFrame, per_request: bool = False) -> DataFrame:
    """S5b, set-based: for each request (player_id, date) its logged games on that date,
    and for requests with no logged game, every scheduled game of that date
    (left-anti join instead of a per-request ``if``).

    With ``per_request`` one row per request that has games: ``games``, ``first_game`` and ``last_game``, the count and the ends of those
    rows. The logged games are summed up by player and date and the schedule by date before they meet the requests, so the
    work grows with the three tables and not with requests times games of a date."""
    if per_request:
        ends = [F.min("game_id").alias("first_game"), F.max("game_id").alias("last_game")]
        asked = requests.groupBy("player_id", "date").agg(F.count(F.lit(1)).alias("_asked"))
        log = log_games.groupBy(F.col("player_id").alias("_p"), F.col("date").alias("_d")).agg(F.count(F.lit(1)).alias("_n"), *ends)
        day = schedule.groupBy("date").agg(F.count(F.lit(1)).alias("_day_n"), *[c.alias(f"_day_{n}") for c, n in (
            (F.min("game_id"), "first"), (F.max("game_id"), "last"))])
        mine = asked.join(log, (F.col("player_id") == F.col("_p")) & (F.col("date") == F.col("_d")), "left")
        both, logged = mine.join(day, "date", "left"), F.col("_n").isNotNull()
        n = F.when(logged, F.col("_n")).otherwise(F.col("_day_n"))
        return both.where(n.isNotNull()).select(
            "player_id", "date", (n * F.col("_asked")).alias("games"), F.when(logged, F.col("first_game")).otherwise(F.col("_day_first")).alias("first_game"),
            F.when(logged, F.col("last_game")).otherwise(F.col("_day_last")).alias("last_game"))
    logged = requests.join(log_games, ["player_id", "date"], "inner").select("player_id", "date", "game_id")
    missing = requests.join(log_games.select("player_id", "date").distinct(), ["player_id", "date"], "left_anti")
    fallback = missing.join(schedule.select("date", "game_id"), "date", "inner").select("player_id", "date", "game_id")
    return logged.unionByName(fallback)
