"""Teams, leagues, sports, game types, players, people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moundlake.operators.joins import parent_lookup

_L, _S, _I, _B = T.LongType(), T.StringType(), T.IntegerType(), T.BooleanType()


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


_REF = _st(("id", _L), ("name", _S), ("abbreviation", _S))
TEAMS_SCHEMA = _st(("teams", T.ArrayType(_st(
    ("id", _L), ("name", _S), ("franchiseName", _S), ("clubName", _S), ("abbreviation", _S),
    ("parentOrgId", _L), ("parentOrgName", _S), ("league", _REF), ("sport", _REF)))))
LEAGUES_SCHEMA = _st(("leagues", T.ArrayType(_st(
    ("id", _L), ("name", _S), ("abbreviation", _S), ("sport", _st(("id", _L)))))))
SPORTS_SCHEMA = _st(("sports", T.ArrayType(_st(("id", _L), ("code", _S), ("name", _S), ("abbreviation", _S)))))
GAME_TYPES_SCHEMA = T.ArrayType(_st(("id", _S), ("description", _S)))
PEOPLE_SCHEMA = _st(("people", T.ArrayType(_st(
    ("id", _L), ("firstName", _S), ("lastName", _S), ("fullName", _S), ("useName", _S),
    ("primaryPosition", _st(("abbreviation", _S))), ("currentTeam", _st(("id", _L))),
    ("weight", _L), ("height", _S), ("currentAge", _L), ("birthDate", _S),
    ("batSide", _st(("code", _S))), ("pitchHand", _st(("code", _S)))))))


def _read(spark: SparkSession, schema, path):
    return spark.read.schema(schema).option("multiLine", True).json(path)


def teams(spark: SparkSession, path) -> DataFrame:
    """S7 from landed JSON files (see ``flatten_teams``)."""
    return flatten_teams(_read(spark, TEAMS_SCHEMA, path))


def flatten_teams(raw: DataFrame) -> DataFrame:
    """S7 + J8: distinct teams with ids; a null parent is the team itself (P9); the
    parent's abbreviation by a left self join. ``city`` is the franchise name (T14)."""
    t = raw.select(F.explode("teams").alias("t")).select(
        F.col("t.id").alias("team_id"), F.col("t.franchiseName").alias("city"), F.col("t.name").alias("name"),
        F.col("t.clubName").alias("franchise"), F.col("t.abbreviation").alias("abbreviation"),
        F.col("t.parentOrgId").alias("parent_org_id"), F.col("t.parentOrgName").alias("parent_org"),
        F.col("t.league.id").alias("league_id"), F.col("t.league.name").alias("league_name"),
        F.col("t.sport.id").alias("sport_id"))
    t = t.distinct().dropna(subset=["team_id"])
    t = t.withColumns({"parent_org_id": F.coalesce("parent_org_id", "team_id"),
                       "parent_org": F.coalesce("parent_org", "name")})
    return parent_lookup(t, "team_id", "parent_org_id", "abbreviation", "parent_org_abbreviation").orderBy("team_id")


def leagues(spark: SparkSession, path) -> DataFrame:
    """S8 from landed JSON files."""
    return flatten_leagues(_read(spark, LEAGUES_SCHEMA, path))


def flatten_leagues(raw: DataFrame) -> DataFrame:
    return raw.select(F.explode("leagues").alias("l")).select(
        F.col("l.id").alias("league_id"), F.col("l.name").alias("league_name"),
        F.col("l.abbreviation").alias("league_abbreviation"), F.col("l.sport.id").alias("sport_id"))


def sports(spark: SparkSession, path) -> DataFrame:
    """S9 from landed JSON files."""
    return flatten_sports(_read(spark, SPORTS_SCHEMA, path))


def flatten_sports(raw: DataFrame) -> DataFrame:
    return raw.select(F.explode("sports").alias("s")).select(
        F.col("s.id").alias("sport_id"), F.col("s.code").alias("sport_code"), F.col("s.name").alias("sport_name"),
        F.col("s.abbreviation").alias("sport_abbreviation"))


def sport_exists(sport_table: DataFrame, sport_id: int) -> bool:
    """S9 membership check (a bounded probe, not a collect)."""
    return not sport_table.filter(F.col("sport_id") == sport_id).isEmpty()


def game_types(spark: SparkSession, path) -> DataFrame:
    """A JSON array of {id, description}."""
    raw = spark.read.option("multiLine", True).schema(GAME_TYPES_SCHEMA.elementType).json(path)
    return raw.select(F.col("id").alias("game_type"), "description")


def people(spark: SparkSession, path) -> DataFrame:
    return flatten_people(_read(spark, PEOPLE_SCHEMA, path))


def flatten_people(raw: DataFrame) -> DataFrame:
    """Players with bio fields (missing -> null)."""
    return raw.select(F.explode("people").alias("p")).select(
        F.col("p.id").alias("player_id"), F.col("p.firstName").alias("first_name"),
        F.col("p.lastName").alias("last_name"), F.col("p.fullName").alias("name"),
        F.col("p.primaryPosition.abbreviation").alias("position"), F.col("p.currentTeam.id").alias("team"),
        F.col("p.weight").alias("weight"), F.col("p.height").alias("height"), F.col("p.currentAge").alias("age"),
        F.to_date("p.birthDate").alias("birth_date"), F.col("p.batSide.code").alias("bats"),
        F.col("p.pitchHand.code").alias("throws"))


def players_union(frames: Sequence[DataFrame]) -> DataFrame:
    """S11 spring form: pitchers and batters unioned, distinct, ids required, sorted."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct().dropna(subset=["player_id"]).orderBy("player_id")


def current_team_abbr(people_df: DataFrame, teams_df: DataFrame, top_sport: int = 1) -> DataFrame:
    """Current team abbreviation, only when that team plays in the top sport."""
    t = teams_df.select(F.col("team_id").alias("team"), "abbreviation", "sport_id")
    j = people_df.join(t, "team", "left")
    return j.select("player_id", F.when(F.col("sport_id") == top_sport, F.col("abbreviation")).alias("team_abbr"))


def lookup_player(people_df: DataFrame, last: str, first: str | None = None) -> DataFrame:
    """Case-insensitive name lookup."""
    cond = F.lower(F.col("last_name")) == last.lower()
    if first is not None:
        cond = cond & (F.lower(F.col("first_name")) == first.lower())
    return people_df.filter(cond)
