"""Tabular sources (S13-S16, S18, S21-S24): leaderboard JSON, CSV scans with
declared schemas, statcast rows, box scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moundlake.operators.boards import stack_frames
from moundlake.schemas import PITCHING_BOARD
from moundlake.sources.landed import read_documents


def leaderboard_json(spark: SparkSession, path, schema: T.StructType = PITCHING_BOARD, quarantine: str | None = None) -> DataFrame:
    """Leaderboard JSON ``{"data": [...]}`` with a declared row schema. ``quarantine``: see ``landed.read_documents``."""
    return flatten_leaderboard(read_documents(spark, path, leaderboard_schema(schema), quarantine))


def leaderboard_schema(schema: T.StructType = PITCHING_BOARD) -> T.StructType:
    return T.StructType([T.StructField("data", T.ArrayType(schema))])


def flatten_leaderboard(raw: DataFrame) -> DataFrame:
    """One row per leaderboard entry."""
    return raw.select(F.explode("data").alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             drop_index: bool = False) -> DataFrame:
    """CSV scan with a declared schema (no inference); multi-file; optional
    leading index column dropped. The files' headers must name the schema's columns in its order: a header that does not fails the
    read instead of shifting values. Files that differ go through :func:`read_csv_by_name`."""
    if drop_index:
        schema = T.StructType([T.StructField("_index", T.LongType())] + list(schema.fields))
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return df.drop("_index") if drop_index else df


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of ``path`` by their header line. Only the first line of a file is read here; files without one are left out."""
    paths = [path] if isinstance(path, str) else list(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).where("length > 0").select("path")
    groups: dict[tuple[str, ...], list[str]] = {}
    for (file,) in sorted(listed.collect()):  # one row per landed file: names, not data
        names = spark.read.option("header", True).csv(file).columns
        groups.setdefault(tuple(names), []).append(file)
    return groups


def read_csv_by_name(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, year_col: str | None = None,
                     year_pattern: str = r"(\d{4})[^/]*(?:/[^/]*)?$", label: str | None = None) -> DataFrame:
    """Yearly CSV files whose columns come in any order and number, united by column name.

    The files are grouped by their headers; each group is one scan with the declared types put on the columns of that name (blanks
    around a name are ignored, case counts). Columns of ``schema`` that a file lacks are null, columns that it has besides
    are dropped. ``year_col`` is taken from the file's (or its folder's) name; ``label`` adds the number of the header group. A value
    that does not fit its declared type fails the read. No files, or files without any of the columns, give the schema's columns and no values."""
    types = {f.name: f.dataType for f in schema.fields}
    frames = {}
    for number, (names, files) in enumerate(sorted(csv_headers(spark, path).items())):
        as_read = T.StructType([T.StructField(n, types.get(n.strip(), T.StringType())) for n in names])
        df = spark.read.schema(as_read).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(files)
        cols = [F.col(f"`{n}`").alias(n.strip()) for n in names if n.strip() in types]
        if year_col:
            cols.append(F.regexp_extract(F.col("_metadata.file_path"), year_pattern, 1).cast("int").alias(year_col))
        frames[str(number)] = df.select(*cols)
    wanted = T.StructType(list(schema.fields) + ([T.StructField(year_col, T.IntegerType())] if year_col else []))
    mark = label or "_header"
    empty = spark.createDataFrame([], wanted)
    out = stack_frames({"": empty} | frames, mark)
    return out if label else out.drop(mark)


def statcast_batter(rows: DataFrame, batter_id: int, start: str, end: str) -> DataFrame:
    """A batter's pitch rows in a date range (inclusive; DateType compare, T25)."""
    return rows.filter((F.col("batter") == batter_id) &
                       F.col("game_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def fielding_framing(fielding: DataFrame, framing: DataFrame, min_attempts: int = 5,
                     attempts_col: str = "called_pitches") -> DataFrame:
    """Framing rows with a minimum sample, renamed to the card's names, then J9."""
    from moundlake.operators.joins import outer_merge
    fr = framing.filter(F.col(attempts_col) >= min_attempts)
    return outer_merge([fielding, fr], ["xMLBAMID"], ["_oaa", "_cfr"])


BOX_PLAYER = T.StructType([
    T.StructField("person", T.StructType([T.StructField("id", T.LongType()),
                                          T.StructField("fullName", T.StringType())])),
    T.StructField("stats", T.StructType([T.StructField("pitching", T.MapType(T.StringType(), T.StringType())),
                                         T.StructField("batting", T.MapType(T.StringType(), T.StringType()))])),
])
BOX_SCHEMA = T.StructType([T.StructField("teams", T.StructType([
    T.StructField(side, T.StructType([T.StructField("players", T.MapType(T.StringType(), BOX_PLAYER))]))
    for side in ("home", "away")]))])


def box_score(spark: SparkSession, path, game_id: int | None = None, quarantine: str | None = None) -> DataFrame:
    """S21 from a landed box-score file (see ``flatten_box_score``). ``quarantine``: see ``landed.read_documents``."""
    out = flatten_box_score(read_documents(spark, path, BOX_SCHEMA, quarantine))
    return out if game_id is None else out.withColumn("game_id", F.lit(game_id))


def flatten_box_score(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Players of both sides from the box-score map (empty map -> no rows);
    ``keep`` carries document-level columns (e.g. the game id) along."""
    sides = [raw.select(*keep, F.lit(s).alias("side"), F.explode(F.col(f"teams.{s}.players")).alias("key", "p"))
             for s in ("home", "away")]
    out = sides[0].unionByName(sides[1])
    return out.select(*keep, "side", "key", F.col("p.person.id").alias("player_id"),
                      F.col("p.person.fullName").alias("name"),
                      F.col("p.stats.pitching").alias("pitching"), F.col("p.stats.batting").alias("batting"))
