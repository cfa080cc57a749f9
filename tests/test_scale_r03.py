"""Work and written bytes that grow no faster than the tables: scored table, requested games, lineage cuts, landed feeds."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from moundlake.session import cut_lineage


def _lines(spark, path, n=60):
    li = spark.range(n).select(
        F.floor(F.col("id") / 3).cast("long").alias("l_orderkey"), (F.col("id") % 17).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        (F.col("id") % 3 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 50).cast("double").alias("l_quantity"),
        (F.col("id") * 1.5).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"), F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.expr("timestamp_ntz'1996-03-01 00:00:00' + make_dt_interval(cast(id % 700 as int))").alias("l_shipdate"))
    li.write.parquet(f"{path}/lineitem.parquet")
    spark.range(n // 3).select(F.col("id").alias("o_orderkey"), (F.col("id") % 4).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                               F.lit("1-URGENT").alias("o_orderpriority"), F.lit(5000.0).alias("o_totalprice"),
                               F.expr("timestamp_ntz'1996-03-01 00:00:00'").alias("o_orderdate")).write.parquet(f"{path}/orders.parquet")


def test_scored_table_holds_what_boards_read(spark, tmp_path):
    """no measurement columns in the scored table, every row of the scores in it."""
    from moundlake.plans import driver
    _lines(spark, str(tmp_path))
    got, want = driver.scored_pitches(spark, str(tmp_path)), driver.score_pitches(spark, str(tmp_path))
    assert set(got.columns) == set(driver.SCORED) and "spin_rate" not in got.columns
    key = lambda r: str(r)
    assert sorted(got.select(*driver.SCORED).collect(), key=key) == sorted(want.select(*driver.SCORED).collect(), key=key)


def test_table_written_without_gathering(spark, tmp_path):
    """every season's rows in its folder, as with the exchange."""
    from moundlake.sources.sinks import write_table
    df = spark.range(100).select("id", F.when(F.col("id") % 9 != 0, 1990 + F.col("id") % 40).alias("year"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    write_table(df, f"{tmp_path}/t", gather=False)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    back = spark.read.schema("id long, year long").parquet(f"{tmp_path}/t")
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert len(glob.glob(f"{tmp_path}/t/year=*")) == 41  # 40 seasons and the rows without one


def test_requests_summed_without_the_pairs(spark):
    """one row per request equals the summary of the request's games, with repeated, null and unknown keys."""
    from moundlake.sources.schedule import player_games_safe
    req = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "a"), (3, None), (4, "b"), (5, "none")], "player_id long, date string")
    log = spark.createDataFrame([(1, "a", 10), (1, "a", None), (None, "a", 3), (4, "b", None), (9, "a", 4)], "player_id long, date string, game_id long")
    days = spark.createDataFrame([("a", 10), ("a", 11), ("b", 12), (None, 13)], "date string, game_id long")
    rows = player_games_safe(req, log, days).groupBy("player_id", "date").agg(
        F.count(F.lit(1)).alias("games"), F.min("game_id").alias("first_game"), F.max("game_id").alias("last_game"))
    got = player_games_safe(req, log, days, per_request=True)
    assert got.columns == rows.columns
    assert sorted(got.collect(), key=str) == sorted(rows.collect(), key=str)


def test_lineage_cut_holds_rows_once(spark):
    """The cut is a table in the shared folder, nothing is kept in storage; what Parquet cannot hold is still cut."""
    df = spark.range(5).select("id", F.struct(F.lit(None).cast("string").alias("x"), F.array("id").alias("y")).alias("s"))
    out = cut_lineage(df)
    assert out.inputFiles() and all("moundlake-cut-" in f for f in out.inputFiles())
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [(f.name, f.dataType.simpleString()) for f in df.schema]
    assert sorted(out.collect()) == sorted(df.collect())
    odd = cut_lineage(spark.range(2).select("id", F.lit(None).alias("nothing")))
    assert odd.count() == 2 and odd.schema["nothing"].dataType.typeName() == "void"


@pytest.mark.parametrize("name", ["feed_quarantine", "stream_ingest"])
def test_landed_feeds_are_compressed(spark, tmp_path, name):
    """Landed documents lie compressed and every game comes back."""
    from moundlake.plans.driver import stream_ingest
    from moundlake.plans.side_driver import feed_quarantine
    _lines(spark, str(tmp_path))
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    seen = set(glob.glob(f"{root}/**/part-*.gz", recursive=True))
    out = {"feed_quarantine": feed_quarantine, "stream_ingest": stream_ingest}[name](spark, str(tmp_path))
    assert out.select("game_id").distinct().count() == 20
    new = set(glob.glob(f"{root}/**/part-*.gz", recursive=True)) - seen
    assert new and all(os.path.getsize(f) > 0 for f in new)


@pytest.mark.parametrize("keep", ["newest", "first"])
def test_versions_are_chosen_by_short_keys(spark, keep):
    """ties of time, block and place go to the file's name, over batches; events meet the chosen versions without file names."""
    from moundlake.streaming.ingest import _chosen
    t = [F.timestamp_seconds(F.lit(s)) for s in (10, 20)]
    rows = None
    for game, when, file, batch, n in [(1, 0, "a", 0, 3), (1, 1, "b", 1, 2), (2, 0, "b", 0, 2), (2, 0, "a", 0, 1), (None, 0, "a", 0, 2), (None, 1, "a", 1, 1)]:
        one = spark.range(n).select(F.lit(game).cast("long").alias("game_id"), (F.col("id") + 100 * batch).alias("x"), t[when].alias("_landed"),
                                    F.lit(file).alias("_file"), F.lit(0).cast("long").alias("_block"), F.lit(7).cast("long").alias("_place"),
                                    F.lit(batch).cast("long").alias("_batch"))
        rows = one if rows is None else rows.union(one)
    rows = cut_lineage(rows)
    out = _chosen(rows, keep)
    got = sorted((str(r.game_id), r._file, r._batch, r.x) for r in out.collect())
    want = {"newest": [("1", "b", 1, 100), ("1", "b", 1, 101), ("2", "b", 0, 0), ("2", "b", 0, 1), ("None", "a", 1, 100)],
            "first": [("1", "a", 0, 0), ("1", "a", 0, 1), ("1", "a", 0, 2), ("2", "a", 0, 0), ("None", "a", 0, 0), ("None", "a", 0, 1)]}
    assert got == want[keep]
    plan = out.select("game_id", "x")._jdf.queryExecution().sparkPlan().toString()
    assert "xxhash64(_file" in plan.replace("xxhash64([_file", "xxhash64(_file")
    lowest = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest  # the events are not sorted to find their versions


def test_plays_are_built_after_the_join(spark, tmp_path):
    """the join of lines and orders sorts lines, not the documents made of them."""
    from moundlake.plans.driver import feed_documents
    _lines(spark, str(tmp_path))
    plan = feed_documents(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("transform(") < plan.index("Join")


def test_model_rows_meet_baselines_without_an_exchange(spark, tmp_path):
    """a small baseline is broadcast, the lookups are not repeated for it, and the rows are the same."""
    from moundlake.operators import features, targets
    from moundlake.plans import roles, side_driver
    _lines(spark, str(tmp_path))
    p = roles.pitches(spark, str(tmp_path))
    t = targets.run_value_target(p, roles.run_values(spark))
    cols = ["pitch_uid", "target", "speed_diff", "az_diff", "ax_diff"]
    key = lambda r: str(r)
    for keep in (False, True):
        one = features.fastball_features(t, keep_without_baseline=keep).select(*cols).collect()
        for in_place in (False, True):
            two = features.fastball_features(t, keep_without_baseline=keep, source=p, in_place=in_place).select(*cols).collect()
            assert one and sorted(one, key=key) == sorted(two, key=key)
    plan = side_driver._model_rows(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(pitcher_id" not in plan
