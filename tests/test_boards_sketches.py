"""Boards that follow the stream by signed changes, against full recounts; stored distinct sketches."""

import random
from collections import defaultdict
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from moundlake.operators import sketches
from moundlake.streaming.boards import MomentBoard

SCHEMA = "game_id long, pitcher string, x double, _landed timestamp, _file string, _block long, _place long"


def rows_of(game, version, rnd):
    import datetime as dt
    at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=version)
    values = [None, float("nan"), float("inf"), 0.1, 0.2, 0.3, 97.7, -3.25]
    return [(game, rnd.choice(["a", "b", "c", None]), rnd.choice(values), at, "f", 0, version) for _ in range(rnd.randrange(1, 9))]


def recount(current):
    groups = defaultdict(list)
    for rows in current.values():
        for r in rows:
            groups[r[1]].append(r[2])
    out = {}
    for k, vs in groups.items():
        ok = [v for v in vs if v is not None and v == v and abs(v) != float("inf")]
        out[k] = (len(vs), len(ok), round(sum(ok), 6), round(mean(ok), 6) if ok else None, round(stdev(ok), 6) if len(ok) > 1 else None)
    return out


def seen(board, spark):
    def r(x):
        return None if x is None else round(x, 6)
    return {b.pitcher: (b.rows, b.n_x, r(b.sum_x), r(b.mean_x), r(b.std_x)) for b in board.board(spark).collect()}


@pytest.mark.parametrize("keep", ["newest", "first"])
def test_board_equals_a_recount_after_every_batch(spark, tmp_path, keep):
    """Late versions, repeated games, null games and keys, a replayed batch, compaction in between and a replay after it."""
    rnd = random.Random(3)
    board = MomentBoard(str(tmp_path / "board"), ["pitcher"], ["x"], keep)
    with pytest.raises(ValueError):
        board.board(spark)
    current, version = {}, {}
    for batch in range(5):
        games = {}
        for game in rnd.sample([None, 1, 2, 3, 4, 5], 3):
            v = rnd.randrange(100)
            games[game] = (v, rows_of(game, v, rnd))
        frame = spark.createDataFrame([r for _, rows in games.values() for r in rows], SCHEMA)
        board.apply(frame, batch)
        for game, (v, rows) in games.items():
            if game not in version or (v > version[game] if keep == "newest" else v < version[game]):
                version[game], current[game] = v, rows
        assert seen(board, spark) == recount(current)
        if batch in (1, 3):
            if batch == 3:
                board.apply(frame, batch)  # replayed before and after it is folded
                assert seen(board, spark) == recount(current)
            board.compact(spark)
            board.apply(frame, batch)
            assert seen(board, spark) == recount(current)
    board.compact(spark)
    board.compact(spark)
    assert seen(board, spark) == recount(current)


def test_batch_cut_off_before_its_totals_counts_once(spark, tmp_path, monkeypatch):
    """A batch that fails between its tables is not seen, and its replay counts once, also when another board object takes over."""
    rnd = random.Random(5)
    path = str(tmp_path / "board")
    first = spark.createDataFrame(rows_of(1, 1, rnd), SCHEMA)
    again = rows_of(1, 2, rnd)
    board = MomentBoard(path, ["pitcher"], ["x"])
    board.apply(first, 0)
    before = seen(board, spark)
    put = MomentBoard._put

    def fails(self, rows, name, batch_id):
        if name == "totals":
            raise RuntimeError("lost")
        put(self, rows, name, batch_id)
    monkeypatch.setattr(MomentBoard, "_put", fails)
    with pytest.raises(RuntimeError):
        board.apply(spark.createDataFrame(again, SCHEMA), 1)
    monkeypatch.setattr(MomentBoard, "_put", put)
    board.compact(spark)
    assert seen(board, spark) == before
    other = MomentBoard(path, ["pitcher"], ["x"])
    other.apply(spark.createDataFrame(again, SCHEMA), 1)
    assert seen(other, spark) == recount({1: again})


def test_sketches_unite_upwards(spark, tmp_path):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("year"),
                                    F.when(F.col("id") % 11 != 0, F.col("id") % 20_000).alias("game"))
    path = str(tmp_path / "sketches")
    sketches.distinct_sketches(df, ["k", "year"], "game").write.parquet(path)
    stored = spark.read.parquet(path)
    for keys in (["k"], []):
        united = {tuple(r)[:-1]: r.n for r in sketches.estimate(sketches.union_sketches(stored, keys), "n").collect()}
        whole = {tuple(r)[:-1]: r.n for r in sketches.estimate(sketches.union_sketches(sketches.distinct_sketches(df, keys, "game"), keys), "n").collect()}
        true = {tuple(r)[:-1]: r.n for r in df.groupBy(*keys).agg(F.count_distinct("game").alias("n")).collect()}
        assert united.keys() == whole.keys() == true.keys()
        for k in true:
            assert abs(united[k] - true[k]) <= sketches.error_bound() * true[k]
            assert abs(united[k] - whole[k]) <= sketches.error_bound() * true[k]
    few = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None)], "k string, game long")
    small = sketches.estimate(sketches.distinct_sketches(few, ["k"], "game"), "n")
    assert {r.k: r.n for r in small.collect()} == {"a": 1, "b": 0}
    assert sketches.distinct_sketches(few.limit(0), ["k"], "game").count() == 0
