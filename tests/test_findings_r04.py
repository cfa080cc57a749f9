"""Findings of round 4: the whole model behind the importances; landed documents written sparse, parsed once, states put without counting."""

import pytest
from pyspark.sql import functions as F

from tests.test_scale_r03 import _lines


def test_importance_fits_every_round(spark, tmp_path, monkeypatch):
    """F8: the published 1000 rounds at step 0.01 (cut short here only after the query has asked for them)."""
    from moundlake.operators import stuff
    from moundlake.plans import driver
    _lines(spark, str(tmp_path), 400)
    asked, build = [], stuff.gbt_pipeline

    def watched(*args, **kwargs):
        out = build(*args, **kwargs)
        trees = out.getStages()[-1]
        asked.append((trees.getMaxIter(), trees.getStepSize(), trees.getMaxDepth(), trees.getSubsamplingRate(), trees.getFeatureSubsetStrategy()))
        trees.setMaxIter(2)
        return out
    monkeypatch.setattr(stuff, "gbt_pipeline", watched)
    rows = driver.importance(spark, str(tmp_path)).collect()
    assert asked == [(1000, 0.01, 5, 0.8, "0.8")]
    assert len(rows) == 10 and sum(r.importance for r in rows) == pytest.approx(1)


def test_sparse_documents_have_the_same_text(spark, tmp_path):
    """documents without the fields that are always null are the same JSON text, null values of the tables included."""
    from moundlake.plans import driver
    from moundlake.plans.roles import table
    _lines(spark, f"{tmp_path}/a", 90)
    table(spark, f"{tmp_path}/a", "orders").write.parquet(f"{tmp_path}/b/orders.parquet")
    odd = {c: F.when(F.pmod("l_partkey", F.lit(k)) != 0, F.col(c)) for k, c in ((3, "l_suppkey"), (4, "l_quantity"), (5, "l_returnflag"))}
    table(spark, f"{tmp_path}/a", "lineitem").withColumns(odd).write.parquet(f"{tmp_path}/b/lineitem.parquet")
    text = []
    for sparse in (False, True):
        driver.feed_documents(spark, f"{tmp_path}/b", speed_bump=F.lit(0.5), sparse=sparse).write.json(f"{tmp_path}/{sparse}")
        text.append(sorted(r.value for r in spark.read.text(f"{tmp_path}/{sparse}").collect()))
    assert text[0] == text[1] and len(text[0]) == 30


def _landed(path, name, games):
    import json
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(g if isinstance(g, str) else json.dumps(
        {"gamePk": g, "liveData": {"plays": {"allPlays": [{"atBatIndex": 0, "playEvents": [
            {"index": 0, "isPitch": True, "pitchData": {"startSpeed": 90.0 + g}}]}]}}}) for g in games))


@pytest.mark.parametrize("stream", ["ingest", "plays"])
def test_batch_is_parsed_again_only_for_malformed_documents(spark, tmp_path, monkeypatch, stream):
    """a batch whose documents are all well-formed is parsed once; one with malformed ones still quarantines every one of them."""
    from moundlake.streaming import ingest, plays
    again, real = [], ingest.quarantined
    monkeypatch.setattr(ingest, "quarantined", lambda *a, **k: again.append(1) or real(*a, **k))
    start = ingest.start_feed_ingest if stream == "ingest" else plays.stage_documents
    run = lambda: start(spark, f"{tmp_path}/landing", f"{tmp_path}/t", f"{tmp_path}/ckpt", multiline=False).awaitTermination()
    _landed(tmp_path / "landing", "a.json", [1, 2, 3])
    run()
    assert not again
    _landed(tmp_path / "landing", "b.json", [4, '{"gamePk": 9, "live', "no document", 5])
    run()
    assert len(again) == 1
    bad = spark.read.parquet(ingest.quarantine_path(f"{tmp_path}/t")).collect()
    assert sorted(r.document for r in bad) == ["no document", '{"gamePk": 9, "live']
    assert sorted(r.game_id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [1, 2, 3, 4, 5]


def test_play_state_has_a_row_for_each_play_only(spark):
    """no row of the game beside its plays goes through the state, and the store's rows are not counted as they are written."""
    from moundlake.streaming.ingest import VERSION
    from moundlake.streaming.plays import keyed_plays, rocksdb_state
    events = spark.createDataFrame([(g, 0, p, None, 90.0 + p, f, 0, 0, f"f{f}") for g in (1, 2, None) for p in range(3) for f in (1, 2)],
                                   "game_id long, ab_number int, index_play int, play_id string, start_speed double, s long, _block long, _place long, _file string")
    events = events.withColumn("_landed", F.timestamp_seconds("s")).drop("s").select("*")
    rows = keyed_plays(events).collect()
    assert len(rows) == 9 and all(r.play_key is not None and r.newest.version._file == "f2" for r in rows) and set(VERSION) <= set(events.columns)
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(name, None)
    with rocksdb_state(spark):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name, None) == before
