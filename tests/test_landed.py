"""Landed files that are malformed, misordered or repeated; the stored nearest-neighbour index; selections of exact size."""

import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from moundlake.operators import distribution, expected
from moundlake.operators.sequence import first_by_hash
from moundlake.sources import feed, tables

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("war", T.DoubleType()), T.StructField("games", T.LongType())])


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_in_another_order_is_never_shifted(spark, tmp_path):
    put(tmp_path / "a", "b_2021.csv", "id,war,games\n1,2.5,20\n")
    put(tmp_path / "a", "b_2022.csv", "id,games,war\n1,30,3.5\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "a"), SCHEMA).collect()


def test_yearly_files_united_by_name(spark, tmp_path):
    d = str(tmp_path / "y")
    put(d, "batting_2021.csv", "id,war,games\n1,2.5,20\n2,,\n")
    put(d, "batting_2022.csv", ",games, war ,team,id\n0,30,3.5,\"a, b\",1\n")
    put(d, "batting_2023.csv", "id,war\n1,4.5\n")
    put(d, "empty_2024.csv", "")
    got = {(r.id, r.war, r.games, r.year) for r in tables.read_csv_by_name(spark, d, SCHEMA, year_col="year").collect()}
    assert got == {(1, 2.5, 20, 2021), (2, None, None, 2021), (1, 3.5, 30, 2022), (1, 4.5, None, 2023)}
    assert tables.read_csv_by_name(spark, d, SCHEMA, label="kind").select("kind").distinct().count() == 3
    put(str(tmp_path / "none"), "x.txt", "")
    none = tables.read_csv_by_name(spark, str(tmp_path / "none"), SCHEMA, year_col="year")
    assert none.count() == 0 and none.columns == ["id", "war", "games", "year"]


def test_value_of_another_type_fails(spark, tmp_path):
    put(str(tmp_path), "x_2021.csv", "war,id\nnone,1\n")
    with pytest.raises(Exception):
        tables.read_csv_by_name(spark, str(tmp_path), SCHEMA).collect()


def game(pk, speed):
    pitch = {"isPitch": True, "index": 0, "details": {"call": {"code": "B"}}, "pitchData": {"startSpeed": speed}}
    return {"gamePk": pk, "liveData": {"plays": {"allPlays": [{"about": {"atBatIndex": 0}, "playEvents": [pitch]}]}}}


def test_malformed_documents_fail_or_go_to_quarantine(spark, tmp_path):
    d, bad = str(tmp_path / "in"), str(tmp_path / "bad")
    put(d, "a.json", json.dumps(game(1, 90.0)))
    whole = json.dumps(game(2, 91.0))
    broken = put(d, "b.json", whole[:len(whole) // 2])
    put(d, "c.json", json.dumps(game(3, 92.0)))
    with pytest.raises(Exception):
        feed.read_feed(spark, d).collect()
    good = feed.read_feed(spark, d, quarantine=bad)
    assert {r.gamePk for r in good.collect()} == {1, 3} and good.schema == feed.FEED_SCHEMA
    rows = spark.read.parquet(bad).collect()
    assert [(os.path.basename(r.file), r.file_size, r.document) for r in rows] == [("b.json", os.path.getsize(broken), whole[:len(whole) // 2])]


def test_stream_keeps_one_version_of_a_game_twice_in_a_file(spark, tmp_path):
    from moundlake.streaming import current_pitches, start_feed_ingest
    from moundlake.streaming.ingest import compact, quarantine_path
    land, table, ckpt = (str(tmp_path / n) for n in ("land", "table", "ckpt"))
    lines = [json.dumps(game(7, 90.0)), json.dumps(game(8, 80.0)), '{"gamePk": 9, "live', json.dumps(game(7, 91.0))]
    put(land, "a.json", "\n".join(lines))
    start_feed_ingest(spark, land, table, ckpt, multiline=False).awaitTermination()

    def speeds(keep="newest"):
        return sorted((r.game_id, r.start_speed) for r in current_pitches(spark, table, keep).collect())
    assert speeds() == [(7, 91.0), (8, 80.0)]
    assert [r.document for r in spark.read.parquet(quarantine_path(table)).collect()] == ['{"gamePk": 9, "live']
    put(land, "late.json", json.dumps(game(5, 70.0)))
    start_feed_ingest(spark, land, table, ckpt, multiline=False).awaitTermination()  # a restart: nothing is read twice
    assert speeds() == [(5, 70.0), (7, 91.0), (8, 80.0)]
    # a compaction that stopped before it removed the old batches leaves every row twice; still one is current
    rows = spark.read.parquet(table)
    spark.createDataFrame(rows.drop("_batch").collect(), rows.drop("_batch").schema).withColumn("_batch", F.lit(-1).cast("long")) \
        .write.mode("append").partitionBy("_batch").parquet(table)
    assert speeds() == [(5, 70.0), (7, 91.0), (8, 80.0)]
    compact(spark, table)
    assert speeds() == [(5, 70.0), (7, 91.0), (8, 80.0)] and spark.read.parquet(table).count() == 3


def test_stored_index_in_a_new_session(spark, tmp_path):
    import random
    rnd = random.Random(4)
    rows = [(i, float(rnd.randrange(40)), float(rnd.randrange(40)), rnd.randrange(3)) for i in range(600)]
    rows += [(1000, None, 1.0, 1), (1001, float("inf"), 1.0, 1), (1002, float("nan"), 1.0, 1)]
    src = str(tmp_path / "train")
    spark.createDataFrame(rows, "id long, x double, y double, tb int").write.parquet(src)
    train, path = spark.read.parquet(src), str(tmp_path / "index")
    args = dict(x="x", y="y", label="tb", train_id="id")
    expected.save_knn_index(expected.build_knn_index(train, k=5, **args), path)
    query = [(float(rnd.randrange(-5, 45)), float(rnd.randrange(-5, 45))) for _ in range(80)] + [(float("-inf"), 0.0), (None, 0.0)]
    other = spark.newSession()
    index = expected.load_knn_index(other, path)
    found = expected.search_knn(index, other.createDataFrame(query, "x double, y double"), x="x", y="y")
    assert src not in found._jdf.queryExecution().toString()
    want = expected.knn_votes(train, spark.createDataFrame(query, "x double, y double"), k=5, **args)
    as_set = lambda d: {tuple(r) for r in d.collect()}
    got = as_set(found)
    assert got == as_set(want) and len({r[:2] for r in got}) == len(set(query) - {(float("-inf"), 0.0), (None, 0.0)})
    nothing = expected.build_knn_index(train.limit(0), **args)
    expected.save_knn_index(nothing, path)
    assert expected.search_knn(expected.load_knn_index(spark, path), train, x="x", y="y").count() == 0


def test_selection_of_exact_size(spark):
    df = spark.range(10_007).withColumn("v", F.col("id") % 7)
    picks = [{r.id for r in first_by_hash(df.repartition(p), ["id"], share=0.2, prefix_bits=b).collect()} for p, b in ((1, 16), (7, 4), (3, 8))]
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 2002
    assert distribution.deterministic_sample(df, "id", 100).count() == 100
    assert first_by_hash(df, ["id"], n=0).count() == 0 and first_by_hash(df.limit(0), ["id"], n=5).count() == 0
    assert first_by_hash(df, ["id"], n=20_000).count() == 10_007
    flagged = first_by_hash(df, ["id"], share=1 / 3, flag="test")
    assert flagged.count() == 10_007 and flagged.where("test").count() == 3336


def test_mass_levels(spark):
    import random
    rnd = random.Random(2)
    rows = [(g, rnd.choice([0.0, 0.1, 0.2]) + rnd.random() * (g + 1)) for g in range(3) for _ in range(200)] + [(9, 0.0)]
    got = {(r.g, r.share): r.level for r in distribution.mass_levels(spark.createDataFrame(rows, "g int, density double"), ["g"], [0.1, 0.5, 0.9]).collect()}
    assert {g for g, _ in got} == {0, 1, 2}
    for g in range(3):
        cells = sorted((d for k, d in rows if k == g), reverse=True)
        for share in (0.1, 0.5, 0.9):
            total = 0.0
            for d in cells:
                total += d
                if total >= share * sum(cells) * (1 - 1e-9):
                    break
            assert abs(got[g, share] - d) < 1e-12
