"""Bucketed pitch table: features without an exchange of pitch rows, equal to the plain ones; densities within the kernel's reach."""

import datetime as dt
import math
import random
import statistics
import uuid

import pytest
from pyspark.sql import functions as F

from moundlake.operators import distribution, features
from moundlake.sources.sinks import write_bucketed
from tests.test_plans import _plan


@pytest.fixture()
def pitches(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, *range(12)]), rnd.choice([None, dt.date(2023, 5, 1), dt.date(2024, 5, 1)]), rnd.choice("LR"),
             rnd.choice(["FF", "SI", "CU", "SL", None]), rnd.choice([None, float(rnd.randrange(80, 100))]), float(rnd.randrange(-30, 0)),
             float(rnd.randrange(-9, 9)), 1.0) for i in range(600)]
    rows = [(*r[:4], "CU" if r[1] in (3, 4) else r[4], *r[5:]) for r in rows]  # pitchers without a fastball
    df = spark.createDataFrame(rows, "uid long, pitcher_id long, game_date date, pitcher_hand string, pitch_type string, start_speed double, "
                                     "az double, ax double, x0 double")
    name = f"p_{uuid.uuid4().hex[:10]}"
    assert write_bucketed(df, name, ["pitcher_id"], 4, str(tmp_path / name))
    yield df, spark.table(name)
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("keep", [False, True])
def test_same_rows_as_the_plain_features(pitches, keep):
    df, bucketed = pitches
    want = features.fastball_features(df, keep_without_baseline=keep)
    got = features.fastball_features_co_located(bucketed, keep_without_baseline=keep)
    assert set(got.columns) == set(want.columns)
    names = sorted(want.columns)
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))


def exchanges(df):
    """Shuffles in the executed plan's tree, final stages included."""
    return [line for line in _plan(df, "simple").splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


@pytest.mark.parametrize("keep", [False, True])
def test_no_pitch_row_is_exchanged(spark, pitches, keep):
    df, bucketed = pitches
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert exchanges(features.fastball_features_co_located(bucketed, keep_without_baseline=keep)) == []
        assert exchanges(features.fastball_features(df, keep_without_baseline=keep))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_key_is_saved_without_buckets(spark, tmp_path):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    name = f"h_{uuid.uuid4().hex[:10]}"
    assert not write_bucketed(df, name, ["k"], 64, str(tmp_path / name))
    assert spark.table(name).count() == 4000
    spark.sql(f"DROP TABLE {name}")


def test_kde_by_group_against_the_whole_sum(spark):
    rnd = random.Random(2)
    groups = {"a": [rnd.gauss(100, 9) for _ in range(80)], None: [rnd.gauss(5000, 3) for _ in range(40)] + [100.0], "flat": [100.0, 100.0], "one": [99.0]}
    rows = [(g, v) for g, vs in groups.items() for v in [*vs, None, float("nan"), float("inf")]]
    out = distribution.kde_1d(spark.createDataFrame(rows, "g string, v double"), "v", 60.0, 140.0, points=81, by=["g"]).collect()
    assert len(out) == 4 * 81
    for r in out:
        vs = groups[r.g]
        h = 0.8 * statistics.stdev(vs) if len(vs) > 1 else 0.0
        if not h:
            assert r.density is None
        else:
            want = sum(math.exp(-0.5 * ((r.x - v) / h) ** 2) for v in vs) / (len(vs) * h * math.sqrt(2 * math.pi))
            assert r.density == pytest.approx(want, rel=1e-9, abs=1e-14)


def test_scaled_columns_do_not_depend_on_the_data(spark):
    from moundlake.operators.stuff import robust_scale
    df = spark.createDataFrame([(1.0, None, 5.0), (2.0, None, 5.0), (4.0, None, 5.0)], "a double, b double, c double")
    got = robust_scale(df, ["a", "b", "c"])
    assert got.columns == ["a", "b", "c", "a_scaled", "b_scaled", "c_scaled"]
    assert [(r.b_scaled, r.c_scaled) for r in got.collect()] == [(None, None)] * 3
