"""Property tests (Hypothesis) on small generated inputs; few examples each, since
every example is a Spark job."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moundlake.operators import boards, stuff, summary

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(1, 4), st.sampled_from(["FF", "SL", "CH", "CU"]), st.integers(1, 3),
              st.floats(60, 140, allow_nan=False)),
    min_size=5, max_size=60)


@SETTINGS
@given(rows_strategy)
def test_shares_sum_to_one(spark, rows):
    df = spark.createDataFrame(rows, "pitcher_id long, pitch_type string, game_id long, v double") \
        .withColumn("is_pitch", F.lit(True))
    out = summary.arsenal_summary(df, ["pitcher_id", "pitch_type"], {"v": "v"}, digits=None, share_digits=None)
    for r in out.groupBy("pitcher_id").agg(F.sum("proportion").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


@SETTINGS
@given(rows_strategy)
def test_grades_within_scale(spark, rows):
    df = spark.createDataFrame(rows, "pitcher_id long, pitch_type string, game_id long, stuff_plus double") \
        .withColumn("year", F.lit(2024).cast("long"))
    g = stuff.pitch_grades(df, min_pitches=1)
    assert all(20 <= r.pitch_grade <= 80 for r in g.collect() if r.pitch_grade is not None)


@SETTINGS
@given(rows_strategy)
def test_union_distinct_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "pitcher_id long, pitch_type string, game_id long, v double")
    once = boards.union_distinct([df, df])
    twice = boards.union_distinct([once, once, df])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == df.distinct().count()
