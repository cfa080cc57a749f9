"""Plan checks for the scale claims: pruning, pushdown, broadcast, partial group limits."""

import contextlib
import io

SF = "/root/testdata/sf0.001"


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _q(spark, name):
    import __spark_entry__ as E
    return E.queries()[name](spark, SF)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(_q(spark, "arsenal_summary"))
    schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "l_partkey" in schema and "l_suppkey" in schema
    for unused in ("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey"):
        assert unused not in schema


def test_reference_season_filter_reaches_the_scan(spark):
    from moundlake.plans.driver import score_pitches
    plan = _plan(score_pitches(spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_run_values_are_broadcast(spark):
    plan = _plan(_q(spark, "run_value_target"), "simple")
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_first_row_per_key_limits_before_the_shuffle(spark):
    plan = _plan(_q(spark, "dedupe_latest"), "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_grouping_sets_single_aggregation(spark):
    from moundlake.operators.summary import pitcher_type_totals
    df = spark.createDataFrame([(1, 2024, "FF", 1, 100.0)], "pitcher_id long, year long, pitch_type string, "
                                                            "game_id long, stuff_plus double")
    plan = _plan(pitcher_type_totals(df, ["pitcher_id", "year"]), "simple")
    assert "Expand" in plan and "Union" not in plan
