"""Unit tests on hand-written rows, one per trap / property."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from moundlake.functions import columns as C
from moundlake.functions.mathx import normal_cdf
from moundlake.operators import joins, boards, distribution, expected, features, stuff, summary, targets


def test_shares_sum_to_one_and_partition_invariance(spark):
    rows = [(p, t, float(s)) for p in (1, 2) for t in ("FF", "SL", "CH") for s in range(p * 3 + len(t))]
    df = spark.createDataFrame(rows, "pitcher_id long, pitch_type string, start_speed double") \
        .withColumn("is_pitch", F.lit(True))
    out = summary.arsenal_summary(df, ["pitcher_id", "pitch_type"], {"start_speed": "start_speed"}, digits=None,
                                  share_digits=None)
    sums = {r[0]: r[1] for r in out.groupBy("pitcher_id").agg(F.sum("proportion")).collect()}
    assert all(abs(v - 1) < 1e-12 for v in sums.values())
    again = summary.arsenal_summary(df.repartition(7), ["pitcher_id", "pitch_type"], {"start_speed": "start_speed"},
                                    digits=None, share_digits=None)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_statcast_flags_null_zone_is_chase(spark):
    df = spark.createDataFrame([("foul", None), ("ball", None), ("swinging_strike", 10), ("foul", 5), ("foul", 12)],
                               "description string, zone int")
    r = [tuple(x) for x in C.statcast_flags(df).select("swing", "in_zone", "out_zone", "chase").collect()]
    assert r == [(True, False, False, True), (False, False, False, False), (True, False, False, True),
                 (True, True, False, False), (True, False, True, True)]


def _pitches(spark, rows):
    return spark.createDataFrame(rows, "pitcher_id long, game_date string, pitcher_hand string, pitch_type string, "
                                       "start_speed double, az double, ax double, x0 double")


def test_fastball_baseline_inner_default_and_fallback(spark):
    rows = [(1, "2024-04-01", "R", "FF", 95.0, -15.0, 5.0, 2.0), (1, "2024-04-01", "R", "SI", 94.0, -20.0, 12.0, 2.0),
            (1, "2024-04-01", "R", "SL", 85.0, -35.0, -3.0, 2.0),
            (2, "2024-04-02", "L", "SL", 84.0, -33.0, 4.0, 1.5), (2, "2024-04-02", "L", "CU", 78.0, -45.0, 6.0, 1.5)]
    df = _pitches(spark, rows)
    inner = features.fastball_features(df)
    assert {r.pitcher_id for r in inner.collect()} == {1}  # T1: no fastball -> gone
    # FF/SI tie on count (1 each): the faster type wins
    assert {r.avg_fastball_speed for r in inner.collect()} == {95.0}
    kept = features.fastball_features(df, keep_without_baseline=True)
    p2 = [r for r in kept.collect() if r.pitcher_id == 2]
    assert len(p2) == 2 and all(r.avg_fastball_speed == 84.0 for r in p2)
    # ax mirrored for L (-ax), fallback max is by pitcher (T2): max(-4, -6) = -4
    assert all(r.avg_fastball_ax == -4.0 for r in p2)


def test_run_value_target_lookup_then_description(spark):
    rv = spark.createDataFrame([("single", 0, 0, 0.5), ("ball", 0, 0, 0.03), ("called_strike", 1, 0, -0.04),
                                ("strikeout", 0, 2, -0.3)], "event string, balls int, strikes int, delta_run_exp double")
    p = spark.createDataFrame([(1, "single", "In play, no out", 0, 0), (2, None, "Ball", 0, 0),
                               (3, None, "Called Strike", 1, 0), (4, "field_out", "In play, out(s)", 0, 0),
                               (5, "strikeout", "Swinging Strike", 0, 2)],
                              "id int, event_type string, play_description string, balls int, strikes int")
    out = {r.id: r.target for r in targets.run_value_target(p, rv).collect()}
    assert out == {1: 0.5, 2: 0.03, 3: -0.04, 4: None, 5: -0.3}
    hand = targets.expand_run_values_by_hand(rv, {"strikeout": (1.5, 2.0)})
    ph = p.withColumns({"pitcher_hand": F.lit("R"), "batter_hand": F.when(F.col("id") == 5, "L").otherwise("R")})
    out2 = {r.id: r.target for r in targets.run_value_target(ph, hand, hand_keys=["pitcher_hand", "batter_hand"]).collect()}
    assert out2[5] == pytest.approx(-0.6) and out2[1] == 0.5


def test_whiff_target_no_fan_out(spark):
    p = spark.createDataFrame([("Swinging Strike", 0, 0, True, True), ("Swinging Strike", 0, 0, True, None),
                               ("Ball", 0, 0, None, None)],
                              "play_description string, balls int, strikes int, is_swing boolean, is_whiff boolean")
    out = targets.whiff_target(p)
    assert out.count() == 3
    assert sorted(r.target for r in out.collect()) == [0, 0, 1]


def test_plus_scale_reference_mean_and_std(spark):
    rnd = random.Random(3)
    rows = [(y, rnd.gauss(0, 0.05)) for y in (2023, 2024) for _ in range(400)]
    df = spark.createDataFrame(rows, "year long, target double")
    s = stuff.plus_scale(df, "target", reference=F.col("year") == 2023)
    m, sd = s.filter("year = 2023").agg(F.avg("stuff_plus"), F.stddev_samp("stuff_plus")).first()
    assert m == pytest.approx(100.0) and sd == pytest.approx(10.0)


def test_pitch_grades_in_range(spark):
    rnd = random.Random(5)
    rows = [(p, 2024, t, g, rnd.gauss(100, 10)) for p in range(30) for t in ("FF", "SL") for g in range(3)
            for _ in range(6)]
    df = spark.createDataFrame(rows, "pitcher_id long, year long, pitch_type string, game_id long, stuff_plus double")
    g = stuff.pitch_grades(df)
    vals = [r.pitch_grade for r in g.collect() if r.pitch_grade is not None]
    assert vals and all(20 <= v <= 80 for v in vals)
    assert {r.pitch_type for r in g.collect()} == {"FF", "SL", "All"}


def _brute_knn(train, query, k):
    out = {}
    for qx, qy in {(q[0], q[1]) for q in query}:
        d = sorted(((qx - t[0]) ** 2 + (qy - t[1]) ** 2, t[3], t[2]) for t in train)[:k]
        votes = {}
        for _, _, lab in d:
            votes[lab] = votes.get(lab, 0) + 1
        out[(qx, qy)] = votes
    return out


@pytest.mark.parametrize("seed,leaf,levels,step", [(1, 16, 16, 2), (2, 16, 16, 3), (3, None, 8, 2), (4, 12, 16, 1)])
def test_knn_exact_against_brute_force(spark, seed, leaf, levels, step):
    rnd = random.Random(seed)
    train = []
    i = 0
    for _ in range(300):  # integer grid -> many exact ties
        train.append((float(rnd.randint(0, 30)), float(rnd.randint(60, 110)), rnd.randint(0, 4), i)); i += 1
    for _ in range(150):  # a hot location: many rows at one point
        train.append((10.0, 90.0, rnd.randint(0, 4), i)); i += 1
    for _ in range(200):  # a dense cluster of distinct points
        train.append((20.0 + rnd.random() * 0.01, 70.0 + rnd.random() * 0.01, rnd.randint(0, 4), i)); i += 1
    train.append((500.0, 500.0, 3, i))  # sparse far corner
    query = [(float(rnd.randint(-5, 35)), float(rnd.randint(55, 115))) for _ in range(120)]
    query += [(10.0, 90.0), (480.0, 470.0), (-200.0, 60.0), (20.005, 70.005), (20.2, 70.2), (500.0, 500.0), (0.0, 60.0),
              (9000.0, 9000.0), (500.0, 60.0)]
    tdf = spark.createDataFrame(train, "x double, y double, label int, id long")
    qdf = spark.createDataFrame(query, "x double, y double")
    k = 11
    got = {}
    for r in expected.knn_votes(tdf, qdf, x="x", y="y", label="label", train_id="id", k=k,
                                         leaf_size=leaf, max_level=levels, levels_per_round=step).collect():
        got.setdefault((r.qx, r.qy), {})[r.label] = r.votes
    want = _brute_knn(train, query, k)
    assert got == want
    assert all(sum(v.values()) == k for v in got.values())


def test_expected_value_and_prediction_tie_lowest_class(spark):
    votes = spark.createDataFrame([(0.0, 0.0, 1, 5), (0.0, 0.0, 2, 5), (0.0, 0.0, 0, 1)],
                                  "qx double, qy double, tb int, votes long") \
        .withColumn("share", F.col("votes") / 11.0)
    r = expected.expected_from_votes(votes, "tb", {0: 0.0, 1: 0.9, 2: 1.2, 3: 1.5, 4: 2.0}).first()
    assert r.pred_class == 1
    assert r.expected == pytest.approx((5 * 0.9 + 5 * 1.2) / 11)


def test_event_overrides_and_dropna(spark):
    df = spark.createDataFrame([("walk", None), ("strikeout", 0.4), ("field_out", None), ("single", 0.7)],
                               "event_type string, woba_pred double")
    out = {r.event_type: r.woba_pred for r in expected.event_overrides(df, "event_type").collect()}
    assert out == {"walk": 0.696, "strikeout": 0.0, "single": 0.7}


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    rep = {r.row: r for r in expected.class_report(df, "y", "p", [0, 1, 2]).collect()}
    assert rep["2"].precision == 1.0 and rep["2"].recall == 1.0
    assert rep["1"].precision == 1.0 and rep["1"].recall == 0.0
    assert rep["accuracy"].precision == pytest.approx(2 / 3)


def test_rolling_mean_null_until_full(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(60)], "batter long, n long, v double")
    out = summary.rolling_mean(df, ["batter"], ["n"], {"r": "v"}, window=50).orderBy("n").collect()
    assert all(r.r is None for r in out[:49])
    assert out[49].r == pytest.approx(np.mean(range(50)))
    assert out[59].r == pytest.approx(np.mean(range(10, 60)))
    assert [r.seq for r in out] == list(range(1, 61))


def test_location_ellipse_closed_form(spark):
    rnd = np.random.default_rng(0)
    pts = rnd.multivariate_normal([0, 2.5], [[0.3, 0.12], [0.12, 0.2]], size=200)
    rows = [("FF", float(a), float(b)) for a, b in pts] + [("CU", 0.1, 2.0)]
    df = spark.createDataFrame(rows, "pitch_type string, px double, pz double")
    out = {r.pitch_type: r for r in summary.location_ellipse(df, ["pitch_type"]).collect()}
    assert out["CU"].width is None  # 1-row group (T21)
    cov = np.cov(pts.T)
    lam, vec = np.linalg.eigh(cov)
    assert out["FF"].width == pytest.approx(2 * math.sqrt(lam[0]))
    assert out["FF"].height == pytest.approx(2 * math.sqrt(lam[1]))
    ang = math.degrees(math.atan2(vec[1, 0], vec[0, 0])) % 180
    assert out["FF"].angle == pytest.approx(ang)
    assert out["FF"].share + out["CU"].share == pytest.approx(1.0)


def test_normal_cdf_accuracy(spark):
    zs = [-3.0, -1.2, -0.1, 0.0, 0.4, 1.96, 3.5]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r[0] for r in df.select(normal_cdf(F.col("z"))).collect()]
    for z, g in zip(zs, got):
        assert g == pytest.approx(0.5 * (1 + math.erf(z / math.sqrt(2))), abs=2e-7)


def test_kde_1d_integrates_to_one(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(rnd.gauss(100, 8),) for _ in range(300)], "v double")
    out = distribution.kde_1d(df, "v", 40.0, 160.0, points=601).orderBy("x").collect()
    step = 120.0 / 600
    assert sum(r.density for r in out) * step == pytest.approx(1.0, abs=1e-3)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(60.0,), (61.99,), (62.0,), (140.0,), (59.9,), (140.1,)], "v double")
    got = {r.bin: r.n for r in distribution.histogram(df, "v").collect()}
    assert got == {0: 2, 1: 1, 39: 1}


def test_best_per_type_tie_lowest_id(spark):
    df = spark.createDataFrame([("FF", 80.0, 7, 200), ("FF", 80.0, 3, 200), ("SL", 70.0, 1, 100)],
                               "pitch_type string, pitch_grade double, pitcher_id long, pitches long")
    out = [tuple(r) for r in boards.best_per_type(df, "pitch_type", "pitch_grade", "pitcher_id", "pitches").collect()]
    assert out == [("FF", 80.0, 3, 200)]


def test_zone_values_empty_zone_zero(spark):
    df = spark.createDataFrame([(1, "R", 0.5), (1, "L", -0.25), (14, "R", 1.0)], "zone int, p_throws string, delta_run_exp double")
    out = {(r.zone, r.p_throws): r.run_value for r in summary.zone_values(df).collect()}
    assert out[(1, "All")] == 0.25 and out[(2, "R")] == 0.0 and (10, "R") not in out
    assert len(out) == 13 * 3


def test_grouping_sets_all_row(spark):
    df = spark.createDataFrame([(1, 2024, "FF", 10, 100.0), (1, 2024, "SL", 11, 90.0), (1, 2024, "SL", 10, 110.0)],
                               "pitcher_id long, year long, pitch_type string, game_id long, stuff_plus double")
    out = {r.pitch_type: r for r in summary.pitcher_type_totals(df, ["pitcher_id", "year"]).collect()}
    assert out["All"].pitches == 3 and out["All"].games == 2 and out["SL"].stuff_plus == 100.0


def _gappy(spark):
    """A hot group, null and single-row groups, ties, a hot value, nulls and NaN."""
    rnd = random.Random(11)
    rows = []
    for i in range(1500):
        g = 0 if rnd.random() < 0.4 else None if rnd.random() < 0.1 else rnd.randint(1, 20)
        u = rnd.random()
        v = None if u < 0.05 else float("nan") if u < 0.1 else 3.0 if u < 0.45 else float(rnd.randint(0, 9)) + (u > 0.8) * rnd.random()
        rows.append((g, i, v, rnd.random() < 0.5))
    rows.append((99, 5000, 1.0, True))
    return spark.createDataFrame(rows, "g long, t long, v double, flip boolean"), rows


def test_trailing_means_over_chunks_and_partitions(spark, monkeypatch):
    from moundlake.operators import sequence
    monkeypatch.setattr(sequence, "CHUNK_ROWS", 7)
    df, rows = _gappy(spark)
    for window in (5, 7, 12):
        got = {(r.g, r.t): (r.seq, r.r) for r in sequence.trailing_means(df, ["g"], ["t"], {"r": "v"}, window).collect()}
        assert len(got) == len(rows)
        by = {}
        for g, t, v, _ in rows:
            by.setdefault(g, []).append((t, v))
        for g, part in by.items():
            vs = [v for _, v in sorted(part)]
            for k, (t, _) in enumerate(sorted(part)):
                last = vs[max(0, k - window + 1):k + 1]
                full = len(last) == window and all(x is not None and x == x for x in last)
                seq, r = got[g, t]
                assert seq == k + 1 and (r == pytest.approx(sum(last) / window) if full else r is None)


def test_rolling_mean_newest_first(spark):
    df = spark.createDataFrame([("a", t, float(t)) for t in range(6)] + [("b", 1, 5.0)], "g string, t int, v double")
    got = [(r.g, r.seq, r.m) for r in summary.rolling_mean(df, ["g"], ["t"], {"m": "v"}, window=3, newest_first=True).collect()]
    assert got == [("a", 6, 4.0), ("a", 5, 3.0), ("a", 4, 2.0), ("a", 3, 1.0), ("a", 2, None), ("a", 1, None), ("b", 1, None)]


def test_grades_only_for_listed_types(spark):
    rows = [(p, 2024, t, g, 100.0 + p) for p in range(3) for t in ("FF", "EP") for g in range(12)]
    df = spark.createDataFrame(rows, "pitcher_id int, year int, pitch_type string, game_id int, stuff_plus double")
    assert {r.pitch_type for r in stuff.pitch_grades(df).collect()} == {"FF", "All"}
    assert {r.pitch_type for r in stuff.pitch_grades(df, types=None).collect()} == {"FF", "EP", "All"}


def test_robust_scale(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(9)], "a double, b double")
    got = [(r.a_scaled, r.b_scaled) for r in stuff.robust_scale(df, ["a", "b"]).orderBy("a").collect()]
    assert got == [((i - 4.0) / 4.0, None) for i in range(9)]


def test_percent_ranks_null_keys_nan_and_flips(spark):
    from moundlake.operators.sequence import percent_ranks
    df, rows = _gappy(spark)
    got = {(r.g, r.t): r.percent_rank for r in percent_ranks(df, ["g"], "v", "flip").collect()}
    for g, t, v, flip in rows:
        if v is None or v != v:
            assert got[g, t] is None
            continue
        vs = [x for h, _, x, _ in rows if h == g and x is not None and x == x]
        before = sum(x > v if flip else x < v for x in vs)
        assert got[g, t] == pytest.approx(before / (len(vs) - 1) if len(vs) > 1 else 0.0)


def test_exact_quantiles_match_percentile(spark):
    from moundlake.operators.sequence import exact_quantiles
    df, _ = _gappy(spark)
    lv = [0.0, 0.001, 0.025, 0.5, 0.975, 0.999, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(lv))] for r in exact_quantiles(df, ["g"], "v", lv).collect()}
    present = df.where("v is not null and not isnan(v)")
    ref = {r.g: r.p for r in present.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(x) for x in lv])).alias("p")).collect()}
    assert got.keys() == ref.keys() and None in got
    for g in ref:
        assert got[g] == pytest.approx(ref[g])


def test_best_per_type_leaves_out_totals(spark):
    df = spark.createDataFrame([("All", 1, 900, 80.0), ("FF", 1, 200, 60.0), ("FF", 2, 200, 70.0), ("FF", 3, 149, 80.0),
                                ("EP", 1, 500, 79.0), ("SL", 5, 150, 55.0), ("SL", 4, 150, 55.0)],
                               "pitch_type string, pitcher_id long, pitches long, grade double")
    got = [(r.pitch_type, r.pitcher_id) for r in boards.best_per_type(df, "pitch_type", "grade", "pitcher_id", "pitches").collect()]
    assert got == [("FF", 2), ("SL", 4)]


def test_pitch_sums_ignore_false_rows(spark):
    df = spark.createDataFrame([("FF", True, True, True, True, 5, "Foul"), ("FF", False, False, False, False, 5, "Ball"),
                                ("FF", None, False, False, False, 12, "Ball"), ("SL", False, False, False, False, 12, "Ball")],
                               "pitch_type string, is_pitch boolean, swing boolean, whiff boolean, is_strike boolean, zone int, play_description string")
    r = {x.pitch_type: x for x in summary.arsenal_rates(df, ["pitch_type"]).collect()}
    assert (r["FF"].pitches, r["FF"].in_zone, r["FF"].pitch_pct, r["SL"].pitches, r["SL"].zone_pct) == (1, 1, 1.0, 0, None)
    line = {x.pitch_type: x for x in summary.game_line(df, ["pitch_type"]).collect()}
    assert line["FF"].strike_pct == 100.0 and line["SL"].strike_pct == 0.0


def test_joined_and_attached_means(spark):
    from moundlake.operators import expected
    left = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k long, t string")
    means = spark.createDataFrame([(1, None, 5.0), (2, "a", 7.0)], "k long, t string, m double")
    got = sorted(((r.k, r.t or "", r.m) for r in expected.attach_means(left, means, ["k", "t"]).collect()), key=str)
    assert got == [(1, "", 5.0), (1, "a", None), (2, "a", 7.0)]
    a = spark.createDataFrame([(1, 0.3)], "id long, woba double")
    assert joins.join_suffixed(a, a, ["id"], suffix="_MLB").columns == ["id", "woba", "woba_MLB"]


def test_pitching_line_joins_game_log_and_rates(spark):
    log = spark.createDataFrame([(7, 100, "2024-05-01", "X", "6.0", 24, 1, 4, 8, 2, 0)],
                                "player_id long, game_id long, date string, opponent string, innings_pitched string, "
                                "batters_faced long, earned_runs long, hits long, strikeouts long, walks long, home_runs long")
    p = spark.createDataFrame([(7, 100, True, True, "Swinging Strike"), (7, 100, True, False, "Foul"),
                               (7, 100, False, False, "Ball"), (7, 100, False, False, "Called Strike")],
                              "pitcher_id long, game_id long, swing boolean, whiff boolean, play_description string") \
        .withColumn("is_pitch", F.lit(True))
    r = boards.pitching_line(log, p).first()
    assert (r.IP, r.K, r.pitches) == ("6.0", 8, 4)
    assert r.whiff_pct == pytest.approx(50.0) and r.strike_pct == pytest.approx(75.0)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(" ff ", "xMLBAMID_123_2021_2022", "2024-02-30", "L", 3.0, "Foul Tip"),
                                ("sl", "456", "2024-02-28", None, -2.0, "Unknown")],
                               "t string, pid string, d string, hand string, ax double, des string")
    r = df.select(C.upper_trim("t").alias("t"), C.strip_id("pid").alias("pid"), C.is_iso_date("d").alias("ok"),
                  C.mirror_by_hand("ax", "hand").alias("ax"), C.describe_outcome("des").alias("o"),
                  C.case_map("des", {"Foul Tip": 1}, 0).alias("c"),
                  C.format_metric(F.lit(0.2567), ".1f%").alias("f"), C.clip(F.lit(95.0)).alias("cl")).collect()
    assert [tuple(x) for x in r] == [("FF", "123", False, -3.0, "swinging_strike", 1, "0.3%", 80.0),
                                     ("SL", "456", True, -2.0, None, 0, "0.3%", 80.0)]
    assert C.strip_column_names(spark.createDataFrame([(1,)], "` a ` int")).columns == ["a"]
    sc = C.percent_scale(spark.createDataFrame([(0.25, 0.5)], "`K%` double, avg double")).first()
    assert (sc["K%"], sc["avg"]) == (25.0, 0.5)


def test_hash_split_and_sample_are_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = expected.split_flag(df, "k")
    b = expected.split_flag(df.repartition(13), "k")
    fa = {r.k: r.is_train for r in a.collect()}
    assert fa == {r.k: r.is_train for r in b.collect()}
    assert 0.77 < sum(fa.values()) / len(fa) < 0.83
    s1 = sorted(r.k for r in distribution.deterministic_sample(df, "k", 100).collect())
    s2 = sorted(r.k for r in distribution.deterministic_sample(df.repartition(7), "k", 100).collect())
    assert s1 == s2 and len(s1) == 100


def test_card_flows_on_role_views(spark):
    from moundlake.plans import roles
    from moundlake.plans.flows import hitter_card, pitcher_card
    p = roles.pitches(spark, "/root/testdata/sf0.001")
    card = pitcher_card(p, 3, "1995-01-01", "2001-12-31")
    assert card["arsenal"].count() == 8 and card["locations"].count() > 0 and card["game_line"].count() > 0
    sc = p.select(F.col("description"), F.col("zone"), F.col("ax").alias("pfx_x"), F.col("az").alias("pfx_z"),
                  F.col("px").alias("plate_x"), F.col("pz").alias("plate_z"),
                  F.lit(0.3).alias("woba_value"), F.lit(0.31).alias("estimated_woba_using_speedangle"),
                  F.col("delta_run_exp"), F.col("pitcher_hand").alias("p_throws"), F.col("event_type").alias("events"),
                  F.lit(7).cast("long").alias("batter"), F.col("game_date"), F.col("ab_number").alias("at_bat_number"),
                  F.col("tb_p").cast("int").alias("pitch_number"))
    h = hitter_card(sc, 7, "1995-01-01", "2001-12-31")
    assert h["zone_values"].count() == 39
    r = h["rolling"].orderBy("seq").collect()
    assert r[48].rolling_woba is None and r[49].rolling_woba == pytest.approx(0.3)


def test_kde_2d_binned_equals_exact_on_bin_centres(spark):
    rnd = random.Random(8)
    rows = [((rnd.randint(-8, 8) + 0.5) * 0.25, (rnd.randint(4, 16) + 0.5) * 0.25) for _ in range(300)]
    df = spark.createDataFrame(rows, "px double, pz double")
    exact = {(r.gx_i, r.gy_i): r.density for r in distribution.kde_2d(df, "px", "pz", (-2, 2), (1, 4), points=9).collect()}
    binned = {(r.gx_i, r.gy_i): r.density
              for r in distribution.kde_2d(df, "px", "pz", (-2, 2), (1, 4), points=9, bin_size=0.25).collect()}
    assert exact.keys() == binned.keys()
    assert all(binned[k] == pytest.approx(exact[k]) for k in exact)


def test_outer_merge_suffixes_and_parent_lookup(spark):
    from moundlake.operators import joins
    a = spark.createDataFrame([(1, 0.5), (2, 0.7)], "xMLBAMID long, OAA double")
    b = spark.createDataFrame([(2, 3.0, 10), (3, 1.0, 4)], "xMLBAMID long, CFR double, n long")
    c = spark.createDataFrame([(3, 0.9, 7)], "xMLBAMID long, wRC double, n long")
    m = {r.xMLBAMID: r for r in joins.outer_merge([a, b, c], ["xMLBAMID"], ["_oaa", "_cfr", "_bat"]).collect()}
    assert set(m) == {1, 2, 3}
    assert m[2].OAA == 0.7 and m[2].n_cfr == 10 and m[3].n_bat == 7 and m[1].CFR is None
    t = spark.createDataFrame([(1, None, "BIG"), (2, 1, "FRM"), (3, 9, "ORP")],
                              "team_id long, parent_org_id long, abbreviation string")
    p = {r.team_id: r.parent_abbreviation for r in joins.parent_lookup(t, "team_id", "parent_org_id",
                                                                       "abbreviation", "parent_abbreviation").collect()}
    assert p == {1: "BIG", 2: "BIG", 3: None}  # null parent -> itself; unknown parent -> null
    nxt = joins.next_season(spark.createDataFrame([(1, 2023, 3.0), (1, 2024, 4.0), (2, 2024, 5.0)],
                                                  "id long, season long, era double"), "id", "season", ["era"])
    assert [(r.id, r.season, r.era, r.era_next) for r in nxt.collect()] == [(1, 2023, 3.0, 4.0)]


def test_league_position_range_flip_and_fallback(spark):
    long = spark.createDataFrame([("FF", "velo", 96.0), ("FF", "k_pct", 0.30), ("SL", "xwoba", 0.30)],
                                 "pitch_type string, metric string, value double")
    ranges = spark.createDataFrame([("FF", "velo", 94.0, 90.0, 98.0, False), ("FF", "k_pct", 0.25, 0.15, 0.35, True),
                                    ("SL", "xwoba", 0.30, None, None, False)],
                                   "pitch_type string, metric string, avg double, lo double, hi double, flip boolean")
    out = {(r.pitch_type, r.metric): r.position for r in
           boards.league_position(long, ranges, ["pitch_type", "metric"]).collect()}
    assert out[("FF", "velo")] == pytest.approx(0.75)
    assert out[("FF", "k_pct")] == pytest.approx(0.25)       # flipped: lower is better
    assert out[("SL", "xwoba")] == pytest.approx(0.5)        # fallback 0.8-1.2 x average


def test_park_factor_formula(spark):
    rows = [("NYY", True, 110.0), ("NYY", True, 100.0), ("NYY", False, 95.0), ("BOS", True, 100.0), ("BOS", False, 100.0)]
    df = spark.createDataFrame(rows, "pitcher_team string, pitcher_home boolean, stuff_plus double")
    out = {r.pitcher_team: r for r in distribution.park_factor(df).collect()}
    phi = lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2)))
    assert out["NYY"].home_mean == 105.0 and out["NYY"].road_mean == 95.0
    assert out["NYY"].park_factor == pytest.approx(abs(phi(0.5) / phi(-0.5)) * 100, rel=1e-6)
    assert out["BOS"].park_factor == pytest.approx(100.0, rel=1e-9)


def test_r2_line_and_confusion(spark):
    rnd = np.random.default_rng(3)
    t = rnd.normal(0.32, 0.03, 60)
    p = 0.9 * t + 0.03 + rnd.normal(0, 0.01, 60)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(t, p)], "xwoba double, woba double")
    r = expected.r2_and_line(df, "xwoba", "woba").first()
    sse, sst = ((t - p) ** 2).sum(), ((t - t.mean()) ** 2).sum()
    slope, intercept = np.polyfit(t, p, 1)
    assert r.r2 == pytest.approx(1 - sse / sst) and r.slope == pytest.approx(slope) and r.intercept == pytest.approx(intercept)
    cm = expected.confusion_matrix(spark.createDataFrame([(0, 0), (0, 1), (4, 0)], "y int, p int"), "y", "p", [0, 1, 2, 3, 4])
    rows = {r.y: tuple(r)[1:] for r in cm.collect()}
    assert rows == {0: (1, 1, 0, 0, 0), 4: (1, 0, 0, 0, 0)}
