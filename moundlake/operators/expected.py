"""Expected value from batted balls: exact distributed kNN (M1) and what follows
(M2 expected value, M3 event overrides, M4 split, M5 prediction, M6/M7 report
and confusion, M8 R^2, M9 line, A5/A6 per-group means).

kNN design (exact, no UDF, no Cartesian product): see ``knn_votes`` -- duplicate
locations pruned to k rows (exact), distinct queries scored once, and a
quadtree built from cell counts is searched with joins: each query starts at the level of
its own surroundings and refines only where the data is dense, so a hot location or a dense cluster never
produces all-pairs work. Every round cuts lineage with a reliable checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moundlake.schemas import HBP_EVENTS, STRIKEOUT_EVENTS, WALK_EVENTS, WOBA_WEIGHTS_A
from moundlake.session import cut_lineage


def split_flag(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42,
               method: str = "hash") -> DataFrame:
    """M4: deterministic train/test flag. ``hash``: 48 bits of MD5(seed|key) modulo 100 < train_pct
    (independent of partitioning, unlike randomSplit, and the same in every engine); ``modulo``:
    pmod(key, 5) != 0 (80/20)."""
    if method == "hash":
        text = F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")
        flag = F.pmod(F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long"), F.lit(100)) < train_pct
    elif method == "modulo":
        if train_pct != 80:
            raise ValueError("modulo split is fixed at 80/20")
        flag = F.pmod(F.col(key), F.lit(5)) != 0
    else:
        raise ValueError(method)
    return df.withColumn("is_train", flag)


def _id_col(tid: str | Sequence[str]):
    return F.col(tid) if isinstance(tid, str) else F.struct(*[F.col(c) for c in tid])


def _finite(*cols: str) -> Column:
    """Neither null nor NaN nor infinite."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(float("inf")))
    return out


def _prune_train(train: DataFrame, x: str, y: str, label: str, tid, k: int) -> DataFrame:
    w = Window.partitionBy("_x", "_y").orderBy(F.col("_id"))
    t = train.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"),
                     F.col(label).alias("_label"), _id_col(tid).alias("_id"))
    return t.filter(_finite("_x", "_y")).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def _cell(c: str, origin: float, side) -> Column:
    return F.floor((F.col(c) - origin) / side).cast("long")


@dataclass(frozen=True)
class KnnIndex:
    """A searchable training table: ``rows`` (_x, _y, _label, _id and their finest cell _fx, _fy; at most k per location), ``fine`` (rows
    per finest cell), ``cells`` (rows and leaf flag of every cell of every level), ``meta`` (label, label_type, k, max_level, n, x0, y0, size)."""
    rows: DataFrame
    fine: DataFrame
    cells: DataFrame
    meta: Mapping[str, object]


def build_knn_index(train: DataFrame, *, x: str, y: str, label: str, train_id: str | Sequence[str], k: int = 11,
                    leaf_size: int | None = None, max_level: int = 16) -> KnnIndex:
    """Steps 1 and 2 of :func:`knn_votes`: everything the search needs of the training rows. Rows with a missing or infinite
    coordinate are left out; an index without rows is valid."""
    cap = leaf_size or max(64, 4 * k)
    tr = cut_lineage(_prune_train(train, x, y, label, train_id, k))
    st = tr.agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("x0"), F.max("_x").alias("x1"),
                F.min("_y").alias("y0"), F.max("_y").alias("y1")).first()
    x0, y0 = st["x0"] or 0.0, st["y0"] or 0.0
    size = max((st["x1"] or 0.0) - x0, (st["y1"] or 0.0) - y0, 1e-12) * (1 + 1e-9) + 1e-12
    fine_side = size / 2 ** max_level
    tr = tr.withColumns({"_fx": _cell("_x", x0, fine_side), "_fy": _cell("_y", y0, fine_side)})
    fine = tr.groupBy("_fx", "_fy").agg(F.count(F.lit(1)).alias("_n"))
    cells = _levels(fine, max_level).groupBy("_l", "_cx", "_cy").agg(F.sum("_n").alias("_n"))
    cells = cut_lineage(cells.withColumn("_leaf", (F.col("_n") <= cap) | (F.col("_l") == max_level)))
    return KnnIndex(tr, fine, cells, {
        "label": label, "label_type": train.schema[label].dataType.simpleString(), "k": k, "max_level": max_level,
        "n": st["n"], "x0": float(x0), "y0": float(y0), "size": float(size)})


def _levels(fine: DataFrame, max_level: int) -> DataFrame:
    """Every finest cell with the cell of each level that holds it."""
    at_level = fine.select("_fx", "_fy", "_n", F.explode(F.sequence(F.lit(0), F.lit(max_level))).alias("_l"))
    return at_level.withColumns({"_cx": F.expr(f"shiftright(_fx, {max_level} - _l)"), "_cy": F.expr(f"shiftright(_fy, {max_level} - _l)")})


def save_knn_index(index: KnnIndex, path: str) -> None:
    """The fitted search as three tables and a row of parameters, the parameters last: a folder without them is no index.
    The training rows lie sorted by cell inside their files, so a search reads the row groups of the cells it needs."""
    index.rows.repartitionByRange("_fx", "_fy").sortWithinPartitions("_fx", "_fy").write.mode("overwrite").parquet(f"{path}/rows")
    index.fine.write.mode("overwrite").parquet(f"{path}/fine")
    index.cells.write.mode("overwrite").parquet(f"{path}/cells")
    spark = index.rows.sparkSession
    spark.createDataFrame([dict(index.meta)], "label string, label_type string, k int, max_level int, n long, x0 double, y0 double, size double"
                          ).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_knn_index(spark: SparkSession, path: str) -> KnnIndex:
    """An index saved by :func:`save_knn_index`, in any session; the training table is not read again."""
    meta = spark.read.parquet(f"{path}/meta").first().asDict()
    return KnnIndex(*[spark.read.parquet(f"{path}/{t}") for t in ("rows", "fine", "cells")], meta)


def knn_votes(train: DataFrame, query: DataFrame, *, x: str, y: str, label: str,
              train_id: str | Sequence[str], k: int = 11, leaf_size: int | None = None,
              max_level: int = 16, levels_per_round: int = 2) -> DataFrame:
    """M1: for every distinct query location (qx, qy) the vote share of each label among
    its k nearest training rows (Euclidean on the raw x, y; ties by train id).

    Exact and density-adaptive (a quadtree built from counts, searched with joins):

    1. Training rows are pruned to the k lowest ids per distinct location (exact).
    2. The finest cells are counted once; coarser cells are sums of finer ones. A cell is a leaf when it holds
       <= ``leaf_size`` rows or is at ``max_level``.
    3. Each distinct query starts at the finest level at which its cell and the eight around it hold k rows: the k-th
       distance is then at most 2 sqrt(2) cell sides, so the cells up to three away at that level hold every
       neighbour. (A query outside the training extent starts with the 16 cells of level 2.) Per round: an
       upper bound R on its k-th distance (smallest max-distance at which the cells seen so far hold k
       rows), cells with min-distance > R dropped, non-leaf cells replaced by their descendants. Most queries are done
       in the first round; sparse ones start coarse, dense neighbours are refined, so nobody pays for a cluster's size.
    4. The surviving cells join the training rows; top k by (distance, id).

    Returns (qx, qy, label, votes, share) with share = votes / k. Steps 1 and 2 are :func:`build_knn_index`, which can be saved;
    3 and 4 are :func:`search_knn`."""
    index = build_knn_index(train, x=x, y=y, label=label, train_id=train_id, k=k, leaf_size=leaf_size, max_level=max_level)
    return search_knn(index, query, x=x, y=y, levels_per_round=levels_per_round)


def search_knn(index: KnnIndex, query: DataFrame, *, x: str, y: str, levels_per_round: int = 2) -> DataFrame:
    """Steps 3 and 4 of :func:`knn_votes` against a built or loaded index. Queries with a missing or infinite coordinate have no votes."""
    spark = query.sparkSession
    label, k, max_level, x0, y0, size = (index.meta[c] for c in ("label", "k", "max_level", "x0", "y0", "size"))
    q = (query.select(F.col(x).cast("double").alias("qx"), F.col(y).cast("double").alias("qy"))
              .filter(_finite("qx", "qy")).distinct())
    q = cut_lineage(q)
    if not index.meta["n"] or q.isEmpty():
        return spark.createDataFrame([], f"qx double, qy double, `{label}` {index.meta['label_type']}, votes long, share double")
    tr, cells, at_level = index.rows, index.cells, _levels(index.fine, max_level)

    # 3a: the level at which each query starts
    def spread(df: DataFrame, r: int) -> DataFrame:
        """Each row with every cell offset (_i, _j) up to ``r``."""
        offsets = F.explode(F.sequence(F.lit(-r), F.lit(r)))
        return df.withColumn("_i", offsets).withColumn("_j", offsets)

    around = spread(cells.select("_l", "_cx", "_cy", "_n"), 1).groupBy(
        "_l", (F.col("_cx") + F.col("_i")).alias("_cx"), (F.col("_cy") + F.col("_j")).alias("_cy")).agg(F.sum("_n").alias("_n9"))
    enough = around.where(F.col("_n9") >= k).select("_l", "_cx", "_cy")
    side = F.lit(size) / F.pow(F.lit(2.0), F.col("_l"))
    places = q.select("qx", "qy", F.explode(F.sequence(F.lit(0), F.lit(max_level))).alias("_l")) \
        .withColumns({"_cx": _cell("qx", x0, side), "_cy": _cell("qy", y0, side)})
    own = places.join(enough, ["_l", "_cx", "_cy"]).groupBy("qx", "qy").agg(F.max("_l").alias("_l"))
    inside = F.col("qx").between(x0, x0 + size) & F.col("qy").between(y0, y0 + size)
    start = q.join(own, ["qx", "qy"], "left").withColumn(
        "_l", F.when(inside, F.coalesce("_l", F.lit(0))).otherwise(F.lit(min(2, max_level))))
    near = spread(start.select("qx", "qy", "_l"), 3).withColumns({
        # a query outside starts from the grid's edge: three cells away is all of level 2
        "_cx": F.greatest(F.lit(0), F.least(_cell("qx", x0, side), F.pow(F.lit(2.0), F.col("_l")).cast("long") - 1)) + F.col("_i"),
        "_cy": F.greatest(F.lit(0), F.least(_cell("qy", y0, side), F.pow(F.lit(2.0), F.col("_l")).cast("long") - 1)) + F.col("_j")})
    frontier = near.drop("_i", "_j").join(cells, ["_l", "_cx", "_cy"], "inner")

    # 3b: refine
    wq = Window.partitionBy("qx", "qy")
    eps = size * 1e-9
    f = None
    for i in range(max_level + 1):
        lo_x, lo_y = x0 + F.col("_cx") * side, y0 + F.col("_cy") * side
        # bounds widened by a hair (eps) so that floating-point cell edges can never
        # exclude a point that ties the k-th distance
        dxmin = F.greatest(lo_x - F.col("qx") - eps, F.col("qx") - (lo_x + side) - eps, F.lit(0.0))
        dymin = F.greatest(lo_y - F.col("qy") - eps, F.col("qy") - (lo_y + side) - eps, F.lit(0.0))
        dxmax = F.greatest(F.abs(F.col("qx") - lo_x), F.abs(F.col("qx") - (lo_x + side))) + eps
        dymax = F.greatest(F.abs(F.col("qy") - lo_y), F.abs(F.col("qy") - (lo_y + side))) + eps
        f = frontier.withColumns({"_dmin": dxmin * dxmin + dymin * dymin, "_dmax": dxmax * dxmax + dymax * dymax})
        cum = F.sum("_n").over(wq.orderBy("_dmax", "_l", "_cx", "_cy").rowsBetween(Window.unboundedPreceding, 0))
        f = f.withColumn("_cum", cum)
        f = f.withColumn("_r2", F.min(F.when(F.col("_cum") >= k, F.col("_dmax"))).over(wq))
        f = f.filter(F.col("_r2").isNull() | (F.col("_dmin") <= F.col("_r2")))
        f = cut_lineage(f.select("qx", "qy", "_l", "_cx", "_cy", "_n", "_leaf"))
        if f.filter(~F.col("_leaf")).isEmpty():
            break
        # descend ``levels_per_round`` levels before the next bound: fewer rounds (jobs),
        # at most 4^levels_per_round descendants per refined cell in between
        down = cells.select(F.col("_l"), F.col("_cx"), F.col("_cy"), "_n", "_leaf",
                            F.explode(F.sequence(F.lit(1), F.lit(levels_per_round))).alias("_d")) \
            .where("_l >= _d").select("_l", "_cx", "_cy", "_n", "_leaf", "_d", (F.col("_l") - F.col("_d")).alias("_pl"),
                                      F.expr("shiftright(_cx, _d)").alias("_pcx"), F.expr("shiftright(_cy, _d)").alias("_pcy"))
        open_cells = f.filter(~F.col("_leaf")).select(
            "qx", "qy", F.col("_l").alias("_pl"), F.col("_cx").alias("_pcx"), F.col("_cy").alias("_pcy"),
            F.least(F.lit(levels_per_round), F.lit(max_level) - F.col("_l")).alias("_d"))
        grow = open_cells.join(down, ["_pl", "_pcx", "_pcy", "_d"], "inner").select("qx", "qy", "_l", "_cx", "_cy", "_n", "_leaf")
        frontier = f.filter("_leaf").unionByName(grow)
    # 4: candidates from the surviving cells, exact top k. Distinct cells find their finest cells, those their rows
    wanted = f.select("_l", "_cx", "_cy").distinct()
    members = wanted.join(at_level.select("_l", "_cx", "_cy", "_fx", "_fy"), ["_l", "_cx", "_cy"]).join(tr, ["_fx", "_fy"])
    cand = f.select("qx", "qy", "_l", "_cx", "_cy").join(members.drop("_fx", "_fy"), ["_l", "_cx", "_cy"], "inner")
    cand = cand.withColumn("_d2", (F.col("qx") - F.col("_x")) ** 2 + (F.col("qy") - F.col("_y")) ** 2)
    top = (cand.withColumn("_rn", F.row_number().over(wq.orderBy("_d2", "_id")))
               .filter(F.col("_rn") <= k))
    votes = top.groupBy("qx", "qy", "_label").agg(F.count(F.lit(1)).alias("votes"))
    return votes.select("qx", "qy", F.col("_label").alias(label), "votes",
                        (F.col("votes") / F.lit(float(k))).alias("share"))


def expected_from_votes(votes: DataFrame, label: str, weights: Mapping[object, float]) -> DataFrame:
    """M2 + M5: per location, expected value = sum share x weight(class), joined by class
    value (T26, so an absent class cannot shift weights), and the predicted class
    (most votes, lowest class on a tie)."""
    spark = votes.sparkSession
    kind = votes.schema[label].dataType.simpleString()
    wt = spark.createDataFrame([(k_, float(v)) for k_, v in weights.items()], f"`{label}` {kind}, _w double")
    j = votes.join(F.broadcast(wt), label, "left")
    return j.groupBy("qx", "qy").agg(
        F.sum(F.col("share") * F.coalesce(F.col("_w"), F.lit(0.0))).alias("expected"),
        F.max_by(F.col(label), F.struct(F.col("votes"), -F.col(label))).alias("pred_class"))


def knn_expected(train: DataFrame, query: DataFrame, *, x: str, y: str, label: str,
                 train_id: str | Sequence[str],
                 k: int = 11, weights: Mapping[object, float] | None = None,
                 leaf_size: int | None = None) -> DataFrame:
    """M1 + M2 + M5 joined back onto every query row (columns ``expected``, ``pred_class``)."""
    index = build_knn_index(train, x=x, y=y, label=label, train_id=train_id, k=k, leaf_size=leaf_size)
    return apply_knn(index, query, x=x, y=y, weights=weights)


def apply_knn(index: KnnIndex, query: DataFrame, *, x: str, y: str, weights: Mapping[object, float] | None = None) -> DataFrame:
    """The expectation of a built or loaded index on every query row.

    The per-location table has one row per distinct launch pair; it is joined
    back with AQE choosing broadcast or a skew-split sort-merge."""
    weights = weights or {0: 0.0, 1: WOBA_WEIGHTS_A["single"], 2: WOBA_WEIGHTS_A["double"],
                          3: WOBA_WEIGHTS_A["triple"], 4: WOBA_WEIGHTS_A["home_run"]}
    ev = expected_from_votes(search_knn(index, query, x=x, y=y), index.meta["label"], weights)
    qq = query.withColumns({"qx": F.col(x).cast("double"), "qy": F.col(y).cast("double")})
    return qq.join(ev, ["qx", "qy"], "left").drop("qx", "qy")


def event_overrides(df: DataFrame, event: str, value: str = "woba_pred",
                    walk: float = WOBA_WEIGHTS_A["walk"], hbp: float = WOBA_WEIGHTS_A["hit_by_pitch"],
                    walk_events: Sequence[str] = WALK_EVENTS, hbp_events: Sequence[str] = HBP_EVENTS,
                    strikeout_events: Sequence[str] = STRIKEOUT_EVENTS) -> DataFrame:
    """M3: walks, hit-by-pitch and strikeouts get fixed values over the expectation;
    rows left null are dropped."""
    e = F.col(event)
    v = (F.when(e.isin(list(strikeout_events)), F.lit(0.0))
          .when(e.isin(list(hbp_events)), F.lit(hbp))
          .when(e.isin(list(walk_events)), F.lit(walk))
          .otherwise(F.col(value)))
    return df.withColumn(value, v).filter(F.col(value).isNotNull())


def per_group_means(df: DataFrame, by: Sequence[str], count_of: str, means: Mapping[str, str],
                    min_count: int | None = None, count_alias: str = "n") -> DataFrame:
    """Count and means per group, optional strict minimum (HAVING n > min, T17)."""
    g = df.groupBy(*by).agg(F.count(count_of).alias(count_alias),
                            *[F.avg(src).alias(name) for name, src in means.items()])
    return g if min_count is None else g.filter(F.col(count_alias) > min_count)


def attach_means(df: DataFrame, means: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group means joined back to every row of the group (left; null keys match each other)."""
    from moundlake.operators.sequence import join_groups
    return join_groups(df, means, list(keys), "left")


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: Sequence[int]) -> DataFrame:
    """M7: rows = true class, one count column per predicted class, zeros filled."""
    g = df.groupBy(label).pivot(pred, list(classes)).count().na.fill(0)
    return g.select(label, *[F.col(str(c)).cast("long").alias(f"pred_{c}") for c in classes])


def class_report(df: DataFrame, label: str, pred: str, classes: Sequence[int]) -> DataFrame:
    """M6: precision, recall, F1 and support per class, then accuracy, macro and
    weighted averages; a zero division gives 1.0 (as the reference's setting).

    Confusion counts come from ONE aggregation; everything after is arithmetic
    over at most |classes|^2 rows, broadcast-sized."""
    spark = df.sparkSession
    cls = spark.createDataFrame([(int(c),) for c in classes], "cls int")
    # at most |classes|^2 rows, written once
    pairs = cut_lineage(df.groupBy(F.col(label).alias("_true"), F.col(pred).alias("_pred")).agg(F.count(F.lit(1)).alias("_n")))
    tp = pairs.groupBy(F.col("_true").alias("cls")).agg(
        F.sum("_n").alias("support"), F.sum(F.when(F.col("_true") == F.col("_pred"), F.col("_n")).otherwise(0)).alias("tp"))
    pp = pairs.groupBy(F.col("_pred").alias("cls")).agg(F.sum("_n").alias("predicted"))
    base = (F.broadcast(cls).join(tp, "cls", "left").join(pp, "cls", "left")
              .na.fill(0, ["support", "tp", "predicted"]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(1.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(1.0)
    per = base.select(F.col("cls").cast("string").alias("row"), prec.alias("precision"), rec.alias("recall"),
                      "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") /
                                      (F.col("precision") + F.col("recall"))).otherwise(0.0))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp_all"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("row"), (F.col("tp_all") / F.col("n")).alias("precision"),
                     (F.col("tp_all") / F.col("n")).alias("recall"), (F.col("tp_all") / F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    mac = tot.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                     F.col("mf").alias("f1"), F.col("n").alias("support"))
    wei = tot.select(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                     F.col("wf").alias("f1"), F.col("n").alias("support"))
    return (per.select("row", "precision", "recall", "f1", "support")
               .unionByName(acc).unionByName(mac).unionByName(wei))


def r2_and_line(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """M8 + M9: R^2 = 1 - SSE/SST with ``truth`` as the reference passes it (T18), and the
    least-squares line of ``pred`` on ``truth``. One global aggregate, one row."""
    # sum of squares about the mean = population variance x n, so the frame is read once
    sst = F.var_pop(truth) * F.count(truth)
    return df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull()).agg(
        (F.lit(1.0) - F.try_divide(F.sum((F.col(truth) - F.col(pred)) ** 2), sst)).alias("r2"),
        F.regr_slope(F.col(pred), F.col(truth)).alias("slope"),
        F.regr_intercept(F.col(pred), F.col(truth)).alias("intercept"),
        F.count(F.lit(1)).alias("n"))
