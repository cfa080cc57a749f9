"""Toxicity as ordered severity: cumulative-link (proportional-odds) regression on sparse text features.

The label table knows toxic or not. The severity grade of a labelled text is 0 when it is not toxic, else 1, 2
or 3 by the third of the labelled toxic texts its share of marker terms falls in (markers: the selected
terms that are over-represented in toxic texts). The model

    P(grade <= k | x) = sigmoid(theta_k - w.x),  theta_1 < theta_2 < theta_3

shares one weight vector over all thresholds. Features are words and word beginnings (4 and 5
characters) with value log(1 + 1000 * count / words). A text's score is its expected severity,
sum_k P(grade > k); texts at or above ``REJECT_AT`` are rejected.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest by hash of the id)
and ``FEATURES`` terms, chosen by a distributed count over that sample. Every row is scored over its whole text.

Defined results: a null or empty text gets the score of a text without features;
rows are scored one by one, so ties and repeated rows get equal scores; an id labelled twice counts as toxic
when one label says so, null labels are left out; without any toxic or any clean label there is no
model and every severity is 0; an empty table gives no rows; further columns are ignored or kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moundlake.llm.common import drop_table, put_down, table, text_or_empty

SAMPLE_ROWS, FEATURES, LEAST_TEXTS = 12_000, 500, 4
GRADES = 3
REJECT_AT = 0.4
MEMO = 300_000


@dataclass
class OrdinalModel:
    features: dict[str, int] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def severity(self, found: dict[int, float]) -> float:
        from math import exp
        if not self.thresholds:
            return 0.0
        at = sum(self.weights[j] * x for j, x in found.items())
        return sum(1.0 / (1.0 + exp(min(50.0, max(-50.0, t - at)))) for t in self.thresholds)


def terms_of(word: str) -> list[str]:
    """The features a word belongs to: itself and its beginnings."""
    return ["w" + word, *(["4" + word[:4]] if len(word) > 3 else []), *(["5" + word[:5]] if len(word) > 4 else [])]


_WORD = re.compile(r"\w+")


class Extractor:
    """Selected features of a text, by a bounded memo of its words."""

    def __init__(self, features: dict[str, int]):
        self.features, self.memo = features, {}

    def _look(self, word: str) -> tuple[int, ...]:
        if len(self.memo) >= MEMO:
            self.memo.clear()
        got = self.memo[word] = tuple(self.features[t] for t in terms_of(word) if t in self.features)
        return got

    def __call__(self, text: str) -> dict[int, float]:
        from math import log1p
        words = _WORD.findall(text.lower())
        counts: dict[int, int] = {}
        memo = self.memo
        for word, n in Counter(words).items():
            ids = memo.get(word)
            for j in self._look(word) if ids is None else ids:
                counts[j] = counts.get(j, 0) + n
        return {j: log1p(1000.0 * n / len(words)) for j, n in counts.items()}


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(toxic, text) of at most ``rows`` labelled ids, the smallest by hash."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded by the parameter, so it is broadcast
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").select("toxic", "text")


def choose_features(sample: DataFrame, most: int, least: int = LEAST_TEXTS) -> list[tuple[str, bool]]:
    """The terms most associated with the label by the likelihood ratio, and whether they mark toxic texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = (Counter(), Counter())
            for toxic, text in zip(batch["toxic"], batch["text"]):
                seen[1 if toxic else 0].update({t for w in set(_WORD.findall(text.lower())) for t in terms_of(w)})
            terms = sorted(set(seen[0]) | set(seen[1]))
            yield pd.DataFrame({"term": terms, "clean": [seen[0][t] for t in terms], "toxic": [seen[1][t] for t in terms]})

    n = {bool(r.toxic): r["count"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    if len(n) < 2:
        return []
    total = sample.mapInPandas(count, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("clean") + F.col("toxic") >= least)
    toxic, clean, both = F.col("toxic"), F.col("clean"), n[True] + n[False]
    cells = [(toxic, (toxic + clean) * n[True] / both), (clean, (toxic + clean) * n[False] / both),
             (n[True] - toxic, (both - toxic - clean) * n[True] / both), (n[False] - clean, (both - toxic - clean) * n[False] / both)]
    gain = sum(F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0) for seen, due in cells)
    rows = total.select("term", F.round(gain, 6).alias("gain"), (toxic * n[False] > clean * n[True]).alias("marks")) \
        .orderBy(F.col("gain").desc(), "term").limit(most).collect()
    return [(r.term, r.marks) for r in rows]


def fit_ordinal(rows: list[dict[int, float]], grades: list[int], n_features: int, ridge: float = 1e-3,
                steps: int = 400, rate: float = 0.05) -> tuple[list[float], list[float]]:
    """Weights and thresholds of the cumulative-link model by full-batch gradient steps (Adam).

    Every row counts once, so the thresholds carry the grades' shares: a text without any feature
    gets the severity of the share of such texts that are toxic."""
    import numpy as np
    x = np.zeros((len(rows), n_features), dtype=np.float32)
    for i, found in enumerate(rows):
        for j, v in found.items():
            x[i, j] = v
    y = np.array(grades)
    top = GRADES
    weight = np.full(len(y), 1.0 / len(y))
    theta = np.concatenate([[2.0], np.zeros(top - 1)])  # first threshold, then logs of the gaps
    p = np.concatenate([np.zeros(n_features), theta])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda t: 1.0 / (1.0 + np.exp(-np.clip(t, -50, 50)))
    for step in range(1, steps + 1):
        w, first, gaps = p[:n_features], p[n_features], np.exp(p[n_features + 1:])
        cut = first + np.concatenate([[0.0], np.cumsum(gaps)])
        at = x @ w.astype(np.float32)
        above = np.concatenate([np.ones((len(y), 1)), sigmoid(at[:, None] - cut), np.zeros((len(y), 1))], axis=1)
        mine = np.maximum(above[np.arange(len(y)), y] - above[np.arange(len(y)), y + 1], 1e-12)
        slope = above * (1 - above)  # derivative of P(grade >= k) by the score
        lower, upper = slope[np.arange(len(y)), y], slope[np.arange(len(y)), y + 1]
        g_at = -weight * (lower - upper) / mine
        g_cut = np.zeros(top)
        np.add.at(g_cut, y[y > 0] - 1, (weight * lower / mine)[y > 0])
        np.add.at(g_cut, y[y < top], (-weight * upper / mine)[y < top])
        tail = np.cumsum(g_cut[::-1])[::-1]
        grad = np.concatenate([x.T @ g_at.astype(np.float32) + ridge * w, [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    gaps = np.exp(p[n_features + 1:])
    return p[:n_features].tolist(), (p[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])).tolist()


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES,
        id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """The model from the labelled rows of ``docs``; the sample's sparse rows are fitted on the driver."""
    import numpy as np
    sample = put_down(labelled_sample(docs, labels, sample_rows, id_col, text_col), "labelled")
    chosen = choose_features(sample, features)
    if not chosen:
        drop_table(sample)
        return OrdinalModel()
    index = {t: j for j, (t, _) in enumerate(chosen)}
    markers = {j for j, (_, toxic) in enumerate(chosen) if toxic}

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extract = Extractor(index)
        for batch in batches:
            found = [extract(t) for t in batch["text"]]
            yield pd.DataFrame({"toxic": (batch["toxic"] > 0).to_numpy(), "ids": [list(f) for f in found],
                                "xs": [list(f.values()) for f in found]})

    got = sample.mapInPandas(sparse, "toxic boolean, ids array<int>, xs array<double>").collect()  # bounded by the sample
    drop_table(sample)
    rows = [dict(zip(r.ids, r.xs)) for r in got]
    share = [sum(np.expm1(x) for j, x in f.items() if j in markers) for f in rows]
    of_toxic = sorted(s for s, r in zip(share, got) if r.toxic)
    cuts = [of_toxic[len(of_toxic) * k // GRADES] for k in range(1, GRADES)]
    grades = [1 + sum(s >= c for c in cuts) if r.toxic else 0 for s, r in zip(share, got)]
    weights, thresholds = fit_ordinal(rows, grades, len(chosen))
    return OrdinalModel(index, weights, thresholds)


def severity(model: OrdinalModel, spark: SparkSession, text: Column) -> Column:
    """Expected severity (0 to 3) of a text column."""
    sent = spark.sparkContext.broadcast((model.features, model.weights, model.thresholds))  # bounded: ``features`` terms

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = OrdinalModel(*sent.value)
        extract = Extractor(m.features)
        for batch in batches:
            yield pd.Series([m.severity(extract(t)) for t in batch], dtype="float64")

    return score(F.coalesce(text, F.lit("")))


def keep_clean(docs: DataFrame, labels: DataFrame, reject_at: float = REJECT_AT) -> DataFrame:
    """``docs`` without the rows whose expected severity is ``reject_at`` or more; all columns stay."""
    model = fit(docs, labels)
    scored = docs.withColumn("_llm_severity", severity(model, docs.sparkSession, F.col("text")))
    return scored.where(F.col("_llm_severity") < reject_at).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, nearest grade and decision for all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", severity(model, spark, F.col("text")).alias("expected_severity")).select(
        "doc_id", "expected_severity", F.round("expected_severity").cast("int").alias("grade"),
        (F.col("expected_severity") >= REJECT_AT).alias("rejected"))
