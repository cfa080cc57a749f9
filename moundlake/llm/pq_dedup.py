"""Near copies among embeddings by an inverted-list index with product-quantised residuals.

Vectors are scaled to length one; cosine >= t is distance <= r = sqrt(2 - 2t). Equal vectors form a class
that is compared once. The index has coarse centroids and, for the residual from a vector's own centroid, one
code per subspace; centroids and code books are fitted on a bounded sample (``SAMPLE`` classes, the smallest by
hash), every class is indexed, together with the exact length of what its code leaves over.

* Probes. A neighbour of x lies in the list of centroid c only if x is at most r from the plane between
  c and its own centroid. Lists whose plane is within ``margin`` * r are probed: margin 1 cannot miss a
  neighbour; at the default 0.5 a neighbour at the full distance r would have to lie four standard deviations off in the
  direction of that plane (64 dimensions), and closer ones further.
* Asymmetric distances. For each query and list a table holds its distances to all code words; a member's distance to the
  query is the sum of its codes' entries. Since the member is exactly ``left`` away from its code, it cannot be within r if
  that sum exceeds r + left; nothing else is dropped.
* Exact rerank. The rest are compared by cosine in double precision.

* Both ends. A link found from one end counts for both: a task that finds member y from query x works out from y whether y's
  own probes reach x's list. If they do, y finds x itself; if not, the task counts the link for y as well.

A list of any size is cut into blocks of members and blocks of queries, one task's work each, so a hot list
spreads. A task returns the number of links of each vector and a spanning forest of the links, not the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different lengths never link; equal vectors link with each other; an empty table gives no rows; null ids are carried and are never
a component's id while it has another; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from moundlake.llm.common import put_down, table
from moundlake.llm.components import connected_components

COSINE = 0.95
SAMPLE, MOST_LISTS, SUBSPACES, CODE_WORDS = 16_384, 4_096, 8, 256
MARGIN = 0.5
BLOCK = 2_048


def kmeans(x, k: int, rounds: int = 8, seed: int = 11):
    """Lloyd's iterations on a bounded sample; centroids without members stay where they are."""
    import numpy as np
    rng = np.random.Generator(np.random.PCG64(seed))
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x, c):
    import numpy as np
    half = (c ** 2).sum(axis=1) / 2
    return np.concatenate([(x[a:a + 4096] @ c.T - half).argmax(axis=1) for a in range(0, len(x), 4096)] or [np.empty(0, int)])


def fit_index(x, lists: int, subspaces: int = SUBSPACES, words: int = CODE_WORDS):
    """(centroids, list of (columns, code book)) from unit vectors."""
    import numpy as np
    centroids = kmeans(x, min(lists, len(x)))
    left = x - centroids[nearest(x, centroids)]
    columns = [c for c in np.array_split(np.arange(x.shape[1]), subspaces) if len(c)]
    return centroids, [(c, kmeans(np.ascontiguousarray(left[:, c]), min(words, len(x)))) for c in columns]


def unit(raw):
    """Rows of float bytes as unit vectors in double precision."""
    import numpy as np
    x = np.frombuffer(b"".join(raw), dtype=np.float32).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares of tiny components do not vanish
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def _plane(margin: float, radius: float, own, other):
    """How much further (in squared distance) a vector of a list may be from another list's centroid for it to be probed."""
    import numpy as np
    return 2 * margin * radius * np.sqrt(((own - other) ** 2).sum(axis=-1)) + 1e-9


def _index(classes: DataFrame, sent, radius: float, margin: float) -> DataFrame:
    """For every class: a member row in its own list and a query row in every probed list."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        centroids, books = sent.value
        squares = (centroids ** 2).sum(axis=1)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                x = unit(part["raw"])
                d2 = np.maximum(1 + squares - 2 * x @ centroids.T, 0)
                own = d2.argmin(axis=1)
                left = x - centroids[own]
                codes = np.stack([nearest(left[:, c], book) for c, book in books], axis=1).astype(np.uint8)
                for m, (c, book) in enumerate(books):
                    left[:, c] -= book[codes[:, m]]
                over = np.sqrt((left ** 2).sum(axis=1))
                near = np.sqrt(d2)
                apart = np.sqrt(np.maximum(squares[own][:, None] + squares - 2 * centroids[own] @ centroids.T, 0))
                probed = d2 - d2[np.arange(len(x)), own][:, None] <= 2 * margin * radius * apart + 1e-9
                q, lists = np.nonzero(probed)
                node, copies, raw = part["node"].to_numpy(), part["copies"].to_numpy(), part["raw"].to_numpy()
                yield pd.DataFrame({"list": own.astype("int32"), "own": own.astype("int32"), "node": node, "copies": copies, "raw": raw,
                                    "codes": [b.tobytes() for b in codes], "left": over, "near": near[np.arange(len(x)), own]})
                for a in range(0, len(q), 4096):
                    b, c = q[a:a + 4096], lists[a:a + 4096]
                    yield pd.DataFrame({"list": c.astype("int32"), "own": own[b].astype("int32"), "node": node[b], "copies": copies[b], "raw": raw[b],
                                        "codes": None, "left": 0.0, "near": near[b, c]})

    return classes.mapInPandas(run, "list int, own int, node long, copies long, raw binary, codes binary, left double, near double")


def _tasks(rows: DataFrame, block: int) -> DataFrame:
    """Each row with the (member block, query block) tasks of its list."""
    query = F.col("codes").isNull()
    sizes = put_down(rows.groupBy("list").agg(
        F.greatest(F.ceil(F.sum(F.when(query, 0).otherwise(1)) / block), F.lit(1)).cast("int").alias("m_blocks"),
        F.greatest(F.ceil(F.sum(F.when(query, 1).otherwise(0)) / block), F.lit(1)).cast("int").alias("q_blocks")), "list-sizes")
    mine = lambda n: F.array(F.pmod(F.xxhash64("node"), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # one row for each list, at most MOST_LISTS
    out = rows.join(F.broadcast(sizes), "list")
    out = out.withColumn("mb", F.explode(F.when(query, every("m_blocks")).otherwise(mine("m_blocks"))))
    return out.withColumn("qb", F.explode(F.when(query, mine("q_blocks")).otherwise(every("q_blocks")))).drop("m_blocks", "q_blocks")


def _search(pdf: pd.DataFrame, index, radius: float, cosine: float, margin: float) -> pd.DataFrame:
    """One list's block of queries against one block of its members."""
    import numpy as np
    centroids, books = index
    is_query = pdf["codes"].isna().to_numpy()
    queries, members = pdf[is_query], pdf[~is_query]
    empty = pd.DataFrame({"a": np.empty(0, "int64"), "b": np.empty(0, "int64"), "links": np.empty(0, "int64")})
    if not len(queries) or not len(members):
        return empty
    y, node, copies = unit(members["raw"]), members["node"].to_numpy(), members["copies"].to_numpy()
    codes = np.frombuffer(b"".join(members["codes"]), dtype=np.uint8).reshape(len(members), -1)
    reach, near = (radius + members["left"].to_numpy() + 1e-6) ** 2, members["near"].to_numpy()
    q_node, q_own, q_copies = (queries[c].to_numpy() for c in ("node", "own", "copies"))
    here, m_links = int(members["list"].iloc[0]), np.zeros(len(members), dtype=np.int64)
    links, forest = np.zeros(len(queries), dtype=np.int64), []
    every = np.unique(np.concatenate([node, q_node]))
    label = np.arange(len(every))
    at_member, at_query = np.searchsorted(every, node), np.searchsorted(every, q_node)
    for a in range(0, len(queries), 128):
        part = queries.iloc[a:a + 128]
        x = unit(part["raw"])
        left = x - centroids[part["list"].to_numpy()]
        total = np.zeros((len(part), len(members)))
        for m, (c, book) in enumerate(books):
            lookup = ((left[:, c] ** 2).sum(1)[:, None] + (book ** 2).sum(1) - 2 * left[:, c] @ book.T)
            total += lookup[:, codes[:, m]]
        able = (total <= reach) & (np.abs(part["near"].to_numpy()[:, None] - near) <= radius + 1e-6)
        able &= q_node[a:a + 128, None] != node
        i, j = np.nonzero(able)
        for lo in range(0, len(i), 200_000):
            p, s = i[lo:lo + 200_000], j[lo:lo + 200_000]
            good = np.einsum("nd,nd->n", x[p], y[s]) >= cosine
            p, s = p[good], s[good]
            np.add.at(links, a + p, copies[s])
            back = centroids[q_own[a + p]]  # does the member's own search reach the query's list?
            further = ((y[s] - back) ** 2).sum(axis=1) - ((y[s] - centroids[here]) ** 2).sum(axis=1)
            alone = further > _plane(margin, radius, centroids[here], back)
            np.add.at(m_links, s[alone], q_copies[a + p[alone]])
            for k in np.unique(p):
                labels = np.unique(label[np.append(at_member[s[p == k]], at_query[a + k])])
                if len(labels) > 1:
                    forest += [(every[labels[0]], every[v]) for v in labels[1:]]
                    label[np.isin(label, labels[1:])] = labels[0]
    some, others = np.flatnonzero(links), np.flatnonzero(m_links)
    counted = np.concatenate([q_node[some], node[others]])
    return pd.DataFrame({"a": np.concatenate([counted, np.array([u for u, _ in forest], dtype=np.int64)]),
                         "b": np.concatenate([counted, np.array([v for _, v in forest], dtype=np.int64)]),
                         "links": np.concatenate([links[some], m_links[others], np.zeros(len(forest), dtype=np.int64)])})


def _pack(rows: DataFrame) -> DataFrame:
    """The embedding's floats as bytes, beside the other columns."""
    kept = [f for f in rows.schema.fields if f.name != "embedding"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        for batch in batches:
            yield batch.drop(columns="embedding").assign(raw=[np.asarray(e, dtype=np.float32).tobytes() for e in batch["embedding"]])

    return rows.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", raw binary")


def near_links(classes: DataFrame, cosine: float, margin: float, block: int = BLOCK) -> DataFrame | None:
    """(a, b, links) of classes (node, copies, raw) of one length: links of node a where a = b, else a link."""
    import numpy as np
    spark = classes.sparkSession
    n = classes.count()
    if n < 2:
        return None
    sample = classes.select("node", "raw").orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("raw").collect()
    index = fit_index(unit([bytes(r.raw) for r in sample]), int(min(MOST_LISTS, max(1, 2 * np.sqrt(n)))))
    sent = spark.sparkContext.broadcast(index)  # bounded: MOST_LISTS centroids and the code books
    radius = float(np.sqrt(2 - 2 * cosine))
    rows = put_down(_index(classes, sent, radius, margin), "pq-index")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _search(pdf, sent.value, radius, cosine, margin)

    return _tasks(rows, block).groupBy("list", "mb", "qb").applyInPandas(run, "a long, b long, links long")


def near_copies(vectors: DataFrame, id_col: str = "vec_id", embedding_col: str = "embedding", cosine: float = COSINE,
                margin: float = MARGIN) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    e = F.col("embedding")
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    rows = put_down(vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{embedding_col}`").cast("array<float>").alias("embedding"))
                    .withColumn("uid", F.monotonically_increasing_id())
                    .withColumn("good", F.coalesce(good, F.lit(False))), "vectors")
    copies = put_down(rows.where("good").groupBy("embedding").agg(
        F.min("uid").alias("node"), F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("embedding")), "vector-classes")
    placed = rows.where("good").join(copies.select("embedding", "node", "copies"), "embedding").select("vec_id", "node", "copies") \
        .union(rows.where("not good").select("vec_id", F.col("uid").alias("node"), F.lit(1).cast("long")))
    found = spark.createDataFrame([], "a long, b long, links long")
    for r in copies.select("dim").distinct().collect():  # lengths of vectors, usually one
        some = near_links(_pack(copies.where(F.col("dim") == r.dim).select("node", "copies", "embedding")), cosine, margin)
        if some is not None:
            found = found.union(some)
    found = put_down(found, "vector-links")
    counted = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = put_down(connected_components(found.where("a != b")), "vector-groups")
    whole = put_down(placed.join(groups, "node", "left").join(counted, "node", "left").select(
        "vec_id", F.coalesce("component", "node").alias("group"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-groups-rows")
    least = put_down(whole.groupBy("group").agg(F.min("vec_id").alias("component_id")), "vector-least")
    return whole.join(least, "group").select("vec_id", "n_links", "component_id",
                                             F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op1_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings`` at cosine 0.95 (contract of operator 1)."""
    return near_copies(table(spark, sf_dir, "embeddings"))


ORACLE_OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                     WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
k AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN k USING (vec_id)
"""
