"""Similarity join on the Jaccard similarity of word n-grams with Bayesian candidate pruning.

Texts are lower-cased and split at white space; a text's set holds its runs of five words (a shorter
text: its whole word sequence), as 64-bit hashes. Texts with equal sets form a class of copies and are
compared once, through their first row.

1. Each class gets a MinHash signature (192 values); 32 bands of 6 values link classes to the first
   class of their bucket. A pair at similarity 0.8 shares no band with probability 6e-5, before the
   closure below, and less above it.
2. The linked classes form candidate clusters. Inside a cluster all pairs are compared by MinHash values, 32
   at a time: with m matches among n values and a uniform prior, the posterior that the similarity reaches t is
   P(Binomial(n + 1, t) <= m); the pair is dropped once it is below ``TOLERANCE``.
3. Pairs that survive all values are verified exactly on their sets.

A cluster of any size is cut into blocks of bounded rows and bounded set sizes, and each pair of blocks is one
task's work; small clusters share a task. A task returns the number of links of each class and a
spanning forest of the links it found, never the pairs, so a group of g near copies gives O(g) rows.

Defined results: a null text counts as empty; a text without words links with nothing, equal empty
texts included; repeated rows are copies of each other; an empty table gives no rows; null ids are carried, and
are never the id of a class that has another one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

from pyspark.sql import DataFrame, SparkSession, functions as F

from moundlake.llm.common import drop_table, put_down, table, text_or_empty, with_locator
from moundlake.llm.components import connected_components

WORDS, THRESHOLD = 5, 0.8
BANDS, BAND_ROWS = 32, 6
HASHES = BANDS * BAND_ROWS
#: MinHash values compared at a time, and the posterior below which a pair is dropped.
STEP, TOLERANCE = 32, 1e-6
#: A block holds at most about so many classes and so many set members.
BLOCK_CLASSES, BLOCK_MEMBERS = 2048, 2_000_000
#: Words a task's memo of word hashes holds before it is emptied.
MEMO = 500_000


def least_matches(threshold: float, tolerance: float, step: int = STEP, hashes: int = HASHES) -> dict[int, int]:
    """For each n compared: the fewest matches at which the posterior is still at least ``tolerance``."""
    out = {}
    for n in range(step, hashes + 1, step):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out[n] = m
    return out


class Shingler:
    """Sets of word n-grams as sorted 64-bit hashes."""

    def __init__(self, words: int = WORDS):
        import numpy as np
        import xxhash
        self.np, self.words, self.hash_of = np, words, xxhash.xxh64_intdigest
        self.memo: dict[str, int] = {}
        self.factors = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) | 1 for k in range(words)], dtype=np.uint64)

    def _hash(self, word: str) -> int:
        if len(self.memo) >= MEMO:
            self.memo.clear()
        h = self.memo[word] = self.hash_of(word)
        return h

    def mix(self, x):
        np = self.np
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))

    def set_of(self, text: str):
        np, get, k = self.np, self.memo.get, self.words
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.array([get(w) or self._hash(w) for w in words], dtype=np.uint64)
        n = max(len(h) - k + 1, 1)
        total = np.full(n, min(len(h), k), dtype=np.uint64)
        for j in range(min(k, len(h))):
            total = self.mix(total + h[j:j + n] * self.factors[j])
        return np.unique(total)


def _signature(members, factors, offsets):
    """MinHash values of one set, 32 bits each."""
    import numpy as np
    x = (members >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        h = x[at:at + 2048, None] * factors[None, :]
        h += offsets
        np.minimum(least, h.min(axis=0), out=least)
    return least


def _hash_family(hashes: int):
    import numpy as np
    rng = np.random.Generator(np.random.PCG64(20240501))
    return (rng.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, hashes, dtype=np.uint32))


def signatures(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, file, row, n (set size), d1, d2 (128 bits of the whole set), sig, of (doc_id, file, row, text)."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        import xxhash
        shingler = Shingler(words)
        factors, offsets = _hash_family(HASHES)
        for batch in batches:
            n, d1, d2, sig = [], [], [], []
            for text in batch["text"]:
                members = shingler.set_of(text)
                whole = xxhash.xxh128_digest(members.tobytes())
                n.append(len(members))
                d1.append(int.from_bytes(whole[:8], "big", signed=True))
                d2.append(int.from_bytes(whole[8:], "big", signed=True))
                sig.append(_signature(members, factors, offsets).tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "file": batch["file"], "row": batch["row"],
                                "n": np.array(n, dtype="int64"), "d1": np.array(d1, dtype="int64"),
                                "d2": np.array(d2, dtype="int64"), "sig": sig})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, file string, row long, n long, d1 long, d2 long, sig binary")


def _band_keys(classes: DataFrame) -> DataFrame:
    """(key, node) for every band of every class."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        mix = Shingler().mix
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at:at + 4096]
                sig = np.frombuffer(b"".join(part["sig"]), dtype=np.uint32).reshape(len(part), BANDS, BAND_ROWS)
                key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(part), BANDS)).copy()
                for r in range(BAND_ROWS):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
                yield pd.DataFrame({"key": key.ravel().view(np.int64), "node": np.repeat(part["node"].to_numpy(), BANDS)})

    return classes.select("node", "sig").mapInPandas(run, "key long, node long")


def candidate_clusters(classes: DataFrame) -> DataFrame:
    """(node, cluster) for classes that share a bucket with another one, closed under sharing."""
    keys = put_down(_band_keys(classes), "bands")
    buckets = put_down(keys.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("many"))
                       .where("many > 1").select("key", "first"), "buckets")
    links = keys.join(buckets, "key").where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    found = put_down(connected_components(links), "clusters")
    drop_table(keys)
    drop_table(buckets)
    return found.select("node", F.col("component").alias("cluster"))


def _compare(pdf, threshold: float, enough: dict[int, int]):
    """All pairs of one task: the links of each class (copies counted) and a spanning forest."""
    import numpy as np
    import pandas as pd
    node, copies, side = pdf["node"].to_numpy(), pdf["copies"].to_numpy(), pdf["side"].to_numpy()
    cluster = pdf["cluster"].to_numpy()
    sizes = pdf["n"].to_numpy()
    sig = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint32).reshape(len(pdf), HASHES)
    _, ids = np.unique(np.frombuffer(b"".join(pdf["members"]), dtype=np.uint64), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marked = np.zeros(int(ids.max()) + 1, dtype=bool)
    links, label = np.zeros(len(pdf), dtype=np.int64), np.arange(len(pdf))
    forest: list[tuple[int, int]] = []
    order = np.argsort(cluster, kind="stable")
    cuts = np.flatnonzero(np.diff(cluster[order])) + 1
    for group in np.split(order, cuts):
        for k, i in enumerate(group):
            other = group[k + 1:] if side[i] < 0 else group[side[group] == 1] if side[i] == 0 else group[:0]
            # a set that is smaller by more than the threshold allows cannot reach it
            other = other[np.minimum(sizes[other], sizes[i]) >= threshold * np.maximum(sizes[other], sizes[i])]
            matches = np.zeros(len(other), dtype=np.int32)
            for n in range(0, HASHES, STEP):
                if not len(other):
                    break
                matches += (sig[other, n:n + STEP] == sig[i, n:n + STEP]).sum(axis=1, dtype=np.int32)
                stay = matches >= enough[n + STEP]
                other, matches = other[stay], matches[stay]
            if not len(other):
                continue
            mine = ids[starts[i]:ends[i]]
            marked[mine] = True
            if len(other) == 1:
                j = other[0]
                common = np.array([marked[ids[starts[j]:ends[j]]].sum()])
            else:
                lengths = sizes[other]
                first = np.cumsum(lengths) - lengths
                common = np.empty(len(other), dtype=np.int64)
                for lo, hi in _chunks(lengths):
                    span = np.arange(lengths[lo:hi].sum()) + np.repeat(starts[other[lo:hi]] - (first[lo:hi] - first[lo]), lengths[lo:hi])
                    common[lo:hi] = np.add.reduceat(marked[ids[span]].astype(np.int64), first[lo:hi] - first[lo])
            marked[mine] = False
            linked = other[common / (sizes[i] + sizes[other] - common) >= threshold]
            if not len(linked):
                continue
            links[i] += copies[linked].sum()
            links[linked] += copies[i]
            labels = np.unique(label[np.append(linked, i)])
            if len(labels) > 1:
                forest += [(node[labels[0]], node[x]) for x in labels[1:]]
                label[np.isin(label, labels[1:])] = labels[0]
    some = np.flatnonzero(links)
    a = np.concatenate([node[some], np.array([x for x, _ in forest], dtype=np.int64)])
    b = np.concatenate([node[some], np.array([y for _, y in forest], dtype=np.int64)])
    return pd.DataFrame({"a": a, "b": b, "links": np.concatenate([links[some], np.zeros(len(forest), dtype=np.int64)])})


def _chunks(lengths, most: int = 4_000_000):
    """Runs of partners whose sets together hold about ``most`` members."""
    lo, total = 0, 0
    for k, n in enumerate(lengths):
        if total and total + n > most:
            yield lo, k
            lo, total = k, 0
        total += int(n)
    yield lo, len(lengths)


def _members(rows: DataFrame, words: int) -> DataFrame:
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                yield part.drop(columns="text").assign(members=[shingler.set_of(t).tobytes() for t in part["text"]])

    kept = [f for f in rows.schema.fields if f.name != "text"]
    return rows.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", members binary")


def _tasks(located: DataFrame) -> DataFrame:
    """Clustered classes with the task(s) each goes to: unit, i, j and the side it takes there."""
    sizes = located.groupBy("cluster").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("members"))
    sizes = put_down(sizes.select("cluster", F.greatest(
        F.ceil(F.col("classes") / BLOCK_CLASSES), F.ceil(F.col("members") / BLOCK_MEMBERS)).cast("int").alias("blocks"),
        "classes", "members"), "cluster-sizes")
    small = sizes.where("blocks = 1").agg(F.sum("classes").alias("c"), F.sum("members").alias("m")).first()
    bins = max(1, 2 * max((small.c or 0) // BLOCK_CLASSES, (small.m or 0) // BLOCK_MEMBERS), 12)
    out = located.join(sizes.select("cluster", "blocks"), "cluster") \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return out.select(
        "cluster", "node", "copies", "n", "file", "row", "sig",
        F.when(F.col("blocks") == 1, -1 - F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster")).alias("unit"),
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") == F.col("other"), -1).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"))


def verified_links(classes: DataFrame, rows: DataFrame, threshold: float, words: int) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (a, b): the number of linked rows of each class, and links that span every group."""
    clusters = candidate_clusters(classes)
    located = put_down(classes.join(clusters, "node"), "clustered")
    members = _members(rows.select("file", "row", "text").join(located.select("file", "row", "node"), ["file", "row"])
                       .select("node", "text"), words)
    work = _tasks(located).drop("file", "row").join(members, "node")
    enough = least_matches(threshold, TOLERANCE)

    def run(pdf):
        return _compare(pdf, threshold, enough)

    found = put_down(work.groupBy("unit", "i", "j").applyInPandas(run, "a long, b long, links long"), "verified")
    drop_table(located)
    counted = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    return counted, found.where("a != b").select("a", "b")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, file, row (its place), class_id (smallest doc_id of the rows reachable by
    links), n_links (other rows linked directly), kept (the first row of its class)."""
    return _classes(with_locator(docs), id_col, text_col, words, threshold)


def _classes(located: DataFrame, id_col: str, text_col: str, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    rows = located.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"),
                          F.col("_llm_file").alias("file"), F.col("_llm_row").alias("row"))
    signed = put_down(signatures(rows, words).withColumn("uid", F.monotonically_increasing_id()), "signed")
    copies = put_down(signed.where("n > 0").groupBy("d1", "d2").agg(
        F.min("uid").alias("node"), F.count(F.lit(1)).alias("copies")), "copies")
    placed = put_down(signed.where("n > 0").select("doc_id", "file", "row", "uid", "d1", "d2").join(copies, ["d1", "d2"])
                      .drop("d1", "d2")
                      .union(signed.where("n = 0").select("doc_id", "file", "row", "uid", F.col("uid").alias("node"),
                                                          F.lit(1).cast("long").alias("copies"))), "placed")
    classes = signed.select("uid", "file", "row", "n", "sig").join(
        copies.select(F.col("node").alias("uid"), "copies"), "uid").withColumnRenamed("uid", "node")
    counted, links = verified_links(classes, rows, threshold, words)
    groups = put_down(connected_components(links), "groups")
    whole = placed.join(groups, "node", "left").join(counted, "node", "left").select(
        "doc_id", "file", "row", F.coalesce("component", "node").alias("component"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    whole = put_down(whole, "linked")
    first = whole.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")).alias("first"))
    return whole.join(put_down(first, "firsts"), "component").select(
        "doc_id", "file", "row", F.col("first.doc_id").alias("class_id"), "n_links",
        ((F.col("first.file") == F.col("file")) & (F.col("first.row") == F.col("row"))).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the first row of each group of near copies, all columns."""
    located = with_locator(docs)
    kept = _classes(located, id_col, text_col).where("kept").select(
        F.col("file").alias("_llm_file"), F.col("row").alias("_llm_row"))
    return located.join(kept, ["_llm_file", "_llm_row"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all ``documents``: class and number of links of every document."""
    return jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


ORACLE_OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(lower(coalesce(text, '')), '\s+') IF x <> ''] AS words FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE common / (x.n + y.n - common) >= 0.8),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT c.doc_id, class_id, coalesce(n_links, 0) AS n_links, c.doc_id = class_id AS kept FROM c LEFT JOIN k USING (doc_id)
"""
