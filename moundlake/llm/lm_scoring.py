"""Document scoring by cross-entropy difference of two bigram models.

Both models are over the same vocabulary (every word of the background, an unknown-word class and a start sign), use
the same interpolation P(w|h) = L c(h,w)/c(h) + (1-L) (c(w)+1)/(N+V), and differ only in their corpus: the background
model counts every document, the target model the documents given as target. A document's score is the
mean over its tokens of loss(target) - loss(background), in nats: the lower, the more like the target.

1. Documents become 64-bit word hashes in chunks of at most ``CHUNK_TOKENS`` tokens (or one document), one packed row each; words and
   tokens are counted. In storage the ``CODES`` most frequent words take two bytes and only the others their hash: it saves disk and
   changes no score.
2. Every chunk sends its distinct words and bigrams with their counts in both corpora to shards chosen by hash; a shard adds the
   counts of all chunks up and sends the sums back to the chunks that asked. There is a shard for every ``SHARD_TOKENS`` tokens of
   the corpus, so neither a chunk nor a shard grows with it, whatever the lengths of its documents.
3. Each chunk scores its documents. Only the short codes are broadcast. If the caller limits the vocabulary, the words below the
   smallest count that leaves at most ``words`` of them are
   one unknown class.

Defined results: a null or empty text, or one without words, has 0 tokens and a null score; equal texts get equal scores; without any
target document the target model is the smoothed uniform one; an empty table gives no rows; null ids are scored as part of
the background; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from moundlake.llm.common import drop_table, put_down, table, text_or_empty

CHUNK_TOKENS, SHARD_TOKENS = 1 << 21, 1 << 21
LAMBDA = 0.7
_WORD = re.compile(r"\w+")
#: Keys of the start sign and of the unknown class, and documents whose words are hashed at a time.
START, UNKNOWN = 0, 1
#: Words with a two-byte code, and the code of all others.
CODES, RARE = 30_000, 0xFFFF
ROWS_HASHED = 512


def vocabulary(rows: DataFrame, most: int) -> list[str]:
    """The words of ``rows.text`` whose count reaches the smallest cut-off that leaves at most ``most``."""
    words = rows.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")).alias("word")).where("word <> ''")
    counts = put_down(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    # distinct counts: at most about the square root of twice the tokens
    kept, cut = 0, None
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("n").desc()).toLocalIterator():
        kept += r.words
        if kept > most:
            break
        cut = r.n
    found = [] if cut is None else [r.word for r in counts.where(F.col("n") >= cut).orderBy("word").collect()]
    drop_table(counts)
    return found


def _encode(rows: DataFrame, codes, sent, chunk_tokens: int) -> DataFrame:
    """A row per chunk: chunk, doc_ids, lengths (tokens of each document) and, packed, ids (two bytes a word) and rare (hashes of the words
    without a code); with a vocabulary ``sent``, others are unknown."""
    import pyarrow as pa
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import zstandard
        from pyspark import TaskContext
        get = {w: k for k, w in enumerate(codes.value)}.get
        known = None if sent is None else set(sent.value)
        pack = zstandard.ZstdCompressor(level=1).compress
        docs, lengths, ids, rare, tokens, number = [], [], [], [], 0, TaskContext.get().partitionId() << 32

        def chunk():
            doc_ids = pa.concat_arrays(docs)
            ends = pa.array([0, len(doc_ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(ends, doc_ids),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lengths).astype(np.int32))),
                 pa.array([pack(b"".join(ids))], pa.binary()), pa.array([pack(b"".join(rare))], pa.binary())],
                names=["chunk", "doc_ids", "lengths", "ids", "rare"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts = batch.column(1).slice(at, ROWS_HASHED).to_pylist()
                found = [_WORD.findall(t.lower()) for t in texts]
                sizes = np.array([len(f) for f in found], dtype=np.int64)
                take = max(1, int(np.searchsorted(tokens + np.cumsum(sizes), chunk_tokens, side="right")))
                if tokens and tokens + sizes[0] > chunk_tokens:
                    yield chunk()
                    docs, lengths, ids, rare, tokens, number = [], [], [], [], 0, number + 1
                    continue
                found, sizes = found[:take], sizes[:take]
                flat = [w for f in found for w in f]
                code = np.fromiter((get(w, RARE) for w in flat), np.uint16, len(flat))
                others = [flat[k] for k in np.flatnonzero(code == RARE)]
                keys = _hashes(others)
                if known is not None:
                    keys[np.array([w not in known for w in others], dtype=bool)] = UNKNOWN
                docs.append(batch.column(0).slice(at, take))
                lengths.append(sizes)
                ids.append(code.tobytes())
                rare.append(keys.tobytes())
                tokens += int(sizes.sum())
                at += take
        if docs:
            yield chunk()

    return rows.mapInArrow(run, f"chunk long, doc_ids array<{kind}>, lengths array<int>, ids binary, rare binary")


def _hashes(words: list[str]):
    import numpy as np
    return pd.util.hash_array(np.array(words, dtype=object)) if words else np.zeros(0, dtype=np.uint64)


def _keys(ids: bytes, rare: bytes, hashes):
    """The hash of every token of a chunk."""
    import numpy as np
    import zstandard
    read = zstandard.ZstdDecompressor().decompress
    ids = np.frombuffer(read(ids), dtype=np.uint16)
    keys = hashes[ids]
    keys[ids == RARE] = np.frombuffer(read(rare), dtype=np.uint64)
    return keys


def _count(lengths, ids: bytes, rare: bytes, hashes):
    """Distinct words (the start sign first) and distinct bigrams of a chunk, in the order of their hashes: words; bigrams as
    (history, word) numbers; the bigram and the document of each token."""
    import numpy as np
    lengths = np.asarray(lengths, dtype=np.int64)
    words, number = np.unique(_keys(ids, rare, hashes), return_inverse=True)
    number = number.astype(np.int64) + 1
    before = np.empty_like(number)
    before[1:] = number[:-1]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    words = np.concatenate([np.array([START], dtype=np.uint64), words])
    before *= len(words)
    before += number
    pairs, inverse = np.unique(before, return_inverse=True)
    return words, (pairs // len(words), pairs % len(words)), inverse, np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)


def _pair_keys(words, pairs):
    import numpy as np
    x = words[pairs[0]] * np.uint64(0x9E3779B97F4A7C15) + words[pairs[1]]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _shard(keys, shards: int):
    import numpy as np
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def _squeeze(x, sorted_keys: bool = False) -> bytes:
    """Numbers packed for the exchange: differences of sorted keys, bytes of equal weight side by side."""
    import numpy as np
    import zstandard
    x = np.ascontiguousarray(np.diff(x, prepend=x.dtype.type(0)) if sorted_keys else x)
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _spread(packed: bytes, kind, sorted_keys: bool = False):
    import numpy as np
    import zstandard
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    x = np.ascontiguousarray(x.T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if sorted_keys else x


def _split(keys, shards: int):
    """Order of ``keys`` by (shard, key) and the cuts between shards."""
    import numpy as np
    at = _shard(keys, shards)
    order = np.lexsort((keys, at))
    return order, np.searchsorted(at[order], np.arange(shards + 1))


def cross_entropy_difference(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             words: int | None = None, weight: float = LAMBDA, chunk_tokens: int = CHUNK_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, n_tokens, score, in_target for every row of ``docs``; ``target`` holds the ids (doc_id) of the target corpus."""
    import numpy as np
    import pyarrow as pa
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    sent = None if words is None else spark.sparkContext.broadcast(vocabulary(rows, words))  # at most ``words`` words
    frequent = vocabulary(rows, CODES if words is None else min(words, CODES))
    codes = spark.sparkContext.broadcast(frequent)
    table_of = np.zeros(RARE + 1, dtype=np.uint64)
    table_of[:len(frequent)] = _hashes(frequent)
    hashes = spark.sparkContext.broadcast(table_of)
    chosen = target.select("doc_id").where("doc_id is not null").distinct().withColumn("in_target", F.lit(True))
    coded = put_down(_encode(rows, codes, sent, chunk_tokens), "word-ids")
    # one plan at every size: the target ids grow with the data; the places of the target's rows go to their chunks
    places = coded.select("chunk", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("at", "d")).select(
        "chunk", "at", F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").alias("n")).join(chosen.hint("merge"), "doc_id", "left_semi")
    places = put_down(places.select("at", "chunk", "n"), "target-rows")
    size, tokens = _totals(coded, places, hashes)
    shards = max(12, int(tokens[0] // shard_tokens) + 1)

    def ask(pdf: pd.DataFrame, chosen_rows: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        mine = np.zeros(len(one["lengths"]), dtype=bool)
        mine[chosen_rows["at"].to_numpy()] = True
        seen, pairs, inverse, row = _count(one["lengths"], one["ids"], one["rare"], hashes.value)
        n = np.bincount(inverse, minlength=len(pairs[0]))
        t = np.bincount(inverse, weights=mine[row], minlength=len(pairs[0]))
        # of each word, times a history and times a word, in both corpora
        times = np.stack([np.bincount(p, weights=c, minlength=len(seen)) for c in (n, t) for p in pairs], axis=1).astype(np.uint32)
        keys, n, t = _pair_keys(seen, pairs), n.astype(np.uint32), t.astype(np.uint32)
        (order, cuts), (w_order, w_cuts) = _split(keys, shards), _split(seen, shards)
        some = [k for k in range(shards) if cuts[k + 1] > cuts[k] or w_cuts[k + 1] > w_cuts[k]]
        piece = lambda x, k, keys=False: _squeeze(x[order[cuts[k]:cuts[k + 1]]], keys)
        w_piece = lambda x, k, keys=False: _squeeze(x[w_order[w_cuts[k]:w_cuts[k + 1]]].ravel(), keys)
        return pd.DataFrame({"chunk": one["chunk"], "shard": np.array(some, dtype="int32"),
                             "keys": [piece(keys, k, True) for k in some], "n": [piece(n, k) for k in some],
                             "t": [piece(t, k) for k in some], "words": [w_piece(seen, k, True) for k in some],
                             "times": [w_piece(times, k) for k in some]})

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        def summed(packed, counts):
            """The sums of each column of ``counts`` over equal keys, cut like the keys."""
            keys = [_spread(k, np.uint64, True) for k in packed]
            ends = np.cumsum([len(k) for k in keys])
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            counts = [np.bincount(inverse, weights=c, minlength=len(distinct)).astype(np.uint64) for c in counts]
            return [_squeeze(np.concatenate([c[inverse[e - len(k):e]] for c in counts])) for k, e in zip(keys, ends)]

        read = lambda c: np.concatenate([_spread(x, np.uint32) for x in pdf[c]])
        return pd.DataFrame({"chunk": pdf["chunk"].to_numpy(), "shard": pdf["shard"].to_numpy(),
                             "pairs": summed(pdf["keys"], (read("n"), read("t"))),
                             "times": summed(pdf["words"], read("times").reshape(-1, 4).T)})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        lengths, ids, rare = (left.column(c)[0].as_py() for c in ("lengths", "ids", "rare"))
        seen, pairs, inverse, row = _count(lengths, ids, rare, hashes.value)
        right = right.sort_by("shard")
        parts = lambda c, n: np.concatenate(
            [_spread(x, np.uint64).reshape(n, -1) for x in right.column(c).to_pylist()], axis=1).T.astype(np.float64)
        sums, times = np.empty((len(pairs[0]), 2)), np.empty((len(seen), 4))
        sums[_split(_pair_keys(seen, pairs), shards)[0]] = parts("pairs", 2)
        times[_split(seen, shards)[0]] = parts("times", 4)
        losses = 0.0
        for k, sign in enumerate((1, -1)):
            history, single = np.maximum(times[:, 2 * k], 1), (times[:, 2 * k + 1] + 1) / (tokens[k] + size)
            losses = losses + sign * np.log(weight * sums[:, k] / history[pairs[0]] + (1 - weight) * single[pairs[1]])
        n = np.bincount(row, minlength=len(lengths))
        total = np.bincount(row, weights=losses[inverse], minlength=len(lengths))
        mean = np.where(n > 0, total / np.maximum(n, 1), np.nan)
        return pa.table({"doc_id": left.column("doc_ids").combine_chunks().flatten(), "n_tokens": pa.array(n, pa.int64()),
                         "score": pa.array(mean, pa.float64())})

    kind = rows.schema["doc_id"].dataType.simpleString()
    asked = coded.groupBy("chunk").cogroup(places.groupBy("chunk")).applyInPandas(
        ask, "chunk long, shard int, keys binary, n binary, t binary, words binary, times binary")
    answered = asked.groupBy("shard").applyInPandas(answer, "chunk long, shard int, pairs binary, times binary")
    scored = coded.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(
        score, f"doc_id {kind}, n_tokens long, score double")
    scored = scored.join(chosen.hint("merge"), "doc_id", "left").withColumn("in_target", F.coalesce("in_target", F.lit(False)))
    return scored.withColumn("score", F.when(F.col("n_tokens") > 0, F.col("score")))


def _totals(coded: DataFrame, places: DataFrame, hashes):
    """Size of the vocabulary with the unknown class and the start sign, tokens of (background, target)."""
    import numpy as np

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, rare in zip(batch["ids"], batch["rare"]):
                words = np.unique(_keys(ids, rare, hashes.value))
                yield pd.DataFrame({"word": words[words != UNKNOWN].view(np.int64)})

    size = coded.select("ids", "rare").mapInPandas(count, "word long").distinct().count() + 2
    tokens = coded.select(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).agg(F.sum("n")).first()[0]
    return size, (float(tokens or 0), float(places.agg(F.sum("n")).first()[0] or 0))


def op9_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` scored; target: those labelled of good quality and not toxic, background: all."""
    good = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")) \
        .where("q = 1 and coalesce(t, 0) = 0")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


ORACLE_OP9 = r"""
WITH good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND coalesce(max(toxic), 0) = 0),
d AS (SELECT doc_id, doc_id IN (SELECT doc_id FROM good) AS in_target,
             regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ws FROM documents),
t AS (SELECT doc_id, in_target, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
b AS (SELECT doc_id, in_target, w, coalesce(lag(w) OVER (PARTITION BY doc_id ORDER BY i), '') AS h FROM t),
pair AS (SELECT h, w, count(*) AS n, count(*) FILTER (WHERE in_target) AS t FROM b GROUP BY h, w),
history AS (SELECT h, sum(n) AS n, sum(t) AS t FROM pair GROUP BY h),
single AS (SELECT w, sum(n) AS n, sum(t) AS t FROM pair GROUP BY w),
total AS (SELECT sum(n) AS n, sum(t) AS t, count(*) + 2 AS v FROM single),
loss AS (SELECT h, w, ln(0.7::DOUBLE * pair.n / greatest(history.n, 1) + 0.3::DOUBLE * (single.n + 1) / (total.n + v))
                    - ln(0.7::DOUBLE * pair.t / greatest(history.t, 1) + 0.3::DOUBLE * (single.t + 1) / (total.t + v)) AS x
         FROM pair JOIN history USING (h) JOIN single USING (w), total),
s AS (SELECT doc_id, avg(x) AS score FROM b JOIN loss USING (h, w) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_tokens, score, in_target FROM d LEFT JOIN s USING (doc_id)
"""
