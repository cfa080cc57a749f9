"""Token totals by source, language and tokenizer version, maintained from signed changes.

A change is an insert (+1 document, +n tokens), a delete (-1, -n) or a revised count (0, new - old). Totals are
sums, so they follow from the changes alone: ``commit`` adds one batch up to one row per group and writes it
below the rollup's folder; a batch is committed when its success marker is there. Committing an id again does nothing,
a batch that was cut off by a failure is written anew, so a replayed feed changes nothing. ``totals`` adds up the
committed batches; ``compact`` folds them into one snapshot that remembers their ids.

Each batch is combined before its one shuffle, so a source with a third of all rows is one row per task there.

Defined results: null source, language or version are groups of their own; null counts count as 0; a group whose documents
and tokens are both 0 is left out; an empty batch can be committed and changes nothing; a row that is delivered
twice inside one batch counts twice (batches, not rows, are idempotent); further columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moundlake.llm.common import exists, put_down, remove, shared_path, table, text_or_empty

GROUP = ["source", "lang", "version"]
#: Tokenizer versions counted with Spark's own expressions: runs without white space; words and single signs.
SPACE_1 = r"[^\x20\x09-\x0D]+"
WORD_1 = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"


def count_matches(pattern: str):
    return lambda text: F.regexp_count(text, F.lit(pattern)).cast("long")


def bpe_counter(spark: SparkSession, path: str):
    """A counter of byte-level BPE tokens, for a tokenizer version of that vocabulary file."""
    from moundlake.llm.bpe import ForcedBoundaryBpe, vocabulary
    spec = vocabulary(spark, path)

    @F.pandas_udf("long")
    def count(text: pd.Series) -> pd.Series:
        bpe = ForcedBoundaryBpe(spec.value)
        return text.map(lambda t: len(bpe.encode(t)))

    return count


def inserts(rows: DataFrame, tokens: Column, version: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(1).alias("docs"), tokens.alias("tokens"))


def deletes(rows: DataFrame, tokens: Column, version: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(-1).alias("docs"), (-tokens).alias("tokens"))


def revisions(rows: DataFrame, old: Column, new: Column, version: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(0).alias("docs"), (new - old).alias("tokens"))


class TokenRollup:
    """Totals kept in a folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _batch(self, batch_id: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
            raise ValueError(f"batch id {batch_id!r}: letters, digits, '_', '.' and '-' only")
        return f"{self.path}/batches/{batch_id}"

    def _list(self, below: str) -> list[str]:
        """Names of the finished folders below ``below``."""
        if not exists(self.spark, f"{self.path}/{below}"):
            return []
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}")
        found = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p)
        return sorted(s.getPath().getName() for s in found if exists(self.spark, f"{s.getPath().toString()}/_SUCCESS"))

    def _snapshot(self) -> str | None:
        done = self._list("snapshots")
        return f"{self.path}/snapshots/{done[-1]}" if done else None

    def _folded(self) -> set[str]:
        at = self._snapshot()
        return {r.batch for r in self.spark.read.parquet(f"{at}/folded").collect()} if at else set()

    def committed(self, batch_id: str) -> bool:
        return exists(self.spark, f"{self._batch(batch_id)}/_SUCCESS") or batch_id in self._folded()

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of (source, lang, version, docs, tokens); False if that id was committed before."""
        if self.committed(batch_id):
            return False
        summed = changes.groupBy(*GROUP).agg(
            F.sum(F.coalesce("docs", F.lit(0)).cast("long")).alias("docs"),
            F.sum(F.coalesce("tokens", F.lit(0)).cast("long")).alias("tokens"))
        summed.write.mode("overwrite").parquet(self._batch(batch_id))
        return True

    def _parts(self) -> tuple[list[DataFrame], list[str]]:
        folded, at = self._folded(), self._snapshot()
        fresh = [b for b in self._list("batches") if b not in folded]
        kind = "source string, lang string, version string, docs long, tokens long"
        read = lambda p: self.spark.read.schema(kind).parquet(p)
        return ([read(f"{at}/totals")] if at else []) + [read(self._batch(b)) for b in fresh], fresh

    def totals(self) -> DataFrame:
        return self._summed(self._parts()[0])

    def _summed(self, parts: list[DataFrame]) -> DataFrame:
        kind = "source string, lang string, version string, docs long, tokens long"
        rows = self.spark.createDataFrame([], kind)
        for p in parts:
            rows = rows.union(p.select(*GROUP, "docs", "tokens"))
        return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")) \
            .where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Fold everything committed so far into a new snapshot, then remove what it holds. A batch committed meanwhile is in neither
        and stays as it is."""
        old, folded = self._snapshot(), self._folded()
        parts, fresh = self._parts()
        if not fresh:
            return
        at = f"{self.path}/snapshots/{int(old.rsplit('/', 1)[1]) + 1 if old else 0:08d}"
        self._summed(parts).write.mode("overwrite").parquet(f"{at}/totals")
        self.spark.createDataFrame([(b,) for b in sorted(folded | set(fresh))], "batch string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{at}/folded")
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(fs_path).close()  # the snapshot counts from here
        for b in fresh:
            remove(self.spark, self._batch(b))
        if old:
            remove(self.spark, old)


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all ``documents`` under two tokenizer versions after four commits: everything is inserted; documents
    labelled low quality are deleted; labelled toxic ones get revised counts (their signs are removed); the deletes are delivered
    again and change nothing."""
    text = text_or_empty()
    space, word = count_matches(SPACE_1), count_matches(WORD_1)
    bare = F.regexp_replace(text, r"[^\p{L}\p{N}\x20\x09-\x0D]+", " ")
    docs = put_down(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", space(text).alias("space"), word(text).alias("word"),
        space(bare).alias("bare_space"), word(bare).alias("bare_word")), "token-counts")
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marked = docs.join(marks, "doc_id")
    low, toxic = marked.where("quality = 0"), marked.where("toxic = 1 and not coalesce(quality = 0, false)")
    c = F.col
    rollup = TokenRollup(spark, shared_path(spark, "token-rollup"))
    rollup.commit("load", inserts(docs, c("space"), "space-1").union(inserts(docs, c("word"), "word-1")))
    dropped = deletes(low, c("space"), "space-1").union(deletes(low, c("word"), "word-1"))
    rollup.commit("drop", dropped)
    rollup.compact()
    rollup.commit("revise", revisions(toxic, c("space"), c("bare_space"), "space-1")
                  .union(revisions(toxic, c("word"), c("bare_word"), "word-1")))
    rollup.commit("drop", dropped)
    return rollup.totals()


ORACLE_OP8 = r"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t,
             regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}\x20\x09-\x0D]+', ' ', 'g') AS bare FROM documents),
m AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
x AS (SELECT source, lang, CASE WHEN toxic = 1 THEN bare ELSE t END AS t FROM d LEFT JOIN m USING (doc_id)
      WHERE coalesce(quality, 1) <> 0)
SELECT source, lang, version, count(*)::BIGINT AS docs, sum(len(regexp_extract_all(t, pattern)))::BIGINT AS tokens
FROM x, (VALUES ('space-1', '[^\x20\x09-\x0D]+'), ('word-1', '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]')) v(version, pattern)
GROUP BY source, lang, version
"""
