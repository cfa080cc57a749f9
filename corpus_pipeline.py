"""A training corpus from ``documents``: toxic texts go, exact copies go, one of each group of near copies stays, sources
are mixed by temperature, and what is left is encoded with byte-level BPE and decoded again.

Each stage works on everything its predecessor kept, written as Parquet and read back. Stages but the last return
the columns of ``documents`` (and whatever further columns came with them), rows unchanged; the mixing stage returns each row as
often as the mix reads it, at least once. The last returns doc_id, source, ids, n_tokens, ids_sha256 and decoded_sha256.

Defined results: null and empty texts pass the first stage, are copies of each other in the second, link with nothing in the
third, are read with their source in the fourth and have no ids in the last; empty tables give no rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from moundlake.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from moundlake.llm.common import put_down, table

#: No source is read more often than this.
MOST_REPEATS = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents whose expected severity reaches the rejection mark go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of texts linked by Jaccard similarity of at least 0.8 one stays."""
    return jaccard_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: sources mixed at the flattest temperature that reads none more than twice."""
    return mixing.mixed_rows(docs, limit=MOST_REPEATS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the ids of every text, and digests of the ids and of the text decoded from them."""
    coded = bpe.encode_decode(docs, bpe.tokenizer_path(), keep=("doc_id", "source"))
    return coded.select(
        "doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix),
    ("BPE", encode),
]

#: The fitted severity model and the BPE ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = put_down(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
