"""Temperature mixing of sources.

A source's weight is its token share raised to an exponent in [0, 1] (1: natural shares, 0: equal
shares), normalised. The exponent is found by repeated sectioning of [0, 1] in steps of a millionth:

* ``target="entropy"``: the largest exponent whose weights have at least the wanted entropy;
* ``target="repeats"``: the smallest exponent at which no source is read more than ``limit`` times.

The budget is the smallest one that reads every source at least once, so no row is lost: the source with the
lowest ratio is read once, the others (share ** (exponent - 1), relative) times. A source's stream is a series
of epochs; each epoch is a permutation of the source's blocks (about ``block_rows`` rows, chosen by hash), rows inside
a block permuted as well; the last epoch is cut at the source's token budget, before the row that would exceed it.
``mix_key`` (tokens before the row / source's budget) orders the streams of all sources into one mixed stream.

DataFrame operations only. A hot source is split into its blocks; cumulated tokens come from a window over
the blocks of a source (one small row each) and one over the rows of a block; blocks that null or repeated ids
overfill are cut by the place of their rows, so no block is longer than a few times ``block_rows``. The exponent search reads the table of
source totals and returns at most 101 rows a round to the driver.

Defined results: a null source is a source of its own; a null or empty text has no tokens and takes part in every
epoch of its source; a source without tokens is read once; repeated rows are separate rows; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from moundlake.llm.common import drop_table, put_down, table, text_or_empty, with_locator

STEPS = 1_000_000
SECTIONS = 100
BLOCK_ROWS = 1000
CROWDED = 4  # a block this many times as long as wanted is cut by the rows' places


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _unit(*parts) -> Column:
    """A whole number of 48 bits from the MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 12), 16, 10).cast("long")


def _power(tokens: Column, k: Column) -> Column:
    return F.pow(tokens.cast("double"), k / F.lit(float(STEPS)))


def find_exponent(totals: DataFrame, target: str, wanted: float) -> int:
    """The exponent in millionths, from (src, tokens)."""
    some = totals.where("tokens > 0")
    # entropy falls and the largest ratio falls as the exponent grows: look for the last (first) k that holds
    entropy = target == "entropy"

    def holds(ks: list[int]) -> dict[int, bool]:
        grid = some.withColumn("k", F.explode(F.array(*map(F.lit, ks))))  # a row per source and candidate
        if entropy:
            w = grid.withColumn("p", _power(F.col("tokens"), F.col("k")))
            seen = w.groupBy("k").agg((F.log(F.sum("p")) - F.sum(F.col("p") * F.log("p")) / F.sum("p")).alias("x"))
            return {r.k: r.x >= wanted for r in seen.collect()}
        seen = grid.groupBy("k").agg((F.pow(F.max("tokens") / F.min("tokens"), 1 - F.col("k") / F.lit(float(STEPS)))).alias("x"))
        return {r.k: r.x <= wanted for r in seen.collect()}

    low, high = 0, STEPS
    while True:
        step = max(1, -(-(high - low) // SECTIONS))
        ks = sorted({*range(low, high, step), high})
        found = holds(ks)
        if not found:
            return STEPS
        good = [k for k in ks if found[k]]
        if not good:
            return 0 if entropy else STEPS
        if step == 1:
            return max(good) if entropy else min(good)
        if entropy:
            low, high = max(good), min([k for k in ks if k > max(good)], default=max(good))
        else:
            low, high = max([k for k in ks if k < min(good)], default=min(good)), min(good)
        if low == high:
            return low


def entropy_between(totals: DataFrame, fraction: float) -> float:
    """The entropy at this fraction of the way from the natural shares to equal shares."""
    r = totals.where("tokens > 0").agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.log("tokens")).alias("s"),
                                       F.log(F.count(F.lit(1))).alias("most")).first()
    if not r.t:
        return 0.0
    from math import log
    natural = log(r.t) - r.s / r.t
    return natural + fraction * (r.most - natural)


def mix_sources(docs: DataFrame, target: str = "repeats", limit: float = 4.0, fraction: float = 0.5, seed: int = 7,
                source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per reading of a row: doc_id, source, file, row (its place in ``docs``), n_tokens, epoch, block,
    token_start, mix_key, exponent. ``limit`` holds for ``target="repeats"``, ``fraction`` for ``"entropy"``."""
    return _mix(with_locator(docs), target, limit, fraction, seed, source_col, id_col, text_col, block_rows)


def _crowded(sums: DataFrame, plan: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of more than ``CROWDED`` times the wanted rows, with the number of parts each is cut into and the number of its first
    part, after the source's last block."""
    parts = F.ceil(F.col("block_size") / block_rows).cast("int")
    earlier = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per crowded block
    return sums.where(F.col("block_size") > CROWDED * block_rows).join(plan.select("src", "blocks"), "src").select(
        "src", "block", parts.alias("parts"), (F.col("blocks") + F.coalesce(F.sum(parts).over(earlier), F.lit(0))).cast("int").alias("first_part"))


def _split(placed: DataFrame, crowded: DataFrame) -> DataFrame:
    """Rows of crowded blocks move to one of its parts by a hash of their place. Rows meet a block's line over salted copies, so that a
    block of any size is spread over many tasks."""
    salts = 64
    lines = crowded.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = placed.withColumn("salt", F.pmod(F.xxhash64("row", "file"), F.lit(salts)).cast("int"))
    part = F.col("first_part") + F.pmod(F.xxhash64("file", "row"), F.col("parts")).cast("int")
    return rows.join(lines, ["src", "block", "salt"], "left").withColumn(
        "block", F.coalesce(part, F.col("block"))).drop("salt", "parts", "first_part")


def _mix(located: DataFrame, target: str, limit: float, fraction: float, seed: int, source_col: str, id_col: str,
         text_col: str, block_rows: int) -> DataFrame:
    source = F.col(f"`{source_col}`").cast("string")
    rows = put_down(located.select(
        F.col(f"`{id_col}`").alias("doc_id"), source.alias("source"),
        F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), source)).alias("src"),
        F.col("_llm_file").alias("file"), F.col("_llm_row").alias("row"),
        word_count(text_or_empty(f"`{text_col}`")).alias("n_tokens")), "mix-rows")
    totals = put_down(rows.groupBy("src").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")), "mix-totals")
    wanted = limit if target == "repeats" else entropy_between(totals, fraction)
    k = find_exponent(totals, target, wanted)
    exponent = k / STEPS

    most = totals.agg(F.max("tokens").alias("most"))
    plan = totals.crossJoin(F.broadcast(most)).select(  # one row beside the totals
        "src", "tokens", F.greatest(F.lit(1), F.ceil(F.col("n_rows") / block_rows)).cast("int").alias("blocks"),
        F.when(F.col("tokens") > 0, F.floor(
            F.col("tokens") * F.pow(F.col("most").cast("double") / F.col("tokens"), F.lit(1.0 - exponent))))
        .otherwise(0).cast("long").alias("budget"))
    plan = put_down(plan.withColumn("budget", F.greatest("budget", "tokens")).withColumn(
        "epochs", F.when(F.col("tokens") > 0, F.ceil(F.col("budget") / F.greatest("tokens", F.lit(1)))).otherwise(1).cast("int")), "mix-plan")

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    placed = rows.join(plan.select("src", "blocks"), "src").withColumn(
        "block", F.pmod(_unit(F.lit(str(seed)), key), F.col("blocks")).cast("int")).drop("blocks")
    totals_of = lambda d: put_down(d.groupBy("src", "block").agg(
        F.sum("n_tokens").alias("block_tokens"), F.count(F.lit(1)).alias("block_size")), "mix-blocks")
    sums = totals_of(placed)
    crowded = put_down(_crowded(sums, plan, block_rows), "mix-crowded")
    if not crowded.isEmpty():  # null or repeated ids fall into one block
        placed = put_down(_split(placed, crowded), "mix-placed")
        drop_table(sums)
        sums = totals_of(placed)
    sums = sums.drop("block_size")
    epochs = sums.join(plan, "src").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    order = Window.partitionBy("src", "epoch").orderBy(
        _unit(F.lit(str(seed)), F.col("src"), F.col("epoch"), F.lit("b"), F.col("block")), "block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    turns = put_down(epochs.withColumn("before", F.coalesce(F.sum("block_tokens").over(order), F.lit(0))
                                       + F.col("epoch") * F.col("tokens"))
                     .where("before < budget or tokens = 0 or (epoch = 0)")
                     .select("src", "block", "epoch", "before", "budget"), "mix-turns")
    inside = Window.partitionBy("src", "block", "epoch").orderBy(
        _unit(F.lit(str(seed)), F.col("src"), F.col("epoch"), F.lit("d"), key), "doc_id", "n_tokens", "file", "row") \
        .rowsBetween(Window.unboundedPreceding, -1)
    read = placed.join(turns, ["src", "block"]).withColumn(
        "token_start", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return read.where("epoch = 0 or token_start + n_tokens <= budget").select(
        "doc_id", "source", "file", "row", "n_tokens", "epoch", "block", "token_start",
        F.when(F.col("budget") > 0, F.col("token_start") / F.col("budget")).otherwise(0.0).alias("mix_key"),
        F.lit(exponent).alias("exponent"))


def mixed_rows(docs: DataFrame, limit: float = 2.0, seed: int = 7) -> DataFrame:
    """``docs`` with each row as often as the mix reads it, all columns: every row at least once, none more than
    ``limit`` times, rounded up."""
    located = with_locator(docs)
    read = _mix(located, "repeats", limit, 0.0, seed, "source", "doc_id", "text", BLOCK_ROWS)
    times = read.groupBy("file", "row").agg(F.count(F.lit(1)).cast("int").alias("_llm_times")) \
        .withColumnsRenamed({"file": "_llm_file", "row": "_llm_row"})
    return located.join(times, ["_llm_file", "_llm_row"]) \
        .withColumn("_llm_time", F.explode(F.sequence(F.lit(1), F.col("_llm_times")))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to an entropy half way between natural and equal shares of their sources."""
    return mix_sources(table(spark, sf_dir, "documents"), target="entropy", fraction=0.5).select(
        "doc_id", "source", "n_tokens", "epoch", "block", "token_start", F.round("mix_key", 9).alias("mix_key"), "exponent")


ORACLE_OP6 = r"""
WITH r AS (SELECT doc_id, source, 'v' || source AS src,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
t AS (SELECT src, sum(n_tokens)::BIGINT AS tokens, greatest(1, ceil(count(*) / 1000))::INT AS blocks FROM r GROUP BY src),
goal AS (SELECT ln(sum(tokens)) - sum(tokens * ln(tokens)) / sum(tokens) AS plain, ln(count(*)) AS even FROM t),
h AS (SELECT k, ln(sum(p)) - sum(p * ln(p)) / sum(p) AS x
      FROM (SELECT k, pow(tokens::DOUBLE, k / 1000000.0::DOUBLE) AS p FROM t, range(0, 1000001) g(k)) GROUP BY k),
e AS (SELECT coalesce(max(k), 0) / 1000000.0::DOUBLE AS exponent FROM h, goal WHERE x >= plain + 0.5 * (even - plain)),
plan AS (SELECT src, tokens, blocks, greatest(tokens, floor(tokens * pow((SELECT max(tokens) FROM t)::DOUBLE / tokens,
           1.0::DOUBLE - exponent)))::BIGINT AS budget, exponent FROM t, e),
placed AS (SELECT r.*, blocks, (('0x' || substr(md5('7|' || doc_id), 1, 12))::BIGINT % blocks)::INT AS block
           FROM r JOIN plan USING (src)),
sums AS (SELECT src, block, sum(n_tokens) AS block_tokens FROM placed GROUP BY 1, 2),
turns AS (SELECT src, block, epoch, tokens, budget, exponent, epoch * tokens + coalesce(sum(block_tokens) OVER (
            PARTITION BY src, epoch ORDER BY ('0x' || substr(md5('7|' || src || '|' || epoch || '|b|' || block), 1, 12))::BIGINT, block
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM (SELECT *, unnest(range(0, ceil(budget / tokens)::BIGINT))::INT AS epoch FROM sums JOIN plan USING (src))),
read AS (SELECT doc_id, source, n_tokens, epoch, block, budget, exponent, before + coalesce(sum(n_tokens) OVER (
            PARTITION BY src, block, epoch
            ORDER BY ('0x' || substr(md5('7|' || src || '|' || epoch || '|d|' || doc_id), 1, 12))::BIGINT, doc_id, n_tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS token_start
         FROM placed JOIN turns USING (src, block))
SELECT doc_id, source, n_tokens, epoch, block, token_start::BIGINT AS token_start,
       round(token_start / budget, 9) AS mix_key, exponent
FROM read WHERE epoch = 0 OR token_start + n_tokens <= budget
"""
