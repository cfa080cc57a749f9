"""The prefix trie of conversations by fixed-length block hashing.

A conversation is cut into blocks of ``BLOCK`` turns. Conversations are grouped by their successive block digests first: one
row per conversation and block becomes one row per distinct run of blocks, with the number of its members and the smallest. Only where
siblings diverge (a run of blocks that continues in two or more ways) are the turns inside the next blocks looked at: the distinct
blocks, not the conversations, are spread into their turn prefixes and grouped again. Everywhere else the turns of a block are a chain
whose nodes all have the block's members.

The digest of a run of blocks is the sum of the digests of its blocks, each tagged with its place: four sums of 32-bit numbers, so 128
bits and no overflow below 2^31 blocks. All prefixes of all conversations come from one running sum, without a round per level;
the sum runs over spans of ``SPAN`` blocks and over the span totals, so a very long conversation is many tasks. Equal digests are taken
as equal runs (false with probability below n^2 / 2^129 for n distinct runs).

Nothing is summed up the tree. A conversation owns the nodes whose smallest member it is: a tail of its turns. With A(c) the bytes of the
turns c does not own, the bytes that sharing saves below a node v of depth d are

    sum of A(c) over the members of v  -  A(v's owner)  -  (members - 1) * bytes of the first d - 1 turns,

and its leaves are the members that own a childless node; both are sums over members, grouped exactly like the counts.

The list of the members that end at a node is hashed in order and has no bound: rows are range partitioned on (node, id), runs
of ids become texts of bounded length, and one stream per node hashes those.

Defined results: rows without conv_id belong to no conversation and are left out; a null turn comes first; rows of equal turn are ordered by
the digest of role and text; null role or text is empty; an empty table has no nodes; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pyspark.sql import Window

from moundlake.llm.common import put_down, table
from moundlake.operators.sequence import row_numbers

#: Turns in a block; blocks in a span of the running sums.
BLOCK, SPAN = 4, 1024
#: Ids in one text of the ordered lists that are hashed.
RUN = 4096
#: Copies of a shared node that its children are dealt over when they look up their parent.
SALTS = 8
#: Turns of the other conversation that the query's branches can start with.
MOST_SHARED = 8

LANES = ("s0", "s1", "s2", "s3")
BEFORE = ("p0", "p1", "p2", "p3")


def numbered_turns(df: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, bytes): the turns of each conversation from 1, with the digest of (role, text) and the bytes of the text."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.unhex(F.substring(F.sha2(both.cast("binary"), 256), 1, 32)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    return row_numbers(rows, ["conv_id"], ["turn", "digest"], "pos").select("conv_id", "pos", "digest", "bytes")


def branched(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's conversations: c starts with the first h = crc32(c) % 9 turns of conversation c - c % 5 and goes on with its own
    turns after its first h. Returns (turns, all conversation ids)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    heads = (turns.where(F.col("pos") <= MOST_SHARED).groupBy(F.col("conv_id").alias("base"))  # at most eight a group
             .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head")))
    convs = (turns.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
             .select("conv_id", h.alias("h"), F.coalesce("head", F.expr("array()").cast(heads.schema["head"].dataType)).alias("head"))
             .withColumn("taken", F.least(F.col("h"), F.size("head").cast("long"))))
    convs = put_down(convs, "branches")
    first = convs.select("conv_id", F.explode(F.slice("head", F.lit(1), F.col("taken").cast("int"))).alias("t")).select("conv_id", "t.*")
    own = (turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where(F.col("pos") > F.col("h"))
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "bytes"))
    return put_down(first.unionByName(own), "branched-turns"), convs.select("conv_id")


def _two_hashes(*cols: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *cols) for seed in (1, 2)]


def block_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: k, size, turns, s0-s3 (digest sums up to and with the block), p0-p3 (before it) and
    cum (bytes before it)."""
    k = F.floor((F.col("pos") - 1) / BLOCK)
    rows = turns.select("conv_id", k.alias("k"), F.floor(k / SPAN).alias("span"), "pos", "digest", "bytes")
    rows = rows.repartition("conv_id", "span")  # serves the blocks, the span totals and the windows
    blocks = (rows.groupBy("conv_id", "span", "k")  # at most BLOCK turns a group
              .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns")))
    one, two = _two_hashes(F.col("k"), F.col("turns.digest"))
    low = F.lit((1 << 32) - 1).cast("long")
    blocks = blocks.select(
        "conv_id", "span", "k", "turns", F.size("turns").alias("size"), F.aggregate("turns.bytes", F.lit(0).cast("long"), lambda a, b: a + b).alias("w"),
        *[x.alias(n) for n, x in zip(LANES, (F.shiftrightunsigned(one, 32), one.bitwiseAND(low), F.shiftrightunsigned(two, 32), two.bitwiseAND(low)))])
    sums = [*LANES, "w"]
    spans = blocks.groupBy("conv_id", "span").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "span", *[F.sum(c).over(earlier).alias(f"_{c}") for c in sums]).where("span > 0")
    inside = Window.partitionBy("conv_id", "span").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    out = blocks.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_in_{c}") for c in sums]).join(spans, ["conv_id", "span"], "left")
    before = {c: F.col(f"_in_{c}") + F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in sums}
    return out.select("conv_id", "k", "size", "turns", before["w"].alias("cum"), *[before[c].alias(p) for c, p in zip(LANES, BEFORE)],
                      *[(before[c] + F.col(c)).alias(c) for c in LANES])


def node_rows(distinct: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """The nodes of distinct blocks: depth, x, y (their key), up_x, up_y (their parent's), conv_id (the smallest member) and the summed measures,
    the node's bytes and the bytes before it. ``distinct`` has the flag ``alone``: no sibling block diverges from it."""
    j = F.col("j")
    prefix = F.slice(F.col("turns.digest"), F.lit(1), j)
    spread = distinct.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("size"))))
    whole = j == BLOCK
    here, up = F.col("k") * BLOCK + j, F.col("k") * BLOCK + j - 1
    # a node that ends a block is known by the sums with the block, a node inside by the sums before it and the turns since
    at_end, inside = _two_hashes(here, *LANES), _two_hashes(here, *BEFORE, prefix)
    up_end, up_inside = _two_hashes(up, *BEFORE), _two_hashes(up, *BEFORE, F.slice(F.col("turns.digest"), F.lit(1), j - 1))
    turn = F.element_at("turns", j)
    spread = spread.select(
        "alone", "conv_id", *measures, here.alias("depth"),
        *[F.when(whole, e).otherwise(i).alias(n) for n, e, i in zip("xy", at_end, inside)],
        *[F.when(j == 1, e).otherwise(i).alias(f"up_{n}") for n, e, i in zip("xy", up_end, up_inside)],
        turn["bytes"].alias("bytes"),
        (F.col("cum") + F.aggregate(F.slice(F.col("turns.bytes"), F.lit(1), j - 1), F.lit(0).cast("long"), lambda a, b: a + b)).alias("before"))
    key = ["depth", "x", "y", "up_x", "up_y", "bytes", "before"]
    chains = spread.where("alone").select(*key, "conv_id", *measures)
    parted = spread.where("NOT alone").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), *[F.sum(m).alias(m) for m in measures])
    return chains.unionByName(parted)


def ordered_digests(ends: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256): SHA-256 of the decimal conv_ids of each node in numerical order, joined by commas."""
    import pyarrow as pa
    key = ["depth", "x", "y"]
    run_schema = "depth long, x long, y long, first long, run string"

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, x, y, ids = (batch.column(i).to_pylist() for i in range(4))
            out, lo = [], 0
            for hi in range(1, len(ids) + 1):
                if hi == len(ids) or hi - lo == RUN or (d[hi], x[hi], y[hi]) != (d[lo], x[lo], y[lo]):
                    out.append((d[lo], x[lo], y[lo], ids[lo], ",".join(map(str, ids[lo:hi]))))
                    lo = hi
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.string())],
                                             names=[*key, "first", "run"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        at, state, done = None, None, []

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], pa.int64()) for i in range(3)]
                                             + [pa.array([r[3] for r in done], pa.string())], names=[*key, "ends_sha256"])
            done.clear()
            return out
        for batch in batches:
            for *node, _, run in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if node == at:
                    state.update(b"," + run.encode())
                    continue
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = node, hashlib.sha256(run.encode())
            yield flush()
        if at is not None:
            done.append((*at, state.hexdigest()))
        yield flush()

    rows = ends.select(*key, "conv_id")
    texts = rows.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(runs, run_schema)
    return (texts.repartition(*key).sortWithinPartitions(*key, "first")
            .mapInArrow(hashes, "depth long, x long, y long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv_id, pos gapless from 1, digest, bytes); ``conversations`` lists every conv_id, turnless ones too.

    One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = put_down(block_rows(turns), "blocks")
    run = ["k", *LANES]
    # 1. distinct runs of blocks, whatever the number of conversations that share them
    groups = put_down(blocks.groupBy(*run).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("size").alias("size"), F.first("turns").alias("turns"),
        F.first("cum").alias("cum"), *[F.first(p).alias(p) for p in BEFORE]), "block-groups")
    only = (groups.groupBy("k", *BEFORE).agg(F.count(F.lit(1)).alias("ways"), F.min("conv_id").alias("conv_id"))
            .where("ways = 1").select("conv_id", "k", F.lit(True).alias("alone")))
    groups = put_down(groups.join(only, ["conv_id", "k"], "left").withColumn("alone", F.coalesce("alone", F.lit(False))), "block-siblings")
    # 2. nodes; their parents' owners: a node with one member has its own owner above it as long as nothing else is found
    nodes = put_down(node_rows(groups, ("n_convs",)), "trie-nodes")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("conv_id IS NOT NULL")
    root = root.select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "conv_id", "n_convs",
                       F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("parent_conv_id"))
    above = (nodes.where("n_convs > 1").select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"),
                                               F.col("conv_id").alias("_above"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    below = nodes.where("depth > 1").withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    placed = below.join(above, ["depth", "up_x", "up_y", "salt"], "left").withColumn("parent_conv_id", F.coalesce("_above", "conv_id"))
    columns = ["depth", "x", "y", "conv_id", "n_convs", "bytes", "before", "parent_conv_id"]
    tops = nodes.where("depth = 1").crossJoin(F.broadcast(root.select(F.col("conv_id").alias("parent_conv_id"))))  # one row
    nodes = put_down(placed.select(*columns).unionByName(tops.select(*columns)).unionByName(root.select(*columns)), "trie-placed")
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = put_down(nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")
    # 3. what each conversation brings to every node it passes
    owned = nodes.groupBy("conv_id").agg(F.sum("bytes").alias("own"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"))
    totals = turns.groupBy("conv_id").agg(F.sum("bytes").alias("all"), F.count(F.lit(1)).alias("turns"))
    convs = conversations.join(totals, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("turns", F.lit(0)).alias("turns"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
        (F.coalesce("all", F.lit(0)) - F.coalesce("own", F.lit(0))).alias("others"))
    convs = put_down(convs, "conversations")
    # 4. summed over members like the counts
    passing = blocks.select("conv_id", "size", "turns", *BEFORE, *run).withColumnRenamed("turns", "block").join(convs, "conv_id")
    sums = passing.groupBy(*run).agg(F.sum("others").alias("others"), F.sum("leaf").alias("leaf"))
    sums = node_rows(groups.join(sums, run), ("others", "leaf")).select("depth", "x", "y", "others", "leaf")
    sums = sums.unionByName(convs.agg(F.sum("others").alias("others"), F.sum("leaf").alias("leaf")).select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "others", "leaf"))
    # 5. who ends where
    last = F.col("k") * BLOCK + F.col("size")
    at_end, inside = _two_hashes(last, *LANES), _two_hashes(last, *BEFORE, F.col("block.digest"))
    ends = passing.where(last == F.col("turns")).select(
        last.alias("depth"), *[F.when(F.col("size") == BLOCK, e).otherwise(i).alias(n) for n, e, i in zip("xy", at_end, inside)], "conv_id")
    ends = ends.unionByName(convs.where("turns = 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "conv_id"))
    key = ["depth", "x", "y"]
    out = (nodes.join(sums, key).join(ordered_digests(ends), key, "left")
           .join(convs.select("conv_id", F.col("others").alias("_owner")), "conv_id"))
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaf").alias("n_leaves"),
        (F.col("others") - F.col("_owner") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations (contract of operator 13)."""
    turns, convs = branched(numbered_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(turns, convs)


ORACLE_OP13 = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS m FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(m ORDER BY pos) AS ms FROM t GROUP BY conv_id),
hs AS (  -- CRC-32 of the decimal id, a byte at a time
  SELECT conv_id, ms, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda v, i: xor(v >> 1, 3988292384::BIGINT * (v & 1)))),
    4294967295::BIGINT) % 9 AS h FROM own),
r AS (SELECT c.conv_id, list_concat(coalesce(b.ms, [])[1:c.h], c.ms[c.h + 1:]) AS ms
      FROM hs c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
pre AS (SELECT conv_id, d, ms[1:d] AS p, len(ms) AS total FROM (SELECT conv_id, ms, unnest(range(len(ms) + 1)) AS d FROM r)),
nodes AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = d) AS ends
          FROM pre GROUP BY d, p),
kids AS (SELECT a.d, a.p, count(b.d) AS n_children, any_value(u.conv_id) AS parent
         FROM nodes a LEFT JOIN nodes b ON b.d = a.d + 1 AND b.p[1:a.d] = a.p LEFT JOIN nodes u ON u.d = a.d - 1 AND u.p = a.p[1:a.d - 1]
         GROUP BY a.d, a.p),
full_nodes AS (SELECT n.*, k.n_children, k.parent, (n.n - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(p[d].t) END AS saved
               FROM nodes n JOIN kids k USING (d, p)),
below AS (SELECT v.d, v.p, sum(u.saved)::BIGINT AS saved, count(*) FILTER (WHERE u.n_children = 0) AS leaves
          FROM full_nodes v JOIN full_nodes u ON u.d >= v.d AND u.p[1:v.d] = v.p GROUP BY v.d, v.p)
SELECT conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs, n_children, leaves AS n_leaves, below.saved AS saved_tokens,
       sha256(coalesce(ends, '')) AS ends_sha256
FROM full_nodes JOIN below USING (d, p)
"""
