"""Phrase collocation mining by Toivonen's sampling.

A sample of the documents proposes the phrases that are frequent in it (at a lowered threshold), level by level. One full pass then
counts, exactly and over every text, the proposed phrases and their negative border: every phrase that is not proposed itself although
all its parts are. Here that means: a phrase of k words is counted wherever its first k - 1 and its last k - 1 words are proposed, and
every single word is counted. A border phrase that turns out frequent is a failure of the sample: its extensions were not counted. If there are
any, an expansion pass counts every phrase of up to five words around each of their occurrences (failures are rare and hardly more frequent than the
threshold, so these are few). That closes the search whatever the sample was: a frequent phrase that the first pass did not count
holds a smallest part that was not proposed; all parts of that one were, so the first pass counted it and it is a failure.

A task must know which phrases are proposed. It gets a bitmap of their 64-bit hashes: two bits per phrase, at least sixteen bits per
proposed phrase and at most ``MOST_BITS`` (128 MB), the proven bound of what is broadcast. A false positive only counts more
phrases than needed; it never loses one. Most of the border is rare, and its texts are not worth a shuffle: before the full pass, the occurrences of
proposed and border phrases are added up by slots, the low bits of their hashes (three bytes an occurrence, one slot per eight bytes of
text, at most ``MOST_BITS`` slots). A phrase whose slot stays below the threshold is not frequent, nor is any phrase that holds it, so the full pass leaves
it out; slots shared by several phrases only make it count more. Counting itself is exact: inside a task words are numbered, a phrase is the pair of the
numbers of its two parts, and what leaves the task is the phrase's text.

A task flushes its counts every ``FLUSH`` words, so its memory is bounded; flushed counts are combined before the shuffle, so a hot word is
a row per task.

Defined results: a null text is empty, a null lang is ``und``; repeated rows count each time; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from moundlake.llm.common import put_down, table, text_or_empty

#: Words of the longest phrase; occurrences of a frequent one; phrases reported per language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Share of the documents in the sample; the sample's threshold as a share of what the full threshold is expected to leave in it.
SAMPLE, LOWERED = 0.1, 0.6
#: Bits of the broadcast bitmap: at least BITS_EACH per phrase, between FEWEST_BITS and MOST_BITS.
BITS_EACH, FEWEST_BITS, MOST_BITS = 16, 1 << 16, 1 << 30
#: Bytes of text to a slot of the count before the full pass; slots whose sums are kept together.
BYTES_A_SLOT, SHARD = 8, 1 << 16
#: Words a task holds before it hands its counts on; words it keeps numbered.
FLUSH, WORDS = 1_000_000, 150_000
#: Counts handed on at a time.
ROWS_OUT = 50_000
#: Copies of single words that phrases are dealt over when they look up the counts of their parts.
SALTS = 16

#: What ends a piece and what lies between words.
PIECE_ENDS, BETWEEN_WORDS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: A-Z lower-cased, every end of a piece as a full stop, tabs as spaces; other bytes as they are.
BYTES = bytes(46 if b in PIECE_ENDS else 32 if b in BETWEEN_WORDS else b + 32 if 65 <= b <= 90 else b for b in range(256))

_GOLD, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _word_hash(lang: str):
    import xxhash
    seed = xxhash.xxh32_intdigest(lang.encode())
    return lambda word: xxhash.xxh64_intdigest(word, seed)


def _hashes(phrases: DataFrame) -> DataFrame:
    """The 64-bit hash ``h`` of each phrase (lang, phrase)."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {}
        for batch in batches:
            out = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in of:
                    of[lang] = _word_hash(lang)
                word = of[lang]
                first, *rest = phrase.encode().split(b" ")
                h = word(first)
                for w in rest:  # as Counter._longer
                    x = ((h ^ (h >> 29)) * _GOLD + word(w)) & _ALL
                    h = x ^ (x >> 32)
                out.append(h - (1 << 64) if h >> 63 else h)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["h"])
    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


def bitmap(phrases: DataFrame) -> tuple[int, object]:
    """(bits, words as uint64) of the hashes of ``phrases``: of bounded size whatever the number of phrases."""
    import numpy as np
    n, bits = phrases.count(), FEWEST_BITS
    while bits < MOST_BITS and bits < n * BITS_EACH:
        bits *= 2
    place = F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1))))
    slots = (_hashes(phrases).select(place.alias("at")).groupBy(F.shiftright("at", 6).alias("slot"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("word")))
    out = np.zeros(bits // 64, np.uint64)
    got = slots.toArrow()  # at most bits / 64 rows
    out[got.column("slot").to_numpy()] = got.column("word").to_numpy().view(np.uint64)
    return bits, out


def holds(bits_and_words: tuple[int, object], h) -> object:
    """Which of the hashes ``h`` (uint64 array) the bitmap may hold."""
    import numpy as np
    bits, words = bits_and_words
    mask, six, low, one = np.uint64(bits - 1), np.uint64(6), np.uint64(63), np.uint64(1)

    def at(place):
        return (words[(place >> six).astype(np.int64)] >> (place & low)) & one
    return (at(h & mask) & at((h >> np.uint64(32)) & mask)).astype(bool)


def in_slot(bits_and_words: tuple[int, object], h) -> object:
    """Which of the hashes ``h`` (uint64 array) lie in a slot that is set."""
    import numpy as np
    slots, words = bits_and_words
    place = h & np.uint64(slots - 1)
    return ((words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


class Counter:
    """Counts of the phrases of one language in one task."""

    def __init__(self, lang: str, proposed, fresh, levels: tuple[int, ...], full=None):
        self.lang, self.proposed, self.fresh, self.levels, self.full = lang, proposed, fresh, levels, full
        self.hash = _word_hash(lang)
        self.texts: list = []
        self._new_words()

    def _new_words(self):
        import numpy as np

        class Numbers(dict):
            def __missing__(self, word):
                self[word] = number = len(self)
                return number
        self.number = Numbers()
        self.number[b"."]
        self.spelled: list[bytes] = [b"."]
        self.word_hash = np.zeros(1, np.uint64)

    def add(self, text: str) -> int:
        import numpy as np
        tokens = text.encode().translate(BYTES).replace(b".", b" . ").split(b" ")
        ids = np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        self.texts.append(ids)
        self.texts.append(np.zeros(1, np.int64))  # the end of a text ends a piece
        return len(tokens)

    def _numbers(self):
        """The collected words as numbers (0: end of a piece); empty strings between neighbouring spaces are no words."""
        import numpy as np
        ids = np.concatenate(self.texts)
        empty = self.number.get(b"")
        if empty is not None:
            ids = ids[ids != empty]
        known = len(self.spelled)
        if len(self.number) > known:
            more = list(self.number)[known:]
            self.spelled += more
            hashes = np.fromiter(map(self.hash, more), np.uint64, len(more))
            self.word_hash = np.concatenate([self.word_hash, hashes])
        return ids

    @staticmethod
    def _longer(h, last):
        """Hashes of phrases from those without the last word and of the last word."""
        import numpy as np
        x = (h ^ (h >> np.uint64(29))) * np.uint64(_GOLD) + last
        return x ^ (x >> np.uint64(32))

    def _near_fresh(self, ids):
        """The words of every phrase that may hold a fresh one; gaps become ends of pieces."""
        import numpy as np
        n = len(ids)
        wh = self.word_hash[ids]
        h, inside, mark = wh, ids > 0, np.zeros(n + 1, np.int64)
        for k in range(1, LONGEST):
            if k > 1:
                h = self._longer(h[:-1], wh[k - 1:])
                inside = inside[:-1] & (ids[k - 1:] > 0)
            i = np.flatnonzero(inside & holds(self.fresh, h)) if len(h) else np.zeros(0, np.int64)
            np.add.at(mark, np.maximum(i - (LONGEST - k), 0), 1)
            np.add.at(mark, np.minimum(i + LONGEST, n), -1)
        keep = np.cumsum(mark[:n]) > 0
        out = np.where(keep, ids, 0)
        return out[keep | np.concatenate([[False], keep[:-1]])]

    def flush(self):
        """(phrases, counts) of everything added since the last call, a bounded number at a time."""
        if self.texts:
            ids = self._numbers()
            self.texts = []
            yield from self._count(ids if self.fresh is None else self._near_fresh(ids))
            if len(self.number) > WORDS:
                self._new_words()

    def hashes(self):
        """The hashes of all occurrences of proposed and border phrases of two words and more added since the last call, level by level."""
        import numpy as np
        if not self.texts:
            return
        ids = self._numbers()
        self.texts = []
        wh = self.word_hash[ids]
        known = holds(self.proposed, self.word_hash)
        known[0] = False
        good, h = known[ids], wh
        for k in range(2, LONGEST + 1):
            good = good[:-1] & good[1:]
            at = np.flatnonzero(good)
            if not len(at):
                break
            h = self._longer(h[:-1], wh[k - 1:])
            yield h[at]
            good[at] = holds(self.proposed, h[at])
        if len(self.number) > WORDS:
            self._new_words()

    def _count(self, ids):
        import numpy as np
        spelled = self.spelled
        if 1 in self.levels:
            counts = np.bincount(ids, minlength=len(spelled))
            yield [b""], np.array([counts[1:].sum()])  # all word occurrences
            seen = np.flatnonzero(counts)
            seen = seen[seen > 0]
            for lo in range(0, len(seen), ROWS_OUT):
                some = seen[lo:lo + ROWS_OUT]
                yield [spelled[w] for w in some.tolist()], counts[some]
        wh = self.word_hash[ids]
        if self.fresh is None:
            known = holds(self.proposed, self.word_hash) if max(self.levels) > 1 else np.zeros(len(spelled), bool)
            known[0] = False
            good, new = known[ids], None
        else:
            good = ids > 0
            new = holds(self.fresh, self.word_hash)[ids] & good
        h, number = wh, ids
        for k in range(2, max(self.levels) + 1):  # position i: the phrase of k words that starts there
            both = good[:-1] & good[1:]
            at = np.flatnonzero(both)
            h = self._longer(h[:-1], wh[k - 1:])
            if self.full is not None:  # the rest is not frequent, nor is what holds it
                at = at[in_slot(self.full, h[at])]
            if not len(at):
                break
            pair = (number[at] << 32) | number[at + 1]
            _, first, inverse, n = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
            starts = at[first]
            wanted = np.arange(len(starts)) if new is None else np.flatnonzero(new[starts] | new[starts + 1])
            for lo in range(0, len(wanted) if k in self.levels else 0, ROWS_OUT):
                some = wanted[lo:lo + ROWS_OUT]
                words = [map(spelled.__getitem__, ids[starts[some] + j].tolist()) for j in range(k)]
                yield list(map(b" ".join, zip(*words))), n[some]
            number = np.zeros(len(both), np.int64)
            number[at] = inverse
            if new is None:
                good = np.zeros(len(both), bool)
                good[at] = holds(self.proposed, h[starts])[inverse]
            else:
                good = both
                new = (new[:-1] | new[1:]) & both
                new[at] |= holds(self.fresh, h[starts])[inverse]


def full_slots(texts: DataFrame, proposed, least: int) -> tuple[int, object]:
    """(slots, words as uint64): a bit for each slot of at least ``least`` occurrences of proposed and border phrases in ``texts`` (lang, text)."""
    import numpy as np
    import pyarrow as pa
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = SHARD
    while slots < MOST_BITS and slots * BYTES_A_SLOT < size:
        slots *= 2
    proposed = texts.sparkSession.sparkContext.broadcast(proposed)
    small = np.uint8 if least <= 255 else np.uint32

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}

        def flushed():
            found = [(h & np.uint64(slots - 1)).astype(np.uint32) for c in counters.values() for h in c.hashes()]
            if len(counters) > 64:
                counters.clear()
            if not found:
                return
            slot, n = np.unique(np.concatenate(found), return_counts=True)
            n = np.minimum(n, least).astype(small)  # a sum that reaches ``least`` still does
            shard, start = np.unique(slot // SHARD, return_index=True)
            place, ends = (slot % SHARD).astype(np.uint16), [*start[1:].tolist(), len(slot)]
            for lo in range(0, len(shard), 256):
                cut = list(zip(start[lo:lo + 256].tolist(), ends[lo:lo + 256]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard[lo:lo + 256].astype(np.int32)), pa.array([place[i:j].tobytes() for i, j in cut], pa.binary()),
                    pa.array([n[i:j].tobytes() for i, j in cut], pa.binary())], names=["shard", "places", "n"])

        held = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    if lang not in counters:
                        counters[lang] = Counter(lang, proposed.value, None, ())
                    held += counters[lang].add(text)
                    if held >= FLUSH:
                        yield from flushed()
                        held = 0
        yield from flushed()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a shard come one after another, so a task holds the sums of one shard."""
        shard, sums = None, np.zeros(SHARD, np.int64)

        def done():
            if (sums >= least).any():
                bits = np.packbits(sums >= least, bitorder="little").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([bits], pa.binary())], names=["shard", "bits"])

        for batch in batches:
            for s, places, n in zip(*(batch.column(i) for i in range(3))):
                if s.as_py() != shard:
                    yield from done()
                    shard = s.as_py()
                    sums[:] = 0
                sums[np.frombuffer(places.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), small)
        yield from done()

    got = (texts.mapInArrow(seen, "shard int, places binary, n binary").repartition("shard").sortWithinPartitions("shard")
           .mapInArrow(summed, "shard int, bits binary").toArrow())  # a bit per slot
    out = np.zeros((slots // SHARD, SHARD // 8), np.uint8)
    for shard, bits in zip(got.column("shard").to_pylist(), got.column("bits").to_pylist()):
        out[shard] = np.frombuffer(bits, np.uint8)
    return slots, out.reshape(-1).view(np.uint64)


def count_phrases(texts: DataFrame, levels: tuple[int, ...], proposed=None, fresh=None, full=None) -> DataFrame:
    """Exact counts (lang, k, phrase, n) over ``texts`` (lang, text) of the phrases of ``levels`` words whose parts are in the
    bitmap ``proposed``, but for those outside the slots ``full``; or, with ``fresh``, of all phrases that hold one of that bitmap. The row k = 0
    holds all word occurrences."""
    import pyarrow as pa
    sc = texts.sparkSession.sparkContext
    proposed, fresh, full = (b if b is None else sc.broadcast(b) for b in (proposed, fresh, full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}

        def flushed():
            for c in counters.values():
                mark = b"\t" + c.lang.encode()
                for phrases, n in c.flush():
                    keys = pa.array([p + mark for p in phrases], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64())], names=["key", "n"])
            if len(counters) > 64:
                counters.clear()

        held = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    if lang not in counters:
                        counters[lang] = Counter(lang, proposed and proposed.value, fresh and fresh.value, levels, full and full.value)
                    held += counters[lang].add(text)
                    if held >= FLUSH:
                        yield from flushed()
                        held = 0
        yield from flushed()

    # one short key per phrase goes through the shuffle: the phrase, a tab (no word holds one), the language
    counted = texts.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\t", 1)
    return counted.select(
        F.expr("substring(key, instr(key, '\t') + 1)").alias("lang"),
        F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ", -1))).alias("k"), phrase.alias("phrase"), "n")


def frequent_phrases(df: DataFrame, least: int = LEAST, share: float = SAMPLE, lowered: float = LOWERED, text_col: str = "text",
                     lang_col: str = "lang", sample_on: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """(lang, k, phrase, n): every phrase of at most five words with at least ``least`` occurrences in its language, and per language
    the row k = 0 with all word occurrences. Exact; ``share`` and ``lowered`` decide only how much is counted, and whether a second pass is needed."""
    if least < 2:
        raise ValueError("least must be 2 or more")
    texts = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    # 1. the sample proposes
    million = 1_000_000
    chosen = df.where(F.pmod(F.xxhash64(*[F.col(c) for c in sample_on]), F.lit(million)) < int(share * million))
    sample = put_down(chosen.select(*[F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text")]), "phrase-sample")
    in_sample = max(2, int(least * share * lowered))
    proposed, known = None, None
    for k in range(1, LONGEST):
        counts = count_phrases(sample, (k,), known)
        level = put_down(counts.where((F.col("k") == k) & (F.col("n") >= in_sample)), f"proposed-{k}")
        proposed = level if proposed is None else proposed.unionByName(level)
        known = bitmap(proposed)
    # 2. one full pass counts them and their negative border, where the slots do not rule it out
    full = full_slots(texts, known, least)
    found = put_down(count_phrases(texts, tuple(range(1, LONGEST + 1)), known, full=full).where(f"k = 0 OR n >= {least}"), "phrases")
    # 3. failures of the border call for an expansion pass
    failures = found.where(F.col("k").between(1, LONGEST - 1)).join(proposed, ["lang", "k", "phrase"], "left_anti")
    failures = put_down(failures, "border-failures")
    if failures.isEmpty():
        return found.select("lang", "k", "phrase", "n")
    more = count_phrases(texts, tuple(range(2, LONGEST + 1)), fresh=bitmap(failures)).where(F.col("n") >= least)
    return put_down(found.unionByName(more).groupBy("lang", "k", "phrase").agg(F.max("n").alias("n")), "frequent-phrases")


def score(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, a, l, r, n, score) with their lowest-scoring cut, without those that a longer candidate of the same count
    contains. Products are decimals of 38 digits, so exact."""
    words = F.split("phrase", " ", -1)
    some = phrases.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    # every part of a candidate is frequent itself, so it is enough to look one word further
    inner = some.where("k > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("k") - 1), " "))).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("covered"))
    some = some.join(covered, ["lang", "phrase"], "left").where(F.col("covered").isNull() | (F.col("covered") < F.col("a"))).drop("covered")
    cuts = some.select("lang", "k", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("*", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
                       F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"))
    # single words may be part of very many phrases: dealt over salted copies
    copies = F.when(F.col("k") == 1, F.lit(SALTS - 1)).otherwise(F.lit(0))
    parts = phrases.where(F.col("k").between(1, LONGEST - 1)).select(
        "lang", F.col("phrase").alias("part"), F.col("n").alias("f"), F.explode(F.sequence(F.lit(0), copies)).alias("salt"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    for part, f, single in (("left", "l", F.col("cut") == 1), ("right", "r", F.col("k") - F.col("cut") == 1)):
        side = parts.select(F.col("lang"), F.col("part").alias(part), F.col("f").alias(f), "salt")
        cuts = cuts.withColumn("salt", F.when(single, salt).otherwise(F.lit(0))).join(side, ["lang", part, "salt"]).drop("salt")
    totals = phrases.where("k = 0").select("lang", F.col("n").alias("n"))  # one row per language
    cuts = cuts.join(totals, "lang")
    return cuts.select("lang", "phrase", "a", "l", "r", "n", "cut", F.expr(
        "((cast(a AS decimal(18,0)) * (cast(n AS decimal(15,0)) * cast(1000 AS decimal(4,0)))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0))))"
    ).cast("long").alias("score")).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low")).select(
        "lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language (contract of operator 12)."""
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    scored = score(frequent_phrases(table(spark, sf_dir, "documents")))
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


ORACLE_OP12 = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS n FROM (
        SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) AS s(k)))
      GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
inner_parts AS (SELECT lang, a, unnest([array_to_string(ws[1:k - 1], ' '), array_to_string(ws[2:], ' ')]) AS phrase FROM c WHERE k > 2),
gone AS (SELECT lang, phrase, max(a) AS covered FROM inner_parts GROUP BY lang, phrase),
kept AS (SELECT c.* FROM c LEFT JOIN gone g USING (lang, phrase) WHERE g.covered IS NULL OR g.covered < c.a),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, x.n AS l, y.n AS r, t.n, cut, ((1000::HUGEINT * a * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts JOIN total t ON t.lang = cuts.lang
  JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:cut], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[cut + 1:], ' ')),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low) WHERE rank <= 2000
"""
