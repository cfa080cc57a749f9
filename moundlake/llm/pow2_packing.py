"""Packing by power-of-two decomposition.

A document's token count is a sum of powers of two. Its ids are cut, from the front, into as many pieces of
``longest`` tokens as fit and then one piece for every set bit of the rest, longest first. Pieces of equal
length form a bucket; every piece is one training sequence of its bucket, so no sequence crosses documents and
none is padded. Batches are taken from one bucket at a time (:func:`with_batches`): all their rows have one length.

The work is one pass over the texts: a task encodes its documents, cuts them, numbers the pieces of each length in its
own part and hands them on; they are written once. What a part needs to know about the parts before it is one count per
length, a table of at most (lengths x parts) rows, so the numbering is gapless in every bucket without moving the ids.

Ids are those of the vocabulary's own library. A text is split between a non-space character and the white space after it, and
between a run of letters and the mark after it, where that pre-tokenizer always breaks; such chunks repeat, so each Python worker keeps
the ids of short ones in a bounded memo and sends only chunks it has not seen to the library, strung together to one text: it is cut
again at the chunks' bytes, for a token of a byte-level vocabulary has one character for each of its bytes.

Defined results: a null text counts as empty, an empty text is the end mark alone (one piece of one token); repeated rows and
equal ids are documents of their own; a null id stays null; an empty table gives no rows; further columns are ignored unless
``keep`` names them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from moundlake.llm.bpe import WHITE, tokenizer_path, vocabulary
from moundlake.llm.common import put_down, table, text_or_empty, worker_store
from moundlake.operators.joins import broadcast_if_small

#: The longest sequence, and the id that ends each document.
LONGEST, END_ID = 2048, 1
#: Chunks of up to this many characters are kept in the memo, which is emptied beyond this many entries (about 200 bytes each).
SHORT, MEMO = 48, 1_000_000
#: White space and letters up to a mark, or white space and what follows it, or white space that ends the text. No run is given back:
#: what ends it can not stand inside it.
CHUNK = f"[{WHITE}]*+(?:[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,;:!?])|[^{WHITE}]++)|[{WHITE}]++"
#: A chunk that may stand between others of its kind: each border lies between a non-space character and white space.
BETWEEN = f"[{WHITE}]+[^{WHITE}]+"
#: Rows taken from a batch at a time.
ROWS = 256


class ChunkCoder:
    """Ids of whole texts as little-endian 32-bit bytes. The loaded library and the memo stay with the Python worker."""

    def __init__(self, spec: str):
        import os
        import zlib

        import numpy as np
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer
        kept = worker_store(f"chunk coder {len(spec)} {zlib.crc32(spec.encode())}")
        if not kept:
            library = Tokenizer.from_str(spec)
            library.no_truncation()
            library.no_padding()
            vocab = library.get_vocab()
            size = np.zeros(max(vocab.values(), default=0) + 1, dtype=np.int64)
            size[list(vocab.values())] = [len(token) for token in vocab]
            kept.update(library=library, memo={}, size=size)
        self.library, self.memo, self.size = kept["library"], kept["memo"], kept["size"]
        self.chunk, self.between = re.compile(CHUNK), re.compile(BETWEEN).fullmatch
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def _ids(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunk_ids(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of each chunk: those that may stand side by side are one text for the library."""
        import numpy as np
        strung, alone = [], []
        for c in chunks:
            (strung if self.between(c) else alone).append(c)
        yield from zip(alone, self._ids(alone))
        if strung:
            ids = np.frombuffer(self._ids(["".join(strung)])[0], "<u4")
            behind = np.cumsum(self.size[ids])  # bytes up to the end of each token
            ends = np.cumsum([len(c.encode()) for c in strung])
            cuts = np.searchsorted(behind, ends)
            if not np.array_equal(behind[cuts], ends):
                raise ValueError("a token reaches over the border of two chunks")
            raw, lo = ids.tobytes(), 0
            for c, hi in zip(strung, (4 * (cuts + 1)).tolist()):
                yield c, raw[lo:hi]
                lo = hi

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Texts that hold a special token's name go to the library whole."""
        whole = {k for k, t in enumerate(texts) if any(s in t for s in self.special)}
        chunks = [[] if k in whole else self.chunk.findall(t) for k, t in enumerate(texts)]
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        new = list(set().union(*chunks).difference(memo))
        memo.update(self._chunk_ids(new))
        out = [b"".join(map(memo.__getitem__, cs)) for cs in chunks]
        for c in new:
            if len(c) > SHORT:
                del memo[c]
        for k, ids in zip(whole, self._ids([texts[k] for k in whole])):
            out[k] = ids
        return out


def lengths_of(tokens: int, longest: int = LONGEST) -> list[int]:
    """The lengths of a document's pieces: ``longest`` as often as it fits, then the set bits of the rest."""
    full, rest = divmod(tokens, longest)
    return [longest] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), longest: int = LONGEST,
        end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``keep``, start, length, doc_tokens, ids, ids_crc32 (of the ids as unsigned little-endian 32-bit
    numbers), and part and at, the piece's place among those of its length in its task. Written before it is returned."""
    import pyarrow as pa
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    spec = vocabulary(df.sparkSession, path)
    rows = df.select(*[F.col(c) for c in keep], text_or_empty(text_col).alias("_llm_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = (f"{kept + ', ' if kept else ''}start long, length long, doc_tokens long, ids array<int>, ids_crc32 long, "
              "part int, at long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        from collections import Counter

        import numpy as np
        from pyspark import TaskContext
        part, coder, seen = TaskContext.get().partitionId(), ChunkCoder(spec.value), Counter()
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                some = batch.slice(lo, ROWS)
                of, start, length, tokens, crc, at, coded = [], [], [], [], [], [], []
                for k, ids in enumerate(coder.encode(some.column(some.num_columns - 1).to_pylist())):
                    ids += end
                    coded.append(ids)
                    n, place = len(ids) // 4, 0
                    for size in lengths_of(n, longest):
                        of.append(k)
                        start.append(place)
                        length.append(size)
                        tokens.append(n)
                        crc.append(zlib.crc32(ids[4 * place:4 * (place + size)]))
                        at.append(seen[size])
                        seen[size] += 1
                        place += size
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                long = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [some.column(i).take(pa.array(of, long)) for i in range(some.num_columns - 1)]
                    + [pa.array(start, long), pa.array(length, long), pa.array(tokens, long),
                       pa.ListArray.from_arrays(pa.array(ends), values), pa.array(crc, long),
                       pa.array([part] * len(of), pa.int32()), pa.array(at, long)],
                    names=[*keep, "start", "length", "doc_tokens", "ids", "ids_crc32", "part", "at"])

    return put_down(rows.mapInArrow(run, schema), "pieces")


def pack(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), longest: int = LONGEST,
         end_id: int = END_ID) -> DataFrame:
    """The pieces of :func:`cut` as sequences: bucket_slot (gapless from 0 in the bucket of the piece's length), sequence_id
    (gapless from 0 over all buckets, longest first) and offset (0: a piece fills its sequence)."""
    pieces = cut(df, path, text_col, keep, longest, end_id)
    counts = put_down(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    totals = sorted(((r.length, r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()), reverse=True)
    first, base = {}, 0  # one entry per power of two up to ``longest``
    for length, n in totals:
        first[length] = base
        base += n
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    start = F.coalesce(*[F.when(F.col("length") == k, F.lit(v)) for k, v in first.items()], F.lit(0)).cast("long")
    numbered = pieces.join(broadcast_if_small(offsets), ["length", "part"])
    return numbered.select(
        *keep, "start", "length", "doc_tokens", "ids", "ids_crc32", (F.col("_before") + F.col("at")).alias("bucket_slot"),
        (start + F.col("_before") + F.col("at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def with_batches(packed: DataFrame, batch_tokens: int) -> DataFrame:
    """Batch numbers per bucket: every batch holds ``batch_tokens`` tokens of sequences of one length (the last of a
    bucket may hold fewer)."""
    return packed.withColumn("batch", F.floor(F.col("bucket_slot") * F.col("length") / F.lit(batch_tokens)).cast("long"))


def write_buckets(packed: DataFrame, path: str, file_tokens: int = 1 << 26) -> None:
    """One folder per length, files of at most ``file_tokens`` tokens, sequences in the order of their bucket."""
    file = F.floor(F.col("bucket_slot") * F.col("length") / F.lit(file_tokens))
    (packed.withColumn("_llm_file", file).repartition("length", "_llm_file")
     .sortWithinPartitions("length", "_llm_file", "bucket_slot").drop("_llm_file").write.partitionBy("length").parquet(path))


def op11_pow2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its sequence (contract of operator 11)."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
