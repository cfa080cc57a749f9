"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A merge can only ever produce a token of the vocabulary. Where two neighbouring bytes stand side by
side in no token, no token can span them: the place is a certain cut. The text is therefore split at
such places, every fragment is encoded on its own, and the ids are concatenated; the result is the
one of encoding the whole text, whatever its length.

Cuts come in two kinds:

* between a non-space character and white space after it. Tokens carry white space in front, never
  behind, and the pre-tokenizer always breaks there, so a chunk depends on nothing outside it.
* inside every pre-token of a chunk, between bytes whose pair occurs in no token. These bound the
  work of the merge loop on long runs (base64, repeated signs).

Chunks and pre-tokens repeat in natural text: the ids of short ones are kept in two bounded memos per task.

Defined results: a null text counts as empty, an empty text has no ids and decodes to the empty
string; ``<|endoftext|>`` in a text becomes its special id, as the tokenizers library does; repeated
rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from moundlake.llm.common import table, text_or_empty

#: The pre-tokenizer's pattern and the characters Unicode calls white space.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Entries a task's memos hold before they are emptied.
MEMO = 300_000
#: Characters up to which a chunk or pre-token is kept in its memo.
SHORT = 48
#: Rank of a pair that no merge joins.
NEVER = 1 << 62
#: Rows handed back to Spark at a time.
ROWS_OUT = 512


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others get the characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBpe:
    """Encoder and decoder over one byte-level vocabulary file of the tokenizers library."""

    def __init__(self, spec: str):
        import regex
        conf = json.loads(spec)
        alphabet = byte_alphabet()
        vocab = conf["model"]["vocab"]
        as_bytes = {t: bytes(alphabet[c] for c in t) for t in vocab}
        self.token_bytes: list[bytes] = [b""] * (max([*vocab.values(), *(a["id"] for a in conf["added_tokens"])]) + 1)
        for t, i in vocab.items():
            self.token_bytes[i] = as_bytes[t]
        self.special = {a["content"]: a["id"] for a in conf["added_tokens"]}
        for content, i in self.special.items():
            self.token_bytes[i] = content.encode()
        self.byte_id = [0] * 256
        for t, i in vocab.items():
            if len(as_bytes[t]) == 1:
                self.byte_id[as_bytes[t][0]] = i
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(conf["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.rank = {(a << 32) | b: rank for (a, b), (rank, _) in self.merges.items()}
        self.first = [self.rank.get((a << 32) | b, NEVER) for a in self.byte_id for b in self.byte_id]  # by pair of bytes
        self.made = {rank: new for rank, new in self.merges.values()}
        self.joined = {(x << 8) | y for b in as_bytes.values() for x, y in zip(b, b[1:])}
        self.pre_token = regex.compile(PRE_TOKEN)
        self.chunk = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.at_special = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        self.memo: dict[str, tuple[int, ...]] = {}
        self.word_memo: dict[str, list[int]] = {}

    def forced(self, a: int, b: int) -> bool:
        """Whether no token holds byte ``a`` followed by byte ``b``."""
        return (a << 8) | b not in self.joined

    def fragments(self, data: bytes) -> list[bytes]:
        """A pre-token's bytes, split at every forced boundary."""
        joined = self.joined
        cuts = [i for i, (a, b) in enumerate(zip(data, data[1:]), 1) if (a << 8) | b not in joined]
        return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])] if cuts else [data]

    def merge(self, data: bytes) -> list[int]:
        """Merge one fragment: lowest rank first, leftmost among equals."""
        ids = [self.byte_id[b] for b in data]
        if len(ids) > 48:
            return self._merge_long(ids)
        rank, made = self.rank.get, self.made
        first = self.first
        ranks = [first[(a << 8) | b] for a, b in zip(data, data[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            ids[i] = new = made[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1] << 32) | new, NEVER)
            if i < len(ranks):
                ranks[i] = rank((new << 32) | ids[i + 1], NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges with a heap over linked neighbours: n log n on long fragments."""
        get, n = self.merges.get, len(ids)
        nxt, prv = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = nxt[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], nxt[i] = new, -1, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
                if (m := get((new, ids[nxt[j]]))) is not None:
                    heapq.heappush(heap, (m[0], i, new, ids[nxt[j]], m[1]))
            if prv[i] >= 0 and (m := get((ids[prv[i]], new))) is not None:
                heapq.heappush(heap, (m[0], prv[i], ids[prv[i]], new, m[1]))
        return [x for x in ids if x >= 0]

    def encode_word(self, word: str) -> list[int]:
        """The ids of a pre-token: its fragments merged one by one."""
        ids = [i for f in self.fragments(word.encode()) for i in self.merge(f)]
        if len(self.word_memo) >= MEMO:
            self.word_memo.clear()
        if len(word) <= SHORT:
            self.word_memo[word] = ids
        return ids

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        get = self.word_memo.get
        # the collector does not track tuples of numbers
        ids = tuple([i for word in self.pre_token.findall(chunk) for i in get(word) or self.encode_word(word)])
        if len(self.memo) >= MEMO:
            self.memo.clear()
        if len(chunk) <= SHORT:
            self.memo[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        get = self.memo.get
        for k, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if k % 2:
                ids.append(self.special[part])
                continue
            for chunk in self.chunk.findall(part):
                ids += get(chunk) or self.encode_chunk(chunk)
        return ids

    def decode(self, ids) -> str:
        tokens = self.token_bytes
        return b"".join([tokens[i] for i in ids]).decode("utf-8", errors="replace")


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file's text as a broadcast: read once on the driver, of a fixed size (MBs)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_decode(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Columns ``keep`` plus the ids of each whole text and the text decoded from those ids."""
    import pandas as pd
    spec = vocabulary(df.sparkSession, path)
    rows = df.select(*[F.col(c) for c in keep], text_or_empty(text_col).alias("_llm_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = f"{fields + ', ' if fields else ''}`{ids_col}` array<int>, `{decoded_col}` string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ForcedBoundaryBpe(spec.value)
        for batch in batches:
            for at in range(0, len(batch), ROWS_OUT):
                part = batch.iloc[at:at + ROWS_OUT]
                out = part[list(keep)].copy()
                ids = [bpe.encode(t) for t in part["_llm_text"]]
                out[ids_col] = ids
                out[decoded_col] = [bpe.decode(x) for x in ids]
                yield out

    return rows.mapInPandas(run, schema)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def digests(encoded: DataFrame) -> DataFrame:
    """The contract's columns, from the ids and the decoded texts."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_bpe_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded again (contract of operator 3)."""
    return digests(encode_decode(table(spark, sf_dir, "documents"), tokenizer_path()))
