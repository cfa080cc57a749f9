"""op11: what the library is asked for; pipeline: how the state stores are opened."""

import random

import numpy as np

from moundlake.llm import exact_dedup
from moundlake.llm.bpe import tokenizer_path
from moundlake.llm.pow2_packing import ChunkCoder


def test_new_chunks_go_to_the_library_as_one_text():
    """op11_pow2_packing: ids as those of whole texts, and few texts handed to the library."""
    with open(tokenizer_path(), encoding="utf-8") as f:
        coder = ChunkCoder(f.read())
    coder.memo.clear()
    lib, asked = coder.library, []

    class Counted:
        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return lib.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    coder.library = Counted()
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\xa0", "word", "é", "Łódź", ",", ".", "!?", "'s", "12", "漢字", "😀", "<|endof", "text|>", "%%%%", "ß"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += [" ".join(f"w{k}x" for k in range(3000)), "", " ", "a" * 200 + " " * 60 + "b", "<|endoftext|> a"]
    assert coder.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert len(asked) < 1500  # the 3000 words of one text are not 3000 texts
    assert coder.encode(texts[:50]) == coder.encode(texts)[:50]


def test_state_stores_share_bounded_memory_and_close(spark):
    """pipeline: the settings hold while the stream runs and are taken back."""
    names = ["spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "spark.sql.streaming.stateStore.unloadOnCommit"]
    before = [spark.conf.get(n, None) for n in names]
    with exact_dedup._state_settings(spark):
        assert [spark.conf.get(n) for n in names] == ["true", "true"]
    assert [spark.conf.get(n, None) for n in names] == before
    docs = spark.createDataFrame([(3, "a  b"), (1, "a b"), (2, "c"), (None, None), (5, "")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup_exact(docs).collect()}
    assert got == {(3, 1, 2), (1, 1, 2), (2, 2, 1), (None, 5, 2), (5, 5, 2)}
