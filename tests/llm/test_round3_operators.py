"""Packing, collocations and the prefix trie against brute force, on tables with nulls, ties, repeats, empty and long texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, start long, length long, n long, k int"


def docs(spark, texts, langs=None):
    return spark.createDataFrame([(i if i != 5 else None, t, (langs or ["en"])[i % len(langs or "1")], "s", 1, 2, 3, 4)
                                  for i, t in enumerate(texts)], DOCS)


# --- operator 11


def test_packing_pieces(spark, tmp_path):
    from tokenizers import Tokenizer
    from moundlake.llm import pow2_packing as P
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randrange(900)}" for _ in range(n)) for n in (1, 7, 300, 4000, 20000)]
    texts += ["", None, texts[1], "a<|endoftext|> b", "x" * 9000, " \n\t ", "don't. stop,now é²,ß!", "漢字、かな"]
    lib = Tokenizer.from_file(P.tokenizer_path())
    packed = P.pack(docs(spark, texts), P.tokenizer_path(), keep=("doc_id", "text"))
    rows = packed.collect()
    by_text = defaultdict(list)
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0 and len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_text[r.doc_id, r.text].append(r)
    assert len(by_text) == len(texts)
    for (_, t), parts in by_text.items():
        parts.sort(key=lambda r: r.start)
        want = lib.encode(t or "", add_special_tokens=False).ids + [1]
        assert [i for r in parts for i in r.ids] == want and all(r.doc_tokens == len(want) for r in parts)
        assert [r.length for r in parts] == P.lengths_of(len(want)) and [r.start for r in parts] == list(np.cumsum([0] + [r.length for r in parts])[:-1])
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    for length in {r.length for r in rows}:
        assert sorted(r.bucket_slot for r in rows if r.length == length) == list(range(sum(r.length == length for r in rows)))
    for r in P.with_batches(packed, 4096).groupBy("batch", "length").count().collect():
        assert r["count"] * r.length <= 4096
    P.write_buckets(packed, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == len(rows) and {r.length for r in back.select("length").distinct().collect()} == {r.length for r in rows}
    assert P.pack(docs(spark, texts).limit(0), P.tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        P.cut(docs(spark, texts), P.tokenizer_path(), longest=1000)


# --- operator 12


def phrases_by_hand(rows, least):
    import re
    lower = {c: c + 32 for c in range(65, 91)}
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][tuple(words[i:i + k])] += 1
    out = {}
    for lang, c in counts.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        for p, a in some.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in some.items()):
                continue
            score, cut = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            out[lang, " ".join(p)] = (a, c[p[:cut]], c[p[cut:]], n, score)
    return out


@pytest.mark.parametrize("share, lowered", [(0.3, 0.6), (0.0, 0.6), (1.0, 1.0), (0.2, 3.0)])
def test_collocations_whatever_the_sample(spark, share, lowered):
    """Also with an empty sample and one that proposes too little: the failures of the border bring everything back."""
    from moundlake.llm import collocations as C
    rnd = random.Random(9)
    fixed = ["New York City hall", "the the the the the the", "a b a b a b a", "Café au lait", "x y z w"]
    texts = [", ".join([*(" ".join(f"v{rnd.randrange(12)}" for _ in range(6)) for _ in range(4)), rnd.choice(fixed), "tab\tin  it"]) for _ in range(120)]
    texts += [None, "", " . ,\n", "Ünïcode ÀB", texts[0], texts[0], "one " * 4000]
    langs = ["en", "en", None, "de\tx"]
    frame = docs(spark, texts, langs)
    got = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in C.score(C.frequent_phrases(frame, least=9, share=share, lowered=lowered)).collect()}
    want = phrases_by_hand([(t, langs[i % 4]) for i, t in enumerate(texts)], 9)
    assert got == want and len(want) > 50
    assert C.score(C.frequent_phrases(frame.limit(0), least=9)).count() == 0


@pytest.mark.parametrize("flush, slots_shard", [(1_000_000, 1 << 16), (50, 64)])
def test_full_slots_hold_every_frequent_phrase(spark, monkeypatch, flush, slots_shard):
    """No frequent phrase lies outside the slots, however the counts are cut; with one occurrence as the threshold, every slot in use is set."""
    import numpy as np
    from moundlake.llm import collocations as C
    monkeypatch.setattr(C, "FLUSH", flush)
    monkeypatch.setattr(C, "SHARD", slots_shard)
    rnd = random.Random(4)
    texts = [" ".join(f"v{min(rnd.randrange(9), rnd.randrange(9))}" for _ in range(30)) + ". end" for _ in range(200)]
    frame = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(3)
    words = spark.createDataFrame([("en", w) for w in {w for t in texts for w in t.replace(".", "").split()}], "lang string, phrase string")
    known = C.bitmap(words)
    counts = Counter((a, b) for t in texts for a, b in zip(t.split(". ")[0].split(), t.split(". ")[0].split()[1:]))
    h = C._word_hash("en")
    hashes = {p: C.Counter._longer(np.array([h(p[0].encode())], np.uint64), np.array([h(p[1].encode())], np.uint64)) for p in counts}
    full = C.full_slots(frame, known, 60)
    slots, _ = full
    sums = Counter()
    for p, n in counts.items():
        sums[int(hashes[p][0]) & (slots - 1)] += n
    for p, n in counts.items():
        assert n < 60 or C.in_slot(full, hashes[p])[0]
        if slots_shard > 64:  # few collisions: what is rare is left out
            assert C.in_slot(full, hashes[p])[0] or sums[int(hashes[p][0]) & (slots - 1)] < 60
    assert slots_shard <= 64 or not all(C.in_slot(full, x)[0] for x in hashes.values())
    every = C.full_slots(frame, known, 1)
    assert all(C.in_slot(every, x)[0] for x in hashes.values())


def test_collocation_flushes(spark, monkeypatch):
    """Counts handed on in many pieces, with the words numbered anew each time."""
    from moundlake.llm import collocations as C
    c = C.Counter("en", None, None, (1,))
    monkeypatch.setattr(C, "WORDS", 2)
    total = Counter()
    for _ in range(3):
        c.add("a b. b c a\ta d")
        for phrases, n in c.flush():
            total.update(dict(zip(phrases, map(int, n))))
    assert total == {b"": 21, b"a": 9, b"b": 6, b"c": 3, b"d": 3}


# --- operator 13


def trie_by_hand(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    out = set()
    for p, members in nodes.items():
        below = {q: m for q, m in nodes.items() if q[:len(p)] == p}
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in nodes) for q in below)
        saved = sum((len(m) - 1) * (len(q[-1][1].encode()) if q else 0) for q, m in below.items())
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(p))))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def test_trie_of_conversations(spark, monkeypatch):
    from moundlake.llm import prefix_trie as P
    monkeypatch.setattr(P, "SPAN", 2)
    monkeypatch.setattr(P, "RUN", 3)
    rnd = random.Random(3)
    rows, own = [], defaultdict(list)
    for c in range(60):
        n = rnd.choice([1, 2, 3, 5, 8, 9, 14])
        prefix = [("u", f"p{k // 3}") for k in range(rnd.choice([0, 2, 4, 7, 12]))] if c % 3 else []
        turns = (prefix + [(rnd.choice(["u", None]), rnd.choice(["é", "b", None, ""])) for _ in range(n)])[:14]
        for t, (role, text) in enumerate(turns):
            rows.append((c, t if t else (None if c % 2 else 0), role, text, 7, "x"))
            own[c].append((role or "", text or ""))
    rows += [(None, 1, "u", "nobody", 7, "x")]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth long, digest string")
    turns = P.numbered_turns(frame)
    got = {tuple(r) for r in P.prefix_trie(turns, turns.select("conv_id").distinct()).collect()}
    assert got == trie_by_hand(own)
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    got = {tuple(r) for r in P.prefix_trie(*P.branched(turns)).collect()}
    assert got == trie_by_hand(rebuilt)
    assert P.prefix_trie(*P.branched(P.numbered_turns(frame.limit(0)))).count() == 0


def test_trie_with_turnless_conversations_and_ties(spark):
    from moundlake.llm import prefix_trie as P
    frame = spark.createDataFrame([(c, 1, "u", t) for c in (3, 4) for t in ("b", "a", "a")], "conv_id long, turn long, role string, text string")
    turns = P.numbered_turns(frame)
    ids = spark.createDataFrame([(i,) for i in (1, 3, 4, 9)], "conv_id long")
    rows = sorted((r.depth, r.conv_id, r.parent_conv_id, r.n_convs, r.n_leaves, r.saved_tokens) for r in P.prefix_trie(turns, ids).collect())
    assert rows == [(0, 1, None, 4, 1, 3), (1, 3, 1, 2, 1, 3), (2, 3, 3, 2, 1, 2), (3, 3, 3, 2, 1, 1)]
    only = P.prefix_trie(turns.limit(0), ids).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in only] == [(1, 0, 4, 0, 1, 0)]
    assert only[0].ends_sha256 == hashlib.sha256(b"1,3,4,9").hexdigest()
