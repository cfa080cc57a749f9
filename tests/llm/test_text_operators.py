"""The text operators against brute force, on small tables with nulls, empty and long texts, ties, repeated rows,
clashing extra columns, and empty tables."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, node string, file string"


def docs_frame(spark, texts, sources=None):
    """Documents with the given texts (id: place), and extra columns whose names the operators use inside."""
    rows = [(i, t, ("en", "de", None)[i % 3], (sources or ["a", "b", None])[i % len(sources or "abc")],
             None if t is None else len(t), "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(seed, n):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    base = [" ".join(words(i, 60)) for i in range(12)]
    near = [b.split() for b in base[:6]]
    for k, n in enumerate(near):
        n[k * 7 + 3] = "changed"
    return (base + [" ".join(n) for n in near] + [base[0], base[0].replace(" ", "\n\t"), base[0].replace(" ", "  ")]
            + [None, "", "", " ", "\n", "one", "one", "two words", " ".join(words(99, 20000)), "a" * 30000, "é ß 😀 <|endoftext|> 's"])


# --- operator 3


def test_bpe_equals_library(spark, texts):
    from tokenizers import Tokenizer
    from moundlake.llm import bpe
    lib = Tokenizer.from_file(bpe.tokenizer_path())
    rows = bpe.digests(bpe.encode_decode(docs_frame(spark, texts), bpe.tokenizer_path())).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_cuts_every_pre_token(monkeypatch, texts):
    """No chunk goes to a library, however short: every pre-token passes the byte-pair cuts and the merge loop."""
    import sys
    from moundlake.llm import bpe
    monkeypatch.setitem(sys.modules, "tiktoken", None)
    own = bpe.ForcedBoundaryBpe(open(bpe.tokenizer_path(), encoding="utf-8").read())
    cut, merged, cuts, merge = set(), set(), own.fragments, own.merge
    monkeypatch.setattr(own, "fragments", lambda data: cut.add(data) or cuts(data))
    monkeypatch.setattr(own, "merge", lambda data: merged.add(data) or merge(data))
    for t in filter(None, texts):
        own.encode(t)
        words = {w.encode() for part in t.split("<|endoftext|>") for c in own.chunk.findall(part) for w in own.pre_token.findall(c)}
        assert words <= cut
        assert {f for w in words for f in cuts(w)} <= merged


def test_bpe_random_strings_and_cuts():
    from tokenizers import Tokenizer
    from moundlake.llm import bpe
    path = bpe.tokenizer_path()
    own, lib = bpe.ForcedBoundaryBpe(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    rnd = random.Random(3)
    alphabet = " \t\n\r\x0b\x1c\x85 　'sréß#-1a.́中😀<|endoftext|>"
    for _ in range(3000):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(120)))
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    # forced cuts and the heap give what one plain merge of the whole run gives
    long = ("qzxj" * 40 + "ab" * 60).encode()
    assert any(own.forced(x, y) for x, y in zip(long, long[1:]))
    assert [i for f in own.fragments(long) for i in own.merge(f)] == own._merge_long([own.byte_id[b] for b in long])
    token = next(b for b in own.token_bytes if len(b) > 5)
    assert not any(own.forced(x, y) for x, y in zip(token, token[1:]))


# --- operator 4


def test_hilbert_curve_visits_neighbours(spark):
    from moundlake.llm.hilbert import hilbert_index
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        n = 1 << bits
        grid = spark.range(n ** dims).select(*[(F.floor(F.col("id") / n ** k) % n).cast("int").alias(f"c{k}") for k in range(dims)])
        rows = grid.withColumn("h", hilbert_index([F.col(f"c{k}") for k in range(dims)], bits)).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(n ** dims))
        for a, b in zip(rows, rows[1:]):
            assert sum(abs(a[f"c{k}"] - b[f"c{k}"]) for k in range(dims)) == 1


def test_shards_are_even_and_gapless(spark, texts):
    from moundlake.llm.hilbert import assign_shards
    docs = docs_frame(spark, texts)
    docs = docs.union(docs.limit(5)).union(spark.createDataFrame([(None, None, None, None, None, None, None, None)] * 2, DOCS))
    rows = assign_shards(docs, shards=16).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
        text = (texts[r.doc_id] if r.doc_id is not None else None) or ""
        assert r["size"] == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
    assert sorted(by) == list(range(16))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for s, part in by.items():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        part.sort(key=lambda r: r.slot)
        assert [r.curve for r in part] == sorted(r.curve for r in part)
        if s:
            assert by[s][0].curve >= by[s - 1][-1].curve
    assert assign_shards(docs.limit(0)).count() == 0


def test_shard_files_prune(spark, tmp_path):
    from moundlake.llm.hilbert import write_shards
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    write_shards(docs, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count()
    per = back.groupBy("source").agg(F.count_distinct("_llm_shard").alias("shards")).agg(F.avg("shards")).first()[0]
    assert per < 8  # a source touches a part of the 16 shards


# --- operators 10 and 5


def norm(t):
    import re
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup(spark, texts):
    from moundlake.llm.exact_dedup import dedup_exact, keep_first, op10_exact_dedup, sha256
    docs = docs_frame(spark, texts)
    first, size = {}, {}
    for i, t in enumerate(texts):
        first.setdefault(norm(t), i)
        size[norm(t)] = size.get(norm(t), 0) + 1
    weak = lambda text: F.substring(sha256(text), 1, 1)  # noqa: E731  nearly every hit is a collision
    for digest in (sha256, weak):
        rows = dedup_exact(docs, digest=digest).collect()
        assert len(rows) == len(texts)
        for r in rows:
            k = norm(texts[r.doc_id])
            assert (r.keep_id, r.group_size, r.kept) == (first[k], size[k], r.doc_id == first[k])
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert dedup_exact(docs.limit(0)).count() == 0


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    from moundlake.llm.exact_dedup import keep_first
    row = (7, "same text", "en", "a", 9, "x", "y", "z")
    docs = spark.createDataFrame([row, row, (None, *row[1:]), (None, "other", *row[2:])], DOCS)
    assert sorted((r.doc_id or -1, r.text) for r in keep_first(docs).collect()) == [(-1, "other"), (7, "same text")]


def test_dedup_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    from moundlake.llm.exact_dedup import dedup_stream, state_of
    kind = "doc_id long, file string, row long, digest string"
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "ckpt")
    spark.createDataFrame([(5, "f", 0, "d1"), (6, "f", 1, "d2")], kind).write.parquet(landing)
    stream = spark.readStream.schema(kind).parquet(landing)
    dedup_stream(stream, checkpoint).awaitTermination()
    spark.createDataFrame([(3, "g", 0, "d1"), (9, "g", 1, "d3")], kind).write.mode("append").parquet(landing)
    dedup_stream(stream, checkpoint).awaitTermination()
    got = {r.digest: (r.keeper.doc_id, r.n) for r in state_of(spark, checkpoint).collect()}
    assert got == {"d1": (3, 2), "d2": (6, 1), "d3": (9, 1)}


def grams(t):
    w = (t or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_links(texts):
    sets = [grams(t) for t in texts]
    return {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and sets[i] and sets[j]
            and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}


def brute_classes(n, links):
    label = list(range(n))
    while True:
        changed = False
        for a, b in links:
            if label[b] < label[a]:
                label[a], changed = label[b], True
        if not changed:
            return label


def test_jaccard_join(spark, texts):
    from moundlake.llm.jaccard_join import jaccard_classes, one_of_each
    docs = docs_frame(spark, texts)
    links = brute_links(texts)
    label = brute_classes(len(texts), links)
    rows = jaccard_classes(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.class_id, r.n_links) == (label[r.doc_id], sum(a == r.doc_id for a, _ in links)), texts[r.doc_id]
        assert r.kept == (label[r.doc_id] == r.doc_id)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(label))
    assert jaccard_classes(docs.limit(0)).count() == 0


def test_jaccard_join_cuts_a_large_cluster_into_blocks(spark, monkeypatch):
    """A group far larger than a block, in a chain of similarities: no link and no count is lost."""
    from moundlake.llm import jaccard_join
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", 16)
    base = words(1, 120)
    texts = []
    for i in range(90):
        w = list(base)
        w[i] = f"own{i}"
        w[(i * 7) % 120] = f"also{i % 9}"
        texts.append(" ".join(w))
    links = brute_links(texts)
    rows = jaccard_join.jaccard_classes(docs_frame(spark, texts)).collect()
    label = brute_classes(len(texts), links)
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == {
        i: (label[i], sum(a == i for a, _ in links)) for i in range(len(texts))}


def test_bayesian_bound():
    from moundlake.llm.jaccard_join import HASHES, STEP, least_matches
    enough = least_matches(0.8, 1e-6)
    assert sorted(enough) == list(range(STEP, HASHES + 1, STEP))
    for n, m in enough.items():  # the posterior below the bound, by numeric integration of the likelihood
        mass = lambda lo, k: sum((x / 4000) ** k * (1 - x / 4000) ** (n - k) for x in range(int(lo * 4000), 4000))
        assert mass(0.8, m) / mass(0, m) >= 0.9e-6
        assert m == 0 or mass(0.8, m - 1) / mass(0, m - 1) < 1.2e-6


def test_components(spark):
    from moundlake.llm.components import connected_components
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}, **{200 + i: 200 for i in range(30)}}


# --- operator 1


def test_pq_near_copies(spark):
    import numpy as np
    from moundlake.llm.pq_dedup import near_copies
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 32))
    for i in range(200, 300):
        x[i] = x[i - 200] + rng.normal(size=32) * rng.choice([0.05, 0.2, 0.3])
    x[300:330] = x[0]
    x = x.astype(np.float32)
    rows = [(i, [float(v) for v in x[i]], 1, "s") for i in range(400)]
    rows += [(400, None, 1, "s"), (401, [], 1, "s"), (402, [0.0] * 32, 1, "s"), (403, [math.nan] * 32, 1, "s"),
             (404, [None] * 32, 1, "s"), (405, [math.inf] * 32, 1, "s"), (406, [1.0] * 8, 1, "s"), (407, [1.0] * 8, 1, "s"),
             (408, [1e-30] * 8, 1, "s")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = {(i, j) for i, j in zip(*np.nonzero(u @ u.T >= 0.95)) if i != j} | {
        (a, b) for a in (406, 407, 408) for b in (406, 407, 408) if a != b}
    label = brute_classes(409, links)
    for margin in (1.0, 0.5):
        got = {r.vec_id: (r.component_id, r.n_links, r.kept) for r in near_copies(frame, margin=margin).collect()}
        assert got == {i: (label[i], sum(a == i for a, _ in links), label[i] == i) for i in range(409)}
    assert near_copies(frame.limit(0)).count() == 0


def test_pq_blocks(spark, monkeypatch):
    """One hot list, many blocks: the same links."""
    import numpy as np
    from moundlake.llm import pq_dedup
    monkeypatch.setattr(pq_dedup, "MOST_LISTS", 2)
    rng = np.random.default_rng(6)
    x = (np.ones(16) + rng.normal(size=(150, 16)) * 0.25).astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    n = (u @ u.T >= 0.95).sum(axis=1) - 1
    frame = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(150)], "node long, embedding array<float>") \
        .withColumn("copies", F.lit(1).cast("long"))
    found = pq_dedup.near_links(pq_dedup._pack(frame), 0.95, 1.0, block=40).where("links > 0").groupBy("a").agg(F.sum("links").alias("n"))
    assert {r.a: r.n for r in found.collect()} == {i: int(n[i]) for i in range(150) if n[i]}


# --- operator 6


def test_exponent_meets_entropy_and_repeats(spark):
    from moundlake.llm.mixing import STEPS, entropy_between, find_exponent
    tokens = [10_000, 3_000, 500, 500, 7]
    totals = spark.createDataFrame([(f"v{i}", t, t) for i, t in enumerate(tokens)] + [("vz", 0, 4)], "src string, tokens long, n_rows long")

    def entropy(k):
        p = [t ** (k / STEPS) for t in tokens]
        return -sum(x / sum(p) * math.log(x / sum(p)) for x in p)

    for fraction in (0.0, 0.3, 0.9, 1.0):
        wanted = entropy_between(totals, fraction)
        k = find_exponent(totals, "entropy", wanted)
        assert abs(wanted - (entropy(STEPS) + fraction * (math.log(5) - entropy(STEPS)))) < 1e-9
        assert entropy(k) >= wanted - 1e-9 and (k == STEPS or entropy(k + 1) < wanted + 1e-9)
    for limit in (1.0, 2.0, 50.0, 1e6):
        k = find_exponent(totals, "repeats", limit)
        ratio = lambda k: (10_000 / 7) ** (1 - k / STEPS)
        assert ratio(k) <= limit * (1 + 1e-9) and (k == 0 or ratio(k - 1) > limit * (1 - 1e-9))


def test_mixing_streams(spark, texts):
    from moundlake.llm.mixing import mix_sources, mixed_rows
    many = (texts[:20] + [None, "", " "]) * 4
    docs = docs_frame(spark, many, sources=["big"] * 6 + ["small", "tiny", None])
    rows = mix_sources(docs, target="repeats", limit=3.0, block_rows=5).collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    largest = max(sum(len((many[i] or "").split()) for i in {r.doc_id for r in part}) for part in by.values())
    for source, part in by.items():
        ids = {r.doc_id for r in part}
        total = sum(len((many[i] or "").split()) for i in ids)
        first = sorted((r for r in part if r.epoch == 0), key=lambda r: (r.token_start, r.n_tokens))
        assert len(first) == len(ids) and len({(r.doc_id, r.epoch) for r in part}) == len(part)
        at = 0
        for r in sorted(part, key=lambda r: (r.token_start, r.n_tokens)):  # no gap and no overlap in the stream
            assert r.token_start == at and r.n_tokens == len((many[r.doc_id] or "").split())
            at += r.n_tokens
        assert total <= at <= 3.0 * total + 1e-6 and (largest < 3 * total or at > 0)
    assert {r.doc_id for r in rows} == set(range(len(many)))
    mixed = mixed_rows(docs, limit=2.0)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == len(many)
    assert mix_sources(docs.limit(0)).count() == 0


# --- operator 2


def test_toxicity_held_out(spark):
    from moundlake.llm import toxicity
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    train, test = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    model = toxicity.fit(docs, train)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == toxicity.GRADES
    got = docs.join(test, "doc_id").select("toxic", toxicity.severity(model, spark, F.col("text")).alias("s")).collect()
    wrong_clean = sum(r.s >= toxicity.REJECT_AT for r in got if not r.toxic) / sum(not r.toxic for r in got)
    caught = sum(r.s >= toxicity.REJECT_AT for r in got if r.toxic) / sum(bool(r.toxic) for r in got)
    assert wrong_clean <= 0.05 and caught >= 0.75


def test_ordinal_fit_orders_grades():
    from moundlake.llm.toxicity import OrdinalModel, fit_ordinal
    rnd = random.Random(2)
    rows, grades = [], []
    for _ in range(600):
        g = rnd.randrange(4)
        rows.append({0: g + rnd.gauss(0, 0.3), 1: rnd.random()})
        grades.append(g)
    w, t = fit_ordinal(rows, grades, 2)
    model = OrdinalModel({}, w, t)
    assert t == sorted(t) and w[0] > 5 * abs(w[1])
    assert sum(round(model.severity(r)) == g for r, g in zip(rows, grades)) > 500


def test_toxicity_edges(spark, texts):
    from moundlake.llm import toxicity
    docs = docs_frame(spark, texts)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, none).thresholds == []
    assert toxicity.keep_clean(docs, none).count() == len(texts)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(10)] + [(None, 1, 1), (3, None, None), (3, 1, 1)], "doc_id long, quality int, toxic int")
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(texts)
    assert toxicity.keep_clean(docs.limit(0), labels).count() == 0


# --- operator 7


def test_warc_round_trip(spark, tmp_path):
    from moundlake.llm import warc
    html = ["<p>" + "x" * 200, None, "", "short", "short", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 40, "é😀" * 30000,
            "<p>" + "x" * 200, "<p>" + "x" * 200, "0\r\n\r\n" * 50]
    rows = [(i, None if i == 3 else f"http://h/{i}\r\nX: y", h, "e") for i, h in enumerate(html)] + [(None, None, html[0], "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    got = warc.round_trip(pages, str(tmp_path / "w"), segment_bytes=1000).collect()
    assert len(got) == len(rows) and all(r.complete for r in got)
    for r in got:
        payload = (html[r.page_id] if r.page_id is not None else html[0]) or ""
        assert r.payload_bytes == len(payload.encode()) and r.payload_digest == hashlib.sha256(payload.encode()).hexdigest()
        again = r.page_id in (7, 8, None)
        assert (r.record_type, r.refers_to) == (("revisit", 0) if again else ("response", None))
    assert warc.round_trip(pages.limit(0), str(tmp_path / "empty")).count() == 0


def test_warc_broken_segments(spark):
    from moundlake.llm.warc import chunked, reassemble, unchunked
    body = bytes(range(256)) * 50
    assert unchunked(chunked(body, 100)) == body and unchunked(b"zz\r\n") is None and unchunked(chunked(body)[:-9]) is None
    kind = "type string, rid string, origin string, segment string, total string, page string, url string, digest string, refers string, block binary"

    def parts(name, numbers, total):
        return [("response" if k == 1 else "continuation", name if k == 1 else f"{name}-{k}", None if k == 1 else name, str(k),
                 str(total) if k == max(numbers) else None, "1", None, None, None, b"ab") for k in numbers]

    rows = parts("good", [1, 2, 3], 6) + parts("gap", [1, 3], 4) + parts("short", [1, 2], 5) + parts("headless", [2, 3], 4)
    got = {r.rid: r.block for r in reassemble(spark.createDataFrame(rows, kind)).collect()}
    assert got == {"good": bytearray(b"ababab"), "gap": None, "short": None, "headless": None}


# --- operator 8


def test_rollup_is_idempotent(spark, tmp_path):
    from moundlake.llm.token_rollup import TokenRollup
    kind = "source string, lang string, version string, docs int, tokens long, n string"
    frame = lambda *rows: spark.createDataFrame(list(rows), kind)
    r = TokenRollup(spark, str(tmp_path / "rollup"))
    assert r.totals().count() == 0
    assert r.commit("a", frame(("s", "en", "v1", 1, 10, "x"), ("s", "en", "v1", 1, 5, "x"), (None, None, "v1", 1, None, "x")))
    assert not r.commit("a", frame(("s", "en", "v1", 1, 99, "x")))
    assert r.commit("b", frame(("s", "en", "v1", 0, -3, "x"), ("t", "de", "v2", 1, 7, "x")))
    state = lambda: sorted(((x.source, x.lang, x.version, x.docs, x.tokens) for x in r.totals().collect()), key=str)
    expected = sorted([("s", "en", "v1", 2, 12), (None, None, "v1", 1, 0), ("t", "de", "v2", 1, 7)], key=str)
    assert state() == expected
    r.compact()
    assert state() == expected and not r.commit("b", frame(("s", "en", "v1", 0, -3, "x")))
    # a batch that was cut off has files but no marker: it does not count and is written anew
    frame(("s", "en", "v1", 9, 9, "x")).drop("n").write.parquet(str(tmp_path / "rollup/batches/c"))
    (tmp_path / "rollup/batches/c/_SUCCESS").unlink()
    assert state() == expected
    assert r.commit("c", frame(("t", "de", "v2", -1, -7, "x"))) and r.commit("empty", spark.createDataFrame([], kind))
    r.compact()
    assert state() == sorted([("s", "en", "v1", 2, 12), (None, None, "v1", 1, 0)], key=str)
    with pytest.raises(ValueError):
        r.commit("../x", frame(("s", "en", "v1", 1, 1, "x")))


def test_bpe_counts_for_the_rollup(spark, texts):
    from tokenizers import Tokenizer
    from moundlake.llm import bpe
    from moundlake.llm.token_rollup import bpe_counter
    lib = Tokenizer.from_file(bpe.tokenizer_path())
    count = bpe_counter(spark, bpe.tokenizer_path())
    rows = docs_frame(spark, texts).select("doc_id", count(F.coalesce("text", F.lit(""))).alias("n")).collect()
    assert {r.doc_id: r.n for r in rows} == {i: len(lib.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


# --- operator 9


def test_cross_entropy_difference(spark, texts):
    from moundlake.llm.lm_scoring import LAMBDA, cross_entropy_difference
    import re
    some = texts + ["alpha beta gamma alpha beta", "beta gamma alpha delta", "alpha beta"]
    docs = docs_frame(spark, some)
    docs = docs.union(docs.where("doc_id = 2"))
    target = spark.createDataFrame([(len(texts),), (1,), (1,), (None,)], "doc_id long")
    all_texts = some + [some[2]]
    for most in (40, 100_000):
        split = [re.findall(r"\w+", (t or "").lower()) for t in all_texts]
        count = {}
        for w in (w for s in split for w in s):
            count[w] = count.get(w, 0) + 1
        cut = next((n for n in sorted(set(count.values())) if sum(c >= n for c in count.values()) <= most), None)
        vocab = {w for w, c in count.items() if cut and c >= cut}
        coded = [[w if w in vocab else "<unk>" for w in s] for s in split]
        size = len(vocab) + 2

        def model(rows):
            uni, hist, bi = {}, {}, {}
            for s in rows:
                for h, w in zip(["<s>", *s], s):
                    uni[w] = uni.get(w, 0) + 1
                    hist[h] = hist.get(h, 0) + 1
                    bi[h, w] = bi.get((h, w), 0) + 1
            n = sum(uni.values())
            return lambda h, w: -math.log(LAMBDA * bi.get((h, w), 0) / max(hist.get(h, 0), 1) + (1 - LAMBDA) * (uni.get(w, 0) + 1) / (n + size))

        back, goal = model(coded), model([coded[len(texts)], coded[1]])
        rows = cross_entropy_difference(docs, target, words=most, chunk_tokens=150, shard_tokens=4000).collect()
        assert len(rows) == len(all_texts)
        for r in rows:
            s = coded[r.doc_id]
            assert r.n_tokens == len(s) and r.in_target == (r.doc_id in (len(texts), 1))
            want = sum(goal(h, w) - back(h, w) for h, w in zip(["<s>", *s], s)) / len(s) if s else None
            assert r.score is None if want is None else r.score == pytest.approx(want, abs=1e-4)
    assert cross_entropy_difference(docs.limit(0), target).count() == 0


def test_cross_entropy_difference_keeps_every_word(spark):
    """More distinct words than 30,000, each once: rare words of the target are told from those of the background."""
    from moundlake.llm.lm_scoring import cross_entropy_difference
    rows = [" ".join(f"r{i}x{k}" for k in range(400)) for i in range(100)]
    docs = docs_frame(spark, rows + [rows[0], rows[1]])
    scores = {r.doc_id: r.score for r in cross_entropy_difference(docs, spark.createDataFrame([(0,)], "doc_id long")).collect()}
    size, n_b, n_t = 40_000 + 2, 102 * 400, 400
    loss = lambda bi, h, w, n: -math.log(0.7 * bi / max(h, 1) + 0.3 * (w + 1) / (n + size))
    want = {100: (loss(1, 1, 1, n_t) - loss(2, 102, 2, n_b) + 399 * (loss(1, 1, 1, n_t) - loss(2, 2, 2, n_b))) / 400,
            101: (loss(0, 1, 0, n_t) - loss(2, 102, 2, n_b) + 399 * (loss(0, 0, 0, n_t) - loss(2, 2, 2, n_b))) / 400,
            50: (loss(0, 1, 0, n_t) - loss(1, 102, 1, n_b) + 399 * (loss(0, 0, 0, n_t) - loss(1, 1, 1, n_b))) / 400}
    assert {k: scores[k] for k in want} == pytest.approx(want, abs=1e-4)
