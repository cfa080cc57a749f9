"""The stages of the corpus pipeline, each against brute force on its own input."""

import hashlib

from tests.llm.test_text_operators import brute_classes, brute_links, docs_frame, norm, texts, words  # noqa: F401


def test_stages(spark, texts, tmp_path):  # noqa: F811
    import corpus_pipeline as P
    from tokenizers import Tokenizer
    from moundlake.llm import bpe
    lib = Tokenizer.from_file(bpe.tokenizer_path())
    rare = lambda i: [hashlib.md5(f"{w} {i}".encode()).hexdigest()[:9] for w in words(i, 38)]
    clean = [" ".join(rare(500 + i)) for i in range(40)]
    toxic = [" ".join([*rare(700 + i), "idiot", "scum"]) for i in range(20)]
    both = texts + clean + toxic
    docs = docs_frame(spark, both)
    n = len(texts) + len(clean)
    labels = [(len(texts) + i, 1, 0) for i in range(40)] + [(n + i, 1, 1) for i in range(12)]
    sf = str(tmp_path / "sf")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs.write.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        before = spark.read.parquet(f"{sf}/documents.parquet" if not k else f"{tmp_path}/{k - 1}")
        assert stage(spark, before.limit(0), sf).count() == 0
        stage(spark, before, sf).write.parquet(f"{tmp_path}/{k}")
        given, kept = before.collect(), spark.read.parquet(f"{tmp_path}/{k}").collect()
        ids = sorted(r.doc_id for r in kept)
        by_id = {r.doc_id: r for r in given}
        if k < 4:
            assert all(r == by_id[r.doc_id] for r in kept)  # rows as they were, all columns
        if name == "toxicity":
            assert ids == list(range(n))
        elif name == "exact dedup":
            first = {}
            for r in sorted(given, key=lambda r: r.doc_id):
                first.setdefault(norm(r.text), r.doc_id)
            assert ids == sorted(first.values())
        elif name == "n-gram Jaccard join":
            order = sorted(given, key=lambda r: r.doc_id)
            label = brute_classes(len(order), brute_links([r.text for r in order]))
            assert ids == sorted({order[x].doc_id for x in label})
        elif name == "mixing":
            assert set(ids) == set(by_id) and all(1 <= ids.count(i) <= 2 for i in set(ids))
        else:
            assert sorted(r.doc_id for r in given) == ids
            texts_by = {r.doc_id: r.text or "" for r in given}
            for r in kept:
                want = lib.encode(texts_by[r.doc_id], add_special_tokens=False).ids
                assert list(r.ids) == want and r.n_tokens == len(want)
                assert r.decoded_sha256 == hashlib.sha256(lib.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_registered(spark):
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
