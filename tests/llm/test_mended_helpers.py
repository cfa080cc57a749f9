"""Helpers that lost, multiplied or endlessly read data before."""

import pytest


@pytest.mark.parametrize("body, want", [
    (b"1\r\nA\r\n-6\r\n", None), (b"+1\r\nA\r\n0\r\n\r\n", None), (b"1_0\r\nA", None), (b"\r\n", None), (b"2;x=y\r\nAB\r\n0\r\n\r\n", b"AB"), (b"0\r\n\r\n", b"")])
def test_chunk_sizes_are_hex_digits(body, want):
    from moundlake.llm.warc import unchunked
    assert unchunked(body) == want


def test_shards_hold_every_row_once(spark, tmp_path):
    from moundlake.llm.hilbert import write_shards
    rows = [(None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (7, "c", "de", "t", 9), (7, "c", "de", "t", 9), (8, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    write_shards(docs, str(tmp_path / "s"), shards=2)
    back = spark.read.parquet(str(tmp_path / "s")).drop("_llm_shard").select(docs.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))


def test_compaction_beside_a_commit(spark, tmp_path, monkeypatch):
    """A batch that is committed while a compaction has listed the others is counted once."""
    from moundlake.llm import token_rollup as R
    rollup = R.TokenRollup(spark, str(tmp_path / "r"))
    change = lambda n: spark.createDataFrame([("s", "en", "v", 1, n)], "source string, lang string, version string, docs long, tokens long")

    def land(batch, n):  # a committed batch of one summed change
        change(n).write.mode("overwrite").parquet(rollup._batch(batch))
    land("one", 5)
    before = rollup._parts
    listed = before()

    def late():
        land("two", 10)
        monkeypatch.setattr(rollup, "_parts", before)
        return listed
    monkeypatch.setattr(rollup, "_parts", late)
    rollup.compact()
    assert [(r.docs, r.tokens) for r in rollup.totals().collect()] == [(2, 15)]


def test_rows_made_from_one_scanned_row_have_places_of_their_own(spark, tmp_path):
    """Exploded, united and grouped frames over a scan are staged; a plain scan is not."""
    from pyspark.sql import functions as F
    from moundlake.llm.common import with_locator
    from moundlake.llm.exact_dedup import dedup_exact, keep_first
    spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"])], "doc_id long, texts array<string>").write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    rows = scan.select("doc_id", F.explode("texts").alias("text"))
    for frame in (rows, scan.union(scan), scan.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), scan.where(F.rand(1) >= 0)):
        places = with_locator(frame).select("_llm_file", "_llm_row")
        assert places.distinct().count() == frame.count()
    plain = with_locator(scan.where("doc_id > 0").select("doc_id"))
    assert {r[0] for r in plain.select("_llm_file").collect()} <= {f for f in scan.inputFiles()} | {f.replace("file:///", "file:/") for f in scan.inputFiles()}
    assert sorted((r.doc_id, r.text) for r in keep_first(rows).collect()) == [(1, "a"), (1, "b")]
    assert sorted((r.keep_id, r.group_size, r.kept) for r in dedup_exact(rows).collect()) == [(1, 2, False)] * 2 + [(1, 2, True)] * 2


def test_rows_without_or_with_one_id_are_spread_over_blocks(spark, tmp_path):
    from pyspark.sql import functions as F
    from moundlake.llm.mixing import mix_sources, mixed_rows
    rows = [(None, f"w {i}", "s") for i in range(600)] + [(7, f"w {i}", "s") for i in range(500)] + [(1000 + i, "w w", "s") for i in range(100)] \
        + [(5000 + i, "w", "t") for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    read = mix_sources(docs, block_rows=50)
    first = read.where("epoch = 0")
    assert first.count() == len(rows)  # every row once in the first epoch
    largest = first.groupBy("source", "block").count().agg(F.max("count")).first()[0]
    assert largest <= 4 * 50
    for source in ("s", "t"):  # each source's stream has no gaps within an epoch
        at = 0
        for r in sorted(first.where(F.col("source") == source).collect(), key=lambda r: (r.token_start, r.n_tokens)):
            assert r.token_start == at
            at += r.n_tokens
    assert mixed_rows(docs).select("text", "source").distinct().count() == docs.select("text", "source").distinct().count()


def broken_archives():
    from moundlake.llm.warc import HTTP_HEAD, chunked, record
    good = lambda n: record([("WARC-Type", "response"), ("WARC-Record-ID", f"<r{n}>"), ("X-Page-Id", str(n))], HTTP_HEAD + chunked(b"page %d" % n)) + b"\r\n"
    one, two, three = good(1), good(2), good(3)
    no_length = two.replace(b"Content-Length", b"Content-Size")
    return {"garbage": (one + b"\x00garbage\r\n\r\n" + two, {1: b"page 1", None: None, 2: b"page 2"}),
            "one byte": (one + b"!", {1: b"page 1", None: None}),
            "cut off": (one + two[:-12], {1: b"page 1", 2: None}),
            "cut in the head": (one + two[:20], {1: b"page 1", None: None}),
            "no length": (one + no_length + three, {1: b"page 1", 2: None, 3: b"page 3"}),
            "negative": (one + two.replace(b"Content-Length: ", b"Content-Length: -") + three, {1: b"page 1", 2: None, 3: b"page 3"})}


@pytest.mark.parametrize("case", ["garbage", "one byte", "cut off", "cut in the head", "no length", "negative"])
def test_broken_records_are_reported_and_the_others_read(case):
    from moundlake.llm.warc import parse_records, payload_of
    data, want = broken_archives()[case]
    got = {int(h["x-page-id"]) if "x-page-id" in h else None: None if b is None else payload_of(b) for h, b in parse_records(data)}
    assert got == want


def test_archive_with_broken_files(spark, tmp_path):
    import gzip
    from moundlake.llm.warc import read_archive
    cases = broken_archives()
    for n, (data, _) in enumerate(cases.values()):
        (tmp_path / f"part-{n}").write_bytes(gzip.compress(data))
    whole = gzip.compress(cases["garbage"][0])
    (tmp_path / "part-damaged").write_bytes(whole + b"\x1f\x8b" + whole[2:20])
    (tmp_path / "part-cut").write_bytes(whole[:-9])
    rows = read_archive(spark, str(tmp_path)).collect()
    good = sum(v is not None for _, w in cases.values() for v in w.values())
    assert sum(r.complete for r in rows) >= good + 2
    assert all(r.payload is not None if r.complete else r.payload is None for r in rows)
    assert sum(not r.complete for r in rows) >= len(cases) + 1


def test_every_record_is_dated(spark, tmp_path):
    import gzip
    from moundlake.llm.warc import parse_records, round_trip, write_archive
    same = "x" * 300
    spark.createDataFrame([(1, "u", same), (2, "u", same), (3, None, "y" * 5000), (None, "u", None)], "page_id long, url string, html string") \
        .write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    write_archive(pages, str(tmp_path / "w"), segment_bytes=1000, date="2024-01-31T00:00:00Z")
    heads = [h for f in (tmp_path / "w").glob("part-*") for h, b in parse_records(gzip.decompress(f.read_bytes()))]
    assert len(heads) > 5 and {h["warc-date"] for h in heads} == {"2024-01-31T00:00:00Z"}
    assert {(r.page_id, r.refers_to, r.complete) for r in round_trip(pages, str(tmp_path / "v")).collect()} == {
        (1, None, True), (2, 1, True), (3, None, True), (None, None, True)}


def test_large_groups_meet_their_content_in_parts(spark, monkeypatch):
    """Groups cut into parts, every digest colliding, against grouping by the texts."""
    from pyspark.sql import functions as F
    from moundlake.llm import exact_dedup as E
    monkeypatch.setattr(E, "GROUP_PART", 3)
    texts = ["a"] * 25 + ["b"] * 10 + ["c", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for digest in (E.sha256, lambda t: F.lit("same")):
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in E.dedup_exact(docs, digest=digest).collect()}
        assert got == {i: (texts.index(t), texts.count(t), texts.index(t) == i) for i, t in enumerate(texts)}
