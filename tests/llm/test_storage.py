import base64
import gzip
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcohort.llm import packing, sharding, warc
from fieldcohort.session import scratch_path

from .cases import corpus, documents, empty


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 17, 64, 65, 1000])
def test_the_shuffle_permutes_and_can_be_reversed(count):
    shuffle = sharding.Shuffle(count, seed=3)
    places = shuffle.forward(np.arange(count))
    assert sorted(places) == list(range(count)) and (shuffle.inverse(places) == np.arange(count)).all()
    assert count < 64 or np.abs(np.diff(places)).mean() > count / 6
    assert count < 64 or (sharding.Shuffle(count, seed=4).forward(np.arange(count)) != places).any()


@pytest.mark.parametrize("extra", [False, True])
def test_shards_are_even_and_computable(spark, extra):
    docs = documents(spark, extra=extra)
    order = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary"))]
    rows = sharding.assign(docs, 7, order, seed=1).collect()
    count = docs.count()
    assert sorted(r.number for r in rows) == list(range(count))
    sizes = {}
    for r in rows:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    shuffle = sharding.Shuffle(count, 1)
    assert all(shuffle.row_of(r.shard, r.slot, 7) == r.number for r in rows)
    ids = [r.row.doc_id for r in sorted(rows, key=lambda r: r.number)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    again = sharding.assign(docs.repartition(5), 7, order, seed=1).collect()
    assert {(r.row.doc_id, r.row.text, r.shard, r.slot) for r in again if r.row.doc_id not in (None, 7)} == {(r.row.doc_id, r.row.text, r.shard, r.slot) for r in rows if r.row.doc_id not in (None, 7)}
    assert sharding.assign(empty(spark), 7, [F.col("doc_id")]).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    path = f"{tmp_path}/shards"
    sharding.write_shards(sharding.assign(documents(spark), 3, [F.col("doc_id")]), path)
    back = spark.read.parquet(path)
    assert back.count() == len(corpus()) and back.select("shard").distinct().count() == 3


def test_both_encoders_agree():
    files = packing.tokenizer_files()
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(files[0])
    assert 50256 in packing.encode("a <|endoftext|> b", files)
    for text in ("", " ", "a", "Hello  world\n\n\tit's 123 é漢字🙂 <|endoftext|> x", "word " * 50, " " * 40 + "x", "a" * 5000, " \n" * 3000 + "b", "é" * 4000):
        assert list(packing.encode(text, files)) == slow.encode(text, add_special_tokens=False).ids, text[:20]


def test_fill_keeps_every_limit():
    rng = np.random.default_rng(4)
    demands = np.stack([rng.integers(1, 1024, 500), np.ones(500), rng.integers(0, 300, 500)], axis=1).astype(float)
    limits = np.array([1024, 4, 512], float)
    placed = packing.fill(demands, limits)
    for b in np.unique(placed):
        assert (demands[placed == b].sum(axis=0) <= limits).all()
    assert len(np.unique(placed)) < 1.15 * max(demands.sum(axis=0) / limits)
    assert len(packing.fill(demands[:0], limits)) == 0


@pytest.mark.parametrize("extra", [False, True])
def test_pieces_hold_every_id_once(spark, extra):
    rows = corpus()
    files = packing.tokenizer_files()
    want = sorted(([*packing.encode(r[1] or "", files), 0] for r in rows), key=str)
    found = packing.pack(documents(spark, rows, extra), tokens=256, segments=5, loss_tokens=200, keep_ids=True).collect()
    sequences, documents_ids = {}, {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        documents_ids.setdefault((r.row.doc_id, r.doc_tokens), {}).setdefault(r.start, []).append(r.ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256 and len(pieces) <= 5 and sum(r.length - (r.start == 0) for r in pieces) <= 200
    rebuilt = [[i for start in sorted(parts) for i in parts[start][k]] for parts in documents_ids.values() for k in range(len(parts[0]))]
    assert sorted(rebuilt, key=str) == want
    assert packing.pack(empty(spark)).count() == 0


PAGES = [(1, "u", "a"), (2, None, "a"), (2, "x", "a"), (None, "y", "a"), (3, "z\r\nq: r", None), (4, "z", ""), (5, "k", "b"), (5, "k", "b"), (6, "é", "<p>ß\r\n\r\nWARC/1.0</p>" * 4000), (7, "v", None)]


@pytest.mark.parametrize("extra", [False, True])
def test_archives_round_trip(spark, extra):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    if extra:
        for name in ("uid", "row", "at", "digest", "original", "same", "bytes"):
            pages = pages.withColumn(name, F.lit("clash"))
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(pages, folder)
    read = warc.read_records(index, folder).join(index.select("uid", "page_id", "refers_to", F.col("record_type").alias("kind"), "original"), "uid").collect()
    assert len(read) == len(PAGES)
    by_payload = {}
    for p, _, h in PAGES:
        by_payload.setdefault(h or "", []).append(p)
    for r in read:
        assert r.kind == r.record_type
        if r.record_type == "response":
            text = r.payload.decode()
            assert r.page_id == max((p for p in by_payload[text] if p is not None), default=None) and r.refers_to is None
            assert r.payload_bytes == len(r.payload)
        else:
            assert r.refers is not None and r.payload == b""
    assert sorted(r.payload.decode() for r in read if r.record_type == "response") == sorted(by_payload)
    told = {r.record: r.payload_digest for r in read}
    assert all(told[r.refers] == r.payload_digest for r in read if r.refers)
    assert {r.payload_digest for r in read} == {base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in by_payload}
    assert warc.read_records(index.where("page_id = 6"), folder).first().payload.decode() == PAGES[8][2]
    high = warc.write_archives(pages, scratch_path(spark, "warc"), least_bytes=1).where("record_type = 'revisit'")
    assert {r.page_id for r in high.collect()} == {1, 2, None, 5}
    assert warc.write_archives(pages.limit(0), scratch_path(spark, "warc")).count() == 0


def test_near_ranges_are_read_together(spark, monkeypatch):
    rows = [("a", 0, 10, 1), ("a", 10, 10, 2), ("a", 200_000, 10, 3), ("a", 200_010, 5, 4), ("b", 0, 7, 5)]
    plan = warc.read_plan(spark.createDataFrame(rows, "archive string, at long, length long, uid long")).collect()
    assert sorted((r.archive, r.start, r.end, len(r.records)) for r in plan) == [("a", 0, 20, 2), ("a", 200_000, 200_015, 2), ("b", 0, 7, 1)]


def test_archives_are_plain_gzip_members():
    one = gzip.compress(warc.record(1, "u", b"abc", warc.digest32(b"abc"), None)) + gzip.compress(warc.record(2, "v", b"abc", warc.digest32(b"abc"), 1))
    raw = gzip.decompress(one)
    assert raw.count(b"WARC/1.0\r\n") == 2 and b"WARC-Type: revisit" in raw
    assert warc.parse(raw)[1:] == (b"abc", 3)
