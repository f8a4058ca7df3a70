"""Exact round trips of archives and packed sequences."""

import gzip
import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodgecurve.llm import common, packing, warc
from tests.llm.fixtures import empty, frame, prose, rows

PAGES = "page_id long, url string, html string, digest string, size string, shard string, payload string"


def pages(spark, data):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in data], PAGES).repartition(5)


def some_pages():
    body = "<p>" + prose(3, 40) + "</p>"
    return [
        (5, "http://a/5", body), (2, "http://a/2", body), (9, None, body), (9, "http://a/9b", body), (7, "http://x\r\nEvil: 1", "short"), (1, "u", "short"),
        (4, "http://ü/", None), (3, "http://a/3", ""), (None, "http://a/n", body), (8, "http://a/8", "é" * 5000), (8, "http://a/8", "other " * 40),
        *((100 + i, f"http://b/{i}", prose(40 + i, 200)) for i in range(40)),
    ]


def test_archives_read_back_whole(spark, tmp_path):
    data = some_pages()
    folder = f"file://{tmp_path}/out"
    files = warc.write_archives(pages(spark, data), folder, file_bytes=4000, shard_bytes=9000)
    got = warc.read_archives(files, folder).collect()
    assert len(got) == len(data) and files.count() > 3 and max(r.bytes for r in files.collect() if r.records > 1) <= 4000
    digest = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in got if r.page_id is not None) == sorted(
        (i, len((h or "").encode()), digest(h)) for i, _, h in data if i is not None
    )
    kinds = sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id is not None and r.page_id < 10)
    assert [k for k in kinds if k[1] == "revisit"] == [(5, "revisit", 2), (9, "revisit", 2), (9, "revisit", 2)]
    assert all(bytes(r.payload).decode() == (h or "") for r in got if r.record_type == "response" for i, _, h in data if i == r.page_id and digest(h) == r.payload_digest)
    assert sorted(os.path.basename(r.name) for r in files.collect()) == sorted(f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".gz"))


def test_the_same_rows_make_the_same_bytes(spark, tmp_path):
    for at, parts in (("a", 1), ("b", 7)):
        warc.write_archives(pages(spark, some_pages()).repartition(parts), f"file://{tmp_path}/{at}", file_bytes=4000, shard_bytes=9000)
    names = [f for f in os.listdir(f"{tmp_path}/a") if f.endswith(".gz")]
    assert names and all((tmp_path / "a" / f).read_bytes() == (tmp_path / "b" / f).read_bytes() for f in names)
    first = gzip.decompress((tmp_path / "a" / sorted(names)[0]).read_bytes())
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\r\nEvil" not in first


def test_files_that_no_manifest_lists_are_not_read_and_damage_is_seen(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    files = warc.write_archives(pages(spark, some_pages()), folder)
    (tmp_path / "out" / "part-999999-00000.warc.gz").write_bytes(b"left behind")
    assert warc.read_archives(files, folder).count() == len(some_pages())
    name = tmp_path / "out" / files.first().name
    name.write_bytes(name.read_bytes()[:-30])
    with pytest.raises(Exception, match="cut off|manifest|truncated|incomplete"):
        warc.read_archives(files, folder).collect()


def test_no_pages(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    files = warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert files.count() == 0 and warc.read_archives(files, folder).count() == 0


def test_borders_are_balanced_whatever_the_keys(spark):
    keys = [0] * 50 + [1 << 60] + [-(1 << 61)] * 3 + list(range(1000, 3000))
    df = spark.createDataFrame([(k, 1) for k in keys], "k long, n long")
    edges = common.balanced_borders(df, "k", "n", 100)
    sizes = np.bincount(np.searchsorted(edges, keys, side="right"))
    assert edges == sorted(set(edges)) and sizes.max() <= 200 and len(sizes) < 60
    assert edges == common.balanced_borders(df.repartition(3), "k", "n", 100)
    assert common.balanced_borders(df.where("false"), "k", "n", 100) == []


def test_every_token_lies_in_one_piece(spark):
    data = rows() + [(60, "it's <|endoftext|> 'S ok"), (61, "tab\tÉé\u0301 x\u00a0y\u2003z"), (62, prose(7, 2500))]
    plain = Tokenizer.from_file(packing.public_tokenizer())
    want = defaultdict(list)
    for i, t in data:
        want[i].append(plain.encode(t or "", add_special_tokens=False).ids + [2])
    got = packing.pack(frame(spark, data), packing.public_tokenizer(), length=512, stretch=1500).collect()
    total, sequences = 0, defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert ids in [w[r.start : r.start + r.length] for w in want[r.doc_id] if len(w) == r.doc_tokens]
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(ids) == r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        total += r.length
    assert total == sum(len(w) for ws in want.values() for w in ws) and {r.doc_id for r in got} == set(want)
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == 512 or at & (at - 1) == 0
    for i, ws in want.items():
        assert sum(r.length for r in got if r.doc_id == i) == sum(map(len, ws))


def test_neighbours_on_the_curve_touch():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = packing.hilbert(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_packing_nothing(spark):
    assert packing.pack(empty(spark), packing.public_tokenizer()).count() == 0
