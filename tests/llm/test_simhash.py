"""Fingerprints, links and groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from lodgecurve.llm import components, simhash
from tests.llm.fixtures import empty, frame, prose, rows


def plain_fingerprint(text, size=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def closure(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark):
    data = [r for r in rows() if r[0] is not None]
    got = simhash.near_duplicates(frame(spark, data)).collect()
    fps = [(i, plain_fingerprint(t)) for i, t in data]
    assert sorted((r.id, r.fp % (1 << 64)) for r in got) == sorted(fps)
    places = closure(range(len(fps)), lambda a, b: (fps[a][1] ^ fps[b][1]).bit_count() <= 3)
    want = sorted((fps[n][0], min(fps[m][0] for m in places if places[m] == places[n])) for n in places)
    assert sorted((r.id, r.component) for r in got) == want


@pytest.mark.parametrize("bucket", [4096, 5])
def test_links_connect_all_close_values(spark, bucket):
    r = random.Random(7)
    centres = [r.getrandbits(64) for _ in range(6)]
    values = {c ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 3))) for c in centres for _ in range(60)} | {r.getrandbits(64) for _ in range(50)}
    values = {v % (1 << 64) for v in values}
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = components.components(simhash.links(df, 3, 5, bucket)).collect()
    want = closure(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {r.node: r.root for r in found} == {n: x for n, x in want.items() if list(want.values()).count(x) > 1}


def test_components_of_a_path_a_hub_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([*path, *hub, (5, 5), (7, 6), (None, 3), (2000, 2000)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(200)}}
    assert components.components(edges.where("false")).count() == 0


def test_block_masks_keep_a_common_block():
    for distance, blocks in ((3, 4), (3, 5), (2, 6)):
        masks = simhash.block_masks(distance, blocks)
        r = random.Random(1)
        for _ in range(200):
            flips = sum(1 << k for k in r.sample(range(64), distance))
            assert any(flips & m == 0 for m in masks)
    with pytest.raises(ValueError):
        simhash.block_masks(4, 4)


def test_one_of_each_group_of_copies_and_near_copies_stays(spark):
    base = [(100 + i, prose(50 + i, 180)) for i in range(5)]
    near = [(200 + i, t.replace(t.split()[90], "changed", 1)) for i, (_, t) in enumerate(base)]
    again = [(300, base[0][1]), (90, base[1][1]), (400, None), (401, ""), (100, base[0][1])]
    docs = frame(spark, base + near + again)
    kept = simhash.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [90, 100, 102, 103, 104, 400]


def test_null_ids_and_empty_tables(spark):
    kept = simhash.kept_documents(frame(spark, [(None, prose(1, 80)), (None, prose(2, 80)), (None, prose(1, 80))]))
    assert kept.count() == 2
    assert simhash.kept_documents(empty(spark)).count() == 0
    assert simhash.near_duplicates(empty(spark)).count() == 0
