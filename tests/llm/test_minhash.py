"""b-bit MinHash: signatures, groups against brute force, groups dealt over several tasks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgecurve.llm import minhash
from tests.llm.fixtures import empty, frame, prose, rows
from tests.llm.test_simhash import closure


def plain_set(text, size=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1)))


def linked(a, b):
    common = len(a & b)
    return bool(common) and 100 * common >= 85 * (len(a) + len(b) - common)


def edited(seed: int, words: int, change: int) -> str:
    """A text of a family with ``change`` words of it replaced at its end."""
    return prose(seed, words - change) + (" " + prose(seed + 1000 + change, change) if change else "")


def families() -> list[tuple[int, str]]:
    r, out = random.Random(5), []
    for family in range(12):
        words = r.choice([6, 9, 30, 80, 400])
        for _ in range(6):
            out.append((100 + len(out), edited(family, words, r.randint(0, max(1, words // 8)))))
    return out


@pytest.mark.parametrize("members", [512, 3])
def test_components_equal_brute_force(spark, members, monkeypatch):
    monkeypatch.setattr(minhash, "MEMBERS", members)
    monkeypatch.setattr(minhash.confirmed, "__defaults__", (members, minhash.SHINGLES))
    data = [r for r in rows() if r[0] is not None] + families()
    sets = [plain_set(t) for _, t in data]
    got = minhash.minhash_groups(frame(spark, data)).collect()
    places = closure(range(len(data)), lambda a, b: linked(sets[a], sets[b]))
    want = sorted((data[n][0], len(sets[n]), min(data[m][0] for m in places if places[m] == places[n])) for n in places)
    assert sorted((r.id, r.n, r.component) for r in got) == want
    assert len({p for p in places.values()}) < len(data) - 20  # the fixture has links


def test_a_large_group_in_parts(spark):
    """A chain in which only neighbours link stays one group however its sets are dealt."""
    words = prose(3, 400).split()
    data = [(n, " ".join(words[n * 12 : n * 12 + 200])) for n in range(16)]
    sets = [plain_set(t) for _, t in data]
    assert linked(sets[0], sets[1]) and not linked(sets[0], sets[2])
    docs = frame(spark, data)
    assert {r.component for r in minhash.minhash_groups(docs).collect()} == {0}
    hashed = minhash.Shingles(5)
    held = [hashed(t.encode()) for _, t in data]
    made = [(n, 0, len(s), minhash.packed_bits(minhash.minima(s)), s.tobytes()) for n, s in enumerate(held)]
    table = spark.createDataFrame([(a, b, c, bytearray(d), bytearray(e)) for a, b, c, d, e in made], "fp long, root long, size long, bits binary, shingles binary")
    found = minhash.confirmed(table, 85, members=2).collect()
    assert {r.node: r.root for r in found} == {n: 0 for n in range(16)}


@pytest.mark.parametrize("bucket", [1024, 4])
def test_full_buckets_lose_no_candidate(spark, bucket):
    data = [(n, edited(7, 200, n % 9)) for n in range(9)]
    shingled = minhash.Shingles(5)
    sets = [shingled(t.encode()) for _, t in data]
    made = [(n, minhash.packed_bits(minhash.minima(s)), minhash.signed(minhash.band_keys(minhash.minima(s))).tolist()) for n, s in enumerate(sets)]
    distinct = spark.createDataFrame([(n, bytearray(b), k) for n, b, k in made], "fp long, bits binary, bands array<long>")
    nodes = {x for r in minhash.candidates(distinct, 0.85, bucket).collect() for x in (r.a, r.b)}
    assert nodes == set(range(9))


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.85, 0.95):
        found = []
        for _ in range(60):
            common = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
            n = round(2000 * share)
            rest = (2000 - n) // 2
            a = np.concatenate([common[:n], rng.integers(0, 1 << 63, rest, dtype=np.uint64)])
            b = np.concatenate([common[:n], rng.integers(0, 1 << 63, rest, dtype=np.uint64)])
            lanes = [np.frombuffer(minhash.packed_bits(minhash.minima(x)), dtype=np.uint64) for x in (a, b)]
            equal = int(minhash.equal_lanes(lanes[0][None], lanes[1])[0])
            low = (1 << minhash.BITS) - 1
            plain = [minhash.mixed(minhash.minima(x)) & np.uint64(low) for x in (a, b)]
            assert equal == int((plain[0] == plain[1]).sum())
            found.append(float(minhash.estimated(equal)))
        assert abs(np.mean(found) - share) < 0.02
    assert minhash.estimated(minhash.least_lanes(0.85)) > 0.6


def test_pairs_at_the_limit_meet():
    rng, missed = np.random.default_rng(2), 0
    for _ in range(400):
        values = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = np.sort(values[:370]), np.sort(values[30:])  # 340 of 400 in common
        missed += not (minhash.band_keys(minhash.minima(a)) == minhash.band_keys(minhash.minima(b))).any()
    assert missed == 0


def test_edge_cases(spark):
    assert minhash.minhash_groups(empty(spark)).collect() == []
    data = [(None, "one two three"), (None, "ONE two  three"), (5, "ONE two  three"), (6, ""), (7, None), (None, " \n"), (8, "x " * 100_000)]
    got = minhash.minhash_groups(frame(spark, data))
    out = sorted(((r.id, r.n, r.component) for r in got.collect()), key=str)
    assert out == sorted([(None, 1, 5), (None, 1, 5), (5, 1, 5), (6, 0, 6), (7, 0, 7), (None, 0, None), (8, 1, 8)], key=str)


def test_query(spark, sf_dir):
    got = minhash.op11_minhash(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    sets = [plain_set(r.text) for r in docs]
    places = closure(range(len(docs)), lambda a, b: linked(sets[a], sets[b]))
    want = {docs[n].doc_id: min(docs[m].doc_id for m in places if places[m] == places[n]) for n in places}
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert got.where(F.col("kept") != (F.col("doc_id") == F.col("component_id"))).count() == 0
