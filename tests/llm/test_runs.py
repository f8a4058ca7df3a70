"""Periodic runs against a search over every lag."""

import hashlib
import random
import zlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from lodgecurve.llm import runs
from lodgecurve.llm.runs import Runs
from tests.llm.fixtures import empty, frame, prose, rows


def plain_runs(words, least=24, repeats=3):
    n, out = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, repeats * q):
                out.setdefault((i, j - i + q), q)  # the smallest comes first
            i = j
    return sorted((s, m, q) for (s, m), q in out.items())


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    milli = None if not found else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=12), st.integers(1, 12)), max_size=8))
def test_find_equals_every_lag(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert Runs().find(words) == plain_runs(words)
    assert Runs(6, 2).find(words) == plain_runs(words, 6, 2)
    assert Runs(10, 4).find(words) == plain_runs(words, 10, 4)


def test_long_periods_nested_and_neighbouring_runs():
    r = random.Random(3)
    word = lambda: b"w%d" % r.randrange(40)
    for _ in range(25):
        inner = [word() for _ in range(r.randint(1, 4))]
        block = [word() for _ in range(r.randint(5, 60))] + inner * r.randint(1, 12)
        words = [word() for _ in range(r.randint(0, 30))] + block * r.randint(1, 7)
        words += words[len(words) // 2 :][: r.randint(0, 50)] + [word() for _ in range(20)] + inner * 30
        assert Runs().find(words) == plain_runs(words)


def test_grams_that_recur_within_a_period():
    """Every gram occurs twice in a period, so the next occurrence is never a period on."""
    x, y, z = ([b"%s%d" % (c, k) for k in range(20)] for c in (b"x", b"y", b"z"))
    period = x + y + x + z + y + z
    assert Runs().find(period * 3) == plain_runs(period * 3) == [(0, 360, 120)]


def test_the_guaranteed_overlap():
    assert Runs().gram == 16
    assert [Runs(8, 2).gram, Runs(2, 2).gram] == [4, 1]


def test_very_long_and_very_repetitive_texts():
    assert Runs().find([b"a"] * 200_000) == [(0, 200_000, 1)]
    period = prose(1, 700).encode().split()
    found = Runs().find(period * 100)
    assert (0, 70_000, 700) in found


def test_rows(spark):
    data = rows() + [(i, "so it goes " * 20 + prose(i, 30)) for i in range(200, 240)]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data)
    got = runs.periodic_runs(frame(spark, data), rewrite=runs.planted).collect()
    for r, (i, t) in zip(sorted(got, key=lambda r: str((r.id, r.n_words))), sorted(data, key=lambda d: str((d[0], len((d[1] or "").encode().split()))))):
        assert (r.id, r.n_words) == (i, len((t or "").encode().split()))
    assert runs.periodic_runs(empty(spark)).collect() == []
    nothing = [r for r in got if not r.n_words]
    assert nothing and all(r.runs == [] and r.best is None and r.kept == "" for r in nothing)


def test_without_runs_keeps_rows_and_columns(spark):
    docs = frame(spark, [(1, "so it goes " * 20 + "end"), (2, "as  it is"), (3, None), (3, None), (None, "")])
    out = runs.without_runs(docs)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect() if r.text is not None) == [("1", "so it goes end"), ("2", "as  it is"), ("None", "")]
    assert out.count() == 5


def test_query(spark, sf_dir):
    got = runs.op13_runs(spark, sf_dir)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.dtypes == list(zip(names, ["bigint"] * 6 + ["string"] * 2))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: plain_row(r.doc_id, r.text) for r in docs if len((r.text or "").split()) < 700}
    seen = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(seen) == len(docs) and {k: seen[k] for k in want} == want
