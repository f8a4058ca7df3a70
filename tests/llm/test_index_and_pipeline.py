"""Recall and exactness of the multi-index, and the pipeline from end to end."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodgecurve.llm import multi_index
from lodgecurve.llm.queries import ORACLE, QUERIES
from tests.llm.fixtures import frame, prose

SCHEMA = "vec_id long, embedding array<float>, v string, id string, q string, cell string"


def vectors(spark, data):
    return spark.createDataFrame([(i, v, *["x"] * 4) for i, v in data], SCHEMA)


def brute(data, queries, k):
    dim = max((len(v) for _, v in data if v), default=0)
    fine = lambda v: v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = {(i, tuple(np.float32(v).tolist())) for i, v in data if i is not None and fine(v)}
    out = {}
    for q, v in rows:
        if q in queries:
            best = {}
            for i, w in rows:
                if i != q:
                    best[i] = max(best.get(i, -math.inf), float(np.dot(v, w)))
            out[q] = heapq.nsmallest(k, ((-s, i) for i, s in best.items()))
    return out


@pytest.fixture(scope="module")
def some():
    r = np.random.default_rng(2)
    centres = r.standard_normal((12, 16))
    data = [(i, (centres[i % 12] + 0.4 * r.standard_normal(16)).tolist()) for i in range(900)]
    copies = [(1000 + i, data[5][1]) for i in range(60)] + [(40, data[40][1]), (2000, (np.array(data[3][1]) * 2).tolist())]
    odd = [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] + [1.0] * 15), (3003, [None] + [1.0] * 15), (3004, [1.0, 2.0]), (None, data[1][1]), (3005, [float("inf")] * 16)]
    return data + copies + odd


def test_neighbours_against_brute_force(spark, some):
    df = vectors(spark, some)
    queries = {i for i, _ in some if i is not None and i % 20 == 0}
    want = brute(some, queries, 20)
    got = multi_index.neighbours(df, df.where("vec_id % 20 = 0")).collect()
    by = {q: sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) for q in want}
    assert {r.query_id for r in got} == set(want)
    hits = 0
    for q, best in want.items():
        assert [x[0] for x in by[q]] == list(range(1, 21))
        assert [(-x[2], x[1]) for x in by[q]] == sorted((-x[2], x[1]) for x in by[q])
        hits += len({i for _, i in best} & {x[1] for x in by[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_small_tables_are_searched_whole(spark):
    data = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(30)]
    df = vectors(spark, data)
    got = multi_index.neighbours(df, df, k=7).collect()
    for q, best in brute(data, set(range(30)), 7).items():
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [(i, -s) for s, i in best]
    assert multi_index.neighbours(df.where("vec_id < 3"), df, k=7).where("query_id = 0").count() == 2
    assert multi_index.neighbours(df.where("false"), df.where("false")).count() == 0
    assert multi_index.neighbours(df.where("vec_id = 1"), df.where("vec_id = 1")).count() == 0


def test_walk_goes_by_summed_distance():
    r = np.random.default_rng(1)
    for _ in range(30):
        a, b = r.random(6), r.random(7)
        counts = r.integers(0, 3, 42)
        want = [c for c in sorted(range(42), key=lambda c: a[c // 7] + b[c % 7]) if counts[c]]
        assert multi_index.walk(a, b, counts, 10**9) == want
        part = multi_index.walk(a, b, counts, 5)
        assert part == want[: len(part)] and counts[part].sum() >= 5 > counts[part[:-1]].sum()


def test_pipeline_end_to_end(spark, tmp_path):
    passage = prose(3, 120)
    data = []
    for i in range(160):
        text = prose(2000 + i, 150)
        if i % 8 == 0:
            text = " ".join(w + (" vilewretch scumlord" if k % 30 == 5 else "") for k, w in enumerate(text.split()))
        data.append((i, text))
    data += [(1000 + i, data[i][1]) for i in (1, 2, 3)] + [(2000 + i, data[i][1].replace(" ", " \n ", 1).title()) for i in (4, 5)]
    data += [(3000 + i, prose(4000 + i, 80) + " " + passage + " " + prose(5000 + i, 30)) for i in range(3)] + [(4000, None), (4001, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 8 != 0 and i % 5 != 0), int(i % 8 == 0)) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(f"{tmp_path}/{name}")
        now = seen[name] = spark.read.parquet(f"{tmp_path}/{name}")
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    toxic = {i for i, _, t in labels if t}
    assert len(ids["toxicity"] & toxic) <= 2 and len(set(range(160)) - toxic - ids["toxicity"]) <= 2
    assert not ids["near_dedup"] & {1001, 1002, 1003, 2004, 2005} and len(ids["near_dedup"] & {4000, 4001}) == 1
    assert ids["repeat_dedup"] == ids["near_dedup"] == ids["mixing"] == ids["packing"]
    cut = seen["repeat_dedup"]
    assert cut.where(F.col("text").contains(passage[200:300])).count() == 0
    assert cut.where("n_chars <> length(coalesce(text, ''))").count() == 0
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, seen["packing"].select(*run.columns).collect()))


def test_registered_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_pipeline_targets_move_the_mix_and_can_be_reached():
    import pyarrow.parquet as pq

    import corpus_pipeline

    folder = "/root/testdata/sf0.01"
    quality = dict(zip(*pq.read_table(f"{folder}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values()))
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    words = {"high": 0, "low": 0}
    for i, text in zip(docs["doc_id"], docs["text"]):
        if quality.get(i) in (0, 1):
            words["high" if quality[i] else "low"] += len((text or "").split())
    for name, n in words.items():
        share, target = n / sum(words.values()), corpus_pipeline.SHARES[name]
        assert abs(share - target) > 0.04 and target * corpus_pipeline.BUDGET > share  # rates of one at least
