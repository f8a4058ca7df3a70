"""Toxicity, mixing and quality rules on small labelled corpora."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgecurve.llm import mixing, quality, toxicity
from tests.llm.fixtures import empty, frame, prose, rows

LABELS = "doc_id long, toxic int, quality int, text string, id string"


def labelled(n=240):
    r = random.Random(9)
    data, labels = [], []
    for i in range(n):
        toxic, low = i % 4 == 0, i % 5 == 0
        words = prose(900 + i, 60).split()
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["vilewretch", "scumlord", "dimwit"]))
        data.append((i, " ".join(w + ("###" if low else "") for w in words)))
        labels.append((i, int(toxic), int(not low), "x", "y"))
    return data, labels


def test_toxic_text_scores_high_and_held_out_labels_teach_nothing(spark):
    data, labels = labelled()
    docs, known = frame(spark, data), spark.createDataFrame(labels, LABELS)
    scores = {r.id: r.score for r in toxicity.toxicity_scores(docs, known).collect()}
    assert len(scores) == len(data) and all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[i] >= 0.5) == bool(t) for i, t, *_ in labels]) > 0.95
    held = {r.id for r in docs.select(F.col("doc_id").alias("id")).where(toxicity.held_out(F.col("id"))).collect()}
    turned = [(i, 1 - t if i in held else t, q, a, b) for i, t, q, a, b in labels]
    again = {r.id: r.score for r in toxicity.toxicity_scores(docs, spark.createDataFrame(turned, LABELS)).collect()}
    assert held and again == scores


def test_toxic_rows_go_and_others_stay_as_they_are(spark):
    data, labels = labelled()
    docs = frame(spark, data + [(9000, None), (9001, ""), (None, "plain words here")])
    kept = toxicity.without_toxic(docs, spark.createDataFrame(labels, LABELS))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and {9000, 9001, None} <= set(ids)
    toxic = {i for i, t, *_ in labels if t}
    assert len(toxic & set(ids)) <= 3 and len(set(ids) - toxic) >= len(data) - len(toxic) + 1


def test_a_term_of_few_toxic_documents_counts_however_many_there_are():
    common = [([b"plain", b"words", b"vilewretch"], 1)] * 2000 + [([b"plain", b"words"], 0)] * 4000
    rare = [([b"plain", b"scumlord"], 1)] * toxicity.LEAST_DOCUMENTS
    assert b"=scumlord" in toxicity.telling(common + rare) and b"=plain" not in toxicity.telling(common + rare)
    assert b"=scumlord" not in toxicity.telling(common + rare[1:])
    assert b"=scumlord" in toxicity.telling(common + rare[1:], least_documents=3)


def test_long_labelled_texts_train_where_the_caller_allows(spark):
    docs = frame(spark, [(1, "word " * 5000), (3, "few words")])
    known = spark.createDataFrame([(1, 1, 0, "", ""), (3, 0, 1, "", "")], LABELS)
    learnt = {r[0] for r in ((1,), (3,)) if docs.where(F.col("doc_id") == r[0]).where(~toxicity.held_out(F.col("doc_id"))).count()}
    for chars, ids in ((20_000, learnt - {1}), (30_000, learnt)):
        assert len(toxicity.training_rows(docs, known, "doc_id", "text", "toxic", (9, 9), chars)) == len(ids)


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    some = [r.score for r in toxicity.toxicity_scores(frame(spark), none).collect()]
    assert len(some) == len(rows()) and len(set(some)) == 1
    assert toxicity.toxicity_scores(empty(spark), none).count() == 0
    one_kind = spark.createDataFrame([(1, 0, 1, "", ""), (3, 0, None, "", ""), (None, 1, 1, "", ""), (4, None, 1, "", "")], LABELS)
    assert all(r.score < 0.5 for r in toxicity.toxicity_scores(frame(spark), one_kind).collect())


def test_rates_meet_the_targets(spark):
    data, labels = labelled()
    docs, known = frame(spark, data + [(9000, None), (9001, "")]), spark.createDataFrame(labels, LABELS)
    shares = {"high": 0.5, "low": 0.2, "toxic": 0.3}
    found = mixing.mixing_rates(docs, known, shares).collect()
    p, t, r = (np.array([x[c] for x in found], dtype=float) for c in ("p", "tokens", "rate"))
    assert np.allclose(p.sum(axis=1), 1) and (r >= 0).all() and len(found) == len(data) + 2
    assert np.allclose((r * t) @ p / t.sum(), list(shares.values()), rtol=2e-3)
    assert all(abs(x.copies - x.rate) < 1 for x in found)


def test_rates_are_the_least_squares_optimum():
    r = np.random.default_rng(3)
    p = r.dirichlet([0.3, 0.3, 0.3], 60)
    t = r.integers(1, 50, 60).astype(float)
    targets = np.array([0.05, 0.15, 2.0]) * t.sum()  # out of reach without negative rates
    weight = 1 / targets
    m = (p * t[:, None]).T @ p
    steepest = np.linalg.eigvalsh(m * np.sqrt(weight)[:, None] * np.sqrt(weight)[None, :]).max()
    moves = np.zeros((0, 3))
    for _ in range(400):
        _, ahead = mixing.rates(p, moves, 0.0)
        moves = np.vstack([moves, ((ahead * t) @ p - targets) * weight / steepest])
    rate, _ = mixing.rates(p, moves, 0.0)
    slope = p @ (((rate * t) @ p - targets) * weight)
    assert (np.abs(slope[rate > 1e-9]) < 1e-3).all() and (slope[rate <= 1e-9] > -1e-3).all()


def test_mixing_repeats_rows_and_keeps_all_with_a_floor(spark):
    data, labels = labelled(120)
    docs, known = frame(spark, data + [(7, data[7][1])]), spark.createDataFrame(labels, LABELS)
    out = mixing.mixed(docs, known, {"high": 0.9, "low": 0.1}, budget=1.3, least=1.0, domain="CASE quality WHEN 1 THEN 'high' ELSE 'low' END")
    counts = Counter(r.doc_id for r in out.collect())
    assert out.columns == docs.columns and set(counts) == {i for i, _ in data} and sum(counts.values()) > 121
    assert counts[7] % 2 == 0


def test_mixing_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    found = mixing.mixing_rates(frame(spark), none, {"high": 0.5, "low": 0.5}).collect()
    assert all(np.allclose(r.p, 0.5) and abs(r.rate - 1) < 1e-6 for r in found) and len(found) == len(rows())
    assert mixing.mixing_rates(empty(spark), none, {"high": 1.0}).count() == 0
    assert mixing.mixed(empty(spark), none, {"high": 1.0}).columns == empty(spark).columns
    with pytest.raises(ValueError):
        mixing.mixing_rates(frame(spark), none, {"high": 0.5})


def plain_quality(i, t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    in_window = [False] * len(w)
    for k in range(len(w) - 4):
        if seen[tuple(w[k : k + 5])] > 1:
            in_window[k : k + 5] = [True] * 5
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    longest, cover = 0, [False] * len(w)
    if len(w) < 400:
        for a in range(len(w)):
            for b in range(len(w)):
                n = 0
                while a != b and max(a, b) + n < len(w) and w[a + n] == w[b + n]:
                    n += 1
                longest = max(longest, n)
                if n >= quality.MIN_WORDS:
                    cover[a : a + n] = [True] * n
    repeats = sum(in_window)
    return i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeats, len(w) < 10 or 100 * repeats > 20 * len(w), sum(cover), longest


def test_quality_counts(spark):
    data = rows() + [(50, "Tür & *zu* | a\n\nTür & *zu* | a\n \n \nb b"), (51, " ".join([prose(5, 30)] * 2)), (52, prose(6, 60) + " " + prose(5, 25) + " x " + prose(5, 25))]
    got = quality.quality(frame(spark, data)).collect()
    short = {i for i, t in data if len((t or "").split()) < 400}
    plain = sorted((plain_quality(i, t) for i, t in data), key=str)
    found = sorted(((*r[:7], r.covered_words, r.longest_repeat) for r in got), key=str)
    assert [x[:7] for x in found] == [x[:7] for x in plain]
    assert [x for x in found if x[0] in short] == [x for x in plain if x[0] in short]
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.quality(empty(spark)).count() == 0


def test_quality_limits(spark):
    docs = frame(spark, [(1, prose(6, 300) + " " + prose(5, 25) + " x " + prose(5, 25))])
    assert quality.quality(docs).first().kept
    assert not quality.quality(docs, max_repeat=20).first().kept
    assert not quality.quality(docs, max_covered=0.1).first().kept


def test_suffix_order_and_common_prefixes():
    r = random.Random(4)
    for _ in range(150):
        document = np.array(sorted(r.randint(0, 2) for _ in range(r.randint(0, 25))), dtype=np.int64)
        tokens = np.array([r.randint(0, 1) for _ in document], dtype=np.int64)
        suffix = [(document[i], [t for t, d in zip(tokens[i:], document[i:]) if d == document[i]]) for i in range(len(tokens))]
        order, prefix = quality.suffix_order(tokens, document)
        assert order.tolist() == sorted(range(len(tokens)), key=lambda i: suffix[i])
        for k in range(1, len(order)):
            (da, a), (db, b) = suffix[order[k - 1]], suffix[order[k]]
            same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[k] == (same if da == db else 0)
