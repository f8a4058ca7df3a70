"""Repeated passages against brute force, byte by byte and word by word."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodgecurve.llm import repeats, substring_dedup, suffix_dedup, windows
from tests.llm.fixtures import empty, frame, rows


def byte_repeats(data, length):
    texts = [(t or "").encode() for _, t in data]
    seen = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(data, texts):
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def word_repeats(data, window):
    texts = [(i, (t or "").encode().split()) for i, t in data]
    first = defaultdict(lambda: 1 << 62)
    for i, w in texts:
        for p in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[p : p + window])] = min(first[tuple(w[p : p + window])], i)
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [400, 37, 2])
def test_bytes_removed_are_those_of_brute_force(spark, length):
    found = suffix_dedup.repeated_spans(frame(spark), length=length).collect()
    got = [(r.id, r.n_bytes, sum(s["to"] - s["from"] for s in r.spans), len(r.spans), r.kept_sha256) for r in found]
    assert sorted(got, key=str) == byte_repeats(rows(), length)


@pytest.mark.parametrize("window,cells", [(50, 1 << 20), (7, 1 << 20), (2, 1 << 20), (20, 2048)])
def test_words_removed_are_those_of_brute_force_whatever_the_sketch(spark, window, cells):
    found = substring_dedup.repeated_words(frame(spark), window=window, cells=cells).collect()
    assert sorted((tuple(r) for r in found), key=str) == word_repeats(rows(), window)


@pytest.mark.parametrize("length", [50, 7, 2])
def test_repeated_windows_of_words_go_from_every_text(spark, length):
    data = [(n, t) for n, (_, t) in enumerate(rows())]
    texts = [(t or "").encode().split() for _, t in data]
    seen = Counter(tuple(w[p : p + length]) for w in texts for p in range(len(w) - length + 1))
    want = {}
    for (i, t), w in zip(data, texts):
        gone = {q for p in range(len(w) - length + 1) if seen[tuple(w[p : p + length])] > 1 for q in range(p, p + length)}
        want[i] = t if not gone else b" ".join(x for q, x in enumerate(w) if q not in gone).decode()
    got = suffix_dedup.without_repeats(frame(spark, data), length=length, unit="words").collect()
    assert {r.doc_id: r.text for r in got} == want
    left = [t.split() for t in want.values() if t]
    again = Counter(tuple(w[p : p + length]) for w in left for p in range(len(w) - length + 1))
    assert length < 50 or max(again.values()) == 1  # no window of 50 words is in two kept places
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(frame(spark, data), unit="lines")


def test_cut_texts_keep_rows_columns_and_valid_text(spark):
    docs = frame(spark)
    cut = suffix_dedup.without_repeats(docs, length=50)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    by_id = {r.doc_id: r for r in cut.collect()}
    assert by_id[9].text is None and by_id[8].text == "" and by_id[1].text == "" and by_id[12].text == dict(rows())[12]
    assert by_id[7].text.startswith("Ünïcödé") and by_id[7].uid == "x"
    words = substring_dedup.without_repeated_words(docs)
    kept = {r.doc_id: r.text for r in words.collect()}
    assert words.columns == docs.columns and kept[1] == dict(rows())[1] and kept[2] == "" and kept[9] is None


def test_empty_tables(spark):
    assert suffix_dedup.repeated_spans(empty(spark)).count() == 0
    assert substring_dedup.repeated_words(empty(spark)).count() == 0
    assert suffix_dedup.without_repeats(empty(spark)).columns == empty(spark).columns


def test_lengths_that_make_no_sense_are_refused(spark):
    with pytest.raises(ValueError):
        suffix_dedup.repeated_pieces(frame(spark), 1)
    with pytest.raises(ValueError):
        substring_dedup.earlier_pieces(frame(spark), 1)


def test_anchors_are_the_leftmost_smallest_gram():
    grams = np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64) << np.uint64(32)
    for width in (1, 2, 7, 300):
        want = [p + int(np.argmin(grams[p : p + width])) for p in range(300 - width + 1)]
        assert windows.owners(grams, width).tolist() == want
    assert not len(windows.owners(grams, 301))


def test_equal_grams_hash_equal():
    tokens = np.array([3, 1, 4, 1, 5, 9, 3, 1, 4, 1, 5, 9, 2], dtype=np.uint64)
    for gram in (1, 2, 3, 5, 6):
        h = windows.gram_hashes(tokens, gram)
        places = [tuple(tokens[i : i + gram].tolist()) for i in range(len(tokens) - gram + 1)]
        assert len(h) == len(places) and len(set(zip(h.tolist(), places))) == len(set(h.tolist())) == len(set(places))


def test_bitmap_loses_no_document(spark):
    docs = spark.range(5000).selectExpr("xxhash64(id) uid", "id", "'t' body")
    some = docs.where("id % 7 = 0").select("uid")
    maybe, rest = repeats.filtered(docs, some, bits=1 << 18)
    assert maybe.join(some, "uid").count() == some.count()
    assert maybe.count() + rest.count() == 5000 and maybe.count() < 1500
