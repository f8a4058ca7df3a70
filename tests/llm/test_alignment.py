"""Cross-tokenizer alignment against a plain walk over the two token lists."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodgecurve.llm import alignment
from lodgecurve.llm.alignment import ByteLevel, Pieces, public
from tests.llm.fixtures import empty, frame, prose, rows

A, B = public(ByteLevel, "byte_bpe_50k.json"), public(Pieces, "piece_bpe_32k.model")


def tokens(maker, text):
    """Ids and bytes of the tokens of a whole text, from the library itself."""
    t = maker()
    ids = t.tokenizer.encode(" " + text, add_special_tokens=False).ids if maker is A else t.model.encode(text)
    return ids, [t.spelt[i] for i in ids]


def plain(texts):
    """Groups of each text, and links of each as pairs of ids."""
    out = []
    for text in texts:
        groups = []
        if text:
            (a, spelt_a), (b, spelt_b) = tokens(A, text), tokens(B, text)
            if b"".join(spelt_a) == b"".join(spelt_b) == b" " + text.encode():
                i = j = x = y = 0
                held = ([], [])
                while i < len(a) or j < len(b):
                    if x <= y:
                        held[0].append(a[i])
                        x += len(spelt_a[i])
                        i += 1
                    else:
                        held[1].append(b[j])
                        y += len(spelt_b[j])
                        j += 1
                    if x == y:
                        groups.append(held)
                        held = ([], [])
        out.append(groups)
    return out


def expected(data):
    found = plain([t for _, t in data])
    count = Counter((g[0][-1], g[1][-1]) for groups in found for g in groups)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for (i, _), groups in zip(data, found):
        links = [(g[0][-1], g[1][-1]) for g in groups]
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(count[x] == top[x[1]] for x in links),
            sum(count[x] for x in links), hashlib.sha256(line.encode()).hexdigest() if groups else "",
        ))
    return out


def found(docs, **more):
    got, _ = alignment.alignments(docs, A, B, **more)
    return sorted(((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.digest) for r in got.collect()), key=str)


AWKWARD = [
    (30, "<|endoftext|> and <s> </s> <unk> <0x0A>"), (31, "naïve ▁ mark"), (32, "日本語 テキスト 🙂🙂 ‍"), (33, "  two  spaces \n\n new\tline "),
    (34, "\x00nul\x7f"), (35, "é ﬁ ½ ﷺ"), (36, "x" * 3000), (37, " "), (38, "1234567890" * 30), (39, "don't we'll I'M ’s"),
]


@pytest.mark.parametrize("size", [alignment.PIECE, 7, 1])
def test_rows_equal_a_plain_walk(spark, size):
    data = rows() + AWKWARD
    data = data if size > 7 else [(i, t and t[:400]) for i, t in data]
    assert found(frame(spark, data), size=size) == sorted(expected(data), key=str)


def test_the_pair_table_beyond_the_broadcast(spark):
    data = rows()
    assert found(frame(spark, data), limit=-1) == sorted(expected(data), key=str)


@pytest.mark.parametrize("maker", [A, B])
def test_quick_ways_change_no_token(maker):
    r = random.Random(4)
    parts = [" ", "  ", "\n", "\t ", " the", "word", "'s", "'ll", "Ünï", "ß", "ſ", "×", "µ", "日本", "🙂", "e\u0301", "\u00a0", "\x1c", "12", "3", ".", " --", "▁", "<s>", "<0x41>", "\x7f", "ĳ", "ª", "ﬁ"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 30))) for _ in range(4000)] + [t for _, t in AWKWARD]
    spelling = alignment.Spelling(maker())
    for at in range(0, len(texts), 50):
        for text, got in zip(texts[at : at + 50], spelling(texts[at : at + 50])):
            ids, spelt = tokens(maker, text)
            assert (got is None) == (b"".join(spelt) != b" " + text.encode())
            assert got is None or got[0].tolist() == ids and got[1].tolist() == np.cumsum([len(x) for x in spelt]).tolist()


def test_the_quick_way_is_taken():
    t = A()
    assert t.quick is not None and t.COMMON.fullmatch(prose(1, 50)) and not t.COMMON.fullmatch("日本")


def test_crossings_cut_the_merge_evenly():
    r = random.Random(1)
    for _ in range(300):
        last = r.randint(1, 60)
        a, b = (np.array(sorted({*r.sample(range(1, last + 1), r.randint(1, last)), last})) for _ in range(2))
        size = r.randint(1, 20)
        parts = alignment.pieces_of(a, b, size)
        assert [p[0] for p in parts] == [0, *(p[1] for p in parts[:-1])] and parts[-1][1] == len(a)
        assert [p[2] for p in parts] == [0, *(p[3] for p in parts[:-1])] and parts[-1][3] == len(b)
        assert all(k - i + m - j <= size + 1 for i, k, j, m in parts)
        common = [np.intersect1d(a[i:k], b[j:m]).tolist() for i, k, j, m in parts]
        assert sum(common, []) == np.intersect1d(a, b).tolist()  # no tie is parted


def test_byte_letters_spell_every_byte():
    assert sorted(alignment.byte_letters().values()) == list(range(256))
    t = A()
    assert t.spelt[t.tokenizer.token_to_id("Ġthe")] == b" the"


def test_empty_tables_and_pair_counts(spark):
    assert found(empty(spark)) == []
    _, counted = alignment.alignments(frame(spark, [(1, "the end the end"), (2, "the end")]), A, B)
    assert {r.n for r in counted.collect()} == {3} and all(r.best for r in counted.collect())


def test_query(spark, sf_dir):
    got = alignment.op12_alignment(spark, sf_dir)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.dtypes == list(zip(names, ["bigint"] * 7 + ["string"]))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = expected([(r.doc_id, r.text) for r in docs])
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want)
