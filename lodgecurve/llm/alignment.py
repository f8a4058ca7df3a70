"""Alignment of two tokenizers' tokens by the bytes they end on, with merge-path partitioning.

A text's tokens under tokenizer A and under tokenizer B spell the same bytes. Where a token of A and
one of B both end, the text is cut, which gives the smallest groups of tokens that stand for each other.
Finding the cuts is a merge of two ascending lists of end offsets.

*Merge path.* The merge of a text is a path of n_a + n_b steps. A binary search on every diagonal
``PIECE`` steps apart finds where the path crosses it, so the merge falls into independent pieces of
equal work, whatever the two lists look like. A tie that a diagonal would part stays with the earlier
piece. A text of one piece is aligned where it was encoded; the pieces of longer ones are dealt over
all tasks as rows. A piece gives the groups that lie within it and the open ends before its first
and after its last cut, and the ends of neighbouring pieces are stitched into groups, one piece of a
text after another.

*Corpus counts.* Links (a token of A and one of B that end together) are counted by pair of ids in one
aggregation with map-side combine. The counts come back to the texts' distinct pairs in a join which
broadcasts the table of counts only when its files are small, and is shuffled otherwise.

Empty tables give empty results. A text has no tokens if it is null or empty, or if either tokenizer
does not give its bytes back: all its numbers are zero. Ids may be null, repeated rows count as
separate texts, and other columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import longs, many, rows_of, texts
from lodgecurve.operators.scale import join_measured, materialise

PIECE = 1 << 16
TOGETHER = 32
SHIFT = 32


# --- tokenizers ------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


# Fixed value: how a byte-level vocabulary of this kind splits a text before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level vocabulary file of the ``tokenizers`` library; strings of special tokens are plain text.

    Texts of common characters go to ``tiktoken``, which merges by the same vocabulary in a quarter
    of the time. Others, whose characters two Unicode tables might class differently, and very long
    words go to ``tokenizers`` itself, as all do where the vocabulary is not in the order of its merges.
    """

    COMMON = re.compile("[\t\n\r -~\u00a1-\u017f]*")
    LONG = 500

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many tasks as there are cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        self.spelt: list[bytes] = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.spelt[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.quick = self.merging(path)

    def merging(self, path: str):
        """The same vocabulary for ``tiktoken``, if merges come in the order of the ids they make."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        split = model["pre_tokenizer"] or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["model"]["merges"]]
        ids = [self.tokenizer.token_to_id(m.replace(" ", "")) for m in merges]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if model["normalizer"] is not None or not plain or ids != list(range(256, 256 + len(ids))) or model["model"].get("ignore_merges"):
            return None
        ranks = {self.spelt[i]: i for i in range(256 + len(ids))}
        return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, batch: list[str]) -> list[list[int]]:
        out: list = [None] * len(batch)
        rest = []
        for at, text in enumerate(batch):
            if self.quick and self.COMMON.fullmatch(text) and max(map(len, text.split()), default=0) <= self.LONG:
                out[at] = self.quick.encode_ordinary(" " + text)
            else:
                rest.append(at)
        for at, e in zip(rest, self.tokenizer.encode_batch_fast([" " + batch[k] for k in rest], add_special_tokens=False)):
            out[at] = e.ids
        return out


class Pieces:
    """A ``sentencepiece`` model, which puts a space before every text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelt = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def __call__(self, batch: list[str]) -> list[list[int]]:
        return self.model.encode(batch, num_threads=1)


@lru_cache(maxsize=4)
def loaded(kind: type, path: str):
    """One tokenizer of each kind and path a worker process."""
    return kind(path)


class Spelling:
    """Encodes texts and gives the ids with their end offsets, where the tokens spell a space and the text."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.sizes = tokenizer, np.array([len(b) for b in tokenizer.spelt], dtype=np.int64)

    def __call__(self, bodies: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        spelt = self.tokenizer.spelt
        for text, ids in zip(bodies, self.tokenizer(bodies)):
            if b"".join(map(spelt.__getitem__, ids)) != b" " + text.encode():
                out.append(None)
                continue
            held = np.array(ids, dtype=np.int64)
            out.append((held, np.cumsum(self.sizes[held])))
        return out


# --- merge path ------------------------------------------------------------------------


def crossing(a: np.ndarray, b: np.ndarray, step: int) -> tuple[int, int]:
    """Where the merge of two ascending lists stands after ``step`` steps: elements taken of each, ties of ``a`` first.

    If the last step took the first of a tie, its partner is taken too.
    """
    low, high = max(0, step - len(b)), min(step, len(a))
    while low < high:  # along the diagonal i + j == step
        i = (low + high) // 2
        if a[i] <= b[step - i - 1]:
            low = i + 1
        else:
            high = i
    i, j = low, step - low
    if 0 < i and j < len(b) and a[i - 1] == b[j]:
        j += 1
    return i, j


def pieces_of(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """The merge of two lists of ends in pieces of ``size`` steps: from and to in ``a``, from and to in ``b``."""
    at = [(0, 0), *(crossing(a, b, s) for s in range(size, len(a) + len(b), size)), (len(a), len(b))]
    return [(i, k, j, m) for (i, j), (k, m) in zip(at, at[1:]) if k > i or m > j]


class Lines:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, most: int) -> None:
        self.width = most
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(most)]

    def __call__(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
        """Groups that end at the given cuts, each with its final ``;``; nothing may follow the last cut."""
        in_a = np.searchsorted(cut_a, np.arange(len(a)), side="right")
        in_b = np.searchsorted(cut_b, np.arange(len(b)), side="right")
        mark_a, mark_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        mark_a[cut_a - 1], mark_b[cut_b - 1] = 1, 2
        order = np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")
        codes = np.concatenate([a + self.width * mark_a, b + self.width * mark_b])[order]
        return "".join(map(self.written.__getitem__, codes.tolist()))


def aligned(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, lines: Lines) -> dict:
    """What one piece of a merge gives: groups after its first cut, its links, and the open ends on both sides."""
    _, at_a, at_b = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    cut_a, cut_b = at_a + 1, at_b + 1
    if not len(cut_a):
        return {"cuts": 0, "head": (a, b), "body": "", "tail": (a[:0], b[:0]), "links": np.zeros(0, dtype=np.int64)}
    i, j, k, m = cut_a[0], cut_b[0], cut_a[-1], cut_b[-1]
    return {
        "cuts": len(cut_a),
        "head": (a[:i], b[:j]),
        "body": lines(a[i:k], b[j:m], cut_a[1:] - i, cut_b[1:] - j),
        "tail": (a[k:], b[m:]),
        "links": (a[at_a] << SHIFT) | b[at_b],
    }


class Stitched:
    """Joins what the pieces of one text give, in their order; holds one open group at a time."""

    def __init__(self) -> None:
        self.n_a = self.n_b = self.cuts = 0
        self.open: tuple[list[int], list[int]] = ([], [])
        self.held = ""
        self.digest = hashlib.sha256()

    def add(self, cuts: int, head, body: str, tail, sizes: tuple[int, int]) -> None:
        self.n_a += sizes[0]
        self.n_b += sizes[1]
        self.cuts += cuts
        for mine, more in zip(self.open, head):
            mine.extend(more)
        if cuts:
            group = ",".join(map(str, self.open[0])) + "|" + ",".join(map(str, self.open[1])) + ";"
            text = self.held + group + body
            self.held = text[-1:]  # the text's last mark is none, so one is always kept back
            self.digest.update(text[:-1].encode())
            self.open = (list(tail[0]), list(tail[1]))

    def row(self) -> tuple[int, int, int, str]:
        return self.n_a, self.n_b, self.cuts, self.digest.hexdigest() if self.n_a else ""


# --- jobs ------------------------------------------------------------------------------

ENDS = "head_a array<long>, head_b array<long>, tail_a array<long>, tail_b array<long>, body string, size_a long, size_b long"
FOUND = "no long, id long, n_a long, n_b long, n_groups long, digest string, pairs array<long>, times array<long>"
WAITING = "piece long, from_a long, ids_a binary, sizes_a binary, from_b long, ids_b binary, sizes_b binary"
LIST = pa.list_(pa.int64())


def narrow(ids: np.ndarray, sizes: np.ndarray, start: int) -> tuple[int, bytes, bytes]:
    """Tokens of a piece to be sent: the offset they start at, ids and sizes in as few bytes as the vocabulary allows."""
    return int(start), ids.astype(np.min_scalar_type(len(sizes))).tobytes(), sizes[ids].astype(np.min_scalar_type(sizes.max())).tobytes()


def widened(start: int, ids: bytes, lengths: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and end offsets of a piece that ``narrow`` made."""
    held = np.frombuffer(ids, dtype=np.min_scalar_type(len(sizes))).astype(np.int64)
    return held, start + np.cumsum(np.frombuffer(lengths, dtype=np.min_scalar_type(sizes.max())), dtype=np.int64)


def encoded(docs: DataFrame, first: Callable, second: Callable, size: int = PIECE) -> DataFrame:
    """Every text, aligned if its merge is one piece, else one row for each piece that is still to be aligned.

    ``no`` numbers the rows of ``docs``; it holds once the result is written.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell_a, spell_b = Spelling(first()), Spelling(second())
        lines = Lines(max(len(spell_a.sizes), len(spell_b.sizes)))
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                rows = list(rows_of([batch.slice(at, TOGETHER)], "no", "id", "body"))
                bodies = [t for _, _, t in rows]
                yield packed_rows(rows, spell_a(bodies), spell_b(bodies), spell_a.sizes, spell_b.sizes, lines)

    def packed_rows(rows, many_a, many_b, sizes_a, sizes_b, lines: Lines) -> pa.RecordBatch:
        out: list[tuple] = []
        none = [None] * 7
        for (no, id_, body), one, other in zip(rows, many_a, many_b):
            if not body or one is None or other is None:
                out.append((no, id_, 0, 0, 0, "", [], [], *none))
                continue
            (a, a_ends), (b, b_ends) = one, other
            parts = pieces_of(a_ends, b_ends, size)
            if len(parts) == 1:
                text = Stitched()
                got = aligned(a, a_ends, b, b_ends, lines)
                text.add(got["cuts"], got["head"], got["body"], got["tail"], (len(a), len(b)))
                pairs, times = np.unique(got["links"], return_counts=True)
                out.append((no, id_, *text.row(), pairs, times, *none))
                continue
            for number, (i, k, j, m) in enumerate(parts):
                one, other = narrow(a[i:k], sizes_a, a_ends[i - 1] if i else 0), narrow(b[j:m], sizes_b, b_ends[j - 1] if j else 0)
                out.append((no, id_, None, None, None, None, None, None, number, *one, *other))
        kinds = [pa.int64()] * 5 + [pa.string(), LIST, LIST, pa.int64()] + [pa.int64(), pa.binary(), pa.binary()] * 2
        names = [c.split()[0] for c in f"{FOUND}, {WAITING}".split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], kind) for c, kind in enumerate(kinds)], names)

    numbered = docs.select(F.monotonically_increasing_id().alias("no"), "id", "body")
    return numbered.mapInArrow(work, f"{FOUND}, {WAITING}")


def pieces_aligned(waiting: DataFrame, sizes_a: np.ndarray, sizes_b: np.ndarray) -> DataFrame:
    """Each piece, dealt over all tasks, with its inner groups, open ends and links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = Lines(max(len(sizes_a), len(sizes_b)))
        names = [c.split()[0] for c in f"no long, id long, piece long, cuts long, {ENDS}, pairs array<long>, times array<long>".split(", ")]
        kinds = [pa.int64()] * 4 + [LIST] * 4 + [pa.string(), pa.int64(), pa.int64(), LIST, LIST]
        sent = ("from_a", "ids_a", "sizes_a", "from_b", "ids_b", "sizes_b")
        for no, id_, piece, *raw in rows_of(batches, "no", "id", "piece", *sent):
            a, a_ends = widened(*raw[:3], sizes_a)
            b, b_ends = widened(*raw[3:], sizes_b)
            got = aligned(a, a_ends, b, b_ends, lines)
            pairs, times = np.unique(got["links"], return_counts=True)
            row = (no, id_, piece, got["cuts"], *got["head"], *got["tail"], got["body"], len(a), len(b), pairs, times)
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    schema = f"no long, id long, piece long, cuts long, {ENDS}, pairs array<long>, times array<long>"
    return waiting.repartition(many(waiting), "no", "piece").mapInArrow(work, schema)


def stitched(pieces: DataFrame) -> DataFrame:
    """One row for each text from its pieces: numbers, digest of all groups."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, text = None, Stitched()

        def done() -> pa.RecordBatch:
            row = (*now, *text.row())
            kinds = [pa.int64()] * 5 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["no", "id", "n_a", "n_b", "n_groups", "digest"])

        wanted = ("no", "id", "cuts", "head_a", "head_b", "body", "tail_a", "tail_b", "size_a", "size_b")
        for no, id_, cuts, head_a, head_b, body, tail_a, tail_b, size_a, size_b in rows_of(batches, *wanted):
            if (no, id_) != now:
                if now is not None:
                    yield done()
                now, text = (no, id_), Stitched()
            text.add(cuts, (head_a, head_b), body, (tail_a, tail_b), (size_a, size_b))
        if now is not None:
            yield done()

    sorted_pieces = pieces.drop("pairs", "times").repartition(many(pieces), "no").sortWithinPartitions("no", "piece")
    return sorted_pieces.mapInArrow(work, "no long, id long, n_a long, n_b long, n_groups long, digest string")


def alignments(
    docs: DataFrame, first: Callable, second: Callable, key: str = "doc_id", text: str = "text", size: int = PIECE, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` its numbers, and the table ``pair, n, best`` of all linked pairs of ids.

    ``first`` and ``second`` make a tokenizer in a task (``ByteLevel`` and ``Pieces`` are such): a call on
    texts gives the ids of each, which spell a space and the text; ``spelt`` has the bytes of every
    token. A pair is ``id of A << 32 | id of B``; ``best`` says that no pair of that
    id of B occurs more often. ``limit`` is the size up to which the table is broadcast.
    """
    rows = materialise(encoded(texts(docs, key, text), first, second, size))
    waiting, ready = rows.where(F.col("piece").isNotNull()), rows.where(F.col("piece").isNull())
    sizes = [np.array([len(x) for x in make().spelt], dtype=np.int64) for make in (first, second)]
    pieces = materialise(pieces_aligned(waiting, *sizes))
    linked = ready.select("no", "pairs", "times").unionByName(pieces.select("no", "pairs", "times"))
    linked = linked.select("no", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("no", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))

    counts = materialise(linked.groupBy("pair").agg(F.sum("times").alias("n")))
    by_b = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)))
    top = by_b.groupBy("b").agg(F.max("n").alias("top"))
    counted = materialise(join_measured(by_b, top, ["b"], "inner").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))

    judged = join_measured(linked, counted, ["pair"], "inner", limit=limit, stored=True).groupBy("no").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    numbers = ["no", "id", "n_a", "n_b", "n_groups", "digest"]
    whole = ready.select(*numbers).unionByName(stitched(pieces).select(*numbers))
    sums = ["n_links", "n_best", "count_sum"]
    out = whole.join(judged, "no", "left").select(*numbers[1:], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sums])
    return out, counted


def public(kind: type, name: str) -> Callable:
    """Makes a tokenizer from a public vocabulary file."""

    def make():
        import public_tokenizers

        return loaded(kind, public_tokenizers.path(name))

    return make


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    """How the tokens of two public vocabularies align in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found, _ = alignments(docs, public(ByteLevel, "byte_bpe_50k.json"), public(Pieces, "piece_bpe_32k.model"))
    return found.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("digest").alias("groups_sha256")
    )
