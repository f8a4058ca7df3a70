"""Quality rules with a repetition rule from suffix arrays.

Base rules count words, characters, symbols, repeated lines and words in repeated windows. The
repetition rule sorts the suffixes of each document by words and reads the longest common prefixes
of neighbours: an interval of the sorted suffixes that share a prefix, of a length no larger
interval shares, is a maximal repeated substring and its members are its places. Their spans of
``min_words`` or more are united; a document fails if they cover more than ``max_covered`` of its
words or if one repeat is longer than ``max_repeat`` words.

The suffixes of many documents are sorted together, document by document, by prefix doubling: each
round sorts only suffixes that are still tied, so ordinary text is done after a few rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import longs, rows_of, texts

MIN_WORDS = 10
MAX_COVERED = 0.25
MAX_REPEAT = 200
BASE_WINDOW = 5
BASE_WORDS = 10
BASE_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
BATCH_WORDS = 200_000
REMEMBERED = 150_000


def suffix_order(tokens: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and the common prefix of each suffix with the one before it.

    ``tokens`` holds the words of several documents, one after another; ``document`` numbers them
    upwards. Suffixes end with their document and are sorted within it, shorter ones first.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order = np.lexsort((tokens, document))
    changed = np.concatenate([[True], (tokens[order][1:] != tokens[order][:-1]) | (document[order][1:] != document[order][:-1])])
    rank = np.empty(n, dtype=np.int64)
    first = np.flatnonzero(changed)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))  # a group's rank is where it begins
    end = np.flatnonzero(np.append(document[1:] != document[:-1], True)) + 1
    ends = np.repeat(end, np.diff(np.concatenate([[0], end])))
    size, ranks = 1, []
    sizes = np.diff(np.append(first, n))
    tied = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places in the order that are still tied
    while len(tied):
        ranks.append(rank.copy())
        at = order[tied]
        ahead = at + size
        inside = ahead < ends[at]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)], -1)
        group = rank[at]
        sort = np.lexsort((second, group))
        at, second, group = at[sort], second[sort], group[sort]
        order[tied] = at
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(at)))
        rank[at] = np.repeat(tied[begin], length)
        tied = tied[np.repeat(length > 1, length)]
        size *= 2
    return order, common_prefixes(ends, order, ranks)


def common_prefixes(ends: np.ndarray, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one sorted before it.

    ``ranks[k]`` is equal for suffixes whose first 2^k words are, so a shared prefix is read off
    bit by bit, longest power first, whatever its length.
    """
    out = np.zeros(len(order), dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    last = len(ends) - 1
    for k in range(len(ranks) - 1, -1, -1):
        same = (np.maximum(a, b) <= last) & (ends[np.minimum(a, last)] == ends[np.minimum(b, last)])
        same &= ranks[k][np.minimum(a, last)] == ranks[k][np.minimum(b, last)]
        step = same.astype(np.int64) << k
        out[1:] += step
        a += step
        b += step
    return out


def union_lengths(starts: np.ndarray, lengths: np.ndarray, document: np.ndarray, documents: int) -> np.ndarray:
    """Words of each document under the spans."""
    n = len(document)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.bincount(document[np.cumsum(edge[:n]) > 0], minlength=documents)


def repetition(tokens: np.ndarray, document: np.ndarray, documents: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: words in repeated ``BASE_WINDOW``-word windows, words under repeats, longest repeat.

    A suffix's longest repeat is the longer of its common prefixes with both neighbours: the
    smallest interval it belongs to. Shorter repeats that start at the same word are prefixes of
    it, so these spans have the same union as all maximal repeats.
    """
    order, prefix = suffix_order(tokens, document)
    after = np.append(prefix[1:], 0) if len(prefix) else prefix
    longest = np.empty(len(order), dtype=np.int64)
    longest[order] = np.maximum(prefix, after)
    window = np.flatnonzero(longest >= BASE_WINDOW)
    in_windows = union_lengths(window, np.full(len(window), BASE_WINDOW), document, documents)
    span = np.flatnonzero(longest >= min_words)
    covered = union_lengths(span, longest[span], document, documents)
    most = np.zeros(documents, dtype=np.int64)
    np.maximum.at(most, document, longest)
    return in_windows, covered, most


def line_repeats(body: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in body.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(SPACES):
            seen.add(line)
    return n


def quality(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """Counts and verdicts per row of ``docs``.

    ``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``, then
    what the repetition rule saw: ``covered_words``, ``longest_repeat``. Words are runs of anything
    but ASCII white space, ``word_chars`` their code points. ``base_failed`` below ``BASE_WORDS``
    words or with over ``BASE_PERCENT`` percent of the words in repeated windows. Null and empty
    texts have no words and fail. Rows are judged one by one, so repeated rows agree.
    """
    schema = (
        "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
        "covered_words long, longest_repeat long"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        held: list[tuple] = []
        size = 0

        def judged() -> pa.RecordBatch:
            counts = np.array([h[5] for h in held], dtype=np.int64)
            document = np.repeat(np.arange(len(held)), counts)
            tokens = np.concatenate([h[6] for h in held]) if held else np.zeros(0, dtype=np.int64)
            windows, covered, most = repetition(tokens, document, len(held), min_words)
            failed = (counts < BASE_WORDS) | (100 * windows > BASE_PERCENT * counts)
            kept = ~failed & (covered <= max_covered * counts) & (most <= max_repeat)
            out = [pa.array([h[0] for h in held], pa.int64()), longs(counts), *(longs([h[i] for h in held]) for i in (1, 2, 3)), longs(windows)]
            return pa.RecordBatch.from_arrays([*out, pa.array(failed), pa.array(kept), longs(covered), longs(most)], names)

        for id_, body in rows_of(batches, "id", "body"):
            words = body.split()
            if len(known) > REMEMBERED:
                known.clear()
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w) >> 1
            tokens = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
            chars = sum(map(len, words)) - len(body.translate(None, bytes(range(128)) + bytes(range(192, 256))))
            symbols = sum(map(body.count, [SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))]))
            held.append((id_, chars, symbols, line_repeats(body), None, len(words), tokens))
            size += len(words)
            if size > BATCH_WORDS:
                yield judged()
                held, size = [], 0
        yield judged()

    return texts(docs, key, text).select("id", F.col("body").cast("binary").alias("body")).mapInArrow(work, schema)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    found = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), *found.columns[1:])
