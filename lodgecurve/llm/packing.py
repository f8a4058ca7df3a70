"""Packing of documents into training sequences, neighbours in content side by side.

Every document gets a vector of hashed counts of byte runs, a fixed random projection of it to a few
dimensions, and the place of that point on a Hilbert curve. Documents are range-sorted by that key
and their tokens follow each other along the curve, cut wherever a sequence is full, so a sequence
holds documents that are near each other and no token is lost or padded within the curve.

The curve is dealt to tasks in stretches of about ``stretch`` bytes, whose borders come from exact
sums over ranges of the key in a pass before; copies share a point, so the key ends in bits of the
document's hash, which lets a border fall between copies. Each task packs its stretch on its own.
What is left at its end is cut into sequences of powers of two, which need no padding, so the
price of working in parallel is a few short sequences for each task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import balanced_borders, column, longs, rows_of, texts
from lodgecurve.operators.scale import materialise

LENGTH = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
HASHED = 256
SLOT_BITS = 9  # slots of both signs: 2 * HASHED
DIMENSIONS = 4
CURVE_BITS = 10
TIE_BITS = 22
STRETCH = 2_500_000
REMEMBERED = 400_000


@lru_cache(maxsize=1)
def projection() -> np.ndarray:
    """A fixed projection of hashed counts; its columns have unit length on average."""
    return np.random.default_rng(20).standard_normal((HASHED, DIMENSIONS)) / np.sqrt(HASHED)


def vector(body: bytes) -> np.ndarray:
    """Signed counts of hashed runs of three bytes."""
    b = np.frombuffer(body, dtype=np.uint8).astype(np.uint32)
    runs = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D) if len(b) > 2 else b[:0]
    counts = np.bincount(runs * np.uint32(0x27D4EB2F) >> np.uint32(32 - SLOT_BITS), minlength=2 * HASHED)
    return (counts[0::2] - counts[1::2]).astype(np.float64)


def points(vectors: np.ndarray) -> np.ndarray:
    """Cells of the curve's grid: each projected coordinate, as its share of a standard normal law."""
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    z = vectors @ projection() / np.where(norm == 0, 1, norm) * np.sqrt(HASHED)
    share = 0.5 * (1 + np.tanh(0.7978845608 * (z + 0.044715 * z**3)))
    return np.minimum((share * (1 << CURVE_BITS)).astype(np.int64), (1 << CURVE_BITS) - 1)


def hilbert(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Position of each row of grid coordinates along the Hilbert curve through a grid of 2^bits a side.

    Works from the coarsest bit down, keeping the orientation of the current cube: coordinates
    are reflected and exchanged so that each cube is entered where the last one was left.
    """
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for axis in range(n):
            set_ = (x[:, axis] & high) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, axis] ^= swap
    for axis in range(1, n):
        x[:, axis] ^= x[:, axis - 1]
    turn = np.zeros(len(x), dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, n - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn[:, None]
    out = np.zeros(len(x), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            out = (out << 1) | ((x[:, axis] >> level) & 1)
    return out


def curve_keys(bodies: list[bytes], uids: list[int]) -> np.ndarray:
    """Sort key of each text: curve position, then bits of the uid."""
    if not bodies:
        return np.zeros(0, dtype=np.int64)
    tie = np.array(uids, dtype=np.int64) & ((1 << TIE_BITS) - 1)
    return (hilbert(points(np.stack([vector(b) for b in bodies]))) << TIE_BITS) | tie


class Pieces:
    """Texts as the pieces that a vocabulary file splits them into, found for many texts at once.

    Takes UTF-8 texts of ASCII and Latin-1 letters without apostrophes and special tokens. There a
    piece is a run of letters, a single digit, or a run of anything else but white space; letters
    are lower-cased. A piece is known by a 64-bit hash of its bytes.
    """

    BATCH = 1 << 19

    def __init__(self) -> None:
        kind = np.full(256, 3, dtype=np.uint8)
        kind[[9, 10, 11, 12, 13, 32]] = 0
        kind[ord("0") : ord("9") + 1] = 2
        kind[ord("A") : ord("Z") + 1] = kind[ord("a") : ord("z") + 1] = kind[128:] = 1
        self.kind = kind
        self.code = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x9E3779B97F4A7C15
        self.power = self.inverse = np.ones(1, dtype=np.uint64)
        self.base, self.back = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))

    def grow(self, n: int) -> None:
        if len(self.power) <= n:
            size = max(n + 1, self.BATCH)
            for name, base in (("power", self.base), ("inverse", self.back)):
                steps = np.full(size, base)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    @staticmethod
    def fits(body: bytes) -> bool:
        if b"'" in body or b"<|" in body:
            return False
        if body.isascii():
            return True
        b = np.frombuffer(body, dtype=np.uint8)
        high = b >= 128
        lead = b == 0xC3
        return bool((high.sum() == 2 * lead.sum()) and not (lead[:-1] & ((b[1:] == 0x97) | (b[1:] == 0xB7))).any())

    def split(self, bodies: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts' lower-cased bytes; each piece's start, end and hash; the pieces of each text."""
        b = np.frombuffer(b"\n".join([*bodies, b""]), dtype=np.uint8).copy()
        upper = (b >= 65) & (b <= 90)
        upper[1:] |= (b[:-1] == 0xC3) & (b[1:] <= 0x9E)
        b[upper] += 32
        kind = self.kind[b]
        change = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == 2)]) if len(b) else np.zeros(0, dtype=bool)
        edges = np.append(np.flatnonzero(change), len(b))
        starts, ends = edges[:-1], edges[1:]
        real = kind[starts] != 0 if len(starts) else np.zeros(0, dtype=bool)
        starts, ends = starts[real], ends[real]
        self.grow(len(b))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.add.accumulate(self.code[b] * self.power[: len(b)])])
        hashes = (sums[ends] - sums[starts]) * self.inverse[starts] ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        until = np.cumsum([len(x) + 1 for x in bodies])
        return b.tobytes(), starts, ends, hashes, np.diff(np.searchsorted(starts, until), prepend=0)


class Encoder:
    """Token ids of texts by a vocabulary file, with the ids of pieces remembered.

    White space never becomes part of a token of this vocabulary and merges stay within pieces, so
    the ids of a text are those of its pieces in turn. New pieces are encoded together, as one text
    with spaces between; a piece ends with a token that is marked as a word's end, which tells
    their ids apart. Texts that ``Pieces`` doesn't take are encoded as they are.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.pieces = Pieces()
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.first, self.size = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text, the end id last."""
        end = np.array([END], dtype="<u4").tobytes()
        out: list[bytes] = [b""] * len(texts)
        held, size = [], 0
        for i, t in enumerate(texts):
            if not self.pieces.fits(t):
                out[i] = self.plain(t) + end
                continue
            held.append(i)
            size += len(t)
            if size > Pieces.BATCH:
                self.fill(out, held, texts, end)
                held, size = [], 0
        self.fill(out, held, texts, end)
        return out

    def plain(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def fill(self, out: list[bytes], at: list[int], texts: list[bytes], end: bytes) -> None:
        data, starts, ends, hashes, counts = self.pieces.split([texts[i] for i in at])
        distinct, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.clear()
        keys = distinct.tolist()
        places = list(map(self.known.get, keys))
        new = [i for i, p in enumerate(places) if p is None]
        if new:
            spans = zip(starts[example[new]].tolist(), ends[example[new]].tolist())
            for i, p in zip(new, range(*self.learn([data[a:b] for a, b in spans]))):
                places[i] = self.known[keys[i]] = p
        piece = np.array(places, dtype=np.int64)[inverse]
        n = self.size[piece]
        before = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.arange(before[-1]) + np.repeat(self.first[piece] - before[:-1], n)].tobytes()
        cuts = (4 * before[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        for i, a, b in zip(at, cuts, cuts[1:]):
            out[i] = ids[a:b] + end

    def learn(self, pieces: list[bytes]) -> tuple[int, int]:
        """Remember the ids of new pieces; the range of their places."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(pieces).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(pieces):
            each = [self.plain(p) for p in pieces]
            ids, stops = np.frombuffer(b"".join(each), dtype="<u4"), np.cumsum([len(e) // 4 for e in each])
        first = np.concatenate([[0], stops[:-1]])
        place = len(self.first)
        self.first = np.concatenate([self.first, first + len(self.flat)])
        self.size = np.concatenate([self.size, stops - first])
        self.flat = np.concatenate([self.flat, ids])
        return place, place + len(pieces)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python process, so that what it remembers outlives a task."""
    return Encoder(path)


def keys_and_sizes(docs: DataFrame) -> DataFrame:
    """``key, size`` of every document: its place on the curve and its length in bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bodies = column(part, "body").to_pylist()
                yield pa.RecordBatch.from_arrays([longs(curve_keys(bodies, column(part, "uid").to_pylist())), longs([len(b) + 1 for b in bodies])], ["key", "size"])

    return docs.select("uid", F.col("body").cast("binary").alias("body")).mapInArrow(work, "key long, size long")


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, stretch: int = STRETCH
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens, ``ids`` included.

    ``tokenizer`` is the path of the vocabulary file on every executor. Every document is its
    token ids and the end id, so null and empty texts are one token. Rows that share an id are
    packed as documents of their own. ``sequence_id`` is unique, not gapless; sequences are full
    but for a few at the end of a stretch, whose lengths are powers of two. Columns: ``doc_id``,
    ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``.
    """
    rows = texts(docs, key, text)
    edges = np.array(balanced_borders(materialise(keys_and_sizes(rows)), "key", "size", stretch), dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(edges)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bodies = column(part, "body").to_pylist()
                keys = curve_keys(bodies, column(part, "uid").to_pylist())
                ids = pa.array(encode_all(bodies), pa.binary())
                stretches = pa.array(np.searchsorted(shared.value, keys, side="right").astype(np.int32))
                yield pa.RecordBatch.from_arrays([stretches, longs(keys), column(part, "id"), ids], ["stretch", "key", "id", "ids"])

    keyed = rows.withColumn("body", F.col("body").cast("binary")).mapInArrow(encode, "stretch int, key long, id long, ids binary")
    sorted_ = keyed.repartitionById(len(edges) + 1, F.col("stretch")).sortWithinPartitions("stretch", "key", "id")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return sorted_.mapInArrow(lambda batches: packed_pieces(batches, length), schema)


def packed_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Fill sequences with the documents in turn, stretch by stretch.

    The pieces of the sequence being filled are held back until it is full or its stretch ends.
    """
    out: list[tuple] = []
    held: list[tuple] = []  # (document id, start, ids, all tokens) of the open sequence
    size, now, number = 0, None, 0

    def emit(pieces: list[tuple]) -> None:
        nonlocal number
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            out.append((doc, start, n, zlib.crc32(ids), total, now << 40 | number, offset, ids))
            offset += n
        number += 1

    def finish() -> None:
        """The open sequence in sequences of powers of two."""
        nonlocal held, size
        while size:
            take = 1 << (size.bit_length() - 1)
            first, held = split(held, take)
            emit(first)
            size -= take

    def batch() -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        made = pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], pa.binary() if n == "ids" else pa.int64()) for i, n in enumerate(names)], names
        )
        out.clear()
        return made

    for stretch, doc, ids in rows_of(batches, "stretch", "id", "ids"):
        if stretch != now:
            finish()
            now, number = stretch, 0
        total, at = len(ids) // 4, 0
        while at < total:
            n = min(length - size, total - at)
            held.append((doc, at, ids[4 * at : 4 * (at + n)], total))
            at, size = at + n, size + n
            if size == length:
                emit(held)
                held, size = [], 0
        if len(out) >= 2000:
            yield batch()
    finish()
    yield batch()


def split(pieces: list[tuple], take: int) -> tuple[list[tuple], list[tuple]]:
    """The first ``take`` tokens of the pieces, and the rest."""
    first, rest = [], []
    for doc, start, ids, total in pieces:
        n = min(take, len(ids) // 4)
        if n:
            first.append((doc, start, ids[: 4 * n], total))
        if 4 * n < len(ids):
            rest.append((doc, start + n, ids[4 * n :], total))
        take -= n
    return first, rest


def public_tokenizer(name: str = TOKENIZER) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed along the curve."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizer()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
