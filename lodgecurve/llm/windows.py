"""Repeated windows of a fixed number of tokens, found through content-chosen anchors.

A window of ``length`` tokens contains ``width = length - gram + 1`` grams of ``gram`` tokens. Its
*anchor* is the gram with the smallest hash, the leftmost of equals. The choice depends on the
window's content only, so equal windows have equal anchors at equal distance from their start.
Consecutive windows mostly share an anchor, so all windows of a document form few *pieces*:
maximal runs of consecutive windows with one anchor whose distances fall into one block of
``block`` distances, [0, block), [block, 2 block), ... A piece has two keys:

``core``  hash of what all windows of this anchor and block have in common (with the block),
          which is ``length - block + 1`` tokens. Equal windows have equal cores.
``hull``  hash of all tokens the piece's windows touch, with their distances. Pieces with equal
          core and hull hold exactly the same windows.

A core that occurs once holds no repeated window. Pieces left open are cut again with smaller
blocks; at ``block == 1`` a piece is one window and its core is the window itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

LOW = np.uint64(0xFFFFFFFF)
HIGH = np.uint64(0xFFFFFFFF00000000)
ODD = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Shape:
    """``length`` tokens a window, ``gram`` tokens an anchor gram."""

    length: int
    gram: int

    @property
    def width(self) -> int:
        return self.length - self.gram + 1


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a multiply and xor-shift finaliser)."""
    v = values ^ (values >> np.uint64(31))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    return v ^ (v >> np.uint64(29))


def gram_hashes(tokens: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` 64-bit tokens, by doubling: h(ab) = h(a) * base^|b| + h(b)."""
    if len(tokens) < gram:
        return np.zeros(0, dtype=np.uint64)
    power, size = ODD, 1
    unit, out, done = tokens.astype(np.uint64, copy=False), None, 0
    left = gram
    while left:
        if left & 1:  # append a run of ``size`` tokens
            if out is None:
                out = unit
            else:
                n = len(tokens) - done - size + 1
                out = out[:n] * np.uint64(power) + unit[done : done + n]
            done += size
        left >>= 1
        if left:
            n = len(unit) - size
            unit = unit[:n] * np.uint64(power) + unit[size : size + n]
            power = power * power % (1 << 64)
            size *= 2
    return mixed(out[: len(tokens) - gram + 1])


def owners(grams: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` grams, the position of the smallest gram, leftmost of equals."""
    n = len(grams)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    keyed = (grams & HIGH) | np.arange(n, dtype=np.uint64)
    pad = -n % width
    if pad:
        keyed = np.concatenate([keyed, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)])
    blocks = keyed.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()  # from the block's start up to here
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()  # from here to its end
    return (np.minimum(after[: n - width + 1], before[width - 1 : n]) & LOW).astype(np.int64)


def runs(owner: np.ndarray, first: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of the windows ``first, first + 1, ...`` with these anchors: starts, ends (inclusive), anchors."""
    if not len(owner):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    start = np.arange(first, first + len(owner), dtype=np.int64)
    part = owner * 4096 + (owner - start) // block
    cut = np.flatnonzero(part[1:] != part[:-1]) + 1
    s = start[np.concatenate([[0], cut])]
    e = start[np.concatenate([cut - 1, [len(owner) - 1]])]
    return s, e, owner[np.concatenate([[0], cut])]


def cut_piece(s: int, e: int, anchor: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The piece [s, e] of one anchor in smaller blocks."""
    return runs(np.full(e - s + 1, anchor, dtype=np.int64), s, block)


def piece_keys(data, size: int, s, e, anchor, shape: Shape, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Core and hull of each piece; ``data`` is the text's bytes, ``size`` bytes to a token."""
    core, hull = np.empty(len(s), dtype=np.uint64), np.empty(len(s), dtype=np.uint64)
    digest, view = xxhash.xxh3_64_intdigest, memoryview(data)
    for i, (a, b, x) in enumerate(zip(s.tolist(), e.tolist(), anchor.tolist())):
        j = (x - a) // block
        low = x - j * block  # the last window start of the whole block, then of its first
        high = low - block + 1 + shape.length
        core[i] = digest(view[low * size : high * size], j)
        hull[i] = digest(view[a * size : (b + shape.length) * size], (x - a) * 4096 + (x - b))
    return core, hull


def packed(s, e, anchor) -> np.ndarray:
    """A piece in one long: start, distance of the anchor, windows less one."""
    return (np.asarray(s) << 24) | ((np.asarray(anchor) - s) << 12) | (np.asarray(e) - s)


def unpacked(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pos = np.asarray(pos, dtype=np.int64)
    s = pos >> 24
    return s, s + (pos & 4095), s + ((pos >> 12) & 4095)


def union_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, merged where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
