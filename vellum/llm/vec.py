"""Words, hashes and windows of whole Arrow columns of text, without a Python loop per word.

A column's bytes are scanned in slices of about SLICE bytes of whole texts.  A
word's 64-bit hash is a polynomial over its bytes, taken for all words at once
from running sums; windows combine the hashes of neighbouring words.  Nothing
depends on how texts are batched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 19
U = np.uint64
_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)
_Q = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)], U)
_SEP = np.zeros(256, bool)
_SEP[[32, *range(9, 14)]] = True

#: Byte values as they are, never 0.
PLAIN = np.arange(1, 257, dtype=np.uint16)
#: Lower-cased; ASCII punctuation counts as absent.
FOLDED = np.array([0 if b < 128 and not chr(b).isalnum() else ord(chr(b).lower()) + 1 if b < 128 else b + 1 for b in range(256)], np.uint16)

_powers = np.ones(1, U), np.ones(1, U)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, SLICE + (SLICE >> 2) + 1)
        up, down = np.full(n, _P, U), np.full(n, _INV, U)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finisher of 64-bit hashes."""
    h = h + U(salt * _P & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


@dataclass
class Words:
    """Words of a slice: byte spans in ``buf``; those of text d are ``off[d]:off[d + 1]``; ``value`` is what was hashed."""

    buf: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    off: np.ndarray
    hash: np.ndarray
    value: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.off)

    @property
    def text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.off) - 1), self.n)

    def line(self) -> np.ndarray:
        """The number of each word's line in its text, lines being split at \\n."""
        newline = np.flatnonzero(self.buf == 10)
        return np.searchsorted(newline, self.start) - np.repeat(np.searchsorted(newline, self.text_at[:-1]), self.n)


def small(batches, rows: int = 1024):
    """Arrow batches in parts of few rows, which bounds what is held at once."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of runs of whole texts of about SLICE bytes; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE, "right")) - 1)
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def lowered(buf: np.ndarray) -> np.ndarray:
    """Latin-1 capitals beyond ASCII in lower case; ASCII is left to FOLDED."""
    capital = np.zeros(len(buf), bool)
    capital[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
    return np.where(capital, buf + np.uint8(0x20), buf) if capital.any() else buf


def words(buf: np.ndarray, text_at: np.ndarray, values: np.ndarray = PLAIN) -> Words:
    """Words are runs of bytes other than blank and \\t to \\r.

    Bytes whose value is 0 don't count at a word's ends; a word of only such
    bytes is none.
    """
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(buf, text_at, none, none, np.zeros(len(text_at), np.int64), np.zeros(0, U), np.zeros(0, np.uint16))
    inside = ~_SEP[buf]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    before[text_at[:-1][text_at[:-1] < len(buf)]] = False
    after[text_at[1:][text_at[1:] > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    value = values[lowered(buf) if values is FOLDED else buf]
    if not values.all():
        real = np.flatnonzero(value)
        first = np.searchsorted(real, start)
        last = np.searchsorted(real, end) - 1
        some = first <= last
        start, end = real[first[some]] if some.any() else start[:0], real[last[some]] + 1 if some.any() else end[:0]
    return Words(buf, text_at, start, end, np.searchsorted(start, text_at), spans(value, start, end), value)


def spans(value: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of byte values; both ends ascend."""
    h = np.empty(len(start), U)
    k = 0
    while k < len(start):  # one round, but for texts longer than a slice
        base = start[k]
        to = max(k + 1, int(np.searchsorted(end, base + SLICE + (SLICE >> 2), "right")))
        stretch = value[base : end[to - 1]]
        up, down = _power(len(stretch) + 1)
        running = np.zeros(len(stretch) + 1, U)
        np.cumsum(stretch * up[: len(stretch)], out=running[1:])
        s, e = start[k:to] - base, end[k:to] - base
        h[k:to] = (running[e] - running[s]) * down[s]
        k = to
    return mix(h)


def windows(h: np.ndarray, off: np.ndarray, width: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, their texts' offsets, and the first word of each.

    With ``short``, a text of fewer words, but some, has one window of all.
    """
    n = np.diff(off)
    count = np.maximum(n - width + 1, 0)
    small = (n > 0) & (n < width)
    if short:
        count = np.where(small, 1, count)
    out_off = np.concatenate(([0], np.cumsum(count)))
    first = np.arange(out_off[-1]) + np.repeat(off[:-1] - out_off[:-1], count)
    out = np.zeros(len(first), U)
    for j in range(width):
        at = first + j
        if short and small.any():
            have = j < np.repeat(n, count)
            out += np.where(have, h[np.minimum(at, len(h) - 1)] * _Q[j], U(0))
        else:
            out += h[at] * _Q[j]
    return mix(out), out_off, first


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of the stretches ``off[d]:off[d + 1]``, wrapping."""
    running = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=running[1:])
    return running[off[1:]] - running[off[:-1]]


class Bloom:
    """A bit table of fixed size for a first, one-sided test of membership.

    Its size bounds what is broadcast, whatever the number of members; a full
    table only lets more rows through to the exact join that follows.
    """

    def __init__(self, bits: int, table: np.ndarray | None = None):
        self.bits = bits
        self.table = np.zeros(1 << (bits - 3), np.uint8) if table is None else table

    def _at(self, h: np.ndarray, k: int) -> np.ndarray:
        return (mix(h, k + 1) >> U(64 - self.bits)).astype(np.int64)

    def add(self, h: np.ndarray) -> None:
        for k in range(2):
            at = self._at(h, k)
            np.bitwise_or.at(self.table, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def has(self, h: np.ndarray) -> np.ndarray:
        at = self._at(h, 0)
        found = np.flatnonzero(self.table[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        at = self._at(h[found], 1)
        out = np.zeros(len(h), bool)
        out[found] = self.table[at >> 3] >> (at & 7).astype(np.uint8) & 1
        return out


def bloom_of(df, column: str | list[str], bits: int = 24, hashed=None) -> Bloom:
    """A Bloom table of a bigint column, or of what ``hashed`` makes of some columns without nulls: made by at most 64 tasks, one table each, and merged one by one."""

    def run(batches):
        b = Bloom(bits)
        for batch in batches:
            if hashed is None:
                b.add(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(U))
            else:
                b.add(hashed(*(c.to_numpy(zero_copy_only=False) for c in batch.columns)))
        if b.table.any():
            import zlib

            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(b.table.tobytes(), 1)], pa.binary())], ["table"])

    import zlib

    whole = np.zeros(1 << (bits - 3), np.uint8)
    for row in df.select(column).coalesce(64).mapInArrow(run, "table binary").toLocalIterator():
        whole |= np.frombuffer(zlib.decompress(row[0]), np.uint8)
    return Bloom(bits, whole)
