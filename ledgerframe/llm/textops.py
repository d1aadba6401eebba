"""Vectorised text primitives over whole Arrow batches.

Texts are handled as the UTF-8 bytes that Arrow already holds: words, hashes and windows of thousands of documents
are found with a few array operations, in slices of about a megabyte so that memory stays flat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of words: all but space and the controls 9 to 13.
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that end a word.
SPACES = ~_SOLID

_U = np.uint64
SLICE_BYTES = 1 << 20
# The prime of the hashes and two bases below it, drawn at random once. Different strings of n values have
# the same hash under a random base with a chance of n in 2**61, whatever their pattern.
PRIME = (1 << 61) - 1
_BASES = (0x1B7C3E94A5D06F28, 0x0E92D41F8B35C7A6)
_P, _LOW = _U(PRIME), _U(0xFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (in place)."""
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    x *= _U(0xA0761D6478BD642F)
    x ^= x >> _U(32)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for any 64-bit words."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def _joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """(high * 2**32 + low) modulo the prime; 2**61 is one."""
    return _reduced((high >> _U(29)) + ((high & _U((1 << 29) - 1)) << _U(32)) + (low & _P) + (low >> _U(61)))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for numbers below it."""
    al, ah, bl, bh = a & _LOW, a >> _U(32), b & _LOW, b >> _U(32)
    high = al * bh + ah * bl  # 2**64 is eight
    return _reduced(_joined(high, al * bl) + ah * bh * _U(8))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo the prime for i < n at least. Those for a slice are kept, longer ones are not."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        out = []
        for b in (_BASES[which], pow(_BASES[which], -1, PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate((p, times(p[: size - len(p)], np.full(1, pow(b, len(p), PRIME), np.uint64))))
            out.append(p)
        if size > SLICE_BYTES + 4096:
            return out[0][:n], out[1][:n]
        _POWERS[which] = (out[0], out[1])
    up, down = _POWERS[which]
    return up[:n], down[:n]


class Sums:
    """Prefix sums of values[j] * base**j modulo the prime, in two halves that don't overflow."""

    def __init__(self, values: np.ndarray, which: int):
        up, self.down = _powers(which, len(values) + 1)
        up = up[:-1]
        if values.dtype == np.uint8 and len(values) < 1 << 22:
            # one more than the byte, so that no value is zero; the halves of a power times nine bits stay small
            small = values.astype(np.uint64) + _U(1)
            low, high = small * (up & _LOW), small * (up >> _U(32))
        else:
            term = times(_reduced(values.astype(np.uint64) + _U(values.dtype == np.uint8)), up)
            low, high = term & _LOW, term >> _U(32)
        self.low, self.high = np.zeros(len(values) + 1, np.uint64), np.zeros(len(values) + 1, np.uint64)
        np.cumsum(low, out=self.low[1:])
        np.cumsum(high, out=self.high[1:])


def prefix_sums(values: np.ndarray, which: int = 0) -> Sums:
    """Of bytes, or of hashes; ranges are hashed from it by range_hash()."""
    return Sums(values, which)


def range_hash(sums: Sums, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], equal for equal content wherever it stands: numbers below 2**61, spread over 64 bits."""
    whole = _joined(sums.high[ends] - sums.high[starts], sums.low[ends] - sums.low[starts])
    return mix(times(whole, sums.down[starts]))


def _by_slice(hashed, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``hashed`` of ranges that don't overlap and are in order, of about a slice at a time."""
    if len(data) <= SLICE_BYTES or not len(starts):
        return hashed(data, starts, ends)
    out, i = [], 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        out.append(hashed(data[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i]))
        i = j
    return np.concatenate(out)


def bytes_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of ranges of bytes that don't overlap and are in order, such as words."""
    return _by_slice(lambda d, a, b: range_hash(prefix_sums(d, which), a, b), data, starts, ends)


# An odd base and its powers modulo 2**64.
_QUICK = 0x9E3779B97F4A7C15
_QUICK_POWERS: list[np.ndarray] = []


def quick_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes modulo 2**64 of ranges of bytes or hashes: several times faster, but there are patterns of 1,024 values and
    more that they don't tell apart. They are for choosing candidates, not for knowing what is equal."""
    n = len(values) + 1
    powers = _QUICK_POWERS
    if not powers or len(powers[0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        made = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)))) for b in (_QUICK, pow(_QUICK, -1, 1 << 64))]
        if size == SLICE_BYTES + 4096:
            powers[:] = made
        powers = made
    sums = np.zeros(n, np.uint64)
    np.cumsum((values.astype(np.uint64) + _U(1)) * powers[0][: n - 1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers[1][starts])


def quick_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``quick_hashes`` of ranges of bytes that don't overlap and are in order."""
    return _by_slice(quick_hashes, data, starts, ends)


def columns(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    col = batch.column(batch.schema.get_field_index(name))
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pa.array([b"" if x is None else x for x in col.to_pylist()], pa.large_binary())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if off is not None and len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def slices(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: first row, row after the last, their bytes, their own offsets."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text (and one past the last) the number of words before it."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = _SOLID[data]
    begin, final = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    final[:-1] &= ~solid[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[edge] = solid[edge]
    edge = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    final[edge] = solid[edge]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(final) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def gram_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Index of every run of ``size`` words that lies in one text."""
    ok = np.zeros(int(first[-1]) + 1, np.int32)
    stop = np.maximum(first[1:] - size + 1, first[:-1])
    np.add.at(ok, first[:-1], 1)
    np.add.at(ok, stop, -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)


def gram_hashes(word_hash: np.ndarray, first: np.ndarray, size: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index and hash of every run of ``size`` words that lies in one text."""
    if len(word_hash) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = gram_starts(first, size)
    return at, range_hash(prefix_sums(word_hash, which), at, at + size)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i : i + width] for each i, by block prefix and suffix minima."""
    n = len(values)
    if width <= 1 or n < width:
        return values.copy() if width <= 1 else values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(values: np.ndarray, width: int) -> np.ndarray:
    """Positions that are a minimum of some window of ``width`` values; of all values, where there are fewer.

    Whether a position counts depends on the values around it alone, so equal stretches have equal anchors, and every
    full window holds at least one.
    """
    n = len(values)
    if n <= width:
        return np.flatnonzero(values == values.min()) if n else np.zeros(0, np.int64)
    least = sliding_min(values, width)
    padded = np.full(n + width - 1, np.iinfo(values.dtype).max, values.dtype)
    padded[width - 1 : n] = ~least
    return np.flatnonzero(~sliding_min(padded, width) == values)


def blocks(data: np.ndarray, offsets: np.ndarray, most: int, ends: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Like ``slices``, but a text of more than ``most`` bytes is cut too, after a byte for which ``ends`` is true, so
    that memory doesn't grow with the longest text. Offsets are those of the parts of texts that lie in the block."""
    at, total = int(offsets[0]), int(offsets[-1])
    while at < total:
        stop = min(at + most, total)
        if stop < total:
            row = int(np.searchsorted(offsets, stop, "right")) - 1
            if offsets[row] > at:
                stop = int(offsets[row])
            else:
                limit = int(offsets[row + 1])
                while stop < limit:
                    found = np.flatnonzero(ends[data[stop : min(stop + 4096, limit)]])
                    if len(found):
                        stop += int(found[0]) + 1
                        break
                    stop = min(stop + 4096, limit)
        a, b = int(np.searchsorted(offsets, at, "right")) - 1, int(np.searchsorted(offsets, stop, "left"))
        yield a, b, data[at:stop], np.clip(offsets[a : b + 1], at, stop) - at
        at = stop


def split(some: np.ndarray, off: np.ndarray, breaks: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of a block of texts, A-Z in lower case, between bytes for which ``breaks`` is true; where each starts."""
    solid = ~breaks[some]
    begin, final = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    final[:-1] &= ~solid[1:]
    inner = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(some))]
    begin[inner] = solid[inner]
    final[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(final) + 1
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(ends - starts)))
    return pa.Array.from_buffers(pa.large_utf8(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(LOWER[some][solid])]), starts
