"""Vectorised work on the UTF-8 bytes of Arrow string columns: words, word hashes and word shingles.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as a-z. A null text is an empty one.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes worked on at once; a longer single text is worked on alone.
SLICE_BYTES = 1 << 19

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def tidy(run):
    """For a function of Arrow batches that a task runs: at its end, memory goes back to the system. Workers live on from
    task to task, and would keep what the largest batch of each kind of task needed."""

    @functools.wraps(run)
    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # the C library of other systems has no such function
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and, for each row, where it starts; one more entry ends the last."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    return (np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one more entry ends the last).
    ``offsets`` count from the start of ``data``."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    full = ~IS_SPACE[data]
    begins, ends = cut[:-1].copy(), cut[1:].copy()
    begins[1:] |= ~full[:-1]
    ends[:-1] |= ~full[1:]
    starts = np.flatnonzero(full & begins)
    return starts, np.flatnonzero(full & ends) + 1, np.searchsorted(starts, offsets)


def dealt(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` at ``starts``, one behind the other."""
    upto = np.cumsum(sizes)
    return pool[np.repeat(starts - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)]


def _packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as a binary array: all bytes that are no space, cut at the words' ends."""
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~IS_SPACE[data]])])


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of ``words`` (by their bytes, as binary) and the place of each word among them."""
    coded = _packed(data, starts, ends).dictionary_encode()
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()


def _chunks(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Bytes 8k to 8k + 7 of words that have that many, as numbers; what lies behind a word's end is zero. ``data`` has
    eight bytes to spare."""
    wide = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    left = np.minimum(sizes - 8 * k, 8).astype(U64)
    return wide[starts + 8 * k] & (~U64(0) >> (U64(64) - U64(8) * left))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the words, A-Z as a-z: eight bytes at a time are mixed into a seeded state, each time by a
    bijection that is not linear, so that no words collide by construction under two seeds at once. Hashes of two
    seeds are independent: together they are 128 bits."""
    data = np.concatenate((LOWER[data], np.zeros(8, np.uint8)))
    sizes = ends - starts
    out = mix((sizes.astype(U64) + U64(seed + 1)) * U64(0x9E3779B97F4A7C15))
    salt, at, k = mix(np.array([seed + 1], U64))[0], np.arange(len(starts)), 0
    while len(at):
        out[at] = mix((out[at] ^ _chunks(data, starts[at], sizes[at], k)) * U64(0xD6E8FEB86659FD93) + salt)
        k += 1
        at = at[sizes[at] > 8 * k]
        if k >= 32:  # words of more than 256 bytes, which are few, one by one
            for w in at.tolist():
                digest = hashlib.blake2b(data[starts[w] : ends[w]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
                out[w] ^= U64(int.from_bytes(digest, "little"))
            break
    return out


def _cuts(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)


def texts(column: pa.Array) -> list[str]:
    """The strings of a binary array without nulls, all decoded in one go."""
    cuts, raw = _cuts(column), column.buffers()[2]
    if not len(column) or raw is None:
        return [""] * len(column)
    text = raw.to_pybytes()[cuts[0] : cuts[-1]].decode()
    if len(text) < cuts[-1] - cuts[0]:  # places in bytes are those of characters only if all are ASCII
        lead = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8)[cuts[0] : cuts[-1]] & 0xC0) != 0x80)))
        cuts = lead[cuts - cuts[0]]
    else:
        cuts = cuts - cuts[0]
    at = cuts.tolist()
    return [text[a:b] for a, b in zip(at, at[1:], strict=False)]


class WordNumbers:
    """Numbers distinct words in the order in which they come. Words are told apart by their bytes: those of at most 16
    as two numbers and a length in a table with open places, longer ones in a dict."""

    def __init__(self) -> None:
        self.size, self.long = 0, {}
        self.keys = np.zeros((3, 1 << 10), U64)
        self.table = np.full(1 << 11, -1, np.int32)

    def __len__(self) -> int:
        return self.size

    @staticmethod
    def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cuts, raw = _cuts(column).astype(np.int64), column.buffers()[2] if len(column) else None
        data = np.concatenate((np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), np.zeros(16, np.uint8)))
        sizes = np.diff(cuts)
        key = np.zeros((3, len(sizes)), U64)
        some = sizes > 0
        key[0, some] = _chunks(data, cuts[:-1][some], sizes[some], 0)
        more = sizes > 8
        key[1, more] = _chunks(data, cuts[:-1][more], sizes[more], 1)
        key[2] = sizes
        return key, np.flatnonzero(sizes > 16)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return (mix(key[0] ^ mix(key[1] + key[2])) & U64(len(self.table) - 1)).astype(np.int64)

    def find(self, column: pa.Array) -> np.ndarray:
        """Each word's number, or -1."""
        key, long_ = self._keys(column)
        out, open_, slot = np.full(len(column), -1, np.int64), np.arange(len(column)), self._slots(key)
        while len(open_):
            at = self.table[slot]
            own = (at >= 0) & (self.keys[:, at] == key[:, open_]).all(0)
            out[open_[own]] = at[own]
            on = (at >= 0) & ~own
            open_, slot = open_[on], (slot[on] + 1) & (len(self.table) - 1)
        if len(long_):
            out[long_] = [self.long.get(w, -1) for w in column.take(pa.array(long_)).to_pylist()]
        return out

    def add(self, column: pa.Array) -> np.ndarray:
        """Numbers words that are distinct and new."""
        key, long_ = self._keys(column)
        number = self.size + np.arange(len(column))
        self.size += len(column)
        self.long.update(zip(column.take(pa.array(long_)).to_pylist(), number[long_].tolist(), strict=True))
        while self.keys.shape[1] < self.size:
            self.keys = np.concatenate((self.keys, np.zeros_like(self.keys)), axis=1)
        self.keys[:, number] = key
        self.keys[2, number[long_]] = 0  # found in the dict alone
        if 2 * self.size > len(self.table):
            self.table = np.full(1 << (4 * self.size).bit_length(), -1, np.int32)
            self._place(np.arange(self.size))
        else:
            self._place(number)
        return number

    def _place(self, number: np.ndarray) -> None:
        slot = self._slots(self.keys[:, number])
        while len(number):
            free = self.table[slot] < 0
            self.table[slot[free]] = number[free]
            left = self.table[slot] != number
            number, slot = number[left], (slot[left] + 1) & (len(self.table) - 1)


_PLACE = mix(np.arange(101, 117, dtype=U64))


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the ``width``-word shingles of each row, and where each row's start (one more entry ends the
    last); with fewer words, of the whole sequence as one; of a row without words, none."""
    n = len(hashes)
    rolled = np.zeros(n, U64)
    for j in range(width):  # a shingle mixes in one word after the other
        whole = max(0, n - j)
        rolled[:whole] = mix((rolled[:whole] ^ hashes[j:]) * (_PLACE[j] | U64(1)))
    size = np.diff(first)
    for row in np.flatnonzero((size > 0) & (size < width)).tolist():
        a, x = first[row], _PLACE[8 + size[row] : 9 + size[row]]
        for h in hashes[a : a + size[row]].tolist():
            x = mix((x ^ U64(h)) * (_PLACE[0] | U64(1)))
        rolled[a] = x[0]
    count = np.where(size < width, size > 0, size - width + 1)
    at = np.concatenate(([0], np.cumsum(count)))
    keep = np.repeat(first[:-1] - at[:-1], count) + np.arange(at[-1])
    return rolled[keep] >> U64(1), at


def long_lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
