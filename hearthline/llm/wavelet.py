"""A wavelet matrix over token ids in one compressed file.

Layout (little endian): magic ``HLWM2``, one byte for the number of bit-planes, uint64 tokens, uint64 documents, uint32
bits per block, then a zstd frame with the document ids (int64, a mask of null ids) and token counts (uint32), its
length in front (uint64), then uint64 zeros per plane, then the directory: per plane and block the offset of the zstd
frame (uint64) and the ones before the block (uint64), then per plane the ones before each superblock of 2,048 bits
within its block (uint32), then the frames. Rank and select read a count of the directory, one of the superblocks, and
count the bits of at most 32 words; reading a block unpacks one frame alone.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import zstandard

MAGIC = b"HLWM2"
#: Bits per frame (a multiple of SUPER_BITS), and bits per stored count within it.
BLOCK_BITS = 1 << 18
SUPER_BITS = 2048
SUPER_WORDS = SUPER_BITS // 64


def _words(bit: np.ndarray) -> np.ndarray:
    """Bits as whole 64-bit words, padded with zeros to a whole superblock."""
    packed = np.packbits(bit, bitorder="little")
    out = np.zeros(-(-len(bit) // SUPER_BITS) * SUPER_WORDS * 8, np.uint8)
    out[: len(packed)] = packed
    return out.view("<u8")


def encode(ids: np.ndarray, doc_ids: list[int | None], counts: np.ndarray) -> bytes:
    """ids: the tokens of all documents in order; counts: tokens per document."""
    pack = zstandard.ZstdCompressor(level=1).compress
    bits = max(1, int(ids.max(initial=0)).bit_length())
    level, zeros, directory, supers, frames, at = ids.astype(np.uint16 if bits <= 16 else np.uint32), [], [], [], [], 0
    for plane in range(bits - 1, -1, -1):
        bit = (level & level.dtype.type(1 << plane)) != 0
        ones = 0
        for b in range(0, len(bit), BLOCK_BITS):
            words = _words(bit[b : b + BLOCK_BITS])
            frames.append(pack(words.tobytes()))
            directory += [at, ones]
            at += len(frames[-1])
            own = np.bitwise_count(words).reshape(-1, SUPER_WORDS).sum(1, dtype=np.uint32)
            supers.append(np.cumsum(own, dtype=np.uint32) - own)
            ones += int(own.sum())
        zeros.append(len(bit) - ones)
        level = np.concatenate((level.take(np.flatnonzero(~bit)), level.take(np.flatnonzero(bit))))
    known = np.array([x is not None for x in doc_ids], bool)
    documents = pack(np.array([x or 0 for x in doc_ids], "<i8").tobytes() + known.tobytes() + counts.astype("<u4").tobytes())
    head = MAGIC + struct.pack("<BQQIQ", bits, len(ids), len(doc_ids), BLOCK_BITS, len(documents))
    counted = np.concatenate(supers).astype("<u4").tobytes() if supers else b""
    return head + documents + np.array(zeros, "<u8").tobytes() + np.array(directory, "<u8").tobytes() + counted + b"".join(frames)


class WaveletMatrix:
    """Reads a file of ``encode`` and answers access, rank, select and count without unpacking it whole."""

    def __init__(self, raw: bytes):
        if raw[:5] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.bits, self.n, docs, self.block, length = struct.unpack_from("<BQQIQ", raw, 5)
        at = 5 + struct.calcsize("<BQQIQ")
        head = zstandard.ZstdDecompressor().decompress(raw[at : at + length])
        known = np.frombuffer(head, bool, docs, 8 * docs)
        self.doc_ids = [int(x) if k else None for x, k in zip(np.frombuffer(head, "<i8", docs), known, strict=True)]
        self.counts = np.frombuffer(head, "<u4", docs, 9 * docs).astype(np.int64)
        at += length
        self.zeros = np.frombuffer(raw, "<u8", self.bits, at).astype(np.int64)
        at += 8 * self.bits
        self.blocks = -(-self.n // self.block)
        self.directory = np.frombuffer(raw, "<u8", 2 * self.bits * self.blocks, at).astype(np.int64).reshape(self.bits, self.blocks, 2)
        at += 16 * self.bits * self.blocks
        self.supers = -(-self.n // SUPER_BITS)
        self.before = np.frombuffer(raw, "<u4", self.bits * self.supers, at).reshape(self.bits, self.supers)
        self.raw, self.data = raw, at + 4 * self.bits * self.supers
        self._block = lru_cache(64)(self._unpack)

    def _unpack(self, plane: int, block: int) -> np.ndarray:
        """The words of a block."""
        frame = zstandard.ZstdDecompressor().decompressobj().decompress(memoryview(self.raw)[self.data + int(self.directory[plane, block, 0]) :])
        return np.frombuffer(frame, "<u8")

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        if i >= self.n:
            return self.n - int(self.zeros[plane])
        block, rest = divmod(i, self.block)
        word = rest // 64
        first = word // SUPER_WORDS * SUPER_WORDS
        words = self._block(plane, block)
        inside = int(np.bitwise_count(words[first:word]).sum()) + (int(words[word]) & ((1 << rest % 64) - 1)).bit_count()
        return int(self.directory[plane, block, 1]) + int(self.before[plane, i // SUPER_BITS]) + inside

    def _bit(self, plane: int, i: int) -> int:
        block, rest = divmod(i, self.block)
        return int(self._block(plane, block)[rest // 64]) >> (rest % 64) & 1

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.bits):
            bit, ones = self._bit(plane, i), self._ones(plane, i)
            value = value << 1 | bit
            i = int(self.zeros[plane]) + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        a, b = 0, i
        for plane in range(self.bits):
            ones_a, ones_b = self._ones(plane, a), self._ones(plane, b)
            if token >> (self.bits - 1 - plane) & 1:
                a, b = int(self.zeros[plane]) + ones_a, int(self.zeros[plane]) + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def rank(self, token: int, i: int) -> int:
        """How often the token occurs before position i."""
        if token >> self.bits:
            return 0
        a, b = self._range(token, i)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The position of the token's occurrence number k, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0)[0] + k
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            i = self._find(plane, bit, i - int(self.zeros[plane]) if bit else i)
        return i

    def _find(self, plane: int, bit: int, k: int) -> int:
        """The place of the plane's one (or zero) number k, from 0."""
        blocks = self.directory[plane, :, 1] if bit else np.arange(self.blocks) * self.block - self.directory[plane, :, 1]
        block = int(np.searchsorted(blocks, k, "right")) - 1
        k -= int(blocks[block])
        first = block * self.block // SUPER_BITS
        ones = self.before[plane, first : first + self.block // SUPER_BITS].astype(np.int64)
        supers = ones if bit else np.arange(len(ones)) * SUPER_BITS - ones
        at = int(np.searchsorted(supers, k, "right")) - 1
        k -= int(supers[at])
        words = self._block(plane, block)[at * SUPER_WORDS : (at + 1) * SUPER_WORDS]
        upto = np.cumsum(np.bitwise_count(words if bit else ~words), dtype=np.int64)
        word = int(np.searchsorted(upto, k, "right"))
        k -= int(upto[word - 1]) if word else 0
        bits = np.unpackbits(words[word : word + 1].view(np.uint8), bitorder="little")
        return block * self.block + at * SUPER_BITS + word * 64 + int(np.flatnonzero(bits == bit)[k])

    def decode(self) -> np.ndarray:
        """All tokens: the planes are undone from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        value = np.zeros(self.n, kind)
        for plane in range(self.bits - 1, -1, -1):
            words = np.concatenate([self._unpack(plane, b) for b in range(self.blocks)]) if self.n else np.zeros(0, "<u8")
            bit = np.unpackbits(words.view(np.uint8), count=self.n, bitorder="little").view(bool)
            above, zeros = np.empty_like(value), int(self.zeros[plane])
            above[np.flatnonzero(~bit)], above[np.flatnonzero(bit)] = value[:zeros], value[zeros:] | kind(1 << (self.bits - 1 - plane))
            value = above
        return value.astype(np.uint32)
