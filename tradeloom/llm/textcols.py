"""Whole Arrow text columns as numpy arrays: tokens, their hashes, and n-gram hashes.

Everything works on UTF-8 bytes and on blocks of bounded size, so that memory in a task does not
depend on the number of rows in a batch (a single longer text makes a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

U64 = np.uint64


def byte_table(pattern: str) -> np.ndarray:
    """A table of 256 flags from ranges such as ``"0-9 a-z 80-FF"`` (two hex digits or single characters)."""
    table = np.zeros(256, bool)
    for part in pattern.split():
        low, high = part.split("-")
        low, high = (int(x, 16) if len(x) == 2 else ord(x) for x in (low, high))
        table[low : high + 1] = True
    return table


#: Words between ASCII white space, as ``[^\x20\x09-\x0D]+``.
NOT_SPACE = byte_table("00-08 0E-1F 21-FF")
#: Letters, digits and everything beyond ASCII, after A-Z were lower-cased.
ALNUM = byte_table("0-9 a-z 80-FF")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    x = x ^ (x >> U64(31)) ^ (x >> U64(62))
    x *= U64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> U64(27)) ^ (x >> U64(54))
    x *= U64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> U64(30)) ^ (x >> U64(60))


class Hasher:
    """Polynomial hashes modulo 2**64 of byte ranges and of word windows; a seed picks the polynomial."""

    def __init__(self, seed: int = 1):
        values = mix(np.arange(1, 260, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
        self.codes, self.step = values[:256] | U64(1), values[256] | U64(1)
        self.back = U64(pow(int(self.step), -1, 1 << 64))
        self.combine = values[257] | U64(1)
        self.powers = self.backs = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, min(1 << (n - 1).bit_length(), BLOCK_BYTES + 1))
            self.powers, self.backs = (np.cumprod(np.r_[U64(1), np.full(size - 1, x, U64)]) for x in (self.step, self.back))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.empty(len(data) + 1, U64)
        sums[0] = 0
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end] from the prefix sums of data."""
        return mix((sums[ends] - sums[starts]) * self.backs[starts] + (ends - starts).astype(U64))

    def windows(self, words: np.ndarray, n: int) -> np.ndarray:
        """The hash of words[i:i+n] for every i; windows across documents are for the caller to leave out."""
        count = len(words) - n + 1
        if count <= 0:
            return np.empty(0, U64)
        out = words[:count].copy()
        for k in range(1, n):
            out *= self.combine
            out += words[k : k + count]
        return mix(out + U64(n))


class Block:
    """Some rows' texts as one byte array; bounds[i]:bounds[i+1] are the bytes of row i."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.data, self.bounds = first, data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, table: np.ndarray, lower: bool = False) -> "Words":
        return Words(self, LOWER[self.data] if lower else self.data, table)


class Words:
    """Maximal runs of accepted bytes within each row of a block: byte ranges and their rows."""

    def __init__(self, block: Block, data: np.ndarray, table: np.ndarray):
        self.data = data
        inside = table[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = block.bounds[:-1][np.diff(block.bounds) > 0]
        before[edges] = False
        after[edges[1:] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: Words of row i are first[i]:first[i+1].
        self.first = np.searchsorted(self.starts, block.bounds)
        self.rows = np.repeat(np.arange(len(block)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, hasher: Hasher) -> np.ndarray:
        return hasher.ranges(hasher.prefix(self.data), self.starts, self.ends)

    def text(self, low: int, high: int) -> bytes:
        """Words low:high joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[low:high], self.ends[low:high], strict=True))

    def within(self, n: int) -> np.ndarray:
        """For each window of n words: does it lie in one row?"""
        count = max(0, len(self) - n + 1)
        return self.rows[:count] == self.rows[n - 1 : n - 1 + count]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of an Arrow column (null: empty) in blocks of at most ``limit`` bytes, or one text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    binary = column.cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    raw = binary.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    low = 0
    while low < len(binary):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield Block(low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def covered(starts: np.ndarray, width: np.ndarray | int, size: int) -> np.ndarray:
    """Flags of the positions inside any [start, start + width)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.subtract.at(change, starts + width, 1)
    return np.cumsum(change[:-1]) > 0
