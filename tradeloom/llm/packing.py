"""Many small numbers as one binary value of a row, for shuffles."""

from __future__ import annotations

import numpy as np


def planes(values: np.ndarray) -> bytes:
    """How many bytes of each number follow, then these byte by byte, the low bytes of all first.

    High bytes that are zero in all numbers are left out: rows are held unpacked wherever they are sorted or passed on.
    """
    table = values.view(np.uint8).reshape(len(values), values.itemsize)
    width = values.itemsize
    while width > 1 and not table[:, width - 1].any():
        width -= 1
    return b"".join((bytes([width]), np.ascontiguousarray(table[:, :width].T)))


def unplanes(data: bytes, kind: type) -> np.ndarray:
    low = np.frombuffer(data, np.uint8)[1:].reshape(data[0], -1).T
    table = np.zeros((len(low), np.dtype(kind).itemsize), np.uint8)
    table[:, : data[0]] = low
    return table.view(kind).ravel()


def edges(found: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal ranges of 64-bit hashes begins in sorted hashes, and the end."""
    limits = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    return np.r_[0, np.searchsorted(found, limits), len(found)]
