"""Hashes of words and word windows for whole Arrow batches at once, with numpy.

A word's hash is a polynomial over its bytes, taken from running sums, so its cost does not depend on
where words begin. Arithmetic is modulo 2^64 throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE^0 .. BASE^(n-1), or of its inverse modulo 2^64."""
    key = "inverse" if inverse else "forward"
    held = _powers.get(key)
    if held is None or len(held) < n:
        base = pow(int(BASE), -1, 1 << 64) if inverse else int(BASE)
        factors = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        factors[0] = 1
        held = _powers[key] = np.multiply.accumulate(factors)
    return held[:n]


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))


def running(data: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial of the first i bytes."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODE[data] * powers(len(data)), out=sums[1:])
    return sums


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end], equal for equal bytes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the start of each text, plus the end of the last."""
    plain = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """The words of a batch of texts: byte positions, and for each text the index of its first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def find_words(data: np.ndarray, at: np.ndarray, blank: np.ndarray) -> Words:
    """Runs of bytes that are not `blank`; no run crosses from one text to the next."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~blank
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return Words(data, starts, ends, np.searchsorted(starts, at))


# Space and the control characters from tab to carriage return.
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WEIGHTS = mix(np.arange(1001, 1065, dtype=np.uint64)) | np.uint64(1)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all `size`-word windows, and the text each belongs to.

    A text with fewer words has one window of them all; one without words has none.
    """
    counts = np.diff(first)
    n = len(hashes)
    total = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for k in range(size):
        total += hashes[k : n - size + 1 + k] * WEIGHTS[k] if len(total) else total
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(owner[: len(total)] == owner[size - 1 :]) if len(total) else np.zeros(0, dtype=np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    extra = np.array(
        [(hashes[first[d] : first[d + 1]] * WEIGHTS[: counts[d]]).sum(dtype=np.uint64) ^ WEIGHTS[size + counts[d]] for d in short],
        dtype=np.uint64,
    )
    found = mix(np.concatenate([total[whole], extra]))
    return found, np.concatenate([owner[whole], short])
