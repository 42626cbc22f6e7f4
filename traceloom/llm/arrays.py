"""Vectorised work on Arrow text columns: bytes, tokens and 64-bit token hashes without Python strings.

A text is its UTF-8 bytes. Separators are the ASCII characters space and 0x09-0x0D, which never occur inside a
multi-byte character, so byte-level splitting equals splitting by code point. A token's hash is a polynomial over random
64-bit values of its bytes modulo 2**64, passed through a mixer; it depends on the bytes alone, on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}
#: Bytes of text that one numpy pass holds; a longer single text makes a pass of its own.
PASS_BYTES = 1_000_000


def powers(n: int, sign: int = 1) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, of the inverse base for sign -1."""
    have = _powers[sign]
    if len(have) < n:
        base = np.full(max(n, 2 * len(have)), _BASE if sign > 0 else _INVERSE, np.uint64)
        base[0] = 1
        have = _powers[sign] = np.cumprod(base, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each row's text; a null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) < 2 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def passes(offsets: np.ndarray, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``limit`` bytes together, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end
        row = end


class Tokens:
    """Tokens of several texts: hash, byte start and end, and for each text the index of its first token."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = LOWER, separator: np.ndarray = SEPARATORS):
        n = len(data)
        bounds = np.zeros(n + 1, bool)
        bounds[offsets[:-1]] = True
        apart = separator[data]
        before = np.empty(n, bool)
        before[:1] = True
        before[1:] = apart[:-1]
        after = np.empty(n, bool)
        after[-1:] = True
        after[:-1] = apart[1:]
        self.start = np.flatnonzero(~apart & (before | bounds[:n]))
        self.end = np.flatnonzero(~apart & (after | bounds[1 : n + 1])) + 1
        if n and offsets[-1] == n:  # the last text ends with the data
            pass
        self.first = np.searchsorted(self.start, offsets)
        value = np.zeros(n + 1, np.uint64)
        np.cumsum(_RANDOM[fold[data]] * powers(n), out=value[1:], dtype=np.uint64)
        inverse = powers(n, -1)
        self.hash = mix((value[self.end] - value[self.start]) * inverse[self.start]) if len(self.start) else np.zeros(0, np.uint64)

    def row(self) -> np.ndarray:
        """The text of each token."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def shingles(tokens: Tokens, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``width`` tokens, and each text's first; a shorter text's whole sequence is one."""
    counts = np.diff(tokens.first)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = len(tokens.hash)
    value = np.zeros(n + 1, np.uint64)
    np.cumsum(tokens.hash * powers(n), out=value[1:], dtype=np.uint64)
    at = np.arange(first[-1]) - np.repeat(first[:-1], sizes) + np.repeat(tokens.first[:-1], sizes)
    ends = np.minimum(at + width, np.repeat(tokens.first[1:], sizes))
    return mix((value[ends] - value[at]) * powers(max(n, 1), -1)[at]) if len(at) else np.zeros(0, np.uint64), first
