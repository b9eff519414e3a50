"""Words and their 64-bit hashes, computed over whole Arrow string buffers with numpy.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z: ASCII digits and letters, and every
character beyond ASCII. In UTF-8 that is a property of single bytes, so words are found and hashed bytewise.
"""
from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a longer text is hashed piece by piece.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(maxsize=None)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64, up to a piece."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        x = np.full(PIECE + 1, b, _U)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


@functools.lru_cache(maxsize=None)
def _codes() -> np.ndarray:
    """Byte -> its code in a word, lower-cased and never 0 there; 0 outside of words."""
    code = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if 48 <= low <= 57 or 97 <= low <= 122 or low >= 128:
            code[b] = low
    return code


def word_hashes(raw: np.ndarray, bounds: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``raw``: the bytes of texts one after the other, ``bounds``: where each starts, and the end. ``codes`` gives each byte's
    code in a word, 0 outside of words; by default the rule above.

    Returns the hash of every word in order, and where each text's words start, and the end. Hashes 0 and 1 are free
    for the callers' padding."""
    power, inverse = _powers()
    codes = _codes() if codes is None else codes
    parts_h, parts_at, open_length = [], [], 0
    begins = np.zeros(len(raw) + 1, bool)
    begins[bounds] = True
    for at in range(0, len(raw), PIECE):
        code = codes[raw[at:at + PIECE]]
        n = len(code)
        inside = code != 0
        fresh = begins[at:at + n]
        before = np.empty(n, bool)
        before[0], before[1:] = False, inside[:-1]
        start = np.flatnonzero(inside & (~before | fresh))
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, inside[1:] & ~fresh[1:]
        end = np.flatnonzero(inside & ~after) + 1
        sums = np.zeros(n + 1, _U)
        np.cumsum(code.astype(_U) * power[:n], out=sums[1:])
        h = (sums[end] - sums[start]) * inverse[start]
        length = end - start
        if open_length and len(start) and start[0] == 0 and not fresh[0]:  # the piece goes on with the last word
            shifted = int(h[0]) * pow(_BASE, open_length, 1 << 64)
            parts_h[-1][-1] = _U((int(parts_h[-1][-1]) + shifted) & ((1 << 64) - 1))
            open_length = open_length + int(length[0]) if end[0] == n else 0
            start, h, length, end = start[1:], h[1:], length[1:], end[1:]
        elif open_length:
            open_length = 0
        if len(end):
            open_length = int(length[-1]) if end[-1] == n else 0
            parts_h.append(h)
            parts_at.append(start + at)
    if not parts_h:
        return np.zeros(0, _U), np.zeros(len(bounds), np.int64)
    h = mix(np.concatenate(parts_h))
    h[h < 2] += _U(2)
    return h, np.searchsorted(np.concatenate(parts_at), bounds).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def grams(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the k words from each word on, and whether they lie in one text."""
    n = len(words)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    whole = np.arange(n) + k <= ends
    if n < k:
        return np.zeros(n, _U), whole
    h = np.zeros(n, _U)
    for j in range(k):
        h[:n - k + 1] = (h[:n - k + 1] + words[j:n - k + 1 + j]) * _U(0xD1342543DE82EF95)
    return mix(h + _U(k)), whole


def row_slices(bounds: np.ndarray, most: int):
    """Ranges of rows that hold about ``most`` bytes; one larger row is a range of its own."""
    start, n = 0, len(bounds) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + most, "right")) - 1)
        yield start, end
        start = end
