"""Words of UTF-8 texts: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A to Z.

Digits, ASCII letters and everything beyond ASCII are parts of words, so words can be told by
their bytes and are cut at whole characters.
"""

from __future__ import annotations

import numpy as np

_BLANK = 32


def _byte_table() -> bytes:
    table = bytearray([_BLANK]) * 256
    for byte in (*range(48, 58), *range(97, 123), *range(128, 256)):
        table[byte] = byte
    for byte in range(65, 91):
        table[byte] = byte + 32
    return bytes(table)


#: Each byte's lower-case form, or a blank where it belongs to no word.
TABLE = _byte_table()
_TABLE = np.frombuffer(TABLE, np.uint8)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _TABLE[data] != _BLANK
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit integers with all bits stirred."""
    values = values.astype(np.uint64)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


#: A random 64-bit value for every byte of a word.
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_TABLE]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Powers that are kept for each base; longer runs are made of them, block by block.
_KEPT_POWERS = 1 << 16
_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base ** 0, base ** 1, ... modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None:
        factors = np.full(_KEPT_POWERS, base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.multiply.accumulate(factors)
    if size <= _KEPT_POWERS:
        return known[:size]
    blocks = np.full(-(-size // _KEPT_POWERS), pow(base, _KEPT_POWERS, 1 << 64), np.uint64)
    blocks[0] = 1
    return (np.multiply.accumulate(blocks)[:, None] * known[None, :]).ravel()[:size]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, the same wherever the word stands."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * powers(_BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts])


def shingle_hashes(words: np.ndarray, owners: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and owners of all runs of `size` words that stay with one owner.

    An owner with fewer words, but some, has one shingle of all of them. `owners` ascend.
    """
    if len(words) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, owners.dtype)
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64))
    factors |= np.uint64(1)
    full = max(0, len(words) - size + 1)
    hashes = np.zeros(full, np.uint64)
    for place in range(size):
        hashes += words[place:place + full] * factors[place]
    within = owners[:full] == owners[size - 1:size - 1 + full]
    first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
    counts = np.diff(np.r_[first, len(owners)])
    short = counts < size
    extra = np.zeros(int(short.sum()), np.uint64)
    begin, length = first[short], counts[short]
    for place in range(size - 1):
        there = place < length
        extra[there] += words[begin[there] + place] * factors[place]
    extra += length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (
        mixed(np.r_[hashes[within], extra]),
        np.r_[owners[:full][within], owners[begin]],
    )
