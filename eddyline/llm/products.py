"""Exact inner products of whole-number vectors of any size."""

from __future__ import annotations

import numpy as np

#: Bits of a limb: products of limbs, summed over 2 ** 11 components, are exact as doubles.
LIMB = 21
MOST_WIDTH = 1 << 11

LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _limbs(matrix: np.ndarray) -> list[np.ndarray]:
    """Signed limbs of whole numbers, lowest first; their sum, each shifted, is the matrix."""
    limbs, rest = [], matrix
    while True:
        higher = np.trunc(np.ldexp(rest, -LIMB))
        limbs.append(rest - np.ldexp(higher, LIMB))
        if not higher.any():
            return limbs
        rest = higher


def _long_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Products of numbers of several limbs, cut off at the range of a long."""
    ones, others = _limbs(left), _limbs(right)
    sums = np.zeros((len(ones) + len(others) - 1, len(left), len(right)), np.int64)
    for place, one in enumerate(ones):
        for further, other in enumerate(others):
            for start in range(0, left.shape[1], MOST_WIDTH):
                part = slice(start, start + MOST_WIDTH)
                sums[place + further] += (one[:, part] @ other[:, part].T).astype(np.int64)
    for place in range(len(sums) - 1):
        sums[place + 1] += sums[place] >> LIMB
        sums[place] &= (1 << LIMB) - 1
    total, limit = sums[-1], 1 << (63 - LIMB)
    over = np.zeros(total.shape, np.int8)
    for place in range(len(sums) - 2, -1, -1):
        over = np.where((over == 0) & (total >= limit), 1, np.where((over == 0) & (total < -limit), -1, over))
        total = np.where(over == 0, (np.where(over == 0, total, 0) << LIMB) | sums[place], total)
    return np.where(over > 0, MOST, np.where(over < 0, LEAST, total))


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of whole numbers held as doubles, as 64-bit integers.

    Rows of small numbers are multiplied as they are; the others limb by limb. Products
    beyond the range of a long are cut off there.
    """
    out = np.zeros((len(left), len(right)), np.int64)
    if not out.size:
        return out
    small = [np.abs(matrix).max(axis=1, initial=0) < 1 << LIMB for matrix in (left, right)]
    if left.shape[1] > MOST_WIDTH:
        small = [np.zeros(len(matrix), bool) for matrix in (left, right)]
    for row_kind in (True, False):
        rows = np.flatnonzero(small[0] == row_kind)
        for column_kind in (True, False):
            columns = np.flatnonzero(small[1] == column_kind)
            if not len(rows) or not len(columns):
                continue
            one = left if len(rows) == len(left) else left[rows]
            other = right if len(columns) == len(right) else right[columns]
            both = row_kind and column_kind
            found = (one @ other.T).astype(np.int64) if both else _long_products(one, other)
            if found.shape == out.shape:
                return found
            out[np.ix_(rows, columns)] = found
    return out
