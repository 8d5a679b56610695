"""Ratcliff-Obershelp ratios of many pairs of strings at once, equal to difflib.SequenceMatcher's.

Each round finds the longest common block of every open pair of pieces (the first in the left, then in the right
piece, as difflib does) and opens the pieces on both sides of it. A row of bits holds the places of the right string
that equal one character of the left; runs grow by shifting rows against each other.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

#: Characters of a string that fit a row of bits (longer ones go through difflib); entries of a table of rows.
WORD, TABLE = 63, 1 << 20


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in a matrix, -1 after the end, and lengths."""
    size = np.array([len(x) for x in texts], np.int64)
    out = np.full((len(texts), max(1, size.max(initial=0))), -1, np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, size


def _longest(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, row, bit) of the longest diagonal run of bits in each column; the first row, then the first bit."""
    n = rows.shape[1]
    size, at, bit = (np.zeros(n, np.int64) for _ in range(3))
    open_ = np.flatnonzero(np.bitwise_or.reduce(rows, axis=0))
    if len(open_) < n:
        rows = rows[:, open_]
    k, left = 1, np.ones(len(open_), bool)
    while left.any():
        longer = rows[:-1] & (rows[1:] >> rows.dtype.type(1))
        on = np.bitwise_or.reduce(longer, axis=0) != 0 if len(longer) else np.zeros(len(left), bool)
        end = np.flatnonzero(left & ~on)
        if len(end):
            r = (rows[:, end] != 0).argmax(axis=0)
            word = rows[r, end]
            size[open_[end]], at[open_[end]], bit[open_[end]] = k, r, np.bitwise_count((word & (~word + rows.dtype.type(1))) - rows.dtype.type(1))
        rows, left, k = longer, on, k + 1
        if 2 * np.count_nonzero(left) < len(left):
            keep = np.flatnonzero(left)
            rows, open_, left = rows[:, keep], open_[keep], left[keep]
    return size, at, bit


def _matches(a: list[str], b: list[str], ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Characters in common blocks of each pair (a[ia], b[ib]); no string has more than WORD characters."""
    used_a, ia = np.unique(ia, return_inverse=True)
    used_b, ib = np.unique(ib, return_inverse=True)
    (ca, la), (cb, lb) = _codes([a[i] for i in used_a]), _codes([b[i] for i in used_b])
    known = np.unique(cb[cb >= 0])
    if len(used_b) > 1 and len(used_b) * (len(known) + 1) > TABLE:
        low = ib < len(used_b) // 2
        out = np.zeros(len(ib), np.int64)
        for part in (np.flatnonzero(low), np.flatnonzero(~low)):
            out[part] = _matches(a, b, used_a[ia[part]], used_b[ib[part]])
        return out
    word, none = (np.uint32 if cb.shape[1] < 32 else np.uint64), len(known)
    places = np.zeros((len(used_b), none + 1), word)  # the last column: characters that no right string has
    for j in range(cb.shape[1]):
        r = np.flatnonzero(lb > j)
        places[r, np.searchsorted(known, cb[r, j])] |= word(1 << j)
    code = np.searchsorted(known, ca)
    code[(code == none) | (np.append(known, -2)[code] != ca)] = none
    places, code, wide = places.ravel(), code.ravel(), ca.shape[1]
    total = np.zeros(len(ia), np.int64)
    work = [np.arange(len(ia)), np.zeros(len(ia), np.int64), la[ia], np.zeros(len(ia), np.int64), lb[ib]]
    while len(work[0]):
        pieces, tall = [], work[2] - work[1]
        for top in (1, 2, 4, 8, 16, 32, 64):
            of = np.flatnonzero((tall > top // 2) & (tall <= top))
            if not len(of):
                continue
            p, a0, a1, b0, b1 = work if len(of) == len(tall) else (w[of] for w in work)
            h, first, base = a1 - a0, ia[p] * wide + a0, ib[p] * (none + 1)
            window = ((np.uint64(1) << (b1 - b0).astype(np.uint64)) - np.uint64(1) << b0.astype(np.uint64)).astype(word)
            rows = np.empty((h.max(), len(p)), word)
            least = h.min()
            for i in range(len(rows)):
                if i < least:
                    rows[i] = places[base + code[first + i]] & window
                else:
                    rows[i] = np.where(i < h, places[base + code[np.minimum(first + i, len(code) - 1)]] & window, word(0))
            k, i, j = _longest(rows)
            i = i + a0
            np.add.at(total, p, k)
            for piece in ((p, a0, i, b0, j), (p, i + k, a1, j + k, b1)):
                more = (k > 0) & (piece[1] < piece[2]) & (piece[3] < piece[4])
                pieces.append([x[more] for x in piece])
        work = [np.concatenate(x) for x in zip(*pieces)] if pieces else [np.zeros(0, np.int64)] * 5
    return total


def ratios(a: list[str], b: list[str], ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """SequenceMatcher(None, a[i], b[j]).ratio() of each pair of indexes; equal pairs are computed once."""
    if not len(ia):
        return np.zeros(0)
    pair, back = np.unique(np.asarray(ia, np.int64) * len(b) + ib, return_inverse=True)
    i, j = pair // len(b), pair % len(b)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    length, out = (la[i] + lb[j]), np.ones(len(pair))
    short = (la[i] <= WORD) & (lb[j] <= WORD) & (length > 0)
    out[short] = 2.0 * _matches(a, b, i[short], j[short]) / length[short]
    for n in np.flatnonzero(~short & (length > 0)):
        out[n] = SequenceMatcher(None, a[i[n]], b[j[n]]).ratio()
    return out[back]
