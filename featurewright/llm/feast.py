"""Largest eigenpairs of a symmetric matrix by FEAST contour integration.

``inertia`` counts eigenvalues above a shift (Sylvester's law on a pivoted
LDL^T factorisation).  Bisection on these counts places interval ends in gaps of
the spectrum.  For each interval a Gauss-Legendre quadrature of complex shifted
solves along a circle through its ends projects a block of vectors onto the
interval's eigenvectors; Rayleigh-Ritz on that block gives the eigenpairs, and
the next round starts from them.  An interval is done when its Ritz values are as
many as the inertia counts say and their residuals no longer fall.

The matrix is of the order of the number of dimensions; nothing here grows with
the number of rows.
"""

from __future__ import annotations

import numpy as np

NODES, PER_INTERVAL, ROUNDS = 16, 4, 60
_ALPHA = (1 + 17 ** 0.5) / 8


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int]:
    """Numbers of eigenvalues above ``shift`` and equal to it, by Bunch-Parlett pivots of matrix - shift * I."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        r = int(np.argmax(diagonal))
        off = size.copy()
        np.fill_diagonal(off, 0)
        i, j = np.unravel_index(int(np.argmax(off)), off.shape)
        if diagonal[r] == 0 and off[i, j] == 0:
            return above, len(a)
        if diagonal[r] >= _ALPHA * off[i, j]:
            above += a[r, r] > 0
            pick = [r]
        else:  # a 2 x 2 pivot has one eigenvalue on each side
            above += 1
            pick = [i, j]
        rest = np.delete(np.arange(len(a)), pick)
        cross = a[np.ix_(rest, pick)]
        a = a[np.ix_(rest, rest)] - cross @ np.linalg.solve(a[np.ix_(pick, pick)], cross.T)
        a = (a + a.T) / 2
    return int(above), 0


def cut_below(matrix: np.ndarray, k: int, low: float, high: float) -> tuple[float, int]:
    """A shift in a gap of the spectrum with k eigenvalues above it, and their number.

    Where the k-th eigenvalue is not separable from its successors, the cut lies
    below all of them and the number is larger.  ``low`` and ``high`` have at least
    k and fewer than k eigenvalues above them.
    """
    tiny = 64 * np.finfo(float).eps * max(abs(low), abs(high))
    full, few = low, high  # more than k, fewer than k above
    middle = low if inertia(matrix, low)[0] == k else None  # just k above
    while few - full > tiny and middle is None:
        x = (full + few) / 2
        n = inertia(matrix, x)[0]
        if n == k:
            middle = x
        elif n > k:
            full = x
        else:
            few = x
    if middle is None:  # a cluster; walk down from it while no eigenvalue is passed
        n, step = inertia(matrix, full)[0], tiny
        while full - step > low and inertia(matrix, full - step)[0] == n:
            full, step = full - step, 2 * step
        return full, n
    bottom = top = middle  # widen to both ends of the gap, then take its middle
    for _ in range(12):
        x = (full + bottom) / 2
        if inertia(matrix, x)[0] == k:
            bottom = x
        else:
            full = x
        x = (few + top) / 2
        if inertia(matrix, x)[0] == k:
            top = x
        else:
            few = x
    return (bottom + top) / 2, k


def in_interval(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``low`` and ``high``; raises ArithmeticError if they are not all found."""
    d = len(matrix)
    x, w = np.polynomial.legendre.leggauss(NODES)
    around = np.exp(1j * np.pi / 2 * (x + 1)) * (high - low) / 2
    center, scale = (low + high) / 2, max(np.abs(matrix).sum(axis=1).max(), np.finfo(float).tiny)
    block = min(d, 2 * count + 4)
    while True:
        y = np.random.default_rng(seed).standard_normal((d, block))
        best, found, stale = np.inf, None, 0
        for _ in range(ROUNDS):
            q = sum(wj / 2 * (zj * np.linalg.solve((center + zj) * np.eye(d) - matrix, y.astype(complex))).real for wj, zj in zip(w, around))
            q, _ = np.linalg.qr(q)
            values, small = np.linalg.eigh(q.T @ matrix @ q)
            y = q @ small
            inside = (values > low) & (values < high)
            if inside.sum() == count:
                residual = np.linalg.norm(matrix @ y[:, inside] - y[:, inside] * values[inside], axis=0).max(initial=0) / scale
                stale = 0 if residual < best / 2 else stale + 1
                if residual < best:
                    best, found = residual, (values[inside], y[:, inside])
                if stale >= 2 and best < 1e-12:
                    return found
        if found is not None and best < 1e-12:
            return found
        if block == d:
            raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, not all were found")
        block = min(d, 2 * block)


def largest(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to k largest eigenvalues above rounding level, falling, and their unit eigenvectors as columns."""
    d = len(matrix)
    radius = np.abs(matrix).sum(axis=1).max(initial=0)
    if not radius:
        return np.zeros(0), np.zeros((d, 0))
    scaled, floor = matrix / radius, 16 * d * np.finfo(float).eps
    top = 1 + 1e-3  # no eigenvalue exceeds the largest row sum
    k = min(k, inertia(scaled, floor)[0])
    ends, counts = [top], [0]
    for n in range(min(PER_INTERVAL, k), k + PER_INTERVAL, PER_INTERVAL):
        if counts[-1] >= k:
            break
        wanted = max(min(n, k), counts[-1] + 1)
        cut, number = cut_below(scaled, wanted, floor, top)
        ends.append(cut)
        counts.append(number)
    parts = [in_interval(scaled, lo, hi, b - a) for hi, lo, a, b in zip(ends, ends[1:], counts, counts[1:])]
    if not parts:
        return np.zeros(0), np.zeros((d, 0))
    q, _ = np.linalg.qr(np.concatenate([v for _, v in parts], axis=1))  # one more Rayleigh-Ritz over all intervals
    values, small = np.linalg.eigh(q.T @ scaled @ q)
    order = np.argsort(-values)[:k]
    vectors = (q @ small)[:, order]
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1, 1)
    return values[order] * radius, vectors
