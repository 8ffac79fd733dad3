"""Leading eigenvectors of a symmetric matrix by contour integration.

The spectrum is cut into intervals by inertia counts: the number of eigenvalues below a shift is
the number of negative pivots of the shifted matrix, whatever vectors are known.  For each interval
the spectral projector is integrated over a circle around it: Gauss points on the upper half, at
each a solve of the matrix with a complex shift.  Applied to a block of vectors it leaves the
eigenvectors inside; Rayleigh-Ritz extracts them, and the block is filtered again until the
residuals are at rounding level and as many lie inside as the inertia counts say.

A border is put only where a margin around it holds no eigenvalue, so a cluster or a tie is never
cut; an interval that cannot be cut is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Eigenvalues an interval may hold before it is cut again; Gauss points on the half circle.
IN_INTERVAL, POINTS = 8, 8
# An interval whose ends differ by a larger factor is cut as well: one circle does not see values of all sizes.
STRETCH = 8
# Free margin on both sides of a border, as a part of the interval's end and of the largest eigenvalue.
MARGIN, LEAST_MARGIN = 1e-7, 1e-13
# Residuals at which a block is done, as a part of the largest eigenvalue.
DONE = 1e-14
ROUNDS = 40
_GROWTH = (1 + 17**0.5) / 8
_PLACES = (0.5, 0.42, 0.58, 0.34, 0.66, 0.27, 0.73, 0.2, 0.8, 0.13, 0.87)


def count_below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues below ``shift``: negative pivots of a factorisation with blocks of one and two."""
    rest = matrix - shift * np.eye(len(matrix))
    found = 0
    while len(rest):
        diagonal = np.abs(np.diagonal(rest))
        one = int(np.argmax(diagonal))
        beside = np.abs(rest)
        np.fill_diagonal(beside, 0)
        i, j = np.unravel_index(int(np.argmax(beside)), rest.shape)
        if diagonal[one] == 0 and beside[i, j] == 0:
            break
        block = [one] if diagonal[one] >= _GROWTH * beside[i, j] else [int(i), int(j)]
        # A block of two has a negative determinant: one pivot of either sign.
        found += 1 if len(block) == 2 else int(rest[one, one] < 0)
        others = np.setdiff1d(np.arange(len(rest)), block)
        side = rest[np.ix_(others, block)]
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(rest[np.ix_(block, block)], side.T)
        rest = (rest + rest.T) / 2
    return found


def _border(matrix: np.ndarray, low: float, high: float, most: float) -> tuple[float, int] | None:
    """A shift between the two with nothing near it, and the count below it."""
    margin = max(MARGIN * high, LEAST_MARGIN * most)
    for place in _PLACES:
        at = low * (high / low) ** place if high > 100 * low else low + place * (high - low)
        if at - margin > low and at + margin < high:
            n = count_below(matrix, at - margin)
            if n == count_below(matrix, at + margin):
                return at, n
    return None


def intervals(matrix: np.ndarray, wanted: int, least: float, most: float) -> Iterator[tuple[float, float, int]]:
    """(from, to, eigenvalues inside) from the top on, until ``wanted`` are in them; all above ``least``."""
    size = len(matrix)
    zeros = count_below(matrix, least)
    # Away from the zeros: to a part of the least of the others.
    step = least
    while 16 * step < most and count_below(matrix, 16 * step) == zeros:
        step *= 16
    open_, taken = [(max(least, step / 4), most, zeros, size)], 0
    while open_ and taken < wanted:
        low, high, n_low, n_high = open_.pop()
        inside = n_high - n_low
        wide = inside > IN_INTERVAL or (inside and high > STRETCH * low)
        cut = _border(matrix, low, high, most) if wide else None
        if cut is not None:
            at, n = cut
            open_ += [(low, at, n_low, n), (at, high, n, n_high)]
        elif inside:
            taken += inside
            yield low, high, inside


def filtered(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's parts in the eigenspaces between ``low`` and ``high``, nearly."""
    middle, radius = (high + low) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(POINTS)
    one, out = np.eye(len(matrix)), np.zeros_like(block)
    for x, w in zip(points, weights, strict=True):
        turn = radius * np.exp(0.5j * np.pi * (1 - x))
        out += (w / 2) * (turn * np.linalg.solve((middle + turn) * one - matrix, block.astype(complex))).real
    return out


def ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, rising, and vectors of the matrix within the block's span."""
    basis = np.linalg.qr(block)[0]
    inner = basis.T @ matrix @ basis
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return values, basis @ turn


def inside(matrix: np.ndarray, low: float, high: float, wanted: int, scale: float) -> np.ndarray:
    """The ``wanted`` eigenvectors between ``low`` and ``high``."""
    size = len(matrix)
    block = np.random.default_rng(5).standard_normal((size, min(size, wanted + max(4, wanted // 2))))
    for _ in range(ROUNDS):
        values, vectors = ritz(matrix, filtered(matrix, block, low, high))
        residuals = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        # What the filter left of other eigenvectors may mix to a value inside, but not to a small residual.
        done = (values > low) & (values < high) & (residuals <= DONE * scale * size)
        if done.sum() == wanted:
            return vectors[:, done]
        block = vectors
    raise ArithmeticError(f"{wanted} eigenvalues between {low} and {high}, but {done.sum()} found")


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors as rows.

    The matrix is positive semidefinite; eigenvalues that are zero within rounding are left out, so
    fewer may come back.  Of tied ones at the end any are taken.
    """
    size = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not size or not bound:
        return np.zeros(0), np.zeros((0, size))
    found = [
        inside(matrix, low, high, n, bound)
        for low, high, n in intervals(matrix, wanted, 4 * size * np.finfo(float).eps * bound, bound * (1 + 1e-6))
    ]
    if not found:
        return np.zeros(0), np.zeros((0, size))
    values, vectors = ritz(matrix, np.hstack(found))
    return values[::-1][:wanted], vectors.T[::-1][:wanted]
