"""Eigendecompositions kept up to date under rank-one changes.

``rank_one`` turns the decomposition of a symmetric matrix ``A`` into that of
``A + rho * d d'``: in the eigenbasis this is a diagonal matrix plus a
rank-one one, whose eigenvalues are the roots of the secular equation
``1 + sum_j rho z_j^2 / (d_j - x) = 0``, one between each pair of old values.
Old eigenvectors that ``d`` does not touch, or that share a value, are
deflated: they stay (after one reflection) and take no part in the equation.
Roots are found as offsets from their nearer pole, by two-pole interpolation
inside a bracket; eigenvectors come from the vector ``z`` that has exactly the
found roots, so they stay orthogonal however close roots are.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

EPS = np.finfo(np.float64).eps


def _secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum z2 / (d - x)`` for rising, distinct ``d``: the roots, and ``d_j - root_i`` (row i) without cancellation."""
    m = len(d)
    upper = d[-1] + z2.sum()
    gap = np.append(d[1:], upper) - d
    middle = 1 + (z2 / (d - (d + gap / 2)[:, None])).sum(1)
    right = middle < 0  # the root lies in the right half of its gap
    right[-1] = False
    origin = np.arange(m) + right
    delta = d - d[origin][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    if middle[-1] < 0:
        low[-1], high[-1] = gap[-1] / 2, gap[-1]
    left_of = np.tri(m)
    own = delta[np.arange(m), np.arange(m)]
    following = np.append(delta[np.arange(m - 1), np.arange(1, m)], 2 * gap[-1])
    mu = (low + high) / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(64):
            inverse = 1 / (delta - mu[:, None])
            f = 1 + inverse @ z2
            low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
            done = (np.abs(f) <= 4 * EPS * (1 + np.abs(inverse) @ z2)) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
            if done.all():
                break
            # a model with the two poles beside the root and the true slopes on either side
            inverse *= inverse
            both = inverse @ z2
            inverse *= left_of
            psi = inverse @ z2
            a1, a2 = own - mu, following - mu
            c = f - a1 * psi - a2 * (both - psi)
            a = (a1 + a2) * f - a1 * a2 * both
            b = a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            guess = mu + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            inside = (guess > low) & (guess < high)
            mu = np.where(done, mu, np.where(inside, guess, (low + high) / 2))
    return d[origin] + mu, delta - mu[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, d: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors (columns) of ``vectors diag(values) vectors' + rho d d'`` for ``rho >= 0``."""
    z = vectors.T @ d
    length = np.sqrt(z @ z)
    if rho * length == 0:
        return values, vectors
    tolerance = 8 * EPS * max(abs(values[-1]), abs(values[0]), rho * length * length)
    close = np.flatnonzero(np.diff(values) <= tolerance)
    if len(close):
        vectors = vectors.copy()
        start = -1
        for k in close:
            if k < start:
                continue
            stop = k + 2
            while stop < len(values) and values[stop] - values[k] <= tolerance:
                stop += 1
            start = stop - 1
            own = z[k:stop]
            norm = np.sqrt(own @ own)
            if norm == 0:
                continue
            # one reflection leaves only the last of the equal values touched
            mirror = own.copy()
            mirror[-1] += np.copysign(norm, own[-1])
            mirror /= np.sqrt(mirror @ mirror)
            last = -np.copysign(norm, own[-1])
            vectors[:, k:stop] -= 2 * np.outer(vectors[:, k:stop] @ mirror, mirror)
            z[k:stop] = 0
            z[stop - 1] = last
    touched = rho * length * np.abs(z) > tolerance
    if not touched.any():
        return values, vectors
    old, part = values[touched], z[touched]
    m = len(old)
    roots, distance = _secular_roots(old, rho * part * part)
    # the z whose secular equation has exactly these roots
    i, j = np.indices((m, m), sparse=True)
    poles = np.where(i < j, old[:, None], np.append(old[1:], 0.0)[:, None]) - old
    poles[-1] = 1.0
    exact = np.sqrt(np.abs(np.prod(-distance / poles, axis=0))) * np.sign(part)
    turn = exact / distance
    turn /= np.sqrt((turn * turn).sum(1))[:, None]
    values, vectors = values.copy(), vectors.copy()
    values[touched] = roots
    vectors[:, touched] = vectors[:, touched] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass(frozen=True)
class Spectrum:
    """Count, mean, and the decomposition of the centred scatter of some rows."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(width: int) -> "Spectrum":
        return Spectrum(0, np.zeros(width), np.zeros(width), np.eye(width))

    def with_rows(self, rows: Iterable[np.ndarray]) -> "Spectrum":
        """After one centred rank-one update for each row."""
        n, mean, values, vectors = self.n, self.mean, self.values, self.vectors
        for row in rows:
            off = row - mean
            values, vectors = rank_one(values, vectors, off, n / (n + 1))
            mean = mean + off / (n + 1)
            n += 1
        return Spectrum(n, mean, values, vectors)

    def merged(self, other: "Spectrum") -> "Spectrum":
        """The spectrum of both sets of rows: one rank-one update for each eigenvector of ``other`` and one for the means."""
        if not self.n or not other.n:
            return self if self.n else other
        n, off = self.n + other.n, other.mean - self.mean
        values, vectors = self.values, self.vectors
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                values, vectors = rank_one(values, vectors, vector, value)
        values, vectors = rank_one(values, vectors, off, self.n / n * other.n)
        return Spectrum(n, self.mean + off * (other.n / n), values, vectors)
