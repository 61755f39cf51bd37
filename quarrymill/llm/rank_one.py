"""Eigendecompositions kept up by rank-one updates: secular equations with deflation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EPS = np.finfo(float).eps
_MOST_STEPS = 60


def _deflated(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, tolerance: float) -> None:
    """Turn eigenvectors of equal values so that of each such group only the last has a part in the update. In place."""
    close = np.diff(values) <= tolerance
    if not close.any():
        return
    starts = np.flatnonzero(close & ~np.concatenate(([False], close[:-1])))
    ends = np.flatnonzero(close & ~np.concatenate((close[1:], [False]))) + 1
    for first, last in zip(starts.tolist(), ends.tolist()):
        own = z[first : last + 1]
        length = np.linalg.norm(own)
        if length == 0.0:
            continue
        mirror = own.copy()
        mirror[-1] += np.copysign(length, own[-1])
        mirror /= np.linalg.norm(mirror)
        part = vectors[:, first : last + 1]
        part -= 2.0 * np.outer(part @ mirror, mirror)
        z[first:last] = 0.0
        z[last] = -np.copysign(length, own[-1])


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(weights / (poles - x)), one right of each pole, as (pole they are counted from, distance).

    `poles` ascend strictly and `weights` are positive. The sums over poles up to the root and beyond it are each matched by a simple
    fraction, whose common root is the next guess; a guess outside what is known to hold the root is replaced by its middle.
    """
    k = len(poles)
    right = np.append(poles[1:], poles[-1] + weights.sum())
    gap = right - poles
    middle = 1.0 + (weights / (poles - (poles + gap / 2)[:, None])).sum(axis=1)
    left_half = middle >= 0.0
    left_half[-1] = True
    origin = np.where(left_half, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    apart = poles - poles[origin][:, None]
    low = np.where(left_half, 0.0, -gap / 2)
    high = np.where(left_half, gap / 2, 0.0)
    high[-1] = gap[-1]
    out = (low + high) / 2
    root, tau, below = np.arange(k), out.copy(), np.tri(k)
    near, far = np.diag(apart), np.append(np.diag(apart, 1), 0.0)
    with np.errstate(all="ignore"):
        for _ in range(_MOST_STEPS):
            delta = apart - tau[:, None]
            terms = weights / delta
            lower = np.einsum("ij,ij->i", terms, below)
            upper = terms.sum(axis=1) - lower
            value = 1.0 + lower + upper
            high = np.where(value > 0, np.minimum(high, tau), high)
            low = np.where(value < 0, np.maximum(low, tau), low)
            done = (np.abs(value) <= k * _EPS * (1.0 + np.abs(lower) + np.abs(upper))) | (high - low <= 2 * _EPS * np.abs(tau))
            out[root] = tau
            go = np.flatnonzero(~done)
            if not len(go):
                break
            if len(go) < len(root):
                root, tau, low, high, near, far = root[go], tau[go], low[go], high[go], near[go], far[go]
                apart, below, delta, terms = apart[go], below[go], delta[go], terms[go]
                lower, upper = lower[go], upper[go]
            # lower ~ c1 + s1 / (near - t), upper ~ c2 + s2 / (far - t), equal in value and slope here.
            slopes = terms / delta
            p1 = np.einsum("ij,ij->i", slopes, below)
            p2 = np.maximum(slopes.sum(axis=1) - p1, 0.0)
            d1, d2 = near - tau, far - tau
            s1, s2 = p1 * d1 * d1, p2 * d2 * d2
            c = 1.0 + (lower - p1 * d1) + (upper - p2 * d2)
            # c + s1 / (d1 - x) + s2 / (d2 - x) = 0 for the step x; right of the last pole there is no second fraction.
            b = -(c * (d1 + d2) + s1 + s2)
            e = c * d1 * d2 + s1 * d2 + s2 * d1
            under = np.sqrt(np.maximum(b * b - 4 * c * e, 0.0))
            step = np.where(b <= 0, 2 * e / (-b + under), (-b - under) / (2 * c))
            step = np.where(root == k - 1, d1 + s1 / (1.0 + (lower - p1 * d1)), step)
            guess = tau + step
            tau = np.where((guess > low) & (guess < high), guess, (low + high) / 2)
    return origin, out


def updated(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors of `vectors diag(values) vectors' + rho v v'`, for `rho` >= 0."""
    z = vectors.T @ v
    weight = rho * float(z @ z)
    if not weight > 0.0:
        return values, vectors
    scale = max(float(values[-1]), weight)
    vectors = vectors.copy()
    _deflated(values, vectors, z, 8 * _EPS * scale)
    taking = rho * z * z > (_EPS * _EPS) * scale
    taking &= np.abs(z) * np.sqrt(weight * rho) > 4 * _EPS * scale
    own = np.flatnonzero(taking)
    if not len(own):
        return values, vectors
    poles, weights = values[own], rho * z[own] ** 2
    origin, tau = secular_roots(poles, weights)
    # Distances from every pole to every root, to full precision, as the roots are counted from poles.
    apart = (poles[origin] - poles[:, None]) + tau
    # Weights for which these roots are exact: the vectors then are orthogonal to rounding.
    ratio = apart / np.where(np.eye(len(own), dtype=bool), 1.0, poles - poles[:, None])
    exact = np.sqrt(np.abs(ratio.prod(axis=1))) * np.sign(z[own])
    turn = exact[:, None] / apart
    turn /= np.linalg.norm(turn, axis=0)
    values = values.copy()
    values[own] = poles[origin] + tau
    vectors[:, own] = vectors[:, own] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, mean, and the eigendecomposition of the scatter around the mean, of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimension: int) -> Spectrum:
        return cls(0, np.zeros(dimension), np.zeros(dimension), np.eye(dimension))

    def add(self, x: np.ndarray, times: int = 1) -> None:
        """Take in a vector that occurs `times` times: one centred rank-one update."""
        total = self.n + times
        from_mean = x - self.mean
        if self.n:
            self.values, self.vectors = updated(self.values, self.vectors, from_mean, self.n * times / total)
        self.mean = self.mean + from_mean * (times / total)
        self.n = total

    def merge(self, other: Spectrum) -> None:
        """Take in other vectors by their spectrum: a rank-one update for each of its directions and one for the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0.0:
                self.values, self.vectors = updated(self.values, self.vectors, vector, float(value))
        total = self.n + other.n
        between = other.mean - self.mean
        if self.n:
            self.values, self.vectors = updated(self.values, self.vectors, between, self.n * other.n / total)
        self.mean = self.mean + between * (other.n / total)
        self.n = total
