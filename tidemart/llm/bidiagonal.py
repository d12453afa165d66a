"""Singular values and right singular vectors of one small matrix, by way of its bidiagonal form.

Householder reflections make the matrix bidiagonal, differential quotient-difference steps with shifts
find its singular values to high relative accuracy, and twisted factorisations their vectors.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Singular values closer than this, relative to the larger, share a cluster; their vectors are made orthogonal.
CLUSTER = 1e-3
#: Corrections of a vector, at most; one or two do.
ROUNDS = 6


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector v whose reflection I - 2 v v' turns x into a multiple of the first axis."""
    v = x.copy()
    v[0] += np.copysign(np.linalg.norm(x), x[0])
    size = np.linalg.norm(v)
    return v / size if size > 0 else None


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of a square matrix A = U B V'."""
    a, d = np.array(matrix, np.float64), len(matrix)
    right = np.eye(d)
    for k in range(d):
        if (v := _reflector(a[k:, k])) is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k + 2 < d and (v := _reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ v, 2 * v)
            right[:, k + 1:] -= np.outer(right[:, k + 1:] @ v, 2 * v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, descending.

    Each step transforms q (squared diagonal) and e (squared superdiagonal) so that the shift is taken off all
    eigenvalues; a shift too large shows by a negative d and is halved, down to none, with which a step
    never fails.  Entries that no longer matter at the end split off a value or a block.
    """
    found: list[float] = []
    blocks = [(list(np.square(diagonal)), list(np.square(upper)), 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        shift = 0.0
        while q:
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            tiny = EPS * EPS
            if e[-1] <= tiny * (sigma + q[-1]) or e[-1] <= tiny * q[-1]:
                found.append(sigma + q.pop())
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= tiny * (sigma + q[i + 1])), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1] and sum(q[:len(q) // 2]) < sum(q[len(q) // 2:]) / 4:  # small values converge at the end
                q.reverse()
                e.reverse()
                # a reversed bidiagonal is lower; one step without shift makes it upper again
                q, e = _lower_to_upper(q, e)
            # the smallest eigenvalue of the last two rows, somewhat reduced, is the shift to try
            a, b, c = q[-2] + e[-2] if len(e) > 1 else q[-2], e[-1], q[-1]
            trace, det = a + b + c, a * c
            small = 2 * det / (trace + np.sqrt(max(trace * trace - 4 * det, 0.0))) if trace > 0 else 0.0
            shift = small * (1 - 1e-3)
            while True:
                made = _step(q, e, shift)
                if made is not None:
                    break
                shift = shift / 4 if shift > 1e-3 * small else 0.0
            q, e = made
            sigma += shift
    return np.array(sorted(found, reverse=True))


def _lower_to_upper(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The upper bidiagonal with the same singular values as the lower one of squared entries q and e."""
    out_q, out_e, d = [], [], q[0]
    for i in range(len(e)):
        total = d + e[i]
        out_q.append(total)
        out_e.append(q[i + 1] * (e[i] / total) if total else 0.0)
        d = q[i + 1] * (d / total) if total else q[i + 1]
    return [*out_q, d], out_e


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    d, out_q, out_e = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        total = d + e[i]
        ratio = q[i + 1] / total if total else 0.0
        out_q.append(total)
        out_e.append(e[i] * ratio)
        d = d * ratio - shift if total else q[i + 1] - shift
    return ([*out_q, d], out_e) if d >= 0 else None


def _twisted(diagonal: np.ndarray, upper: np.ndarray, lam: float) -> tuple[np.ndarray, float, float]:
    """A vector z with (T - lam) z = gamma at one place and 0 elsewhere; gamma; and the square of |z|.

    T = B'B is L D L' with D the squared diagonal.  T - lam is factored from the top by the stationary and
    from the bottom by the progressive transformation, and twisted where gamma is smallest.
    """
    q, e = np.square(diagonal), np.square(upper)
    n, guard = len(q), EPS * EPS * max(q.max(), e.max() if len(e) else 0.0) + np.finfo(np.float64).tiny
    safe = lambda x: x if abs(x) > guard else np.copysign(guard, x if x else 1.0)
    off = diagonal[:-1] * upper
    down, s = np.empty(n), np.empty(n)  # pivots from the top
    s[0] = -lam
    for i in range(n - 1):
        down[i] = safe(s[i] + q[i])
        s[i + 1] = e[i] * (s[i] / down[i]) - lam
    down[-1] = s[-1] + q[-1]
    up, p = np.empty(n), np.empty(n)  # pivots from the bottom
    p[-1] = q[-1] - lam
    for i in range(n - 2, -1, -1):
        up[i + 1] = safe(e[i] + p[i + 1])
        p[i] = p[i + 1] * (q[i] / up[i + 1]) - lam
    gamma = s + p + lam
    at = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -off[i] / down[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -off[i] / up[i + 1] * z[i]
    return z, float(gamma[at]), float(z @ z)


def vectors(diagonal: np.ndarray, upper: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Orthonormal right singular vectors of an upper bidiagonal matrix, as columns, for the largest `squares`.

    The matrix falls apart where the superdiagonal does not matter.  Within a part each value has its
    vector from a twisted factorisation, corrected by its Rayleigh quotient; vectors of values in one
    cluster are made orthogonal to each other and corrected by inverse iteration.
    """
    d, scale = len(diagonal), max(np.abs(diagonal).max(), np.abs(upper).max() if len(upper) else 0.0)
    cuts = [0, *(i + 1 for i in range(d - 1) if abs(upper[i]) <= EPS * scale), d]
    part_of = []
    for lo, hi in zip(cuts, cuts[1:]):
        part_of += [(lam, lo, hi) for lam in dqds(diagonal[lo:hi], upper[lo:hi - 1])]
    part_of.sort(reverse=True)
    out, random = np.zeros((d, len(squares))), np.random.default_rng(0)
    for j, (lam, lo, hi) in enumerate(part_of[:len(squares)]):
        own = diagonal[lo:hi], upper[lo:hi - 1]
        near = [i for i in range(j) if part_of[i][1] == lo and part_of[i][0] - lam <= CLUSTER * max(part_of[i][0], 0.0)]
        z, gamma, size = _twisted(*own, lam)
        for _ in range(ROUNDS):
            if abs(gamma) / np.sqrt(size) <= EPS * lam or near:
                break
            lam += gamma / size
            z, gamma, size = _twisted(*own, lam)
        z /= np.sqrt(size)
        if near:
            others = out[lo:hi, near]
            for round_ in range(ROUNDS):
                for _ in range(2):
                    z = z - others @ (others.T @ z)
                rest = np.linalg.norm(z)
                z = z / rest if rest > 1e-8 else random.standard_normal(hi - lo)
                if rest > 0.9 or round_ == ROUNDS - 1:
                    break
                z = _solve(*own, lam * (1 + 4 * EPS), z - others @ (others.T @ z))
                z /= np.linalg.norm(z)
        out[lo:hi, j] = z
    return out


def _solve(diagonal: np.ndarray, upper: np.ndarray, lam: float, b: np.ndarray) -> np.ndarray:
    """(B'B - lam)^-1 b for one step of inverse iteration."""
    bidiagonal = np.diag(diagonal) + np.diag(upper, 1)
    shifted = bidiagonal.T @ bidiagonal - lam * np.eye(len(b))
    try:
        return np.linalg.solve(shifted, b)
    except np.linalg.LinAlgError:
        return np.linalg.solve(shifted + np.eye(len(b)) * EPS * lam, b)


def right_vectors(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest `most` squared singular values of a square matrix and their unit right vectors, as columns.

    Values that are zero up to rounding have no vector here.  Each vector's largest entry is positive.
    """
    diagonal, upper, right = bidiagonalise(matrix)
    squares = dqds(diagonal, upper)
    zero = np.square(4 * len(matrix) * EPS) * np.square(matrix).sum()
    squares = squares[squares > zero][:most]
    found = right @ vectors(diagonal, upper, squares)
    found *= np.where(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])] < 0, -1.0, 1.0)
    return squares, found
