"""Singular values and right singular vectors of a small square matrix, by dqds and twisted factorisations.

Helpers of operator 13; the matrix is the R factor of the centred rows, its side the number of dimensions.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_CLUSTER = 1e-8  # eigenvalues relatively closer than this share one invariant subspace


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of r = U B V', by Householder reflections from both sides."""
    b = np.array(r, dtype=float)
    n = len(b)
    v = np.eye(n)
    for k in range(n):
        _reflect(b[k:, k:])
        if k < n - 2:
            w = _reflect(b[k:, k + 1:].T)
            v[:, k + 1:] -= np.outer(v[:, k + 1:] @ w, 2 * w)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def _reflect(a: np.ndarray) -> np.ndarray:
    """Reflect the rows of ``a`` in place so that its first column keeps one entry; the unit vector reflected in."""
    w = a[:, 0].copy()
    size = np.linalg.norm(w)
    if size == 0 or len(w) == 1:
        return np.zeros(len(w))
    w[0] += np.copysign(size, w[0])
    w /= np.linalg.norm(w)
    a -= np.outer(2 * w, w @ a)
    return w


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, rising, of the bidiagonal matrix with diagonal ``a`` and superdiagonal ``b``.

    The differential qd transform with shifts keeps every value to high relative accuracy, as it only adds, multiplies
    and divides positive numbers; a shift that turns one negative is taken back and made smaller.
    """
    out: list[float] = []
    todo = [((np.asarray(a, float) ** 2).tolist(), (np.asarray(b, float) ** 2).tolist(), 0.0)]
    while todo:
        q, e, shift = todo.pop()
        least = 0.0
        while q:
            n = len(q)
            if n == 1:
                out.append(q[0] + shift)
                break
            tiny = _EPS ** 2 * (shift + max(q))
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= tiny or e[i] <= _EPS ** 2 * (q[i] + shift)), None)
            if cut == n - 2:
                out.append(q.pop() + shift)
                e.pop()
                continue
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], shift))
                q, e, least = q[cut + 1:], e[cut + 1:], 0.0
                continue
            step = 0.98 * least
            while True:
                moved = _transform(q, e, step)
                if moved is not None:
                    break
                step = step / 4 if step > 1e-3 * least else 0.0
            q, e, least = moved
            shift += step
    return np.sort(np.maximum(out, 0.0))


def _transform(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float], float] | None:
    """One qd step with shift ``s``, and the least intermediate value; None if the shift was too large."""
    d = q[0] - s
    least, qs, es = d, [], []
    for i, e_i in enumerate(e):
        if d < 0:
            return None
        q_i = d + e_i
        ratio = q[i + 1] / q_i
        qs.append(q_i)
        es.append(e_i * ratio)
        d = d * ratio - s
        least = min(least, d)
    if d < 0:
        return None
    return [*qs, d], es, least


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for its eigenvalue ``value``.

    The stationary transform factors B'B - value from the top, the progressive one from the bottom; they meet at the
    row where the twisted factorisation has its smallest pivot, and the vector follows from there by multiplications.
    """
    n = len(a)
    q, e, tiny = a * a, b * b, np.finfo(float).tiny ** 0.5
    safe = lambda x: x if abs(x) > tiny else np.copysign(tiny, x)
    down, s = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        down[i] = safe(s[i] + q[i])
        s[i + 1] = e[i] / down[i] * s[i] - value
    up, p = np.empty(n), np.empty(n)
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = safe(e[i] + p[i + 1])
        p[i] = p[i + 1] * (q[i] / up[i + 1]) - value
    pivot = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[pivot] = 1.0
    off = a[:-1] * b
    for i in range(pivot - 1, -1, -1):
        z[i] = -off[i] / down[i] * z[i + 1]
    for i in range(pivot, n - 1):
        z[i + 1] = -off[i] / up[i + 1] * z[i]
    return z / np.linalg.norm(z)


def _subspace(a: np.ndarray, b: np.ndarray, values: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of B'B for a cluster of equal values, by inverse iteration beside ``taken`` ones."""
    n = len(a)
    t = np.diag(a * a + np.concatenate([[0.0], b * b])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    y = np.random.default_rng(n).standard_normal((n, len(values)))
    shifted = t - (values.mean() + 4 * _EPS * np.abs(t).max()) * np.eye(n)
    for _ in range(4):
        y -= taken @ (taken.T @ y)
        y = np.linalg.qr(np.linalg.solve(shifted, np.linalg.qr(y)[0]))[0]
    weights, turn = np.linalg.eigh(y.T @ t @ y)
    return (y @ turn)[:, np.argsort(-weights)]


def right_vectors(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of ``r``, falling, and the unit right vectors of the first ``most`` that are not zero.

    A value counts as zero from 1e-12 of the largest down: below, it is the rounding of the centred rows.
    """
    a, b, v = bidiagonalise(r)
    values = dqds(a, b)[::-1]
    rank = int((values > 1e-12 * values[0]).sum()) if len(values) else 0
    z = np.empty((len(a), 0))
    while z.shape[1] < min(most, rank):
        first = z.shape[1]
        last = first + 1
        while last < rank and values[last - 1] - values[last] <= _CLUSTER * values[last - 1]:
            last += 1
        if last == first + 1:
            z = np.column_stack([z, twisted_vector(a, b, values[first])])
        else:
            z = np.column_stack([z, _subspace(a, b, values[first:last], z)])
    if z.shape[1]:  # what close values leave of each other's directions goes
        fixed, upper = np.linalg.qr(z)
        z = fixed * np.sign(np.diag(upper))
    vectors = v @ z[:, :most]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[largest, range(vectors.shape[1])])
