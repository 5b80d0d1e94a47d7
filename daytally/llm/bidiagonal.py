"""Singular values and right singular vectors of a square matrix that fits into memory.

Householder reflections make the matrix bidiagonal. The dqds transform finds the squared singular values from the
squares of the bidiagonal's entries, without subtractions but that of the shift, and so to high relative accuracy. A
twisted factorisation of the shifted product gives the vector of each; where squared values lie close together, the
vectors are found by inverse iteration and made orthogonal to each other.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = float(np.finfo(float).eps)
_NEGLIGIBLE = (16 * _EPS) ** 2
#: Squared singular values closer than this, relative to the larger, are a cluster.
_CLOSE = 1e-3
_TINY = 1e-300


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta, such that (I - beta v v') x has only its first entry."""
    v = x.astype(float).copy()
    norm = float(np.linalg.norm(v))
    if norm == 0:
        return v, 0.0
    v[0] += math.copysign(norm, v[0])
    return v, 2.0 / float(v @ v)


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, entries above it, and the orthogonal matrix Q on the right: matrix = P (bidiagonal) Q'."""
    a = np.array(matrix, float)
    size = a.shape[0]
    right = np.eye(size)
    for k in range(size):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k + 2 < size:
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= beta * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds step and the least of its d; None if the shift is above the smallest value."""
    new_q, new_e = q[:], e[:]
    d = q[0] - shift
    least = d
    for i, off in enumerate(e):
        if d < 0:
            return None
        new_q[i] = d + off
        ratio = q[i + 1] / new_q[i]
        new_e[i] = off * ratio
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, least


def dqds(diagonal, above) -> np.ndarray:
    """The squared singular values of a bidiagonal matrix, in falling order."""
    parts = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0, 0.0)]
    out, steps = [], 0
    while parts:
        q, e, done, least = parts.pop()
        cut = next((i for i, off in enumerate(e) if off <= _NEGLIGIBLE * (done + min(q[i], q[i + 1])) or off < _TINY), None)
        if cut is not None:
            parts += [(q[: cut + 1], e[:cut], done, 0.0), (q[cut + 1 :], e[cut + 1 :], done, 0.0)]
        elif len(q) == 1:
            out.append(q[0] + done)
        elif len(q) == 2:
            middle, off = (q[0] + q[1] + e[0]) / 2, math.sqrt(max(0.0, ((q[0] - q[1] + e[0]) / 2) ** 2 + q[1] * e[0]))
            high = middle + off
            out += [high + done, q[0] * (q[1] / high) + done]
        else:
            steps += 1
            if steps > 200 * len(diagonal) + 1000:
                raise ArithmeticError("dqds does not converge")
            # The least d of the step before is not below the smallest value, and close to it in the end.
            shift = 0.98 * least
            while (moved := _transform(q, e, shift)) is None:
                shift = shift / 4 if shift > _EPS * max(q) else 0.0
            parts.append((moved[0], moved[1], done + shift, moved[2]))
    return np.sort(np.array(out))[::-1]


def _guarded(x: float, scale: float) -> float:
    least = max(_TINY, _EPS * _EPS * scale)
    return x if abs(x) >= least else math.copysign(least, x)


def _twisted(d: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """The vector of `value` for L diag(d) L', where `low` stands below L's unit diagonal."""
    size, scale = len(d), float(d.max())
    down, up = np.zeros(size), np.zeros(size)
    left, right = np.zeros(size), np.zeros(size)
    down[0] = -value
    for i in range(size - 1):
        pivot = _guarded(down[i] + d[i], scale)
        left[i] = d[i] * low[i] / pivot
        down[i + 1] = left[i] * low[i] * down[i] - value
    up[-1] = d[-1] - value
    for i in range(size - 2, -1, -1):
        ratio = d[i] / _guarded(d[i] * low[i] ** 2 + up[i + 1], scale)
        right[i] = low[i] * ratio
        up[i] = up[i + 1] * ratio - value
    at = int(np.argmin(np.abs(down + up + value)))
    z = np.zeros(size)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -left[i] * z[i + 1]
    for i in range(at, size - 1):
        z[i + 1] = -right[i] * z[i]
    return z / np.linalg.norm(z)


def _apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            z = z - (other @ z) * other
    return z


def _inverse_iteration(diagonal, off, value: float, others: list[np.ndarray]) -> np.ndarray:
    """A vector of `value`, of the tridiagonal matrix, orthogonal to `others`."""
    size = len(diagonal)
    shifted = np.diag(diagonal - value) + np.diag(off, 1) + np.diag(off, -1)
    shifted += np.eye(size) * _EPS * max(abs(value), float(np.abs(diagonal).max()) * _EPS)
    z = _apart(np.cos(np.arange(size) * (1.0 + len(others))), others)
    for _ in range(6):
        z /= np.linalg.norm(z)
        try:
            z = np.linalg.solve(shifted, z)
        except np.linalg.LinAlgError:
            shifted += np.eye(size) * 4 * _EPS * max(abs(value), _TINY)
        z = _apart(z / np.linalg.norm(z), others)
    return z / np.linalg.norm(z)


def _of_block(a: np.ndarray, b: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """Squared values and vectors of a bidiagonal block."""
    values = dqds(a, b)
    scale = float(np.abs(a).max(initial=0.0))
    if len(a) == 1 or scale == 0:
        return list(zip(values, np.eye(len(a)), strict=True))
    held = np.where(np.abs(a) < _EPS * scale, _EPS * scale, a)
    d, low = held**2, b / held[:-1]
    diagonal, off = a**2 + np.append(0.0, b**2), a[:-1] * b
    out, cluster, before = [], [], math.inf
    for i, value in enumerate(values):
        cluster = cluster if before - value <= _CLOSE * before else []
        alone = not cluster and (i + 1 == len(values) or value - values[i + 1] > _CLOSE * value)
        z = _twisted(d, low, float(value)) if alone else _inverse_iteration(diagonal, off, float(value), cluster)
        cluster.append(z)
        out.append((float(value), z))
        before = value
    return out


def singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values in falling order, and the right singular vectors as rows."""
    size = matrix.shape[0]
    scale = float(np.abs(matrix).max(initial=0.0))
    if size == 0 or scale == 0:
        return np.zeros(size), np.eye(size)
    a, b, right = bidiagonalised(matrix / scale)
    sizes = np.abs(a)
    ends = [*(np.flatnonzero(np.abs(b) <= _EPS * (sizes[:-1] + sizes[1:])) + 1).tolist(), size]
    found, start = [], 0
    for end in ends:
        for value, z in _of_block(a[start:end], b[start : end - 1]):
            found.append((value, right[:, start:end] @ z))
        start = end
    found.sort(key=lambda pair: -pair[0])
    return np.array([v for v, _ in found]) * scale**2, np.stack([z for _, z in found])
