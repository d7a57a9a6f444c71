"""Singular values and right singular vectors of a small square matrix.

Householder reflections make the matrix bidiagonal; the dqds recurrence finds
all singular values to high relative accuracy; twisted factorisations of the
squared, shifted matrix give the vectors that are asked for. All of it works on
one matrix of the vectors' dimension and knows nothing of the rows behind it.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
# Values closer than this share of their size are solved for together.
CLUSTER = 1e-3


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, beta) such that x - beta v (v.x) has zeros from the second entry on."""
    v = x.copy()
    size = float(np.linalg.norm(x))
    if size == 0 or len(x) == 1:
        return v, 0.0
    v[0] += size if x[0] >= 0 else -size
    return v, 2.0 / float(v @ v)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """(diagonal, superdiagonal, right reflectors) of a square matrix."""
    a = np.array(matrix, float)
    d = len(a)
    rights = []
    for k in range(d):
        v, beta = reflector(a[k:, k])
        if beta:
            a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            w, beta = reflector(a[k, k + 1:])
            if beta:
                a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ w, w)
            rights.append((k + 1, w, beta))
    return a.diagonal().copy(), a.diagonal(1).copy(), rights


def safe_shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest eigenvalue: one over the inverse's trace,
    whose diagonal is one over the pivots of an unshifted step."""
    d = q[0]
    if d <= 0:
        return 0.0
    total = 1.0 / d
    for k in range(len(e)):
        d = d * (q[k + 1] / (d + e[k]))
        if d <= 0:
            return 0.0
        total += 1.0 / d
    return (1.0 - 8 * len(q) * EPS) / total


def dqds_step(q: list[float], e: list[float], shift: float):
    """One shifted step, or None if the shift was above the smallest eigenvalue."""
    new_q, new_e = [], []
    d = q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        pivot = d + e[k]
        ratio = q[k + 1] / pivot if pivot else 0.0
        new_q.append(pivot)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """All singular values of an upper bidiagonal matrix, falling."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if not scale:
        return np.zeros(len(diagonal))
    found: list[float] = []
    blocks = [(((diagonal / scale) ** 2).tolist(), ((above / scale) ** 2).tolist(), 0.0)]
    while blocks:
        q, e, base = blocks.pop()
        while q:
            if not e or e[-1] <= 100 * EPS * EPS * (base + q[-1]):
                found.append(base + q.pop())
                if e:
                    e.pop()
                continue
            # A link that counts for nothing splits the block in two.
            cut = next((k for k in range(len(e) - 2, -1, -1)
                        if e[k] <= 100 * EPS * EPS * (base + min(q[k], q[k + 1]))), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], base))
                q, e = q[cut + 1:], e[cut + 1:]
            if q[0] * 1.5 < q[-1]:                  # small values belong to the end
                q.reverse()
                e.reverse()
            shift = safe_shift(q, e)
            step = dqds_step(q, e, shift)
            while step is None:
                shift = shift / 2 if shift > EPS * EPS * max(q) else 0.0
                step = dqds_step(q, e, shift)
            q, e = step
            base += shift
    return scale * np.sqrt(np.sort(np.array(found))[::-1])


class Twisted:
    """T - value = N D N', twisted at every row, for T = B'B of a bidiagonal B."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n = len(diagonal)
        tiny = EPS * EPS * max(float(np.square(diagonal).max()), value)
        pivot = np.where(np.square(diagonal) < tiny, tiny, np.square(diagonal)).tolist()
        link = [x / np.copysign(np.sqrt(p), a) for x, p, a in
                zip(above.tolist(), pivot[:-1], diagonal[:-1].tolist(), strict=True)]
        down, down_link, s = [0.0] * n, [0.0] * max(n - 1, 0), [-value] * n
        for i in range(n - 1):                      # from the top, stationary
            down[i] = s[i] + pivot[i] or tiny
            down_link[i] = pivot[i] * link[i] / down[i]
            s[i + 1] = down_link[i] * link[i] * s[i] - value
        down[n - 1] = s[n - 1] + pivot[n - 1] or tiny
        up, up_link, p = [0.0] * n, [0.0] * max(n - 1, 0), [pivot[-1] - value] * n
        for i in range(n - 2, -1, -1):              # from the bottom, progressive
            up[i + 1] = pivot[i] * link[i] * link[i] + p[i + 1] or tiny
            t = pivot[i] / up[i + 1]
            up_link[i] = link[i] * t
            p[i] = p[i + 1] * t - value
        self.down, self.down_link, self.up, self.up_link = down, down_link, up, up_link
        self.gamma = [a + b + value for a, b in zip(s, p, strict=True)]
        self.at = int(np.argmin(np.abs(self.gamma)))
        self.tiny = tiny

    def _out(self, z: list[float], add: list[float]) -> np.ndarray:
        r = self.at
        for i in range(r - 1, -1, -1):
            z[i] = add[i] - self.down_link[i] * z[i + 1]
        for i in range(r, len(z) - 1):
            z[i + 1] = add[i + 1] - self.up_link[i] * z[i]
        z = np.array(z)
        return z / np.linalg.norm(z)

    def vector(self) -> np.ndarray:
        """The unit vector that the smallest twist solves for."""
        n = len(self.down)
        z = [0.0] * n
        z[self.at] = 1.0
        return self._out(z, [0.0] * n)

    def solve(self, v: np.ndarray) -> np.ndarray:
        """Direction of (T - value)^-1 v: a step of inverse iteration."""
        r, u = self.at, v.tolist()
        n = len(u)
        for i in range(1, r):
            u[i] -= self.down_link[i - 1] * u[i - 1]
        for i in range(n - 2, r, -1):
            u[i] -= self.up_link[i] * u[i + 1]
        if r > 0:
            u[r] -= self.down_link[r - 1] * u[r - 1]
        if r < n - 1:
            u[r] -= self.up_link[r] * u[r + 1]
        w = [u[i] / self.down[i] for i in range(r)] + [u[r] / (self.gamma[r] or self.tiny)]
        w += [u[i] / self.up[i] for i in range(r + 1, n)]
        top = max(map(abs, w)) or 1.0
        w = [x / top for x in w]
        return self._out(w, w.copy())


def squared(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> np.ndarray:
    """B'B z."""
    y = diagonal * z
    y[:-1] += above * z[1:]
    out = diagonal * y
    out[1:] += above * y[:-1]
    return out


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal right singular vectors (columns) of the falling ``values``."""
    out: list[np.ndarray] = []
    top = float(np.square(diagonal).max() + np.square(above).max(initial=0))
    noise = np.random.default_rng(5)
    start = 0
    for k, value in enumerate(values.tolist()):
        square = value * value
        if k and values[k - 1] ** 2 - square > CLUSTER * square:
            start = k                               # a new cluster
        alone = (k == start and (k + 1 == len(values)
                                 or square - values[k + 1] ** 2 > CLUSTER * square))
        twisted = Twisted(diagonal, above, square)
        z = twisted.vector()
        if not alone:
            near = np.array(out[start:k]).reshape(k - start, len(diagonal))
            if k > start:
                z = noise.standard_normal(len(diagonal))
            best, least = z, np.inf
            for _ in range(10):
                for _ in range(2):
                    z = z - near.T @ (near @ z)
                    z /= np.linalg.norm(z)
                rest = float(np.linalg.norm(squared(diagonal, above, z) - square * z))
                if rest < least:
                    best, least = z, rest
                if rest <= 4 * EPS * top:
                    break
                z = twisted.solve(z)
            # A matrix in parts that share a value can hold the steps in one
            # part: values a rounding away twist it elsewhere.
            for step in range(1, 9):
                if least <= 64 * EPS * top:
                    break
                moved = Twisted(diagonal, above, square * (1 + (-1) ** step * 2 * step * EPS))
                z = noise.standard_normal(len(diagonal))
                for _ in range(10):
                    for _ in range(2):
                        z = z - near.T @ (near @ z)
                        z /= np.linalg.norm(z)
                    rest = float(np.linalg.norm(squared(diagonal, above, z) - square * z))
                    if rest < least:
                        best, least = z, rest
                    if rest <= 4 * EPS * top:
                        break
                    z = moved.solve(z)
            z = best
        out.append(z)
    return np.array(out).T.reshape(len(diagonal), len(values))


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors as columns) of a square matrix:
    the ``most`` largest above rounding error."""
    diagonal, above, rights = bidiagonal(matrix)
    values = singular_values(diagonal, above)
    values = values[values > len(values) * EPS * values.max(initial=0)][:most]
    if not len(values):
        return values, np.zeros((len(diagonal), 0))
    z = right_vectors(diagonal, above, values)
    for at, w, beta in reversed(rights):
        if beta:
            z[at:] -= beta * np.outer(w, w @ z[at:])
    return values, z
