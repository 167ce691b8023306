"""Singular values and right singular vectors of a small square matrix.

The matrix is made bidiagonal by Householder reflections. dqds, the quotient-difference
algorithm with shifts in its differential form, finds the squared singular values to
high relative accuracy. Each vector then comes from a twisted factorization of
``B'B - s``: one factorization from the top, one from the bottom, joined where the
twist is smallest.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Values closer than this to each other, relatively, are a cluster.
CLUSTER = 1e-3


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, upper diagonal, V) with ``matrix = U B V'`` for some orthogonal U."""
    work, n = np.array(matrix, float), len(matrix)
    v = np.eye(n)
    for k in range(n):
        reflector = _reflector(work[k:, k])
        work[k:, k:] -= np.outer(reflector, reflector @ work[k:, k:])
        if k + 2 <= n:
            reflector = _reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= np.outer(work[k:, k + 1 :] @ reflector, reflector)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ reflector, reflector)
    return np.diag(work).copy(), np.diag(work, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray:
    """w with ``(I - ww')x`` along the first axis; 0 where x is there already."""
    w = x.copy()
    if not np.any(x[1:]):
        return np.zeros_like(x)
    w /= np.abs(x).max()
    w[0] += np.copysign(np.linalg.norm(w), w[0])
    return w * (np.sqrt(2) / np.linalg.norm(w))


def squares_by_dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The squared singular values of a bidiagonal matrix, largest first."""
    scale = max([1e-300, *np.abs(diagonal).tolist(), *np.abs(upper).tolist()])
    todo = [([(x / scale) ** 2 for x in diagonal.tolist()], [(x / scale) ** 2 for x in upper.tolist()], 0.0)]
    found: list[float] = []
    while todo:
        q, e, shifted = todo.pop()
        while q:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (shifted + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                found.append(shifted + q[0])
                break
            if 1.5 * q[0] < q[-1]:  # reversed arrays have the same values; small ones go last
                q, e = q[::-1], e[::-1]
            q, e, shift = _step(q, e)
            shifted += shift
    return np.sort(np.array(found))[::-1] * scale * scale


def _step(q: list[float], e: list[float]) -> tuple[list[float], list[float], float]:
    """One transformation, with as large a shift as leaves all quotients nonnegative."""
    total, product = q[-2] + e[-1] + q[-1], q[-2] * q[-1]
    shift = 2 * product / (total + max(0.0, total * total - 4 * product) ** 0.5) if total else 0.0
    for attempt in range(5):
        shift = shift if attempt < 4 else 0.0
        new_q, new_e, d, failed = [], [], q[0] - shift, -1
        for i in range(len(e)):
            if d < 0:
                failed = i
                break
            head = d + e[i]
            ratio = q[i + 1] / head if head else 0.0
            new_q.append(head)
            new_e.append(e[i] * ratio)
            d = (d * ratio if head else q[i + 1]) - shift
        if failed < 0 and d >= 0:
            return [*new_q, d], new_e, shift
        # failing only at the end tells how far the shift was too large
        shift = max(0.0, (shift + d) * (1 - 4 * EPS)) if failed < 0 else shift / 4
    raise ArithmeticError("a transformation without a shift failed")


class Twisted:
    """The twisted factorization of ``B'B - value``."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, value: float, tiny: float):
        d, l, n = (diagonal**2).tolist(), (upper / diagonal[:-1]).tolist(), len(diagonal)  # noqa: E741
        self.down, self.up = [0.0] * n, [0.0] * n
        self.low, self.high = [0.0] * (n - 1), [0.0] * (n - 1)
        s, from_top = -value, []
        for i in range(n):
            from_top.append(s)
            self.down[i] = _away(s + d[i], tiny)
            if i + 1 < n:
                self.low[i] = d[i] * l[i] / self.down[i]
                s = self.low[i] * l[i] * s - value
        p = d[-1] - value
        from_bottom = [0.0] * n
        for i in range(n - 1, -1, -1):
            from_bottom[i] = p
            if i:
                self.up[i] = _away(d[i - 1] * l[i - 1] ** 2 + p, tiny)
                ratio = d[i - 1] / self.up[i]
                self.high[i - 1] = l[i - 1] * ratio
                p = p * ratio - value
        gammas = np.array(from_top) + np.array(from_bottom) + value
        self.at = int(np.argmin(np.abs(gammas)))
        self.gamma = float(gammas[self.at])
        self.tiny = tiny

    def spread(self, x: list[float]) -> np.ndarray:
        """Solves the transposed twisted factor, outwards from the twist."""
        z = list(x)
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.low[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.high[i] * z[i]
        return np.array(z)

    def vector(self) -> tuple[np.ndarray, float]:
        """The unit vector of the twist, and the correction of the value by its Rayleigh quotient."""
        unit = [0.0] * len(self.down)
        unit[self.at] = 1.0
        z = self.spread(unit)
        length = np.linalg.norm(z)
        return z / length, self.gamma / length**2

    def solve(self, b: np.ndarray) -> np.ndarray:
        """One step of inverse iteration."""
        y, r, n = b.tolist(), self.at, len(b)
        for i in range(1, r + 1):
            y[i] -= self.low[i - 1] * y[i - 1]
        for i in range(n - 2, r - 1, -1):
            y[i] -= self.high[i] * y[i + 1]
        pivots = [*self.down[:r], _away(self.gamma, self.tiny), *self.up[r + 1 :]]
        return self.spread([x / p for x, p in zip(y, pivots, strict=True)])


def _away(x: float, tiny: float) -> float:
    return x if abs(x) > tiny else (-tiny if x < 0 else tiny)


def leading_vectors(diagonal: np.ndarray, upper: np.ndarray, squares: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values, refined, and their right vectors as columns.

    Vectors of well separated values are orthogonal as they come. Those of a cluster are
    found by inverse iteration with the same factorization, each kept orthogonal to the
    others of its cluster.
    """
    largest = float(squares[0])
    a = np.maximum(np.abs(diagonal), EPS * EPS**0.5 * largest**0.5)
    b, tiny = np.abs(upper), EPS * EPS * largest
    signs = np.cumprod(np.concatenate([[1.0], np.where(np.sign(diagonal[:-1]) * np.sign(upper) < 0, -1.0, 1.0)]))
    values, vectors, first = [], [], 0
    while first < k:
        last = first + 1
        while last < len(squares) and squares[last - 1] - squares[last] <= CLUSTER * squares[last - 1]:
            last += 1
        found: list[np.ndarray] = []
        for j in range(first, last):
            value = float(squares[j])
            z, change = Twisted(a, b, value, tiny).vector()
            if last - first == 1 and abs(change) < CLUSTER * value / 4:
                value += change
                z, _ = Twisted(a, b, value, tiny).vector()
            elif last - first > 1:
                z = _among(Twisted(a, b, value, tiny), found, j)
            found.append(z)
            values.append(value)
        vectors += found
        first = last
    return np.array(values[:k]), signs[:, None] * np.array(vectors[:k]).T


def _among(factors: Twisted, others: list[np.ndarray], seed: int) -> np.ndarray:
    z = np.random.default_rng(seed).standard_normal(len(factors.down))
    for _ in range(4):
        z = factors.solve(z / np.linalg.norm(z))
        z /= np.linalg.norm(z)
        for _ in range(2):
            for other in others:
                z = z - (other @ z) * other
        z /= np.linalg.norm(z)
    return z


def singular(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest squared singular values (fewer where the rank is less), their right
    vectors as columns, and the sum of all squared singular values."""
    diagonal, upper, v = bidiagonal(matrix)
    total = float((diagonal**2).sum() + (upper**2).sum())
    if not total:
        return np.zeros(0), np.zeros((len(matrix), 0)), 0.0
    squares = squares_by_dqds(diagonal, upper)
    rank = int((squares > (EPS * len(matrix)) ** 2 * squares[0]).sum())
    values, z = leading_vectors(diagonal, upper, squares, min(k, rank))
    return values, v @ z, total
