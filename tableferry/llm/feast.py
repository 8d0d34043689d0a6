"""Leading eigenpairs of a symmetric matrix by contour integration.

Inertia counts of shifted matrices place intervals that hold few eigenvalues each. For
an interval, complex shifted systems are solved at the nodes of a quadrature around it;
their sum is close to the projector onto its eigenvectors. A Rayleigh-Ritz step takes
the eigenpairs from the projected space, again and again until they no longer change,
and their number must be the one that inertia counts.
"""

from __future__ import annotations

import numpy as np

#: Nodes of the Gauss-Legendre rule on half the contour, and rounds until eigenpairs must have settled.
NODES, ROUNDS = 12, 60
#: Eigenvalues that are sought in one interval, unless they are too close to part.
TOGETHER = 8


def negative_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues are below 0, by Sylvester's law from a factorisation with pivots of one or two rows.

    Pivots are chosen among all that is left (Bunch and Parlett), so entries stay bounded.
    """
    a, count = np.array(matrix, np.float64), 0
    bound = (1 + np.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(np.argmax(diagonal))
        off = np.abs(np.triu(a, 1))
        most = off.max(initial=0.0)
        if not diagonal[p] and not most:
            break
        if diagonal[p] >= bound * most:
            chosen = [p]
            count += int(a[p, p] < 0)
        else:
            chosen = list(divmod(int(np.argmax(off)), len(a)))
            # A pair of rows with such pivots has one eigenvalue on either side.
            count += 1
        rest = [i for i in range(len(a)) if i not in chosen]
        pivot, column = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - column @ np.linalg.solve(pivot, column.T)
        a = (a + a.T) / 2
    return count


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``."""
    return negative_pivots(shift * np.eye(len(matrix)) - matrix)


def intervals(matrix: np.ndarray, wanted: int, together: int = TOGETHER) -> list[tuple[float, float, int]]:
    """Intervals from the top down, with the number of eigenvalues in each, until ``wanted`` are held.

    Intervals are parted until they hold few enough, only where inertia counts nothing in a
    small gap; one that has no such place, as around equal eigenvalues, stays whole.
    """
    high = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9) + np.finfo(float).tiny
    gap, todo, out = high * 1e-11, [(-high, high, 0, len(matrix))], []
    while todo and sum(n for *_, n in out) < wanted:
        a, b, over, upto = todo.pop()
        cut = None
        if upto - over > together and b - a > 8 * gap:
            places = (a + (b - a) * share for share in (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8))
            counts = ((x, above(matrix, x - gap), above(matrix, x + gap)) for x in places)
            cut = next(((x, n) for x, n, m in counts if n == m), None)
        if cut:
            todo += [(a, cut[0], cut[1], upto), (cut[0], b, over, cut[1])]
        elif upto > over:
            out.append((a, b, upto - over))
    return out


def _projected(matrix: np.ndarray, a: float, b: float, basis: np.ndarray, nodes: int) -> np.ndarray:
    """The sum over the upper half of a circle around ``[a, b]`` of the resolvents applied to ``basis``."""
    middle, radius = (a + b) / 2, (b - a) / 2
    place, weight = np.polynomial.legendre.leggauss(nodes)
    out = np.zeros_like(basis)
    for x, w in zip(place, weight):
        turn = np.exp(1j * np.pi * (1 - x) / 2)
        solved = np.linalg.solve((middle + radius * turn) * np.eye(len(matrix)) - matrix, basis.astype(complex))
        out += w / 2 * np.real(radius * turn * solved)
    return out


def in_interval(
    matrix: np.ndarray, a: float, b: float, count: int, nodes: int = NODES, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in ``[a, b]``, greatest first, and their unit vectors as columns.

    Raises if the eigenpairs that settle are not as many as were counted.
    """
    size = len(matrix)
    # Neighbours just outside are found too, and left out again.
    width = min(size, max(2 * count, count + 4))
    basis = np.linalg.qr(np.random.Generator(np.random.PCG64(1998)).standard_normal((size, width)))[0]
    scale = max(np.abs(matrix).sum(axis=1).max(), np.finfo(float).tiny)
    best, waited = np.inf, 0
    for _ in range(rounds):
        # The interval is widened by what rounding may move an eigenvalue on its edge.
        space, _ = np.linalg.qr(_projected(matrix, a - scale * 1e-12, b + scale * 1e-12, basis, nodes))
        values, turned = np.linalg.eigh(space.T @ matrix @ space)
        basis = space @ turned
        miss = np.linalg.norm(matrix @ basis - basis * values, axis=0)
        inside = np.flatnonzero((values >= a - scale * 1e-13) & (values <= b + scale * 1e-13) & (miss <= scale * 1e-7))
        worst = miss[inside].max(initial=0.0) if len(inside) == count else np.inf
        waited = 0 if worst < best / 2 else waited + 1
        best = min(best, worst)
        if np.isfinite(best) and (best <= scale * 1e-15 or waited >= 2):
            order = inside[np.argsort(-values[inside], kind="stable")]
            vectors = basis[:, order]
            return values[order], vectors / np.linalg.norm(vectors, axis=0)
    raise RuntimeError(f"{count} eigenvalues are in [{a}, {b}], but {len(inside)} settled")


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their unit vectors as columns.

    Of each vector the greatest entry by size (the first of equal ones) is positive. Vectors of equal
    eigenvalues are some orthonormal ones.
    """
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        k = min(wanted, len(matrix))
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    matrix = (matrix + matrix.T) / 2 / scale
    values, vectors = [np.zeros(0)], [np.zeros((len(matrix), 0))]
    for a, b, count in intervals(matrix, wanted):
        found, turned = in_interval(matrix, a, b, count)
        values.append(found)
        vectors.append(turned)
    value, vector = np.concatenate(values)[:wanted] * scale, np.concatenate(vectors, axis=1)[:, :wanted]
    if vector.size:
        # Vectors of near eigenvalues in neighbouring intervals are straight to each other up to their gap only.
        vector = np.linalg.qr(vector)[0]
        vector = vector * np.where(np.take_along_axis(vector, np.abs(vector).argmax(0)[None], 0)[0] < 0, -1.0, 1.0)
    return value, vector
