"""Leading eigenvectors of a symmetric matrix by slicing its spectrum.

The signs of the pivots of an LDL' factorisation of a shifted matrix count the eigenvalues
beyond the shift. Counts cut the spectrum until a slice holds one eigenvalue, or a cluster
too narrow to cut; Rayleigh quotient iteration finds it from there, with cubic convergence;
counts on both sides of what was found certify its number.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
# Of Bunch and Kaufman: bounds the growth of entries in the factorisation.
_GROWTH = (1 + 17 ** 0.5) / 8
_STEPS = 12


def negatives(matrix: np.ndarray) -> int:
    """The number of negative eigenvalues, from the pivots of a factorisation LDL'.

    Pivots are single entries or two by two blocks, chosen so that entries don't grow; a
    block has one negative eigenvalue and one positive. A pivot of zero is not negative.
    """
    rest, count = matrix.astype(np.float64, copy=True), 0
    while len(rest):
        below = np.abs(rest[1:, 0])
        largest = below.max(initial=0.0)
        if largest == 0:
            count += int(rest[0, 0] < 0)
            rest = rest[1:, 1:]
            continue
        partner, block = 0, 1
        if abs(rest[0, 0]) < _GROWTH * largest:
            other = 1 + int(below.argmax())
            column = np.abs(rest[:, other])
            column[other] = 0
            if abs(rest[0, 0]) * column.max() < _GROWTH * largest ** 2:
                partner = other
                block = 1 if abs(rest[other, other]) >= _GROWTH * column.max() else 2
        _swap(rest, block - 1, partner)
        pivot, side = rest[:block, :block], rest[block:, :block]
        count += int(rest[0, 0] < 0) if block == 1 else 1
        rest = rest[block:, block:] - side @ np.linalg.solve(pivot, side.T)
    return count


def _swap(matrix: np.ndarray, a: int, b: int) -> None:
    matrix[[a, b]] = matrix[[b, a]]
    matrix[:, [a, b]] = matrix[:, [b, a]]


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their unit vectors as columns.

    ``matrix`` has no negative eigenvalues. Those that rounding does not tell from zero are
    left out, so there may be fewer. Equal eigenvalues have any orthogonal vectors.
    """
    size = len(matrix)
    top = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    noise = 64 * size * _EPS * top
    if top == 0:
        return np.zeros(0), np.zeros((size, 0))
    identity = np.eye(size)

    def above(value: float) -> int:
        return negatives(value * identity - matrix)

    positive = above(noise)
    wanted = min(most, positive)
    values, vectors = np.zeros(0), np.zeros((size, 0))
    # Slices (low, high, eigenvalues above high, above low), the highest last.
    slices = [(noise, top * (1 + 4 * _EPS) + noise, 0, positive)]
    while slices and len(values) < wanted:
        low, high, before, after = slices.pop()
        held, narrow = after - before, high - low <= noise
        if held == 1 or narrow:
            for _ in range(min(held, wanted - before)):
                # Vectors of values nearby are kept apart; others are so by themselves.
                apart = vectors[:, np.abs(values - high) < top / 64]
                value, vector = _refined(matrix, (low + high) / 2, apart)
                if not narrow and not low <= value <= high:
                    break  # drawn to a neighbour: cut closer
                values, vectors = np.append(values, value), np.column_stack([vectors, vector])
            else:
                continue
        if held:
            middle = (low + high) / 2
            cut = above(middle)
            slices += [(low, middle, cut, after), (middle, high, before, cut)]
    for number, value in enumerate(values):
        if not above(value + noise) <= number < above(value - noise):
            raise ArithmeticError(f"eigenvalue {number + 1} is not certified")
    return values, vectors


def _refined(matrix: np.ndarray, near: float, apart: np.ndarray) -> tuple[float, np.ndarray]:
    """The eigenvalue closest to ``near`` whose vector is orthogonal to ``apart``."""
    size = len(matrix)
    scale = np.abs(matrix).max()

    def cleared(vector: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - apart @ (apart.T @ vector)
        return vector / np.linalg.norm(vector)

    def solved(shift: float, vector: np.ndarray) -> np.ndarray:
        try:
            step = np.linalg.solve(matrix - shift * np.eye(size), vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue
            step = np.linalg.solve(matrix - (shift + 4 * _EPS * scale) * np.eye(size), vector)
        return cleared(step / np.abs(step).max())

    vector = cleared(np.random.default_rng(size + apart.shape[1]).standard_normal(size))
    for _ in range(3):  # with a fixed shift, toward the slice
        vector = solved(near, vector)
    value = float(vector @ matrix @ vector)
    best = (np.linalg.norm(matrix @ vector - value * vector), value, vector)
    for _ in range(_STEPS):
        vector = solved(value, vector)
        value = float(vector @ matrix @ vector)
        error = np.linalg.norm(matrix @ vector - value * vector)
        if error >= best[0]:
            break
        best = (error, value, vector)
    return best[1], best[2]
