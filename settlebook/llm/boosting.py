"""Small gradient boosted trees: fitted with numpy, applied as a SQL expression."""

from __future__ import annotations

import numpy as np

Tree = float | tuple[int, float, "Tree", "Tree"]  # a leaf's value, or feature <= bound ? left : right


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, least: int) -> Tree:
    g, h = grad[rows].sum(), hess[rows].sum()
    best, split = 1e-6, None
    if depth and len(rows) >= 2 * least:
        for f in range(x.shape[1]):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v = x[order, f]
            cut = np.flatnonzero(v[:-1] < v[1:]) + 1
            cut = cut[(cut >= least) & (cut <= len(rows) - least)]
            if not len(cut):
                continue
            gl, hl = np.cumsum(grad[order])[cut - 1], np.cumsum(hess[order])[cut - 1]
            gain = gl**2 / (hl + 1) + (g - gl)**2 / (h - hl + 1) - g**2 / (h + 1)
            k = int(gain.argmax())
            if gain[k] > best:
                best, split = gain[k], (f, float((v[cut[k] - 1] + v[cut[k]]) / 2))
    if split is None:
        return float(-g / (h + 1))
    f, bound = split
    low = x[rows, f] <= bound
    return f, bound, _grow(x, grad, hess, rows[low], depth - 1, least), _grow(x, grad, hess, rows[~low], depth - 1, least)


def _value(tree: Tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, bound, low, high = tree
    return np.where(x[:, f] <= bound, _value(low, x), _value(high, x))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3, least: int = 5) -> list[Tree]:
    """Trees whose values add up to the log odds of ``y`` (0 or 1)."""
    z, trees = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        tree = _grow(x, p - y, p * (1 - p), np.arange(len(y)), depth, least)
        trees.append(tree)
        z += rate * _value(tree, x)
    return trees


def scores(trees: list[Tree], x: np.ndarray, rate: float = 0.3) -> np.ndarray:
    return 1 / (1 + np.exp(-rate * sum(_value(t, x) for t in trees)))


def sql(trees: list[Tree], names: list[str], rate: float = 0.3) -> str:
    """The same score as SQL over columns ``names``."""
    def one(tree: Tree) -> str:
        if isinstance(tree, float):
            return f"{rate * tree!r}D"
        f, bound, low, high = tree
        return f"IF({names[f]} <= {bound!r}D, {one(low)}, {one(high)})"
    return f"1 / (1 + exp(-({' + '.join(map(one, trees))})))"


def threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least score from which on the labelled examples reach ``precision``."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= precision)
    return float(score[order[good[-1]]]) if len(good) else 1.0
