"""Gradient-boosted trees for small tables: fitted on the driver on a bounded sample, applied as SQL expressions."""

from __future__ import annotations

import numpy as np


def grow(x, g, h, rows, depth, cuts, least, ridge):
    """A tree as nested (feature, cut, left, right) or a leaf's value; ties go to the first feature and cut."""
    gs, hs = g[rows].sum(), h[rows].sum()
    leaf = float(gs / (hs + ridge))
    if not depth or len(rows) < 2 * least:
        return leaf
    best, gain = None, 1e-6
    for f in range(x.shape[1]):
        order = np.argsort(x[rows, f], kind="stable")
        v = x[rows[order], f]
        cg, ch = np.cumsum(g[rows[order]]), np.cumsum(h[rows[order]])
        k = np.searchsorted(v, cuts[f], "right")  # rows at or below each cut
        ok = (k >= least) & (len(rows) - k >= least)
        if ok.any():
            k, c = k[ok], cuts[f][ok]
            gl, hl = cg[k - 1], ch[k - 1]
            gains = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
            i = int(np.argmax(gains))
            if gains[i] > gain:
                best, gain = (f, float(c[i])), float(gains[i])
    if best is None:
        return leaf
    f, c = best
    low = x[rows, f] <= c
    return (f, c, grow(x, g, h, rows[low], depth - 1, cuts, least, ridge), grow(x, g, h, rows[~low], depth - 1, cuts, least, ridge))


def value(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, c, left, right = tree
    return np.where(x[:, f] <= c, value(left, x), value(right, x))


def fit(x, y, weight=None, trees=30, depth=3, rate=0.3, bins=32, least=5, ridge=1.0):
    """(start, trees) of the log odds; with one class or no rows only the smoothed start."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
    p = ((w * y).sum() + 1) / (w.sum() + 2)
    start = float(np.log(p / (1 - p)))
    if len(y) == 0 or y.min() == y.max():
        return start, []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    z, made = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        tree = grow(x, w * (y - p), w * p * (1 - p), np.arange(len(y)), depth, cuts, least, ridge)
        made.append(tree)
        z = z + rate * value(tree, x)
    return start, [(rate, t) for t in made]


def predict(model, x):
    start, trees = model
    z = start + sum(rate * value(t, np.asarray(x, float)) for rate, t in trees)
    return 1 / (1 + np.exp(-z)) if trees else np.full(len(x), 1 / (1 + np.exp(-start)))


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending scores and the non-decreasing probabilities that fit ``y`` best, by pooling adjacent violators."""
    w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
    at, inverse = np.unique(score, return_inverse=True)
    blocks = []
    for total, n in zip(np.bincount(inverse, w * y).tolist(), np.bincount(inverse, w).tolist(), strict=True):
        blocks.append([total, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, n, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2] + k]
    return at, np.concatenate([np.full(k, total / n) for total, n, k in blocks]) if blocks else np.zeros(0)


def auc(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Weighted area under the ROC curve, ties half; nan with one class."""
    at, inverse = np.unique(score, return_inverse=True)
    pos, neg = np.bincount(inverse, weight * y, len(at)), np.bincount(inverse, weight * (1 - y), len(at))
    below = np.cumsum(neg) - neg / 2
    return float((pos * below).sum() / (pos.sum() * neg.sum())) if pos.sum() and neg.sum() else float("nan")


def to_sql(model, names: list[str]) -> str:
    """The probability as a SQL expression over the features' expressions ``names``."""
    start, trees = model

    def one(t, rate):
        if not isinstance(t, tuple):
            return f"{rate * t:.9f}D"
        return f"CASE WHEN {names[t[0]]} <= {t[1]!r}D THEN {one(t[2], rate)} ELSE {one(t[3], rate)} END"

    z = " + ".join([f"{start:.9f}D", *(one(t, rate) for rate, t in trees)])
    return f"1D / (1D + exp(-({z})))"
