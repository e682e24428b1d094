"""Small gradient-boosted trees, isotonic calibration and lasso logistic regression for bounded samples.

All three are fitted on the driver, on samples whose size is a parameter of the operators that use them;
what they yield is applied to all rows on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Nodes by number; feature -1 marks a leaf. A row goes left where its value is at most the threshold."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.left.append(-1)
        self.right.append(-1)
        self.value.append(value)
        return len(self.value) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        feature, threshold, left, right = map(np.array, (self.feature, self.threshold, self.left, self.right))
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(x[rows, feature[node]] <= threshold[node], left[node], right[node])
        return np.array(self.value)[at]

    def paths(self) -> list[tuple[tuple[int, bool, float], ...]]:
        """Of each node but the root, the conditions (feature, at most, threshold) on the way to it."""
        out, todo = [], [(0, ())]
        while todo:
            node, path = todo.pop()
            if path:
                out.append(path)
            if self.feature[node] >= 0:
                f, t = self.feature[node], self.threshold[node]
                todo += [(self.left[node], (*path, (f, True, t))), (self.right[node], (*path, (f, False, t)))]
        return out


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += self.rate * t.predict(x)
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cuts midway between neighbouring distinct values, at most bins of them, by quantile."""
    out = []
    for column in x.T:
        values = np.unique(column)
        cuts = (values[1:] + values[:-1]) / 2
        out.append(cuts if len(cuts) <= bins else np.unique(np.quantile(cuts, np.linspace(0, 1, bins))))
    return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, least: int = 5, ridge: float = 1.0, bins: int = 48) -> Boosted:
    """Newton boosting of the logistic loss over histograms."""
    edges = _edges(x, bins)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(p / (1 - p))), rate, [])
    margin = np.full(len(y), model.base)
    for _ in range(rounds):
        q = sigmoid(margin)
        grad, hess = y - q, np.maximum(q * (1 - q), 1e-6)
        tree = Tree()
        tree.add(0.0)
        todo = [(0, np.arange(len(y)), 0)]
        while todo:
            node, rows, level = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            tree.value[node] = float(g / (h + ridge))
            if level == depth or len(rows) < 2 * least:
                continue
            best = (1e-4, -1, -1)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, f]
                n = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                gl = np.cumsum(np.bincount(b, grad[rows], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], len(e) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                gain[(n < least) | (len(rows) - n < least)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
            if best[1] < 0:
                continue
            _, f, k = best
            goes = binned[rows, f] <= k
            tree.feature[node], tree.threshold[node] = f, float(edges[f][k])
            tree.left[node], tree.right[node] = tree.add(0.0), tree.add(0.0)
            todo += [(tree.left[node], rows[goes], level + 1), (tree.right[node], rows[~goes], level + 1)]
        margin += rate * tree.predict(x)
        model.trees.append(tree)
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (score, probability) of the non-decreasing fit, by pooling neighbours that violate the order."""
    values, at = np.unique(score, return_inverse=True)
    weight = np.bincount(at).astype(float)
    mean = np.bincount(at, y) / weight
    blocks: list[list[float]] = []  # mean, weight, first and last value
    for v, m, w in zip(values, mean, weight, strict=True):
        blocks.append([m, w, v, v])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m1, w1, _, last = blocks.pop()
            m0, w0, first, _ = blocks.pop()
            blocks.append([(m0 * w0 + m1 * w1) / (w0 + w1), w0 + w1, first, last])
    xs = [x for b in blocks for x in ((b[2], b[3]) if b[2] < b[3] else (b[2],))]
    ys = [b[0] for b in blocks for _ in range(2 if b[2] < b[3] else 1)]
    return np.array(xs), np.array(ys)


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise mean logistic loss + penalty * sum |weight|, by accelerated proximal steps."""
    n, d = x.shape
    rate = 4.0 / max(np.linalg.norm(x, 2) ** 2 / n + 1, 1e-9)
    w, b = np.zeros(d), 0.0
    v, c, t = w, b, 1.0
    for _ in range(steps):
        r = sigmoid(x @ v + c) - y
        new = v - rate * (x.T @ r / n)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        base = c - rate * r.mean()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / s * (new - w), base + (t - 1) / s * (base - b)
        w, b, t = new, base, s
    return float(b), w


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))
