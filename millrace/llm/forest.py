"""A random forest in numpy: bootstrap rows, a random share of the features at each split, Gini impurity."""
import numpy as np


class Forest:
    """trees: arrays (feature, threshold, left, right, share of label 1) of nodes; feature -1 is a leaf."""

    def __init__(self, trees: list[tuple]):
        self.trees = trees

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of label 1 in the leaves that each row reaches."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                go_left = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go_left, left[at], right[at]), at)
            total += share[at]
        return total / max(1, len(self.trees))


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray, smallest: int):
    """(impurity, feature, threshold) of the best split, or None."""
    best, n = None, len(y)
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        left = np.arange(1, n)
        fits = (v[1:] > v[:-1]) & (left >= smallest) & (n - left >= smallest)
        if not fits.any():
            continue
        a, b = ones[:-1] / left, (ones[-1] - ones[:-1]) / (n - left)
        impurity = np.where(fits, left * a * (1 - a) + (n - left) * b * (1 - b), np.inf)
        i = int(np.argmin(impurity))
        if best is None or impurity[i] < best[0]:
            best = (impurity[i], int(f), float((v[i] + v[i + 1]) / 2))
    return best


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 10, smallest: int = 3, seed: int = 0) -> Forest:
    """A forest for rows x with labels y of 0 and 1; the same seed gives the same forest."""
    rng, out = np.random.default_rng(seed), []
    few = max(1, round(np.sqrt(x.shape[1])))
    for _ in range(trees):
        drawn = rng.integers(0, len(x), len(x))
        nodes: list[list] = []
        waiting = [(drawn, 0, -1, 0)]
        while waiting:
            rows, level, parent, side = waiting.pop()
            if parent >= 0:
                nodes[parent][2 + side] = len(nodes)
            nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
            if level >= depth or len(rows) < 2 * smallest or y[rows].min() == y[rows].max():
                continue
            if found := _split(x[rows], y[rows], rng.choice(x.shape[1], few, replace=False), smallest):
                here = len(nodes) - 1
                nodes[here][:2] = found[1:]
                goes = x[rows, found[1]] <= found[2]
                waiting += [(rows[~goes], level + 1, here, 1), (rows[goes], level + 1, here, 0)]
        columns = list(zip(*nodes, strict=True))
        out.append((np.array(columns[0], np.int64), np.array(columns[1]), np.array(columns[2], np.int64), np.array(columns[3], np.int64), np.array(columns[4])))
    return Forest(out)
