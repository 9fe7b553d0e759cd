"""Regression trees grown level by level with exact splits, many trees at once.

Rows of all trees stand in one table. At each level every feature is put in
order within its node once, and running sums give the gain of every cut between
two unlike values; the best cut of each node wins. A tree of any depth takes as
many passes as it has levels, whatever the number of its nodes or of the trees
beside it. These functions see one series (a row a day) inside a Spark task;
series, folds and candidates are spread over tasks by :mod:`.models`.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Variance of a node that counts as none.
PURE = 1e-12
#: Rows of all trees that are grown together.
TOGETHER = 200_000


@dataclass
class Trees:
    """Nodes of several trees: the feature and cut of inner nodes (feature -1: a leaf), their left child, the mean."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row of x reaches, in each tree."""
        node = np.repeat(self.roots[:, None], len(x), axis=1)
        row = np.arange(len(x))[None, :]
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return node
            right = x[row, np.maximum(feature, 0)] > self.cut[node]
            node = np.where(inner, self.left[node] + right, node)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean of the trees for each row of x."""
        return self.value[self.leaves(x)].mean(axis=0)


def _first_best(gain: np.ndarray, starts: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest gain of each run of rows, and the first row that has it."""
    best = np.maximum.reduceat(gain, starts)
    at = np.where(gain == best[node], np.arange(len(gain)), len(gain))
    return best, np.minimum.reduceat(at, starts)


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int | None = None) -> Trees:
    """A tree for each row of ``weight``: how often it holds each row of x. Without a depth, trees grow until
    their leaves hold one value or cannot be cut."""
    trees = len(weight)
    node, rows = np.nonzero(weight)
    w = weight[node, rows].astype(float)
    wy = w * y[rows]
    total, squares = (np.bincount(node, v, trees) for v in (wy, wy * y[rows]))
    count = np.bincount(node, w, trees)
    feature, cut, left, value = [np.full(trees, -1)], [np.zeros(trees)], [np.full(trees, -1)], [total / count]
    order = [np.argsort(x[rows, f], kind="stable") for f in range(x.shape[1])]
    first, level = 0, 0  # the first node of the level
    while depth is None or level < depth:
        spread = squares / count - (total / count) ** 2
        open_ = spread > PURE * np.maximum(1.0, (total / count) ** 2)
        live = np.flatnonzero((node >= first) & open_[np.maximum(node - first, 0)])
        if not len(live):
            break
        alive = np.zeros(len(node), bool)
        alive[live] = True
        here = np.flatnonzero(open_)
        local = np.full(len(open_), -1)
        local[here] = np.arange(len(here))
        best = np.full(len(here), -np.inf)
        chosen, where = np.full(len(here), -1), np.zeros(len(here))
        for f, o in enumerate(order):
            o = o[alive[o]]
            mine = local[node[o] - first]
            by = np.argsort(mine, kind="stable")
            o, mine = o[by], mine[by]
            starts = np.searchsorted(mine, np.arange(len(here)))
            values = x[rows[o], f]
            cw, cy = np.cumsum(w[o]), np.cumsum(wy[o])
            before_w, before_y = (np.concatenate([[0.0], c])[starts][mine] for c in (cw, cy))
            lw, ly = cw - before_w, cy - before_y
            rw, ry = count[here][mine] - lw, total[here][mine] - ly
            can = np.zeros(len(o), bool)
            can[:-1] = (mine[1:] == mine[:-1]) & (values[1:] > values[:-1])
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(can, ly * ly / lw + ry * ry / rw, -np.inf)
            top, at = _first_best(gain, starts, mine)
            better = top > best + 1e-12 * np.abs(np.where(np.isfinite(best), best, 0.0))
            at = at[better]
            best[better], chosen[better] = top[better], f
            where[better] = (values[at] + values[np.minimum(at + 1, len(values) - 1)]) / 2
        cuts = np.flatnonzero(chosen >= 0)
        if not len(cuts):
            break
        # The children of the nodes that are cut follow all nodes so far, side by side.
        begin = first + len(count)
        feature[-1][here[cuts]], cut[-1][here[cuts]] = chosen[cuts], where[cuts]
        left[-1][here[cuts]] = begin + 2 * np.arange(len(cuts))
        child = left[-1][np.maximum(node - first, 0)]
        moves = np.flatnonzero((node >= first) & (child >= 0))
        mine = node[moves] - first
        node[moves] = child[moves] + (x[rows[moves], feature[-1][mine]] > cut[-1][mine])
        own = node[moves] - begin
        count, total = np.bincount(own, w[moves], 2 * len(cuts)), np.bincount(own, wy[moves], 2 * len(cuts))
        squares = np.bincount(own, wy[moves] * y[rows[moves]], 2 * len(cuts))
        feature.append(np.full(len(count), -1))
        cut.append(np.zeros(len(count)))
        left.append(np.full(len(count), -1))
        value.append(total / count)
        first, level = begin, level + 1
    return Trees(*(np.concatenate(v) for v in (feature, cut, left, value)), np.arange(trees))


def boosting(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, step: float) -> Iterator[Trees]:
    """The trees of least-squares boosting from the mean: each fits what is left by those before it."""
    left = y - y.mean()
    every = np.ones((1, len(y)), int)
    for _ in range(rounds):
        tree = grow(x, left, every, depth)
        left = left - step * tree.predict(x)
        yield tree


def boosted(x: np.ndarray, y: np.ndarray, test: np.ndarray, rounds: int, depth: int, step: float) -> np.ndarray:
    """Predictions of the boosted trees for the test rows."""
    out = np.full(len(test), y.mean())
    for tree in boosting(x, y, rounds, depth, step):
        out += step * tree.predict(test)
    return out


def forest(x: np.ndarray, y: np.ndarray, test: np.ndarray, count: int, depth: int | None, seed: int) -> np.ndarray:
    """Mean of trees on bootstrap samples, each with all features."""
    rng, out, done = np.random.default_rng(seed), np.zeros(len(test)), 0
    while done < count:
        some = min(count - done, max(1, TOGETHER // len(y)))
        weight = np.stack([np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y)) for _ in range(some)])
        out += grow(x, y, weight, depth).predict(test) * some
        done += some
    return out / count


def ridge(x: np.ndarray, y: np.ndarray, test: np.ndarray, alpha: float) -> np.ndarray:
    """Least squares with a penalty on the slopes and none on the intercept, by the normal equations."""
    middle = x.mean(axis=0)
    centred = x - middle
    slopes = np.linalg.solve(centred.T @ centred + alpha * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    return y.mean() + (test - middle) @ slopes
