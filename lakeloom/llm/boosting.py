"""Gradient-boosted trees on counted cells: fitted on the driver from a bounded table, applied as a Column."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rounds of boosting, the step of each, and the ridge on leaf values.
ROUNDS, RATE, RIDGE = 40, 0.3, 1.0
Node = tuple  # ("leaf", value) or ("split", feature, largest value that goes left, left, right)


def fit_trees(x: np.ndarray, n: np.ndarray, y: np.ndarray, depth: int = 2) -> tuple[float, list[Node]]:
    """x: (cells, features) small whole numbers; n and y: rows and positive rows of each cell. Logistic loss."""
    p = (y.sum() + 0.5) / (n.sum() + 1)
    base = float(np.log(p / (1 - p)))
    score, trees = np.full(len(x), base), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree = grown(x, y - n * p, n * p * (1 - p), np.ones(len(x), bool), depth)
        score += values_of(tree, x)
        trees.append(tree)
    return base, trees


def grown(x: np.ndarray, g: np.ndarray, h: np.ndarray, here: np.ndarray, depth: int) -> Node:
    leaf = ("leaf", float(RATE * g[here].sum() / (h[here].sum() + RIDGE)))
    if not depth:
        return leaf
    fit = lambda m: g[m].sum() ** 2 / (h[m].sum() + RIDGE)
    whole, best = fit(here), (1e-6, -1, 0)
    for f in range(x.shape[1]):
        for v in np.unique(x[here, f])[:-1]:
            left = here & (x[:, f] <= v)
            best = max(best, (fit(left) + fit(here & ~left) - whole, f, int(v)))
    if best[1] < 0:
        return leaf
    left = here & (x[:, best[1]] <= best[2])
    return ("split", best[1], best[2], grown(x, g, h, left, depth - 1), grown(x, g, h, here & ~left, depth - 1))


def values_of(node: Node, x: np.ndarray) -> np.ndarray:
    """The tree's value of each row."""
    if node[0] == "leaf":
        return np.full(len(x), node[1])
    return np.where(x[:, node[1]] <= node[2], values_of(node[3], x), values_of(node[4], x))


def totals(base: float, trees: list[Node], x: np.ndarray) -> np.ndarray:
    return base + sum((values_of(t, x) for t in trees), np.zeros(len(x)))


def total(base: float, trees: list[Node], row: np.ndarray) -> float:
    return float(totals(base, trees, np.asarray(row)[None])[0])


def as_column(base: float, trees: list[Node], features: list[Column]) -> Column:
    def of(node: Node) -> Column:
        if node[0] == "leaf":
            return F.lit(node[1])
        return F.when(features[node[1]] <= node[2], of(node[3])).otherwise(of(node[4]))

    return reduce(Column.__add__, [of(t) for t in trees], F.lit(base))
