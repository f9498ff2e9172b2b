"""Gradient boosting of small trees over binned features, with isotonic calibration, from sums that may be made anywhere.

Each round fits a tree of fixed depth to the gradients of the logistic loss: splits are chosen from histograms of gradients
and curvatures over at most `BINS` quantile bins of each feature. Ties go to the first feature and the lowest bin, so equal
input gives an equal model. A constant feature is never split on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

BINS, LEAST, SHRINK = 32, 1.0, 1.0


@dataclass
class Boosted:
    """`feature` and `cut` of each inner node (rounds x nodes, by levels), `value` of each leaf; edges bin a feature."""

    edges: list[np.ndarray]
    start: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.raw_of(_codes(x, self.edges))

    def raw_of(self, codes: np.ndarray, first: int = 0) -> np.ndarray:
        """What the trees from `first` on say of binned rows; the start counts as part of the first."""
        out = np.full(len(codes), 0.0 if first else self.start)
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        for feature, cut, value in zip(self.feature[first:], self.cut[first:], self.value[first:]):
            out += value[_node(codes, feature, cut, depth) - (len(value) - 1)]
        return out


def _node(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
    for _ in range(levels):
        node = 2 * node + 1 + (codes[rows, feature[node]] > cut[node])
    return node


def _codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    if not len(x):
        return np.zeros((0, len(edges)), np.int64)
    return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)], axis=1)


def histogram(codes: np.ndarray, y: np.ndarray, weight: np.ndarray, raw: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """Gradients and curvatures (2 x nodes x features x bins) at a level of the tree that grows; those of parts of the rows add up."""
    p = 1 / (1 + np.exp(-raw))
    g, h = weight * (p - y), weight * p * (1 - p)
    many = 1 << level
    node = _node(codes, feature, cut, level) - (many - 1)
    out = np.zeros((2, many, codes.shape[1], BINS))
    for f in range(codes.shape[1]):
        at = node * BINS + codes[:, f]
        for k, w in enumerate((g, h)):
            out[k, :, f] = np.bincount(at, weights=w, minlength=many * BINS).reshape(many, BINS)
    return out


def grow(sums: Callable[[Boosted, np.ndarray, np.ndarray, int], np.ndarray], edges: list[np.ndarray], start: float, rounds: int = 60, depth: int = 3, rate: float = 0.2) -> Boosted:
    """Trees from histograms alone: sums(trees so far, features and cuts of the one that grows, level)."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    made = Boosted(edges, start, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, leaves)))
    for _ in range(rounds):
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        for level in range(depth):
            low, many = (1 << level) - 1, 1 << level
            gl, hl = sums(made, feature, cut, level).cumsum(axis=3)
            total_g, total_h = gl[:, 0, -1], hl[:, 0, -1]
            gr, hr = total_g[:, None, None] - gl, total_h[:, None, None] - hl
            gain = gl**2 / (hl + SHRINK) + gr**2 / (hr + SHRINK) - (total_g**2 / (total_h + SHRINK))[:, None, None]
            gain[(hl < LEAST) | (hr < LEAST)] = -1
            gain, nodes = gain.reshape(many, -1), np.arange(many)
            top = gain.argmax(axis=1)
            better, f, t = gain[nodes, top] > 1e-9, top // BINS, top % BINS
            feature[low : low + many], cut[low : low + many] = np.where(better, f, 0), np.where(better, t, BINS)
            left_g, left_h = np.where(better, gl[nodes, f, t], total_g), np.where(better, hl[nodes, f, t], total_h)
        sum_g, sum_h = (np.stack([left, total - left], axis=1).ravel() for left, total in ((left_g, total_g), (left_h, total_h)))
        value = -rate * sum_g / (sum_h + SHRINK)
        made = Boosted(edges, start, np.vstack([made.feature, feature]), np.vstack([made.cut, cut]), np.vstack([made.value, value]))
    return made


def at_once(codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Callable[[Boosted, np.ndarray, np.ndarray, int], np.ndarray]:
    """Sums over rows in memory: what the trees say of them is kept."""
    kept: list = [0, 0.0]

    def sums(made: Boosted, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        if level == 0:
            kept[:] = len(made.value), kept[1] + made.raw_of(codes, kept[0])
        return histogram(codes, y, weight, kept[1], feature, cut, level)

    return sums


def start_of(ones: float, whole: float) -> float:
    share = float(np.clip(ones / whole, 1e-6, 1 - 1e-6))
    return float(np.log(share / (1 - share)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2) -> Boosted:
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    edges = [e[e > x[:, k].min()] for k, e in enumerate(edges)]
    return grow(at_once(_codes(x, edges), y, weight), edges, start_of((weight * y).sum(), weight.sum()), rounds, depth, rate)


@dataclass
class Isotonic:
    """A non-decreasing step function: probability `level` from `at` on."""

    at: np.ndarray
    level: np.ndarray

    def __call__(self, score: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.zeros(len(score))
        return self.level[np.maximum(0, np.searchsorted(self.at, score, side="right") - 1)]


def pooled(score: np.ndarray, ones: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Pools (first score, ones, rows) over ascending scores, each share no lower than the one before; pools of ranges pool alike."""
    pools: list[list[float]] = []
    for s, one, n in zip(score.tolist(), ones.tolist(), rows.tolist()):
        if pools and pools[-1][0] == s:
            pools[-1][1:] = [pools[-1][1] + one, pools[-1][2] + n]
        else:
            pools.append([s, one, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, more, n_more = pools.pop()
            pools[-1][1:] = [pools[-1][1] + more, pools[-1][2] + n_more]
    return np.array(pools, float).reshape(-1, 3)


def shares(pools: np.ndarray) -> Isotonic:
    return Isotonic(pools[:, 0], pools[:, 1] / pools[:, 2])


def isotonic(score: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pooled shares of ones over ascending scores."""
    order = np.argsort(score, kind="stable")
    return shares(pooled(score[order], y[order], np.ones(len(order))))


def bar(calibration: Isotonic, score: np.ndarray, y: np.ndarray, probability: float, least: int) -> float:
    """The least score whose calibrated probability is `probability` or more; infinite unless `least` ones reach it."""
    good = np.flatnonzero(calibration.level >= probability)
    if not len(good) or y[score >= calibration.at[good[0]]].sum() < least:
        return float("inf")
    return float(calibration.at[good[0]])
