"""Linear models on hashed features, trained from labels of bags (noisy-or).

A bag is one document or value, its instances are sentences. The chance of a
bag is ``1 - prod(1 - sigmoid(w·x))`` over its instances; with one instance
per bag this is logistic regression. Training runs over a bounded sample on
the driver; the weights are an array of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np


@dataclass
class Bags:
    """Instances in CSR form: features of instance i are ``idx[indptr[i]:indptr[i+1]]``."""

    idx: np.ndarray
    indptr: np.ndarray
    bag_ptr: np.ndarray
    y: np.ndarray
    scale: np.ndarray | None = None  # divisor of each instance's sum; the root of its feature count if None

    def divisor(self) -> np.ndarray:
        return np.sqrt(np.maximum(self.indptr[1:] - self.indptr[:-1], 1)) if self.scale is None else self.scale


def hashed(feature: str, bits: int) -> int:
    return crc32(feature.encode()) & ((1 << bits) - 1)


def pack(instances: list[list[list[int]]], y: list[int]) -> Bags:
    """From feature lists per instance per bag."""
    flat, indptr, bag_ptr = [], [0], [0]
    n = 0
    for bag in instances:
        for f in bag:
            flat.extend(f)
            indptr.append(len(flat))
        n += len(bag)
        bag_ptr.append(n)
    return Bags(np.array(flat, np.int64), np.array(indptr, np.int64), np.array(bag_ptr, np.int64), np.array(y, float))


def _scores(b: Bags, w: np.ndarray, bias: float) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(w[b.idx])])
    return (total[b.indptr[1:]] - total[b.indptr[:-1]]) / b.divisor() + bias


def _softplus(s: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, s)


def bag_probability(b: Bags, w: np.ndarray, bias: float) -> np.ndarray:
    q = np.concatenate([[0.0], np.cumsum(_softplus(_scores(b, w, bias)))])
    return -np.expm1(-(q[b.bag_ptr[1:]] - q[b.bag_ptr[:-1]]))


def fit(b: Bags, bits: int, l2: float = 1e-3, rounds: int = 200, rate: float = 0.15, bias: float = -3.0, smooth: float = 0.0, missed: float | None = None, balance: bool = True, gain: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the mean log loss of the bags.

    ``smooth`` is the share of positive labels taken to be wrong, ``missed``
    that of negative ones (equal if None); they bound the pull of mislabelled
    bags. ``balance`` gives both classes the same total weight. ``gain``
    scales each feature, so that the penalty weighs on some more than others;
    the weights returned include it.
    """
    g_in = np.ones(1 << bits) if gain is None else gain
    dim = 1 << bits
    w = np.zeros(dim)
    m = np.zeros(dim)
    v = np.zeros(dim)
    bm = bv = 0.0
    div = b.divisor()
    row = np.repeat(np.arange(len(div)), b.indptr[1:] - b.indptr[:-1])
    bag = np.repeat(np.arange(len(b.y)), b.bag_ptr[1:] - b.bag_ptr[:-1])
    pos = max(b.y.sum(), 1.0)
    neg = max(len(b.y) - b.y.sum(), 1.0)
    cw = np.where(b.y > 0, 0.5 / pos, 0.5 / neg) if balance else np.full(len(b.y), 1.0 / len(b.y))
    target = b.y * (1 - smooth) + (1 - b.y) * (smooth if missed is None else missed)
    for t in range(1, rounds + 1):
        s = _scores(b, w * g_in, bias)
        q = np.bincount(bag, _softplus(s), len(b.y))
        p = np.clip(-np.expm1(-q), 1e-9, 1.0)
        dq = cw * ((1 - target) - target * (1 - p) / p)
        ds = dq[bag] / (1 + np.exp(-s))
        g = np.bincount(b.idx, (ds / div)[row], dim) * g_in + l2 * w
        gb = ds.sum()
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        bm = 0.9 * bm + 0.1 * gb
        bv = 0.999 * bv + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-6)
        bias -= rate * (bm / c1) / (np.sqrt(bv / c2) + 1e-6)
    return (w * g_in).astype(np.float32), float(bias)
