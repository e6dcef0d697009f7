"""A binary linear classifier over a few dense features and hashed n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Sequence

import numpy as np

BITS = 15


def hashed(grams: Iterable[str], bits: int = BITS) -> list[int]:
    return sorted({zlib.crc32(g.encode()) & ((1 << bits) - 1) for g in grams})


def fit(x: np.ndarray, bags: Sequence[np.ndarray], y: np.ndarray, epochs: int = 16, rate: float = 0.5, batch: int = 64, seed: int = 7, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(weights of the dense features, weights of the n-grams): Adagrad on the logistic loss in small batches."""
    rng = np.random.default_rng(seed)
    w, h = np.zeros(x.shape[1]), np.zeros(1 << bits)
    gw, gh = np.full_like(w, 1e-3), np.full_like(h, 1e-3)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            lens = np.asarray([len(bags[r]) for r in rows], np.int64)
            idx = np.concatenate([bags[r] for r in rows]).astype(np.int64)
            row = np.repeat(np.arange(len(rows)), lens)
            scale = 1.0 / np.sqrt(np.repeat(lens, lens))
            z = x[rows] @ w + np.bincount(row, h[idx] * scale, len(rows))
            err = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y[rows]
            grad = x[rows].T @ err
            gw += grad * grad
            w -= rate * grad / np.sqrt(gw)
            at, inv = np.unique(idx, return_inverse=True)
            g = np.bincount(inv, err[row] * scale, len(at))
            gh[at] += g * g
            h[at] -= rate * g / np.sqrt(gh[at])
    return w, h


def scores(x: np.ndarray, bags: Sequence[np.ndarray], w: np.ndarray, h: np.ndarray) -> np.ndarray:
    lens = np.asarray([len(b) for b in bags], np.int64)
    idx = np.concatenate([*bags, np.empty(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(bags)), lens)
    return x @ w + np.bincount(row, h[idx] / np.sqrt(np.repeat(lens, lens)), len(bags))


def threshold(pos: np.ndarray, neg: np.ndarray) -> float:
    """The score with the least share of errors among pos plus that among neg, in the middle of the widest such gap."""
    pos, neg = np.sort(pos), np.sort(neg)
    at = np.unique(np.concatenate([pos, neg]))
    cuts = np.concatenate([at[:1] - 1, 0.5 * (at[1:] + at[:-1])])
    errors = np.searchsorted(pos, cuts, "left") / max(1, len(pos)) + 1 - np.searchsorted(neg, cuts, "left") / max(1, len(neg))
    width = np.concatenate([[0.0], np.diff(at)])
    best = np.flatnonzero(errors == errors.min())
    return float(cuts[best[width[best].argmax()]])
