"""Linear-chain conditional random fields by numpy: many chains at once, step by step."""

from __future__ import annotations

import numpy as np


#: Places of a chain that are taken one after another; longer chains go by blocks of so many, side by side.
BLOCK = 256


def chains(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values in `group`."""
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    return first, np.diff(np.append(first, len(group)))


def _going(lengths: np.ndarray) -> np.ndarray:
    """How many of the runs, longest first, still go on at each step."""
    return np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1 if len(lengths) else 1), "right")


def _messages(e: np.ndarray, a: np.ndarray, starts: np.ndarray, lengths: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of the chains (starts, lengths), and what enters each from before (zeros: nothing, it begins a chain) and from behind.

    The steps within a block are one k x k matrix, a product of the steps' matrices, made for all blocks side by side;
    messages then pass from block to block, which are all that is done one after another.
    """
    k = len(a)
    n = -(-lengths // block)
    of = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    lo = starts[of] + block * nth
    size = np.minimum(lengths[of] - block * nth, block)
    before, behind = np.zeros((len(lo), k)), np.ones((len(lo), k))
    long = np.flatnonzero(n[of] > 1)
    if not len(long):
        return lo, size, before, behind
    order = long[np.argsort(-size[long], kind="stable")]
    step = np.tile(np.eye(k), (len(order), 1, 1))
    for t, m in enumerate(_going(size[order])):
        at = lo[order[:m]] + t
        enter = step[:m] @ a if t else np.where((nth[order] == 0)[:, None, None], step, a)
        x = enter * e[at][:, None, :]
        step[:m] = x / x.sum(axis=(1, 2), keepdims=True)
    matrix = np.empty((len(lo), k, k))
    matrix[order] = step
    last = np.cumsum(n) - 1
    some = np.flatnonzero(n > 1)
    for j in range(int(n.max()) - 1):
        at = (last - n + 1 + j)[some[n[some] > j + 1]]
        x = matrix[at].sum(axis=1) if j == 0 else (before[at][:, None, :] @ matrix[at])[:, 0]
        before[at + 1] = x / x.sum(axis=1, keepdims=True)
        at = (last - j)[some[n[some] > j + 1]]
        x = (matrix[at] @ behind[at][:, :, None])[:, :, 0]
        behind[at - 1] = x / x.sum(axis=1, keepdims=True)
    return lo, size, before, behind


def marginals(emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, transition: np.ndarray, pairs: bool = False, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray | None, float]:
    """Posterior label probabilities of every place, the expected transition counts and the log partition sum.

    emission: log potentials, a row for each place; chains are runs of places, of any length, and never cut. Blocks of
    chains are taken longest first, so those still going at a step are always the first ones; values are scaled to sum
    to one at each place.
    """
    n, k = emission.shape
    top = emission.max(axis=1, keepdims=True) if n else emission
    e = np.exp(emission - top)
    a = np.exp(transition)
    begins = starts[lengths > 0]
    lo, size, before, behind = _messages(e, a, starts, lengths, block)
    order = np.argsort(-size, kind="stable")
    lo, size, before, behind = lo[order], size[order], before[order], behind[order]
    inside = before.any(axis=1)
    going = _going(size)
    forward, scale = np.empty_like(e), np.empty(n)
    for t, m in enumerate(going):
        at = lo[:m] + t
        x = np.where(inside[:m, None], before[:m] @ a, 1.0) * e[at] if t == 0 else (forward[at - 1] @ a) * e[at]
        scale[at] = s = x.sum(axis=1)
        forward[at] = x / s[:, None]
    backward = np.empty_like(e)
    backward[lo + size - 1] = behind
    for t in range(len(going) - 2, -1, -1):
        at = lo[: going[t + 1]] + t
        x = (backward[at + 1] * e[at + 1]) @ a.T
        backward[at] = x / x.sum(axis=1, keepdims=True)
    p = forward * backward
    p /= p.sum(axis=1, keepdims=True)
    if not pairs:
        return p, None, 0.0
    inner = np.ones(n, dtype=bool)
    inner[begins] = False
    later = np.flatnonzero(inner)
    x = forward[later - 1][:, :, None] * a[None] * (e[later] * backward[later])[:, None, :]
    expected = (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(later) else np.zeros((k, k))
    return p, expected, float(np.log(scale).sum() + top.sum())
