"""Generalised extreme-value distributions of many keys at once, by maximum likelihood."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.session import shared_dir

#: Width of the differences that make derivatives, on scores of deviation one; least and largest shape.
_H, SHAPES = 1e-3, (-0.999, 5.0)
#: Where the likelihood is asked: the point itself, beside it in each direction, and in both of two directions.
_STENCIL = [(0, 0, 0), *[tuple(s * (k == i) for k in range(3)) for i in range(3) for s in (1, -1)], *[tuple(s * (k in p) for k in range(3)) for p in ((0, 1), (0, 2), (1, 2)) for s in (1, -1)]]


def negative_log_density(x: Column, loc: Column, scale: Column, shape: Column) -> Column:
    """-ln of the density; infinite beyond the end of the distribution."""
    z = (x - loc) / scale
    t = 1 + shape * z
    gumbel = z + F.exp(-z)
    other = F.when(t > 0, (1 + 1 / shape) * F.log(t) + F.pow(t, -1 / shape)).otherwise(F.lit(float("inf")))
    return F.log(scale) + F.when(F.abs(shape) < 1e-7, gumbel).otherwise(other)


def _step(pdf: pd.DataFrame) -> pd.DataFrame:
    """The next trial of each key: a damped Newton step from the best point so far."""
    out = []
    for r in pdf.to_dict("records"):
        f = np.array(r["sums"], dtype=float)
        best, lam = r["best"], r["lam"]
        if np.isfinite(f).all() and (best is None or f[0] <= best[0]):
            g = [(f[1 + 2 * i] - f[2 + 2 * i]) / (2 * _H) for i in range(3)]
            h = np.diag([(f[1 + 2 * i] + f[2 + 2 * i] - 2 * f[0]) / _H**2 for i in range(3)])
            for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
                h[i, j] = h[j, i] = (f[7 + 2 * k] + f[8 + 2 * k] + 2 * f[0] - f[1 + 2 * i] - f[2 + 2 * i] - f[1 + 2 * j] - f[2 + 2 * j]) / (2 * _H**2)
            best, lam = [f[0], *r["trial"], *g, *h.ravel()], max(lam / 10, 1e-9)
        else:
            lam = lam * 10
        done, trial = lam > 1e10, r["trial"]
        if best is not None and not done:
            at, g, h = np.array(best[1:4]), np.array(best[4:7]), np.array(best[7:]).reshape(3, 3)
            value, vector = np.linalg.eigh(h)
            size = np.abs(value) + lam * max(np.abs(value).max(), 1e-9)
            move = -vector @ ((vector.T @ g) / size)
            move *= min(1.0, 0.5 / max(np.abs(move).max(), 1e-300))
            trial = at + move
            trial[2] = np.clip(trial[2], *SHAPES)
            done = bool(np.abs(trial - at).max() < 1e-7)
        out.append((r["key"], list(map(float, trial)), best, float(lam), done))
    return pd.DataFrame(out, columns=["key", "trial", "best", "lam", "done"])


def fit(scores: DataFrame, steps: int = 80) -> DataFrame:
    """key, n, loc, scale, shape, nll of the scores (key, x) of each key, zeros and nulls left out.

    Likelihood and derivatives are sums over a key's scores, so each step is one aggregation over all keys that haven't
    arrived; a key is a row of numbers in between, and none is ever gathered. Steps begin at a Gumbel distribution
    of the same mean and deviation. Keys with fewer than four scores, or equal ones only, have no distribution.
    """
    shared_dir(scores.sparkSession)
    rows = scores.where("key is not null and x is not null and x <> 0").groupBy("key", F.col("x").cast("double").alias("x")).agg(F.count("*").alias("w"))
    mean = F.sum(F.col("x") * F.col("w")) / F.sum("w")
    moments = rows.groupBy("key").agg(F.sum("w").alias("n"), mean.alias("m"), F.min("x").alias("lo"), F.max("x").alias("hi")).where("n >= 4 and hi > lo")
    spread = rows.join(moments, "key").groupBy("key").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.sqrt(F.sum(F.col("w") * F.pow(F.col("x") - F.col("m"), F.lit(2))) / (F.first("n") - 1)).alias("d"))
    spread = spread.checkpoint()
    even = rows.join(spread, "key").select("key", ((F.col("x") - F.col("m")) / F.col("d")).alias("y"), "w").checkpoint()
    start = [float(x) for x in (-0.5772156649 * 6**0.5 / np.pi, np.log(6**0.5 / np.pi), 0.0)]
    state = spread.select("key", F.array(*map(F.lit, start)).alias("trial"), F.lit(None).cast("array<double>").alias("best"), F.lit(1e-2).alias("lam"), F.lit(False).alias("done"))
    arrived: list[DataFrame] = []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield _step(f)

    for _ in range(steps):
        at = [F.col("trial")[i] for i in range(3)]
        sums = [F.sum(F.col("w") * negative_log_density(F.col("y"), at[0] + a * _H, F.exp(at[1] + b * _H), at[2] + c * _H)) for a, b, c in _STENCIL]
        told = even.join(state.select("key", "trial", "best", "lam"), "key").groupBy("key").agg(*[F.first(c).alias(c) for c in ("trial", "best", "lam")], F.array(*sums).alias("sums"))
        kind = state.schema["key"].dataType.simpleString()
        state = told.select("key", "trial", "best", "lam", "sums").mapInPandas(run, f"key {kind}, trial array<double>, best array<double>, lam double, done boolean").checkpoint()
        arrived.append(state.where("done"))
        state = state.where("not done")
        if state.isEmpty():
            break
    arrived.append(state)
    every = arrived[0]
    for a in arrived[1:]:
        every = every.union(a)
    b = F.col("best")
    found = every.where("best is not null").join(spread, "key")
    return found.select("key", "n", (F.col("m") + F.col("d") * b[1]).alias("loc"), (F.col("d") * F.exp(b[2])).alias("scale"), b[3].alias("shape"), (b[0] + F.col("n") * F.log("d")).alias("nll"))


def cutoffs(scores: DataFrame, p: float) -> DataFrame:
    """key, cutoff: the score that a key's distribution exceeds with probability p. p = 1 and above: 0; p = 0 and below, or
    where there is no distribution: the largest score (0 without any but zeros)."""
    most = scores.groupBy("key").agg(F.coalesce(F.max(F.when(F.col("x") != 0, F.col("x"))), F.lit(0.0)).cast("double").alias("most"))
    if p >= 1:
        return most.select("key", F.lit(0.0).alias("cutoff"))
    if p <= 0:
        return most.select("key", F.col("most").alias("cutoff"))
    y = float(-np.log1p(-p))
    level = F.when(F.abs("shape") < 1e-7, F.col("loc") - F.col("scale") * float(np.log(y))).otherwise(F.col("loc") + F.col("scale") * (F.pow(F.lit(y), -F.col("shape")) - 1) / F.col("shape"))
    return most.join(fit(scores).select("key", level.alias("level")), "key", "left").select("key", F.coalesce("level", "most").alias("cutoff"))
