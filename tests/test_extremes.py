"""Fits of extreme-value distributions against a search around them, and the cutoffs that follow."""

import numpy as np
import pytest

from strandloom.operators import extremes, partitions


def nll(x, loc, scale, shape):
    z = (x - loc) / scale
    if abs(shape) < 1e-7:
        return float(np.sum(np.log(scale) + z + np.exp(-z)))
    t = 1 + shape * z
    return float(np.sum(np.log(scale) + (1 + 1 / shape) * np.log(t) + t ** (-1 / shape))) if (t > 0).all() else np.inf


def searched(x, at, wide=0.3, rounds=60):
    """The least value that a shrinking random search finds around a point."""
    r = np.random.default_rng(0)
    best, f = np.array(at), nll(x, *at)
    for _ in range(rounds):
        for step in r.normal(size=(60, 3)) * [wide * best[1], wide * best[1], wide]:
            p = best + step
            if p[1] > 0 and -1 < p[2] < 5 and (g := nll(x, *p)) < f:
                best, f = p, g
        wide *= 0.85
    return f


@pytest.fixture(scope="module")
def scores():
    r = np.random.default_rng(4)
    out = {}
    for k, (n, loc, scale, shape) in enumerate([(400, 10, 2, 0.0), (300, -5, 0.1, 0.3), (500, 1000, 50, -0.25), (25, 3, 1, 0.1), (2000, 0.5, 1, 0.6)]):
        y = -np.log(r.random(n))
        out[f"m{k}"] = np.round(loc + scale * ((y**-shape - 1) / shape if shape else -np.log(y)), 6)
    return out


def test_no_point_nearby_is_likelier(spark, scores):
    rows = [(k, float(v)) for k, x in scores.items() for v in x] + [("m0", 0.0), ("m0", None), (None, 3.0), ("few", 1.0), ("few", 2.0), ("few", 3.0), *[("same", 7.0)] * 9]
    t = spark.createDataFrame(rows, "key string, x double").repartition(3)
    got = {r.key: r for r in extremes.fit(t).collect()}
    assert set(got) == set(scores)
    for k, x in scores.items():
        r = got[k]
        assert r.n == len(x) and abs(nll(x, r.loc, r["scale"], r.shape) - r.nll) < 1e-4
        start = [x.mean() - 0.45 * x.std(), 0.78 * x.std(), 0.01]
        assert r.nll <= min(searched(x, [r.loc, r["scale"], r.shape]), searched(x, start)) + 1e-3
    cut = {r.key: r.cutoff for r in extremes.cutoffs(t.where("key is not null"), 0.05).collect()}
    for k, x in scores.items():
        r = got[k]
        y = -np.log(0.95)
        want = r.loc + r["scale"] * ((y**-r.shape - 1) / r.shape)
        assert abs(cut[k] - want) < 1e-6 * max(1, abs(want)) and 0.01 < (x > cut[k]).mean() < 0.12
    assert cut["few"] == 3 and cut["same"] == 7
    assert {r.cutoff for r in extremes.cutoffs(t, 1.0).collect()} == {0.0} and {r.key: r.cutoff for r in extremes.cutoffs(t, 0.0).collect()}["m0"] == scores["m0"].max()


def test_cutoffs_of_models_and_columns(spark, scores):
    hits = spark.createDataFrame([(k, float(v), None) for k, x in scores.items() for v in x], "name string, bitscore double, evalue double")
    cut = {r.name: r.cutoff for r in partitions.gev_cutoffs(hits, 0.1).collect()}
    kept = {(r.name, r.bitscore) for r in partitions.score_cutoff(hits, -1e9, 0.0, 0.1).collect()}
    assert kept == {(k, float(v)) for k, x in scores.items() for v in x if v >= cut[k]}
    r = np.random.default_rng(6)
    m = r.gumbel(5, 2, (12, 12))
    m[3, :] = 0
    cells = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(12) for j in range(12)], "i long, j long, val double")
    got = {(r.i, r.j): r.sig for r in partitions.significance_matrix(cells, 0.2).collect()}
    assert all(got[i, i] == 1 for i in range(12)) and 12 < sum(got.values()) < 60
    for j in range(12):
        high, low = ([m[i, j] for i in range(12) if i != j and got[i, j] == k] for k in (1, 0))
        assert not high or min(high) > max(low)
