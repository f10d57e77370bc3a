"""The chosen-path join against all pairs."""

import re

import numpy as np
import pytest

from strandloom.llm import setjoin
from tests.llm.test_operators import SCHEMA, table

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, k=2):
    """For each row (doc_id, text) the size of its set and the least doc_id of its component."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        least = (min(ids) if ids else None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "en", "s", 1, 2, 3, "z", "q") for i, x in rows], SCHEMA).repartition(4)


def run(docs, **more):
    return sorted(map(tuple, setjoin.near_duplicates(docs, **more).collect()), key=repr)


def changed(words, n, seed):
    r = np.random.default_rng(seed)
    w = list(words)
    for at in r.choice(len(w), n, replace=False):
        w[at] = f"new{seed}x{at}"
    return " ".join(w)


def family(seed, members, most):
    base = [f"w{seed}x{i}" for i in range(60)]
    return [changed(base, int(np.random.default_rng(1000 * seed + m).integers(0, most)), 1000 * seed + m) for m in range(members)]


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in table()] + [(40, "A b"), (41, "a  B"), (42, "one"), (43, "ONE "), (None, "one two three"), (None, "nobody else"), (None, "nobody else"), (44, " "), (7, "")]
    out = run(frame(spark, rows))
    assert out == brute(rows)


@pytest.mark.parametrize("members", [0, 5])
def test_families(spark, monkeypatch, members):
    # with few members to a node, trees branch to their depth and what is left is compared in blocks
    if members:
        monkeypatch.setattr(setjoin, "MEMBERS", members)
    texts = [x for seed in range(12) for x in family(seed, 25, 8)] + [" ".join(f"lone{i}x{j}" for j in range(30)) for i in range(40)]
    rows = list(enumerate(texts + texts[:60]))
    assert run(frame(spark, rows), depth=3 if members else setjoin.DEPTH) == brute(rows)


def test_template_family_loses_no_link(spark):
    # slots of a template differ at random, so links of just 0.8 and pairs just below it are mixed
    r = np.random.default_rng(5)
    rows = []
    for i in range(300):
        w = [f"t{j}" for j in range(50)]
        for at in (7, 21, 35):
            w[at] = f"v{r.integers(0, 12)}"
        if r.random() < 0.5:
            w[44] = f"z{r.integers(0, 12)}"
        rows.append((i, " ".join(w)))
    assert run(frame(spark, rows)) == brute(rows)


def test_the_limit_itself(spark):
    # 8 of 10 shingles in common is linked, 7 of 9 isn't
    a = " ".join(f"a{i}" for i in range(10))
    rows = [(1, a), (2, a.replace("a9", "b9")), (3, " ".join(f"c{i}" for i in range(10))), (4, " ".join(f"c{i}" for i in range(9)) + " d"), (5, " ".join(f"c{i}" for i in range(8)) + " e f")]
    assert run(frame(spark, rows)) == brute(rows)


def test_empty_tables(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(frame(spark, [(1, None), (2, "")])) == [(1, 0, 1, True), (2, 0, 2, True)]
