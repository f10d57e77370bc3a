"""Scores of the line model against features counted by hand and labels enumerated one by one."""

import itertools
import math

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strandloom.llm import quality

KINDS = [str.isupper, str.islower, str.isdigit, lambda c: c in ".,;:?'\"()-", lambda c: c in "#$%&*+/<=>@[]\\^_`{}~", lambda c: c == "|", lambda c: c == "!"]
SPACE = "\t\n\x0b\x0c\r "


def own_features(line):
    """Of a line with words; ASCII only."""
    words = [w for w in "".join(" " if c in SPACE else c for c in line).split(" ") if w]
    lo, hi = line.index(words[0]), line.rindex(words[-1]) + len(words[-1])
    span = line[lo:hi]
    low = [w.lower() for w in words]
    n = len(words)
    sums = [
        sum(a == b for a, b in zip(low, low[1:], strict=False)), n - len(set(low)), sum(len(w) > 1 and (KINDS[4](w[-1]) or w[-1] == "!") for w in words),
        sum(w[0] == "|" for w in words), sum(w[0].isupper() for w in words), sum(len(w) for w in words) / 8,
    ]
    return [sum(map(k, span)) / len(span) for k in KINDS] + [x / n for x in sums] + [min(n, 60) / 60, math.log(len(span)) / 8, float(span[-1] in "!.?")], len(span)


def brute_score(text, model):
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    if not lines:
        return model.none
    own, size = zip(*map(own_features, lines), strict=True)
    none = [0.0] * 16
    rows = [[*own[i], *(own[i - 1] if i else none), *(own[i + 1] if i + 1 < len(own) else none), 1.0] for i in range(len(own))]
    emission = np.array(rows) @ model.weights
    total, good = 0.0, np.zeros(len(lines))
    for labels in itertools.product((0, 1), repeat=len(lines)):
        w = math.exp(sum(emission[i, k] for i, k in enumerate(labels)) + sum(model.transition[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        total += w
        good += w * np.array(labels)
    p = float(np.dot(good / total, size) / sum(size))
    p = min(max(p, 1e-6), 1 - 1e-6)
    return 1 / (1 + math.exp(-(model.slope * math.log(p / (1 - p)) + model.offset)))


TEXTS = st.lists(st.text(alphabet=st.sampled_from(list("aabB12.!?|#$- \t\n\n,Zz")), max_size=60), min_size=1, max_size=4)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(0, 10**6))
def test_scores_by_enumeration(texts, seed):
    r = np.random.default_rng(seed)
    texts = ["\n".join(t.split("\n")[:9]) for t in texts]
    model = quality.LineModel(r.normal(size=(49, 2)), r.normal(size=(2, 2)), float(r.normal()), float(r.normal()), 0.3)
    got = model.score(pa.array([*texts, None], pa.string()))
    assert np.allclose(got, [*[brute_score(t, model) for t in texts], 0.3], atol=1e-9)


def test_training_climbs_the_likelihood_of_what_is_seen():
    """The latent-label likelihood, by enumeration, is higher at the trained weights than at none and than nearby."""
    good, bad = "The cat sat on a mat.\nIt was warm there.", "WIN $$ NOW !!\n### click || click !!"
    texts, labels = [good, bad, good.replace("cat", "dog"), bad.replace("WIN", "GET")] * 3, [1, 0, 1, 0] * 3

    def objective(model):
        out = 0.0
        for text, y in zip(texts, labels, strict=True):
            x, _, _ = quality.line_features(pa.array([text], pa.large_string()))
            e = x @ model.weights
            free = held = 0.0
            for k in itertools.product((0, 1), repeat=len(e)):
                w = math.exp(sum(e[i, a] for i, a in enumerate(k)) + sum(model.transition[a, b] for a, b in zip(k, k[1:], strict=False)))
                free += w
                held += w * math.prod(1 - quality.NOISE if a == y else quality.NOISE for a in k)
            out += math.log(held / free)
        n = sum(len(t.split("\n")) for t in texts)
        return out / n - 1e-3 / 2 * (model.weights**2).sum() - quality.RIGID / 2 * (model.transition**2).sum()

    model = quality.train(texts, labels, steps=400)
    best = objective(model)
    assert best > objective(quality.LineModel(np.zeros((49, 2)), np.zeros((2, 2))))
    r = np.random.default_rng(1)
    for _ in range(20):
        near = quality.LineModel(model.weights + r.normal(scale=0.05, size=(49, 2)), model.transition + r.normal(scale=0.05, size=(2, 2)))
        assert objective(near) < best + 1e-4
    assert [int(p >= 0.5) for p in model.score(pa.array(texts))] == labels
