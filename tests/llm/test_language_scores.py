"""Languages of texts against features taken byte by byte and labels enumerated one by one."""

import itertools
import math

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strandloom.llm import language
from strandloom.llm import textbuf as tb

SPACE = b"\t\n\x0b\x0c\r "


def word_rows(word):
    """Places in the weight table of a word's features: three bytes around each byte, the first three, the last three, the word."""
    padded = b" " + word + b" "
    keys = [int.from_bytes(padded[i : i + 3], "little") for i in range(len(word))]
    keys.append(int.from_bytes(word[:3], "little") | 1 << 24)
    last = word[-3:]
    keys.append(int.from_bytes(b"\0" * (3 - len(last)) + last, "little") | 2 << 24)
    buf = np.frombuffer(word + b"\n", np.uint8)
    keys.append(int(tb.hashes(buf, np.array([0]), np.array([len(word)]))[0]) | 1 << 63)
    return [int(tb.mix(np.array([k], np.uint64))[0] & np.uint64(language.TABLE - 1)) for k in keys]


def brute(text, model):
    low = bytes(c + 32 if 65 <= c < 91 else c for c in (text or "").encode())
    k = len(model.names)
    sums = np.zeros(k)
    for line in low.split(b"\n"):
        words = [w for w in bytes(32 if c in SPACE else c for c in line).split(b" ") if w]
        if not words:
            continue
        e = np.array([sum(model.table[r] for r in word_rows(w)) for w in words])
        total, at = 0.0, np.zeros((len(words), k))
        for labels in itertools.product(range(k), repeat=len(words)):
            p = math.exp(sum(e[i, a] for i, a in enumerate(labels)) + sum(model.transition[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            total += p
            for i, a in enumerate(labels):
                at[i, a] += p
        sums += (at / total).sum(axis=0)
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    best = int(np.argmax(np.round(sums, 9)))
    return model.names[best], sums[best] / sums.sum()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.text(alphabet=st.sampled_from(list("abAé日7.- \t\x0b")), max_size=14), max_size=3), min_size=1, max_size=3), st.integers(0, 10**6), st.integers(1, 3))
def test_predictions_by_enumeration(texts, seed, k):
    r = np.random.default_rng(seed)
    model = language.WordModel([f"l{i}" for i in range(k)], r.normal(scale=0.5, size=(language.TABLE, k)), r.normal(size=(k, k)))
    whole = ["\n".join(t) for t in texts]
    names, share = model.predict(pa.array([*whole, None], pa.string()))
    for t, n, s in zip([*whole, None], names, share, strict=True):
        want, p = brute(t, model)
        assert n == want and abs(s - p) < 1e-9


def test_training_learns_words_and_changes():
    texts = ["the cat and the dog", "le chat et le chien", "the dog sat", "le chien dort"] * 10
    model = language.train(texts, ["en", "fr"] * 20)
    names, share = model.predict(pa.array(["the cat sat", "le chat dort", "the dog and the cat le chat et le chien dort", ""]))
    assert names[:2] == ["en", "fr"] and share[0] > 0.9 and share[1] > 0.9 and names[3] == "und"
    p, _ = model.words(pa.array(["the dog sat\nle chien dort"]))
    assert (p[:3].argmax(axis=1) == 0).all() and (p[3:].argmax(axis=1) == 1).all()
    # a language stays rather than changes
    assert model.transition[0, 0] > model.transition[0, 1] and model.transition[1, 1] > model.transition[1, 0]
