"""The subsequence kernel, its landmarks and the folded decision against direct enumeration."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tenura.llm import toxicity

TEXTS = ["you are such an id1ot", "i.d.i.o.t you", "a calm clear day by the sea", "what an idxiot he is", "ÉCOLE über 日本 text"]


def plain(codes, at):
    """Weights of all subsequences of four characters with at most one further character in each gap."""
    found = Counter()
    for places in combinations(range(at, min(at + toxicity.STARTS + 6, len(codes))), 4):
        steps = [b - a for a, b in zip(places, places[1:])]
        if places[0] < at + toxicity.STARTS and max(steps) <= 2:
            found[tuple(int(codes[p]) for p in places)] += 0.75 ** sum(s - 1 for s in steps)
    return found


def dot(a, b):
    return sum(w * b[k] for k, w in a.items())


@pytest.fixture(scope="module")
def windows():
    codes, starts = toxicity.folded(TEXTS)
    rnd = random.Random(3)
    at = np.array(sorted(rnd.sample(range(len(codes) - toxicity.PAD - toxicity.STARTS), 30)))
    return codes, at, [plain(codes, a) for a in at]


def test_features_are_the_nystroem_map_of_the_kernel(windows):
    codes, at, found = windows
    vectors = toxicity._vectors(codes, at)
    some = list(range(0, 30, 4))
    marks = toxicity.Landmarks(vectors[some])
    unit = [Counter({k: w / dot(found[i], found[i]) ** 0.5 for k, w in found[i].items()}) for i in some]
    gram = np.array([[dot(a, b) for b in unit] for a in unit])
    to_marks = np.array([[dot(f, u) for u in unit] for f in found])
    want = to_marks @ np.linalg.pinv(gram, rcond=1e-6, hermitian=True) @ to_marks.T
    features = marks.features(vectors)
    assert np.allclose(features @ features.T, want, atol=1e-8)
    # between a window and a landmark the approximation is the kernel itself
    exact = np.array([[dot(a, found[i]) for i in some] for a in found])
    assert np.allclose((features @ features.T)[:, some], exact, atol=1e-5)


def test_the_folded_decision_is_that_of_the_machine(windows):
    codes, at, _ = windows
    vectors = toxicity._vectors(codes, at)
    marks = toxicity.Landmarks(vectors[::3])
    weight = np.random.default_rng(1).normal(size=marks.root.shape[1])
    assert np.allclose(toxicity.decisions(marks.fold(weight), codes)[at], marks.features(vectors) @ weight, atol=1e-3)


def test_gapped_and_inserted_letters_stay_close():
    def like(a, b):
        codes, starts = toxicity.folded([a, b])
        x, y = plain(codes, starts[0]), plain(codes, starts[1])
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    assert like("idiot", "i.d.i.o.t") == pytest.approx(1.0) and like("idiot", "ID10T") == pytest.approx(1.0)
    # wherever a text stands among others
    alone = toxicity.folded(["i.d.i.o.t"])[0]
    codes, starts = toxicity.folded(["x y", "i.d.i.o.t", "z"])
    assert np.array_equal(codes[starts[1] : starts[2]], alone)
    assert like("idiot", "idxiot") > 0.4 > like("idiot", "sunny")


def test_the_machine_reaches_the_least_loss():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 3))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=80) > 0.4, 1.0, -1.0)
    share = np.where(y > 0, 100 / (y > 0).sum(), 100 / (y < 0).sum())

    def loss(w, b):
        return 0.5 * w @ w + (share * np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum()

    w, b = toxicity.svm(x, y)
    for _ in range(300):
        assert loss(w, b) <= loss(w + rng.normal(size=3) * 0.01, b + rng.normal() * 0.01) + 1e-3
