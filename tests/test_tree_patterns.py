"""Attribution works out the patterns of a tree's leaves together, not leaf by leaf and batch by batch."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest

from tenura.operators import attribution


def chain(depth, features):
    """A tree whose left children are leaves; node k splits feature k modulo ``features`` at 0."""
    size = 2 * depth + 1
    tree = {n: [] for n in ("feature", "threshold", "rule", "left", "right", "value", "cover")}
    for node in range(size):
        inner = node % 2 == 0 and node < size - 1
        tree["feature"].append(node // 2 % features if inner else -1)
        tree["threshold"].append(float(node // 2 // features))
        tree["rule"].append(None)
        tree["left"].append(node + 1 if inner else -1)
        tree["right"].append(node + 2 if inner else -1)
        tree["value"].append(0.0 if inner else float(node * node % 7 - 3))
        tree["cover"].append(float(depth - node // 2 + 1) if node % 2 == 0 else 1.0)
    return tree


def worth(tree, x, known, node=0):
    f = tree["feature"][node]
    if f < 0:
        return tree["value"][node]
    left, right = tree["left"][node], tree["right"][node]
    if f in known:
        return worth(tree, x, known, left if x[f] <= tree["threshold"][node] else right)
    return sum(tree["cover"][c] * worth(tree, x, known, c) for c in (left, right)) / tree["cover"][node]


def brute_force(tree, x):
    m, out = len(x), np.zeros(len(x))
    for f in range(m):
        rest = [g for g in range(m) if g != f]
        for s in range(m):
            w = factorial(s) * factorial(m - s - 1) / factorial(m)
            out[f] += sum(w * (worth(tree, x, {*c, f}) - worth(tree, x, set(c))) for c in combinations(rest, s))
    return out


@pytest.mark.parametrize(("depth", "features"), [(3, 3), (6, 4), (10, 10)])
def test_batches_equal_enumeration(depth, features):
    """Paths of few features, of repeated features, and of more features than have all their patterns worked out."""
    tree = chain(depth, features)
    x = np.random.default_rng(depth).integers(-1, 3, (5, features)).astype(float)
    phi, _ = attribution.attribute_batch(x, [tree], features)
    for row, found in zip(x, phi):
        assert found == pytest.approx(brute_force(tree, row), abs=1e-12)


def test_patterns_are_worked_out_once_a_tree_and_rows_are_not_sorted(monkeypatch):
    tree, calls, whole = chain(8, 8), [], attribution._path_values
    monkeypatch.setattr(attribution, "_path_values", lambda *a: calls.append(1) or whole(*a))
    monkeypatch.setattr(np, "unique", lambda *a, **k: pytest.fail("rows were sorted"))
    attribution.attribute_batch(np.zeros((4, 8)), [tree], 8)
    assert len(calls) == 8  # one for each length of a path; the two longest share theirs
