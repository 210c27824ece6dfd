"""Training and deciding hold a run of texts at a time, and the run's size changes nothing."""

import random
import tracemalloc

import numpy as np
import pytest

from tenura.llm import toxicity

WORDS = ["calm", "river", "über", "market", "i.d.i.o.t", "stone", "wool", "日本", "paper", "light", "a", "of"]


def some_texts(count, words, toxic, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(count):
        text = [rnd.choice(WORDS) + rnd.choice("abcdefgh") for _ in range(rnd.randint(0, words))]
        out.append(" ".join(text + ["you id1ot"] * toxic))
    return out


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_training_holds_a_run_of_texts():
    toxic, clean = some_texts(200, 2500, 1, 1), some_texts(200, 2500, 0, 2)
    assert peak_mb(lambda: toxicity.train(toxic, clean, toxic[:50], clean[:50])) < 90


def test_spread_holds_few_windows():
    vectors = np.random.default_rng(0).integers(0, toxicity.SIZE, (2000, 48)).astype(np.uint32)
    assert peak_mb(lambda: toxicity._spread(vectors, 4)) < 60


@pytest.mark.parametrize("run", [1, 300])
def test_runs_change_no_model_and_no_summary(monkeypatch, run):
    lists = [some_texts(12, 60, 1, 3), some_texts(12, 60, 0, 4), some_texts(5, 60, 1, 5), ["", *some_texts(5, 60, 0, 6)]]
    whole = toxicity.train(*lists)
    values = toxicity.summaries(whole.weights, whole.bias, lists[0] + [""] + lists[1])
    monkeypatch.setattr(toxicity, "RUN_CHARS", run)
    cut = toxicity.train(*lists)
    assert np.array_equal(whole.weights, cut.weights) and whole.bias == cut.bias and np.array_equal(whole.curve, cut.curve)
    assert np.array_equal(values, toxicity.summaries(whole.weights, whole.bias, lists[0] + [""] + lists[1]))
