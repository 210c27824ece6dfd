"""The registered model queries run at the full tree, trial and fold counts."""

import pytest

from tenura.operators import models
from tenura.plans import queries


class Asked(Exception):
    pass


@pytest.fixture
def parts(monkeypatch):
    monkeypatch.setattr(queries, "_parts", lambda *_: ("train", "test", "columns"))


@pytest.mark.parametrize("name", ["gbt_scores", "tree_attribution"])
def test_fits_use_all_trees(parts, monkeypatch, name):
    fit = models.fit_boosted

    def asked(train, columns, params=fit.__defaults__[0], *_):
        raise Asked(params)

    monkeypatch.setattr(models, "fit_boosted", asked)
    with pytest.raises(Asked) as found:
        queries.QUERIES[name](None, "")
    params = found.value.args[0]
    assert params == models.BoostedParams() and (params.n_trees, params.max_depth) == (500, 6)


def test_search_uses_all_trials_and_folds(parts, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "search_boosted", lambda train, columns, trials, k=models.SEARCH_FOLDS: seen.append((trials, k)))
    queries.QUERIES["search_trials"](None, "")
    (trials, k), = seen
    assert len(trials) == 20 and k == 3 and all(t.n_trees == 300 for t in trials)
