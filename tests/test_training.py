"""The registered training queries fit what is published."""

import pytest

from suite import encoding
from tidemark.operators import train as T


class Stop(Exception):
    pass


class Rows:
    def count(self):
        return 10


@pytest.fixture
def fitted(monkeypatch):
    """Parameters of the estimators that are asked for, instead of fits."""
    seen = {}

    def instead(name):
        def stop(*args, **params):
            seen[name] = params
            raise Stop

        monkeypatch.setattr(T, name, stop)

    for name in ("logistic_regression", "random_forest", "boosted_trees"):
        instead(name)
    monkeypatch.setattr(encoding, "_training", lambda spark, sf: (Rows(), Rows()))
    return seen


@pytest.mark.parametrize("name", ["train_score_lr", "batch_scoring", "baseline_row"])
def test_regressions_have_all_iterations(fitted, name):
    with pytest.raises(Stop):
        getattr(encoding, name)(None, "")
    assert fitted["logistic_regression"]["maxIter"] == 100


def test_trees_have_all_rounds(fitted):
    for name in ("train_score_forest", "train_score_gbt"):
        with pytest.raises(Stop):
            getattr(encoding, name)(None, "")
    assert fitted["random_forest"]["numTrees"] == 100
    assert fitted["boosted_trees"]["maxIter"] == 100 and fitted["boosted_trees"]["maxDepth"] == 6


def test_search_draws_from_the_published_space(monkeypatch):
    seen = []
    sample = T.sample_params

    def draw(space, trials, seed=42):
        seen.append((space, sample(space, trials, seed)))
        raise Stop

    monkeypatch.setattr(encoding, "_training", lambda spark, sf: (Rows(), Rows()))
    monkeypatch.setattr(T, "boosted_trees", lambda *a, **k: None)
    monkeypatch.setattr(T, "sample_params", draw)
    with pytest.raises(Stop):
        encoding.hpo_random(None, "")
    space, draws = seen[0]
    assert space == T.SEARCH_SPACE and len(draws) == 4
