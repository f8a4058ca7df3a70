"""Registered model queries train what the reference trains."""

import pytest

from lodgecurve.checks import queries as q
from lodgecurve.checks import registry


class Asked(Exception):
    pass


def stop(*args, **kwargs):
    raise Asked(args, kwargs)


@pytest.mark.parametrize("name, maker", [("gbt_scores", "boosted_trees"), ("forest_scores", "random_forest"), ("tree_importance", "boosted_trees"), ("permutation_importance", "boosted_trees")])
def test_trees_are_as_many_as_the_reference_has(monkeypatch, name, maker):
    made, names = getattr(q.learning, maker), ["listing_price"]
    monkeypatch.setattr(q, "model_rows", lambda *a: (None, None, names))
    monkeypatch.setattr(q.learning, maker, lambda *a, **k: stop(a, k))
    with pytest.raises(Asked) as asked:
        registry.QUERIES[name](None, None)
    args, settings = asked.value.args[0]
    assert not args and settings.get("trees", made.__defaults__[1]) == 200


@pytest.mark.parametrize("name", ["solution_status", "lift_report", "portfolio_kpis", "weekend_premium"])
def test_every_price_query_has_a_full_grid(monkeypatch, name):
    monkeypatch.setattr(q, "held", lambda *a: None)
    monkeypatch.setattr(q, "solved", stop)
    with pytest.raises(Asked) as asked:
        registry.QUERIES[f"{name}_full_grid"](None, None)
    assert asked.value.args[0] == (None, 500)
