"""A gold run shuffles the readings once, and its marts do not wait for each other."""

import threading

import pytest
from conftest import DATA

from strata.plans import loads, medallion, stateful


def test_marts_use_added_up_measures_and_overlap(spark, monkeypatch):
    plans, second = {}, threading.Event()
    load_full = loads.load_full

    def watched(source, root, *rest, **more):
        name = root.rsplit("/", 1)[1]
        if name != "site_day":
            plans[name] = source._jdf.queryExecution().optimizedPlan().toString()
            if len(plans) > 1:
                second.set()
            assert second.wait(60), "the first mart was loaded alone"
        return load_full(source, root, *rest, **more)

    monkeypatch.setattr(loads, "load_full", watched)
    base = stateful._layers(spark, f"{DATA}/sf0.001")
    assert len(plans) == 9
    for name, plan in plans.items():
        again = [line for line in plan.splitlines() if "Aggregate [site_id" in line and "production_date" in line.split("]")[0]]
        assert not again, f"{name} adds up sites and days once more"
    rows = medallion.gold(spark, base, "production_by_site")
    assert rows.count() == rows.select("site_id", "production_date").distinct().count() == medallion.gold(spark, base, "site_day").count()


def test_an_error_of_one_step_is_raised_after_the_others_ended():
    done = []

    def fails():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        medallion._together({"a": fails, "b": lambda: done.append("b")})
    assert done == ["b"]
