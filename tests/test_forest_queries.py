"""The forest queries, and what must hold of the full forest on the real price."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from shelflens.plans import price_model
from workload.registry import products

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


def test_forest_queries(spark):
    def rows(name):
        return entry.queries()[name](spark, FOLDER).collect()

    found = {r.id: r for r in rows("holdout_predictions")}
    plain = {r.id: r for r in rows("plain_holdout_predictions")}
    assert {i: r.actual_price for i, r in found.items()} == {i: r.actual_price for i, r in plain.items()}
    whole = {r.id: r for r in rows("forest_holdout_predictions")}
    assert {i: r.predicted_price for i, r in whole.items() if r.part == "holdout"} == {i: r.predicted_price for i, r in found.items()}
    assert {"reviews_count", "brand_name", "is_top_brand"} <= set(next(iter(whole.values())).asDict())
    held = {r.part: r for r in rows("forest_metrics")}["holdout"]
    errors = [abs(r.actual_price - r.predicted_price) for r in found.values()]
    assert held["rows"] == len(found) and held.mae == pytest.approx(sum(errors) / len(found), rel=1e-6)
    assert held.rmse == pytest.approx((sum(e * e for e in errors) / len(found)) ** 0.5, rel=1e-6)
    assert len(rows("actual_vs_predicted")) == len(found) and len(rows("forest_actual_vs_predicted")) == len(whole)
    weights = rows("feature_importance")
    assert sum(r.importance for r in weights) == pytest.approx(1.0, abs=1e-4) and min(r.importance for r in weights) >= 0
    assert [r.original_feature for r in weights] == [r.original_feature for r in rows("importance_bars")][::-1]


def test_full_forest(spark):
    """300 trees of depth 30 on every feature: averages of the training prices' logs, not one price per brand."""
    goods = products(spark, FOLDER)
    table = price_model.model_table(goods).cache()
    train = table.where("part = 'train'")
    model = price_model.fit_price_model(train)
    forest = model.pipeline.stages[-1]
    assert (forest.getNumTrees, forest.getMaxDepth()) == (300, 30)
    found = price_model.predict(model, table.where("part <> 'train'")).collect()
    prices = [r.price for r in train.select("price").collect()]
    assert all(min(prices) - 1e-6 <= r.predicted_price <= max(prices) + 1e-6 for r in found)
    assert len({round(r.predicted_price, 4) for r in found}) > len(found) // 2
    weights = price_model.feature_importance(model, table).collect()
    assert sum(r.importance for r in weights) == pytest.approx(1.0) and min(r.importance for r in weights) >= 0
