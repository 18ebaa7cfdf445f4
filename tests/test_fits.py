"""The model queries learn from every labelled row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwise import config
from cartwise.operators import models
from cartwise.plans import registry

ROWS = 120_000


@pytest.fixture(scope="module")
def many(spark):
    """More rows than a fit was bounded to; few bought, by X1 and X4."""
    n = F.col("id")
    made = {"customer_id": n % 500, "item_id": (n / 500).cast("long"), "Y": ((n % 40 == 0) | (n % 8 > 6) & (n % 7 == 2)).cast("int")}
    features = {c: (n % (3 + 2 * i)).cast("double") for i, c in enumerate(config.FEATURE_COLUMNS)}
    return spark.range(ROWS).select(*[c.alias(name) for name, c in (made | features).items()]).cache()


def learned_from(spark, model, path) -> float:
    """The rows that the trees of a model were grown from, on average; for a regression the
    rows that its penalty of 1 / rows stands for."""
    fitted = model.stages[-1]
    if hasattr(fitted, "coefficients"):
        return 1 / fitted.getRegParam()
    models.save_model(model, str(path))
    roots = models.tree_nodes(spark, str(path)).where("node = 0")
    return roots.agg(F.avg("n_rows")).first()[0]


# Rows that a tree sees of all: 80 % of them in boosting, 70 % where tuned.
@pytest.mark.parametrize(
    ("name", "kind", "params", "share"),
    [
        ("train_logistic", "logistic", {"maxIter": 3}, 1),
        ("train_random_forest", "random_forest", {"numTrees": 3, "maxDepth": 2}, 1),
        ("train_gbt_lgbm", "lightgbm", {"maxIter": 2, "maxDepth": 2}, 0.8),
        ("train_gbt_xgb", "xgboost", {"maxIter": 2, "maxDepth": 2}, 0.8),
        ("train_gbt_tuned", "lightgbm", {**models.TUNED_PARAMS, "maxIter": 2, "maxDepth": 2}, 0.7),
    ],
)
def test_fits_learn_from_all_rows(spark, many, tmp_path, monkeypatch, name, kind, params, share):
    monkeypatch.setattr(registry, "staged_features", lambda *_: many)
    model = registry._fit(kind, spark, "nowhere", params)
    assert learned_from(spark, model, tmp_path / "model") == pytest.approx(ROWS * share, rel=0.02)


def _train_all_quickly(monkeypatch, many):
    quick = {"logistic": {"maxIter": 3}, "random_forest": {"numTrees": 3, "maxDepth": 2}}
    quick |= dict.fromkeys(("xgboost", "lightgbm"), {"maxIter": 2, "maxDepth": 2})
    monkeypatch.setattr(registry, "staged_features", lambda *_: many)
    for kind, params in quick.items():
        monkeypatch.setitem(models._DEFAULTS, kind, {**models._DEFAULTS[kind], **params})


def test_train_all_learns_from_all_rows(spark, many, tmp_path, monkeypatch):
    _train_all_quickly(monkeypatch, many)
    fitted = []
    rank = models.predict_and_rank
    monkeypatch.setattr(models, "predict_and_rank", lambda model, *a, **k: fitted.append(model) or rank(model, *a, **k))
    assert [r.error for r in registry.train_all(spark, "nowhere").collect()] == [None] * 24
    found = sorted(learned_from(spark, m, tmp_path / str(i)) / ROWS for i, m in enumerate(fitted))
    assert found == pytest.approx([0.8, 0.8, 1, 1], rel=0.02)


def test_training_accuracy_is_of_a_fit_on_all_rows(spark, many, monkeypatch):
    monkeypatch.setattr(registry, "staged_features", lambda *_: many)
    fitted = []
    accuracy = models.training_accuracy
    monkeypatch.setattr(models, "training_accuracy", lambda model, table: fitted.append(model) or accuracy(model, table))
    assert 0.9 < registry.training_accuracy(spark, "nowhere").first().accuracy <= 1
    assert 1 / fitted[0].stages[-1].getRegParam() == pytest.approx(ROWS)
