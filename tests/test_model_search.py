import pytest

from tabsift.modelling import models
from tabsift.modelling import scoreboard as sb


def _rows(spark):
    rows = [(float(i % 7), "ab"[i % 2], float(3 * (i % 7) + (i % 2) + (i % 5) / 10)) for i in range(600)]
    return spark.createDataFrame([*rows, (1.0, "a", None)], "x double, c string, y double")


def test_types_are_measured_once_and_share_prepared_rows(spark, monkeypatch):
    """No type is measured on the rows it learned from, and both kinds of trees learn from one preparation."""
    d, kinds = _rows(spark), ["LINEAR_REG", "BOOSTED_TREE_REGRESSOR", "RANDOM_FOREST_REGRESSOR"]
    small = {"BOOSTED_TREE_REGRESSOR": {"max_iterations": 2}, "RANDOM_FOREST_REGRESSOR": {"num_trees": 2}}
    fit, held = sb.split(d, "AUTO", 42)
    alone = {k: models.train(fit, k, "y", split_method="NONE", stage=False, seed=42, **small.get(k, {})) for k in kinds}
    want = {(r["model"], r["metric"]): r["value"] for r in sb.scoreboard(alone, held).collect()}
    prepared, measured, ready, metrics = [], [], models._ready, models.ev.regression_metrics
    monkeypatch.setattr(models, "_ready", lambda rows, fit, kind, *a: (prepared.append(kind), ready(rows, fit, kind, *a))[1])
    monkeypatch.setattr(models.ev, "regression_metrics", lambda df, *a: (measured.append(df.count()), metrics(df, *a))[1])
    got = {(r["model"], r["metric"]): r["value"] for r in sb.model_search(d, "y", kinds, **small).collect()}
    assert got == {k: pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in want.items()}
    assert prepared == ["LINEAR_REG", "BOOSTED_TREE_REGRESSOR"]
    assert len(measured) == 4 and max(measured) <= held.count()  # three types and the baseline


def test_search_over_classifiers(spark):
    d = _rows(spark).selectExpr("x", "c", "y > 9 as dear")
    kinds = ["LOGISTIC_REG", "RANDOM_FOREST_CLASSIFIER"]
    fit, held = sb.split(d, "AUTO", 42)
    small = {"RANDOM_FOREST_CLASSIFIER": {"num_trees": 2}}
    alone = {k: models.train(fit, k, "dear", split_method="NONE", stage=False, seed=42, **small.get(k, {})) for k in kinds}
    want = {(r["model"], r["metric"]): r["value"] for r in sb.scoreboard(alone, held).collect()}
    got = {(r["model"], r["metric"]): r["value"] for r in sb.model_search(d, "dear", kinds, **small).collect()}
    assert got == {k: pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in want.items()}
