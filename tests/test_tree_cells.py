import numpy as np

from tabsift.modelling import explain, models, trees


def _ensemble(n_slots: int, n_splits: int, seed: int) -> trees.Ensemble:
    rng = np.random.default_rng(seed)
    splits, leaves = [], []
    for i in range(n_splits):
        s = int(rng.integers(n_slots))
        listed = s % 3 == 0
        splits.append(trees.Split(s, None if listed else float(rng.integers(0, 6)) / 2, tuple(map(float, rng.permutation(5)[:2])) if listed else ()))
        leaves += [trees.Leaf([s], np.array([share]), [[(i, left)]], rng.normal(size=2)) for share, left in ((0.3, True), (0.7, False))]
    out = trees.Ensemble([f"p{i}" for i in range(n_slots)], 2, sorted({s.slot for s in splits}), splits, leaves)
    return out


def test_rows_of_a_cell_share_values_and_known_cells_are_not_asked_again(monkeypatch):
    """Thresholds, lists of categories, values on a mark and undefined ones; cells of earlier rows are looked up."""
    rng, asked, of_answers = np.random.default_rng(0), [], trees.Ensemble._of_answers
    monkeypatch.setattr(trees.Ensemble, "_of_answers", lambda self, left: (asked.append(left.shape[1]), of_answers(self, left))[1])
    model = _ensemble(4, 9, 1)
    for _ in range(3):
        x = rng.integers(-1, 7, (400, len(model.slots))) / 2.0
        x[rng.random(x.shape) < 0.05] = np.nan
        want = of_answers(model, np.array([s.goes_left(x[:, model.slots.index(s.slot)]) for s in model.splits]))
        assert np.allclose(model.values(x), want)
        assert np.allclose(model.values(x[::-1]), want[::-1])
    assert len(asked) == 3 and asked[0] > asked[1] > asked[2]


def test_cells_beyond_one_number_and_beyond_what_is_kept(monkeypatch):
    x = np.random.default_rng(2).integers(0, 6, (300, 60)) / 2.0
    model = _ensemble(60, 600, 3)
    x = x[:, : len(model.slots)]
    want = model._answers(x)
    assert not model._cells(x)[1] and np.allclose(model.values(x), want) and np.allclose(model.values(x[:50]), want[:50])
    monkeypatch.setattr(trees, "KNOWN_BYTES", 10)
    few = _ensemble(3, 5, 4)
    x = x[:, : len(few.slots)]
    assert np.allclose(few.values(x), few._answers(x)) and few.known is None and np.allclose(few.values(x), few._answers(x))


def test_explained_rows_keep_nested_and_missing_columns(spark):
    rows = [(float(i % 5), "ab"[i % 2], float(i % 5 + i % 2), [("k", float(i))], None if i % 3 else i) for i in range(200)]
    d = spark.createDataFrame(rows, "x double, c string, y double, more array<struct<k string, v double>>, gap int")
    m = models.train(d.select("x", "c", "y"), "BOOSTED_TREE_REGRESSOR", "y", max_iterations=2, split_method="NONE")
    out = explain.shapley(m, models.predict(m, d)).collect()
    assert len(out) == 200
    for r in out:
        i = int(r["more"][0]["v"])
        assert (r["x"], r["c"], r["y"], r["gap"]) == (rows[i][0], rows[i][1], rows[i][2], rows[i][4])
        e = r["explained"][0]
        assert abs(e["baseline"] + sum(p["attribution"] for p in e["parts"]) - r["predicted_y"]) < 1e-6
