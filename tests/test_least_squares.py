"""Grouped least squares against fits of each group, horizon and origin on their own rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandtide.plans import least_squares as Q


def shifted(ym, k):
    m = ym // 100 * 12 + ym % 100 - 1 + k
    return m // 12 * 100 + m % 12 + 1


def made(width, seed=1):
    rng = random.Random(seed)
    rows = []
    for label in ("di", "eib", None):
        for item in range(4):
            for back in range(20):
                origin = shifted(202001, back)
                for h in (1, 2, 5):
                    x = [rng.choice([None, 0.0, rng.uniform(-5, 90)]) for _ in range(width)]
                    y = None if rng.random() < 0.1 or back + h > 19 else 3 + sum((v or 0) * (k % 3) for k, v in enumerate(x)) + rng.uniform(-4, 4) * h
                    rows.append((label, item, origin, shifted(origin, h), h, y, *x, 7.0))  # the last feature is constant
    names = [f"x{k}" for k in range(width)] + ["flat"]
    ddl = "label string, item int, date_when_predicting int, date_to_predict int, horizon int, target double, " + ", ".join(f"{n} double" for n in names)
    return rows, names, ddl


def plain(rows, origins, ridge, months, by_label):
    out = {}
    for origin in origins:
        for label in {r[0] for r in rows} if by_label else {None}:
            for h in (1, 2, 5):
                first = shifted(origin, -months) if months else 0
                own = [r for r in rows if (r[0] == label or not by_label) and r[4] == h and r[5] is not None and first < r[3] <= origin]
                if not own:
                    continue
                x, y = np.array([[v or 0.0 for v in r[6:]] for r in own]), np.array([r[5] for r in own])
                c = x - x.mean(0)
                a = np.vstack([c, np.sqrt(ridge) * np.eye(x.shape[1])])
                w = np.linalg.lstsq(a, np.concatenate([y - y.mean(), np.zeros(x.shape[1])]), rcond=1e-9)[0]
                for r in rows:
                    if (r[0] == label or not by_label) and r[4] == h and r[2] == origin:
                        z = np.array([v or 0.0 for v in r[6:]])
                        out[r[0], r[1], origin, h] = (max(0.0, float(y.mean() + (z - x.mean(0)) @ w)), len(own))
    return out


@pytest.mark.parametrize("width,ridge,months,by", [(1, 0.0, None, True), (3, 2.0, 6, False), (13, 5.0, None, True), (13, 5.0, 9, False)])
def test_equal_to_single_fits(spark, width, ridge, months, by):
    rows, names, ddl = made(width)
    origins = [shifted(202001, k) for k in (0, 3, 9, 15, 19)]
    table = spark.createDataFrame(rows, ddl).repartition(5)
    got = Q.linear_backtest(table, ["label", "item"], names, origins, [1, 2, 5], ["label"] if by else [], ridge, months)
    found = {(r.label, r.item, r.date_when_predicting, r.horizon): (r.prediction, r.n_rows) for r in got.collect()}
    want = {k: v for k, v in plain(rows, origins, ridge, months, by).items() if not by or k[0] is not None}  # a null group has no fit of its own
    assert found.keys() == want.keys() and len(found) > 40
    for k, (p, n) in want.items():
        assert found[k] == (pytest.approx(p, rel=1e-6, abs=1e-6), n), k


def test_narrow_and_wide_sums_agree(spark, monkeypatch):
    rows, names, ddl = made(4)
    table = spark.createDataFrame(rows, ddl).filter("target is not null").repartition(3)
    narrow = {tuple(r)[:2]: r.sums for r in Q.product_sums(table, ["label", "horizon"], [*names, "target"]).collect()}
    monkeypatch.setattr(Q, "WIDEST", 0)
    monkeypatch.setattr(Q, "HELD", 2)
    wide = {tuple(r)[:2]: r.sums for r in Q.product_sums(table, ["label", "horizon"], [*names, "target"]).collect()}
    assert narrow.keys() == wide.keys() and len(narrow) == 9
    for k in narrow:
        assert wide[k] == pytest.approx(narrow[k])


def test_no_rows(spark):
    rows, names, ddl = made(2)
    table = spark.createDataFrame(rows, ddl)
    assert Q.linear_forecast(table.limit(0), ["item"], names, 202101, [1]).count() == 0
    assert Q.linear_forecast(table.withColumn("target", F.lit(None).cast("double")), ["item"], names, 202101, [1]).count() == 0


def test_masked_features_fit_as_their_own_columns(spark, tmp_path):
    from demandtide.plans import forecasting as L, selection as X

    rows, names, ddl = made(3)
    table = spark.createDataFrame(rows, ddl).fillna(0.0, subset=names)
    importances = spark.createDataFrame([(1, "x0", 0.6), (1, "x1", 0.3), (1, "x2", 0.1), (2, "x2", 0.5), (2, "x1", 0.5), (9, "x0", 1.0)], "horizon int, feature string, importance double")
    X.save_selection(X.select_features(importances, 1), str(tmp_path / "s"), "1")
    chosen = X.read_selection(spark, str(tmp_path / "s"))
    assert {tuple(r) for r in chosen.collect()} == {(1, 1, "x0"), (2, 1, "x1"), (9, 1, "x0")}
    ready = X.masked(table, names, chosen, fixed=["flat"])
    at = shifted(202001, 12)
    key = lambda df: {(r.label, r.item): r.prediction for r in df.collect()}
    for h, own in ((1, ["x0"]), (2, ["x1"]), (5, names)):
        alone = key(Q.linear_forecast(table, ["label", "item"], own, at, [h]))
        assert len(alone) == 12 and key(Q.linear_forecast(ready, ["label", "item"], names, at, [h])) == pytest.approx(alone, abs=1e-6)
        tree = L.ModelSpec("DecisionTreeRegressor", {"maxDepth": 3})
        assert key(L.direct_forecast(ready, ["label", "item"], names, at, [h], tree)[0]) == key(L.direct_forecast(table, ["label", "item"], own, at, [h], tree)[0])
