"""What grows with the products stays out of the driver, and what lags or origins multiply stays out of maps and shuffles."""

import random
import re
import time

import pytest
from pyspark.ml.feature import PCA

from demandtide.catalog import QUERIES, roles, splits
from demandtide.plans import flows, forecasting as L, least_squares as Q, supervised as S, unified


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mappings_of_products_are_never_broadcast(spark):
    feed = spark.createDataFrame([("u1_offtake", "A", "ali", "x", None, 23999, 10.0, "")], "feed string, sku string, party string, plant string, state string, m int, quantity double, status string")
    channels = spark.createDataFrame([("u1_offtake", "ali", "ALI")], "feed string, party string, channel string")
    names = spark.createDataFrame([("u1_offtake", "A", "s")], "feed string, feed_sku string, sku string")
    products, grams = spark.createDataFrame([("s", "n")], "sku string, name string"), spark.createDataFrame([("s", 1e6)], "sku string, grams double")
    out = flows.trade_flow(feed, flows.di_rules(), 24000, channels, names, products, grams)
    assert plan(out).count("strategy=merge") == 3
    assert [(r.sku, r.name, r.quantity) for r in out.collect()] == [("s", "n", 10.0)]


def test_members_are_never_broadcast(spark):
    wanted = spark.createDataFrame([("a", 202001), ("b", 202001)], "g string, ym int")
    history = spark.createDataFrame([("a", "s", 202001, 3.0), ("a", "t", 202001, 1.0)], "g string, sku string, ym int, v double")
    members = spark.createDataFrame([("a", "s"), ("a", "t"), ("b", "u"), ("b", "w")], "g string, sku string")
    out = unified.backoff_shares(wanted, history, members, ["g"], ["sku"], "ym", "v")
    assert "strategy=merge" in plan(out)  # the equal parts; the other join is behind the stored levels
    assert {(r.g, r.sku, r.share, r.level) for r in out.collect()} == {("a", "s", 0.75, 1), ("a", "t", 0.25, 1), ("b", "u", 0.5, 4), ("b", "w", 0.5, 4)}


def test_fits_from_months_equal_fits_from_rows(spark):
    """Gaps in the calendar, lags before its first month, targets behind it, series of two groups."""
    rng = random.Random(5)
    axis = [m for m in range(24001, 24040) if m not in (24011, 24025)]
    facts = spark.createDataFrame([(k, "ab"[k % 2], m, float(rng.randrange(90))) for k in range(9) for m in rng.sample(axis, 20)] + [(0, "a", m, 1.0) for m in axis], "sku int, label string, m int, v double")
    origins, horizons = [200012, 200206, 200303], [1, 3, 12]
    table = S.supervised_table(facts, ["sku", "label"], "m", "v", [S.Level("own_", ("sku", "label"), "v", 12)], 12)
    for months in (None, 18):
        want = Q.linear_backtest(table, ["sku", "label"], ["own_sales1", "own_sales12"], origins, horizons, ["label"], 50.0, months)
        got = Q.series_backtest(facts, axis, ["sku", "label"], "m", "v", [1, 12], origins, horizons, ["label"], 50.0, months)
        order = ["sku", "label", "date_when_predicting", "horizon"]
        left, right = want.orderBy(*order).collect(), got.orderBy(*order).collect()
        assert len(left) == len(right) > 60 and any(r.target is None for r in right)
        for a, b in zip(left, right):
            assert a[:6] == b[:6] and a.n_rows == b.n_rows and abs(a.prediction - b.prediction) < 1e-6


def test_component_fits_run_one_at_a_time(spark, monkeypatch):
    now, most, fit = [0], [0], PCA._fit

    def slow(self, df):
        now[0] += 1
        most[0] = max(most[0], now[0])
        time.sleep(0.5)
        out = fit(self, df)
        now[0] -= 1
        return out

    monkeypatch.setattr(PCA, "_fit", slow)
    rows = [(h, 202001 + k, 202001 + k, float(k), float(k * k), float(k)) for h in (1, 2, 3) for k in range(6)]
    table = spark.createDataFrame(rows, "horizon int, date_when_predicting int, date_to_predict int, a double, b double, target double")
    spec = L.ModelSpec("Ridge", {"regParam": 1.0}, scale=True, components=1)
    assert L.direct_forecast(table, [], ["a", "b"], 202004, [1, 2, 3], spec)[0].count() == 3
    assert most == [1]


def test_last_years_sales_take_one_shuffle_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(roles, "TASK_LINES", 100)
    out = roles.based(spark, "/root/testdata/sf0.001")
    shuffles = out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles == 1 and out.rdd.getNumPartitions() >= 60


def parts_of_shuffles(df):
    """Number of partitions of every shuffle by keys in the plan."""
    return [int(n) for n in re.findall(r"Exchange hashpartitioning\([^\n]*?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())]


@pytest.mark.parametrize("name", ["actuals_il", "kpi_input", "pivot_fill", "job_sellin_long", "job_unit_price"])
def test_shuffles_of_lines_grow_with_the_lines(spark, monkeypatch, name):
    """No shuffle falls back to the session's number of partitions (4 here), which would make tasks grow with the table."""
    monkeypatch.setattr(roles, "TASK_LINES", 100)
    found = parts_of_shuffles(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert found and min(found) >= 60


def test_products_join_sales_where_they_are_dealt(spark, monkeypatch):
    """The hierarchy is neither broadcast nor are the sales shuffled for it: one shuffle of each, by the number of lines."""
    monkeypatch.setattr(roles, "TASK_LINES", 100)
    out = roles.leafs(spark, "/root/testdata/sf0.001")
    found = parts_of_shuffles(out)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString() and len(found) == 2 and min(found) >= 60


def test_branches_of_granularity_read_sums_of_products(spark):
    """The stored cube, nearly as long as the lines, is summed by product name once and not read by every branch."""
    made, known = splits.granular_il(spark, "/root/testdata/sf0.001")
    files = [*made.inputFiles(), *known.inputFiles()]
    assert any("product-months" in f for f in files) and not any("flow-cube" in f for f in files)
