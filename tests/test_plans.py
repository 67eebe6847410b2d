import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandtide.functions.periods import idx_to_date
from demandtide.plans import diagnostics as D, forecasting as L, granularity as G, kpis as K, masters as M, postprocess as O, scenario as Z, supervised as S
from demandtide.plans.prep import availability_sheet, months_long, unit_price

HOLES = random.Random(5)
CYCLE_ROWS = [
    (sku, "di", m, lag, m - lag, float(HOLES.choice([0, 3, 8, 11])), float(HOLES.choice([2, 4, 9])))
    for sku, m, lag in itertools.product("abc", range(24001, 24022), range(1, 9))
    if HOLES.random() < 0.9 and not (m == 24006 and lag == 2)
]


@pytest.fixture(scope="module")
def errors(spark):
    df = spark.createDataFrame(CYCLE_ROWS, "sku string, label string, m int, lag int, cycle int, actual double, forecast double")
    return K.error_columns(df, mask_zero_actual=True)


def loop_sums(m, lag):
    rows = [r for r in CYCLE_ROWS if r[2] == m and r[3] == lag]
    if not rows:
        return None
    err = [0.0 if r[5] == 0 else r[5] - r[6] for r in rows]
    return sum(err), sum(map(abs, err)), sum(r[6] for r in rows)


def loop_ytd(m, lag, first=None):
    first = first or (m - 1) // 12 * 12 + 1
    parts = [loop_sums(x, lag) for x in range(first, m + 1)]
    return None if not parts or None in parts else tuple(map(sum, zip(*parts)))


def loop_rolling(m, r, k):
    cycle = m - (r - 1 + k)
    parts = [loop_sums(x, x - cycle) for x in range(m - r + 1, m + 1)]
    return None if None in parts else tuple(map(sum, zip(*parts)))


def test_monthly_kpis_match_loops(errors):
    bias = {(r.m, r.lag): r.bias for r in K.bias(errors, ["label"]).collect()}
    fa = {(r.m, r.lag): r.fa for r in K.accuracy(errors, ["label"]).collect()}
    for key in bias:
        err, ab, f = loop_sums(*key)
        assert bias[key] == pytest.approx(err / f) and fa[key] == pytest.approx(max(0, 1 - ab / f))
        assert 0 <= fa[key] <= 1


@pytest.mark.parametrize("first", [None, 24004])
def test_year_to_date_needs_every_month(errors, first):
    got = {(r.m, r.lag): (r.ytd_bias, f.ytd_fa) for r, f in zip(
        K.ytd_bias(errors, ["label"], first).orderBy("m", "lag").collect(), K.ytd_accuracy(errors, ["label"], first).orderBy("m", "lag").collect())}
    assert any(v[0] is None for v in got.values())
    for (m, lag), (bias, fa) in got.items():
        want = loop_ytd(m, lag, first)
        if want is None:
            assert bias is None and fa is None
        else:
            assert bias == pytest.approx(want[0] / want[2]) and fa == pytest.approx(max(0, 1 - want[1] / want[2]))


def test_rolling_bias_matches_loop(errors):
    got = {r.m: r.rolling_bias for r in K.rolling_bias(errors, ["label"], 4, 2).collect()}
    months = {m for m in range(24001, 24022) if loop_rolling(m, 4, 2)}
    assert set(got) == months
    for m in months:
        err, _, f = loop_rolling(m, 4, 2)
        assert got[m] == pytest.approx(err / f)
    ytd = {r.m: r.ytd_rolling_bias for r in K.ytd_rolling_bias(errors, ["label"], 4, 2).collect()}
    signed = {r.m: r.ytd_rolling_bias for r in K.ytd_rolling_bias(errors, ["label"], 4, 2, absolute=False).collect()}
    for m in months:
        parts = [loop_rolling(x, 4, 2) for x in range((m - 1) // 12 * 12 + 1, m + 1)]
        if None in parts:
            assert ytd[m] is None
        else:
            assert ytd[m] == pytest.approx(sum(abs(p[0]) for p in parts) / sum(p[2] for p in parts))
            assert signed[m] == pytest.approx(sum(p[0] for p in parts) / sum(p[2] for p in parts))


def test_report_marks_missing(errors):
    out = K.kpi_report(errors.drop("err", "abs_err"), "label", ["di", "dc"], max_horizon=3)
    assert {r.value for r in out.filter("label = 'dc'").collect()} == {K.MISSING_KPI}
    assert out.count() == 21 * 3 * 2 * 5


def test_report_keeps_measures_apart(errors):
    one = errors.drop("err", "abs_err")
    two = one.withColumn("variable", F.lit("sold")).unionByName(one.withColumns({"variable": F.lit("sent"), "forecast": F.col("forecast") * 2}))
    names = {"di": "IL", "dc": "DC"}
    out = K.kpi_report(two, "label", list(names), max_horizon=3, by=["variable"], umbrella=names)
    plain = K.kpi_report(one, "label", list(names), max_horizon=3)
    sold = out.filter("variable = 'sold'")
    assert sorted(sold.select(*plain.columns).collect()) == sorted(plain.collect())
    assert out.count() == 2 * plain.count()
    assert {(r.label, r.umbrella) for r in out.select("label", "umbrella").distinct().collect()} == set(names.items())
    assert out.filter("variable = 'sent'").select("value").subtract(sold.select("value")).count() > 0


def test_levels_differ_from_leaf_errors(spark):
    df = spark.createDataFrame([("c", "b", 1, 1, 10.0, 5.0), ("c", "b", 1, 1, 0.0, 5.0)], "country string, brand string, m int, lag int, actual double, forecast double")
    level = K.error_columns(K.levels_rollup(df, ["m", "lag"], ["country", "brand"]))
    assert {(r.level_id, r.abs_err) for r in level.collect()} == {(0, 0.0), (1, 0.0)}
    leaf = K.levels_computed_on(K.error_columns(df), ["m", "lag"], "country", "brand", ["abs_err"])
    assert {(r.computed_on, r.abs_err) for r in leaf.collect()} == {(x, 10.0) for x in ("all", "country", "brand", "country_brand")}


def test_scores(spark):
    df = spark.createDataFrame([("x", 10.0, 8.0), ("x", 0.0, 2.0), ("z", 1.0, 0.0)], "k string, actual double, forecast double")
    got = {r.k: (r.fa, r.fa_prime, r.bias) for r in D.score_summary(df, ["k"]).collect()}
    assert got["x"] == pytest.approx((0.6, 0.6, 0.0)) and got["z"] == (None, None, None)


def test_seasonal_ratio_of_a_peak(spark):
    df = spark.createDataFrame([("b", 24001, 5.0), ("b", 24002, 100.0), ("b", 24003, 5.0)], "k string, m int, v double")
    assert [r.season_ratio for r in O.seasonal_ratio(df, ["k"], "m", "v").orderBy("m").collect()] == [0.05, 10.0, 0.05]


def test_correction_touches_only_the_rule_months(spark):
    sales = spark.createDataFrame([("b", m, 50.0 if m % 12 in (2, 11) else 10.0) for m in range(2015 * 12 + 1, 2019 * 12 + 13)], "k string, m int, sold double")
    forecast = spark.createDataFrame([("b", m, 10.0) for m in range(2020 * 12 + 1, 2020 * 12 + 13)], "k string, m int, prediction double")
    out = {r.m % 12: r.prediction for r in O.seasonal_correction(sales, forecast, ["k"], "m", "sold", ("CNY", 11), 0.0).collect()}
    assert {m for m, p in out.items() if p != 10.0} == {2, 11}
    assert out[2] == pytest.approx(50.0) and out[11] == pytest.approx(50.0)
    wide = O.seasonal_correction(sales, forecast, ["k"], "m", "sold", ("CNY", 11), 100.0)
    assert {r.prediction for r in wide.collect()} == {10.0}


def test_extension_has_one_ratio_per_year(spark):
    forecast = spark.createDataFrame([(m, m - 24012, 2.0) for m in range(24012, 24025)], "m int, horizon int, yhat double")
    actual = spark.createDataFrame([(m, 1.0) for m in range(24001, 24013)], "m int, sold double")
    out = O.extend_forecast(forecast, actual, "m", ["yhat"], "yhat", "sold", 3)
    assert out.count() == 13 + 36
    by_year = {(r.horizon - 1) // 12: r.yhat for r in out.filter("horizon > 0").collect()}
    assert by_year == {0: 2.0, 1: 4.0, 2: 8.0, 3: 16.0}


def forecast_frame(spark):
    rows = [("a", "di", 1.0), ("a", "eib", 3.0), ("a", "il", 8.0), ("b", "di", 0.0), ("b", "il", 5.0)]
    return spark.createDataFrame([(s, x, 24001, 1, p) for s, x, p in rows], "sku string, label string, m int, horizon int, prediction double")


def test_children_add_up_to_the_parent(spark):
    out = {(r.sku, r.label): r.prediction for r in O.rescale_children(forecast_frame(spark), ["sku", "m"]).collect()}
    assert out["a", "di"] + out["a", "eib"] == out["a", "il"] == 8.0
    assert out["b", "di"] == 0.0 and out["b", "il"] == 5.0


def test_parent_recomputed_and_residual(spark):
    made = {(r.sku, r.label): r.prediction for r in O.recompute_parent(forecast_frame(spark), ["sku", "m", "horizon"]).collect()}
    assert made["a", "il"] == 4.0 and made["b", "il"] is None
    total = spark.createDataFrame([(24001, 1, 7.0)], "m int, horizon int, prediction double")
    out = {(r.sku, r.label): r.prediction for r in O.rescale_residual(forecast_frame(spark), total, "sku", "m").collect()}
    assert out["a", "eib"] == 6.0 and out["a", "il"] == 7.0 and out["b", "il"] == 0.0


def test_invalid_products_become_zero(spark):
    history = spark.createDataFrame([("di", "a", 0.0), ("eib", "a", 0.0), ("il", "a", 2.0)], "label string, sku string, sold double")
    out = {(r.sku, r.label): r.prediction for r in O.zero_invalid(forecast_frame(spark), history, "sku", "sold").collect()}
    assert (out["a", "di"], out["a", "eib"], out["a", "il"], out["b", "il"]) == (0.0, 0.0, 8.0, 5.0)


def test_scope_modes(spark):
    wide = spark.createDataFrame([(1.0, 3.0, 2.0)], "yhat_di_calib double, yhat_eib_calib double, yhat_il_calib double")
    assert O.scope_modes(wide, "diff").first()["yhat_di_calib"] == 0.0
    assert O.scope_modes(wide, "sum").first()["yhat_il_calib"] == 4.0
    with pytest.raises(ValueError):
        O.scope_modes(wide, "other")


def test_split_keeps_the_total(spark):
    history = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("n", "x", 2.0)], "sku string, channel string, q double")
    ratios = G.ratios_of(history, ["sku", "channel"], ["sku"], "q")
    forecast = spark.createDataFrame([("a", 24001, 10.0)], "sku string, m int, offtake double")
    out = G.split_forecast(forecast, ratios, "sku", "offtake", keep_missing=False)
    assert sorted(r.offtake for r in out.collect()) == [2.5, 7.5]
    kept = G.split_forecast(forecast, ratios, "sku", "offtake", keep_missing=True)
    assert kept.filter("sku = 'n' AND offtake IS NULL").count() == 1


def test_deaggregation_sums_to_the_new_totals(spark):
    leaf = spark.createDataFrame([(t, s, float(s if t else 0)) for t in range(2) for s in range(5)], "t int, s int, v double")
    edited = spark.createDataFrame([(0, 50.0), (1, 60.0)], "t int, new double")
    out = G.deaggregate(leaf, edited, ["t"], "v", "new").groupBy("t").agg(F.sum("v").alias("v"))
    assert {r.t: r.v for r in out.collect()} == {0: 50.0, 1: pytest.approx(60.0)}


def test_eib_actuals_leave_out_young_months(spark):
    rows = spark.createDataFrame([("a", 24001, 5.0), ("a", 24005, 6.0)], "sku string, m int, offtake double").withColumn("produced_date", F.lit("2000-06-15").cast("date"))
    sellin = spark.createDataFrame([("a", 24001, 1.0)], "sku string, m int, sellin double")
    assert [(r.m, r.offtake, r.sellin) for r in G.actuals_eib(rows, sellin, "sku", "m", idx_to_date("m")).collect()] == [(24001, 5.0, 1.0)]


def test_scenario_has_no_overlap_and_no_duplicates(spark):
    schema = "label string, sku_wo_pkg string, m int, horizon int, offtake double"
    made = spark.createDataFrame([("il", "a", 24003, 0, 3.0), ("il", "a", 24004, 1, 4.0)], schema)
    known = spark.createDataFrame([("il", "a", 24001, -99, 1.0), ("il", "a", 24003, -99, 9.0)], schema)
    out = Z.build_scenario(made, known, ["label", "sku_wo_pkg"])
    assert [(r.m, r.frc_flg, r.oft_trk_val, r.sal_ins_val) for r in out.orderBy("m").collect()] == [(24001, False, 1.0, 0.0), (24003, True, 3.0, 0.0), (24004, True, 4.0, 0.0)]
    stamped = Z.stamp_scenario(out, "DC", "me", F.lit("2000-04-02").cast("date")).first()
    assert (stamped.cyc_dat, stamped.unit, stamped.frc_cre_dat) == (20000301, "tins", 20000402)
    with pytest.raises(PySparkException):
        Z.build_scenario(made.unionByName(made), known, ["label", "sku_wo_pkg"]).collect()


def test_neighbour_forecast_direction(spark):
    df = spark.createDataFrame([("a", 24000, 24001, 1.0), ("a", 24000, 24002, 2.0), ("a", 24000, 24004, 4.0)], "k string, cycle int, m int, forecast double")
    out = {r.m: r for r in S.neighbour_forecasts(df, ["k"], "cycle", "m", "forecast", 2).collect()}
    assert out[24002]["forecast_1"] == 1.0 and out[24002]["forecast_-2"] == 4.0 and out[24002]["forecast_-1"] is None


def test_supervised_levels(spark):
    facts = spark.createDataFrame([("a", "di", 24001, 1.0, 2.0), ("b", "di", 24001, 10.0, 4.0), ("a", "di", 24002, 3.0, None)], "sku string, label string, m int, v double, p double")
    levels = [S.Level("own_", ("sku", "label"), "v", 2), S.Level("all_", ("label",), "v", 2), S.Level("price_", ("label",), "p", 1, "mean")]
    out = {(r.sku, r.date_when_predicting): r for r in S.supervised_table(facts, ["sku", "label"], "m", "v", levels, 1, one_hot=("label", ["di", "eib"])).collect()}
    row = out["a", 200002]
    assert (row.own_sales1, row.own_sales2, row.all_sales1, row.all_sales2, row.target, row.di, row.eib) == (3.0, 1.0, 3.0, 11.0, None, 1, 0)
    assert out["b", 200001].target == 0.0 and out["b", 200001].price_sales1 == 3.0


def test_masters(spark):
    flow = spark.createDataFrame([("a", 1, "x", "offtake", 2.0), ("a", 1, "Total", "offtake", 9.0), ("a", 1, "Total", "sellin", 5.0), ("a", 1, "x", "sellin", 7.0)], "sku string, m int, channel string, type string, quantity double")
    row = M.tradeflow_pivot(flow, ["sku", "m"]).first()
    assert (row.offtake, row.sellout, row.sellin, row.sp_inv) == (2.0, 0.0, 5.0, 0.0)
    status = spark.createDataFrame([("7/1/2019", "x"), ("actual", "y")], "status string, produced_date string")
    assert {tuple(r) for r in M.repair_status(status).collect()} == {("actual", "2019-07-01"), ("actual", "y")}


def test_prep_sheets(spark):
    sheet = spark.createDataFrame([("i", 1.0, None, 3.0)], "item string, W01 double, W02 double, W03 double")
    out = availability_sheet(sheet, "item", [("W01", "2020-01", 1), ("W02", "2020-01", 2), ("W03", "2020-02", 3)])
    assert {(r.week, r.month, r.value) for r in out.collect()} == {(1, "2020-01", 1.0), (3, "2020-02", 3.0)}
    value = spark.createDataFrame([("s", 8.0, 1.0)], "sku string, a double, b double")
    volume = spark.createDataFrame([("s", 4.0, 0.0)], "sku string, a double, b double")
    assert [(r.month, r.price) for r in unit_price(value, volume, ["sku"], ["a", "b"]).collect()] == [("a", 2.0)]
    uplift = spark.createDataFrame([("NL", "25%", None)], "country string, `1/1/2020` string, `2/1/2020` string")
    assert [(r.uplift, str(r.date)) for r in months_long(uplift, ["country"], ["1/1/2020", "2/1/2020"], "uplift").collect()] == [(0.25, "2020-01-01")]


def test_direct_forecast_learns_a_copy(spark):
    rnd = random.Random(1)
    rows = [(f"s{s}", 24000 + t, h, 200000 + t % 12 + 1, 200000 + t, float(x), float(2 * x)) for s in range(4) for t in range(30) for h in (1, 2) for x in [rnd.randrange(20)]]
    table = spark.createDataFrame(rows, "sku string, i int, horizon int, date_when_predicting int, date_to_predict int, x double, target double")
    made, models = L.direct_forecast(table, ["sku"], ["x"], 200001 + 11, [1, 2], L.ModelSpec("LinearRegression"))
    assert set(models) == {1, 2} and made.filter("prediction < 0").count() == 0
    late = L.direct_forecast(table, ["sku"], ["x"], 200029, [1], L.ModelSpec("LinearRegression"))
    assert late[0].count() == 0
    scores = L.train_test_rmse(table, ["x"], 200020, 1, L.ModelSpec("Ridge", scale=True))
    assert scores["train"] < 1e-3 and scores["test"] < 1e-3
    with pytest.raises(ValueError):
        L.build_pipeline(L.ModelSpec("Oracle"), ["x"])


def test_selected_features():
    assert L.features_for(2, ["a", "b"], {2: ["b"]}, ["pop"]) == ["b", "pop"]
    assert L.features_for(3, ["a", "b"], {2: ["b"]}) == ["a", "b"]


def test_end_to_end_horizons_start_at_the_data(spark):
    from demandtide.plans import forecasting as L

    cutoff = 200012
    ym = lambda m: (m - 1) // 12 * 100 + (m - 1) % 12 + 1
    base = 2000 * 12 + 12
    rows = [("a", ym(o), ym(o + h), h, float(h), 1.0 + h) for o in range(base - 20, base + 1) for h in range(1, 16)]
    table = spark.createDataFrame(rows, "sku string, date_when_predicting int, date_to_predict int, horizon int, x double, target double")
    actual = spark.createDataFrame([("a", base - k, 1.0) for k in range(36)], "sku string, m int, sold double")
    spec = L.ModelSpec("DecisionTreeRegressor", {"maxDepth": 1})
    got = L.end_to_end(table, actual, ["sku"], ["x"], cutoff, 5, spec, "sold")
    assert sorted((r.horizon, r.m) for r in got.collect()) == [(h, base + h + 3) for h in range(-2, 6)]
    far = L.end_to_end(table, actual, ["sku"], ["x"], cutoff, 12, spec, "sold")
    assert sorted(r.horizon for r in far.collect()) == list(range(-2, 13))


def test_means_of_sums_equal_means_of_rows(spark):
    rows = spark.createDataFrame(
        [("a", 1, "di", 2.0), ("a", 1, "di", 5.0), ("a", 1, "eib", None), ("a", 2, "eib", 4.0), ("b", 1, "di", 1.0), (None, 1, "eib", 3.0)],
        "sku string, m int, label string, qty double",
    )
    sums = rows.groupBy("sku", "m", "label").agg(F.sum("qty").alias("qty"), F.count("qty").alias("n"))
    keys = ["sku", "m"]

    def same(a, b):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.columns == b.columns

    same(M.scope_pivot_mean(rows, keys, "label", ["di", "eib"], "qty", "sold"), M.scope_pivot_mean(sums, keys, "label", ["di", "eib"], "qty", "sold", "n"))
    same(M.sellout_mix(rows, keys, "qty", "qty", "qty"), M.sellout_mix(sums, keys, "qty", "qty", "qty", "n"))
    wide = rows.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("label") == k, F.col("qty"))).alias(k) for k in ("di", "eib")],
        *[F.count(F.when(F.col("label") == k, F.col("qty"))).alias(f"n_{k}") for k in ("di", "eib")],
    )
    same(M.availability_pivot(rows, keys, "label", ["di", "eib"], "qty"), M.availability_means(wide, keys, {"di": "n_di", "eib": "n_eib"}))
