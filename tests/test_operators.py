import itertools
import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandtide.operators import aggregating as A, dense as N, joining as J, panel as P, quality as Q, reshaping as R
from demandtide.sources.reading import latest_version


def panel_frame(seed=3, skus=6, months=30):
    rnd = random.Random(seed)
    out = []
    for sku, m in itertools.product(range(skus), range(24000, 24000 + months)):
        if rnd.random() < 0.6:
            out.append((f"s{sku}", m, None if rnd.random() < 0.15 else float(rnd.randrange(0, 20)), rnd.choice("ab")))
    return pd.DataFrame(out, columns=["sku", "m", "v", "grp"])


@pytest.fixture(scope="module")
def panel(spark):
    pdf = panel_frame()
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "sku string, m int, v double, grp string")


def as_pandas(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


def test_latest_version_keeps_ties_and_drops_null_keys(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 9, "n"), ("b", 1, "w")], "k string, v int, p string")
    assert rows(latest_version(df, ["k"], "v").select("k", "p"), "k", "p") == [("a", "y"), ("a", "z"), ("b", "w")]
    assert rows(latest_version(df, ["k"], "v", F.col("v") < 2).select("k", "p"), "k", "p") == [("a", "x"), ("b", "w")]


def test_group_sum_null_rules(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 3.0), ("b", 1.0)], "k string, v double")
    assert rows(A.group_sum(df, ["k"], ["v"]), "k") == [("a", 0.0), ("b", 1.0)]


def test_keep_first_and_newest(spark, rows):
    old = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, o int, v int")
    new = spark.createDataFrame([("a", 9, 99), ("c", 1, 30)], "k string, o int, v int")
    assert rows(A.newest_over_old(new, old, ["k"], [F.col("o")]).select("k", "v"), "k") == [("a", 99), ("b", 20), ("c", 30)]
    both = spark.createDataFrame([("a", 2, None), ("a", 1, 7)], "k string, o int, v int")
    assert rows(A.keep_first(both, ["k"], [F.col("o")]), "k") == [("a", 1, 7)]


def test_unique_check_fails_the_job(spark, rows):
    good = spark.createDataFrame([(1, 3), (2, 4)], "k int, v int")
    assert rows(J.require_unique(good, ["k"]), "k") == [(1, 3), (2, 4)]
    bad = spark.createDataFrame([(1, 3), (2, 4), (2, 5)], "k int, v int")
    assert rows(A.duplicate_keys(bad, ["k"])) == [(2, 2)]
    with pytest.raises(PySparkException):
        J.join_many_to_one(good, bad.withColumnRenamed("v", "w"), ["k"]).collect()


def test_outer_panels_equal_chain_of_outer_joins(spark, rows):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, a double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, b double")
    c = spark.createDataFrame([(3, 7.0)], "k int, c double")
    chain = a.join(b, "k", "full").join(c, "k", "full")
    assert rows(J.outer_panels([a, b, c], ["k"]), "k") == rows(chain, "k")
    twice = spark.createDataFrame([(2, 5.0), (2, 7.0)], "k int, b double")
    with pytest.raises(PySparkException):
        J.outer_panels([a, twice], ["k"]).collect()


def test_label_pivot_fails_on_a_repeated_label(spark, rows):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", None), (2, "a", 3.0)], "k int, label string, v double")
    assert rows(R.label_pivot(df, ["k"], ["a", "b"], "v", "v_{label}")) == [(1, 1.0, None)]
    with pytest.raises(PySparkException):
        R.label_pivot(df.unionByName(df), ["k"], ["a", "b"], "v", "v_{label}").collect()


def test_stored_or_held_intermediates(spark, tmp_path):
    from demandtide.session import shared_folder, written

    df = spark.range(5)
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert written(df).inputFiles() and not df.storageLevel.useMemory
    class Unset:
        conf = type("Conf", (), {"get": staticmethod(lambda key, *default: str(tmp_path) if "warehouse" in key else default[0])})

    assert shared_folder(Unset, "x").startswith(str(tmp_path))


def test_shares_and_fallbacks(spark, rows):
    df = spark.createDataFrame([("p", "a", 1.0), ("p", "b", 3.0), ("q", "a", 0.0), ("q", "b", 0.0)], "p string, c string, v double")
    assert rows(A.split_ratio(df, ["p", "c"], ["p"], "v").select("p", "c", "split_ratio"), "p", "c") == [("p", "a", 0.25), ("p", "b", 0.75), ("q", "a", None), ("q", "b", None)]
    assert rows(A.equal_share_fallback(df, ["p"], "v", "s").select("p", "c", "s"), "p", "c")[2:] == [("q", "a", 0.5), ("q", "b", 0.5)]


def test_fallback_lookup(spark, rows):
    codes = spark.createDataFrame([(10, 1, "new"), (20, 2, "old")], "n int, o int, name string")
    df = spark.createDataFrame([(10,), (2,), (5,)], "k int")
    assert rows(J.fallback_lookup(df, codes, "k", "n", "o", "name", "out"), "k") == [(2, "old"), (5, None), (10, "new")]
    swapped = spark.createDataFrame([("A", "B", "old-name"), ("C", "A", "new-name"), ("A", "D", "older")], "o string, n string, name string")
    keys = spark.createDataFrame([("A",), ("Z",), (None,)], "k string")
    assert rows(J.fallback_lookup(keys, swapped, "k", "n", "o", "name", "out"), "k") == [(None, None), ("A", "old-name"), ("Z", None)]


def test_rolled_values_match_pandas(panel):
    got = as_pandas(P.rolled_values(panel, ["sku"], "m", ["v"], [3]), "sku", "m")
    pdf = panel_frame().sort_values(["sku", "m"]).reset_index(drop=True)
    roll = pdf.groupby("sku")["v"].rolling(3, min_periods=1)
    for name in ("mean", "min", "max"):
        want = getattr(roll, name)().fillna(0).reset_index(drop=True)
        pd.testing.assert_series_equal(got[f"v_{name}_3M"], want, check_names=False)
    assert (got["v_min_3M"] <= got["v_max_3M"]).all()


def test_lags_fill_inside_the_series(spark, rows):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0), ("b", 1, 9.0)], "k string, m int, v double")
    out = P.lagged_features(df, ["k"], "m", ["v"], [1]).select("k", "m", "v_lag1")
    assert rows(out, "k", "m") == [("a", 1, 1.0), ("a", 2, 1.0), ("a", 3, 2.0), ("b", 1, None)]


def test_diff_formula_and_zero(spark, rows):
    df = spark.createDataFrame([("a", 1, 4.0), ("a", 2, 5.0), ("a", 3, 0.0)], "k string, m int, v double")
    out = P.diff_features(df, ["k"], "m", ["v"], [1]).select("abs_diff1_v", "rel_diff1_v")
    assert sorted(rows(out), key=str) == sorted([(None, 0.0), (1.0, -80.0), (-5.0, 0.0)], key=str)
    change = P.diff_features(df, ["k"], "m", ["v"], [1], pct_change=True).select("m", "rel_diff1_v")
    assert rows(change, "m")[1] == (2, 25.0)


def test_cumulative_leaves_null_rows(spark, rows):
    df = spark.createDataFrame([("a", 1, 4.0), ("a", 2, None), ("a", 3, 5.0)], "k string, m int, v double")
    assert rows(P.cumulative_minmax(df, ["k"], "m", ["v"]).select("m", "cummax_v", "cummin_v"), "m") == [(1, 4.0, 4.0), (2, None, None), (3, 5.0, 4.0)]


def test_shares_of_month_sum_to_one(panel):
    out = as_pandas(P.share_of_total(panel, "m", ["v"]), "m", "sku")
    sums = out.groupby("m")["share_of_total_v"].sum()
    totals = out.groupby("m")["v"].sum()
    assert sums[totals > 0].round(9).eq(1).all() and sums[totals == 0].eq(0).all()


def test_sku_age_null_and_negative(spark, rows):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 3.0), ("a", 3, 3.0), ("a", 4, 3.0), ("b", 1, 0.0)], "k string, m int, v double")
    assert rows(P.sku_age(df, ["k"], "m", ["v"], 1.0, 0.05).select("k", "m", "age_v"), "k", "m") == [("a", 1, -3), ("a", 2, -2), ("a", 3, -1), ("a", 4, 0), ("b", 1, None)]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_fill_down_across_blocks(spark, rows, block):
    cells = [("x", i, f"h{i}" if i in (2, 9) else None) for i in range(12)] + [("y", i, None) for i in range(3)]
    df = spark.createDataFrame(cells, "s string, n int, h string")
    want = [("x", i, None if i < 2 else "h2" if i < 9 else "h9") for i in range(12)] + [("y", i, None) for i in range(3)]
    assert rows(P.fill_down(df, "s", "n", "h", "out", block).select("s", "n", "out"), "s", "n") == want


@pytest.mark.parametrize("splits", [1, 3, 500])
def test_category_codes_are_dense_ranks(spark, splits):
    words = [f"w{random.Random(i).randrange(10**6)}" for i in range(60)] + [None]
    df = spark.createDataFrame([(w,) for w in words * 2], "c string")
    got = {r.c: r.c_code for r in P.category_codes(df, "c", splits).collect()}
    assert got == {w: i for i, w in enumerate(sorted({w for w in words if w}))}
    assert P.encode_categories(df.filter("c IS NULL"), ["c"]).first()["c_code"] == -1


def brute_lags(pdf, origins, n):
    wide = pdf.groupby(["sku", "m"])["v"].sum().unstack("m").fillna(0)
    out = {}
    for o in origins:
        cols = [c for c in wide.columns if c <= o][-n:]
        for sku in wide.index:
            values = list(wide.loc[sku, cols])[::-1]
            out[sku, o] = values + [0.0] * (n - len(values))
    return out


def test_lag_matrix_matches_definition(panel):
    got = N.lag_matrix(panel, ["sku"], "m", "v", "p_", timelag=4).collect()
    want = brute_lags(panel_frame(), sorted(panel_frame()["m"].unique()), 4)
    assert len(got) == len(want)
    for r in got:
        key = (r.sku, r.date_when_predicting // 100 * 12 + r.date_when_predicting % 100)
        assert [r[f"p_sales{i}"] for i in range(1, 5)] == want[key]


def test_listed_origin_takes_last_month_before_it(spark, rows):
    df = spark.createDataFrame([("a", 24001, 1.0), ("a", 24004, 4.0)], "k string, m int, v double")
    assert rows(N.lag_matrix(df, ["k"], "m", "v", timelag=2, origins=[24003, 24009])) == [("a", 200003, 1.0, 0.0), ("a", 200009, 4.0, 1.0)]


def test_targets_and_windows(panel):
    wide = panel_frame().groupby(["sku", "m"])["v"].sum().unstack("m").fillna(0)
    for r in N.target_join(panel, ["sku"], "m", "v", 3).collect():
        m = r.date_to_predict // 100 * 12 + r.date_to_predict % 100
        assert r.target == wide.loc[r.sku, m]
    for r in N.target_window(panel, ["sku"], "m", "v").collect():
        o = r.date_when_predicting // 100 * 12 + r.date_when_predicting % 100
        months = [c for c in wide.columns if o + 5 <= c <= o + 10]
        assert months and r.target_r6m == wide.loc[r.sku, months].sum()


def test_reshaping(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0)], "k string, v_x double, w_x double, v_y double, w_y double")
    stacked = R.stack_labels(df, ["k"], ["x", "y"], ["v", "w"])
    assert rows(stacked, "label") == [("a", "x", 1.0, 2.0), ("a", "y", 3.0, 4.0)]
    long = spark.createDataFrame([("a", "di", 1.0), ("a", "eib", 2.0), ("b", "di", 3.0)], "k string, label string, p double")
    assert rows(R.label_pivot(long, ["k"], ["di", "eib"], "p", "y_{label}")) == [("a", 1.0, 2.0)]
    base = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "s string, v int")
    assert rows(R.override_rows(base, base.filter("v = 1"), "s", "b"), "v") == [("a", 1), ("a", 1), (None, 2)]


def test_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (None, "x")], "n int, t string")
    got = {r.column_name: r for r in Q.column_profile(df, 500).collect()}
    assert (got["n"].n_distinct, got["n"].n_null, got["n"].mean_value, got["n"].values_text) == (3, 1, 1.5, "1,2")
    assert (got["t"].n_distinct, got["t"].min_value, got["t"].values_text) == (2, 0.0, "x")


def test_contract_and_reconcile(spark, rows):
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert Q.check_contract(df, ["v", "k"]).columns == ["v", "k"]
    for columns in (["k"], ["k", "w"]):
        with pytest.raises(ValueError):
            Q.check_contract(df, columns)
    other = spark.createDataFrame([(1, 2.0005), (2, 1.0)], "k int, v double")
    assert rows(Q.reconcile(df, other, ["k"], ["v"])) == [(2, -1.0)]


def test_one_busy_key_changes_nothing(spark):
    """A third of the rows under one key: totals and shares stay whole."""
    df = spark.range(30000).select(F.when(F.col("id") < 10000, 0).otherwise(F.col("id") % 997).alias("k"), F.lit(1).alias("m"), F.lit(1.0).alias("v"))
    shares = P.share_of_group(df, "m", ["k"], ["v"])
    assert shares.count() == 30000
    total = shares.groupBy("k").agg(F.sum("share_of_k_v").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert round(total[0], 6) == round(total[1], 6) == 1.0


def test_sheet_column_names(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, 3, None)], "`Brand Name` int, `201901` int, `FY 201902` int")
    assert R.normalised_names(df.withColumnRenamed("Brand Name", "6-12 Month")).columns == ["6to12_month", "201901", "fy_201902"]
    assert R.month_columns(df.columns) == ["201901"]
    assert rows(R.drop_empty_rows(df, ["201901", "FY 201902"])) == [(2, 3, None)]
    with pytest.raises(ValueError):
        R.normalised_names(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))
