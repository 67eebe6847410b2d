"""Queries on training and scoring.

Trees are not bit-comparable, so the queries that grow them have no SQL. The operators they run are checked beside
them with a least-squares line on one feature, which SQL has in closed form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from demandtide.catalog.features import _BL, _dense_sql
from demandtide.catalog.registry import query, r4, with_sql, ym
from demandtide.catalog.roles import LABELS, hierarchy, lines, sku_label
from demandtide.functions.cleaning import round_places
from demandtide.functions.periods import idx_to_ym
from demandtide.operators.dense import target_window
from demandtide.plans import forecasting as L, least_squares as Q, selection as X, supervised as S
from demandtide.session import shared_folder, written

KEYS = ["brand", "label"]
LEVELS = [
    S.Level("brand_label_", ("brand", "label"), "offtake", 12),
    S.Level("brand_", ("brand",), "offtake", 12),
    S.Level("label_", ("label",), "offtake", 12),
    S.Level("sellin_brand_label_", ("brand", "label"), "sellin", 12),
]
FEATURES = [f"{v.prefix}sales{i}" for v in LEVELS for i in range(1, v.timelag + 1)] + ["month", "sin_month", "cos_month", "di", "eib"]
HORIZONS = list(range(1, 13))
FOREST = L.ModelSpec("RandomForestRegressor", {"numTrees": 10, "maxDepth": 5})
BOOST = L.ModelSpec("XGBRegressor", {"maxIter": 5, "maxDepth": 3})


def brand_facts(spark, d):
    return (
        sku_label(spark, d).join(hierarchy(spark, d), "sku").groupBy("brand", "label", "m")
        .agg(F.sum("offtake").alias("offtake"), F.sum("sellin").alias("sellin"))
    )


def cutoff(spark, d, back=0):
    """Last month of the sales, or ``back`` months before it, as yyyymm."""
    last = lines(spark, d).agg(F.max("m").alias("m"))
    return last.select(idx_to_ym(F.col("m") - back).alias("ym")).first().ym


def training_table(spark, d, max_horizon):
    return S.supervised_table(brand_facts(spark, d), KEYS, "m", "offtake", LEVELS, max_horizon, one_hot=("label", ("di", "eib")))


@query("forecast_direct")
def _(spark, d):
    table = written(training_table(spark, d, HORIZONS[-1]))
    return L.direct_forecast(table, KEYS, FEATURES, cutoff(spark, d), HORIZONS, BOOST)[0]


@query("backtest")
def _(spark, d):
    """Origins half a year, a year and a year and a half before the last month, so that most targets are known."""
    origins = [cutoff(spark, d, back) for back in (18, 12, 6)]
    return L.backtest(training_table(spark, d, HORIZONS[-1]), KEYS, FEATURES, origins, HORIZONS, FOREST)


@query("model_registry")
def _(spark, d):
    table = written(training_table(spark, d, HORIZONS[-1]))
    specs = {
        "linear": L.ModelSpec("LinearRegression", {"regParam": 0.1}, scale=True),
        "ridge_pca": L.ModelSpec("Ridge", {"regParam": 1.0}, scale=True, components=5),
        "lasso": L.ModelSpec("Lasso", {"regParam": 0.1}),
        "huber": L.ModelSpec("HuberRegressor", {"maxIter": 20}),
        "forest": FOREST,
        "boost": BOOST,
    }
    last = cutoff(spark, d)
    made = L.in_threads(lambda item: L.direct_forecast(table, KEYS, FEATURES, last, HORIZONS, item[1])[0].withColumn("model", F.lit(item[0])), list(specs.items()))
    return L.union_sources(made)


@query("feature_importance")
def _(spark, d):
    last = cutoff(spark, d)
    table = written(training_table(spark, d, HORIZONS[-1]))
    models = L.direct_forecast(table, KEYS, FEATURES, last, HORIZONS, FOREST)[1]
    return L.feature_importance(spark, models, FEATURES, "il", last)


@query("forecast_global")
def _(spark, d):
    means = [c for c in FEATURES if c not in ("di", "eib")]
    table = written(L.global_table(training_table(spark, d, HORIZONS[-1]), means))
    return L.direct_forecast(table, [], means, cutoff(spark, d), HORIZONS, FOREST)[0]


@query("tuning_errors")
def _(spark, d):
    specs = {
        f"depth{depth}_trees{trees}": L.ModelSpec("RandomForestRegressor", {"maxDepth": depth, "numTrees": trees})
        for depth in (3, 5) for trees in (5, 10)
    }
    return L.tuning_errors(training_table(spark, d, 12), KEYS, FEATURES, [cutoff(spark, d, 12)], HORIZONS, specs)


@query("forecast_end_to_end")
def _(spark, d):
    actual = lines(spark, d).groupBy("m").agg(F.sum("qty").alias("offtake"))
    spec = L.ModelSpec("RandomForestRegressor", {"numTrees": 5, "maxDepth": 4})
    out = L.end_to_end(training_table(spark, d, 15), actual, KEYS, FEATURES, cutoff(spark, d), 18, spec, "offtake")
    return out.withColumn("ym", idx_to_ym("m")).drop("m")


# The same operators with a line on the last month's sales of the series.
LINE = L.ModelSpec("LinearRegression")
LAST_SALES = "brand_label_sales1"
PLACES = 2


def line_table(spark, d, max_horizon):
    return S.supervised_table(brand_facts(spark, d), KEYS, "m", "offtake", [S.Level("brand_label_", ("brand", "label"), "offtake", 1)], max_horizon)


def _r2(x):
    return f"(floor(({x}) * 1e2 + 0.5) / 1e2)"


def _line_sql(backs, max_horizon, body, whole=False):
    """Lines fitted per origin (months before the last one) and horizon, as ``made``: one row per series, or per month over all series."""
    both = "SELECT m AS om, h, avg(x) AS x, sum(y) AS y FROM series GROUP BY ALL" if whole else "SELECT * EXCLUDE (m), m AS om FROM series"
    return with_sql(
        f"""WITH {_BL}, {_dense_sql('dn', ['brand', 'label'], 'sum(v)', 'bl')},
        series AS (SELECT o.brand, o.label, o.m, h, o.v AS x, t.v AS y FROM dn o CROSS JOIN (SELECT unnest(range(1, {max_horizon + 1})) AS h) LEFT JOIN dn t ON t.brand = o.brand AND t.label = o.label AND t.m = o.m + h),
        known AS ({both}), cuts AS (SELECT max(m) - b AS c FROM months, (SELECT unnest({list(backs)}) AS b) GROUP BY b),
        fits AS (SELECT c, h, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM known, cuts WHERE y IS NOT NULL AND om + h <= c GROUP BY c, h),
        made AS (SELECT known.*, greatest(base + slope * x, 0) AS p FROM known JOIN fits ON fits.h = known.h AND fits.c = om) {body}""",
        "sku_label", "master", "ranked",
    )


_LINE_ROWS = f"{ym('om')} AS date_when_predicting, {ym('om + h')} AS date_to_predict, CAST(h AS INTEGER) AS horizon, y AS target, {_r2('p')} AS prediction FROM made"


@query("forecast_direct_line", _line_sql([0], 12, f"SELECT brand, label, {_LINE_ROWS}"))
def _(spark, d):
    table = written(line_table(spark, d, HORIZONS[-1]))
    made = L.direct_forecast(table, KEYS, [LAST_SALES], cutoff(spark, d), HORIZONS, LINE)[0]
    return made.withColumn("prediction", round_places("prediction", PLACES))


@query("backtest_line", _line_sql([18, 12, 6], 12, f"SELECT brand, label, {_LINE_ROWS}"))
def _(spark, d):
    origins = [cutoff(spark, d, back) for back in (18, 12, 6)]
    made = L.backtest(line_table(spark, d, HORIZONS[-1]), KEYS, [LAST_SALES], origins, HORIZONS, LINE)
    return made.withColumn("prediction", round_places("prediction", PLACES))


# Linear models of every horizon and origin from one scan.
RIDGE = 50.0
BACKS = list(range(24, 0, -1))


def scoped_facts(spark, d):
    """Sales by product and month of both scopes and of their sum."""
    facts = sku_label(spark, d)
    return facts.select("sku", F.explode(F.array("label", F.lit(LABELS[-1]))).alias("label"), "m", "offtake")


def _fits_sql(backs, features, fit, body, by=()):
    """Fits of every group of ``by``, horizon and origin over products or brands, as ``made``."""
    grain, facts = ("sku", "SELECT sku, label, m, offtake AS v FROM sku_label UNION ALL SELECT sku, 'il', m, offtake FROM sku_label") if by else ("brand", None)
    keyed = "".join(f"{c}, " for c in by)
    same = "".join(f" AND f.{c} = k.{c}" for c in by)
    start = f"bl AS ({facts})" if facts else _BL
    lags = ", ".join(f"coalesce(lag(v, {n - 1}) OVER w, 0) AS x{k}" for k, n in enumerate(features))
    return with_sql(
        f"""WITH {start}, {_dense_sql('dn', [grain, 'label'], 'sum(v)', 'bl')},
        lagged AS (SELECT {grain}, label, m, v, {lags} FROM dn WINDOW w AS (PARTITION BY {grain}, label ORDER BY r)),
        known AS (SELECT o.* EXCLUDE (v, m), o.m AS om, h, t.v AS y FROM lagged o CROSS JOIN (SELECT unnest(range(1, 13)) AS h) LEFT JOIN dn t ON t.{grain} = o.{grain} AND t.label = o.label AND t.m = o.m + h),
        cuts AS (SELECT max(m) - b AS c FROM months, (SELECT unnest({list(backs)}) AS b) GROUP BY b),
        fits AS (SELECT {keyed}c, h, count(*) AS n_rows, {fit} FROM known, cuts WHERE y IS NOT NULL AND om + h <= c GROUP BY ALL),
        made AS (SELECT k.*, f.n_rows, f.base, f.w FROM known k JOIN fits f ON f.h = k.h AND f.c = k.om{same}) {body}""",
        "sku_label", "master", "months", "ranked",
    )


_ONE = "coalesce(regr_slope(y, x0), 0) AS slope, coalesce(regr_intercept(y, x0), avg(y)) AS base, [slope] AS w"
_X = f"(var_pop(x0) + {RIDGE} / count(*))"
_Z = f"(var_pop(x1) + {RIDGE} / count(*))"
_DET = f"({_X} * {_Z} - covar_pop(x0, x1) ** 2)"
_W0 = f"((covar_pop(y, x0) * {_Z} - covar_pop(y, x1) * covar_pop(x0, x1)) / {_DET})"
_W1 = f"((covar_pop(y, x1) * {_X} - covar_pop(y, x0) * covar_pop(x0, x1)) / {_DET})"
_TWO = f"avg(y) - {_W0} * avg(x0) - {_W1} * avg(x1) AS base, [{_W0}, {_W1}] AS w"
_FITTED = f"{ym('om')} AS date_when_predicting, {ym('om + h')} AS date_to_predict, CAST(h AS INTEGER) AS horizon, y AS target, n_rows"


@query("forecast_ridge", _fits_sql([0], [1, 12], _TWO, f"SELECT sku, label, {_FITTED}, {_r2('greatest(base + w[1] * x0 + w[2] * x1, 0)')} AS prediction FROM made", ("label",)))
def _(spark, d):
    """Ridge on the sales of the last and of the twelfth last month, per scope and horizon at product grain: 36 fits from sums of products of months."""
    facts = scoped_facts(spark, d)
    axis = sorted(r.m for r in lines(spark, d).select("m").dropna().distinct().collect())  # bounded by the calendar
    made = Q.series_backtest(facts, axis, ["sku", "label"], "m", "offtake", [1, 12], [cutoff(spark, d)], HORIZONS, ["label"], RIDGE)
    return made.withColumn("prediction", round_places("prediction", PLACES))


@query("backtest_linear", _fits_sql(BACKS, [1], _ONE, f"SELECT brand, label, {_FITTED}, {_r2('greatest(base + w[1] * x0, 0)')} AS prediction FROM made"))
def _(spark, d):
    """Twenty-four monthly origins and twelve horizons: 288 fits from one scan."""
    origins = [cutoff(spark, d, back) for back in (BACKS[0],)]
    first = origins[0] // 100 * 12 + origins[0] % 100
    origins = [(first + k - 1) // 12 * 100 + (first + k - 1) % 12 + 1 for k in range(len(BACKS))]
    made = Q.linear_backtest(line_table(spark, d, HORIZONS[-1]), KEYS, [LAST_SALES], origins, HORIZONS)
    return made.withColumn("prediction", round_places("prediction", PLACES))


@query("backtest_errors")
def _(spark, d):
    """Ridge on every feature of the brand table, three years of history: absolute error and bias by horizon over 24 origins."""
    last = cutoff(spark, d, BACKS[0])
    first = last // 100 * 12 + last % 100
    origins = [(first + k - 1) // 12 * 100 + (first + k - 1) % 12 + 1 for k in range(len(BACKS))]
    made = Q.linear_backtest(training_table(spark, d, HORIZONS[-1]), KEYS, FEATURES, origins, HORIZONS, ridge=RIDGE, months=36)
    known = made.filter(F.col("target").isNotNull())
    return known.groupBy("horizon").agg(F.count("*").alias("n_rows"), F.sum(F.abs(F.col("prediction") - F.col("target"))).alias("error"), F.sum(F.col("prediction") - F.col("target")).alias("bias"), F.sum("target").alias("sold"))


@query(
    "forecast_selected",
    _fits_sql(
        [0], [1, 12], "coalesce(regr_slope(y, CASE WHEN h % 2 = 1 THEN x0 ELSE x1 END), 0) AS slope, coalesce(regr_intercept(y, CASE WHEN h % 2 = 1 THEN x0 ELSE x1 END), avg(y)) AS base, [slope] AS w",
        f"SELECT brand, label, {_FITTED}, {_r2('greatest(base + w[1] * CASE WHEN h % 2 = 1 THEN x0 ELSE x1 END, 0)')} AS prediction FROM made",
    ),
)
def _(spark, d):
    """A saved selection, read back: the last month's sales at odd horizons, the twelfth last month's at even ones."""
    names = ["brand_label_sales1", "brand_label_sales12"]
    importances = spark.range(1, HORIZONS[-1] + 1).select(F.col("id").cast("int").alias("horizon"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.when(F.col("id") % 2 == odd, 0.9).otherwise(0.1).alias("importance")) for n, odd in zip(names, (1, 0))
    ])).alias("e")).select("horizon", "e.*")
    folder = shared_folder(spark, "selection")
    X.save_selection(X.select_features(importances, 1), folder, "1")
    table = S.supervised_table(brand_facts(spark, d), KEYS, "m", "offtake", [S.Level("brand_label_", ("brand", "label"), "offtake", 12)], HORIZONS[-1])
    ready = X.masked(table, names, X.read_selection(spark, folder))
    return Q.linear_forecast(ready, KEYS, names, cutoff(spark, d), HORIZONS).withColumn("prediction", round_places("prediction", PLACES))


@query(
    "train_test_rmse",
    _line_sql(
        [12], 12,
        f""", scored AS (SELECT k.h, om + k.h <= c AS train, (base + slope * x - y) ** 2 AS e FROM known k JOIN fits f ON f.h = k.h WHERE y IS NOT NULL)
        SELECT CAST(h AS INTEGER) AS horizon, count(*) FILTER (train) AS n_train, {_r2('sqrt(avg(e) FILTER (train))')} AS rmse_train, count(*) FILTER (NOT train) AS n_test, {_r2('sqrt(avg(e) FILTER (NOT train))')} AS rmse_test FROM scored GROUP BY h""",
    ),
)
def _(spark, d):
    out = Q.train_test_rmse(line_table(spark, d, HORIZONS[-1]), [LAST_SALES], cutoff(spark, d, 12), HORIZONS)
    return out.withColumns({c: round_places(c, PLACES) for c in ("rmse_train", "rmse_test")})


@query("forecast_global_line", _line_sql([0], 12, f"SELECT {_LINE_ROWS}", whole=True))
def _(spark, d):
    table = written(L.global_table(line_table(spark, d, HORIZONS[-1]), [LAST_SALES]))
    made = L.direct_forecast(table, [], [LAST_SALES], cutoff(spark, d), HORIZONS, LINE)[0]
    return made.withColumn("prediction", round_places("prediction", PLACES))


@query(
    "tuning_errors_line",
    _line_sql(
        [12], 12,
        f"SELECT config, CAST(h AS INTEGER) AS horizon, {_r2('sum(abs(p - y))')} AS error, count(*) AS n_rows FROM made, (SELECT unnest(['plain', 'scaled']) AS config) WHERE y IS NOT NULL AND h IN (1, 6, 12) GROUP BY ALL",
    ),
)
def _(spark, d):
    """Scaling the feature must not change the errors of a line."""
    specs = {"plain": LINE, "scaled": L.ModelSpec("LinearRegression", scale=True)}
    made = L.tuning_errors(line_table(spark, d, 12), KEYS, [LAST_SALES], [cutoff(spark, d, 12)], [1, 6, 12], specs)
    return made.withColumn("error", round_places("error", PLACES))


@query(
    "forecast_end_to_end_line",
    _line_sql(
        [0], 15,
        f""", modelled AS (SELECT brand, label, om + h AS m, h - 3 AS horizon, p AS yhat FROM made), ahead AS (SELECT * FROM modelled WHERE horizon >= 1),
        span AS (SELECT min(m) - 12 AS lo, max(m) - 12 AS hi, sum(yhat) AS total FROM ahead), past AS (SELECT sum(qty) AS sold FROM lines, span WHERE m BETWEEN lo AND hi),
        whole AS (SELECT * FROM modelled UNION ALL SELECT brand, label, m + 12, horizon + 12, yhat * total / sold FROM ahead, span, past)
        SELECT brand, label, CAST(horizon AS INTEGER) AS horizon, {_r2('yhat')} AS yhat, {ym('m')} AS ym FROM whole WHERE horizon <= 18""",
    ),
)
def _(spark, d):
    actual = lines(spark, d).groupBy("m").agg(F.sum("qty").alias("offtake"))
    out = L.end_to_end(line_table(spark, d, 15), actual, KEYS, [LAST_SALES], cutoff(spark, d), 18, LINE, "offtake")
    return out.select(*KEYS, "horizon", round_places("yhat", PLACES).alias("yhat"), idx_to_ym("m").alias("ym"))


@query(
    "importance_totals",
    with_sql(
        f"""SELECT 'il' AS label, CAST(h - 3 AS INTEGER) AS horizon, {ym('max(m) + 2')} AS cycle_date, {len(FEATURES)}::BIGINT AS n_features, 1.0::DOUBLE AS total
        FROM months, (SELECT unnest(range(1, 13)) AS h) GROUP BY h""",
        "months",
    ),
)
def _(spark, d):
    """Importances of a horizon add up to one over all features."""
    last = cutoff(spark, d)
    table = written(training_table(spark, d, HORIZONS[-1]))
    models = L.direct_forecast(table, KEYS, FEATURES, last, HORIZONS, FOREST)[1]
    long = L.feature_importance(spark, models, FEATURES, "il", last)
    return long.groupBy("label", "horizon", "cycle_date").agg(F.count("*").alias("n_features"), round_places(F.sum("importance")).alias("total"))


_P = "((m + 9) % 12 + 1) / 12.0::DOUBLE"


@query(
    "r6m_table",
    with_sql(
        f"""WITH {_BL}, {_dense_sql('dn', ['brand', 'label'], 'sum(v)', 'bl')}, {_dense_sql('dl', ['label'], 'sum(v)', 'bl')},
        s AS (SELECT brand, label, m, sum(v) OVER w AS t FROM dn WINDOW w AS (PARTITION BY brand, label ORDER BY m RANGE BETWEEN 5 FOLLOWING AND 10 FOLLOWING)),
        t AS (SELECT label, m, coalesce(sum(t), 0) AS target_r6m FROM s GROUP BY ALL), l AS (SELECT label, m, {', '.join(f'coalesce(lag(v, {n - 1}) OVER w, 0) AS label_sales{n}' for n in range(1, 12))} FROM dl WINDOW w AS (PARTITION BY label ORDER BY r))
        SELECT t.label, {ym('t.m')} AS date_when_predicting, {ym('t.m + 10')} AS date_to_predict, 10.0::DOUBLE AS horizon, target_r6m, {', '.join(f'label_sales{n}' for n in range(1, 12))},
        {r4(_P.replace('m +', 't.m +'))} AS month, {r4(f"sin(pi() * ({_P.replace('m +', 't.m +')}))")} AS sin_month, {r4(f"cos(pi() * ({_P.replace('m +', 't.m +')}))")} AS cos_month,
        label_sales1 + label_sales2 + label_sales3 + label_sales4 + label_sales5 + label_sales6 AS last_6_months FROM t JOIN l ON l.label = t.label AND l.m = t.m""",
        "sku_label", "master", "ranked",
    ),
)
def _(spark, d):
    facts = brand_facts(spark, d)
    table = S.supervised_table(facts, KEYS, "m", "offtake", [S.Level("label_", ("label",), "offtake", 11)], 10).filter("horizon = 10")
    totals = target_window(facts, KEYS, "m", "offtake")
    both = table.join(totals, [*KEYS, "date_when_predicting", "date_to_predict"], "left")
    out = S.six_month_table(both, "label").withColumn("target_r6m", F.coalesce("target_r6m", F.lit(0.0)))
    return out.withColumns({c: round_places(c) for c in ("month", "sin_month", "cos_month")})
