"""Queries on panel features and supervised tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandtide.catalog.registry import div, query, r4, with_sql, ym
from demandtide.catalog.roles import bare_panel, channel_lines, hierarchy, leafs, lines, panel, sku_label, table
from demandtide.functions.cleaning import pick_by_key, ratio, round_places
from demandtide.functions.periods import idx_to_ym
from demandtide.operators import panel as P
from demandtide.operators.dense import lag_matrix, target_join, target_window
from demandtide.plans import supervised as S
from demandtide.plans.feature_master import dc_spec, feature_master, il_spec
from demandtide.session import written

_YM = f"{ym('m')} AS ym"


def _done(df, rounded=(), month="m"):
    out = df.withColumn("ym", idx_to_ym(month)).drop(month)
    return out.withColumns({c: round_places(c) for c in rounded}) if rounded else out


def _small(spark, d):
    return bare_panel(spark, d).select("sku", "m", "offtake_il", "sellin_il")


@query(
    "rolled_values",
    with_sql(
        f"""SELECT sku, {_YM}, offtake_il, sellin_il, """
        + ", ".join(
            f"{r4(f'{fn}({v}) OVER w{k}')} AS {v}_{name}_{k}M"
            for k in (3, 6, 12)
            for fn, name in (("avg", "mean"), ("min", "min"), ("max", "max"))
            for v in ("offtake_il", "sellin_il")
        )
        + " FROM panel0 WINDOW "
        + ", ".join(f"w{k} AS (PARTITION BY sku ORDER BY m ROWS {k - 1} PRECEDING)" for k in (3, 6, 12)),
        "panel0",
    ),
)
def _(spark, d):
    out = P.rolled_values(_small(spark, d), ["sku"], "m", ["offtake_il", "sellin_il"], [3, 6, 12])
    return _done(out, [c for c in out.columns if c.endswith("M")])


@query(
    "lagged_features",
    with_sql(
        f"""WITH l AS (SELECT sku, m, offtake_il, sellin_il, {', '.join(f'lag({v}, {k}) OVER (PARTITION BY sku ORDER BY m) AS {v}_l{k}' for v in ('offtake_il', 'sellin_il') for k in (0, 1, 2, 12))} FROM panel0)
        SELECT sku, {_YM}, offtake_il, sellin_il, {', '.join(f'first_value({v}_l{k} IGNORE NULLS) OVER w AS {v}_lag{k}' for v in ('offtake_il', 'sellin_il') for k in (0, 1, 2, 12))}
        FROM l WINDOW w AS (PARTITION BY sku ORDER BY m ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        "panel0",
    ),
)
def _(spark, d):
    return _done(P.lagged_features(_small(spark, d), ["sku"], "m", ["offtake_il", "sellin_il"], [0, 1, 2, 12]))


def _diff(v, p):
    lag = f"lag({v}, {p}) OVER (PARTITION BY sku ORDER BY m)"
    return f"{v} - {lag} AS abs_diff{p}_{v}, {r4(f'coalesce({div(f'{v} - {lag}', v)} - 1.0, 0) * 100.0')} AS rel_diff{p}_{v}"


@query("diff_features", with_sql(f"SELECT sku, {_YM}, sellin_il, {_diff('sellin_il', 1)}, {_diff('sellin_il', 12)} FROM panel0", "panel0"))
def _(spark, d):
    base = bare_panel(spark, d).select("sku", "m", "sellin_il")
    return _done(P.diff_features(base, ["sku"], "m", ["sellin_il"], [1, 12]), ["rel_diff1_sellin_il", "rel_diff12_sellin_il"])


@query(
    "cumulative_minmax",
    with_sql(
        f"""SELECT sku, {_YM}, offtake_il, sellin_il, max(offtake_il) OVER w AS cummax_offtake_il, min(offtake_il) OVER w AS cummin_offtake_il,
        max(sellin_il) OVER w AS cummax_sellin_il, min(sellin_il) OVER w AS cummin_sellin_il FROM panel0 WINDOW w AS (PARTITION BY sku ORDER BY m ROWS UNBOUNDED PRECEDING)""",
        "panel0",
    ),
)
def _(spark, d):
    return _done(P.cumulative_minmax(_small(spark, d), ["sku"], "m", ["offtake_il", "sellin_il"]))


@query("date_totals", with_sql(f"SELECT sku, {_YM}, offtake_il, sellin_il, sum(offtake_il) OVER (PARTITION BY m) AS total_offtake_il, sum(sellin_il) OVER (PARTITION BY m) AS total_sellin_il FROM panel0", "panel0"))
def _(spark, d):
    return _done(P.date_totals(_small(spark, d), "m", ["offtake_il", "sellin_il"]))


@query(
    "share_of_total",
    with_sql(
        f"""SELECT sku, {_YM}, offtake_il, sellin_il, {r4('coalesce(' + div('offtake_il', 'sum(offtake_il) OVER (PARTITION BY m)') + ', 0)')} AS share_of_total_offtake_il,
        {r4('coalesce(' + div('sellin_il', 'sum(sellin_il) OVER (PARTITION BY m)') + ', 0)')} AS share_of_total_sellin_il FROM panel0""",
        "panel0",
    ),
)
def _(spark, d):
    out = P.share_of_total(_small(spark, d), "m", ["offtake_il", "sellin_il"])
    return _done(out, ["share_of_total_offtake_il", "share_of_total_sellin_il"])


@query(
    "share_of_group",
    with_sql(
        f"""SELECT sku, brand, tier, {_YM}, sellin_il, {r4('coalesce(' + div('sellin_il', 'sum(sellin_il) OVER (PARTITION BY m, brand)') + ', 0)')} AS share_of_brand_sellin_il,
        {r4('coalesce(' + div('sellin_il', 'sum(sellin_il) OVER (PARTITION BY m, tier)') + ', 0)')} AS share_of_tier_sellin_il FROM panel""",
        "panel",
    ),
)
def _(spark, d):
    out = P.share_of_group(panel(spark, d).select("sku", "brand", "tier", "m", "sellin_il"), "m", ["brand", "tier"], ["sellin_il"])
    return _done(out, ["share_of_brand_sellin_il", "share_of_tier_sellin_il"])


@query(
    "rel_to_group_avg",
    with_sql(
        f"""SELECT sku, brand, tier, {_YM}, sellin_il, {r4('coalesce(' + div('sellin_il', 'avg(sellin_il) OVER (PARTITION BY m, brand)') + ', 0)')} AS sellin_il_rel_to_brand_average,
        {r4('coalesce(' + div('sellin_il', 'avg(sellin_il) OVER (PARTITION BY m, tier)') + ', 0)')} AS sellin_il_rel_to_tier_average FROM panel""",
        "panel",
    ),
)
def _(spark, d):
    out = P.relative_to_group_mean(panel(spark, d).select("sku", "brand", "tier", "m", "sellin_il"), "m", ["brand", "tier"], ["sellin_il"])
    return _done(out, ["sellin_il_rel_to_brand_average", "sellin_il_rel_to_tier_average"])


@query(
    "months_since_first",
    with_sql(f"SELECT sku, {_YM}, sellin_di, sellin_eib, m - min(m) FILTER (sellin_di > 0) OVER w AS months_since_first_sellin_di_gt0, m - min(m) FILTER (sellin_eib > 0) OVER w AS months_since_first_sellin_eib_gt0 FROM panel0 WINDOW w AS (PARTITION BY sku)", "panel0"),
)
def _(spark, d):
    base = bare_panel(spark, d).select("sku", "m", "sellin_di", "sellin_eib")
    return _done(P.months_since_first(base, ["sku"], "m", ["sellin_di", "sellin_eib"]))


@query(
    "sku_age",
    with_sql(
        f"""WITH t AS (SELECT sku, m, sellin_il, offtake_di, min(sellin_il) OVER t AS a, min(offtake_di) OVER t AS b, max(sellin_il) OVER g AS ta, max(offtake_di) OVER g AS tb FROM panel0
          WINDOW t AS (PARTITION BY sku ORDER BY m ROWS 2 PRECEDING), g AS (PARTITION BY sku))
        SELECT sku, {_YM}, sellin_il, offtake_di, m - min(m) FILTER (a >= 10 AND a > ta * 0.05) OVER g AS age_sellin_il, m - min(m) FILTER (b >= 10 AND b > tb * 0.05) OVER g AS age_offtake_di
        FROM t WINDOW g AS (PARTITION BY sku)""",
        "panel0",
    ),
)
def _(spark, d):
    base = bare_panel(spark, d).select("sku", "m", "sellin_il", "offtake_di")
    return _done(P.sku_age(base, ["sku"], "m", ["sellin_il", "offtake_di"], 10.0, 0.05))


@query(
    "cum_delta",
    with_sql(f"SELECT sku, {_YM}, sellin_il, offtake_il, sellin_il - offtake_il AS offtake_sellin_delta_il, sum(sellin_il - offtake_il) OVER (PARTITION BY sku ORDER BY m ROWS UNBOUNDED PRECEDING) AS cumulated_offtake_sellin_delta_il FROM panel0", "panel0"),
)
def _(spark, d):
    return _done(P.cumulative_delta(_small(spark, d), ["sku"], "m", "sellin_il", "offtake_il", "offtake_sellin_delta_il"))


@query(
    "fill_down",
    """SELECT event_id, event_type, last_value(section IGNORE NULLS) OVER (PARTITION BY strftime(ts, '%Y%m') ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS section_name
        FROM (SELECT *, CASE WHEN event_type = 'signup' AND value > 100 THEN 'section ' || CAST(event_id AS VARCHAR) END AS section FROM events)""",
)
def _(spark, d):
    """Section headers carried down a sheet; one month of events is one sheet."""
    header = F.when(
        (F.col("event_type") == "signup") & (F.col("value") > 100), F.concat(F.lit("section "), F.col("event_id").cast("string"))
    )
    sheet = table(spark, d, "events").select("event_id", "event_type", F.date_format("ts", "yyyyMM").alias("sheet"), header.alias("section"))
    return P.fill_down(sheet, "sheet", "event_id", "section", "section_name").select("event_id", "event_type", "section_name")


@query(
    "encode_categories",
    with_sql("SELECT sku, p_name, brand, " + ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_code" for c in ("sku", "brand", "p_name")) + " FROM master", "master"),
)
def _(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("sku"), "p_name", F.col("p_brand").alias("brand"))
    return P.encode_categories(part, ["sku", "brand", "p_name"])


@query(
    "cum_open_orders",
    with_sql(
        f"""WITH s AS (SELECT label, channel, om, m, sum(qty) AS qty FROM channel_lines GROUP BY ALL)
        SELECT label, channel, {ym('om')} AS date_when_predicting, {ym('m')} AS date_to_predict, qty, sum(qty) OVER (PARTITION BY label, channel, om ORDER BY m ROWS UNBOUNDED PRECEDING) AS open_orders FROM s""",
        "channel_lines",
    ),
)
def _(spark, d):
    """Orders known in a month, summed up over the months they ship in."""
    known = channel_lines(spark, d).groupBy("label", "channel", "om", "m").agg(F.sum("qty").alias("qty"))
    run = P.running_sum(known, ["label", "channel", "om"], "m", "qty", "open_orders")
    return run.select("label", "channel", idx_to_ym("om").alias("date_when_predicting"), idx_to_ym("m").alias("date_to_predict"), "qty", "open_orders")


def _brand_tier(spark, d):
    """Panel at brand and tier with the three scopes side by side."""
    cols = ("offtake_di", "offtake_eib", "offtake_il", "sellin_di", "sellin_eib", "sellin_il")
    return panel(spark, d).groupBy("brand", "tier", "m").agg(*[F.sum(c).alias(c) for c in cols])


def _roll_sql(v, k, part="brand, tier"):
    w = f"OVER (PARTITION BY {part} ORDER BY m ROWS {k - 1} PRECEDING)"
    return ", ".join(f"{r4(f'coalesce({fn}({v}) {w}, 0)')} AS {v}_{n}_{k}M" for fn, n in (("avg", "mean"), ("min", "min"), ("max", "max")))


_W = "OVER (PARTITION BY brand, tier ORDER BY m)"
_CUM = "OVER (PARTITION BY brand, tier ORDER BY m ROWS UNBOUNDED PRECEDING)"
_AHEAD = "OVER (PARTITION BY brand, tier ORDER BY m ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_IL = ("offtake_di", "offtake_eib", "sellin_di", "sellin_eib")
_IL_OFF = ("offtake_di", "offtake_eib")
_IL_ROLLED = [*_IL, *[f"share_of_total_{m}" for m in _IL_OFF], *[f"{k}_diff1_{m}" for m in _IL_OFF for k in ("abs", "rel")], "offtake_sellin_delta_di", "offtake_sellin_delta_eib"]
_CODES = ("brand", "tier")


def _il_sql():
    base = f"""bt AS (SELECT brand, tier, m, {', '.join(f'sum({c}) AS {c}' for c in _IL)} FROM panel GROUP BY ALL),
     f1 AS (SELECT *, {', '.join(f"sum({m}) OVER (PARTITION BY m) AS total_{m}, coalesce({div(m, f'sum({m}) OVER (PARTITION BY m)')}, 0) AS share_of_total_{m}, coalesce({div(m, f'sum({m}) OVER (PARTITION BY m, brand)')}, 0) AS share_of_brand_{m}, m - min(m) FILTER ({m} > 0) OVER (PARTITION BY brand, tier) AS months_since_first_{m}_gt0, {m} - lag({m}, 1) {_W} AS abs_diff1_{m}, {m} - lag({m}, 12) {_W} AS abs_diff12_{m}" for m in _IL)},
       sellin_di - offtake_di AS offtake_sellin_delta_di, sellin_eib - offtake_eib AS offtake_sellin_delta_eib FROM bt),
     f2 AS (SELECT *, {', '.join(f"coalesce({div(f'abs_diff{p}_{m}', m)} - 1.0, 0) * 100.0 AS rel_diff{p}_{m}" for m in _IL for p in (1, 12))},
       {', '.join(f'lag({m}, {k}) {_W} AS {m}_l{k}' for m in _IL for k in (0, 1, 2))}, {', '.join(f'lag(abs_diff1_{m}, {k}) {_W} AS abs_diff1_{m}_l{k}' for m in _IL for k in (3,))} FROM f1)"""
    cols = [f"{c}" for c in ("brand", "tier", *_IL)]
    cols += [f"total_{m}, {r4(f'share_of_total_{m}')} AS share_of_total_{m}, {r4(f'share_of_brand_{m}')} AS share_of_brand_{m}, months_since_first_{m}_gt0, abs_diff1_{m}, abs_diff12_{m}, {r4(f'rel_diff1_{m}')} AS rel_diff1_{m}, {r4(f'rel_diff12_{m}')} AS rel_diff12_{m}, max({m}) {_CUM} AS cummax_{m}, min({m}) {_CUM} AS cummin_{m}" for m in _IL]
    cols += [f"first_value({m}_l{k} IGNORE NULLS) {_AHEAD} AS {m}_lag{k}" for m in _IL for k in (0, 1, 2)]
    cols += [f"first_value(abs_diff1_{m}_l3 IGNORE NULLS) {_AHEAD} AS abs_diff1_{m}_lag3" for m in _IL]
    cols += [f"offtake_sellin_delta_{x}, sum(offtake_sellin_delta_{x}) {_CUM} AS cumulated_offtake_sellin_delta_{x}" for x in ("di", "eib")]
    cols += [_roll_sql(v, k) for v in _IL_ROLLED for k in (3, 12)]
    cols += [f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_code" for c in _CODES]
    cols += ["CAST((m - 1) % 12 + 1 AS INTEGER) AS month_int, CAST((m - 1) % 12 AS INTEGER) AS month_cat", _YM]
    return with_sql(f"WITH {base} SELECT {', '.join(cols)} FROM f2", "panel")


@query("feature_master_il", _il_sql())
def _(spark, d):
    spec = il_spec(["brand", "tier"], labels=("di", "eib"), groups=("brand",), codes=_CODES, diffs=(1, 12), windows=(3, 12), diff_lags=(3,))
    base = _brand_tier(spark, d).drop("offtake_il", "sellin_il")
    out = feature_master(base, "m", spec)
    rounded = [c for c in out.columns if c.endswith("M") or c.startswith(("share_", "rel_diff"))]
    return _done(out, rounded)


_DC = ("offtake_dc", "anp", "sellin_dc", "sellout", "sellout_revenue", "sellout_price")
_DC_SIZES = {"offtake_dc": (3, 6, 9)}


@query(
    "feature_master_dc",
    with_sql(
        f"""WITH dc AS (SELECT sku, m, sum(qty) AS offtake_dc, sum(kept) / 4 AS anp, sum(kept) AS sellin_dc, max(qty) AS sellout, floor(sum(amount) * 100 + 0.5) / 100 AS sellout_revenue,
            floor(sum(amount) * 100 + 0.5) / 100 / sum(qty) AS sellout_price FROM lines GROUP BY ALL)
        SELECT sku, {_YM}, offtake_dc, anp, sellin_dc, sellout, sellout_revenue, {r4('sellout_price')} AS sellout_price,
        {', '.join(_roll_sql(v, k, 'sku') for v in _DC for k in _DC_SIZES.get(v, (3, 6)))},
        {', '.join(f'max({v}) OVER w AS cummax_{v}, min({v}) OVER w AS cummin_{v}' for v in ('offtake_dc', 'sellin_dc', 'sellout'))},
        CAST(dense_rank() OVER (ORDER BY sku) - 1 AS INTEGER) AS sku_code, CAST((m - 1) % 12 + 1 AS INTEGER) AS month_int, CAST((m - 1) % 12 AS INTEGER) AS month_cat
        FROM dc WINDOW w AS (PARTITION BY sku ORDER BY m ROWS UNBOUNDED PRECEDING)""",
        "lines",
    ),
)
def _(spark, d):
    base = lines(spark, d).groupBy("sku", "m").agg(
        F.sum("qty").alias("offtake_dc"),
        (F.sum("kept") / 4).alias("anp"),
        F.sum("kept").alias("sellin_dc"),
        F.max("qty").alias("sellout"),
        round_places(F.sum("amount"), 2).alias("sellout_revenue"),
        (round_places(F.sum("amount"), 2) / F.sum("qty")).alias("sellout_price"),
    )
    out = feature_master(base, "m", dc_spec(["sku"], codes=["sku"]))
    return _done(out, [c for c in out.columns if c.endswith("M") or c == "sellout_price"])


def _dense_sql(name, keys, value, facts):
    k = ", ".join(keys)
    return f"""{name} AS (SELECT {', '.join('k.' + x for x in keys)}, r.m, r.r, coalesce(s.v, 0) AS v FROM (SELECT DISTINCT {k} FROM {facts}) k CROSS JOIN ranked r
      LEFT JOIN (SELECT {k}, m, {value} AS v FROM {facts} GROUP BY ALL) s ON {' AND '.join(f's.{x} = k.{x}' for x in keys)} AND s.m = r.m)"""


@query(
    "lag_matrix",
    with_sql(
        f"""WITH {_dense_sql('dn', ['sku'], 'sum(qty)', 'lines')}
        SELECT sku, {ym('m')} AS date_when_predicting, {', '.join(f'coalesce(lag(v, {n - 1}) OVER w, 0) AS sku_sales{n}' for n in range(1, 13))} FROM dn WINDOW w AS (PARTITION BY sku ORDER BY r)""",
        "lines",
        "ranked",
    ),
)
def _(spark, d):
    return lag_matrix(lines(spark, d), ["sku"], "m", "qty", "sku_")


_BL = "bl AS (SELECT brand, label, m, sum(offtake) AS v FROM sku_label JOIN master USING (sku) GROUP BY ALL)"


@query(
    "target_join",
    with_sql(
        f"""WITH {_BL}, {_dense_sql('dn', ['brand', 'label'], 'sum(v)', 'bl')}
        SELECT t.brand, t.label, {ym('o.m')} AS date_when_predicting, {ym('t.m')} AS date_to_predict, t.v AS target FROM dn t JOIN months o ON t.m - o.m BETWEEN 1 AND 12""",
        "sku_label",
        "master",
        "ranked",
    ),
)
def _(spark, d):
    facts = sku_label(spark, d).join(hierarchy(spark, d), "sku")
    return target_join(facts, ["brand", "label"], "m", "offtake", 12)


@query(
    "target_r6m",
    with_sql(
        f"""WITH {_dense_sql('dn', ['sku'], 'sum(qty)', 'lines')}, s AS (SELECT sku, m, sum(v) OVER w AS t, count(*) OVER w AS n FROM dn WINDOW w AS (PARTITION BY sku ORDER BY m RANGE BETWEEN 5 FOLLOWING AND 10 FOLLOWING))
        SELECT sku, {ym('m')} AS date_when_predicting, {ym('m + 10')} AS date_to_predict, t AS target_r6m FROM s WHERE n > 0""",
        "lines",
        "ranked",
    ),
)
def _(spark, d):
    return target_window(lines(spark, d), ["sku"], "m", "qty")


@query(
    "category_features",
    with_sql(
        f"""WITH c AS (SELECT m, sum(offtake_il) AS total_vol, {', '.join(f"coalesce(sum(offtake_il) FILTER (tier = '{t}'), 0) AS {t.lower()}_vol" for t in ('ECONOMY', 'PROMO', 'SMALL'))} FROM panel GROUP BY m)
        SELECT {ym('m')} AS date_to_predict, total_vol, economy_vol, promo_vol, small_vol FROM c""",
        "panel",
    ),
)
def _(spark, d):
    """Category volumes carried on every panel row, read back once per target month."""
    rows = panel(spark, d).select("sku", "m", "tier", "offtake_il")
    volumes = rows.groupBy("m").agg(
        F.sum("offtake_il").alias("total_vol"),
        *[F.sum(F.when(F.col("tier") == t, F.col("offtake_il")).otherwise(0.0)).alias(f"{t.lower()}_vol") for t in ("ECONOMY", "PROMO", "SMALL")],
    )
    wide = rows.join(F.broadcast(volumes), "m")  # one row per calendar month
    targets = rows.select("m").distinct()
    out = S.category_features(wide, "m", ["total_vol", "economy_vol", "promo_vol", "small_vol"], targets)
    return out.withColumn("date_to_predict", idx_to_ym("m")).drop("m")


@query(
    "neighbour_forecasts",
    with_sql(
        f"""WITH f AS (SELECT brand, cycle, m, sum(forecast) AS forecast FROM leafs GROUP BY ALL)
        SELECT f.brand, {ym('f.cycle')} AS cycle_month, {ym('f.m')} AS ym, f.forecast, {', '.join(f'f{i}.forecast AS "forecast_{o}"' for i, o in enumerate((-3, -2, -1, 1, 2, 3)))} FROM f
        {' '.join(f'LEFT JOIN f f{i} ON f{i}.brand = f.brand AND f{i}.cycle = f.cycle AND f{i}.m = f.m - ({o})' for i, o in enumerate((-3, -2, -1, 1, 2, 3)))}""",
        "leafs",
    ),
)
def _(spark, d):
    out = S.neighbour_forecasts(leafs(spark, d), ["brand"], "cycle", "m", "forecast")
    return out.withColumn("cycle_month", idx_to_ym("cycle")).withColumn("ym", idx_to_ym("m")).drop("cycle", "m")


def _table_sql(facts, leaf, target, levels, horizon, hot=(), extra="", hot_column="label"):
    """SQL of a supervised table: dense sums per level, lags by window, origins joined by month."""
    ctes, joins, cols = [], [], []
    for i, level in enumerate(levels):
        how = "sum" if level.how == "sum" else "avg"
        ctes.append(_dense_sql(f"d{i}", list(level.keys), f"{how}({level.value})", facts))
        lags = ", ".join(f"coalesce(lag(v, {n - 1}) OVER w, 0) AS {level.prefix}sales{n}" for n in range(1, level.timelag + 1))
        ctes.append(f"l{i} AS (SELECT {', '.join(level.keys)}, m, {lags} FROM d{i} WINDOW w AS (PARTITION BY {', '.join(level.keys)} ORDER BY r))")
        joins.append(f"LEFT JOIN l{i} ON {' AND '.join(f'l{i}.{k} = b.{k}' for k in level.keys)} AND l{i}.m = b.m")
        cols += [r4(f"{level.prefix}sales{n}") + f" AS {level.prefix}sales{n}" for n in range(1, level.timelag + 1)]
    ctes.append(_dense_sql("b", list(leaf), f"sum({target})", facts))
    dtp = "(b.m + h)"
    part = f"(({dtp} - 1) % 12 + 1) / 12.0::DOUBLE"
    hots = "".join(f", CASE WHEN b.{hot_column} = '{v}' THEN 1 ELSE 0 END AS {v}" for v in hot)
    return (
        f"WITH {extra}{', '.join(ctes)} SELECT {', '.join('b.' + k for k in leaf)}, {ym('b.m')} AS date_when_predicting, {ym(dtp)} AS date_to_predict, h AS horizon, "
        f"{', '.join(cols)}, {r4(part)} AS month, {r4(f'sin(pi() * ({part}))')} AS sin_month, {r4(f'cos(pi() * ({part}))')} AS cos_month, t.v AS target{hots} "
        f"FROM b CROSS JOIN (SELECT CAST(unnest(range(1, {horizon + 1})) AS INTEGER) AS h) {' '.join(joins)} "
        f"LEFT JOIN b t ON {' AND '.join(f't.{k} = b.{k}' for k in leaf)} AND t.m = b.m + h"
    )


def _rounded_table(df):
    wide = [c for c in df.columns if "sales" in c or c in ("month", "sin_month", "cos_month")]
    return df.withColumns({c: round_places(c) for c in wide})


# A series here is a brand and tier under a scope; the brand stands for the country, the tier for the stage.
_SERIES_SQL = """fx AS (SELECT brand || '_' || tier AS sku_wo_pkg, brand AS country, tier AS stage, label, m, sum(qty) AS offtake, sum(kept) AS sellin,
    max(qty) AS sellout, floor(sum(amount) * 100 + 0.5) / 100 / sum(qty) AS sellout_price, sum(kept) / 4 AS anp, count(*)::DOUBLE AS store_distribution FROM lines JOIN master USING (sku) GROUP BY ALL), """
_LEAF = ["country", "stage", "label", "sku_wo_pkg"]


def series_facts(spark, d):
    sums = lines(spark, d).groupBy("sku", "label", "m").agg(
        F.sum("qty").alias("qty"), F.sum("kept").alias("kept"), F.max("qty").alias("top"), F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n")
    )
    known = sums.join(hierarchy(spark, d), "sku")
    return known.groupBy(
        F.concat_ws("_", "brand", "tier").alias("sku_wo_pkg"), F.col("brand").alias("country"), F.col("tier").alias("stage"), "label", "m"
    ).agg(
        F.sum("qty").alias("offtake"),
        F.sum("kept").alias("sellin"),
        F.max("top").alias("sellout"),
        (round_places(F.sum("amount"), 2) / F.sum("qty")).alias("sellout_price"),
        (F.sum("kept") / 4).alias("anp"),
        F.sum("n").cast("double").alias("store_distribution"),
    )


_IL_LEVELS = S.il_levels(_LEAF, "sku_wo_pkg", "label", "country", "stage")
HORIZON, ORIGINS = 12, 24


def origins(spark, d):
    """The last two years of months, as month indices: the origins that a backtest forecasts from."""
    last = lines(spark, d).agg(F.max("m").alias("m")).first().m
    return list(range(last - ORIGINS + 1, last + 1))


def _of_origins(sql):
    return f"SELECT * FROM ({sql}) WHERE date_when_predicting IN (SELECT {ym('m - k')} FROM (SELECT max(m) AS m FROM lines), (SELECT unnest(range({ORIGINS})) AS k))"


@query("feature_table_il", with_sql(_of_origins(_table_sql("fx", _LEAF, "offtake", _IL_LEVELS, HORIZON, ("di", "eib"), _SERIES_SQL)), "lines", "master", "ranked"))
def _(spark, d):
    out = S.supervised_table(series_facts(spark, d), _LEAF, "m", "offtake", _IL_LEVELS, HORIZON, origins(spark, d), ("label", ("di", "eib")))
    return _rounded_table(out)


_DC_LEAF = ["label", "sku_wo_pkg"]
_DC_LEVELS = S.dc_levels(_DC_LEAF, "sku_wo_pkg", "label")


@query("feature_table_dc", with_sql(_of_origins(_table_sql("fx", _DC_LEAF, "offtake", _DC_LEVELS, HORIZON, (), _SERIES_SQL)), "lines", "master", "ranked"))
def _(spark, d):
    return _rounded_table(S.supervised_table(series_facts(spark, d), _DC_LEAF, "m", "offtake", _DC_LEVELS, HORIZON, origins(spark, d)))


_DI_LEAF = ["brand", "label", "channel"]
_DI_HORIZON = 12
# The months of the DI sales, which are fewer than those of all sales.
_DI_FACTS = """fs AS (SELECT brand, label, channel, m, sum(qty) AS offtake FROM channel_lines JOIN master USING (sku) WHERE label = 'di' GROUP BY ALL),
    rdi AS (SELECT m, CAST(row_number() OVER (ORDER BY m) AS INTEGER) AS r FROM (SELECT DISTINCT m FROM fs)), """


def _around_sql(value, factor, delta, shift):
    """A forecast with its neighbours, under the month it was known in."""

    def near(i):
        return f"max(v) OVER (PARTITION BY brand, cy ORDER BY m RANGE BETWEEN {abs(i)} {'PRECEDING' if i > 0 else 'FOLLOWING'} AND {abs(i)} {'PRECEDING' if i > 0 else 'FOLLOWING'})"

    offsets = [*range(-delta, 0), *range(1, delta + 1)]
    return f"""(SELECT brand, {ym('cy')} AS dwp, {ym('m')} AS dtp, v AS {value}, {', '.join(f'{near(i)} AS "{value}_{i}"' for i in offsets)}
        FROM (SELECT brand, cycle - {shift} AS cy, m, sum(forecast) * {factor} AS v FROM leafs GROUP BY ALL))"""


def _di_sql():
    table_ = _table_sql("fs", _DI_LEAF, "offtake", S.di_levels(_DI_LEAF, "brand", "label"), _DI_HORIZON, (), _DI_FACTS).replace("CROSS JOIN ranked r", "CROSS JOIN rdi r")
    on = "{0}.brand = t.brand AND {0}.dwp = t.date_when_predicting AND {0}.dtp = t.date_to_predict"
    return (
        f"SELECT t.*, p.* EXCLUDE (brand, dwp, dtp), q.* EXCLUDE (brand, dwp, dtp) FROM ({table_}) t "
        f"LEFT JOIN {_around_sql('forecast', 1.0, 5, 3)} p ON {on.format('p')} LEFT JOIN {_around_sql('forecast_eln', 1.25, 3, 2)} q ON {on.format('q')}"
    )


@query("feature_table_di", with_sql(_di_sql(), "channel_lines", "master", "leafs"))
def _(spark, d):
    """Channel in the role of the package; the sell-in plan and planner forecast are the lagged forecasts per brand."""
    plan = leafs(spark, d).groupBy("brand", "cycle", "m").agg(F.sum("forecast").alias("forecast"))
    planner = plan.withColumn("forecast_eln", F.col("forecast") * 1.25).drop("forecast")
    sums = channel_lines(spark, d).filter("label = 'di'").groupBy("sku", "label", "channel", "m").agg(F.sum("qty").alias("offtake"))
    sales = sums.join(hierarchy(spark, d), "sku").groupBy("brand", "label", "channel", "m").agg(F.sum("offtake").alias("offtake"))
    return _rounded_table(S.di_table(sales, _DI_LEAF, "brand", "label", "m", plan, planner, ["brand"], _DI_HORIZON))


_BRAND_LEAF = ["label", "country", "brand", "country_brand"]
_PRICES = ("price", "upre", "spre", "mainstream")
_PRICE_TIERS = {"mainstream": "ECONOMY", "spre": "PROMO", "upre": "LARGE"}
_BRAND_LEVELS = S.brand_levels("label", "country", "brand", "country_brand", _PRICES)
_BRAND_SQL = f"""tp AS (SELECT m, {', '.join(f"coalesce({div(f"sum(qty) FILTER (tier = '{t}')", f"count(*) FILTER (tier = '{t}')")}, 0) AS {c}" for c, t in _PRICE_TIERS.items())} FROM lines JOIN master USING (sku) GROUP BY m),
    fb AS (SELECT f.*, upre, spre, mainstream FROM (SELECT label, tier AS country, brand, tier || '_' || brand AS country_brand, m, sum(qty) AS offtake, sum(kept) AS sellin, floor(sum(amount) * 100 + 0.5) / 100 / sum(qty) AS price
        FROM lines JOIN master USING (sku) GROUP BY ALL) f JOIN tp USING (m)),
    cat AS (SELECT CAST((m - 1) // 12 * 100 + (m - 1) % 12 + 1 AS INTEGER) AS date_to_predict, sum(qty) AS total_vol FROM lines GROUP BY ALL), """


def tier_prices(known):
    """Mean line quantity of three tiers by month, in the role of their prices."""

    def of(tier):
        own = F.col("tier") == tier
        return ratio(F.sum(F.when(own, F.col("qty"))), F.sum(F.when(own, F.col("n"))), 0)

    return known.groupBy("m").agg(*[of(t).alias(c) for c, t in _PRICE_TIERS.items()])


def _brand_facts(spark, d):
    sums = lines(spark, d).groupBy("sku", "label", "m").agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept"), F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    known = written(sums.join(hierarchy(spark, d), "sku"), "brand-lines")
    price = (round_places(F.sum("amount"), 2) / F.sum("qty")).alias("price")
    facts = known.groupBy("label", F.col("tier").alias("country"), "brand", "m").agg(F.sum("qty").alias("offtake"), F.sum("kept").alias("sellin"), price)
    return facts.join(F.broadcast(tier_prices(known)), "m")  # one row per calendar month


@query(
    "feature_table_brand",
    with_sql(
        _of_origins(
            _table_sql("fb", _BRAND_LEAF, "offtake", _BRAND_LEVELS, HORIZON, ("di", "eib"), _BRAND_SQL).replace(" t.v AS target", " t.v AS target, cat.total_vol")
            + " JOIN cat ON cat.date_to_predict = " + ym("b.m + h")
        ),
        "lines", "master", "ranked",
    ),
)
def _(spark, d):
    facts = _brand_facts(spark, d)
    category = facts.groupBy(idx_to_ym("m").alias("date_to_predict")).agg(F.sum("offtake").alias("total_vol"))
    out = S.brand_table(facts, "label", "country", "brand", "m", HORIZON, ("di", "eib"), category, origins=origins(spark, d), prices=_PRICES)
    return _rounded_table(out)


@query(
    "feature_table_subbrand",
    with_sql(
        f"""WITH tp AS (SELECT m, {', '.join(f"coalesce({div(f"sum(qty) FILTER (tier = '{t}')", f"count(*) FILTER (tier = '{t}')")}, 0) AS {c}" for t, c in (('ECONOMY', 'mainstream'), ('PROMO', 'spre'), ('LARGE', 'upre')))} FROM lines JOIN master USING (sku) GROUP BY m),
        sb AS (SELECT brand || '_' || tier AS sub_brand, tier, m, sum(qty) AS offtake FROM lines JOIN master USING (sku) GROUP BY ALL),
        j AS (SELECT sb.*, CASE tier WHEN 'ECONOMY' THEN mainstream WHEN 'PROMO' THEN spre WHEN 'LARGE' THEN upre END AS price FROM sb JOIN tp USING (m)),
        rw AS (SELECT sub_brand, tier, m, offtake, {r4('price')} AS price, {', '.join(f"{r4(f'avg(offtake) OVER (PARTITION BY sub_brand ORDER BY m ROWS {k - 1} PRECEDING)')} AS offtake_mean_{k}M" for k in (3, 6, 12, 24))} FROM j),
        {_dense_sql('dn', ['sub_brand'], 'sum(offtake)', 'sb')},
        lg AS (SELECT sub_brand, m, {', '.join(f'coalesce(lag(v, {n - 1}) OVER w, 0) AS sub_brand_sales{n}' for n in range(1, 7))} FROM dn WINDOW w AS (PARTITION BY sub_brand ORDER BY r))
        SELECT rw.* EXCLUDE (m), {ym('rw.m')} AS date_when_predicting, {', '.join(f'sub_brand_sales{n}' for n in range(1, 7))} FROM rw JOIN lg ON lg.sub_brand = rw.sub_brand AND lg.m = rw.m""",
        "lines", "master", "ranked",
    ),
)
def _(spark, d):
    """Sub-brands with the price of their own tier, trailing means up to two years and lags."""
    sums = lines(spark, d).groupBy("sku", "m").agg(F.sum("qty").alias("qty"), F.count(F.lit(1)).alias("n"))
    known = sums.join(hierarchy(spark, d), "sku")
    tiers = {t: c for c, t in _PRICE_TIERS.items()}
    prices = tier_prices(known)
    facts = known.groupBy(F.concat_ws("_", "brand", "tier").alias("sub_brand"), "tier", "m").agg(F.sum("qty").alias("offtake"))
    priced = facts.join(F.broadcast(prices), "m")  # one row per calendar month
    panel_ = priced.select("sub_brand", "tier", "m", "offtake", pick_by_key("tier", tiers).alias("price"))
    rolled = P.rolled_values(panel_, ["sub_brand"], "m", ["offtake"], [3, 6, 12, 24])
    keep = ["sub_brand", "tier", "m", "offtake", "price", *[f"offtake_mean_{k}M" for k in (3, 6, 12, 24)]]
    lags = lag_matrix(facts, ["sub_brand"], "m", "offtake", "sub_brand_", timelag=6)
    left = rolled.select(*keep).withColumn("date_when_predicting", idx_to_ym("m")).drop("m")
    out = left.join(lags, ["sub_brand", "date_when_predicting"])
    return out.withColumns({c: round_places(c) for c in keep if c == "price" or c.endswith("M")})
