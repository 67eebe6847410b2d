"""Queries on forecast post-processing, granularity splits and scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandtide.catalog.registry import date_of, div, query, r4, with_sql, ym
from demandtide.catalog.roles import CHANNELS, bare_panel, channel_lines, channel_months, dealt, flow_cube, hierarchy, last_month, lines, sku_label, table
from demandtide.functions.cleaning import round_places
from demandtide.functions.periods import idx_month, idx_to_date, idx_to_ym, iso_week_mondays
from demandtide.operators.aggregating import group_sum
from demandtide.operators.joining import dealt_lookup
from demandtide.plans import granularity as G, postprocess as O, scenario as Z
from demandtide.session import written

_YM = f"{ym('m')} AS ym"

# Forecasts past the last month: last year's month, growing with the horizon; IL a quarter above its children.
_FUT = """fut AS (SELECT sku, label, m + 12 AS m, m + 12 - (SELECT max(m) FROM lines) AS horizon, offtake * (1 + (m + 12 - (SELECT max(m) FROM lines)) / 64.0::DOUBLE) AS prediction
    FROM sku_label WHERE m + 12 > (SELECT max(m) FROM lines)),
  fall AS (SELECT * FROM fut UNION ALL SELECT sku, 'il', m, horizon, sum(prediction) * 1.25 FROM fut GROUP BY sku, m, horizon)"""


def future(spark, d, cube=None, last=None):
    """Forecasts from the sales, or from a stored ``cube`` of them; ``last`` is the newest month where the cube may lack it."""
    sales = sku_label(spark, d) if cube is None else group_sum(cube, ["sku", "label", "m"], ["qty"]).withColumnRenamed("qty", "offtake")
    if last is None:
        last = last_month(spark, d) if cube is None else cube.agg(F.max("m").alias("last")).scalar()
    ahead = sales.withColumn("m", F.col("m") + 12).withColumn("horizon", F.col("m") - last).filter("horizon > 0")
    return ahead.select("sku", "label", "m", "horizon", (F.col("offtake") * (1 + F.col("horizon") / 64.0)).alias("prediction"))


def future_all(spark, d, cube=None, last=None):
    """DI and EIB with IL above them; the sales are read once, IL is a sum over a second copy of each row."""
    rows = future(spark, d, cube, last)
    il = F.lit("il")
    copies = F.array(F.struct(F.col("label"), F.col("prediction").alias("p")), F.struct(il.alias("label"), (F.col("prediction") * 1.25).alias("p")))
    both = rows.select("sku", "m", "horizon", F.explode(copies).alias("e"))
    return both.groupBy("sku", F.col("e.label").alias("label"), "m", "horizon").agg(F.sum("e.p").alias("prediction"))


def _out(df, *rounded):
    return df.withColumn("ym", idx_to_ym("m")).drop("m").withColumns({c: round_places(c) for c in rounded})


@query(
    "extend_forecast",
    with_sql(
        f"""WITH {_FUT}, w AS (SELECT sku, m, horizon, sum(prediction) AS yhat FROM fut GROUP BY ALL),
        r AS (SELECT (SELECT sum(yhat) FROM w WHERE horizon >= 1) / (SELECT sum(qty) FROM lines WHERE m BETWEEN (SELECT min(m) - 12 FROM w) AND (SELECT max(m) - 12 FROM w)) AS ratio)
        SELECT sku, {_YM}, CAST(horizon AS INTEGER) AS horizon, {r4('yhat')} AS yhat FROM w
        UNION ALL SELECT sku, {ym('m + 12 * n')}, CAST(horizon + 12 * n AS INTEGER), {r4('yhat * pow(ratio, n)')} FROM w, r, (SELECT CAST(unnest([1, 2]) AS INTEGER) AS n)""",
        "sku_label", "lines",
    ),
)
def _(spark, d):
    forecast = written(future(spark, d).groupBy("sku", "m", "horizon").agg(F.sum("prediction").alias("yhat")), "forecasts")
    actual = lines(spark, d).groupBy("m").agg(F.sum("qty").alias("offtake"))
    return _out(O.extend_forecast(forecast, actual, "m", ["yhat"], "yhat", "offtake", years=2), "yhat")


_BL = """bl AS (SELECT brand, label, m, sum(offtake) AS v FROM sku_label JOIN master USING (sku) GROUP BY ALL)"""


@query(
    "seasonal_ratio",
    with_sql(
        f"""WITH {_BL} SELECT a.brand, a.label, {ym('a.m')} AS ym, a.v AS offtake, {r4(div('a.v', 'coalesce(p.v, 0) + coalesce(n.v, 0)'))} AS season_ratio
        FROM bl a LEFT JOIN bl p ON p.brand = a.brand AND p.label = a.label AND p.m = a.m - 1 LEFT JOIN bl n ON n.brand = a.brand AND n.label = a.label AND n.m = a.m + 1""",
        "sku_label", "master",
    ),
)
def _(spark, d):
    facts = sku_label(spark, d).join(hierarchy(spark, d), "sku")
    return _out(O.seasonal_ratio(facts, ["brand", "label"], "m", "offtake"), "season_ratio")


_CNY = ", ".join(f"({y}, {int(x[:2]) + (1 if int(x[3:]) > 24 else 0)})" for y, x in __import__("demandtide.functions.periods", fromlist=["x"]).LUNAR_NEW_YEAR.items())
_CORR = f"""{_BL}, cny(y, mo) AS (VALUES {_CNY}),
  cut AS (SELECT max(m) - 14 AS c FROM lines),
  sales AS (SELECT * FROM bl WHERE m <= (SELECT c FROM cut)),
  fc AS (SELECT brand, label, m, CASE WHEN (m - 1) % 12 IN (0, 1, 10) THEN v * 2 ELSE v END AS v FROM bl WHERE m > (SELECT c FROM cut)),
  fx AS (SELECT * FROM fc UNION ALL SELECT * FROM sales WHERE m = (SELECT c FROM cut)),
  sr AS (SELECT a.brand, a.label, a.m, a.v / NULLIF(coalesce(p.v, 0) + coalesce(n.v, 0), 0) AS r FROM sales a LEFT JOIN sales p ON p.brand = a.brand AND p.label = a.label AND p.m = a.m - 1 LEFT JOIN sales n ON n.brand = a.brand AND n.label = a.label AND n.m = a.m + 1),
  fr AS (SELECT a.brand, a.label, a.m, a.v / NULLIF(coalesce(p.v, 0) + coalesce(n.v, 0), 0) AS r FROM fx a LEFT JOIN fx p ON p.brand = a.brand AND p.label = a.label AND p.m = a.m - 1 LEFT JOIN fx n ON n.brand = a.brand AND n.label = a.label AND n.m = a.m + 1
     WHERE a.m > (SELECT c FROM cut) AND a.m <> (SELECT max(m) FROM fc)),
  refs AS (SELECT fr.*, (fr.m - 1) // 12 * 12 - 12 * k + c.mo AS ref, w, 2 AS need FROM fr JOIN cny t ON t.y = (fr.m - 1) // 12 AND (fr.m - 1) % 12 + 1 = t.mo, (VALUES (1, 0.8::DOUBLE), (2, 0.2::DOUBLE)) AS q(k, w), cny c WHERE c.y = (fr.m - 1) // 12 - k
    UNION ALL SELECT fr.*, fr.m - 12 * k, w, 4 FROM fr, (VALUES (1, 0.4::DOUBLE), (2, 0.3::DOUBLE), (3, 0.2::DOUBLE), (4, 0.1::DOUBLE)) AS q(k, w) WHERE (fr.m - 1) % 12 = 10),
  tg AS (SELECT refs.brand, refs.label, refs.m, refs.r, sum(w * sr.r) AS t FROM refs JOIN sr ON sr.brand = refs.brand AND sr.label = refs.label AND sr.m = refs.ref GROUP BY refs.brand, refs.label, refs.m, refs.r, need HAVING count(sr.r) = need),
  co AS (SELECT fc.brand, fc.label, fc.m, v * coalesce(CASE WHEN abs(t - r) > 0.05 THEN t / r END, 1.0) AS prediction FROM fc LEFT JOIN tg ON tg.brand = fc.brand AND tg.label = fc.label AND tg.m = fc.m)"""


def _corrected(spark, d):
    facts = written(
        sku_label(spark, d).join(hierarchy(spark, d), "sku").groupBy("brand", "label", "m").agg(F.sum("offtake").alias("offtake")), "sales"
    )
    cut = last_month(spark, d) - 14
    sales = facts.filter(F.col("m") <= cut)
    raised = F.when(idx_month("m").isin(1, 2, 11), F.col("offtake") * 2).otherwise(F.col("offtake"))
    forecast = facts.filter(F.col("m") > cut).select("brand", "label", "m", raised.alias("prediction"))
    return O.seasonal_correction(sales, forecast, ["brand", "label"], "m", "offtake")


@query("seasonal_correction", with_sql(f"WITH {_CORR} SELECT brand, label, {_YM}, {r4('prediction')} AS prediction FROM co", "sku_label", "master", "lines"))
def _(spark, d):
    return _out(_corrected(spark, d), "prediction")


@query(
    "scope_recompute",
    with_sql(
        f"""WITH {_CORR}, s AS (SELECT brand, m, sum(prediction) FILTER (label = 'di') AS a, sum(prediction) FILTER (label = 'eib') AS b FROM co GROUP BY ALL)
        SELECT brand, label, {_YM}, {r4('prediction')} AS prediction FROM co UNION ALL SELECT brand, 'il', {ym('m')}, {r4('a + b')} FROM s WHERE a IS NOT NULL""",
        "sku_label", "master", "lines",
    ),
)
def _(spark, d):
    return _out(O.recompute_parent(_corrected(spark, d), ["brand", "m"]), "prediction")


@query(
    "zero_invalid",
    with_sql(
        f"""WITH {_FUT}, h AS (SELECT label, sku, sum(sellin) AS s FROM sku_label GROUP BY ALL)
        SELECT f.sku, f.label, {_YM}, horizon, CASE WHEN s = 0 THEN 0.0 ELSE prediction END AS prediction FROM (SELECT sku, label, m, CAST(horizon AS INTEGER) AS horizon, prediction FROM fut) f LEFT JOIN h ON h.label = f.label AND h.sku = f.sku""",
        "sku_label", "lines",
    ),
)
def _(spark, d):
    return _out(O.zero_invalid(future(spark, d), sku_label(spark, d), "sku", "sellin"))


@query(
    "rescale_children",
    with_sql(
        f"""WITH {_FUT}, g AS (SELECT *, sum(prediction) FILTER (label = 'il') OVER w AS t, sum(prediction) FILTER (label <> 'il') OVER w AS b FROM fall WINDOW w AS (PARTITION BY sku, m))
        SELECT sku, label, {_YM}, CAST(horizon AS INTEGER) AS horizon, CASE WHEN label = 'il' THEN 1.0 ELSE coalesce({div('t', 'b')}, 1.0) END AS ratio, prediction * CASE WHEN label = 'il' THEN 1.0 ELSE coalesce({div('t', 'b')}, 1.0) END AS prediction FROM g""",
        "sku_label", "lines",
    ),
)
def _(spark, d):
    return _out(O.rescale_children(future_all(spark, d), ["sku", "m"]))


@query(
    "rescale_residual",
    with_sql(
        f"""WITH {_FUT}, gl AS (SELECT m, horizon, sum(prediction) AS il FROM fall WHERE label = 'il' GROUP BY ALL),
        t AS (SELECT m, sum(prediction) FILTER (label = 'di') AS di, sum(prediction) FILTER (label = 'eib') AS eib FROM fall GROUP BY m),
        f AS (SELECT t.m, coalesce((coalesce(il, 0) - coalesce(di, 0)) / NULLIF(eib, 0), 1.0) AS fa FROM t LEFT JOIN gl USING (m)),
        s AS (SELECT x.*, CASE WHEN label = 'eib' THEN fa ELSE 1.0 END AS ratio, prediction * CASE WHEN label = 'eib' THEN fa ELSE 1.0 END AS p FROM fall x JOIN f USING (m))
        SELECT sku, label, {_YM}, CAST(horizon AS INTEGER) AS horizon, {r4('ratio')} AS ratio, {r4("CASE WHEN label = 'il' THEN coalesce(sum(p) FILTER (label <> 'il') OVER (PARTITION BY sku, m, horizon), 0) ELSE p END")} AS prediction FROM s""",
        "sku_label", "lines",
    ),
)
def _(spark, d):
    forecast = future_all(spark, d)
    total = forecast.filter("label = 'il'").groupBy("m", "horizon").agg(F.sum("prediction").alias("prediction"))
    return _out(O.rescale_residual(forecast, total, "sku", "m"), "ratio", "prediction")


@query(
    "rescale_r6m",
    with_sql(
        f"""WITH {_FUT}, s6 AS (SELECT label, m - horizon AS dwp, sum(prediction) * 1.5 AS r6 FROM fut WHERE horizon BETWEEN 5 AND 10 GROUP BY ALL),
        t AS (SELECT label, m, horizon, m - horizon AS dwp, sum(prediction) AS tot FROM fut GROUP BY ALL),
        f AS (SELECT t.label, t.m, CASE WHEN horizon BETWEEN 5 AND 10 THEN coalesce((r6 / 6) / NULLIF(tot, 0), 1.0) ELSE 1.0 END AS ratio FROM t LEFT JOIN s6 ON s6.label = t.label AND s6.dwp = t.dwp)
        SELECT sku, fut.label, {ym('fut.m')} AS ym, CAST(horizon AS INTEGER) AS horizon, {r4('ratio')} AS ratio, {r4('prediction * ratio')} AS prediction FROM fut JOIN f ON f.label = fut.label AND f.m = fut.m""",
        "sku_label", "lines",
    ),
)
def _(spark, d):
    forecast = future(spark, d).withColumn("dwp", F.col("m") - F.col("horizon"))
    six = forecast.filter("horizon BETWEEN 5 AND 10").groupBy("label", "dwp").agg((F.sum("prediction") * 1.5).alias("r6m_prediction"))
    return _out(O.rescale_six_months(forecast, six, "m").drop("dwp"), "ratio", "prediction")


@query(
    "long_to_wide",
    with_sql(
        f"""WITH {_FUT}, w AS (SELECT sku, m, horizon, max(prediction) FILTER (label = 'di') AS yhat_di_calib, max(prediction) FILTER (label = 'eib') AS yhat_eib_calib, max(prediction) FILTER (label = 'il') AS yhat_il_calib FROM fall GROUP BY ALL HAVING count(DISTINCT label) = 3)
        SELECT w.sku, {ym('w.m')} AS ym, CAST(horizon AS INTEGER) AS horizon, yhat_di_calib, yhat_eib_calib, yhat_il_calib, offtake_di AS target_di, offtake_eib AS target_eib, offtake_il AS target_il
        FROM w LEFT JOIN panel0 p ON p.sku = w.sku AND p.m + 12 = w.m""",
        "sku_label", "lines", "panel0",
    ),
)
def _(spark, d):
    """Targets are the sales of the month a year before."""
    actual = bare_panel(spark, d).withColumn("m", F.col("m") + 12)
    return _out(O.long_to_wide(future_all(spark, d), actual, ["sku", "m", "horizon"], ["di", "eib", "il"], ["m", "sku"]))


@query(
    "switch_by_date",
    with_sql(
        f"""SELECT sku, label, lag, {_YM}, {ym('cycle')} AS dwp, forecast * CASE WHEN {ym('cycle')} <= 199804 THEN 1 ELSE 2 END AS prediction FROM cycles""",
        "cycles",
    ),
)
def _(spark, d):
    from demandtide.catalog.roles import cycles

    made = cycles(spark, d).select("sku", "label", "lag", "m", idx_to_ym("cycle").alias("dwp"), F.col("forecast").alias("prediction"))
    return _out(O.switch_by_date(made, made.withColumn("prediction", F.col("prediction") * 2), "dwp", 199804))


@query(
    "scope_modes",
    with_sql(
        f"""WITH {_FUT}, w AS (SELECT sku, m, max(prediction) FILTER (label = 'di') AS a, max(prediction) FILTER (label = 'eib') AS b, max(prediction) FILTER (label = 'il') AS c FROM fall GROUP BY ALL HAVING count(DISTINCT label) = 3)
        SELECT 'indep' AS mode, sku, {_YM}, a AS yhat_di_calib, b AS yhat_eib_calib, c AS yhat_il_calib FROM w UNION ALL SELECT 'diff', sku, {ym('m')}, greatest(c - b, 0), b, c FROM w UNION ALL SELECT 'sum', sku, {ym('m')}, a, b, b + a FROM w""",
        "sku_label", "lines",
    ),
)
def _(spark, d):
    from demandtide.operators.reshaping import label_pivot, union_sources

    wide = label_pivot(future_all(spark, d), ["sku", "m"], ["di", "eib", "il"], "prediction", "yhat_{label}_calib")
    return _out(union_sources([O.scope_modes(wide, mode).withColumn("mode", F.lit(mode)) for mode in ("indep", "diff", "sum")]))


_SPLIT = f"""{_FUT}, h AS (SELECT sku, status, channel, sum(qty) AS q FROM channel_lines WHERE label = 'di' GROUP BY ALL), hr AS (SELECT sku, status, channel, {div('q', 'sum(q) OVER (PARTITION BY sku)')} AS r FROM h),
  i AS (SELECT sku, channel, sum(qty) AS q FROM channel_lines GROUP BY ALL), ir AS (SELECT sku, channel, {div('q', 'sum(q) OVER (PARTITION BY sku)')} AS r FROM i)"""


@query(
    "split_channel",
    with_sql(
        f"""WITH {_SPLIT} SELECT 'di' AS label, hr.sku, status, channel, {ym('m')} AS ym, {r4('prediction * r')} AS offtake FROM hr LEFT JOIN (SELECT * FROM fall WHERE label = 'di') f ON f.sku = hr.sku
        UNION ALL SELECT 'il', ir.sku, NULL, channel, {ym('m')}, {r4('prediction * r')} FROM ir JOIN (SELECT * FROM fall WHERE label = 'il') f ON f.sku = ir.sku
        UNION ALL SELECT 'eib', sku, NULL, 'NewChannel', {ym('m')}, {r4('prediction')} FROM fall WHERE label = 'eib'""",
        "sku_label", "lines", "channel_lines",
    ),
)
def _(spark, d):
    from demandtide.operators.reshaping import union_sources

    history = flow_cube(spark, d)
    made = future_all(spark, d, history).select("sku", "label", "m", F.col("prediction").alias("offtake"))
    di = G.ratios_of(history.filter("label = 'di'"), ["sku", "status", "channel"], ["sku"], "qty")
    il = G.ratios_of(history, ["sku", "channel"], ["sku"], "qty")
    parts = [
        G.split_forecast(made.filter("label = 'di'").drop("label"), di, "sku", "offtake", keep_missing=True).withColumn("label", F.lit("di")),
        G.split_forecast(made.filter("label = 'il'"), il, "sku", "offtake", keep_missing=False),
        made.filter("label = 'eib'").withColumn("channel", F.lit(G.SINGLE_CHANNEL)),
    ]
    return _out(union_sources(parts), "offtake")


@query(
    "actuals_il",
    with_sql(
        f"""WITH i AS (SELECT sku, channel, sum(qty) AS q FROM channel_lines GROUP BY ALL), ir AS (SELECT sku, channel, {div('q', 'sum(q) OVER (PARTITION BY sku)')} AS r FROM i),
        o AS (SELECT sku, channel, m, sum(qty) AS offtake FROM channel_lines GROUP BY ALL), s AS (SELECT l.sku, channel, l.m, l.sellin * r AS sellin FROM (SELECT sku, m, sum(kept) AS sellin FROM lines GROUP BY ALL) l JOIN ir USING (sku))
        SELECT coalesce(o.sku, s.sku) AS sku, coalesce(o.channel, s.channel) AS channel, {ym('coalesce(o.m, s.m)')} AS ym, offtake, {r4('sellin')} AS sellin FROM o FULL JOIN s ON o.sku = s.sku AND o.channel = s.channel AND o.m = s.m""",
        "channel_lines", "lines",
    ),
)
def _(spark, d):
    """Months of a channel are stored and dealt by product, a row per month and channel of it at most; all that follows stays in these tasks."""
    history = dealt(spark, d, written(channel_months(spark, d), "channel-months"), "sku", times=len(CHANNELS))
    ratios = G.ratios_of(history, ["sku", "channel"], ["sku"], "qty")
    offtake = group_sum(history, ["sku", "channel", "m"], ["qty"]).withColumnRenamed("qty", "offtake")
    sellin = group_sum(history, ["sku", "m"], ["kept"]).withColumnRenamed("kept", "sellin")
    return _out(G.actuals_il(offtake, sellin, ratios, "sku", "m"), "sellin")


# DI flow at product and package: country_brand_tier_stage with the order status as package token.
_DI = f"""fl AS (SELECT country || '_' || brand || '_' || tier || '_' || stage AS sku, country || '_' || brand || '_' || tier || '_' || status || '_' || stage AS code, channel, status, m, om, qty, kept, CASE WHEN channel = '5-LOW' THEN 'all' ELSE 'x' END AS sp
    FROM channel_lines JOIN master USING (sku) WHERE label = 'di'),
  fw AS (SELECT sku, code, channel, 'offtake' AS type, sp, m, sum(qty) AS quantity FROM fl GROUP BY ALL UNION ALL SELECT sku, code, channel, 'sellout', sp, om, sum(qty) FROM fl GROUP BY ALL
    UNION ALL SELECT sku, code, 'Total', 'sellin', 'x', m, sum(kept) FROM fl GROUP BY ALL UNION ALL SELECT sku, code, 'Total', 'sp_inv', 'x', om, sum(kept) FROM fl GROUP BY ALL),
  cutd AS (SELECT * FROM fw WHERE m < {{cut}}),
  ph AS (SELECT sku, code, channel, sum(quantity) AS q FROM cutd WHERE type = 'offtake' AND channel <> 'Total' GROUP BY ALL),
  pr AS (SELECT sku, code, channel, {div('q', 'sum(q) OVER (PARTITION BY code)')} AS r, {div('q', 'sum(q) OVER (PARTITION BY sku)')} AS rs FROM ph),
  flt AS (SELECT * FROM cutd WHERE NOT (m >= 24004 AND sp = 'all')),
  chn AS (SELECT sku, code, channel, m, avg(quantity) FILTER (type = 'offtake') AS offtake, avg(quantity) FILTER (type = 'sellout') AS sellout FROM flt WHERE channel <> 'Total' GROUP BY ALL),
  tot AS (SELECT code, m, coalesce(avg(quantity) FILTER (type = 'sellin'), 0) AS sellin, coalesce(avg(quantity) FILTER (type = 'sp_inv'), 0) AS sp_inv FROM flt WHERE channel = 'Total' GROUP BY ALL),
  spl AS (SELECT sku, pr.code, channel, m, sellin * r AS sellin, sp_inv * r AS sp_inv FROM pr JOIN tot ON tot.code = pr.code),
  adi AS (SELECT coalesce(a.sku, b.sku) AS sku, coalesce(a.code, b.code) AS code, coalesce(a.channel, b.channel) AS channel, coalesce(a.m, b.m) AS m, coalesce(offtake, 0) AS offtake, coalesce(sellout, 0) AS sellout,
    coalesce(sellin, 0) AS sellin, coalesce(sp_inv, 0) AS sp_inv FROM chn a FULL JOIN spl b ON a.sku = b.sku AND a.code = b.code AND a.channel = b.channel AND a.m = b.m)"""


def di_flow(spark, d, cube=None):
    """Offtake, sell-out, sell-in and stock rows, four per line in one pass, summed to month, code and channel."""
    product = F.concat_ws("_", "country", "brand", "tier", "stage")
    package = F.concat_ws("_", "country", "brand", "tier", "status", "stage")
    if cube is None:
        sums = channel_lines(spark, d).filter("label = 'di'").groupBy("sku", "channel", "status", "m", "om").agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept"))
    else:
        sums = cube.filter("label = 'di'")  # of this grain already
    known = sums.withColumnRenamed("sku", "_s").join(hierarchy(spark, d).withColumnRenamed("sku", "_s"), "_s")
    sp = F.when(F.col("channel") == "5-LOW", "all").otherwise("x")

    def row(kind, channel, month, quantity, source):
        return F.struct(F.lit(kind).alias("type"), channel.alias("channel"), F.col(month).alias("m"), F.col(quantity).alias("quantity"), source.alias("sp"))

    total, plain = F.lit("Total"), F.lit("x")
    rows = F.array(
        row("offtake", F.col("channel"), "m", "qty", sp), row("sellout", F.col("channel"), "om", "qty", sp),
        row("sellin", total, "m", "kept", plain), row("sp_inv", total, "om", "kept", plain),
    )
    long = known.select(product.alias("sku"), package.alias("code"), F.explode(rows).alias("e")).select("sku", "code", "e.*")
    # A stored source table, as it is read by several branches.
    return written(group_sum(long, ["sku", "code", "channel", "type", "sp", "m"], ["quantity"]), "flow")


@query(
    "actuals_di",
    with_sql(f"WITH {_DI.format(cut=99999)} SELECT sku, code, channel, {_YM}, {r4('offtake')} AS offtake, {r4('sellout')} AS sellout, {r4('sellin')} AS sellin, 0.0::DOUBLE AS retailer_inv, {r4('sp_inv')} AS sp_inv FROM adi", "channel_lines", "master"),
)
def _(spark, d):
    flow = di_flow(spark, d)
    ratios = G.ratios_of(flow.filter("type = 'offtake' AND channel != 'Total'"), ["sku", "code", "channel"], ["code"], "quantity")
    return _out(G.actuals_di(flow, ratios, "sku", "code", "m", 2000 * 12 + 4), "offtake", "sellout", "sellin", "sp_inv")


_EIB = """eo AS (SELECT sku, m, sum(qty) AS offtake FROM lines WHERE label = 'eib' AND make_date(CAST((m - 1) // 12 AS BIGINT), CAST((m - 1) % 12 + 1 AS BIGINT), 1) < DATE '2001-06-15' - 60 GROUP BY ALL),
  es AS (SELECT sku, m, sum(kept) AS sellin FROM lines WHERE label = 'eib' GROUP BY ALL)"""


@query("actuals_eib", with_sql(f"WITH {_EIB} SELECT eo.sku, {ym('eo.m')} AS ym, 'NewChannel' AS channel, offtake, sellin FROM eo LEFT JOIN es ON es.sku = eo.sku AND es.m = eo.m", "lines"))
def _(spark, d):
    rows = lines(spark, d).filter("label = 'eib'")
    produced = rows.withColumn("offtake", F.col("qty")).withColumn("produced_date", F.lit("2001-06-15").cast("date"))
    sellin = rows.withColumn("sellin", F.col("kept"))
    return _out(G.actuals_eib(produced, sellin, "sku", "m", idx_to_date("m")))


def granular_il(spark, d):
    """All branches but the DI flow read sums by product name, channel and month, and those by product name and month; both are stored once."""
    product = F.concat_ws("_", "country", "brand", "tier", "stage").alias("product")
    attributes = hierarchy(spark, d).select(product.alias("sku"), "country", "brand", "tier", "stage").distinct()
    names = hierarchy(spark, d).select("sku", product)
    cube = flow_cube(spark, d)
    named = dealt_lookup(cube.select("sku", "label", "channel", "m", "qty", "kept"), names, "sku", "inner")
    channels = written(named.groupBy(F.col("product").alias("sku"), "label", "channel", "m").agg(F.sum("qty").alias("offtake"), F.sum("kept").alias("sellin")), "product-channels")
    products = written(channels.groupBy("sku", "label", "m").agg(F.sum("offtake").alias("offtake"), F.sum("sellin").alias("sellin")), "product-months")
    eib = products.filter("label = 'eib'").withColumn("produced_date", F.lit("2001-06-15").cast("date"))
    future_ = future_all(spark, d, products.withColumnRenamed("offtake", "qty"), last_month(spark, d)).groupBy("sku", "m", "horizon").agg(
        *[F.sum(F.when(F.col("label") == x, F.col("prediction"))).alias(f"yhat_{x}_calib") for x in ("di", "eib", "il")]
    )
    return G.granularity_il(
        di_flow(spark, d, cube), channels, products, eib, eib, future_, attributes, "sku", "code", "m", 2001 * 12 + 1, idx_to_date("m"), 2000 * 12 + 4
    )


_GIL = (
    f"""{_FUT}, {_DI.format(cut=24013)},
  nm AS (SELECT sku, country || '_' || brand || '_' || tier || '_' || stage AS product FROM master), atr AS (SELECT DISTINCT country || '_' || brand || '_' || tier || '_' || stage AS sku, country, brand, tier, stage FROM master),
  fp AS (SELECT product AS sku, label, m, horizon, sum(prediction) AS p FROM fall JOIN nm USING (sku) GROUP BY ALL),
  fk AS (SELECT DISTINCT sku, m, horizon FROM fp), lb AS (SELECT unnest(['di', 'eib', 'il']) AS label),
  fd AS (SELECT fk.sku, fk.m, fk.horizon, lb.label, p FROM fk CROSS JOIN lb LEFT JOIN fp ON fp.sku = fk.sku AND fp.m = fk.m AND fp.horizon = fk.horizon AND fp.label = lb.label),
  ilc AS (SELECT product AS sku, channel, m, sum(qty) AS offtake FROM channel_lines JOIN nm USING (sku) WHERE m < 24013 GROUP BY ALL),
  ilr AS (SELECT sku, channel, {div('sum(offtake)', 'sum(sum(offtake)) OVER (PARTITION BY sku)')} AS r FROM ilc GROUP BY sku, channel),
  sln AS (SELECT product AS sku, label, m, sum(qty) AS offtake, sum(kept) AS sellin FROM lines JOIN nm USING (sku) WHERE m < 24013 GROUP BY ALL),
  ail AS (SELECT coalesce(o.sku, s.sku) AS sku, coalesce(o.channel, s.channel) AS channel, coalesce(o.m, s.m) AS m, coalesce(offtake, 0) AS offtake FROM ilc o FULL JOIN (SELECT q.sku, channel, q.m FROM (SELECT DISTINCT sku, m FROM sln) q JOIN ilr USING (sku)) s ON o.sku = s.sku AND o.channel = s.channel AND o.m = s.m),
  gf AS (SELECT 'di' AS label, pr.sku, code, channel, m, horizon, p * rs AS offtake FROM pr JOIN fd ON fd.sku = pr.sku AND label = 'di'
    UNION ALL SELECT 'il', ilr.sku, ilr.sku, channel, m, horizon, p * r FROM ilr JOIN fd ON fd.sku = ilr.sku AND label = 'il' WHERE p IS NOT NULL
    UNION ALL SELECT 'eib', sku, sku, 'NewChannel', m, horizon, p FROM fd WHERE label = 'eib'),
  ga AS (SELECT 'di' AS label, sku, code, channel, m, offtake, sp_inv FROM adi UNION ALL SELECT 'il', sku, sku, channel, m, offtake, 0 FROM ail
    UNION ALL SELECT 'eib', sku, sku, 'NewChannel', m, offtake, 0 FROM sln WHERE label = 'eib' AND m <= 24016),
  un AS (SELECT 'forecast' AS kind, label, sku, code, channel, m, horizon, coalesce(offtake, 0) AS offtake, NULL::DOUBLE AS sp_inv, NULL::DOUBLE AS sellin FROM gf UNION ALL SELECT 'actual', label, sku, code, channel, m, -99, offtake, sp_inv, 0.0::DOUBLE FROM ga)"""
)


@query(
    "granularity_il",
    with_sql(
        f"""WITH {_GIL} SELECT kind, label, un.sku, CASE WHEN len(string_split(code, '_')) = 5 THEN string_split(code, '_')[4] ELSE 'N/A' END AS package, channel, {_YM}, CAST(horizon AS INTEGER) AS horizon, country, brand, tier, stage,
        {r4('offtake')} AS offtake, {r4('sp_inv')} AS sp_inv, sellin FROM un JOIN atr USING (sku)""",
        "sku_label", "lines", "channel_lines", "master",
    ),
)
def _(spark, d):
    made, known = granular_il(spark, d)
    cols = ["label", "sku", F.col("code").alias("package"), "channel", "m", "horizon", "country", "brand", "tier", "stage", "offtake"]
    both = made.select(F.lit("forecast").alias("kind"), *cols).unionByName(
        known.select(F.lit("actual").alias("kind"), *cols, "sp_inv", "sellin"), allowMissingColumns=True
    )
    return _out(both, "offtake", "sp_inv")


_SEG = "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'KA' WHEN 'MACHINERY' THEN 'GT' WHEN 'BUILDING' THEN 'EC' ELSE coalesce(NULLIF(c_mktsegment, 'AUTOMOBILE'), 'GT') END"


@query(
    "granularity_dc",
    with_sql(
        f"""WITH {_FUT}, st AS (SELECT c_custkey AS k, {_SEG} AS channel FROM customer),
        pd AS (SELECT sku AS sku_no, substring(tier, 1, 2) || stage AS sku FROM master),
        o AS (SELECT pd.sku, st.channel, m, sum(qty) AS offtake FROM channel_lines c JOIN pd ON pd.sku_no = c.sku JOIN st ON st.k = o_custkey GROUP BY ALL),
        rt AS (SELECT sku, channel, {div('sum(offtake)', 'sum(sum(offtake)) OVER (PARTITION BY sku)')} AS r FROM o GROUP BY sku, channel),
        so AS (SELECT pd.sku, om AS m, sum(qty) AS q FROM channel_lines c JOIN pd ON pd.sku_no = c.sku GROUP BY ALL),
        si AS (SELECT pd.sku, m, sum(kept) AS q FROM lines l JOIN pd ON pd.sku_no = l.sku GROUP BY ALL),
        ky AS (SELECT sku, channel, m FROM o UNION SELECT sku, channel, m FROM so JOIN rt USING (sku) UNION SELECT sku, channel, m FROM si JOIN rt USING (sku)),
        ac AS (SELECT ky.sku, ky.channel, ky.m, coalesce(o.offtake, 0) AS offtake, coalesce(si.q * r, 0) AS sp_inv FROM ky JOIN rt ON rt.sku = ky.sku AND rt.channel = ky.channel LEFT JOIN o ON o.sku = ky.sku AND o.channel = ky.channel AND o.m = ky.m
          LEFT JOIN si ON si.sku = ky.sku AND si.m = ky.m),
        fp AS (SELECT pd.sku, m, horizon, sum(prediction) AS p FROM fut JOIN pd ON pd.sku_no = fut.sku GROUP BY ALL),
        un AS (SELECT 'forecast' AS kind, rt.sku, channel, m, horizon, p * r AS offtake, NULL::DOUBLE AS sp_inv FROM rt JOIN fp USING (sku) UNION ALL SELECT 'actual', sku, channel, m, -99, offtake, sp_inv FROM ac)
        SELECT kind, sku, channel, {_YM}, CAST(horizon AS INTEGER) AS horizon, substring(sku, 1, 2) AS brand, substring(sku, 3) AS stage, {r4('offtake')} AS offtake, {r4('sp_inv')} AS sp_inv FROM un""",
        "sku_label", "lines", "channel_lines", "master",
    ),
)
def _(spark, d):
    """Customers are the stores; the product family is two letters of the tier with the stage."""
    segments = {"HOUSEHOLD": "KA", "MACHINERY": "GT", "BUILDING": "EC"}
    segment = F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_mktsegment"))
    stores = table(spark, d, "customer").select(F.col("c_custkey").alias("store_code"), segment.alias("channel"))
    products = hierarchy(spark, d).select(F.col("sku").alias("sku_no"), F.concat(F.substring("tier", 1, 2), "stage").alias("sku"))
    cube = flow_cube(spark, d, "o_custkey")
    history = cube.select(F.col("sku").alias("sku_no"), F.col("o_custkey").alias("store_code"), "m", "om", F.col("qty").alias("quantity"))
    sellout = history.select("sku_no", F.col("om").alias("m"), F.col("quantity").alias("sellout"))
    monthly = group_sum(cube.withColumnRenamed("sku", "sku_no"), ["sku_no", "m"], ["kept"]).join(products, "sku_no")
    made = future(spark, d, cube).withColumnRenamed("sku", "sku_no").join(products, "sku_no").groupBy("sku", "m", "horizon").agg(F.sum("prediction").alias("yhat"))
    forecast, actual = G.granularity_dc(
        history, stores, products, made, sellout, monthly.withColumn("sellin", F.col("kept")), monthly.withColumn("sp_inv", F.col("kept")), "m", channels=segments
    )
    cols = ["sku", "channel", "m", "horizon", "brand", "stage", "offtake"]
    both = forecast.select(F.lit("forecast").alias("kind"), *cols).unionByName(
        actual.select(F.lit("actual").alias("kind"), *cols, "sp_inv"), allowMissingColumns=True
    )
    return _out(both, "offtake", "sp_inv")


_GRAN = ["label", "sku_wo_pkg", "channel"]
_SC = f"""{_SPLIT}, f AS (SELECT 'il' AS label, ir.sku, channel, m, horizon, prediction * r AS offtake FROM ir JOIN (SELECT * FROM fall WHERE label = 'il') f ON f.sku = ir.sku),
  a AS (SELECT 'il' AS label, sku, channel, m, -99 AS horizon, sum(qty) AS offtake FROM channel_lines GROUP BY ALL)"""


def _scenario(spark, d):
    history = flow_cube(spark, d)
    last = history.agg(F.max("m").alias("last")).scalar()
    ratios = G.ratios_of(history, ["sku", "channel"], ["sku"], "qty")
    made = future_all(spark, d, history).filter("label = 'il'").withColumnRenamed("prediction", "offtake")
    forecasts = G.split_forecast(made, ratios, "sku", "offtake", keep_missing=False).withColumnRenamed("sku", "sku_wo_pkg")
    actuals = group_sum(history, ["sku", "channel", "m"], ["qty"]).select(
        F.lit("il").alias("label"), F.col("sku").alias("sku_wo_pkg"), "channel", "m", F.lit(G.ACTUAL_HORIZON).alias("horizon"), F.col("qty").alias("offtake")
    )
    # The two newest actual months are forecast as well, so that an overlap has to be removed.
    again = actuals.filter(F.col("m") > last - 2).withColumn("horizon", (F.col("m") - last).cast("int"))
    # Stored, as the first forecast month is looked up before the rows are read.
    made = written(forecasts.unionByName(again.select(*forecasts.columns)), "forecasts")
    return Z.build_scenario(made, actuals, _GRAN)


_SC_ALL = f"""{_SC}, L AS (SELECT max(m) AS l FROM lines),
  sc AS (SELECT label, sku, channel, m, horizon, offtake, false AS frc_flg FROM a WHERE m <= (SELECT l FROM L) - 2 UNION ALL SELECT label, sku, channel, m, m - (SELECT l FROM L), offtake, true FROM a WHERE m > (SELECT l FROM L) - 2
    UNION ALL SELECT label, sku, channel, m, horizon, offtake, true FROM f)"""


@query(
    "scenario_build",
    with_sql(
        f"""WITH {_SC_ALL} SELECT label AS lv3_pdt_brd_cod, sku AS mat_cod, channel AS dis_chl_cod, {_YM}, CAST(horizon AS INTEGER) AS frc_mth_nbr, frc_flg, {r4('offtake')} AS oft_trk_val, 0.0::DOUBLE AS sal_ins_val FROM sc""",
        "sku_label", "lines", "channel_lines",
    ),
)
def _(spark, d):
    out = _scenario(spark, d).select("lv3_pdt_brd_cod", "mat_cod", "dis_chl_cod", "m", "frc_mth_nbr", "frc_flg", "oft_trk_val", "sal_ins_val")
    return _out(out, "oft_trk_val")


@query(
    "scenario_stamp",
    with_sql(
        f"""WITH {_SC_ALL} SELECT sku AS mat_cod, channel AS dis_chl_cod, frc_flg, CAST(horizon AS INTEGER) AS frc_mth_nbr, {r4('offtake')} AS oft_trk_val, {ym('m')} * 100 + 1 AS mea_dat, (SELECT {ym('l')} * 100 + 1 FROM L) AS cyc_dat,
        'IL' AS lv2_umb_brd_cod, 'tons' AS unit, 'planner' AS frc_usr_nam_dsc, 20011115 AS frc_cre_dat FROM sc""",
        "sku_label", "lines", "channel_lines",
    ),
)
def _(spark, d):
    built = written(_scenario(spark, d).select("mat_cod", "dis_chl_cod", "m", "frc_mth_nbr", "frc_flg", "oft_trk_val"), "scenario")
    stamped = Z.stamp_scenario(built, "IL", "planner", F.lit("2001-11-15").cast("date"))
    return stamped.withColumn("oft_trk_val", round_places("oft_trk_val"))


@query(
    "week_sku_split",
    with_sql(
        f"""WITH dy AS (SELECT CAST(unnest(generate_series((SELECT {date_of('min(m)')} FROM lines) - INTERVAL 14 DAY, (SELECT {date_of('max(m)')} FROM lines) + INTERVAL 40 DAY, INTERVAL 1 DAY)) AS DATE) AS d),
        wk AS (SELECT week(d) AS week, CASE WHEN week(d) = 1 AND month(d) = 12 THEN (year(d) + 1) * 12 + 1 ELSE year(d) * 12 + month(d) END AS m FROM dy WHERE isodow(d) = 1), n AS (SELECT m, count(*) AS n FROM wk GROUP BY m),
        mt AS (SELECT brand, m, sum(qty) AS volume FROM lines JOIN master USING (sku) GROUP BY ALL),
        sh0 AS (SELECT brand, tier, week(l_shipdate) AS week, sum(l_quantity) AS q FROM lineitem JOIN master ON sku = l_partkey GROUP BY ALL), sh AS (SELECT *, (q / sum(q) OVER (PARTITION BY brand, week)) * 100.0 AS pct FROM sh0)
        SELECT mt.brand, tier, {ym('mt.m')} AS ym, CAST(wk.week AS INTEGER) AS week, {r4('volume / n * pct / 100.0')} AS volume FROM mt JOIN n USING (m) JOIN wk ON wk.m = mt.m JOIN sh ON sh.brand = mt.brand AND sh.week = wk.week""",
        "lines", "master",
    ),
)
def _(spark, d):
    """Brand months to weeks, then to tiers by the tier's share of the brand in that week of the year."""
    known = hierarchy(spark, d).select("sku", "brand", "tier")
    months = lines(spark, d).select("m").distinct()
    mondays = months.select("m", F.explode(iso_week_mondays(idx_to_date("m"))).alias("monday"))
    weeks = mondays.select("m", F.weekofyear("monday").alias("week"))
    monthly = lines(spark, d).groupBy("sku", "m").agg(F.sum("qty").alias("volume")).join(known, "sku").groupBy("brand", "m").agg(F.sum("volume").alias("volume"))
    weekly = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("sku"), F.weekofyear("l_shipdate").alias("week")).agg(F.sum("l_quantity").alias("q"))
    shares = G.ratios_of(weekly.join(known, "sku"), ["brand", "tier", "week"], ["brand", "week"], "q").withColumn("pct", F.col("split_ratio") * 100.0)
    out = G.week_split(monthly, weeks, shares.drop("split_ratio"), ["brand"], "m", "volume")
    return _out(out.select("brand", "tier", "m", "week", "volume"), "volume")


@query(
    "deaggregate",
    with_sql(
        f"""WITH t AS (SELECT brand, m, sum(sellin_il) + 50 AS nt FROM panel GROUP BY ALL)
        SELECT sku, brand, {ym('p.m')} AS ym, {r4('CASE WHEN sum(sellin_il) OVER w = 0 THEN nt / count(*) OVER w ELSE sellin_il * (nt / sum(sellin_il) OVER w) END')} AS sellin_il FROM panel p JOIN t USING (brand, m) WINDOW w AS (PARTITION BY brand, p.m)""",
        "panel",
    ),
)
def _(spark, d):
    from demandtide.catalog.roles import panel

    leaf = panel(spark, d).select("sku", "brand", "m", "sellin_il")
    edited = leaf.groupBy("brand", "m").agg((F.sum("sellin_il") + 50).alias("new_total"))
    return _out(G.deaggregate(leaf, edited, ["brand", "m"], "sellin_il", "new_total"), "sellin_il")
