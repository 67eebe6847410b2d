"""Queries on raw masters and their loaders."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandtide.catalog.registry import query, r4, with_sql, ym
from demandtide.catalog.roles import channel_lines, hierarchy, lines, master, master_cube, table
from demandtide.functions.cleaning import round_places
from demandtide.functions.periods import idx_to_ym, month_idx
from demandtide.operators.aggregating import group_sum
from demandtide.operators.joining import lookup
from demandtide.operators.reshaping import unpivot_long
from demandtide.plans import masters as M

_YM = f"{ym('m')} AS ym"

# Trade flow out of the sales lines: channel rows, and total rows per open or finished order.
_FLOW = """flow AS (SELECT sku, m, channel, 'offtake' AS type, sum(qty) AS quantity FROM channel_lines WHERE label = 'di' GROUP BY ALL
    UNION ALL SELECT sku, om, channel, 'sellout', sum(qty) FROM channel_lines WHERE label = 'di' GROUP BY ALL
    UNION ALL SELECT sku, m, 'Total', CASE status WHEN 'F' THEN 'sellin' WHEN 'O' THEN 'retailer_inv' ELSE 'sp_inv' END, sum(kept) FROM channel_lines WHERE label = 'di' GROUP BY sku, m, status),
  tf AS (SELECT sku, m, coalesce(sum(quantity) FILTER (channel <> 'Total' AND type = 'offtake'), 0) AS offtake, coalesce(sum(quantity) FILTER (channel <> 'Total' AND type = 'sellout'), 0) AS sellout,
    coalesce(sum(quantity) FILTER (channel = 'Total' AND type = 'sellin'), 0) AS sellin, coalesce(sum(quantity) FILTER (channel = 'Total' AND type = 'retailer_inv'), 0) AS retailer_inv,
    coalesce(sum(quantity) FILTER (channel = 'Total' AND type = 'sp_inv'), 0) AS sp_inv FROM flow GROUP BY ALL)"""


def tradeflow(sums):
    """Sums by both months, channel and status give three rows each: month, channel, type and quantity. Whoever reads them sums."""
    kind = F.when(F.col("status") == "F", "sellin").when(F.col("status") == "O", "retailer_inv").otherwise("sp_inv")

    def row(month, channel, type_, quantity):
        return F.struct(month.alias("m"), channel.alias("channel"), type_.alias("type"), quantity.alias("quantity"))

    rows = F.array(
        row(F.col("m"), F.col("channel"), F.lit("offtake"), F.col("qty")),
        row(F.col("om"), F.col("channel"), F.lit("sellout"), F.col("qty")),
        row(F.col("m"), F.lit(M.TOTAL_CHANNEL), kind, F.col("kept")),
    )
    return sums.select("sku", F.explode(rows).alias("e")).select("sku", "e.*")


@query("tradeflow_pivot", with_sql(f"WITH {_FLOW} SELECT sku, {_YM}, offtake, sellout, sellin, retailer_inv, sp_inv FROM tf", "channel_lines"))
def _(spark, d):
    sums = channel_lines(spark, d).filter("label = 'di'").groupBy("sku", "m", "om", "channel", "status").agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept"))
    out = M.tradeflow_pivot(tradeflow(sums), ["sku", "m"])
    return out.withColumn("ym", idx_to_ym("m")).drop("m")


_PIVOT = """pv AS (SELECT sku, m, coalesce(avg(qty) FILTER (label = 'di'), 0) AS offtake_di, coalesce(avg(qty) FILTER (label = 'eib'), 0) AS offtake_eib FROM lines GROUP BY ALL)"""


@query("scope_pivot_mean", with_sql(f"WITH {_PIVOT} SELECT sku, {_YM}, {r4('offtake_di')} AS offtake_di, {r4('offtake_eib')} AS offtake_eib FROM pv", "lines"))
def _(spark, d):
    out = M.scope_pivot_mean(lines(spark, d), ["sku", "m"], "label", ["di", "eib"], "qty", "offtake")
    return out.select("sku", idx_to_ym("m").alias("ym"), round_places("offtake_di").alias("offtake_di"), round_places("offtake_eib").alias("offtake_eib"))


@query(
    "il_loaders",
    with_sql(
        f"""WITH av AS (SELECT p_type AS tier, year(l_shipdate) * 12 + month(l_shipdate) AS m, coalesce(avg(l_discount) FILTER (l_returnflag = 'A'), -1) AS osa, coalesce(avg(l_discount) FILTER (l_returnflag = 'N'), -1) AS isa
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R' GROUP BY ALL),
        mk AS (SELECT m, sum(qty) AS volume_ton_il FROM channel_lines WHERE status = 'F' AND m >= 23953 GROUP BY m)
        SELECT tier, {ym('av.m')} AS ym, {r4('osa')} AS osa, {r4('isa')} AS isa, volume_ton_il FROM av LEFT JOIN mk USING (m)""",
        "channel_lines",
    ),
)
def _(spark, d):
    """Availability pivoted per tier and month, with the market volume of one scope since 1996."""
    out = _availability(spark, d).join(F.broadcast(_market(spark, d)), "m", "left")  # one row per calendar month
    return out.select("tier", idx_to_ym("m").alias("ym"), round_places("osa").alias("osa"), round_places("isa").alias("isa"), "volume_ton_il")


def _availability(spark, d):
    kinds = F.when(F.col("l_returnflag") == "A", "OSA").otherwise("ISA")
    rows = table(spark, d, "lineitem").filter("l_returnflag != 'R'").select(
        F.col("l_partkey").alias("sku"), F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("mo"), kinds.alias("kind"), "l_discount"
    )
    tiers = master(spark, d).select("sku", "tier")
    placed = lookup(M.with_month(rows, "y", "mo"), tiers, "sku", "inner")
    return M.availability_pivot(placed, ["tier", "m"], "kind", ["OSA", "ISA"], "l_discount")


def _market(spark, d):
    return M.market_pivot(channel_lines(spark, d), "m", "status", "F", {"qty": "volume_ton_il"}, 1996 * 12 + 1)


_RAW_IL = f"""{_FLOW}, {_PIVOT}, se AS (SELECT sku, m, sellin AS sellin_eib FROM sku_label WHERE label = 'eib'),
 ks AS (SELECT sku, m FROM pv UNION SELECT sku, m FROM se UNION SELECT sku, m FROM tf),
 av AS (SELECT p_type AS tier, year(l_shipdate) * 12 + month(l_shipdate) AS m, coalesce(avg(l_discount) FILTER (l_returnflag = 'A'), -1) AS osa, coalesce(avg(l_discount) FILTER (l_returnflag = 'N'), -1) AS isa
   FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R' GROUP BY ALL),
 pr AS (SELECT sku, m, avg(floor(amount / qty)) AS price FROM lines GROUP BY ALL),
 mk AS (SELECT m, sum(qty) AS volume_ton_il FROM channel_lines WHERE status = 'F' AND m >= 23953 GROUP BY m),
 ct AS (SELECT m, sum(qty) AS total_vol, sum(kept) AS if_vol FROM lines GROUP BY m)"""


@query(
    "raw_master_il",
    with_sql(
        f"""WITH {_RAW_IL} SELECT ks.sku, {ym('ks.m')} AS ym, country, brand, a.tier, stage, {r4('offtake_di')} AS offtake_di, {r4('offtake_eib')} AS offtake_eib, sellin_eib, retailer_inv, sellout, sp_inv, tf.sellin AS sellin_di,
        {r4('osa')} AS osa, {r4('isa')} AS isa, {r4('price')} AS price, volume_ton_il, total_vol, if_vol, {r4('coalesce(offtake_di, 0) + coalesce(offtake_eib, 0)')} AS offtake_il,
        coalesce(tf.sellin, 0) + coalesce(sellin_eib, 0) AS sellin_il
        FROM ks JOIN master a USING (sku) LEFT JOIN pv ON pv.sku = ks.sku AND pv.m = ks.m LEFT JOIN se ON se.sku = ks.sku AND se.m = ks.m LEFT JOIN tf ON tf.sku = ks.sku AND tf.m = ks.m
        LEFT JOIN av ON av.tier = a.tier AND av.m = ks.m LEFT JOIN pr ON pr.sku = ks.sku AND pr.m = ks.m LEFT JOIN mk ON mk.m = ks.m LEFT JOIN ct ON ct.m = ks.m""",
        "lines", "sku_label", "channel_lines", "master",
    ),
)
def _(spark, d):
    cube = master_cube(spark, d)
    sellin = F.sum(F.when(F.col("label") == "eib", F.col("kept"))).alias("sellin_eib")
    price = F.try_divide(F.sum("list"), F.sum("n_list")).alias("price")
    sold = M.scope_pivot_mean(cube, ["sku", "m"], "label", ["di", "eib"], "qty", "offtake", "n_qty", [sellin, price])
    flow = M.tradeflow_pivot(tradeflow(cube.filter("label = 'di' AND status IS NOT NULL")), ["sku", "m"]).withColumnRenamed("sellin", "sellin_di").drop("offtake")
    category = cube.groupBy("m").agg(F.sum("qty").alias("total_vol"), F.sum("kept").alias("if_vol"))
    by_sku = cube.groupBy("sku", "m").agg(*[F.sum(c).alias(c) for c in ("osa", "n_osa", "isa", "n_isa", "n_placed")])
    seen = lookup(by_sku.filter("n_placed > 0"), master(spark, d).select("sku", "tier"), "sku", "inner")
    availability = M.availability_means(seen, ["tier", "m"], {"osa": "n_osa", "isa": "n_isa"})
    market = M.market_pivot(cube, "m", "status", "F", {"qty": "volume_ton_il"}, 1996 * 12 + 1)
    out = M.raw_master_il([sold, flow], ["sku", "m"], hierarchy(spark, d), availability, ["tier", "m"], None, market, category)
    rounded = ("offtake_di", "offtake_eib", "osa", "isa", "price", "offtake_il")
    return out.withColumn("ym", idx_to_ym("m")).drop("m").withColumns({c: round_places(c) for c in rounded})


_DC = """sel AS (SELECT sku, m, sum(q) AS sellin_dc FROM (SELECT sku, m, CASE WHEN label = 'eib' THEN -qty ELSE qty END AS q FROM lines WHERE m >= 23977 UNION ALL SELECT sku, m, kept FROM lines WHERE m < 23977) GROUP BY ALL),
  so AS (SELECT sku, om AS m, sum(qty) AS sellout, sum(kept) AS sellout_revenue, avg(qty) AS sellout_price FROM channel_lines GROUP BY ALL),
  os AS (SELECT l_partkey AS sku, year(l_shipdate) * 12 + month(l_shipdate) AS m, avg(l_discount) AS osa, avg(l_tax) AS csl FROM lineitem GROUP BY ALL)"""


@query(
    "dc_loaders",
    with_sql(
        f"""WITH {_DC}, st AS (SELECT brand, m, store_distribution FROM (UNPIVOT (SELECT m, {', '.join(f'''count(DISTINCT sku) FILTER (brand = 'Brand#{b}')::DOUBLE AS "Brand#{b}"''' for b in range(1, 26))}
          FROM lines JOIN master USING (sku) GROUP BY m) ON COLUMNS('Brand') INTO NAME brand VALUE store_distribution))
        SELECT sel.sku, {ym('sel.m')} AS ym, sellin_dc, sellout, sellout_revenue, {r4('sellout_price')} AS sellout_price, store_distribution FROM sel JOIN master a USING (sku)
        LEFT JOIN so ON so.sku = sel.sku AND so.m = sel.m LEFT JOIN st ON st.brand = a.brand AND st.m = sel.m""",
        "lines", "channel_lines", "master",
    ),
)
def _(spark, d):
    """Sell-in from two systems, sell-out mix, and store distribution melted from one column per brand."""
    sellin = _dc_sellin(lines(spark, d))
    sellout = M.sellout_mix(channel_lines(spark, d), ["sku", "om"], "qty", "kept", "qty").withColumnRenamed("om", "m")
    brands = [f"Brand#{b}" for b in range(1, 26)]
    monthly = lines(spark, d).select("sku", "m").distinct().join(hierarchy(spark, d).select("sku", "brand"), "sku")
    wide = monthly.groupBy("m").pivot("brand", brands).agg(F.count("sku").cast("double")).fillna(0.0)
    stores = unpivot_long(wide, ["m"], [f"`{b}`" for b in brands], "brand", "store_distribution")
    out = sellin.join(hierarchy(spark, d).select("sku", "brand"), "sku").join(sellout, ["sku", "m"], "left").join(stores, ["brand", "m"], "left")
    return out.select("sku", idx_to_ym("m").alias("ym"), "sellin_dc", "sellout", "sellout_revenue", round_places("sellout_price").alias("sellout_price"), "store_distribution")


def _dc_sellin(flows):
    signed = F.when(F.col("label") == "eib", -F.col("qty")).otherwise(F.col("qty"))
    current = flows.filter("m >= 23977").select("sku", "m", signed.alias("sellin_dc"))
    history = flows.filter("m < 23977").select("sku", "m", F.col("kept").alias("sellin_dc"))
    return M.union_history(current, history, ["sku", "m"], "sellin_dc")


@query(
    "raw_master_dc",
    with_sql(
        f"""WITH {_DC}, off AS (SELECT sku, m, sum(qty) AS offtake_dc FROM lines WHERE label = 'di' GROUP BY ALL),
          inv AS (SELECT sku, om AS m, sum(kept) AS sp_inv_dc FROM channel_lines WHERE status = 'O' GROUP BY ALL),
          an AS (SELECT brand, m, sum(kept) / 8 AS anp FROM lines JOIN master USING (sku) GROUP BY ALL),
          st AS (SELECT brand, m, count(DISTINCT sku)::DOUBLE AS store_distribution FROM lines JOIN master USING (sku) GROUP BY ALL)
        SELECT off.sku, {ym('off.m')} AS ym, a.brand, offtake_dc, {r4('osa')} AS osa, {r4('csl')} AS csl, anp, sellin_dc, sp_inv_dc, sellout, sellout_revenue, {r4('sellout_price')} AS sellout_price, store_distribution
        FROM off JOIN master a USING (sku) LEFT JOIN os ON os.sku = off.sku AND os.m = off.m LEFT JOIN an ON an.brand = a.brand AND an.m = off.m LEFT JOIN sel ON sel.sku = off.sku AND sel.m = off.m
        LEFT JOIN inv ON inv.sku = off.sku AND inv.m = off.m LEFT JOIN so ON so.sku = off.sku AND so.m = off.m LEFT JOIN st ON st.brand = a.brand AND st.m = off.m""",
        "lines", "channel_lines", "master",
    ),
)
def _(spark, d):
    cube = master_cube(spark, d)
    offtake = group_sum(cube.filter("label = 'di'"), ["sku", "m"], ["qty"]).withColumnRenamed("qty", "offtake_dc")
    shelf = cube.groupBy("sku", "m").agg(*[F.try_divide(F.sum(c), F.sum(f"n_{c}")).alias(name) for c, name in (("discount", "osa"), ("tax", "csl"))])
    stock = group_sum(cube.filter("status = 'O'"), ["sku", "om"], ["kept"]).withColumnsRenamed({"kept": "sp_inv_dc", "om": "m"})
    sellout = M.sellout_mix(cube, ["sku", "om"], "qty", "kept", "qty", "n_qty").withColumnRenamed("om", "m")
    brands = hierarchy(spark, d).select("sku", "brand")
    per_brand = cube.groupBy("sku", "m").agg(F.sum("kept").alias("kept")).join(brands, "sku").groupBy("brand", "m")
    spending = per_brand.agg((F.sum("kept") / 8).alias("anp"))
    stores = per_brand.agg(F.count("sku").cast("double").alias("store_distribution"))
    out = M.raw_master_dc([offtake, shelf, _dc_sellin(cube), stock, sellout], ["sku", "m"], brands, spending, stores)
    return out.withColumn("ym", idx_to_ym("m")).drop("m").withColumns({c: round_places(c) for c in ("osa", "csl", "sellout_price")})
