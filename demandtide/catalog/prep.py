"""Queries on the preparation jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from demandtide.catalog.registry import date_of, div, query, r4, with_sql, ym
from demandtide.catalog.roles import CHANNELS, channel_lines, dealt, hierarchy, lines, master, panel, sku_label, table
from demandtide.functions.cleaning import round_places
from demandtide.functions.periods import idx_to_date, idx_to_ym, month_idx
from demandtide.operators.aggregating import group_sum
from demandtide.operators.joining import dealt_lookup
from demandtide.operators.quality import check_contract
from demandtide.operators.reshaping import drop_empty_rows, month_columns, normalised_names, unpivot_long
from demandtide.plans import flows, prep as J, sheets, unified

_YM = f"{ym('m')} AS ym"
BRANDS = [f"Brand#{b}" for b in range(1, 26)]
GOODS = {"economy": "low", "promo": "low", "standard": "mid", "medium": "mid", "large": "high", "small": "high"}


def brand_months(spark, d):
    sums = lines(spark, d).groupBy("sku", "label", "m").agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept"))
    known = dealt_lookup(sums, hierarchy(spark, d), "sku", "inner")
    return known.groupBy("brand", "tier", "label", "m").agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept"))


_BM = "bm AS (SELECT brand, tier, label, m, sum(qty) AS qty, sum(kept) AS kept FROM lines JOIN master USING (sku) GROUP BY ALL)"


def sheet_months(spark, d):
    """All months of the data, as month indices; their number is bounded by the calendar."""
    first, last = lines(spark, d).agg(F.min("m"), F.max("m")).first()
    return range(first, last + 1)


def spelled(months):
    return [f"{(m - 1) // 12}{(m - 1) % 12 + 1:02d}" for m in months]


def serials(months):
    """Spreadsheet day numbers of the months' first days."""
    return [str((date((m - 1) // 12, (m - 1) % 12 + 1, 1) - date(1899, 12, 30)).days) for m in months]


def sheet_name(months, names):
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col("m") - (months[0] - 1))


def wide_months(df, ids, value, months, names=None):
    """One column per month."""
    names = names or spelled(months)
    return df.withColumn("_n", sheet_name(months, names)).groupBy(*ids).pivot("_n", list(names)).agg(F.sum(value))


def dealt_months(spark, d, *measures):
    """Sums per product and month, dealt by product for sheets of it: lines meet by product and month first, so that a busy product is spread over its months."""
    monthly = dealt(spark, d, lines(spark, d).select("sku", "m", *measures), "sku", "m").groupBy("sku", "m").agg(*[F.sum(c).alias(c) for c in measures])
    return dealt(spark, d, monthly, "sku")


@query(
    "job_competitor",
    with_sql(
        f"""WITH {_BM}, c AS (SELECT CASE WHEN label = 'di' THEN 'B2C' ELSE 'Total' END AS scope, CASE WHEN tier IN ('ECONOMY', 'PROMO') THEN 'low' WHEN tier IN ('STANDARD', 'MEDIUM') THEN 'mid' ELSE 'high' END AS class,
          m, sum(qty) FILTER (qty <> 7) AS value, sum(kept) AS volume FROM bm GROUP BY ALL)
        SELECT scope, class, {_YM}, value, volume, {r4('coalesce(' + div('value', 'volume') + ', 0)')} AS price FROM c""",
        "lines", "master",
    ),
)
def _(spark, d):
    """A report text sheet is laid out from the brand months: a header row per section, then its cells."""
    base = brand_months(spark, d).withColumn(
        "name", F.concat_ws(" ", F.lower("tier"), "brand", F.when(F.col("label") == "di", "b2c").otherwise("all"))
    )
    number = F.when(F.col("qty") == 7, F.lit("-7")).otherwise(F.format_number("qty", 1))
    order = F.abs(F.xxhash64("name", "m")) % 1_000_000_000

    def section(title, offset, cell):
        rows = base.select((order + offset).alias("row_no"), "name", idx_to_ym("m").alias("month"), cell.alias("cell"))
        return rows.withColumn("header", F.lit(None).cast("string"))

    # One header row per section, at the position before its first cell.
    heads = base.select("m").agg(F.min("m")).select(
        F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("row_no"), F.lit("Value").alias("header")), F.struct(F.lit(1_999_999_999).cast("long").alias("row_no"), F.lit("Volume").alias("header")))).alias("h")
    ).select("h.*")
    cells = section("Value", 0, number).unionByName(section("Volume", 2_000_000_000, F.concat(F.lit(" "), F.col("kept").cast("string"))))
    sheet = cells.unionByName(heads, allowMissingColumns=True).withColumn("sheet", F.lit("report"))
    out = J.competitor_report(sheet, "sheet", GOODS, {"b2c": "B2C"}, ["B2C", "Total"])
    return out.select("scope", "class", F.col("month").alias("ym"), "value", "volume", round_places("price").alias("price"))


WEEKS = [(f"W{w:02d}", f"2000-{min(12, (w - 1) * 12 // 52 + 1):02d}", w) for w in range(1, 53)]


@query(
    "job_osa",
    with_sql(
        """SELECT brand, CAST(week(l_shipdate) AS INTEGER) AS week, '2000-' || lpad(CAST((week(l_shipdate) - 1) * 12 // 52 + 1 AS VARCHAR), 2, '0') AS month, sum(l_quantity) AS value
        FROM lineitem JOIN master ON l_partkey = sku WHERE l_shipdate >= TIMESTAMP '2000-01-03' AND l_shipdate < TIMESTAMP '2001-01-01' GROUP BY ALL""",
        "master",
    ),
)
def _(spark, d):
    rows = table(spark, d, "lineitem").filter("l_shipdate >= timestamp_ntz'2000-01-03' AND l_shipdate < timestamp_ntz'2001-01-01'")
    weekly = rows.groupBy(F.col("l_partkey").alias("sku"), F.weekofyear("l_shipdate").alias("w")).agg(F.sum("l_quantity").alias("q"))
    named = weekly.join(hierarchy(spark, d), "sku").withColumn("col", F.format_string("W%02d", "w"))
    sheet = named.groupBy("brand").pivot("col", [c for c, _, _ in WEEKS]).agg(F.sum("q"))
    return J.availability_sheet(sheet, "brand", WEEKS).select("brand", "week", "month", "value")


@query(
    "job_unit_price",
    with_sql(f"SELECT sku, {_YM}, sum(qty) AS value, sum(kept) AS volume, {r4(div('sum(qty)', 'sum(kept)'))} AS price FROM lines GROUP BY ALL HAVING sum(kept) <> 0", "lines"),
)
def _(spark, d):
    monthly = dealt_months(spark, d, "qty", "kept")
    months = sheet_months(spark, d)
    out = J.unit_price(wide_months(monthly, ["sku"], "qty", months), wide_months(monthly, ["sku"], "kept", months), ["sku"], spelled(months))
    return out.select("sku", F.col("month").cast("int").alias("ym"), "value", "volume", round_places("price").alias("price"))


@query(
    "job_sellin_long",
    with_sql(
        f"""SELECT s.sku, name, {date_of('m')} AS date, sum(qty) AS volume, CASE WHEN m < 23995 THEN 'actual' ELSE 'forecasted' END AS status
        FROM lines s JOIN (SELECT sku, p_name AS name, tier FROM master WHERE tier IN ('LARGE', 'SMALL', 'PROMO')) USING (sku) GROUP BY ALL""",
        "lines", "master",
    ),
)
def _(spark, d):
    monthly = dealt_months(spark, d, "qty")
    tiers = dealt(spark, d, hierarchy(spark, d).select("sku", "tier"), "sku")
    months = sheet_months(spark, d)
    sheet = dealt_lookup(wide_months(monthly, ["sku"], "qty", months, serials(months)), tiers, "sku", "inner")
    # A product mapped under another tier contradicts its sheet and is dropped.
    known = F.when(F.col("tier").isin("LARGE", "SMALL", "PROMO"), F.col("tier")).otherwise("other")
    mapping = dealt(spark, d, master(spark, d).select("sku", F.col("p_name").alias("name"), known.alias("mapped_tier")), "sku")
    return J.sellin_long(sheet, mapping, "sku", ["name"], serials(months), "1999-07-14").select("sku", "name", "date", "volume", "status")


@query(
    "job_anp_long",
    with_sql(
        f"""WITH {_BM} SELECT k.brand, {date_of('r.m')} AS date, sum(kept) AS spending FROM (SELECT DISTINCT brand FROM bm) k CROSS JOIN (SELECT DISTINCT m FROM bm) r LEFT JOIN bm ON bm.brand = k.brand AND bm.m = r.m GROUP BY k.brand, r.m""",
        "lines", "master",
    ),
)
def _(spark, d):
    wide = brand_months(spark, d).groupBy("m").pivot("brand", BRANDS).agg(F.sum("kept"))
    serial = F.date_diff(idx_to_date("m"), F.lit("1900-01-01").cast("date")) + 13
    return J.spending_long(wide.withColumn("serial", serial).drop("m"), "serial", BRANDS).select("brand", "date", "spending")


@query("job_passthrough", "SELECT s_suppkey AS sp_code, s_name AS name, s_nationkey AS area FROM supplier")
def _(spark, d):
    drop = table(spark, d, "supplier").select("s_name", "s_suppkey", "s_nationkey")
    checked = check_contract(drop, ["s_suppkey", "s_name", "s_nationkey"])
    return checked.withColumnsRenamed({"s_suppkey": "sp_code", "s_name": "name", "s_nationkey": "area"})


@query(
    "job_products",
    "SELECT p_partkey AS sku_no, p_name AS product_name, CASE p_brand WHEN 'Brand#1' THEN 'AC' WHEN 'Brand#2' THEN 'NC' ELSE p_brand END AS brand, p_retailprice AS price FROM part",
)
def _(spark, d):
    from demandtide.functions.cleaning import map_values

    part = table(spark, d, "part").withColumnsRenamed({"p_partkey": "sku_no", "p_name": "product_name", "p_retailprice": "price"})
    return part.select("sku_no", "product_name", map_values("p_brand", {"Brand#1": "AC", "Brand#2": "NC"}).alias("brand"), "price")


@query("job_customers", "SELECT c_custkey AS store_code, c_name AS store_name, c_mktsegment AS channel FROM customer WHERE NOT contains(c_name, '000000001')")
def _(spark, d):
    names = {"c_custkey": "store_code", "c_name": "store_name", "c_mktsegment": "channel"}
    return J.customers(table(spark, d, "customer"), "c_name", "000000001", names)


@query(
    "job_pos",
    f"""SELECT l_suppkey AS store, l_partkey AS sku, strftime(make_date(year(l_shipdate), month(l_shipdate), 15), '%m/%d/%Y') AS date, sum(l_quantity) AS quantity, {r4('sum(l_extendedprice)')} AS pos_value
        FROM lineitem GROUP BY ALL""",
)
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        idx_to_ym(month_idx("l_shipdate")).alias("ym"), F.col("l_suppkey").alias("store"), F.col("l_partkey").alias("sku"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("pos_value"),
    )
    out = J.point_of_sale(rows, "ym", "store", "sku", "quantity", "pos_value")
    return out.withColumn("pos_value", round_places("pos_value"))


@query("job_sellout", f"SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS revenue, {r4(div('l_extendedprice', 'l_quantity'))} AS price FROM lineitem")
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("revenue")
    )
    return J.with_unit_price(rows, "revenue", "quantity").withColumn("price", round_places("price"))


@query(
    "job_sp_inventory",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, coalesce(b.p_name, a.p_name) AS sku, {r4(div('l_extendedprice', 'l_quantity'))} AS price FROM lineitem
        LEFT JOIN (SELECT p_partkey AS k, p_name FROM part WHERE p_type <> 'PROMO') a ON l_partkey = a.k
        LEFT JOIN (SELECT p_partkey + 7 AS k, p_name FROM part WHERE p_type <> 'PROMO') b ON l_partkey = b.k""",
)
def _(spark, d):
    codes = table(spark, d, "part").filter("p_type != 'PROMO'").select(F.col("p_partkey").alias("new"), (F.col("p_partkey") + 7).alias("old"), "p_name")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_quantity")
    out = J.stock(rows, codes, "l_partkey", "new", "old", "p_name", "l_extendedprice", "l_quantity")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", "sku", round_places("price").alias("price"))


FLOW_CYCLE = 23970
FLOW_KINDS = ("sellout", "offtake", "sp_inv", "retailer_inv", "sellin")
#: feed, type, provider, status, first, last, state, priority; of the rules in SQL.
_FLOW_RULES = """('u1_sellout', 'sellout', 'U1', 'actual', -2, -2, 'sent', 'BBC'), ('u1_offtake', 'offtake', 'U1', 'actual', -2, -1, NULL, 'BBC'),
        ('u1_retailer_inv', 'retailer_inv', 'U1', 'actual', -2, -2, NULL, 'Total'), ('u1_sp_inv', 'sp_inv', 'U1', 'actual', NULL, NULL, 'good', 'Total'),
        ('yuou_sellout', 'sellout', 'Yuou', 'actual', -2, -2, 'sent', 'Distribution'), ('yuou_offtake', 'offtake', 'Yuou', 'actual', -2, -1, 'sent', 'Distribution'),
        ('yuou_replaced', 'offtake', 'Yuou', 'actual', -2, -1, 'sent', 'Distribution'), ('yuou_retailer_inv', 'retailer_inv', 'Yuou', 'actual', -2, -2, NULL, 'Total'),
        ('yuou_sp_inv', 'sp_inv', 'Yuou', 'actual', NULL, NULL, 'scrap', 'Total'), ('u1_sellin', 'sellin', 'U1', 'actual', -2, -2, 'all', 'Total'),
        ('yuou_sellin', 'sellin', 'Yuou', 'actual', -2, -2, 'all', 'Total'), ('u1_sellin', 'sellin', 'U1', 'forecasted', -1, 4, 'all', 'Total'), ('yuou_sellin', 'sellin', 'Yuou', 'forecasted', -1, 4, 'all', 'Total')"""


@query(
    "job_tradeflow",
    with_sql(
        f"""WITH raw AS (SELECT (CASE WHEN l_linestatus = 'O' THEN 'u1' ELSE 'yuou' END) || '_' || CASE o_orderpriority WHEN '1-URGENT' THEN 'sellout' WHEN '2-HIGH' THEN 'offtake' WHEN '3-MEDIUM' THEN 'sp_inv' WHEN '4-NOT SPECIFIED' THEN 'retailer_inv' ELSE 'sellin' END AS feed,
            l_partkey AS sku, CASE o_custkey % 7 WHEN 0 THEN 'YUNJI' WHEN 1 THEN 'pop' ELSE 'C' || (o_custkey % 7) END AS party, l_suppkey % 2 = 0 AS near, o_orderstatus AS st, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS m, l_quantity AS q
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        twice AS (SELECT * FROM raw UNION ALL SELECT 'yuou_replaced', sku, party, near, st, m, q * 2 FROM raw WHERE feed = 'yuou_offtake' AND party = 'YUNJI'),
        stated AS (SELECT *, CASE WHEN feed LIKE '%sell%' OR feed LIKE '%offtake' OR feed = 'yuou_replaced' THEN (CASE WHEN feed LIKE '%sellin' THEN (CASE WHEN st <> 'P' THEN 'all' END) WHEN st <> 'O' THEN 'sent' END)
            WHEN feed = 'u1_sp_inv' THEN (CASE WHEN st = 'F' THEN 'good' ELSE 'scrap' END) WHEN feed = 'yuou_sp_inv' THEN (CASE WHEN st = 'F' THEN 'good' ELSE 'scrap' END) END AS state FROM twice
            WHERE NOT (feed = 'yuou_offtake' AND party = 'YUNJI') AND NOT (feed = 'u1_sp_inv' AND party = 'pop')),
        rules(rfeed, type, sp, status, lo, hi, rstate, chan) AS (VALUES {_FLOW_RULES}),
        hit AS (SELECT *, CASE WHEN type = 'sp_inv' THEN {FLOW_CYCLE} - 2 ELSE m END AS mm FROM stated JOIN rules ON rfeed = feed AND (rstate IS NULL OR rstate = state) AND (lo IS NULL OR m - {FLOW_CYCLE} BETWEEN lo AND hi)
            WHERE NOT (status = 'forecasted' AND near AND m - {FLOW_CYCLE} > 3)),
        g AS (SELECT sku, sp, type, status, CASE WHEN type IN ('sellout', 'offtake') THEN (CASE party WHEN 'C2' THEN 'Ali' WHEN 'C3' THEN 'NewChannel' WHEN 'YUNJI' THEN 'YUNJI' ELSE chan END) ELSE chan END AS channel, mm AS m, sum(q) AS q FROM hit WHERE sku % 10 <> 3 GROUP BY ALL)
        SELECT g.sku, sku_name, sp, type, channel, status, {ym('m')} AS ym, {r4('q * (p_size * 100.0::DOUBLE) / 1e6')} AS quantity FROM g JOIN master USING (sku) LEFT JOIN (SELECT sku, p_name AS sku_name FROM master WHERE tier <> 'MEDIUM') USING (sku)""",
        "master",
    ),
)
def _(spark, d):
    """Ten feeds in one frame, two per order priority; one retailer's rows come from an eleventh."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus", "o_custkey")
    joined = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", "l_shipdate", "l_quantity").join(orders, "l_orderkey")
    side = F.when(F.col("l_linestatus") == "O", "u1").otherwise("yuou")
    kind = F.element_at(F.array(*[F.lit(k) for k in FLOW_KINDS]), F.substring("o_orderpriority", 1, 1).cast("int"))
    customer, status = F.col("o_custkey") % 7, F.col("o_orderstatus")
    state = (
        F.when(kind.isin("sellout", "offtake"), F.when(status != "O", flows.SHIPPED)).when(kind == "sellin", F.when(status != "P", flows.TOTAL_STATE))
        .when(kind == "sp_inv", F.when(status == "F", flows.GOOD).otherwise(flows.SCRAP[0]))
    )
    party = F.when(customer == 0, flows.REPLACED).when(customer == 1, flows.OWN_STOCK).otherwise(F.concat(F.lit("C"), customer.cast("string")))
    rows = joined.select(
        F.concat_ws("_", side, kind).alias("feed"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("sku"), party.alias("party"),
        F.when(F.col("l_suppkey") % 2 == 0, flows.PLANT).otherwise("Other").alias("plant"), state.alias("state"), month_idx("l_shipdate").alias("m"), F.col("l_quantity").alias("quantity"),
    )
    again = rows.filter((F.col("feed") == "yuou_offtake") & (F.col("party") == flows.REPLACED)).withColumns({"feed": F.lit("yuou_replaced"), "quantity": F.col("quantity") * 2})
    feeds = [f"{s}_{k}" for s in ("u1", "yuou") for k in FLOW_KINDS] + ["yuou_replaced"]
    sold = [f for f in feeds if f.endswith(("sellout", "offtake", "replaced"))]
    channels = spark.createDataFrame([(f, *p) for f in sold for p in (("C2", "ALI"), ("C3", "New channel"), (flows.REPLACED, flows.REPLACED))], "feed string, party string, channel string")
    every = F.explode(F.array(*[F.lit(f) for f in feeds])).alias("feed")
    parts = master(spark, d)
    names = parts.filter("sku % 10 != 3").select(every, F.concat(F.lit("P"), F.col("sku").cast("string")).alias("feed_sku"), "sku")
    products = parts.filter("tier != 'MEDIUM'").select("sku", F.col("p_name").alias("sku_name"))
    grams = parts.select("sku", (F.col("p_size") * 100.0).alias("grams"))
    out = flows.trade_flow(rows.unionByName(again), flows.di_rules(), FLOW_CYCLE, channels, names, products, grams)
    return out.select("sku", "sku_name", "sp", "type", "channel", "status", idx_to_ym("m").alias("ym"), round_places("quantity").alias("quantity"))


@query(
    "job_scope_sum",
    with_sql(
        f"""WITH w AS (SELECT sku, m, coalesce(sum(offtake) FILTER (label = 'di'), 0) / 32 AS DI, coalesce(sum(offtake) FILTER (label = 'eib'), 0) / 32 AS EIB FROM sku_label WHERE m BETWEEN 23965 AND 24000 GROUP BY ALL)
        SELECT sku, {_YM}, scope, round_even(volume, 4) AS volume FROM (UNPIVOT (SELECT *, DI + EIB AS IL FROM w) ON DI, EIB, IL INTO NAME scope VALUE volume)""",
        "sku_label",
    ),
)
def _(spark, d):
    facts = sku_label(spark, d).select("sku", "label", "m", (F.col("offtake") / 32).alias("volume"))
    di, eib = (facts.filter(F.col("label") == x).drop("label") for x in ("di", "eib"))
    out = J.scope_sum(di, eib, ["sku"], "m", "volume", 23965, 24000)
    return out.withColumn("ym", idx_to_ym("m")).drop("m")


_SHEETS = """span AS (SELECT max(m) - 18 AS lo FROM lines), sold AS (SELECT channel, label, brand, m, sum(qty) AS q FROM channel_lines JOIN master USING (sku), span WHERE m > lo GROUP BY ALL),
        grid AS (SELECT channel, label, brand, m, coalesce(q, 0) AS q FROM (SELECT DISTINCT channel, label FROM sold) CROSS JOIN (SELECT DISTINCT brand FROM sold) CROSS JOIN (SELECT DISTINCT m FROM sold) LEFT JOIN sold USING (channel, label, brand, m))"""


def offtake_cells(spark, d):
    """Ten sheets, a channel and scope each, as cells: DI sheets with two header rows and merged blocks, EIB sheets with one row of day numbers.

    A brand stands in row 3 + 2 * its number; the rows between hold totals that no mapping names. The first block and the
    columns after the data are to be left out.
    """
    months = list(sheet_months(spark, d))[-PLAN_MONTHS:]
    first, width = months[0], len(months)
    sums = channel_lines(spark, d).filter(F.col("m") >= first).groupBy("sku", "channel", "label", "m").agg(F.sum("qty").alias("q")).join(hierarchy(spark, d).select("sku", "brand"), "sku")
    sold = sums.groupBy("channel", "label", "brand", "m").agg(F.sum("q").alias("q"))
    sheet = F.concat_ws("/", "channel", "label").alias("sheet")
    kinds = sold.select(sheet, "channel", "label").distinct()
    brands = F.explode(F.array(*[F.struct(F.lit(b).alias("brand"), F.lit(int(b.split("#")[1])).alias("n")) for b in BRANDS])).alias("b")
    every = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(k).alias("k"), F.lit(spelled([m])[0][2:]).alias("yymm"), F.lit(serials([m])[0]).alias("day")) for k, m in enumerate(months)])).alias("t")
    di = F.col("label") == "di"
    # a brand without sales in a month shows a dash or a word
    grid = kinds.select("sheet", "label", brands).select("sheet", "label", "b.*").select("*", every).select("sheet", "label", "brand", "n", "t.*")
    body = grid.join(sold.select(sheet, "brand", "m", "q"), ["sheet", "brand", "m"], "left")
    row = (F.col("n") * 2 + 3).cast("long")
    shown = F.when(di, F.coalesce(F.format_number("q", 1), F.lit(" - "))).otherwise(F.coalesce(F.col("q").cast("string"), F.lit("n/a")))
    at = F.when(di, F.col("k") + 1 + width).otherwise(F.col("k") + 2).cast("long")
    values = body.select("sheet", row.alias("row"), at.alias("col"), shown.alias("text"))
    shares = body.filter(di).select("sheet", row.alias("row"), (F.col("k") + 1).cast("long").alias("col"), F.lit("12%").alias("text"))
    totals = body.select("sheet", (row + 1).alias("row"), at.alias("col"), F.lit("1,000").alias("text"))
    tops = kinds.select("sheet", "label", every).select("sheet", "label", "t.*")
    left, right = (F.col("k") + 1).cast("long"), (F.col("k") + 1 + width).cast("long")
    heads = ((1, left, F.when(F.col("k") == 0, "Share")), (1, right, F.when(F.col("k") == 0, "Absolute")), (2, left, F.col("yymm")), (2, right, F.col("yymm")))
    two = tops.filter(di).select("sheet", F.explode(F.array(*[F.struct(F.lit(r).cast("long").alias("row"), c.alias("col"), t.alias("text")) for r, c, t in heads])).alias("c")).select("sheet", "c.*")
    one = tops.filter(~di).select("sheet", F.lit(4).cast("long").alias("row"), (F.col("k") + 2).cast("long").alias("col"), F.col("day").alias("text"))
    beyond = kinds.filter(~di).select("sheet", F.lit(5).cast("long").alias("row"), F.lit(width + 3).cast("long").alias("col"), F.lit("99").alias("text"))
    cells = values.unionByName(shares).unionByName(totals).unionByName(two).unionByName(one).unionByName(beyond)
    mapping = kinds.select("*", brands).select("sheet", "channel", "label", "b.brand", (F.col("b.n") * 2 + 4).alias("row_no"))
    return cells, mapping


@query(
    "job_brand_to_sku",
    with_sql(
        f"""WITH {_SHEETS}, p AS (SELECT brand, tier, stage, m, sum(kept) AS k FROM lines JOIN master USING (sku) GROUP BY ALL), s AS (SELECT *, {div('k', 'sum(k) OVER (PARTITION BY brand, m)')} AS share FROM p)
        SELECT brand, channel, label, {_YM}, tier, stage, {r4('q * share')} AS volume FROM grid JOIN s USING (brand, m)""",
        "channel_lines", "lines", "master",
    ),
)
def _(spark, d):
    """Ten sheets of two layouts read as cells, then spread over tier and stage by the month's share inside the brand."""
    cells, mapping = offtake_cells(spark, d)
    is_di = F.col("sheet").endswith("/di")
    day_month = idx_to_ym(month_idx(F.date_add(F.lit(date(1899, 12, 30)), F.col("serial"))))
    read = sheets.brand_sheets(cells.filter(is_di), mapping.filter(is_di)).unionByName(sheets.serial_sheets(cells.filter(~is_di), mapping.filter(~is_di), day_month))
    volumes = read.select("brand", "channel", "label", F.col("month").alias("ym"), F.col("value").alias("volume"))
    sold = lines(spark, d).groupBy("sku", "m").agg(F.sum("kept").alias("volume")).join(hierarchy(spark, d), "sku").withColumn("ym", idx_to_ym("m"))
    out = J.brand_to_sku(volumes, sold, ["brand", "ym"], ["tier", "stage"], "volume")
    return out.select("brand", "channel", "label", "ym", "tier", "stage", round_places("volume").alias("volume"))


@query(
    "row_number_join",
    """WITH sheet AS (SELECT p_name, p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS r FROM part), mapping AS (SELECT s_suppkey * 23 AS row_no, s_name, s_nationkey FROM supplier)
    SELECT m.row_no - 1 AS row, p_name, p_partkey, s_name, s_nationkey FROM mapping m LEFT JOIN sheet s ON s.r = m.row_no - 1""",
)
def _(spark, d):
    """Products as a sheet in the order of their names; rows are named by number, and names of rows beyond the sheet stay."""
    sheet = sheets.numbered_rows(table(spark, d, "part").select("p_name", "p_partkey"), ["p_name"])
    mapping = table(spark, d, "supplier").select((F.col("s_suppkey") * 23).alias("row_no"), "s_name", "s_nationkey")
    return sheets.rows_by_number(sheet, mapping)


@query(
    "job_scope_diff",
    with_sql(
        f"""WITH n AS (SELECT sku, m, offtake_il AS v FROM panel0 WHERE m >= 23977), o AS (SELECT sku, m, offtake_il * 2 AS v FROM panel0 WHERE m < 23989),
        il AS (SELECT * FROM n UNION ALL SELECT * FROM o WHERE m < 23977),
        w AS (SELECT il.sku, il.m, v AS IL, offtake_di AS DI, v - offtake_di AS EIB FROM il JOIN panel0 p ON p.sku = il.sku AND p.m = il.m)
        SELECT sku, {_YM}, scope, volume FROM (UNPIVOT w ON IL, DI, EIB INTO NAME scope VALUE volume)""",
        "panel0",
    ),
)
def _(spark, d):
    base = panel(spark, d).select("sku", "m", "offtake_il", "offtake_di")
    new = base.filter("m >= 23977").select("sku", "m", F.col("offtake_il").alias("volume"))
    old = base.filter("m < 23989").select("sku", "m", (F.col("offtake_il") * 2).alias("volume"))
    di = base.filter("offtake_di > 0").select("sku", "m", F.col("offtake_di").alias("volume"))
    out = J.scope_diff(new, old, di, ["sku", "m"], "volume")
    return out.withColumn("ym", idx_to_ym("m")).drop("m")


@query(
    "job_unit_table",
    "SELECT p_name AS name, p_size * 10 AS grams FROM part UNION SELECT p_brand, p_size * 10 FROM part",
)
def _(spark, d):
    part = table(spark, d, "part")
    first = part.select("p_partkey", (F.col("p_size") * 10).alias("grams"))
    names = part.select("p_partkey", F.col("p_name").alias("name"))
    second = part.select(F.col("p_brand").alias("name"), (F.col("p_size") * 10).alias("grams"))
    return J.unit_table(first, second, names, "p_partkey").select("name", "grams")


@query(
    "job_uplift_long",
    with_sql(f"WITH {_BM} SELECT brand, tier, {date_of('m')} AS date, floor(sum(kept)) / 100 AS uplift FROM bm GROUP BY ALL", "lines", "master"),
)
def _(spark, d):
    percent = F.concat(F.col("kept").cast("bigint").cast("string"), F.lit("%"))
    sums = brand_months(spark, d).groupBy("brand", "tier", "m").agg(F.sum("kept").alias("kept")).withColumn("pct", percent)
    months = sheet_months(spark, d)
    names = [f"{(m - 1) % 12 + 1}/1/{(m - 1) // 12}" for m in months]
    wide = sums.withColumn("_n", sheet_name(months, names)).groupBy("brand", "tier").pivot("_n", names).agg(F.max("pct"))
    return J.months_long(wide, ["brand", "tier"], names, "uplift").select("brand", "tier", "date", "uplift")


@query(
    "job_unified_split",
    with_sql(
        f"""WITH h AS (SELECT brand, channel, sum(qty) AS q FROM channel_lines JOIN master USING (sku) GROUP BY ALL), r AS (SELECT brand, channel, {div('q', 'sum(q) OVER (PARTITION BY brand)')} AS sr FROM h),
        {_BM}, w AS (SELECT brand, m, sum(qty) AS offtake, sum(kept) AS sellin FROM bm WHERE brand NOT IN ('Brand#3', 'Brand#4') GROUP BY ALL)
        SELECT brand, channel, {_YM}, {r4('offtake * sr')} AS offtake, {r4('sellin * sr')} AS sellin FROM r JOIN w USING (brand)""",
        "channel_lines", "lines", "master",
    ),
)
def _(spark, d):
    base = brand_months(spark, d)
    months = sheet_months(spark, d)
    sheets = [wide_months(base, ["brand"], col, months).withColumn("measure", F.lit(name)) for col, name in (("qty", "Off"), ("kept", "In"))]
    out_of_scope = hierarchy(spark, d).filter("brand IN ('Brand#3', 'Brand#4')").select("brand").distinct()
    sums = channel_lines(spark, d).groupBy("sku", "channel").agg(F.sum("qty").alias("qty")).join(hierarchy(spark, d), "sku")
    from demandtide.operators.aggregating import split_ratio

    shares = split_ratio(sums, ["brand", "channel"], ["brand"], "qty").drop("qty")
    out = J.unified_split(sheets[0].unionByName(sheets[1]), ["brand"], spelled(months), {"Off": "offtake", "In": "sellin"}, out_of_scope, shares, "brand")
    return out.select("brand", "channel", F.col("month").cast("int").alias("ym"), round_places("offtake").alias("offtake"), round_places("sellin").alias("sellin"))


@query(
    "job_unified_blocks",
    with_sql(
        f"""WITH {_BM}, g AS (SELECT tier, m, CASE WHEN label = 'di' THEN 'Ali' ELSE 'Total' END AS channel, sum(qty) AS q, sum(kept) AS k FROM bm GROUP BY ALL)
        SELECT tier AS sku, channel, {_YM}, sum(q) AS offtake, sum(CASE WHEN channel = 'Total' THEN k ELSE 0 END) AS stock FROM g WHERE tier <> 'PROMO' GROUP BY ALL""",
        "lines", "master",
    ),
)
def _(spark, d):
    """Two channel blocks side by side with text cells; one row per tier and kind."""
    base, months = brand_months(spark, d), sheet_months(spark, d)
    names = spelled(months)

    def sheet(value, kind):
        rows = base.withColumn("_n", F.concat(F.when(F.col("label") == "di", "a").otherwise("t"), sheet_name(months, names)))
        columns = [f"{side}{n}" for side in "at" for n in names]
        wide = rows.groupBy("tier").pivot("_n", columns).agg(F.sum(value))
        texts = [F.coalesce(F.format_number(c, 1), F.lit(" - ")).alias(c) for c in columns]
        return wide.select("tier", F.lit(kind).alias("kind"), *texts)

    blocks = {"Ali": [f"a{n}" for n in names], "Total": [f"t{n}" for n in names]}
    products = hierarchy(spark, d).select("tier").distinct().filter("tier != 'PROMO'").withColumn("sku", F.col("tier"))
    out = J.unified_blocks(
        sheet("qty", "OFF").unionByName(sheet("kept", "INV")), ["tier", "kind"], blocks, names, products, "tier",
        {"OFF": "offtake", "INV": "stock"}, ["INV"],
    )
    return out.select("sku", "channel", F.col("month").cast("int").alias("ym"), "offtake", "stock")


PLAN_MONTHS = 18
#: What of the history is missing: every fourth month, one brand's last years, another brand altogether.
_GAPS = "m % 4 <> 0 AND NOT (brand = 'Brand#7' AND m > 23950) AND brand <> 'Brand#9'"


@query(
    "job_unified_uplift",
    with_sql(
        f"""WITH span AS (SELECT max(m) - {PLAN_MONTHS} AS lo FROM lines),
        v AS (SELECT brand AS section, tier AS stage, m, sum(qty) AS offtake, sum(kept) AS sellin FROM lines JOIN master USING (sku), span WHERE m > lo GROUP BY ALL),
        h AS (SELECT brand AS section, tier AS stage, sku, channel, m, (m - 1) // 12 AS y, sum(kept) AS k FROM channel_lines JOIN master USING (sku) WHERE {_GAPS} GROUP BY ALL HAVING sum(kept) > 0),
        cube AS (SELECT section, stage, sku, channel, 1 AS level, m AS bucket, k FROM h UNION ALL SELECT section, stage, sku, channel, 2, y, sum(k) FROM h GROUP BY ALL UNION ALL SELECT section, stage, sku, channel, 3, 0, sum(k) FROM h GROUP BY ALL),
        members AS (SELECT brand AS section, tier AS stage, sku, channel, count(*) OVER (PARTITION BY brand, tier) AS n FROM master, (SELECT DISTINCT o_orderpriority AS channel FROM orders)),
        t AS (SELECT section, stage, level, bucket, sum(k) AS total FROM cube GROUP BY ALL),
        best AS (SELECT v.section, v.stage, v.m, min(level) AS level FROM v JOIN t ON t.section = v.section AND t.stage = v.stage AND t.bucket = CASE level WHEN 1 THEN m WHEN 2 THEN (m - 1) // 12 ELSE 0 END GROUP BY ALL),
        shares AS (SELECT b.section, b.stage, b.m, c.sku, c.channel, c.k / t.total AS share, b.level FROM best b JOIN cube c ON c.section = b.section AND c.stage = b.stage AND c.level = b.level AND c.bucket = CASE b.level WHEN 1 THEN b.m WHEN 2 THEN (b.m - 1) // 12 ELSE 0 END
              JOIN t ON t.section = b.section AND t.stage = b.stage AND t.level = b.level AND t.bucket = c.bucket
            UNION ALL SELECT v.section, v.stage, v.m, x.sku, x.channel, 1.0::DOUBLE / n, 4 FROM v JOIN members x ON x.section = v.section AND x.stage = v.stage LEFT JOIN best b ON b.section = v.section AND b.stage = v.stage AND b.m = v.m WHERE b.m IS NULL)
        SELECT s.section, s.stage, s.sku, country, channel, {ym('s.m')} AS ym, {r4('offtake * share')} AS offtake, {r4("(CASE WHEN s.stage = 'PROMO' THEN 0 ELSE sellin END) * share")} AS sellin,
        {r4("offtake * share * (1 + CASE WHEN channel = '1-URGENT' THEN 0.25 ELSE 0 END)")} AS total_offtake, CAST(level AS INTEGER) AS level
        FROM shares s JOIN v ON v.section = s.section AND v.stage = s.stage AND v.m = s.m JOIN master ON master.sku = s.sku""",
        "lines", "channel_lines", "master",
    ),
)
def _(spark, d):
    """A sheet with the brand as section row and its tiers as stage rows below, and a sell-in sheet with text cells that lacks one tier."""
    months = list(sheet_months(spark, d))[-PLAN_MONTHS:]
    base = brand_months(spark, d).filter(F.col("m") >= months[0])
    number = F.split_part("brand", F.lit("#"), F.lit(2)).cast("long") * 1000
    stages = wide_months(base, ["brand", "tier"], "qty", months).withColumn(
        "row_no", number + F.row_number().over(_order_by_tier())
    ).withColumn("stage", F.col("tier")).withColumn("section_name", F.lit(None).cast("string"))
    heads = hierarchy(spark, d).select("brand").distinct().select(
        number.alias("row_no"), F.col("brand").alias("section_name"), F.lit(None).cast("string").alias("stage")
    )
    sheet = stages.drop("brand", "tier").unionByName(heads, allowMissingColumns=True).withColumn("sheet", F.lit("plan"))
    described = F.concat_ws("/", "brand", "tier")
    cells = wide_months(base.filter("tier != 'PROMO'").withColumn("description", described), ["description"], "kept", months)
    cells = cells.select("description", *[F.coalesce(F.format_number(c, 1), F.lit(" - ")).alias(c) for c in spelled(months)])
    known = hierarchy(spark, d)
    sums = dealt_lookup(channel_lines(spark, d).groupBy("sku", "channel", "m").agg(F.sum("kept").alias("volume")), known, "sku", "inner").filter(_GAPS)
    history = sums.select(F.col("brand").alias("section"), F.col("tier").alias("stage"), "sku", "channel", idx_to_ym("m").alias("ym"), "volume")
    products = known.select(F.col("brand").alias("section"), F.col("tier").alias("stage"), "sku", "country", described.alias("description"))
    spans = F.explode(F.array(*[F.lit(int(m)) for m in spelled(months)])).alias("ym")
    uplift = known.select("country").distinct().select("country", F.lit(CHANNELS[0]).alias("channel"), spans, F.lit(0.25).alias("uplift"))
    offtake = unified.stage_volumes(sheet, "sheet", spelled(months))
    out = unified.unified_il(offtake, unified.described_sellin(cells, spelled(months)), products, CHANNELS, history, uplift)
    return out.withColumns({c: round_places(c) for c in ("offtake", "sellin", "total_offtake")})


def _order_by_tier():
    from pyspark.sql import Window

    return Window.partitionBy("brand").orderBy("tier")


@query(
    "sheet_columns",
    with_sql(f"WITH {_BM} SELECT brand AS brand_name, CAST(tier AS VARCHAR) AS subtobrand, {ym('m')} AS month, sum(qty) AS quantity FROM bm GROUP BY ALL", "lines", "master"),
)
def _(spark, d):
    """A sheet with a yearly column beside the months and an empty row per brand, read back as clean rows."""
    months = sheet_months(spark, d)
    sheet = wide_months(brand_months(spark, d), ["brand", "tier"], "qty", months).withColumnsRenamed({"brand": "Brand Name", "tier": "Sub-Brand"})
    sheet = sheet.withColumn(f"FY {spelled(months)[0]}", F.lit(1.0))
    blank = sheet.select("Brand Name").distinct().withColumn("Sub-Brand", F.lit("none"))
    held = month_columns(sheet.columns, r"\d{6}")
    rows = normalised_names(drop_empty_rows(sheet.unionByName(blank, allowMissingColumns=True), held))
    out = unpivot_long(rows, ["brand_name", "subtobrand"], held, "month", "quantity", drop_null=True)
    return out.withColumn("month", F.col("month").cast("int"))
