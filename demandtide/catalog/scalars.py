"""Queries on column functions: calendar, text, numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandtide.catalog.registry import date_of, idx, query, r4, with_sql, ym
from demandtide.catalog.roles import hierarchy, lines, table
from demandtide.functions import cleaning as C, periods as P
from demandtide.operators.dense import seasonality

# Keyword classes used by the text queries, in matching order.
COLOURS = {"red": "warm", "blue": "cold", "green": "cold", "small": "size", "large": "size"}
GOODS = ("widget", "gear", "ring", "bolt", "plate", "valve", "gadget")


@query(
    "num_clean",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice AS amount,
        CASE WHEN l_returnflag = 'R' THEN 0.0 WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS cell FROM lineitem""",
)
def _(spark, d):
    # Amount as report text with thousands commas; cells with placeholders and words among the numbers.
    text = F.concat(F.lit(" "), F.format_number("l_extendedprice", 2), F.lit(" "))
    cell = (
        F.when(F.col("l_returnflag") == "R", F.lit(" - "))
        .when(F.col("l_returnflag") == "A", F.lit("n.a."))
        .otherwise(F.col("l_quantity").cast("string"))
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", C.to_number(text).alias("amount"), C.cell_to_number(cell).alias("cell")
    )


def _case(pairs, expr, default):
    whens = " ".join(f"WHEN contains({expr}, '{word}') THEN '{cls}'" for word, cls in pairs)
    return f"CASE {whens} ELSE {default} END"


@query(
    "keyword_classify",
    f"""SELECT p_partkey, {_case(COLOURS.items(), 'p_name', "'other'")} AS first_class,
        {_case(reversed(list(COLOURS.items())), 'p_name', "'other'")} AS last_class FROM part""",
)
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        C.first_keyword("p_name", COLOURS, "other").alias("first_class"),
        C.last_keyword("p_name", COLOURS, "other").alias("last_class"),
    )


@query(
    "token_extract",
    f"SELECT p_partkey, {_case([(g, g) for g in reversed(GOODS)], 'p_name', 'NULL')} AS token FROM part",
)
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", C.last_token("p_name", GOODS).alias("token"))


@query(
    "string_parts",
    """SELECT c_custkey, substring(c_name, 1, 2) AS head, split_part(c_name, '#', 2) AS code,
        CASE WHEN len(string_split(o, '_')) = 5 THEN string_split(o, '_')[4] ELSE 'N/A' END AS package
        FROM (SELECT *, replace(c_mktsegment, 'U', '_a_b_c_') AS o FROM customer)""",
)
def _(spark, d):
    parts = F.split(F.replace("c_mktsegment", F.lit("U"), F.lit("_a_b_c_")), "_")
    return table(spark, d, "customer").select(
        "c_custkey",
        F.substring("c_name", 1, 2).alias("head"),
        F.element_at(F.split("c_name", "#"), 2).alias("code"),
        F.when(F.size(parts) == 5, F.element_at(parts, -2)).otherwise("N/A").alias("package"),
    )


@query(
    "concat_key",
    with_sql("SELECT sku, country || '_' || brand || '_' || tier || '_' || stage AS gran FROM master", "master"),
)
def _(spark, d):
    return hierarchy(spark, d).select("sku", C.concat_key("country", "brand", "tier", "stage").alias("gran"))


@query(
    "string_norm",
    """SELECT c_custkey, ltrim(split_part(c_name, '#', 2), '0') AS code, upper(c_mktsegment) AS seg_up,
        lower(c_mktsegment) AS seg_low, trim(' ' || c_name || ' ') AS name FROM customer""",
)
def _(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        C.strip_leading_zeros(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("code"),
        F.upper("c_mktsegment").alias("seg_up"),
        F.lower("c_mktsegment").alias("seg_low"),
        F.trim(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("name"),
    )


@query("month_start", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", P.month_start("o_orderdate").alias("month"))


@query(
    "excel_date",
    """SELECT o_orderkey, CAST(DATE '1900-01-01' + CAST(o_orderkey % 60000 AS INTEGER) AS DATE) AS d1900,
        CAST(DATE '1899-12-30' + CAST(o_orderkey % 60000 AS INTEGER) AS DATE) AS d1899 FROM orders""",
)
def _(spark, d):
    serial = F.col("o_orderkey") % 60000
    return table(spark, d, "orders").select(
        "o_orderkey",
        P.serial_to_date(serial, P.SERIAL_BASE_1900).alias("d1900"),
        P.serial_to_date(serial, P.SERIAL_BASE_1899).alias("d1899"),
    )


@query(
    "parse_month",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
        ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS month FROM orders""",
)
def _(spark, d):
    # The same month written in a different way per priority, and an unreadable one.
    spelled = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("no month"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "MMMM yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "MMM yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyyMM"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "M/d/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return table(spark, d, "orders").select("o_orderkey", P.parse_month(spelled).alias("month"))


@query(
    "format_date",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) AS short_date,
        strftime(o_orderdate, '%m/%d/%Y') AS long_date FROM orders""",
)
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "M/d/yyyy").alias("short_date"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("long_date"),
    )


@query(
    "make_month",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
)
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", P.make_month(F.year("o_orderdate"), F.month("o_orderdate")).alias("month")
    )


@query(
    "period_range",
    with_sql(
        f"""SELECT sku, {ym('p')} AS ym FROM (SELECT sku, CAST(unnest(range(min(m), max(m) + 1)) AS INTEGER) AS p
        FROM lines GROUP BY sku)""",
        "lines",
    ),
)
def _(spark, d):
    """Every month between the first and the last sale of a product."""
    spans = lines(spark, d).groupBy("sku").agg(
        P.idx_to_ym(F.min("m")).alias("first"), P.idx_to_ym(F.max("m")).alias("last")
    )
    return spans.select("sku", F.explode(P.ym_range("first", "last")).alias("ym"))


@query(
    "period_shift",
    f"""SELECT o_orderkey, {ym(idx('o_orderdate') + ' + 5')} AS plus5, {ym(idx('o_orderdate') + ' - 14')} AS minus14
        FROM orders""",
)
def _(spark, d):
    month = P.idx_to_ym(P.month_idx("o_orderdate"))
    return table(spark, d, "orders").select(
        "o_orderkey", P.shift_ym(month, 5).alias("plus5"), P.shift_ym(month, -14).alias("minus14")
    )


@query(
    "origin_target_grid",
    with_sql(
        f"""SELECT {ym('m')} AS date_when_predicting, {ym('m + h')} AS date_to_predict
        FROM months, (SELECT CAST(unnest(range(1, 7)) AS INTEGER) AS h)""",
        "months",
    ),
)
def _(spark, d):
    """Each month of the data as an origin with its next six target months."""
    months = lines(spark, d).select("m").distinct()
    grid = months.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(6))))
    return grid.select(
        P.idx_to_ym("m").alias("date_when_predicting"), P.idx_to_ym(F.col("m") + F.col("h")).alias("date_to_predict")
    )


@query(
    "horizon",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, {idx('l_shipdate')} - {idx('o_orderdate')} AS horizon
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, d):
    ship = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", P.idx_to_ym(P.month_idx("l_shipdate")).alias("dtp"))
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), P.idx_to_ym(P.month_idx("o_orderdate")).alias("dwp")
    )
    joined = ship.join(orders, "l_orderkey")
    return joined.select("l_orderkey", "l_partkey", "l_linenumber", P.horizon("dwp", "dtp").alias("horizon"))


@query(
    "seasonality",
    with_sql(
        f"""SELECT {ym('m')} AS ym, {r4('((m - 1) % 12 + 1) / 12.0::DOUBLE')} AS month,
        {r4('sin(pi() * (((m - 1) % 12 + 1) / 12.0::DOUBLE))')} AS sin_month,
        {r4('cos(pi() * (((m - 1) % 12 + 1) / 12.0::DOUBLE))')} AS cos_month FROM months""",
        "months",
    ),
)
def _(spark, d):
    months = lines(spark, d).select(P.idx_to_ym("m").alias("ym"))
    out = seasonality(months, "ym")
    return out.withColumns({c: C.round_places(c) for c in ("month", "sin_month", "cos_month")})


@query("round4", "SELECT l_orderkey, l_partkey, l_linenumber, round_even(l_quantity / 32.0::DOUBLE, 4) AS rounded FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", C.round_half_even(F.col("l_quantity") / 32.0).alias("rounded")
    )


@query(
    "unit_convert",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * (p_size * 100.0::DOUBLE) / 1e6 AS tons
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _(spark, d):
    fact = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    grams = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") * 100.0).alias("grams"))
    joined = fact.join(grams, "l_partkey")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", C.tins_to_tons("l_quantity", "grams").alias("tons"))


LUNAR_SQL = ", ".join(
    f"({year}, {int(day[:2]) + (1 if int(day[3:]) > 24 else 0)})" for year, day in P.LUNAR_NEW_YEAR.items()
)


@query(
    "cny_month",
    f"""SELECT o_orderkey, CAST(c.cny AS INTEGER) AS cny_month, month(o_orderdate) = c.cny AS in_season FROM orders
        LEFT JOIN (VALUES {LUNAR_SQL}) AS c(y, cny) ON year(o_orderdate) = c.y""",
)
def _(spark, d):
    out = table(spark, d, "orders").select("o_orderkey", "o_orderdate", P.lunar_month(F.year("o_orderdate")).alias("cny_month"))
    return out.select("o_orderkey", "cny_month", (F.month("o_orderdate") == F.col("cny_month")).alias("in_season"))


@query(
    "select_by_key",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN l_tax WHEN 'A' THEN l_discount
        WHEN 'N' THEN l_extendedprice END AS chosen FROM lineitem""",
)
def _(spark, d):
    choice = C.pick_by_key("l_returnflag", {"R": "l_tax", "A": "l_discount", "N": "l_extendedprice"})
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", choice.alias("chosen"))


@query(
    "iso_weeks_in_month",
    with_sql(
        f"""WITH days AS (SELECT CAST(unnest(generate_series((SELECT {date_of('min(m)')} FROM lines) - INTERVAL 14 DAY,
            (SELECT {date_of('max(m)')} FROM lines) + INTERVAL 40 DAY, INTERVAL 1 DAY)) AS DATE) AS monday),
        owned AS (SELECT monday, week(monday) AS w, CASE WHEN week(monday) = 1 AND month(monday) = 12 THEN (year(monday) + 1) * 12 + 1
            ELSE year(monday) * 12 + month(monday) END AS m FROM days WHERE isodow(monday) = 1)
        SELECT {ym('m')} AS ym, CAST(w AS INTEGER) AS week, monday FROM owned JOIN months USING (m)""",
        "months",
    ),
)
def _(spark, d):
    months = lines(spark, d).select("m").distinct()
    weeks = months.select("m", F.explode(P.iso_week_mondays(P.idx_to_date("m"))).alias("monday"))
    return weeks.select(P.idx_to_ym("m").alias("ym"), F.weekofyear("monday").alias("week"), "monday")


@query(
    "cycle_lag",
    "SELECT o_orderkey, CASE WHEN day(o_orderdate) > 25 THEN 1 ELSE 0 END AS cycle_lag FROM orders",
)
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", P.cycle_lag("o_orderdate").alias("cycle_lag"))


@query(
    "cycle_window_filter",
    f"""SELECT o_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE {idx('l_shipdate')} - {idx('o_orderdate')} BETWEEN 1 AND 2""",
)
def _(spark, d):
    fact = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    joined = fact.join(orders, fact.l_orderkey == orders.o_orderkey)
    return joined.filter(P.in_cycle_window("l_shipdate", "o_orderdate", 1, 2)).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )


@query(
    "status_rule",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linestatus = 'O' AND {idx('l_shipdate')} >= 23990 THEN 'forecasted'
        WHEN {idx('l_shipdate')} < 23988 THEN 'actual' ELSE 'other' END AS status FROM lineitem""",
)
def _(spark, d):
    """Plant and month against the cycle month 1999-02 decide the row status."""
    month, cycle = P.month_idx("l_shipdate"), 1999 * 12 + 2
    status = (
        F.when((F.col("l_linestatus") == "O") & (month >= cycle), "forecasted")
        .when(month < cycle - 2, "actual")
        .otherwise("other")
    )
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", status.alias("status"))


@query(
    "value_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status,
        CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS strict_status FROM orders""",
)
def _(spark, d):
    names = {"F": "finished", "O": "open"}
    return table(spark, d, "orders").select(
        "o_orderkey",
        C.map_values("o_orderstatus", names).alias("status"),
        C.map_values("o_orderstatus", names, keep_unmapped=False).alias("strict_status"),
    )


@query(
    "return_adjust",
    with_sql(
        f"""SELECT l_partkey AS sku, {ym(idx('l_shipdate'))} AS ym, sum(CASE WHEN l_returnflag IN ('R') THEN -l_quantity ELSE l_quantity END) AS quantity
        FROM lineitem WHERE l_linestatus = 'O' AND {idx('l_shipdate')} >= 23953 GROUP BY ALL"""
    ,"lines"),
)
def _(spark, d):
    """Billing rows of one organisation since 1996, returns with a negative sign."""
    rows = table(spark, d, "lineitem").filter(
        (F.col("l_linestatus") == "O") & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp"))
    )
    signed = rows.select(
        F.col("l_partkey").alias("sku"),
        P.idx_to_ym(P.month_idx("l_shipdate")).alias("ym"),
        C.signed_quantity("l_quantity", "l_returnflag", ["R"]).alias("quantity"),
    )
    return signed.groupBy("sku", "ym").agg(F.sum("quantity").alias("quantity"))


@query("project_contract", "SELECT p_partkey AS sku_no, p_brand AS brand, p_type AS tier, 'offtake' AS type, 'T' AS unit FROM part")
def _(spark, d):
    renamed = table(spark, d, "part").withColumnsRenamed({"p_partkey": "sku_no", "p_brand": "brand", "p_type": "tier"})
    return renamed.withColumns({"type": F.lit("offtake"), "unit": F.lit("T")}).select("sku_no", "brand", "tier", "type", "unit")


@query(
    "filter_isin",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
        AND o_orderstatus NOT IN ('P') AND o_totalprice >= 1000""",
)
def _(spark, d):
    return (
        table(spark, d, "orders")
        .filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P"))
        .filter("o_totalprice >= 1000")
        .select("o_orderkey", "o_orderpriority", "o_orderstatus")
    )
