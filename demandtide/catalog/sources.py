"""Queries on reading and writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandtide.catalog.registry import idx, query, r4, with_sql, ym
from demandtide.catalog.roles import hierarchy, lines, panel, table
from demandtide.functions.cleaning import round_places, sink_number
from demandtide.functions.periods import idx_to_ym, month_idx
from demandtide.operators.aggregating import group_sum
from demandtide.operators.quality import check_contract, column_profile, column_values, reconcile
from demandtide.operators.reshaping import union_sources
from demandtide.session import shared_folder
from demandtide.sources.reading import latest_file, latest_version, load_channel_fact, read_delimited, read_scenario
from demandtide.sources.writing import append_scenario, content_sum, publish, published, read_snapshot, reload_table, replace_partitions, write_contract, write_snapshot


@query(
    "latest_version",
    """SELECT e.event_id, e.user_id, e.event_type, e.value FROM events e JOIN (
        SELECT user_id, event_type, max(CAST(ts AS DATE)) AS day FROM events GROUP BY ALL) n
        ON e.user_id = n.user_id AND e.event_type = n.event_type AND CAST(e.ts AS DATE) = n.day""",
)
def _(spark, d):
    versions = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return latest_version(versions, ["user_id", "event_type"], "day").select("event_id", "user_id", "event_type", "value")


_CHANNEL_NAMES = {"4-NOT SPECIFIED": "Other", "5-LOW": "Other", "1-URGENT": "Urgent"}


@query(
    "load_tables",
    f"""SELECT CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Other' WHEN '5-LOW' THEN 'Other'
        WHEN '1-URGENT' THEN 'Urgent' ELSE o_orderpriority END AS channel, o_orderstatus AS status,
        {ym(idx('o_orderdate'))} AS ym, {r4('sum(o_totalprice)')} AS quantity FROM orders GROUP BY ALL""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"),
        idx_to_ym(month_idx("o_orderdate")).alias("ym"),
        F.col("o_totalprice").alias("quantity"),
    )
    out = load_channel_fact(orders, ["o_orderkey", "o_custkey"], "channel", _CHANNEL_NAMES, "quantity")
    return out.withColumn("quantity", round_places("quantity"))


@query("latest_file_scan", with_sql(f"SELECT sku, {ym('m')} AS ym, offtake_il FROM panel0", "panel0"))
def _(spark, d):
    folder = shared_folder(spark, "drops")
    sales = panel(spark, d).select("sku", idx_to_ym("m").alias("ym"), "offtake_il")
    sales.filter("ym < 199801").write.option("header", True).csv(f"{folder}/20200101_pos.csv")
    sales.write.option("header", True).csv(f"{folder}/20200201_pos.csv")
    return latest_file(spark, folder, "pos", "sku long, ym int, offtake_il double")


@query("write_contract", with_sql(f"SELECT brand, {ym('m')} AS ym, sum(offtake_il) AS quantity FROM panel GROUP BY ALL", "panel"))
def _(spark, d):
    folder = shared_folder(spark, "contract")
    sums = group_sum(panel(spark, d), ["brand", "m"], ["offtake_il"])
    out = sums.select("brand", idx_to_ym("m").alias("ym"), F.col("offtake_il").alias("quantity"))
    write_contract(out, ["brand", "ym", "quantity"], folder, "2020-01-01")
    return read_delimited(spark, f"{folder}/dt=2020-01-01", "brand string, ym int, quantity double", sep=";")


@query("contract_check", "SELECT p_partkey, p_brand, p_type, CAST(p_size AS INTEGER) AS p_size FROM part")
def _(spark, d):
    part = table(spark, d, "part").select("p_type", "p_size", "p_brand", "p_partkey")
    return check_contract(part, ["p_partkey", "p_brand", "p_type", "p_size"])


_SCENARIO_ROWS = """SELECT {version} AS version, CAST({cycle} AS INTEGER) AS cyc_dat, brand, """ + ym("m") + """ AS mea_dat,
    {factor} * sum(offtake_il) AS oft_trk_val FROM panel GROUP BY ALL"""


def _scenario(spark, d, version, cycle, factor):
    sums = group_sum(panel(spark, d), ["brand", "m"], ["offtake_il"])
    return sums.select(
        F.lit(version).alias("version"),
        F.lit(cycle).alias("cyc_dat"),
        "brand",
        idx_to_ym("m").alias("mea_dat"),
        (F.lit(factor) * F.col("offtake_il")).alias("oft_trk_val"),
    )


@query(
    "scenario_write",
    with_sql(
        _SCENARIO_ROWS.format(version="'v1'", cycle=200101, factor="1.0::DOUBLE")
        + " UNION ALL "
        + _SCENARIO_ROWS.format(version="'v2'", cycle=200101, factor="1.5::DOUBLE"),
        "panel",
    ),
)
def _(spark, d):
    """Two versions, the second published twice."""
    folder = shared_folder(spark, "scenario")
    for version, factor in (("v1", 1.0), ("v2", 1.5), ("v2", 99.0)):
        publish(_scenario(spark, d, version, 200101, factor), folder, version)
    return published(spark, folder, every=True)


@query(
    "scenario_append",
    with_sql(
        _SCENARIO_ROWS.format(version="'v1'", cycle=200101, factor="1.0::DOUBLE")
        + " UNION ALL "
        + _SCENARIO_ROWS.format(version="'v2'", cycle=200102, factor="1.5::DOUBLE"),
        "panel",
    ),
)
def _(spark, d):
    folder = shared_folder(spark, "scenario")
    append_scenario(_scenario(spark, d, "v1", 200101, 1.0), folder)
    append_scenario(_scenario(spark, d, "v2", 200102, 1.5), folder)
    return spark.read.parquet(folder)


@query("reload_table", with_sql(_SCENARIO_ROWS.format(version="'v1'", cycle=200101, factor="2.0::DOUBLE"), "panel"))
def _(spark, d):
    """A table rebuilt from its own rows; the second run of the same version changes nothing."""
    folder = shared_folder(spark, "reloaded")
    rows = reload_table(_scenario(spark, d, "v1", 200101, 1.0), folder, "1")
    for _ in range(2):
        rows = reload_table(rows.withColumn("oft_trk_val", F.col("oft_trk_val") * 2), folder, "2")
    return rows


_INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("snapshot", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS whole FROM {t}" for t in _INPUTS))
def _(spark, d):
    """All inputs exported with a manifest, read back in their types and compared with what was exported."""
    folder = shared_folder(spark, "snapshot")
    tables = {t: table(spark, d, t) for t in _INPUTS}
    write_snapshot(spark, tables, folder, "20200101000000")
    back = read_snapshot(spark, folder, "20200101000000")
    rows = []
    for t, df in tables.items():
        sums = [content_sum(x).withColumn("side", F.lit(k)) for k, x in enumerate((df, back[t]))]
        both = sums[0].unionByName(sums[1]).agg(F.max(F.when(F.col("side") == 0, F.col("n_rows"))).alias("n_rows"), (F.count_distinct("n_rows", "digest") == 1).alias("whole"))
        rows.append(both.select(F.lit(t).alias("table_name"), "n_rows", "whole"))
    return union_sources(rows)


@query(
    "column_values",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM part GROUP BY ALL" for c in ("p_partkey", "p_size", "p_name", "p_brand", "p_type")),
)
def _(spark, d):
    return column_values(table(spark, d, "part").select("p_partkey", "p_size", "p_name", "p_brand", "p_type"))




@query(
    "partition_overwrite",
    with_sql(
        _SCENARIO_ROWS.format(version="'new'", cycle=200101, factor="2.0::DOUBLE")
        + " UNION ALL "
        + _SCENARIO_ROWS.format(version="'old'", cycle=200102, factor="1.0::DOUBLE"),
        "panel",
    ),
)
def _(spark, d):
    folder = shared_folder(spark, "partitions")
    first = _scenario(spark, d, "old", 200101, 1.0).unionByName(_scenario(spark, d, "old", 200102, 1.0))
    replace_partitions(first, folder, ["cyc_dat"])
    replace_partitions(_scenario(spark, d, "new", 200101, 2.0), folder, ["cyc_dat"])
    return spark.read.parquet(folder)


@query(
    "scenario_read",
    f"""SELECT o_orderkey, o_totalprice FROM orders WHERE {ym(idx('o_orderdate'))} = 199703 AND o_orderstatus = 'F'
        AND CAST(o_orderdate AS DATE) = DATE '1997-03-15'""",
)
def _(spark, d):
    stored = table(spark, d, "orders").select(
        "o_orderkey",
        "o_totalprice",
        idx_to_ym(month_idx("o_orderdate")).alias("cyc_dat"),
        F.col("o_orderstatus").alias("frc_usr_nam_dsc"),
        F.to_date("o_orderdate").alias("frc_cre_dat"),
        F.to_date("o_orderdate").alias("frc_mdf_dat"),
    )
    day = F.lit("1997-03-15").cast("date")
    return read_scenario(stored, 199703, "F", day, day).select("o_orderkey", "o_totalprice")


@query(
    "sink_rounding",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN v < 0 AND v > -1e-6 THEN 0.0 ELSE floor(v * 1e6 + 0.5) / 1e6 END AS written
        FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN -l_discount * 1e-5 ELSE l_extendedprice * l_tax / 7.0::DOUBLE END AS v FROM lineitem)""",
)
def _(spark, d):
    value = F.when(F.col("l_returnflag") == "R", -F.col("l_discount") * F.lit(1e-5)).otherwise(
        F.col("l_extendedprice") * F.col("l_tax") / 7.0
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", sink_number(value).alias("written")
    )


def _profile_sql(numeric, text, relation):
    parts = []
    for col in numeric + text:
        stats = (
            f"coalesce(min({col})::DOUBLE, 0) AS min_value, coalesce(max({col})::DOUBLE, 0) AS max_value, "
            f"{r4(f'coalesce(avg({col}), 0)')} AS mean_value, {r4(f'coalesce(stddev_samp({col}), 0)')} AS std_value"
            if col in numeric
            else "0.0::DOUBLE AS min_value, 0.0::DOUBLE AS max_value, 0.0::DOUBLE AS mean_value, 0.0::DOUBLE AS std_value"
        )
        parts.append(
            f"""SELECT '{col}' AS column_name, {stats}, count(*) - count({col}) AS n_null, count(*) AS n_rows,
            {len(numeric + text)} AS n_columns, count(DISTINCT {col}) + CASE WHEN count(*) > count({col}) THEN 1 ELSE 0 END AS n_distinct,
            substring((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM {relation} WHERE {col} IS NOT NULL)), 1, 500) AS values_text
            FROM {relation}"""
        )
    return " UNION ALL ".join(parts)


@query("column_profile", _profile_sql(["p_partkey", "p_size"], ["p_name", "p_brand", "p_type"], "part"))
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_name", "p_brand", "p_type")
    out = column_profile(part, 500)
    return out.withColumns({c: round_places(c) for c in ("mean_value", "std_value")})


@query(
    "reconcile",
    with_sql(
        f"""SELECT brand, {ym('m')} AS ym, sum(qty) - sum(kept) AS diff_quantity FROM lines JOIN master USING (sku)
        GROUP BY ALL HAVING abs(sum(qty) - sum(kept)) >= 0.001""",
        "lines",
        "master",
    ),
)
def _(spark, d):
    monthly = lines(spark, d).groupBy("sku", "m").agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept"))
    fact = monthly.join(hierarchy(spark, d), "sku")
    raw = group_sum(fact, ["brand", "m"], ["qty"]).withColumnRenamed("qty", "quantity")
    done = group_sum(fact, ["brand", "m"], ["kept"]).withColumnRenamed("kept", "quantity")
    out = reconcile(raw, done, ["brand", "m"], ["quantity"])
    return out.select("brand", idx_to_ym("m").alias("ym"), "diff_quantity")
