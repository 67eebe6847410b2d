"""The driver's tables read in the roles of a planning model.

lineitem is the long sales fact, part the product master, orders the channel
and status source. A line ships under scope ``di`` or ``eib`` by its status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandtide.functions.periods import month_idx
from demandtide.operators.joining import dealt_lookup
from demandtide.session import written

LABELS = ("di", "eib", "il")
CHANNELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
LAGS = 11


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def label_of(status: str = "l_linestatus") -> Column:
    return F.when(F.col(status) == "O", "di").otherwise("eib")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("sku"),
        label_of().alias("label"),
        month_idx("l_shipdate").alias("m"),
        F.col("l_quantity").alias("qty"),
        F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity")).alias("kept"),
        F.col("l_extendedprice").alias("amount"),
        "l_orderkey",
        "l_suppkey",
    )


def master(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("sku"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("country"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("tier"),
        F.concat(F.lit("S"), (F.floor((F.col("p_size") - 1) / 10) + 1).cast("string")).alias("stage"),
        "p_size",
        "p_name",
        "p_retailprice",
    )


def hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    return master(spark, folder).select("sku", "country", "brand", "tier", "stage")


def sku_label(spark: SparkSession, folder: str) -> DataFrame:
    return (
        lines(spark, folder)
        .groupBy("sku", "label", "m")
        .agg(F.sum("qty").alias("offtake"), F.sum("kept").alias("sellin"))
    )


def bare_panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per sku and month with the three scopes side by side; IL is DI plus EIB."""

    def of(label: str, col: str) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col(col)).otherwise(0.0))

    return (
        lines(spark, folder)
        .groupBy("sku", "m")
        .agg(
            of("di", "qty").alias("offtake_di"),
            of("eib", "qty").alias("offtake_eib"),
            F.sum("qty").alias("offtake_il"),
            of("di", "kept").alias("sellin_di"),
            of("eib", "kept").alias("sellin_eib"),
            F.sum("kept").alias("sellin_il"),
        )
    )


def panel(spark: SparkSession, folder: str) -> DataFrame:
    return bare_panel(spark, folder).join(hierarchy(spark, folder), "sku")


def channel_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"),
        month_idx("o_orderdate").alias("om"),
        "o_custkey",
    )
    base = lines(spark, folder).select("sku", "label", "m", "qty", "kept", "l_orderkey")
    n = task_count(spark, folder)
    return base.repartition(n, "l_orderkey").join(orders.repartition(n, "l_orderkey"), "l_orderkey").drop("l_orderkey")


def flow_cube(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Order lines joined with their orders once, summed to the finest grain that any split asks for, and stored.

    Actuals, ratios, scope sums and forecasts are all derived from these rows, so
    neither fact is scanned or shuffled again.
    """
    keys = ["sku", "label", "channel", "status", "m", "om", *extra]
    return written(dealt(spark, folder, channel_lines(spark, folder), "sku", "m").groupBy(*keys).agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept")), "flow-cube")


def channel_months(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines summed to product, channel and month, dealt by product and month, so that a busy product is spread over its months."""
    rows = dealt(spark, folder, channel_lines(spark, folder).select("sku", "channel", "m", "qty", "kept"), "sku", "m")
    return rows.groupBy("sku", "channel", "m").agg(F.sum("qty").alias("qty"), F.sum("kept").alias("kept"))


def master_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Sums and row counts of every measure of the raw masters, from one scan of the lines and one join with their orders, stored.

    Lines without an order keep their place; channel, status and om are null there. ``list`` is the rounded-down unit
    price; ``osa`` and ``isa`` are the discounts of lines flagged A and N, ``n_placed`` counts both. A mean is a sum over ``n_``, so that it can be
    taken at any coarser grain.
    """
    lines_ = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("sku"), label_of().alias("label"), month_idx("l_shipdate").alias("m"), F.col("l_quantity").alias("qty"),
        F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity")).alias("kept"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).alias("list"),
        F.when(F.col("l_returnflag") == "A", F.col("l_discount")).alias("osa"),
        F.when(~F.col("l_returnflag").isin("A", "R"), F.col("l_discount")).alias("isa"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.when(F.col("l_returnflag") != "R", 1).alias("placed"), "l_orderkey",
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("channel"), F.col("o_orderstatus").alias("status"), month_idx("o_orderdate").alias("om")
    )
    measures = ("qty", "kept", "list", "osa", "isa", "discount", "tax")
    joined = lines_.join(orders, "l_orderkey", "left").groupBy("sku", "label", "channel", "status", "m", "om")
    counts = [F.count(c).alias(f"n_{c}") for c in (*measures, "placed") if c != "kept"]
    return written(joined.agg(*[F.sum(c).alias(c) for c in measures], *counts), "master-cube")


def last_month(spark: SparkSession, folder: str) -> Column:
    """Newest month index of the sales fact, as a scalar subquery on one column."""
    return table(spark, folder, "lineitem").agg(F.max(month_idx("l_shipdate")).alias("last")).scalar()


#: Lines per task where sums are as many as lines: their maps stay small whatever the session's number of partitions.
TASK_LINES = 250_000


def task_count(spark: SparkSession, folder: str, times: int = 1) -> int:
    """Partitions that the lines ask for, if ``times`` rows come of a line; they are counted in the files' footers."""
    n = -(-times * table(spark, folder, "lineitem").count() // TASK_LINES)
    return max(n, spark.sparkContext.defaultParallelism)


def dealt(spark: SparkSession, folder: str, df: DataFrame, *keys: str, times: int = 1) -> DataFrame:
    """``df``, a row a line at most, dealt by ``keys`` over as many partitions as the lines ask for; ``times`` as many rows come of it in the same tasks."""
    return df.repartition(task_count(spark, folder, times), *keys)


def based_dealt(spark: SparkSession, folder: str, with_il: bool = False) -> DataFrame:
    """``based``, dealt by sku and ``_r``, the calendar month: a month and the one a year later stay together, so all sums need one shuffle."""
    scopes = F.explode(F.array("label", F.lit("il"))) if with_il else F.col("label")
    rows = lines(spark, folder).select("sku", "label", "m", "qty", (F.col("m") % 12).alias("_r"))
    monthly = dealt(spark, folder, rows, "sku", "_r").groupBy("sku", "_r", "label", "m").agg(F.sum("qty").alias("qty"))  # rows are doubled after the sum
    both = monthly.select("sku", "_r", scopes.alias("label"), "m", "qty").select(
        "sku",
        "_r",
        "label",
        F.explode(
            F.array(
                F.struct(F.col("m"), F.col("qty").alias("actual"), F.lit(0.0).alias("base"), F.lit(0).alias("b")),
                F.struct(
                    (F.col("m") + 12).alias("m"), F.lit(0.0).alias("actual"), F.col("qty").alias("base"), F.lit(1).alias("b")
                ),
            )
        ).alias("e"),
    )
    sums = both.groupBy("sku", "_r", "label", F.col("e.m").alias("m")).agg(
        F.sum("e.actual").alias("actual"), F.sum("e.base").alias("base"), F.max("e.b").alias("_b")
    )
    return sums.filter((F.col("_b") == 1) & (F.col("m") <= last_month(spark, folder))).drop("_b")


def based(spark: SparkSession, folder: str, with_il: bool = False) -> DataFrame:
    """Sales of a month beside the sales twelve months earlier, without a self join."""
    return based_dealt(spark, folder, with_il).drop("_r")


def with_lags(df: DataFrame) -> DataFrame:
    """Deterministic forecasts: last year's month raised with the lag, for lags 1 to 11."""
    kept = [c for c in df.columns if c != "base"]
    lagged = df.withColumn("lag", F.explode(F.sequence(F.lit(1), F.lit(LAGS))))
    return lagged.select(*kept, "lag", (F.col("m") - F.col("lag")).alias("cycle"), (F.col("base") * (1 + F.col("lag") / 64.0)).alias("forecast"))


def cycles(spark: SparkSession, folder: str, with_il: bool = False) -> DataFrame:
    return with_lags(based(spark, folder, with_il))


def leaf_bases(spark: SparkSession, folder: str) -> DataFrame:
    """``based`` with the product hierarchy, a row per product and calendar month of which comes to where the sales are dealt."""
    products = hierarchy(spark, folder).withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(11))))
    return dealt_lookup(based_dealt(spark, folder), products, ["sku", "_r"], "inner").drop("_r")


def leafs(spark: SparkSession, folder: str) -> DataFrame:
    """Forecasts with the product hierarchy, which is joined before the lags multiply the rows."""
    return with_lags(leaf_bases(spark, folder))
