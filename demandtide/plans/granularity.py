"""Split of product forecasts to channel and package, and the actuals beside them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.functions.cleaning import coalesce_zero, map_values, ratio
from demandtide.operators.aggregating import group_sum, split_ratio
from demandtide.operators.joining import outer_panels, with_totals
from demandtide.operators.reshaping import union_sources

# Marker of actual rows, channel of the scope without channels, store channels, default store channel.
ACTUAL_HORIZON = -99
SINGLE_CHANNEL = "NewChannel"
STORE_CHANNELS = {"MT": "KA", "IMBS": "GT", "KMBS": "KA", "EC": "EC", "Others": "GT"}
DEFAULT_STORE_CHANNEL = "GT"
DI_CHANNELS = {"ALI": "Ali", "New channel": SINGLE_CHANNEL}
COUNTRY_WITHIN = "CN"
MEASURES = ("offtake", "sellin", "sellout", "retailer_inv", "sp_inv")


def split_forecast(forecast: DataFrame, ratios: DataFrame, sku: str, value: str, keep_missing: bool) -> DataFrame:
    """Forecast times split ratio. The ratio table drives: its keys without a forecast stay with a null value or go."""
    out = ratios.join(forecast, sku, "left" if keep_missing else "inner").withColumn(value, F.col(value) * F.col("split_ratio"))
    return (out if keep_missing else out.filter(F.col(value).isNotNull())).drop("split_ratio")


def ratios_of(history: DataFrame, child: Sequence[str], parent: Sequence[str], quantity: str) -> DataFrame:
    filled = history.withColumn(quantity, coalesce_zero(quantity))
    return split_ratio(filled, child, parent, quantity).drop(quantity)


def actuals_il(offtake: DataFrame, sellin: DataFrame, ratios: DataFrame, sku: str, month: str) -> DataFrame:
    """Offtake per channel beside sell-in split to channels."""
    split = sellin.join(ratios, sku, "inner").select(sku, "channel", month, (F.col("sellin") * F.col("split_ratio")).alias("sellin"))
    return outer_panels([offtake, split], [sku, "channel", month])


def actuals_di(flow: DataFrame, package_ratios: DataFrame, sku: str, code: str, month: str, drop_all_since: int) -> DataFrame:
    """Channel offtake and sell-out beside sell-in and stocks split from total rows by package and channel."""
    rows = flow.filter(~((F.col(month) >= drop_all_since) & (F.col("sp") == "all"))).withColumn("quantity", coalesce_zero("quantity"))
    keys = [sku, code, "channel", month]

    def mean(kind: str) -> Column:
        return F.avg(F.when(F.col("type") == kind, F.col("quantity"))).alias(kind)

    channels = (
        rows.filter(F.col("type").isin("offtake", "sellout") & (F.col("channel") != "Total"))
        .groupBy(*keys)
        .agg(mean("offtake"), mean("sellout"))
    )
    stocks = ("sellin", "retailer_inv", "sp_inv")
    totals = (
        rows.filter(F.col("type").isin(*stocks) & (F.col("channel") == "Total"))
        .groupBy(*keys)
        .agg(*[mean(k) for k in stocks])
        .groupBy(code, month)
        .agg(*[coalesce_zero(F.sum(k)).alias(k) for k in stocks])
    )
    split = package_ratios.join(totals, code, "inner").select(*keys, *[(F.col(k) * F.col("split_ratio")).alias(k) for k in stocks])
    return outer_panels([channels, split], keys).fillna(0.0, subset=list(MEASURES))


def actuals_eib(offtake: DataFrame, sellin: DataFrame, sku: str, month: str, month_date: Column, min_age_days: int = 60) -> DataFrame:
    """Months at least 60 days older than their produced date, with the sell-in of the month."""
    settled = offtake.filter(month_date < F.date_sub("produced_date", min_age_days))
    sums = group_sum(settled, [sku, month], ["offtake"])
    return sums.join(group_sum(sellin, [sku, month], ["sellin"]), [sku, month], "left").withColumn("channel", F.lit(SINGLE_CHANNEL))


def package_token(code: Column | str) -> Column:
    """The package part of a five-part code."""
    parts = F.split(code, "_")
    return F.when(F.size(parts) == 5, F.element_at(parts, -2)).otherwise("N/A")


def granularity_il(
    di_history: DataFrame, il_history: DataFrame, il_sellin: DataFrame, eib_history: DataFrame, eib_sellin: DataFrame,
    forecast: DataFrame, attributes: DataFrame, sku: str, code: str, month: str, cut: int, month_date: Column, drop_all_since: int,
) -> tuple[DataFrame, DataFrame]:
    """Forecasts and actuals of the three scopes at channel and package, with product attributes.

    History from the cut month on is ignored. Sell-in and sell-out of the actuals are delivered as zero.
    """
    di, il, ilin, eib, eibin = (
        df.filter(F.col(month) < cut) for df in (di_history, il_history, il_sellin, eib_history, eib_sellin)
    )
    di_channels = di.filter((F.col("type") == "offtake") & (F.col("channel") != "Total")).withColumn(
        "channel", map_values("channel", DI_CHANNELS)
    )
    di_ratios = ratios_of(di_channels, [code, sku, "channel"], [sku], "quantity")
    package_ratios = ratios_of(di_channels, [code, sku, "channel"], [code], "quantity")
    il_ratios = ratios_of(il, [sku, "channel"], [sku], "offtake")

    def of(label: str) -> DataFrame:
        return forecast.select(sku, month, "horizon", F.lit(label).alias("label"), F.col(f"yhat_{label}_calib").alias("offtake"))

    forecasts = union_sources(
        [
            split_forecast(of("di"), di_ratios, sku, "offtake", keep_missing=True),
            split_forecast(of("il"), il_ratios, sku, "offtake", keep_missing=False).withColumn(code, F.col(sku)),
            of("eib").withColumn(code, F.col(sku)).withColumn("channel", F.lit(SINGLE_CHANNEL)),
        ]
    ).dropna(subset=[month])
    il_rows = group_sum(il, [sku, "channel", month], ["offtake"])
    actuals = union_sources(
        [
            actuals_di(di, package_ratios, sku, code, month, drop_all_since).withColumn("label", F.lit("di")),
            actuals_eib(eib, eibin, sku, month, month_date).withColumn("label", F.lit("eib")).withColumn(code, F.col(sku)),
            actuals_il(il_rows, group_sum(ilin, [sku, month], ["sellin"]), il_ratios, sku, month)
            .withColumn("label", F.lit("il"))
            .withColumn(code, F.col(sku)),
        ]
    ).withColumn("horizon", F.lit(ACTUAL_HORIZON))

    def finish(df: DataFrame) -> DataFrame:
        return df.join(attributes, sku, "inner").withColumn(code, package_token(code))

    done = finish(actuals).withColumns({m: coalesce_zero(m) for m in MEASURES} | {"sellin": F.lit(0.0), "sellout": F.lit(0.0)})
    return finish(forecasts).withColumn("offtake", coalesce_zero("offtake")), done


def granularity_dc(
    store_sales: DataFrame, stores: DataFrame, products: DataFrame, forecast: DataFrame, sellout: DataFrame, sellin: DataFrame,
    stock: DataFrame, month: str, selected: DataFrame | None = None, channels: Mapping[str, str] = STORE_CHANNELS,
) -> tuple[DataFrame, DataFrame]:
    """DC forecasts and actuals per channel; stores map to channels, flows split by the sales shares.

    Sales are summed per store and product before the store and product joins.
    """
    sums = group_sum(store_sales, ["store_code", "sku_no", month], ["quantity"])
    named = sums.join(products, "sku_no", "left").join(stores.select("store_code", F.col("channel").alias("_c")), "store_code", "left")
    channel = F.coalesce(map_values("_c", channels), F.lit(DEFAULT_STORE_CHANNEL))
    offtake = group_sum(named.withColumn("channel", channel), ["sku", "channel", month], ["quantity"]).withColumnRenamed("quantity", "offtake")
    ratios = split_ratio(offtake, ["sku", "channel"], ["sku"], "offtake").drop("offtake")

    def split(df: DataFrame, name: str) -> DataFrame:
        rows = group_sum(df, ["sku", month], [name]).join(ratios, "sku", "inner")
        return rows.select("sku", "channel", month, (F.col(name) * F.col("split_ratio")).alias(name))

    named_sellout = group_sum(sellout, ["sku_no", month], ["sellout"]).join(products, "sku_no", "left")
    panels = [offtake, split(named_sellout, "sellout"), split(sellin, "sellin"), split(stock, "sp_inv")]
    actual = outer_panels(panels, ["sku", "channel", month]).fillna(0.0).withColumn("horizon", F.lit(ACTUAL_HORIZON))
    if selected is not None:
        actual = actual.join(selected, "sku", "left_semi")
    made = split_forecast(forecast.withColumnRenamed("yhat", "offtake"), ratios, "sku", "offtake", keep_missing=False)

    def finish(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "label": F.lit("DC"), "country": F.lit(COUNTRY_WITHIN), "brand": F.substring("sku", 1, 2),
                "stage": F.expr("substring(sku, 3)"),
            }
        )

    return finish(made), finish(actual).withColumns({"sellin": F.lit(0.0), "sellout": F.lit(0.0)})


def week_split(monthly: DataFrame, weeks: DataFrame, shares: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """Month totals spread evenly over their weeks, then to products by weekly percentage.

    The week table holds one row per calendar week.
    """
    counted = weeks.groupBy(month).agg(F.collect_list("week").alias("_weeks"))
    spread = monthly.join(F.broadcast(counted), month, "inner").select(
        *keys, month, F.explode("_weeks").alias("week"), (F.col(value) / F.size("_weeks")).alias(value)
    )
    return spread.join(shares, [*keys, "week"], "inner").withColumn(value, F.col(value) * F.col("pct") / 100.0).drop("pct")


def deaggregate(leaf: DataFrame, edited: DataFrame, keys: Sequence[str], value: str, new_total: str) -> DataFrame:
    """Leaves moved in proportion to the edited total; an even split where the old total is zero."""
    both = with_totals(leaf, keys, _old=F.sum(value), _n=F.count(F.lit(1))).join(edited, list(keys), "inner")
    moved = F.when(F.col("_old") == 0, F.col(new_total) / F.col("_n")).otherwise(
        F.col(value) * ratio(new_total, "_old")
    )
    return both.withColumn(value, moved).drop("_old", "_n", new_total)
