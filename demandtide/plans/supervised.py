"""Supervised tables: one row per series, origin month and target month.

Each grouping level is turned into dense series once and joined to the finest
series as arrays. Origins and targets are exploded last, so the joins run over
the number of series, never over series times origins times horizons.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandtide.functions.periods import idx_to_ym, season_terms
from demandtide.operators.dense import dense_series, lag_columns, month_axis, target_at, with_origins, with_targets
from demandtide.session import written


@dataclass(frozen=True)
class Level:
    """Lag features ``{prefix}sales1..timelag`` of one value summed or averaged to some keys."""

    prefix: str
    keys: tuple[str, ...]
    value: str
    timelag: int = 12
    how: str = "sum"


# Level prefixes, as they name the feature columns.
def il_levels(leaf: Sequence[str], sku: str, label: str, country: str, stage: str, timelag: int = 12) -> list[Level]:
    out = []
    names = {
        "offtake": ("country_brand_tier_stage_label_", "country_brand_tier_stage_", "label_", "country_label_", "stage_"),
        "sellout": ("sellout_sku_label_", "sellout_sku_", "sellout_label_", "sell_out_country_label_", "sell_out_stage_"),
        "sellin": ("sellin_sku_label_", "sellin_sku_", "sellin_label_", "sell_in_country_label_", "sell_in_stage_"),
    }
    keys = (tuple(leaf), (sku,), (label,), (country, label), (stage,))
    for value, prefixes in names.items():
        out += [Level(prefix, key, value, timelag) for prefix, key in zip(prefixes, keys)]
    return out


def dc_levels(leaf: Sequence[str], sku: str, label: str, timelag: int = 12) -> list[Level]:
    return [
        Level("sku_", tuple(leaf), "offtake", timelag),
        Level("sellin_sku_", (sku, label), "sellin", timelag),
        Level("price_country_", (sku,), "sellout_price", 5, "mean"),
        Level("anp_", (sku,), "anp", 2, "mean"),
        Level("store_distribution_", (sku,), "store_distribution", 2, "mean"),
    ]


def di_levels(leaf: Sequence[str], sku: str, label: str) -> list[Level]:
    return [
        Level("sales_sku_w_pkg_", tuple(leaf), "offtake", 4),
        Level("country_brand_tier_stage_", (sku,), "offtake", 3),
        Level("country_brand_tier_stage_label_", (sku, label), "offtake", 3),
    ]


def brand_levels(label: str, country: str, brand: str, gran: str, prices: Sequence[str] = (), timelag: int = 12) -> list[Level]:
    leaf = (label, country, brand, gran)
    return [
        Level("label_country_brand_offtake_", leaf, "offtake", timelag),
        Level("label_country_offtake_", (label, country), "offtake", timelag),
        Level("label_brand_offtake_", (label, brand), "offtake", timelag),
        Level("label_offtake_", (label,), "offtake", timelag),
        Level("country_offtake_", (country,), "offtake", timelag),
        Level("brand_offtake_", (brand,), "offtake", timelag),
        Level("label_country_brand_sellin_", leaf, "sellin", timelag),
        *[Level({"price": "label_country_brand_price_"}.get(price, f"{price}_"), (gran,), price, 3, "mean") for price in prices],
    ]


def supervised_table(
    facts: DataFrame,
    leaf: Sequence[str],
    month: str,
    target: str,
    levels: Sequence[Level],
    max_horizon: int,
    origins: Sequence[int] | None = None,
    one_hot: tuple[str, Sequence[str]] | None = None,
    all_keys: Sequence[str] = (),
) -> DataFrame:
    """Lag features of all levels, seasonality, target and one-hot labels.

    Facts are summed to the finest grain and month first and stored; every level
    is built from those sums, a mean from sum and count. Coarser levels are stored as one
    row a key, finest first, so the planner knows their size: small ones are broadcast
    and the widening rows are shuffled only for a level that is large itself.
    """
    values = sorted({target, *[level.value for level in levels]})
    grain = list(dict.fromkeys([*leaf, *all_keys]))
    sums = (
        facts.dropna(subset=grain)
        .groupBy(*grain, month)
        .agg(*[F.sum(v).alias(f"_s_{v}") for v in values], *[F.count(v).alias(f"_n_{v}") for v in values])
    )
    base = written(sums, "series") if len({level.keys for level in levels}) > 1 else sums
    axis = month_axis(base, month)

    def expr(level: Level) -> Column:
        total = F.sum(f"_s_{level.value}")
        return total if level.how == "sum" else F.try_divide(total, F.sum(f"_n_{level.value}"))

    by_keys: dict[tuple[str, ...], list[Level]] = {tuple(grain): []}
    for level in levels:
        by_keys.setdefault(level.keys, []).append(level)

    own = {level.prefix: expr(level) for level in by_keys[tuple(grain)]}
    series = dense_series(base, grain, month, {"_target": F.sum(f"_s_{target}"), **own}, axis)
    for keys, group in sorted(by_keys.items(), key=lambda item: -len(item[0])):
        if keys == tuple(grain):
            continue
        other = dense_series(base, list(keys), month, {level.prefix: expr(level) for level in group}, axis).drop("months")
        series = series.join(written(other, "level"), list(keys), "left")

    prefixes = [level.prefix for level in levels]
    grid = with_targets(with_origins(series, [*grain, "months", "_target", *prefixes], origins), max_horizon)
    lags = [column for level in levels for column in lag_columns(level.prefix, level.prefix, level.timelag)]
    part, sine, cosine = season_terms("date_to_predict")
    placed = grid.select("*", idx_to_ym("dtp_idx").alias("date_to_predict"))
    hot = []
    if one_hot:
        column, labels = one_hot
        hot = [F.when(F.col(column) == value, 1).otherwise(0).alias(value) for value in labels]
    return placed.select(
        *grain,
        idx_to_ym("dwp_idx").alias("date_when_predicting"),
        "date_to_predict",
        "horizon",
        *lags,
        part.alias("month"),
        sine.alias("sin_month"),
        cosine.alias("cos_month"),
        target_at("_target", "dtp_idx").alias("target"),
        *hot,
    )


def neighbour_forecasts(
    forecasts: DataFrame, keys: Sequence[str], cycle: str, month: str, value: str, delta: int = 3, cycle_shift: int = 0
) -> DataFrame:
    """A forecast with those for neighbouring months of the same cycle.

    ``{value}_-i`` belongs to the month i later, ``{value}_i`` to the month i
    earlier. A window range on the month index takes the place of self joins.
    """
    summed = forecasts.groupBy(*keys, (F.col(cycle) - cycle_shift).alias(cycle), month).agg(F.sum(value).alias(value))
    w = Window.partitionBy(*keys, cycle).orderBy(month)
    offsets = [*range(-delta, 0), *range(1, delta + 1)]
    return summed.select(
        *keys, cycle, month, value, *[F.first(value).over(w.rangeBetween(-i, -i)).alias(f"{value}_{i}") for i in offsets]
    )


def category_features(df: DataFrame, month: str, columns: Sequence[str], targets: DataFrame) -> DataFrame:
    """Distinct category and population values per target month."""
    return df.join(targets, month, "left_semi").select(month, *columns).distinct()


def di_table(
    sales: DataFrame, leaf: Sequence[str], sku: str, label: str, month: str, plan: DataFrame, planner: DataFrame,
    plan_keys: Sequence[str], max_horizon: int, origins: Sequence[int] | None = None,
) -> DataFrame:
    """DI table: package and SKU lags with the sell-in plan and the planners' forecast around the target."""
    base = supervised_table(sales, leaf, month, "offtake", di_levels(leaf, sku, label), max_horizon, origins)

    def around(df: DataFrame, value: str, delta: int, shift: int) -> DataFrame:
        near = neighbour_forecasts(df, plan_keys, "cycle", "m", value, delta, shift)
        return near.withColumn("date_when_predicting", idx_to_ym("cycle")).withColumn("date_to_predict", idx_to_ym("m")).drop("cycle", "m")

    keys = [*plan_keys, "date_when_predicting", "date_to_predict"]
    with_plan = base.join(around(plan, "forecast", 5, 3), keys, "left")
    return with_plan.join(around(planner, "forecast_eln", 3, 2), keys, "left")


def brand_table(
    facts: DataFrame, label: str, country: str, brand: str, month: str, max_horizon: int, labels: Sequence[str],
    category: DataFrame | None = None, timelag: int = 12, origins: Sequence[int] | None = None, prices: Sequence[str] = (),
) -> DataFrame:
    """Brand table: facts at (month, label, country, brand), lag groups, one-hot labels, category inner join."""
    gran = facts.withColumn("country_brand", F.concat_ws("_", country, brand))
    leaf = [label, country, brand, "country_brand"]
    table = supervised_table(
        gran, leaf, month, "offtake", brand_levels(label, country, brand, "country_brand", prices, timelag), max_horizon,
        origins, (label, labels),
    )
    return table if category is None else table.join(category, "date_to_predict", "inner")


def six_month_table(table: DataFrame, label: str, last_target: int | None = None, horizon: int = 10, lags: int = 11) -> DataFrame:
    """Per origin the six-month target total with mean label lags and their last six months."""
    rows = table.filter(F.col("horizon") == horizon)
    if last_target is not None:
        rows = rows.filter(F.col("date_to_predict") <= last_target)
    means = ["month", "sin_month", "cos_month", *[f"label_sales{i}" for i in range(1, lags + 1)]]
    grouped = rows.groupBy(label, "date_when_predicting", "date_to_predict").agg(
        F.avg("horizon").alias("horizon"), F.sum("target_r6m").alias("target_r6m"), *[F.avg(c).alias(c) for c in means]
    )
    return grouped.withColumn("last_6_months", sum((F.col(f"label_sales{i}") for i in range(2, 7)), F.col("label_sales1")))
