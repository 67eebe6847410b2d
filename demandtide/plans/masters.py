"""Raw masters: one row per product and month out of many long sources.

Sources with the grain of the master are stacked and grouped once, which equals
a chain of full outer joins with a single shuffle. Attribute sources are joined
after that, on the already small panel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.functions.cleaning import coalesce_zero, map_values
from demandtide.functions.periods import make_month, month_idx
from demandtide.operators.aggregating import group_sum, pivot_fill
from demandtide.operators.joining import join_many_to_one, outer_panels

# Types carried by channel rows and by total rows of a trade flow, missing marker of availability.
CHANNEL_TYPES = ("offtake", "sellout")
TOTAL_TYPES = ("sellin", "retailer_inv", "sp_inv")
MISSING_AVAILABILITY = -1.0
TOTAL_CHANNEL = "Total"


def repair_status(df: DataFrame, bad: str = "7/1/2019", status: str = "actual", produced: str = "2019-07-01") -> DataFrame:
    """Rows that carry a date in their status get that date as produced date and a proper status."""
    wrong = F.col("status") == bad
    return df.withColumn("produced_date", F.when(wrong, F.lit(produced)).otherwise(F.col("produced_date"))).withColumn(
        "status", F.when(wrong, F.lit(status)).otherwise(F.col("status"))
    )


def rename_codes(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    return df.withColumn(column, map_values(column, names))


def tradeflow_pivot(df: DataFrame, keys: Sequence[str], channel: str = "channel", kind: str = "type", quantity: str = "quantity") -> DataFrame:
    """Channel rows give offtake and sell-out, total rows give sell-in and stocks, in one pass."""
    of_total = F.col(channel) == TOTAL_CHANNEL

    def total(name: str, rows) -> F.Column:
        return coalesce_zero(F.sum(F.when(rows & (F.col(kind) == name), F.col(quantity)))).alias(name)

    return (
        df.filter((of_total & F.col(kind).isin(*TOTAL_TYPES)) | (~of_total & F.col(kind).isin(*CHANNEL_TYPES)))
        .groupBy(*keys)
        .agg(*[total(n, ~of_total) for n in CHANNEL_TYPES], *[total(n, of_total) for n in TOTAL_TYPES])
    )


def scope_pivot_mean(
    df: DataFrame, keys: Sequence[str], scope: str, scopes: Sequence[str], value: str, prefix: str, count: str | None = None,
    also: Sequence[Column] = (),
) -> DataFrame:
    """Scopes side by side, the mean over repeated rows of a scope, zero where it has none.

    With ``count`` the rows are sums already and that column holds how many values each one sums; other aggregates of the
    same keys (``also``) are then taken in the same pass.
    """
    if count is not None:
        of = {s: F.col(scope) == s for s in scopes}
        means = {s: F.try_divide(F.sum(F.when(rows, F.col(value))), F.sum(F.when(rows, F.col(count)))) for s, rows in of.items()}
        return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[coalesce_zero(mean).alias(f"{prefix}_{s.lower()}") for s, mean in means.items()], *also)
    wide = pivot_fill(df, keys, scope, scopes, value, "avg")
    return wide.select(*keys, *[F.col(s).alias(f"{prefix}_{s.lower()}") for s in scopes])


def availability_pivot(df: DataFrame, keys: Sequence[str], kind: str, kinds: Sequence[str], value: str) -> DataFrame:
    """Mean availability per kind, the missing marker where there is none."""
    wide = pivot_fill(df, keys, kind, kinds, value, "avg", fill=MISSING_AVAILABILITY)
    return wide.select(*keys, *[F.col(k).alias(k.lower()) for k in kinds])


def availability_means(df: DataFrame, keys: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """``availability_pivot`` over rows that hold a sum and a count column per kind."""
    means = {k: F.try_divide(F.sum(k), F.sum(n)) for k, n in kinds.items()}
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.coalesce(mean, F.lit(MISSING_AVAILABILITY)).alias(k) for k, mean in means.items()])


def market_pivot(df: DataFrame, month: str, scope: str, kept: str, measures: Mapping[str, str], since: int) -> DataFrame:
    """Monthly market totals of one scope since a month."""
    rows = df.filter((F.col(month) >= since) & (F.col(scope) == kept))
    return rows.groupBy(month).agg(*[F.sum(c).alias(name) for c, name in measures.items()])


def with_month(df: DataFrame, year: str, month: str, out: str = "m") -> DataFrame:
    return df.withColumn(out, month_idx(make_month(year, month))).drop(year, month)


def raw_master_il(
    panels: Sequence[DataFrame],
    keys: Sequence[str],
    attributes: DataFrame,
    availability: DataFrame,
    availability_keys: Sequence[str],
    prices: DataFrame | None,
    market: DataFrame,
    category: DataFrame,
    month: str = "m",
    selected: DataFrame | None = None,
) -> DataFrame:
    """IL master: stacked panels, product attributes, availability, price, market and category columns.

    Without ``prices`` the panels hold the price themselves.
    """
    stacked = outer_panels(panels, keys)
    sku = [k for k in keys if k != month]
    if selected is not None:
        stacked = stacked.join(selected, sku, "left_semi")
    known = join_many_to_one(stacked, attributes, sku, "inner")
    placed = join_many_to_one(known, availability, availability_keys)
    priced = placed if prices is None else join_many_to_one(placed, prices, [*sku, month])
    monthly = join_many_to_one(join_many_to_one(priced, market, [month]), category, [month])
    il = {
        f"{name}_il": coalesce_zero(f"{name}_di") + coalesce_zero(f"{name}_eib") for name in ("offtake", "sellin")
    }
    return monthly.withColumns(il)


def raw_master_dc(
    panels: Sequence[DataFrame], keys: Sequence[str], attributes: DataFrame, spending: DataFrame, stores: DataFrame,
    brand: str = "brand", month: str = "m",
) -> DataFrame:
    """DC master: stacked panels, brand spending and store distribution; rows with an offtake."""
    stacked = outer_panels(panels, keys).filter(F.col("offtake_dc").isNotNull())
    known = join_many_to_one(stacked, attributes, [k for k in keys if k != month], "inner")
    return join_many_to_one(join_many_to_one(known, spending, [month, brand]), stores, [month, brand])


def union_history(current: DataFrame, history: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Running system and older history of one flow, summed."""
    return group_sum(current.unionByName(history), keys, [value])


def sellout_mix(df: DataFrame, keys: Sequence[str], quantity: str, revenue: str, price: str, count: str | None = None) -> DataFrame:
    """Sums and the mean price; with ``count`` the rows are sums already, of as many prices as that column says."""
    mean = F.avg(price) if count is None else F.try_divide(F.sum(price), F.sum(count))
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        coalesce_zero(F.sum(quantity)).alias("sellout"),
        coalesce_zero(F.sum(revenue)).alias("sellout_revenue"),
        mean.alias("sellout_price"),
    )
