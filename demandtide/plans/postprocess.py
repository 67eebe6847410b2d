"""Forecast post-processing: trend extension, seasonal correction, scope reconciliation.

Forecast rows are long: key columns, ``label``, target month index ``m``,
``horizon`` and ``prediction``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandtide.functions.cleaning import coalesce_zero, ratio
from demandtide.functions.periods import idx_month, idx_year, lunar_month
from demandtide.operators.reshaping import label_pivot

# Weights of earlier years in the target ratio, years back to weight.
YEAR_WEIGHTS = {1: 0.8, 2: 0.2}
NOVEMBER_WEIGHTS = {1: 0.4, 2: 0.3, 3: 0.2, 4: 0.1}
LUNAR = "CNY"
VERY_SMALL = 1e-6


def extend_forecast(
    forecast: DataFrame, actual: DataFrame, month: str, columns: Sequence[str], ratio_column: str, actual_column: str, years: int = 1
) -> DataFrame:
    """Append ``years`` more years, each scaled again by forecast total over last year's same months."""
    future = forecast.filter(F.col("horizon") >= 1)
    # One row, read once: the same scalar subquery serves all three values.
    span = future.agg(
        F.struct(F.min(month).alias("first"), F.max(month).alias("last"), F.sum(ratio_column).alias("total")).alias("span")
    ).scalar()
    total = span["total"]
    past = actual.filter(F.col(month).between(span["first"] - 12, span["last"] - 12)).agg(F.sum(actual_column).alias("past")).scalar()
    stretched = future.withColumns({"_n": F.explode(F.sequence(F.lit(1), F.lit(years)))}).withColumn("_r", ratio(total, past))
    shifted = stretched.withColumns(
        {c: F.col(c) * F.pow("_r", "_n") for c in columns}
        | {month: (F.col(month) + 12 * F.col("_n")).cast("int"), "horizon": (F.col("horizon") + 12 * F.col("_n")).cast("int")}
    )
    return forecast.unionByName(shifted.select(*forecast.columns))


def seasonal_ratio(sales: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """A month's total over the totals of its two calendar neighbours; null where those are zero."""
    totals = sales.groupBy(*keys, month).agg(F.sum(value).alias(value))
    w = Window.partitionBy(*keys).orderBy(month)
    beside = coalesce_zero(F.first(value).over(w.rangeBetween(-1, -1))) + coalesce_zero(F.first(value).over(w.rangeBetween(1, 1)))
    return totals.select(*keys, month, value, ratio(value, beside).alias("season_ratio"))


def correction_factors(
    sales: DataFrame, forecast: DataFrame, keys: Sequence[str], month: str, sold: str, months: Sequence, threshold: float
) -> DataFrame:
    """Factor per key and month out of earlier years' ratios; one where the gap is within the threshold.

    All listed months are corrected from the original values at once. The last
    forecast month is left alone; the first one borrows the last month sold.
    """
    known = seasonal_ratio(sales, keys, month, sold)
    span = forecast.agg(F.struct(F.min(month).alias("first"), F.max(month).alias("last")).alias("span")).scalar()
    first, last = span["first"], span["last"]
    borrowed = sales.filter(F.col(month) == first - 1).select(*keys, month, F.col(sold).alias("prediction"))
    made = seasonal_ratio(
        forecast.select(*keys, month, "prediction").unionByName(borrowed), keys, month, "prediction"
    ).filter(F.col(month) >= first)

    def reference(years_back: int, lunar: bool) -> Column:
        year = idx_year(month) - years_back
        return year * 12 + lunar_month(year) if lunar else F.col(month) - 12 * years_back

    wanted = []
    for rule in months:
        lunar = rule == LUNAR
        weights = NOVEMBER_WEIGHTS if rule == 11 else YEAR_WEIGHTS
        hit = idx_month(month) == (lunar_month(idx_year(month)) if lunar else F.lit(rule))
        refs = F.array(*[F.struct(reference(y, lunar).cast("int").alias("ref"), F.lit(w).alias("weight")) for y, w in weights.items()])
        wanted.append(F.when(hit, refs))
    refs = F.coalesce(*wanted)
    asked = made.filter((F.col(month) != last) & refs.isNotNull()).select(
        *keys, month, F.col("season_ratio").alias("_made"), F.size(refs).alias("_n"), F.explode(refs).alias("_e")
    )
    earlier = known.select(*keys, F.col(month).alias("_ref"), F.col("season_ratio").alias("_known"))
    joined = asked.select(*keys, month, "_made", "_n", F.col("_e.ref").alias("_ref"), F.col("_e.weight").alias("_weight")).join(
        earlier, [*keys, "_ref"]
    )
    targets = joined.groupBy(*keys, month, "_made", "_n").agg(
        F.sum(F.col("_weight") * F.col("_known")).alias("_target"), F.count("_known").alias("_held")
    )
    apart = (F.col("_held") == F.col("_n")) & (F.abs(F.col("_target") - F.col("_made")) > threshold)
    return targets.filter(apart).select(*keys, month, ratio("_target", "_made").alias("factor"))


def seasonal_correction(
    sales: DataFrame, forecast: DataFrame, keys: Sequence[str], month: str, sold: str, months: Sequence = (LUNAR, 11), threshold: float = 0.05
) -> DataFrame:
    factors = correction_factors(sales, forecast, keys, month, sold, months, threshold)
    both = forecast.join(factors, [*keys, month], "left")
    return both.withColumn("prediction", F.col("prediction") * F.coalesce("factor", F.lit(1.0))).drop("factor")


def recompute_parent(forecast: DataFrame, keys: Sequence[str], children: tuple[str, str] = ("di", "eib"), parent: str = "il") -> DataFrame:
    """Parent rows as the sum of the two children, for every key of the first child."""
    first, second = children
    parts = forecast.filter(F.col("label").isin(*children))

    def of(label: str) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col("prediction")))

    sums = parts.groupBy(*keys).agg(of(first).alias("_a"), of(second).alias("_b")).filter(F.col("_a").isNotNull())
    rows = sums.select(*keys, F.lit(parent).alias("label"), (F.col("_a") + F.col("_b")).alias("prediction"))
    return parts.select(*rows.columns).unionByName(rows)


def zero_invalid(forecast: DataFrame, history: DataFrame, sku: str, value: str) -> DataFrame:
    """Predictions of products whose whole history in that scope is nothing become zero."""
    totals = history.groupBy("label", sku).agg(F.sum(value).alias("_sold"))
    both = forecast.join(totals, ["label", sku], "left")
    nothing = F.when(F.col("label") == "eib", F.col("_sold") == 0).otherwise(F.col("_sold") < VERY_SMALL)
    return both.withColumn("prediction", F.when(F.coalesce(nothing, F.lit(False)), 0.0).otherwise(F.col("prediction"))).drop("_sold")


def rescale_children(forecast: DataFrame, keys: Sequence[str], parent: str = "il") -> DataFrame:
    """Child predictions scaled so that they add up to the parent; unchanged where that cannot be done.

    A window partition holds the scopes of one key and month.
    """
    w = Window.partitionBy(*keys)
    is_parent = F.col("label") == parent
    top = F.sum(F.when(is_parent, F.col("prediction"))).over(w)
    below = F.sum(F.when(~is_parent, F.col("prediction"))).over(w)
    factor = F.when(is_parent, 1.0).otherwise(ratio(top, below, 1.0))
    return forecast.withColumn("ratio", factor).withColumn("prediction", F.col("prediction") * F.col("ratio"))


def rescale_residual(forecast: DataFrame, parent_totals: DataFrame, sku: str, month: str) -> DataFrame:
    """EIB scaled so that its total is the global IL less DI; IL becomes DI plus EIB per product."""
    cell = [month, "horizon"]

    def of(label: str) -> Column:
        return coalesce_zero(F.sum(F.when(F.col("label") == label, F.col("prediction"))))

    totals = forecast.groupBy(*cell).agg(of("di").alias("_di"), of("eib").alias("_eib"))
    wanted = totals.join(parent_totals.withColumnRenamed("prediction", "_il"), cell, "left")
    factors = wanted.select(*cell, ratio(coalesce_zero("_il") - F.col("_di"), "_eib", 1.0).alias("_factor"))
    # One row per target month and horizon, both bounded by the calendar.
    scaled = forecast.join(F.broadcast(factors), cell, "left")
    factor = F.when(F.col("label") == "eib", F.coalesce("_factor", F.lit(1.0))).otherwise(1.0)
    scaled = scaled.withColumn("ratio", factor).withColumn("prediction", F.col("prediction") * F.col("ratio")).drop("_factor")
    w = Window.partitionBy(sku, *cell)
    parts = coalesce_zero(F.sum(F.when(F.col("label") != "il", F.col("prediction"))).over(w))
    return scaled.withColumn("prediction", F.when(F.col("label") == "il", parts).otherwise(F.col("prediction")))


def rescale_six_months(forecast: DataFrame, six_months: DataFrame, month: str, first: int = 5, last: int = 10) -> DataFrame:
    """Horizons 5 to 10 scaled to a sixth of the six-month prediction of their origin."""
    cell = ["label", "dwp", "horizon", month]
    totals = forecast.groupBy(*cell).agg(F.sum("prediction").alias("_total"))
    span = F.col("horizon").between(first, last)
    months = last - first + 1
    factors = totals.join(six_months, ["label", "dwp"], "left").select(
        *cell, F.when(span, ratio(F.col("r6m_prediction") / months, "_total", 1.0)).otherwise(1.0).alias("ratio")
    )
    # One row per scope, origin, horizon and month, all bounded by the calendar.
    both = forecast.join(F.broadcast(factors), cell, "left")
    return both.withColumn("prediction", F.col("prediction") * F.coalesce("ratio", F.lit(1.0)))


def long_to_wide(forecast: DataFrame, actual: DataFrame, keys: Sequence[str], labels: Sequence[str], actual_keys: Sequence[str]) -> DataFrame:
    """Scopes side by side with their actual targets."""
    wide = label_pivot(forecast, keys, labels, "prediction", "yhat_{label}_calib")
    targets = actual.groupBy(*actual_keys).agg(*[F.sum(f"offtake_{x}").alias(f"target_{x}") for x in labels])
    return wide.join(targets, list(actual_keys), "left")


def switch_by_date(early: DataFrame, late: DataFrame, origin: str, last_early: int) -> DataFrame:
    """One model's rows up to an origin, another's after it."""
    return early.filter(F.col(origin) <= last_early).unionByName(late.filter(F.col(origin) > last_early))


def scope_modes(wide: DataFrame, mode: str) -> DataFrame:
    """``indep`` leaves the scopes, ``diff`` sets DI to IL less EIB, ``sum`` sets IL to EIB plus DI."""
    if mode == "indep":
        return wide
    if mode == "diff":
        return wide.withColumn("yhat_di_calib", F.greatest(F.col("yhat_il_calib") - F.col("yhat_eib_calib"), F.lit(0.0)))
    if mode == "sum":
        return wide.withColumn("yhat_il_calib", F.col("yhat_eib_calib") + F.col("yhat_di_calib"))
    raise ValueError(f"unknown scope mode {mode}")
