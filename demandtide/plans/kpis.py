"""Forecast accuracy KPIs, computed for all months, lags and scopes in one plan.

Input rows hold key columns, the target month index ``m``, the ``lag`` between
cycle and target, the ``cycle`` index, ``actual`` and ``forecast``. Errors are
taken per input row; everything after works on sums per key, lag and month, so
windows only ever see a handful of months.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandtide.functions.cleaning import ratio
from demandtide.functions.periods import idx_to_ym, year_start_idx
from demandtide.operators.reshaping import union_sources
from demandtide.session import written

# Weights of the horizons and of the four parts of the model score.
HORIZON_WEIGHTS = {"1": 0.2, "4": 0.6, "R6M": 0.2}
SCORE_WEIGHTS = {"brand_month": 0.21, "brand_ytd": 0.49, "total_ytd": 0.21, "total_month": 0.09}
MISSING_KPI = -99999.0

SUMS = ("err", "abs_err", "forecast")


def error_columns(df: DataFrame, mask_zero_actual: bool = False) -> DataFrame:
    """Error ``actual - forecast``; optionally none where nothing was sold."""
    err = F.col("actual") - F.col("forecast")
    if mask_zero_actual:
        err = F.when(F.col("actual") == 0, F.lit(0.0)).otherwise(err)
    return df.withColumn("err", err).withColumn("abs_err", F.abs("err"))


def at_level(df: DataFrame, keys: Sequence[str], level: Sequence[str]) -> DataFrame:
    """Sales and forecasts summed to a hierarchy level, before errors are taken."""
    return df.groupBy(*keys, *level).agg(F.sum("actual").alias("actual"), F.sum("forecast").alias("forecast"))


def levels_rollup(df: DataFrame, keys: Sequence[str], hierarchy: Sequence[str]) -> DataFrame:
    """Sums at every prefix of the hierarchy, told apart by ``level_id``.

    A level is summed from the one below it, never from the rows again. The id
    is that of SQL grouping: one bit per column summed away.
    """
    names = ("actual", "forecast")
    level = at_level(df, keys, hierarchy)
    out = []
    for depth in range(len(hierarchy), 0, -1):
        if depth < len(hierarchy):
            level = at_level(level, keys, hierarchy[:depth])
        gone = [F.lit(None).cast("string").alias(c) for c in hierarchy[depth:]]
        bits = F.lit(2 ** (len(hierarchy) - depth) - 1).alias("level_id")
        out.append(level.select(*keys, *hierarchy[:depth], *gone, *names, bits))
    return union_sources(out)


def levels_computed_on(df: DataFrame, keys: Sequence[str], country: str, brand: str, sums: Sequence[str]) -> DataFrame:
    """Leaf sums carried to all, country, brand and country with brand."""
    lowest = df.groupBy(*keys, country, brand).agg(*[F.sum(c).alias(c) for c in sums])
    fixed = [F.col(c) for c in keys]
    c, b = F.col(country), F.col(brand)
    sets = [fixed, [*fixed, c], [*fixed, b], [*fixed, c, b]]
    level = (
        F.when((F.grouping(country) == 0) & (F.grouping(brand) == 0), "country_brand")
        .when(F.grouping(country) == 0, "country")
        .when(F.grouping(brand) == 0, "brand")
        .otherwise("all")
    )
    return lowest.groupingSets(sets, *fixed, c, b).agg(*[F.sum(s).alias(s) for s in sums], level.alias("computed_on"))


def bias_of(err: Column | str = "err", forecast: Column | str = "forecast") -> Column:
    return ratio(err, forecast)


def accuracy_of(abs_err: Column | str = "abs_err", forecast: Column | str = "forecast") -> Column:
    share = ratio(abs_err, forecast)
    return F.when(share.isNotNull(), F.greatest(F.lit(0.0), 1.0 - share))


def monthly_sums(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    return errors.groupBy(*keys, "lag", "m").agg(*[F.sum(c).alias(c) for c in SUMS])


def year_to_date(sums: DataFrame, keys: Sequence[str], columns: Sequence[str], first: Column | int | None = None) -> DataFrame:
    """Running sums since January, or since ``first``; null from the first missing month on."""
    if first is None:
        start = year_start_idx("m")
        spans = sums.withColumn("_start", start)
        w = Window.partitionBy(*keys, "_start").orderBy("m")
    else:
        start = F.lit(first) if isinstance(first, int) else first
        spans = sums.filter(F.col("m") >= start).withColumn("_start", start)
        w = Window.partitionBy(*keys).orderBy("m")
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = F.count(F.lit(1)).over(w) == F.col("m") - F.col("_start") + 1
    return spans.select(*keys, "m", *[F.when(whole, F.sum(c).over(w)).alias(c) for c in columns])


def bias(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    return monthly_sums(errors, keys).select(*keys, "lag", "m", bias_of().alias("bias"))


def accuracy(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    return monthly_sums(errors, keys).select(*keys, "lag", "m", accuracy_of().alias("fa"))


def ytd_bias(errors: DataFrame, keys: Sequence[str], first: Column | int | None = None) -> DataFrame:
    run = year_to_date(monthly_sums(errors, keys), [*keys, "lag"], SUMS, first)
    return run.select(*keys, "lag", "m", bias_of().alias("ytd_bias"))


def ytd_accuracy(errors: DataFrame, keys: Sequence[str], first: Column | int | None = None) -> DataFrame:
    run = year_to_date(monthly_sums(errors, keys), [*keys, "lag"], SUMS, first)
    return run.select(*keys, "lag", "m", accuracy_of().alias("ytd_fa"))


def rolling_sums(sums: DataFrame, keys: Sequence[str], r: int, k: int) -> DataFrame:
    """Per cycle the sums over lags k to k+r-1, kept only when all r months are there.

    The result month is the last one covered.
    """
    covered = sums.filter(F.col("lag").between(k, k + r - 1)).withColumn("_cycle", F.col("m") - F.col("lag"))
    rolled = covered.groupBy(*keys, "_cycle").agg(
        F.sum("err").alias("err"), F.sum("forecast").alias("forecast"), F.count_distinct("lag").alias("_n")
    )
    return rolled.filter(F.col("_n") == r).select(
        *keys, (F.col("_cycle") + (r - 1 + k)).cast("int").alias("m"), "err", "forecast"
    )


def rolling_bias(errors: DataFrame, keys: Sequence[str], r: int, k: int) -> DataFrame:
    return rolling_sums(monthly_sums(errors, keys), keys, r, k).select(*keys, "m", bias_of().alias("rolling_bias"))


def ytd_rolling_sums(rolled: DataFrame, keys: Sequence[str], absolute: bool = True, first: Column | int | None = None) -> DataFrame:
    err = F.abs("err") if absolute else F.col("err")
    return year_to_date(rolled.withColumn("err", err), keys, ("err", "forecast"), first)


def ytd_rolling_bias(
    errors: DataFrame, keys: Sequence[str], r: int, k: int, absolute: bool = True, first: Column | int | None = None
) -> DataFrame:
    """Running sum of the (absolute) rolling errors over that of the forecasts."""
    rolled = rolling_sums(monthly_sums(errors, keys), keys, r, k)
    run = ytd_rolling_sums(rolled, keys, absolute, first)
    return run.select(*keys, "m", bias_of().alias("ytd_rolling_bias"))


def kpi_table(leafs: DataFrame, label: str, country: str, brand: str, horizons: Sequence[int] = (1, 4), r: int = 6, k: int = 3) -> DataFrame:
    """All KPIs in percent, over every level, horizon and month, in long form."""
    errors = error_columns(leafs, mask_zero_actual=True)
    # Five branches read the sums, so they are stored once.
    sums = written(levels_computed_on(errors, [label, "lag", "m"], country, brand, SUMS), "kpi-sums")
    keys = ["computed_on", country, brand, label]

    def long(df: DataFrame, horizon: Column, kind: str, values: dict[str, Column]) -> DataFrame:
        entries = F.array(
            *[F.struct(F.lit(name).alias("kpi_name"), (100.0 * value).alias("value")) for name, value in values.items()]
        )
        return df.select(
            *keys, horizon.alias("horizon"), F.lit(kind).alias("kpi_type"), "m", F.explode(entries).alias("e")
        ).select(*keys, "horizon", "kpi_type", "m", "e.*")

    both = {"bias": bias_of(), "fa": accuracy_of()}
    fixed = sums.filter(F.col("lag").isin(*horizons))
    rolled = rolling_sums(sums, keys, r, k)
    name = f"R{r}M"
    parts = [
        long(fixed, F.col("lag").cast("string"), "month", both),
        long(year_to_date(fixed, [*keys, "lag"], SUMS), F.col("lag").cast("string"), "ytd", both),
        long(rolled, F.lit(name), "month", {"bias": bias_of()}),
        long(ytd_rolling_sums(rolled, keys), F.lit(name), "ytd", {"bias": bias_of()}),
    ]
    return union_sources(parts)


def kpi_report(
    cycles: DataFrame, scope: str, scopes: Sequence[str], max_horizon: int = 11, r: int = 6, k: int = 3,
    by: Sequence[str] = (), umbrella: Mapping[str, str] | None = None,
) -> DataFrame:
    """Grid of months, horizons and scopes with five KPIs; a KPI that cannot be had is -99999.

    ``by`` names further keys, such as the measure, each value of which has a grid of
    its own. ``umbrella`` gives the umbrella brand of a scope (null for one it lacks)
    and adds a column of this name.
    """
    keys = [*by, scope]
    errors = error_columns(cycles, mask_zero_actual=True)
    sums = written(monthly_sums(errors, keys), "kpi-sums")
    first_cycle = sums.groupBy(*keys).agg(F.min(F.col("m") - F.col("lag")).alias("_first_cycle"))
    begun = sums.join(first_cycle, keys)
    start = F.greatest(F.col("_first_cycle") + F.col("lag"), year_start_idx("m"))
    w = Window.partitionBy(*keys, "lag", year_start_idx("m")).orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.count(F.lit(1)).over(w) == F.col("m") - start + 1
    run = {c: F.when(whole, F.sum(c).over(w)) for c in SUMS}
    point = begun.select(
        *keys,
        F.col("lag").alias("prediction_horizon"),
        "m",
        accuracy_of(run["abs_err"], run["forecast"]).alias("fa_ytd"),
        bias_of(run["err"], run["forecast"]).alias("bias_ytd"),
        accuracy_of().alias("fa_monthly"),
        bias_of().alias("bias_monthly"),
    )
    rolled = ytd_rolling_sums(rolling_sums(sums, keys, r, k), keys).select(*keys, "m", bias_of().alias("R6M"))
    grid = (
        sums.select(*by, "m")
        .distinct()
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(max_horizon))).alias("prediction_horizon"))
        .select("*", F.explode(F.array(*[F.lit(s) for s in scopes])).alias(scope))
    )
    wide = grid.join(point, [*keys, "prediction_horizon", "m"], "left").join(rolled, [*keys, "m"], "left")
    kinds = ("R6M", "fa_ytd", "bias_ytd", "fa_monthly", "bias_monthly")
    entries = F.array(
        *[F.struct(F.lit(n).alias("kpi_type"), F.coalesce(F.col(n), F.lit(MISSING_KPI)).alias("value")) for n in kinds]
    )
    above = []
    if umbrella is not None:
        names = F.create_map(*[F.lit(x) for pair in umbrella.items() for x in pair])
        above = [F.try_element_at(names, F.col(scope)).alias("umbrella")]
    return wide.select(
        *above, *keys, (F.col("m") - F.col("prediction_horizon")).alias("cycle"), "prediction_horizon", F.explode(entries).alias("e")
    ).select(*(["umbrella"] if above else []), *keys, idx_to_ym("cycle").alias("cyc_dat"), "prediction_horizon", "e.kpi_type", "e.value")


def kpi_input(actuals: DataFrame, forecasts: DataFrame, keys: Sequence[str], month: str, cycle: str, measures: Sequence[str]) -> DataFrame:
    """Actuals beside forecasts per key, month and measure, channels summed, up to the last actual month.

    Rows that repeat as a whole count once. Both frames are dealt by key and month once:
    dropping repeats, summing and joining then need no further shuffle, and measures become
    rows after the join.
    """
    last = actuals.agg(F.max(month).alias("last")).scalar()

    def summed(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
        dealt = df.repartition(*[F.col(c) for c in (*keys, month)]).distinct()
        return dealt.groupBy(*by).agg(*[F.sum(c).alias(f"{name}_{c}") for c in measures])

    known = summed(actuals, [*keys, month], "actual")
    made = summed(forecasts.filter(F.col(month) <= last), [*keys, month, cycle], "forecast")
    both = known.join(made, [*keys, month], "inner")
    return both.select(*keys, month, cycle, measure_rows(measures)).select(*keys, month, cycle, "e.*")


def measure_rows(measures: Sequence[str], factor: Column | None = None) -> Column:
    """One struct (variable, actual, forecast) per measure as rows ``e``."""
    made = {c: F.col(f"forecast_{c}") if factor is None else F.col(f"forecast_{c}") * factor for c in measures}
    return F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"actual_{c}").alias("actual"), made[c].alias("forecast")) for c in measures])).alias("e")


def lagged_input(
    actuals: DataFrame, keys: Sequence[str], month: str, measures: Sequence[str], lags: Sequence[int], grown: Callable[[Column], Column], back: int = 12
) -> DataFrame:
    """``kpi_input`` where the forecast is the month ``back`` before, times ``grown`` of the lag: key, month, cycle, lag, variable, actual, forecast.

    Repeated rows count once. A month is paired with the earlier one by stacking it under
    both months and summing: one shuffle of the panel. Lags and measures multiply the
    rows last, right before whatever sums them, so no shuffle carries them. Months without an earlier
    one, and after the last actual one, have no row; null keys and months pair with nothing.
    """
    empty = {c: F.lit(None).cast("double").alias(c) for c in (f"{side}_{c}" for side in ("actual", "forecast") for c in measures)}

    def as_of(side: str, shift: int) -> Column:
        filled = empty | {f"{side}_{c}": F.col(c).cast("double").alias(f"{side}_{c}") for c in measures}
        return F.struct((F.col(month) + shift).alias(month), F.lit(1 if side == "actual" else 0).alias("_a"), F.lit(0 if side == "actual" else 1).alias("_b"), *filled.values())

    stacked = actuals.dropna(subset=[*keys, month]).distinct().select(*keys, F.explode(F.array(as_of("actual", 0), as_of("forecast", back))).alias("s")).select(*keys, "s.*")
    paired = stacked.groupBy(*keys, month).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"), *[F.sum(c).alias(c) for c in empty]).filter("_a = 1 AND _b = 1").drop("_a", "_b")
    lagged = paired.withColumn("lag", F.explode(F.array(*[F.lit(x) for x in lags])))
    return lagged.select(*keys, month, (F.col(month) - F.col("lag")).alias("cycle"), "lag", measure_rows(measures, grown(F.col("lag")))).select(*keys, month, "cycle", "lag", "e.*")


def model_score(
    table: DataFrame, shares: DataFrame, label: str, country: str, brand: str, first: int, last: int, without: Sequence[int] = ()
) -> DataFrame:
    """Weighted bias score per scope from the KPI table over the months ``first`` to ``last``, ``without`` the given ones.

    ``shares`` gives the weight of each country with brand. Year-to-date values
    are read in the last month.
    """
    weights = F.create_map(*[F.lit(x) for pair in HORIZON_WEIGHTS.items() for x in pair])
    rows = (
        table.filter((F.col("kpi_name") == "bias") & F.col("m").between(first, last) & ~F.col("m").isin(*without) & F.col("value").isNotNull())
        .filter(F.col("computed_on").isin("all", "country_brand"))
        .withColumn("weight", weights[F.col("horizon")])
    )
    series = [label, "computed_on", country, brand, "horizon", "weight"]
    n_months = rows.filter("kpi_type = 'month'").groupBy(label, "computed_on").agg(F.count_distinct("m").alias("_n"))
    points = rows.groupBy(*series).agg(
        F.sum(F.when(F.col("kpi_type") == "month", F.col("value") * F.col("value"))).alias("_sq"),
        F.max(F.when((F.col("kpi_type") == "ytd") & (F.col("m") == last), F.abs("value"))).alias("_ytd"),
    )
    placed = points.join(n_months, [label, "computed_on"]).join(shares, [country, brand], "left")
    is_all = F.col("computed_on") == "all"
    scale = F.when(is_all, F.col("weight")).otherwise(F.col("weight") * F.col("share") * 10)
    spread = F.sqrt(F.col("_sq") / F.col("_n")) * scale
    to_date = F.col("_ytd") * scale
    parts = placed.groupBy(label).agg(
        F.sum(F.when(~is_all, spread)).alias("brand_month"),
        F.sum(F.when(~is_all, to_date)).alias("brand_ytd"),
        F.sum(F.when(is_all, to_date)).alias("total_ytd"),
        F.sum(F.when(is_all, spread)).alias("total_month"),
    )
    total = sum((F.lit(w) * F.col(n) for n, w in SCORE_WEIGHTS.items()), F.lit(0.0))
    return parts.withColumn("score", total)
