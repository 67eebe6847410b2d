"""Dense monthly series and the features read from them.

A series is one row per key holding an array aligned with the sorted array of
all months in the data. Months missing for a key count as zero. Arrays are
bounded by the calendar, and the two aggregations behind them (per key and
month, then per key) both combine before their shuffle. Lags and targets are
array look-ups, so no lag needs a join, a sort or a self union.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandtide.functions.periods import idx_to_ym, season_terms


def month_axis(df: DataFrame, month: str) -> Column:
    """All distinct months as one sorted array, as a scalar subquery."""
    return df.select(month).dropna().agg(F.sort_array(F.collect_set(month)).alias("months")).scalar()


def dense_series(
    df: DataFrame, keys: Sequence[str], month: str, values: Mapping[str, Column], axis: Column | None = None
) -> DataFrame:
    """Per key the arrays named in ``values``, one entry per month of the axis.

    Give ``axis`` where ``df`` is itself an aggregate: the months can then be read
    off one column of its source.
    """
    names = list(values)
    monthly = df.dropna(subset=[*keys, month]).groupBy(*keys, month).agg(*[values[n].alias(n) for n in names])
    entry = F.struct(F.col(month).alias("m"), *[F.col(n) for n in names])
    packed = monthly.groupBy(*keys).agg(F.collect_list(entry).alias("_e"))
    by_month = packed.select(
        *keys, F.map_from_entries(F.transform("_e", lambda e: F.struct(e["m"], e))).alias("_by")
    ).withColumn("months", month_axis(df, month) if axis is None else axis)
    dense = by_month.withColumn("_at", F.transform("months", lambda m: F.try_element_at("_by", m)))

    def field(name: str) -> Column:
        return F.transform("_at", lambda entry: F.coalesce(entry[name].cast("double"), F.lit(0.0))).alias(name)

    arrays = [field(n) for n in names]
    return dense.select(*keys, "months", *arrays)


def at(series: str, position: Column) -> Column:
    """Entry at a zero-based position, zero outside the axis."""
    return F.coalesce(F.get(series, position), F.lit(0.0))


def lag_columns(series: str, prefix: str, timelag: int, position: str = "_pos") -> list[Column]:
    """Columns ``{prefix}sales1`` (the origin month) to ``{prefix}sales{timelag}``."""
    return [at(series, F.col(position) - (n - 1)).alias(f"{prefix}sales{n}") for n in range(1, timelag + 1)]


def with_origins(series: DataFrame, keep: Sequence[str], origins: Sequence[int] | None = None) -> DataFrame:
    """One row per key and origin. Without a list, every month of the axis is an origin.

    A listed origin (month index) takes the last month of the axis not after it.
    """
    if origins is None:
        return series.select(*keep, F.posexplode("months").alias("_pos", "dwp_idx"))
    wanted = F.explode(F.array(*[F.lit(o) for o in origins])).alias("dwp_idx")
    placed = series.select(*keep, wanted)
    return placed.withColumn("_pos", F.size(F.filter("months", lambda m: m <= F.col("dwp_idx"))) - 1)


def with_targets(df: DataFrame, max_horizon: int) -> DataFrame:
    """One row per horizon 1 to ``max_horizon``."""
    out = df.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(max_horizon))))
    return out.withColumn("dtp_idx", F.col("dwp_idx") + F.col("horizon"))


def target_at(series: str, month: str, months: str = "months") -> Column:
    """Value of the series in a month, null when the axis does not hold it."""
    place = F.array_position(F.col(months), F.col(month)).cast("int")
    return F.when(place > 0, F.get(series, place - 1))


def lag_matrix(
    df: DataFrame,
    keys: Sequence[str],
    month: str,
    value: str,
    prefix: str = "",
    timelag: int = 12,
    origins: Sequence[int] | None = None,
    how: str = "sum",
) -> DataFrame:
    """Last ``timelag`` months before and at each origin, per key."""
    fn = {"sum": F.sum, "mean": F.avg}[how]
    series = dense_series(df, keys, month, {"_v": fn(value)})
    placed = with_origins(series, [*keys, "months", "_v"], origins)
    return placed.select(
        *keys, idx_to_ym("dwp_idx").alias("date_when_predicting"), *lag_columns("_v", prefix, timelag)
    )


def target_join(df: DataFrame, keys: Sequence[str], month: str, value: str, max_horizon: int) -> DataFrame:
    """Ground truth per key, origin and target month that the data holds."""
    series = dense_series(df, keys, month, {"_v": F.sum(value)})
    grid = with_targets(with_origins(series, [*keys, "months", "_v"]), max_horizon)
    placed = grid.withColumn("target", target_at("_v", "dtp_idx")).filter(F.col("target").isNotNull())
    return placed.select(
        *keys, idx_to_ym("dwp_idx").alias("date_when_predicting"), idx_to_ym("dtp_idx").alias("date_to_predict"), "target"
    )


def target_window(df: DataFrame, keys: Sequence[str], month: str, value: str, first: int = 5, last: int = 10) -> DataFrame:
    """Sum of the months ``first`` to ``last`` after each origin, with the last one as target month.

    Origins whose whole window lies past the data have no row.
    """
    series = dense_series(df, keys, month, {"_v": F.sum(value)})
    placed = with_origins(series, [*keys, "_v"]).withColumn("_v", F.get("_v", F.col("_pos")))
    # The rows are already partitioned by key, so the window adds a sort and no shuffle.
    w = Window.partitionBy(*keys).orderBy("dwp_idx").rangeBetween(first, last)
    summed = placed.select(*keys, "dwp_idx", F.sum("_v").over(w).alias("target_r6m"))
    return summed.filter(F.col("target_r6m").isNotNull()).select(
        *keys,
        idx_to_ym("dwp_idx").alias("date_when_predicting"),
        idx_to_ym(F.col("dwp_idx") + last).alias("date_to_predict"),
        "target_r6m",
    )


def seasonality(df: DataFrame, ym: str) -> DataFrame:
    part, sine, cosine = season_terms(ym)
    return df.select(ym).distinct().select(ym, part.alias("month"), sine.alias("sin_month"), cosine.alias("cos_month"))
