"""Window features on a panel of one row per (series, month).

Every ordered window is partitioned by the series key of an already aggregated
panel, so a partition holds at most one row per calendar month. Totals over a
month or a group are aggregates joined back, because a month can hold a large
part of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandtide.functions.cleaning import coalesce_zero, ratio
from demandtide.operators.joining import with_month_totals, with_totals


def _series(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def rolled_values(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """Trailing mean, min and max over k rows; nulls are skipped and an all-null window gives zero."""
    columns: list[Column] = []
    for k in sizes:
        w = _series(keys, order).rowsBetween(-(k - 1), 0)
        for fn, name in ((F.avg, "mean"), (F.min, "min"), (F.max, "max")):
            columns += [coalesce_zero(fn(v).over(w)).alias(f"{v}_{name}_{k}M") for v in values]
    return df.select("*", *columns)


def lagged_features(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """Lags per series; the missing head takes the next known lag of the same series."""
    w = _series(keys, order)
    ahead = w.rowsBetween(0, Window.unboundedFollowing)
    names = [(v, lag, f"{v}_lag{lag}") for v in values for lag in lags]
    lagged = df.select("*", *[F.lag(v, lag).over(w).alias(name) for v, lag, name in names])
    return lagged.select(*df.columns, *[F.first(name, ignorenulls=True).over(ahead).alias(name) for _, _, name in names])


def diff_features(
    df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], periods: Sequence[int], pct_change: bool = False
) -> DataFrame:
    """Absolute difference to p rows before, and its relative form ``(diff / x - 1) * 100``.

    With ``pct_change`` the relative form is the change on the earlier value instead.
    """
    w = _series(keys, order)
    columns = []
    for v in values:
        for p in periods:
            diff = F.col(v) - F.lag(v, p).over(w)
            relative = ratio(diff, F.lag(v, p).over(w)) if pct_change else ratio(diff, v) - 1.0
            columns += [diff.alias(f"abs_diff{p}_{v}"), (coalesce_zero(relative) * 100.0).alias(f"rel_diff{p}_{v}")]
    return df.select("*", *columns)


def cumulative_minmax(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    w = _series(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    columns = []
    for v in values:
        columns += [
            F.when(F.col(v).isNotNull(), F.max(v).over(w)).alias(f"cummax_{v}"),
            F.when(F.col(v).isNotNull(), F.min(v).over(w)).alias(f"cummin_{v}"),
        ]
    return df.select("*", *columns)


def cumulative_delta(df: DataFrame, keys: Sequence[str], order: str, minuend: str, subtrahend: str, delta: str) -> DataFrame:
    w = _series(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn(delta, F.col(minuend) - F.col(subtrahend))
    return out.withColumn(f"cumulated_{delta}", F.sum(delta).over(w))


def running_sum(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    w = _series(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def date_totals(df: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    return with_month_totals(df, order, **{f"total_{v}": coalesce_zero(F.sum(v)) for v in values})


def share_of_total(df: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    both = with_month_totals(df, order, **{f"_t_{v}": F.sum(v) for v in values})
    return both.select(*df.columns, *[ratio(v, f"_t_{v}", 0).alias(f"share_of_total_{v}") for v in values])


def share_of_group(df: DataFrame, order: str, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    out = df
    for group in groups:
        both = with_totals(out, [order, group], **{f"_t_{v}": F.sum(v) for v in values})
        out = both.select(*out.columns, *[ratio(v, f"_t_{v}", 0).alias(f"share_of_{group}_{v}") for v in values])
    return out


def relative_to_group_mean(df: DataFrame, order: str, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    out = df
    for group in groups:
        both = with_totals(out, [order, group], **{f"_t_{v}": F.avg(v) for v in values})
        out = both.select(*out.columns, *[ratio(v, f"_t_{v}", 0).alias(f"{v}_rel_to_{group}_average") for v in values])
    return out


def group_transform(df: DataFrame, by: Sequence[str], sums: Sequence[str], means: Sequence[str]) -> DataFrame:
    """Group sum of some columns and group mean of others on every row."""
    aggregates = {f"{c}_sum": F.sum(c) for c in sums} | {f"{c}_mean": F.avg(c) for c in means}
    return with_totals(df, by, **aggregates)


def months_since_first(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Months since a value was first above zero; null for a series where it never was."""
    w = Window.partitionBy(*keys)
    columns = [
        (F.col(order) - F.min(F.when(F.col(v) > 0, F.col(order))).over(w)).alias(f"months_since_first_{v}_gt0")
        for v in values
    ]
    return df.select("*", *columns)


def sku_age(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], min_abs: float, min_rel: float) -> DataFrame:
    """Months since launch, the first month whose trailing three-row minimum passes both thresholds."""
    trailing = _series(keys, order).rowsBetween(-2, 0)
    whole = Window.partitionBy(*keys)
    base = df.select(
        "*",
        *[F.min(v).over(trailing).alias(f"_low_{v}") for v in values],
        *[F.max(v).over(whole).alias(f"_top_{v}") for v in values],
    )
    ages = []
    for v in values:
        launched = (F.col(f"_low_{v}") >= min_abs) & (F.col(f"_low_{v}") > F.col(f"_top_{v}") * min_rel)
        ages.append((F.col(order) - F.min(F.when(launched, F.col(order))).over(whole)).alias(f"age_{v}"))
    return base.select(*df.columns, *ages)


def fill_down(df: DataFrame, sheet: str, row_no: str, column: str, out: str, block_rows: int = 100_000) -> DataFrame:
    """Last known value above, per sheet.

    A sheet is cut into blocks of rows: values are filled inside each block, and
    the last value of every block is carried to the blocks after it. One sheet
    holding a large part of the rows therefore spreads over many tasks.
    """
    blocks = df.withColumn("_block", F.floor(F.col(row_no) / block_rows))
    inside = Window.partitionBy(sheet, "_block").orderBy(row_no).rowsBetween(Window.unboundedPreceding, 0)
    filled = blocks.withColumn("_here", F.last(column, ignorenulls=True).over(inside))
    known = F.when(F.col(column).isNotNull(), F.col(row_no))
    tails = blocks.groupBy(sheet, "_block").agg(F.max_by(column, known).alias("_tail"))
    before = Window.partitionBy(sheet).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(sheet, "_block", F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
    return filled.join(carried, [sheet, "_block"], "left").select(
        *df.columns, F.coalesce("_here", "_carry").alias(out)
    )


def category_codes(df: DataFrame, column: str, splits: int = 128) -> DataFrame:
    """Distinct values with their position in sorted order, starting at zero.

    The distinct values are cut into ranges at up to ``splits`` of themselves,
    numbered inside each range and moved by the number of values in the ranges
    before it, so that no task sorts all of them.
    """
    values = df.select(column).dropna().distinct()
    picked = values.orderBy(F.xxhash64(column), F.col(column)).limit(splits)
    cuts = picked.agg(F.sort_array(F.collect_list(column)).alias("cuts"))
    ranged = values.withColumn("_cuts", cuts.scalar()).select(
        column, F.size(F.filter("_cuts", lambda cut: cut <= F.col(column))).alias("_range")
    )
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # At most splits + 1 ranges exist, so this unpartitioned window has a fixed size.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return (
        ranged.withColumn("_in", number)
        .join(offsets, "_range")
        .select(column, (F.col("_before") + F.col("_in")).cast("int").alias(f"{column}_code"))
    )


def encode_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Code per category column, -1 for null."""
    out = df
    for column in columns:
        out = out.join(category_codes(df, column), column, "left")
        out = out.withColumn(f"{column}_code", F.coalesce(f"{column}_code", F.lit(-1)))
    return out
