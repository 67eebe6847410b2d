"""Group aggregates with the null rules of the planning tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandtide.functions.cleaning import coalesce_zero, ratio
from demandtide.operators.joining import with_totals


def group_sum(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums per key; rows with a null key drop out and a sum of nothing is zero."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(*[coalesce_zero(F.sum(col)).alias(col) for col in values])
    )


def group_mixed(df: DataFrame, keys: Sequence[str], how: Mapping[str, str]) -> DataFrame:
    """One aggregate per column, named ``sum``, ``mean``, ``min`` or ``max``."""
    functions = {"sum": lambda c: coalesce_zero(F.sum(c)), "mean": F.avg, "min": F.min, "max": F.max}
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[functions[fn](col).alias(col) for col, fn in how.items()])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, the first by ``order``; partial aggregation, no window."""
    rest = [col for col in df.columns if col not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[f"_row.{col}" for col in rest])


def newest_over_old(new: DataFrame, old: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Union in which rows of ``new`` win over rows of ``old`` with the same key."""
    stacked = new.withColumn("_age", F.lit(0)).unionByName(old.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    return keep_first(stacked, keys, [F.col("_age"), *order]).drop("_age")


def pivot_fill(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence, value: str, how: str = "sum", fill: float | None = 0.0
) -> DataFrame:
    """Pivot over a known value list, so that no extra job looks for the values."""
    out = df.dropna(subset=list(keys)).groupBy(*keys).pivot(column, list(values)).agg(F.expr(f"{how}({value})"))
    return out if fill is None else out.fillna(fill, subset=[str(v) for v in values])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_single_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys carrying more than one distinct value, to be checked for emptiness."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("n_values")).filter("n_values > 1")


def weighted_price(df: DataFrame, keys: Sequence[str], value: str, volume: str) -> DataFrame:
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(coalesce_zero(F.sum(value)).alias(value), coalesce_zero(F.sum(volume)).alias(volume))
        .withColumn("price", ratio(value, volume, 0.0))
    )


def split_ratio(df: DataFrame, child: Sequence[str], parent: Sequence[str], value: str, out: str = "split_ratio") -> DataFrame:
    """Share of each child in the total of its parent, over all history given."""
    sums = group_sum(df, child, [value])
    return with_totals(sums, parent, _total=F.sum(value)).withColumn(out, ratio(value, "_total")).drop("_total")


def equal_share_fallback(df: DataFrame, parent: Sequence[str], value: str, out: str) -> DataFrame:
    """Share in the parent total; equal shares where that total is zero."""
    both = with_totals(df, parent, _total=F.sum(value), _n=F.count(F.lit(1)))
    share = F.when(F.col("_total") == 0, F.lit(1.0) / F.col("_n")).otherwise(ratio(value, "_total"))
    return both.withColumn(out, share).drop("_total", "_n")


def rms(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.sqrt(F.sum(col * col) / F.count(col))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The k first rows per group. Spark limits each task's groups before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
