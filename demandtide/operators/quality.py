"""Profiles, contract checks and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def repeated_column_names(df: DataFrame) -> list[str]:
    return sorted({name for name in df.columns if df.columns.count(name) > 1})


def check_contract(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself when its column set equals the contract and no name repeats, an error otherwise."""
    if repeated := repeated_column_names(df):
        raise ValueError(f"repeated columns: {repeated}")
    if len(df.columns) != len(columns):
        raise ValueError(f"{len(df.columns)} columns found, contract has {len(columns)}")
    if set(df.columns) != set(columns):
        raise ValueError(f"columns differ from the contract: {sorted(set(df.columns) ^ set(columns))}")
    return df.select(*columns)


def column_values(df: DataFrame) -> DataFrame:
    """column_name, value (as text), n_rows: every value of every column, null included.

    One pass and one shuffle by column and value with partial counts, so a column with
    many values is many tasks and a frequent value one row a task.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns]
    pairs = df.select(F.explode(F.array(*cells)).alias("p")).select("p.*")
    return pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def column_profile(df: DataFrame, text_limit: int | None = None) -> DataFrame:
    """One row per column: range, mean, spread, distinct and null counts.

    Numeric columns are profiled in one aggregate. Distinct counts come from
    ``column_values``, which is the value list itself. With ``text_limit`` the list
    is also given as text of so many characters, from its smallest values.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}

    def stats(name: str) -> Column:
        value = F.col(name).cast("double") if name in numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.coalesce(F.min(value), F.lit(0.0)).alias("min_value"),
            F.coalesce(F.max(value), F.lit(0.0)).alias("max_value"),
            F.coalesce(F.avg(value), F.lit(0.0)).alias("mean_value"),
            F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std_value"),
            (F.count(F.lit(1)) - F.count(name)).alias("n_null"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
        )

    wide = df.agg(*[stats(name).alias(f"_{i}") for i, name in enumerate(df.columns)])
    base = wide.select(F.explode(F.array(*[f"_{i}" for i in range(len(df.columns))])).alias("s")).select("s.*")
    values = column_values(df)
    counts = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    profile = base.join(counts, "column_name")
    if text_limit is None:
        return profile
    # Every value but the empty one fills a character and a separator: text_limit values always suffice.
    from demandtide.operators.aggregating import top_per_group

    head = top_per_group(values.filter("value IS NOT NULL").select("column_name", F.col("value").alias("v")), ["column_name"], [F.col("v")], text_limit, "r")
    texts = head.groupBy("column_name").agg(
        F.substring(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "v"))), lambda e: e["v"]), ","),
            1,
            text_limit,
        ).alias("values_text")
    )
    return profile.join(texts, "column_name", "left")


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance: float = 0.001
) -> DataFrame:
    """Keys on which the sums of two stages differ by the tolerance or more.

    Both stages are stacked with opposite signs and summed once: no join.
    """
    plus = left.select(*keys, *[F.col(v).alias(v) for v in values])
    minus = right.select(*keys, *[(-F.col(v)).alias(v) for v in values])
    diff = plus.unionByName(minus).groupBy(*keys).agg(*[F.sum(v).alias(f"diff_{v}") for v in values])
    worst = [F.abs(F.coalesce(F.col(f"diff_{v}"), F.lit(0.0))) for v in values]
    largest = worst[0] if len(worst) == 1 else F.greatest(*worst)
    return diff.filter(largest >= tolerance)
