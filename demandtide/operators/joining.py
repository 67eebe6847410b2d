"""Equi joins with the null and cardinality rules of the planning tables.

Joins carry no broadcast hint, except against one row per calendar month:
Catalyst and adaptive execution broadcast a side only after checking its size,
and split skewed partitions otherwise. That size is one of compressed files, and an
exploded side counts as its source: tables with rows per product are kept from
broadcasts by ``dealt_lookup``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def lookup(df: DataFrame, mapping: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    return df.join(mapping, on=[on] if isinstance(on, str) else list(on), how=how)


def dealt_lookup(df: DataFrame, mapping: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """``lookup`` by sorting both sides, so that no mapping passes through the driver whatever the planner takes for its size."""
    return lookup(df, mapping.hint("merge"), on, how)


def unmapped_keys(df: DataFrame, mapping: DataFrame, df_key: str, map_key: str) -> DataFrame:
    """Distinct key values that have no row in the mapping."""
    keys = df.select(F.col(df_key).alias("unmapped_key")).dropna().distinct()
    return keys.join(mapping, keys.unmapped_key == mapping[map_key], "left_anti")


def fallback_lookup(
    df: DataFrame, mapping: DataFrame, key: str, new_key: str, old_key: str, value: str, out: str
) -> DataFrame:
    """Value found by the old code, else by the new code, else null. A repeated code stands for its smallest value."""

    def found(code: str, name: str) -> DataFrame:
        return mapping.select(F.col(code).alias(key), F.col(value).alias(name)).dropna().groupBy(key).agg(F.min(name).alias(name))

    joined = df.join(found(old_key, "_by_old"), key, "left").join(found(new_key, "_by_new"), key, "left")
    return joined.withColumn(out, F.coalesce("_by_old", "_by_new")).drop("_by_old", "_by_new")


def cardinality_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails where a key occurs twice. The maximum of a column over one row is its value."""
    rest = [col for col in df.columns if col not in keys]
    packed = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.max(col).alias(col) for col in rest])
    return packed.filter(at_most_one(["_n"], keys)).select(*keys, *rest)


def at_most_one(counts: Sequence[str], keys: Sequence[str]) -> Column:
    """True where no count of rows is above one; the job fails elsewhere."""
    message = F.lit(f"more than one row for key {', '.join(keys)}")
    repeated = reduce(lambda a, b: a | b, [F.col(count) > 1 for count in counts])
    return F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def join_many_to_one(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    return left.join(require_unique(right, on), list(on), how)


def fold_join(frames: Sequence[DataFrame], key_names: Sequence[str], how: str = "left") -> DataFrame:
    """Join frames one after another on those key names both sides share."""

    def step(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [key for key in key_names if key in left.columns and key in right.columns]
        return left.join(right, shared, how)

    return reduce(step, frames)


def outer_panels(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer join of long facts as one grouped union: a single shuffle for any number of frames.

    Every frame must hold at most one row per key; the job fails where one holds
    more. Columns outside the key are null where a frame lacks the key.
    """
    names = [[col for col in frame.columns if col not in on] for frame in frames]
    counts = [f"_rows_{k}" for k in range(len(frames))]
    parts = []
    for frame, own, count in zip(frames, names, counts):
        parts.append(frame.select(*on, *own, F.lit(1).alias(count)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [col for own in names for col in own]
    joined = stacked.groupBy(*on).agg(*[F.max(col).alias(col) for col in values], *[F.count(count).alias(count) for count in counts])
    return joined.filter(at_most_one(counts, on)).drop(*counts)


def with_month_totals(df: DataFrame, month: str, **aggregates: Column) -> DataFrame:
    """Attach aggregates per month. One row per calendar month is few enough to broadcast at any scale."""
    totals = df.groupBy(month).agg(*[expr.alias(name) for name, expr in aggregates.items()])
    return df.join(F.broadcast(totals), month, "left")


def with_totals(df: DataFrame, by: Sequence[str], **aggregates: Column) -> DataFrame:
    """Attach group aggregates to every row.

    Partial aggregation plus a join, not a window: a group holding a large part
    of the rows never has to fit in one task.
    """
    totals = df.groupBy(*by).agg(*[expr.alias(name) for name, expr in aggregates.items()])
    return df.join(totals, list(by), "left")
