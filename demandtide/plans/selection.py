"""Feature selections per horizon: saved, read back, and applied to one prepared table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandtide.operators.aggregating import top_per_group
from demandtide.sources.writing import publish, published

#: A selection is broadcast; it has one row per horizon and feature.
MOST_ROWS = 100_000


def select_features(importances: DataFrame, k: int) -> DataFrame:
    """horizon, rank, feature: the ``k`` most important features of every horizon, ties by name."""
    ranked = top_per_group(importances.select("horizon", "feature", "importance"), ["horizon"], [F.desc("importance"), F.col("feature")], k, "rank")
    return ranked.select("horizon", "rank", "feature")


def save_selection(selection: DataFrame, path: str, version: str) -> None:
    """Published as a version, so that a run that reads it sees a whole selection or the one before."""
    publish(selection.select("horizon", "rank", "feature"), path, version)


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    return published(spark, path)


def masked(table: DataFrame, features: Sequence[str], selection: DataFrame, fixed: Sequence[str] = ()) -> DataFrame:
    """``table`` with every feature zero where its row's horizon has not selected it; ``fixed`` ones always stay.

    A constant column adds nothing to a fit, so all horizons share one table, one list of features and
    one vector assembler, and each is fitted as if on its own columns. Horizons without a
    selection keep all features. Features that the table lacks are ignored.
    """
    if (rows := selection.count()) > MOST_ROWS:
        raise ValueError(f"a selection of {rows} rows; at most {MOST_ROWS}")
    chosen = F.broadcast(selection.groupBy("horizon").agg(F.collect_set("feature").alias("_chosen")))
    met = table.join(chosen, "horizon", "left")

    def cell(name: str):
        return F.when(F.col("_chosen").isNull() | F.array_contains("_chosen", name), F.col(name)).otherwise(F.lit(0.0)).alias(name)

    free = [f for f in features if f not in fixed]
    return met.select(*[cell(c) if c in free else F.col(c) for c in table.columns])
