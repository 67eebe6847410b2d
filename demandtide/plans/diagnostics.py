"""Diagnostic KPIs of a backtest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from demandtide.functions.cleaning import ratio

NO_AGE = -99


def score_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Accuracy on forecast, accuracy on actual and bias; null where the forecasts sum to zero."""
    sums = df.groupBy(*keys).agg(
        F.sum("actual").alias("a"),
        F.sum("forecast").alias("f"),
        F.sum(F.abs(F.col("forecast") - F.col("actual"))).alias("e"),
    )
    held = F.col("f") != 0
    return sums.select(
        *keys,
        (1 - ratio("e", "f")).alias("fa"),
        F.when(held, 1 - ratio("e", "a")).alias("fa_prime"),
        ratio(F.col("a") - F.col("f"), "f").alias("bias"),
    )


def mx_kpis(df: DataFrame, keys: Sequence[str], horizon: int, first: int, last: int, minimum_age: int = -100) -> DataFrame:
    """Totals over a month range at one horizon; errors count only where something was sold.

    Rows of series younger than ``minimum_age`` count as zero.
    """
    rows = df.filter((F.col("lag") == horizon) & F.col("m").between(first, last))
    old = F.coalesce(F.col("age"), F.lit(NO_AGE)) >= minimum_age
    err = F.when(old & (F.col("actual") > 0), F.col("actual") - F.col("forecast")).otherwise(0.0)
    sums = rows.groupBy(*keys).agg(
        F.sum(F.when(old, F.col("actual")).otherwise(0.0)).alias("target"),
        F.sum(F.when(old, F.col("forecast")).otherwise(0.0)).alias("prediction"),
        F.sum(err).alias("_err"),
        F.sum(F.abs(err)).alias("_abs"),
    )
    return sums.select(
        *keys,
        "target",
        "prediction",
        ratio("_err", "prediction").alias("bias"),
        (1 - ratio("_abs", "prediction")).alias("fa"),
        (1 - ratio("_abs", "target")).alias("fa_prime"),
    )


def monthly_series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = df.groupBy(*keys, "m").agg(
        F.sum("actual").alias("target"),
        F.sum("forecast").alias("prediction"),
        F.sum(F.abs(F.col("actual") - F.col("forecast"))).alias("_abs"),
    )
    return sums.select(
        *keys,
        "m",
        "target",
        "prediction",
        ratio(F.col("target") - F.col("prediction"), "prediction").alias("bias"),
        (1 - ratio("_abs", "prediction")).alias("fa"),
    )


def as_kpi_input(df: DataFrame, keys: Sequence[str], time_lag: int = 0) -> DataFrame:
    """Cycle month from horizon and time lag, sums per key."""
    placed = df.withColumn("cycle", F.col("m") - (F.col("lag") - time_lag))
    return placed.groupBy(*keys, "cycle", "m").agg(
        F.coalesce(F.sum("forecast"), F.lit(0.0)).alias("forecast"), F.coalesce(F.sum("actual"), F.lit(0.0)).alias("actual")
    )


def backtest_actuals(forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str], data_lag: int = 2) -> DataFrame:
    """Forecasts with their actual (null when unknown) and the cycle they were made in."""
    return forecasts.join(actuals, [*keys, "m"], "left").withColumn("cycle", F.col("m") - F.col("lag") + data_lag)
