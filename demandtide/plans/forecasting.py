"""Direct multi-horizon forecasts with Spark ML: one regressor per horizon.

Every fit reads the same supervised table, which is stored once. Fits of
different horizons are independent jobs, submitted from a small driver thread
pool; the data never leaves the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from demandtide.functions.periods import idx_to_ym, ym_to_idx
from demandtide.operators.reshaping import union_sources
from demandtide.plans.postprocess import extend_forecast
from demandtide.session import written

SEED = 17
# Longest horizon that is modelled, and months between data and origin.
MAX_MODEL_HORIZON = 12
DATA_LAG = 2
#: Singular values come from a library in the driver's JVM that prepares its constants at its first use without a lock.
_COMPONENTS = Lock()

REGISTRY = {
    "RandomForestRegressor": lambda **p: RandomForestRegressor(seed=SEED, **p),
    "XGBRegressor": lambda **p: GBTRegressor(seed=SEED, **p),
    "GradientBoostingRegressor": lambda **p: GBTRegressor(seed=SEED, **p),
    "DecisionTreeRegressor": lambda **p: DecisionTreeRegressor(seed=SEED, **p),
    "LinearRegression": lambda **p: LinearRegression(**p),
    "Ridge": lambda **p: LinearRegression(elasticNetParam=0.0, **p),
    "Lasso": lambda **p: LinearRegression(elasticNetParam=1.0, **p),
    "ElasticNet": lambda **p: LinearRegression(**{"elasticNetParam": 0.5, **p}),
    "HuberRegressor": lambda **p: LinearRegression(loss="huber", **p),
}


@dataclass(frozen=True)
class ModelSpec:
    """Regressor by name with optional scaling and principal components."""

    name: str = "RandomForestRegressor"
    params: Mapping[str, object] = field(default_factory=dict)
    scale: bool = False
    components: int | None = None


def build_pipeline(spec: ModelSpec, features: Sequence[str], target: str = "target") -> Pipeline:
    if spec.name not in REGISTRY:
        raise ValueError(f"unknown model {spec.name}")
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw")]
    column = "_raw"
    if spec.scale:
        stages.append(StandardScaler(inputCol=column, outputCol="_scaled", withMean=True))
        column = "_scaled"
    if spec.components:
        stages.append(PCA(k=spec.components, inputCol=column, outputCol="_pca"))
        column = "_pca"
    model = REGISTRY[spec.name](featuresCol=column, labelCol=target, predictionCol="prediction", **spec.params)
    return Pipeline(stages=[*stages, model])


def in_threads(task, items: Sequence, width: int = 4) -> list:
    """Results of independent Spark jobs, submitted side by side."""
    with ThreadPool(min(width, max(1, len(items)))) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(task), items)


def features_for(horizon: int, features: Sequence[str], selected: Mapping[int, Sequence[str]] | None, fixed: Sequence[str] = ()) -> list[str]:
    """Columns of a horizon: a saved selection plus fixed columns, or all of them."""
    if not selected or horizon not in selected:
        return list(features)
    return list(dict.fromkeys([*selected[horizon], *fixed]))


def training_rows(table: DataFrame, horizon: int, cutoff: int, target: str = "target") -> DataFrame:
    """Rows of a horizon whose target month is known at the cutoff."""
    return table.filter((F.col("horizon") == horizon) & F.col(target).isNotNull() & (F.col("date_to_predict") <= cutoff))


def direct_forecast(
    table: DataFrame, keys: Sequence[str], features: Sequence[str], cutoff: int, horizons: Sequence[int], spec: ModelSpec,
    selected: Mapping[int, Sequence[str]] | None = None, fixed: Sequence[str] = (),
) -> tuple[DataFrame, dict[int, PipelineModel]]:
    """Predictions of the origin ``cutoff`` per horizon, not below zero, and the fitted models."""
    ready = table.fillna(0.0, subset=list(features))

    def fit(horizon: int):
        columns = features_for(horizon, features, selected, fixed)
        with _COMPONENTS if spec.components else nullcontext():
            model = build_pipeline(spec, columns).fit(training_rows(ready, horizon, cutoff))
        rows = ready.filter((F.col("horizon") == horizon) & (F.col("date_when_predicting") == cutoff))
        scored = model.transform(rows).withColumn("prediction", F.greatest(F.col("prediction"), F.lit(0.0)))
        return model, scored.select(*keys, "date_when_predicting", "date_to_predict", "horizon", "target", "prediction")

    fitted = in_threads(fit, list(horizons))
    return union_sources([rows for _, rows in fitted]), {h: model for h, (model, _) in zip(horizons, fitted)}


def backtest(
    table: DataFrame, keys: Sequence[str], features: Sequence[str], origins: Sequence[int], horizons: Sequence[int], spec: ModelSpec
) -> DataFrame:
    """Direct forecasts of several origins, each trained on what was known at it."""
    held = written(table)
    return union_sources([direct_forecast(held, keys, features, origin, horizons, spec)[0] for origin in origins])


def train_test_rmse(table: DataFrame, features: Sequence[str], cutoff: int, horizon: int, spec: ModelSpec) -> dict[str, float]:
    ready = table.fillna(0.0, subset=list(features)).filter(F.col("target").isNotNull() & (F.col("horizon") == horizon))
    model = build_pipeline(spec, features).fit(ready.filter(F.col("date_to_predict") <= cutoff))
    rmse = RegressionEvaluator(labelCol="target", predictionCol="prediction", metricName="rmse")
    sides = {"train": F.col("date_to_predict") <= cutoff, "test": F.col("date_to_predict") > cutoff}
    return {name: rmse.evaluate(model.transform(ready.filter(side))) for name, side in sides.items()}


def feature_importance(
    spark: SparkSession, models: Mapping[int, PipelineModel], features: Sequence[str], label: str, cutoff: int,
    selected: Mapping[int, Sequence[str]] | None = None, fixed: Sequence[str] = (),
) -> DataFrame:
    """Long table of importances; horizons count from the data, the cycle is the cutoff less the smallest one.

    Its size is features times horizons, whatever the data holds.
    """
    rows = []
    for horizon, model in models.items():
        scores = model.stages[-1].featureImportances.toArray()
        names = features_for(horizon, features, selected, fixed)
        rows += [(label, horizon - (DATA_LAG + 1), name, float(score)) for name, score in zip(names, scores)]
    smallest = min(horizon for _, horizon, _, _ in rows)
    frame = spark.createDataFrame(rows, "label string, horizon int, feature string, importance double")
    cycle = idx_to_ym(ym_to_idx(F.lit(cutoff)) - smallest)
    return frame.withColumn("cycle_date", cycle)


def global_table(table: DataFrame, means: Sequence[str], sums: Sequence[str] = ("target",), by: Sequence[str] = ()) -> DataFrame:
    """One row per origin and target over all series: mean features, summed targets."""
    keys = [*by, "date_when_predicting", "date_to_predict", "horizon"]
    held = [F.when(F.count(c) > 0, F.sum(c)).alias(c) for c in sums]
    return table.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in means], *held)


def tuning_errors(
    table: DataFrame, keys: Sequence[str], features: Sequence[str], origins: Sequence[int], horizons: Sequence[int], specs: Mapping[str, ModelSpec]
) -> DataFrame:
    """Sum of absolute errors per configuration and horizon."""
    held = written(table)
    parts = []
    for name, spec in specs.items():
        made = union_sources([direct_forecast(held, keys, features, origin, horizons, spec)[0] for origin in origins])
        scored = made.filter(F.col("target").isNotNull()).groupBy("horizon").agg(
            F.sum(F.abs(F.col("prediction") - F.col("target"))).alias("error"), F.count(F.lit(1)).alias("n_rows")
        )
        parts.append(scored.withColumn("config", F.lit(name)))
    return union_sources(parts)


def end_to_end(
    table: DataFrame, actual: DataFrame, keys: Sequence[str], features: Sequence[str], cutoff: int, requested: int, spec: ModelSpec, sold: str
) -> DataFrame:
    """Modelled horizons up to twelve beyond the data lag, the yearly trend after them, cut at the request."""
    modelled = min(requested, MAX_MODEL_HORIZON) + DATA_LAG + 1
    held = written(table)
    made, _ = direct_forecast(held, keys, features, cutoff, list(range(1, modelled + 1)), spec)
    rows = written(
        made.select(
            *keys, ym_to_idx("date_to_predict").alias("m"), (F.col("horizon") - (DATA_LAG + 1)).alias("horizon"), F.col("prediction").alias("yhat")
        )
    )
    if requested <= MAX_MODEL_HORIZON:
        return rows.filter(F.col("horizon") <= requested)
    # The year after the last modelled months repeats the last twelve of them.
    years = -(-(requested - MAX_MODEL_HORIZON) // 12)
    base = rows.filter(F.col("horizon").between(1, MAX_MODEL_HORIZON)).unionByName(rows.filter("horizon < 1"))
    return extend_forecast(base, actual, "m", ["yhat"], "yhat", sold, years).filter(F.col("horizon") <= requested)
