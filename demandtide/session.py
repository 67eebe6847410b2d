"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "demandtide", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; everything else stays with the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """New folder under the one the cluster names in spark.checkpoint.dir, else under the warehouse; both are shared."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """The same rows held once, for a frame that several branches read.

    Where the cluster names a shared folder, as a stored columnar table: it cuts the
    lineage, survives the loss of executors, and gives the planner a known size to
    choose joins by. Elsewhere the executors keep the rows; what a lost one held is
    computed again.
    """
    if not df.sparkSession.conf.get("spark.checkpoint.dir", None):
        return df.persist()
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
