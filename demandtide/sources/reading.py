"""Readers for versioned tables and timestamped file drops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandtide.functions.cleaning import map_values
from demandtide.operators.aggregating import group_sum


def latest_version(df: DataFrame, keys: Sequence[str], version: str, where: Column | None = None) -> DataFrame:
    """Rows holding the newest version of their key; ties all stay, rows with a null key drop out.

    ``where`` narrows the rows that decide on the newest version. The maximum is
    a partial aggregate, and the semi join hashes key and version together, so
    the old versions of one busy key spread over the cluster.
    """
    selector = df if where is None else df.filter(where)
    newest = selector.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(version).alias(version))
    return df.join(newest.dropna(subset=[version]), [*keys, version], "left_semi")


def load_channel_fact(
    df: DataFrame, audit_columns: Sequence[str], channel: str, renames: Mapping[str, str], quantity: str
) -> DataFrame:
    """Fact without its audit columns, channels renamed, duplicates summed."""
    slim = df.drop(*audit_columns).withColumn(channel, map_values(channel, renames))
    return group_sum(slim, [c for c in slim.columns if c != quantity], [quantity])


def load_tables(spark: SparkSession, folder: str, names: Sequence[str], audit_columns: Sequence[str] = ()) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet").drop(*audit_columns) for name in names}


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True, encoding: str = "UTF-8"
) -> DataFrame:
    """Delimited text under an explicit schema; blank lines are skipped by the reader."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header, encoding=encoding)


def latest_file(spark: SparkSession, folder: str, suffix: str, schema: str, sep: str = ",") -> DataFrame:
    """Rows of the drop ``<number>_<suffix>.csv`` with the largest number; an error when there is none.

    A drop is one file or a folder of part files. Only the listing is read to choose it.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    pattern = rf"^(.*/(\d+)_{suffix}\.csv)(/.*)?$"
    named = listing.select(
        F.regexp_extract("path", pattern, 1).alias("drop"), F.regexp_extract("path", pattern, 2).alias("stamp")
    ).filter("stamp != ''")
    newest = named.agg(F.max_by("drop", F.col("stamp").cast("decimal(38,0)")).alias("drop")).first()["drop"]
    if newest is None:
        raise FileNotFoundError(f"no *_{suffix}.csv in {folder}")
    rows = read_delimited(spark, newest, schema, sep)
    if rows.isEmpty():
        raise ValueError(f"{newest} holds no rows")
    return rows


def read_scenario(df: DataFrame, cycle: int, created_by: str, created_on: Column, changed_on: Column) -> DataFrame:
    """One version of a scenario; the cycle is the partition column, so the scan is pruned."""
    return df.filter(
        (F.col("cyc_dat") == cycle)
        & (F.col("frc_usr_nam_dsc") == created_by)
        & (F.col("frc_cre_dat") == created_on)
        & (F.col("frc_mdf_dat") == changed_on)
    )
