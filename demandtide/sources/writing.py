"""Writers: contract files, appended scenario versions, replaced partitions, published versions, snapshots."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from demandtide.functions.cleaning import sink_number
from demandtide.operators.quality import check_contract


def sink_ready(df: DataFrame) -> DataFrame:
    """Every floating-point column in its written form."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.select(*[sink_number(c).alias(c) if c in floats else F.col(c) for c in df.columns])


def write_contract(df: DataFrame, columns: Sequence[str], path: str, drop_date: str) -> None:
    """Delimited file of the contract columns, in a folder per drop date."""
    out = check_contract(df.select(*columns), columns)
    out.write.mode("overwrite").option("sep", ";").option("header", True).csv(f"{path}/dt={drop_date}")


def append_scenario(df: DataFrame, path: str, partition: str = "cyc_dat") -> None:
    """Append one version; rows are gathered per partition value into few files, split by size."""
    spread = sink_ready(df).hint("rebalance", F.col(partition))
    spread.write.mode("append").partitionBy(partition).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Overwrite only the partitions that occur in the frame."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def reload_table(df: DataFrame, path: str, version: str) -> DataFrame:
    """The table rebuilt as a new version, also from its own rows; the newest version is returned."""
    publish(df, path, version)
    return published(df.sparkSession, path)


# --- versions that may be written twice ---------------------------------------------------


def content_sum(df: DataFrame) -> DataFrame:
    """One row n_rows, digest: the sum of a hash of every row, the same in any order and partitioning.

    Nulls count by their place, so a value that moves to another column is noticed.
    """
    marks = [F.col(c).isNull() for c in df.columns]
    row = F.xxhash64(*[F.col(c) for c in df.columns], *marks).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row), F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest"))


_COMMIT = "version string, sequence long, n_rows long, digest string"


def commits(spark: SparkSession, path: str) -> list[Row]:
    """Committed versions in the order of their commits; none where nothing was ever published."""
    try:
        found = spark.read.schema(_COMMIT).json(f"{path}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return found.groupBy("version").agg(F.min("sequence").alias("sequence"), F.first("n_rows").alias("n_rows"), F.first("digest").alias("digest")).orderBy("sequence", "version").collect()


def publish(df: DataFrame, path: str, version: str) -> bool:
    """One version of a table, visible to readers only once it is whole; False where the version is committed already.

    The rows are staged in a folder of the version, which a second try overwrites, and a
    commit record of one line makes them visible: a job that fails on the way changes
    nothing, a job that is run again changes nothing either. Older versions stay as they
    are, so a table may be rebuilt from itself.
    """
    spark = df.sparkSession
    known = commits(spark, path)
    if any(c.version == version for c in known):
        return False
    folder = f"{path}/versions/{version}"
    sink_ready(df).write.mode("overwrite").parquet(folder)
    written = content_sum(spark.read.schema(df.schema).parquet(folder)).first()
    record = [(version, 1 + max((c.sequence for c in known), default=0), written.n_rows, written.digest)]
    spark.createDataFrame(record, _COMMIT).coalesce(1).write.mode("append").json(f"{path}/commits")
    return True


def published(spark: SparkSession, path: str, every: bool = False) -> DataFrame:
    """Rows of the newest committed version, or of ``every`` one of them."""
    known = commits(spark, path)
    if not known:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(*[f"{path}/versions/{c.version}" for c in (known if every else known[-1:])])


# --- snapshots -----------------------------------------------------------------------------


#: Types whose text holds neither backslash nor line end, so that their cells are written and read as they are.
_PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_text(df: DataFrame) -> DataFrame:
    """Every cell as text on one line: backslash, line ends and null are written with a backslash."""

    def cell(f: T.StructField) -> Column:
        text = F.col(f.name).cast("string")
        for mark, spelled in () if isinstance(f.dataType, _PLAIN) else (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(mark), F.lit(spelled))
        return F.coalesce(text, F.lit("\\N")).alias(f.name)

    return df.select(*[cell(f) for f in df.schema])


def _from_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Inverse of ``_as_text``: pieces between doubled backslashes get their line ends back and are joined by one. Most cells hold no backslash."""

    def piece(text: Column) -> Column:
        return F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    def cell(f: T.StructField) -> Column:
        text = F.when(F.col(f.name) != "\\N", F.col(f.name))
        if not isinstance(f.dataType, _PLAIN):
            marked = F.array_join(F.transform(F.split(f.name, r"\\\\", -1), piece), "\\")
            text = F.when(F.contains(F.col(f.name), F.lit("\\")), F.when(F.col(f.name) != "\\N", marked)).otherwise(F.col(f.name))
        return text.cast(f.dataType).alias(f.name)

    return df.select(*[cell(f) for f in schema])


_CSV = {"sep": ";", "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_MANIFEST = "table string, columns string, n_rows long, digest string"


def write_snapshot(spark: SparkSession, tables: Mapping[str, DataFrame], path: str, stamp: str) -> None:
    """All tables as delimited files ``<stamp>_<table>.csv`` and, written last, a manifest of their rows and contents."""
    lines = []
    for name, df in tables.items():
        text = _as_text(df)
        text.write.mode("overwrite").options(**_CSV).csv(f"{path}/{stamp}_{name}.csv")
        found = content_sum(text).first()
        lines.append((name, df.schema.json(), found.n_rows, found.digest))
    spark.createDataFrame(lines, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}/{stamp}_manifest")


def read_snapshot(spark: SparkSession, path: str, stamp: str) -> dict[str, DataFrame]:
    """Tables of a snapshot in their own types; an error that names the tables whose files are not those of the manifest."""
    tables, wrong = {}, []
    for line in spark.read.schema(_MANIFEST).json(f"{path}/{stamp}_manifest").collect():
        schema = T.StructType.fromJson(json.loads(line.columns))
        text = spark.read.options(**_CSV).schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).csv(f"{path}/{stamp}_{line.table}.csv").fillna("")
        found = content_sum(text).first()
        if (found.n_rows, found.digest) != (line.n_rows, line.digest):
            wrong.append(line.table)
        tables[line.table] = _from_text(text, schema)
    if wrong:
        raise ValueError(f"files differ from the manifest: {', '.join(sorted(wrong))}")
    return tables
