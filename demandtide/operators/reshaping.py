"""Union, unpivot, pivot and label stacking."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.operators.joining import at_most_one


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unpivot_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], variable: str, value: str, drop_null: bool = False
) -> DataFrame:
    out = df.unpivot(list(ids), list(columns), variable, value)
    return out.dropna(subset=[value]) if drop_null else out


def unpivot_blocks(
    df: DataFrame, ids: Sequence[str], blocks: Mapping[str, Sequence[str]], tag: str, names: Sequence[str]
) -> DataFrame:
    """Column ranges laid side by side, stacked under one tag each, in a single pass."""
    structs = [
        F.struct(F.lit(label).alias(tag), *[F.col(col).alias(name) for col, name in zip(cols, names)])
        for label, cols in blocks.items()
    ]
    return df.select(*ids, F.explode(F.array(*structs)).alias("_b")).select(*ids, "_b.*")


def override_rows(base: DataFrame, replacement: DataFrame, column: str, value: str) -> DataFrame:
    """Drop one source's rows and append its replacement."""
    return base.filter(~F.col(column).eqNullSafe(F.lit(value))).unionByName(replacement)


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    return df.select(
        "*", *[F.when(F.col(column) == v, 1).otherwise(0).alias(f"{prefix}{v}") for v in values]
    )


def stack_labels(df: DataFrame, ids: Sequence[str], labels: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per label out of columns named ``{measure}_{label}``."""
    return unpivot_blocks(
        df, ids, {label: [f"{m}_{label}" for m in measures] for label in labels}, "label", measures
    )


def label_pivot(df: DataFrame, keys: Sequence[str], labels: Sequence[str], value: str, name: str) -> DataFrame:
    """Wide form with one column per label; only keys present for every label remain. The job fails where a label has two rows."""
    aggs: list[Column] = []
    counts = [f"_rows_{k}" for k in range(len(labels))]
    for label, count in zip(labels, counts):
        of_label = F.col("label") == label
        aggs += [F.max(F.when(of_label, F.col(value))).alias(name.format(label=label)), F.count(F.when(of_label, 1)).alias(count)]
    everywhere = reduce(lambda a, b: a & b, [F.col(count) > 0 for count in counts])
    return df.groupBy(*keys).agg(*aggs).filter(at_most_one(counts, [*keys, "label"])).filter(everywhere).drop(*counts)


# Marks of columns that hold aggregates beside the months of a sheet.
AGGREGATE_MARKS = ("FY", "GR", "YTD", "Q1", "Q2", "Q3", "Q4")


def normalised_names(df: DataFrame) -> DataFrame:
    """Lower-case column names, blanks as underscores and hyphens as ``to``; names that fall together are an error."""
    names = [name.replace(" ", "_").replace("-", "to").lower() for name in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names fall together: {sorted({n for n in names if names.count(n) > 1})}")
    return df.toDF(*names)


def month_columns(columns: Sequence[str], pattern: str = r"20\d{4}", marks: Sequence[str] = AGGREGATE_MARKS) -> list[str]:
    """Columns whose name holds a month by ``pattern`` and none of the marks of an aggregate."""
    return [name for name in columns if re.search(pattern, name) and not any(mark in name for mark in marks)]


def drop_empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in one of the columns at least."""
    return df.dropna(how="all", subset=list(columns))
