"""Registered queries against their SQL on the smallest scale.

By default a few from each area; with DEMANDTIDE_ALL=1 every one.
"""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
SOME = (
    "latest_version latest_file_scan scenario_write partition_overwrite column_profile dedup_keep_first panel_full_outer kpi_grouping_sets "
    "fill_down encode_categories lag_matrix target_r6m feature_table_dc raw_master_dc job_competitor job_tradeflow kpi_report kpi_score "
    "seasonal_correction rescale_residual granularity_dc scenario_build week_sku_split flagship"
).split()
NAMES = sorted(entry.oracle_sql()) if os.environ.get("DEMANDTIDE_ALL") else SOME

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    return repr(round(float(value), 6)) if isinstance(value, (int, float)) else str(value)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(result.fetchall(), columns)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
