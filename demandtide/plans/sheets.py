"""Spreadsheets as cells: two header rows with merged cells, rows picked by number.

A sheet is a set of cells (sheet, row, col, text), rows and columns from zero; empty
cells may be missing. Headers are parsed from the header rows alone and joined to the
body by position, so any number of sheets with different columns is read in one pass
and no sheet is pivoted or brought to one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandtide.functions import cleaning as C
from demandtide.session import written


def filled_headers(cells: DataFrame, first: int = 1, second: int = 2) -> DataFrame:
    """sheet, col, upper, lower: header texts of every column, a merged cell standing for all columns it covers.

    A merged cell keeps its text in its first column: the upper row is filled to the
    right, the lower one takes the upper text of its own column where it is empty.
    Only cells of the two header rows and the sheets' column numbers take part.
    """
    texts = F.when(F.trim("text") != "", F.trim("text"))
    heads = cells.filter(F.col("row").isin(first, second)).groupBy("sheet", "col").agg(
        F.max(F.when(F.col("row") == first, texts)).alias("upper"), F.max(F.when(F.col("row") == second, texts)).alias("lower")
    )
    columns = cells.select("sheet", "col").distinct()
    right = Window.partitionBy("sheet").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as the sheet has columns
    placed = columns.join(heads, ["sheet", "col"], "left").withColumn("own", F.col("upper")).withColumn("upper", F.last("upper", ignorenulls=True).over(right))
    start = F.max(F.when(F.col("own").isNotNull(), F.col("col"))).over(right)
    return placed.select("sheet", "col", "upper", F.coalesce("lower", "own").alias("lower"), start.alias("start"))


def last_block(headers: DataFrame, label: str) -> DataFrame:
    """Columns of the last block of each sheet whose upper header is ``label``."""
    own = headers.filter(F.col("upper") == label)
    latest = own.groupBy("sheet").agg(F.max("start").alias("start"))
    return own.join(latest, ["sheet", "start"], "left_semi")


def fullest_row(cells: DataFrame, holds: Column, last: int = 50) -> DataFrame:
    """sheet, row: the row among the first ``last`` with most cells for which ``holds``; the upper one of equals."""
    counts = cells.filter((F.col("row") <= last) & F.coalesce(holds, F.lit(False))).groupBy("sheet", "row").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("sheet").agg(F.min(F.struct((-F.col("n")).alias("n"), "row")).alias("b")).select("sheet", "b.row")


def until_gap(headers: DataFrame, first: int) -> DataFrame:
    """Columns from ``first`` on up to the first one without a lower header."""
    gaps = headers.filter((F.col("col") >= first) & F.col("lower").isNull()).groupBy("sheet").agg(F.min("col").alias("gap"))
    return headers.join(gaps, "sheet", "left").filter((F.col("col") >= first) & (F.col("gap").isNull() | (F.col("col") < F.col("gap")))).drop("gap")


def numbered_rows(df: DataFrame, order: Sequence[str], out: str = "row") -> DataFrame:
    """Rows numbered from zero in the order of ``order``, then of the other columns.

    The frame is sorted into ranges and stored with each row's place in its range; the ranges'
    sizes, one number a range, are summed up to offsets. No task sees all rows, and the
    numbers do not depend on how the frame was dealt.
    """
    rest = [c for c in df.columns if c not in order]
    # the place is the part of the increasing id below the partition's number
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = written(df.orderBy(*order, *rest).select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), "numbered")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).agg(F.array_sort(F.collect_list(F.struct("_range", "n"))).alias("s"))
    before = F.transform("s", lambda e, k: F.struct(e["_range"].alias("_range"), F.aggregate(F.slice("s", 1, k), F.lit(0).cast("long"), lambda total, x: total + x["n"]).alias("_before")))
    offsets = sizes.select(F.explode(before).alias("o")).select("o.*")
    return ranged.join(F.broadcast(offsets), "_range").withColumn(out, F.col("_before") + F.col("_place")).drop("_range", "_place", "_before")


def rows_by_number(sheet: DataFrame, mapping: DataFrame, on: Sequence[str] = (), keep: str = "mapping", row: str = "row", row_no: str = "row_no") -> DataFrame:
    """Rows of a numbered sheet beside the mapping that names them by a number counted from one.

    ``keep``: "mapping" keeps mapping rows whose row the sheet lacks, "sheet" rows that no mapping
    names, "both" all, "matched" neither. Null numbers match nothing.
    """
    how = {"mapping": "right", "sheet": "left", "both": "outer", "matched": "inner"}[keep]
    placed = mapping.withColumn(row, F.col(row_no).cast("long") - 1).drop(row_no)
    return sheet.join(placed, [*on, row], how)


def brand_sheets(cells: DataFrame, mapping: DataFrame, label: str = "Absolute", first: int = 1, second: int = 2) -> DataFrame:
    """sheet, the mapping's columns, month, value: the last block ``label`` of every sheet, at the rows the mapping names.

    The lower header is a month as yymm, read as yyyymm. Cells that are no number are
    zero; empty cells and rows that the sheet lacks give no row.
    """
    heads = last_block(filled_headers(cells, first, second), label).select("sheet", "col", F.col("lower").cast("int").alias("yymm")).filter("yymm is not null")
    body = cells.filter((F.col("row") > second) & F.col("text").isNotNull())
    named = rows_by_number(body, mapping, ["sheet"], "matched")
    names = [c for c in mapping.columns if c not in ("sheet", "row_no")]
    return named.join(heads, ["sheet", "col"]).select("sheet", *names, (F.col("yymm") + 200_000).alias("month"), C.coalesce_zero(C.to_number("text")).alias("value"))


def serial_sheets(cells: DataFrame, mapping: DataFrame, to_month: Column) -> DataFrame:
    """As ``brand_sheets`` for sheets with one header row of spreadsheet day numbers, wherever it stands.

    It is the row with most whole numbers from 30000 to 99999; the data end before its first empty
    cell. ``to_month`` turns the day number in ``serial`` into the month.
    """
    number = F.trim("text").try_cast("int")
    days = number.between(30_000, 99_999)
    dates = fullest_row(cells, days)
    heads = cells.join(dates, ["sheet", "row"], "left_semi").select("sheet", "col", F.when(days, number).alias("lower"))
    first = heads.filter("lower is not null").groupBy("sheet").agg(F.min("col").alias("from"))
    columns = cells.select("sheet", "col").distinct().join(first, "sheet").filter("col >= from").drop("from").join(heads, ["sheet", "col"], "left")
    serials = until_gap(columns, 0).select("sheet", "col", F.col("lower").alias("serial"))
    body = cells.join(dates.withColumnRenamed("row", "_top"), "sheet").filter((F.col("row") > F.col("_top")) & F.col("text").isNotNull())
    names = [c for c in mapping.columns if c not in ("sheet", "row_no")]
    named = rows_by_number(body, mapping, ["sheet"], "matched").join(serials, ["sheet", "col"])
    return named.select("sheet", *names, to_month.alias("month"), C.coalesce_zero(C.to_number("text")).alias("value"))
