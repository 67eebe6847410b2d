"""Preparation jobs: from contract columns of a drop to clean long tables.

Each job is one function over tidy DataFrames. Sheets keep a ``row_no`` column
where the order of rows carries meaning. Months of wide sheets are columns; a
job gets them as a list of names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.functions import cleaning as C, periods as P
from demandtide.operators.aggregating import equal_share_fallback, group_sum, newest_over_old, split_ratio
from demandtide.operators.joining import dealt_lookup, fallback_lookup, lookup
from demandtide.operators.panel import fill_down
from demandtide.operators.reshaping import override_rows, union_sources, unpivot_blocks, unpivot_long


def ticked(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


# --- market and availability reports -------------------------------------------------


def competitor_report(
    sheet: DataFrame, sheet_key: str, names: Mapping[str, str], scopes: Mapping[str, str], kept: Sequence[str]
) -> DataFrame:
    """Report with one section per measure: value and volume per class and month, with their price.

    A section header stands in ``header`` and is carried down. Cells are text;
    negative ones are dropped, and a class needs both value and volume.
    """
    filled = fill_down(sheet, sheet_key, "row_no", "header", "section").filter(F.col("header").isNull())
    cells = filled.select(
        "section",
        C.last_keyword("name", names, "other").alias("class"),
        C.first_keyword("name", scopes, "Total").alias("scope"),
        "month",
        C.cell_to_number("cell").alias("number"),
    ).filter("number >= 0")

    def of(section: str) -> Column:
        return F.sum(F.when(F.col("section") == section, F.col("number")))

    both = cells.groupBy("scope", "class", "month").agg(of("Value").alias("value"), of("Volume").alias("volume"))
    return (
        both.dropna(subset=["value", "volume"])
        .filter(F.col("scope").isin(*kept))
        .withColumn("price", C.ratio("value", "volume", 0.0))
    )


def availability_sheet(sheet: DataFrame, item: str, headers: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Sheet with two header rows, given as (column, month, week), to one row per item and week."""
    months = {column: month for column, month, _ in headers}
    weeks = F.create_map(*[F.lit(x) for column, _, week in headers for x in (column, week)])
    long = unpivot_long(sheet, [item], ticked(list(months)), "column", "value", drop_null=True)
    return long.select(
        item, "value", weeks[F.col("column")].alias("week"), C.map_values("column", months, keep_unmapped=False).alias("month")
    )


def unit_price(value: DataFrame, volume: DataFrame, ids: Sequence[str], months: Sequence[str]) -> DataFrame:
    """Value block over volume block, per product and month."""

    def rows(sheet: DataFrame, name: str) -> DataFrame:
        return unpivot_blocks(sheet, ids, {month: [f"`{month}`"] for month in months}, "month", [name]).dropna(subset=[name])

    # Stacked and summed instead of joined: one shuffle, or none where both sheets are dealt by their ids, which blocks of columns keep.
    top, bottom = rows(value, "value"), rows(volume, "volume")
    both = union_sources([top, bottom]).groupBy(*ids, "month").agg(F.sum("value").alias("value"), F.sum("volume").alias("volume"))
    return both.dropna(subset=["value", "volume"]).withColumn("price", C.ratio("value", "volume")).dropna(subset=["price"])


# --- flows in and out -----------------------------------------------------------------


def without_tier_conflict(df: DataFrame, tier: str, mapped_tier: str) -> DataFrame:
    """Rows whose own tier does not contradict the mapped one."""
    return df.filter(F.col(tier).isNull() | F.col(mapped_tier).isNull() | (F.col(tier) == F.col(mapped_tier)))


def sellin_long(
    sheet: DataFrame, mapping: DataFrame, key: str, ids: Sequence[str], serials: Sequence[str], cycle: str,
    base: str = P.SERIAL_BASE_1899,
) -> DataFrame:
    """Mapped products, serial-date columns melted to months, months before the cycle are actual."""
    mapped = without_tier_conflict(dealt_lookup(sheet, mapping, key, "inner"), "tier", "mapped_tier")
    long = unpivot_long(mapped, [key, *ids], ticked(serials), "serial", "volume", drop_null=True)
    day = P.month_start(P.serial_to_date(F.col("serial").cast("int"), base))
    dated = long.withColumn("date", day).drop("serial")
    return dated.withColumn("status", F.when(F.col("date") < F.trunc(F.lit(cycle).cast("date"), "month"), "actual").otherwise("forecasted"))


def spending_long(sheet: DataFrame, serial: str, brands: Sequence[str], base: str = P.SERIAL_BASE_1900) -> DataFrame:
    long = unpivot_long(sheet, [serial], ticked(brands), "brand", "spending")
    return long.withColumn("date", P.month_start(P.serial_to_date(serial, base))).drop(serial)


def point_of_sale(df: DataFrame, ym: str, store: str, sku: str, quantity: str, value: str) -> DataFrame:
    """Sums per month, store and product; the month is written as its middle day."""
    sums = group_sum(df, [ym, store, sku], [quantity, value])
    middle = F.make_date(F.floor(F.col(ym) / 100).cast("int"), (F.col(ym) % 100).cast("int"), F.lit(15))
    return sums.withColumn("date", F.date_format(middle, "MM/dd/yyyy")).drop(ym)


def with_unit_price(df: DataFrame, revenue: str, quantity: str, out: str = "price") -> DataFrame:
    return df.withColumn(out, C.ratio(revenue, quantity))


def stock(df: DataFrame, codes: DataFrame, key: str, new: str, old: str, value: str, revenue: str, quantity: str) -> DataFrame:
    """Stock rows with a product, named by the old code, else the new one, with unit price."""
    named = fallback_lookup(df.dropna(subset=[key]), codes, key, new, old, value, "sku")
    return with_unit_price(named, revenue, quantity)


def customers(df: DataFrame, name: str, virtual: str, columns: Mapping[str, str]) -> DataFrame:
    """Customers without the virtual stores, renamed to the contract."""
    return df.filter(~F.col(name).contains(virtual)).select(*[F.col(c).alias(n) for c, n in columns.items()])


# --- scopes ----------------------------------------------------------------------------


def scope_sum(di: DataFrame, eib: DataFrame, keys: Sequence[str], month: str, value: str, first: int, last: int) -> DataFrame:
    """DI beside EIB with IL as their sum, one row per scope, inside a month window."""
    stacked = union_sources(
        [di.select(*keys, month, F.lit("DI").alias("scope"), value), eib.select(*keys, month, F.lit("EIB").alias("scope"), value)]
    ).filter(F.col(month).between(first, last))
    wide = stacked.groupBy(*keys, month).agg(
        *[C.coalesce_zero(F.sum(F.when(F.col("scope") == s, F.col(value)))).alias(s) for s in ("DI", "EIB")]
    )
    with_il = wide.withColumn("IL", F.col("DI") + F.col("EIB"))
    long = unpivot_long(with_il, [*keys, month], ["DI", "EIB", "IL"], "scope", value)
    return long.withColumn(value, C.round_half_even(value, 4))


def scope_diff(
    new: DataFrame, old: DataFrame, di: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """IL from the new file over the old one, EIB as IL minus DI, one row per scope."""
    il = newest_over_old(new.select(*keys, value), old.select(*keys, value), keys, [F.col(value)])
    both = il.withColumnRenamed(value, "IL").join(di.withColumnRenamed(value, "DI").select(*keys, "DI"), list(keys), "left")
    wide = both.withColumn("DI", C.coalesce_zero("DI")).withColumn("EIB", F.col("IL") - F.col("DI"))
    return unpivot_long(wide, list(keys), ["IL", "DI", "EIB"], "scope", value)


def brand_to_sku(volumes: DataFrame, products: DataFrame, brand: Sequence[str], detail: Sequence[str], value: str) -> DataFrame:
    """Brand volumes spread over the detail by its share inside the brand in the product sheets."""
    shares = split_ratio(products, [*brand, *detail], brand, value, "share").drop(value)
    shared = [c for c in volumes.columns if c in brand]
    return volumes.join(shares, shared, "inner").withColumn(value, F.col(value) * F.col("share")).drop("share")


# --- mapping tables -----------------------------------------------------------------------


def unit_table(first: DataFrame, second: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Two conversion tables under standard names, without repeats."""
    return union_sources([lookup(first, names, key, "inner").drop(key), second]).distinct()


def months_long(sheet: DataFrame, ids: Sequence[str], months: Sequence[str], value: str) -> DataFrame:
    """Month columns to rows; ``25%`` becomes 0.25."""
    long = unpivot_long(sheet, ids, ticked(months), "month", value, drop_null=True)
    number = C.to_number(F.replace(value, F.lit("%"), F.lit("")))
    return long.withColumn(value, F.when(F.col(value).endswith("%"), number / 100.0).otherwise(number)).withColumn(
        "date", P.parse_month("month")
    ).drop("month")


# --- unified views ---------------------------------------------------------------------------


def unified_split(
    sheet: DataFrame, ids: Sequence[str], months: Sequence[str], measures: Mapping[str, str], out_of_scope: DataFrame,
    shares: DataFrame, sku: str,
) -> DataFrame:
    """Plan sheet melted, measures side by side, products out of scope dropped, split to channels by share."""
    long = unpivot_long(sheet, [*ids, "measure"], ticked(months), "month", "number", drop_null=True)
    named = long.withColumn("measure", C.map_values("measure", measures, keep_unmapped=False)).dropna(subset=["measure"])
    wide = named.groupBy(*ids, "month").pivot("measure", list(measures.values())).agg(F.sum("number")).fillna(0.0)
    kept = wide.join(out_of_scope, sku, "left_anti")
    split = shares.join(kept, sku, "left").dropna(subset=["month"])
    return split.select(
        sku, "channel", "month", *[(F.col(m) * F.col("split_ratio")).alias(m) for m in measures.values()]
    )


def unified_blocks(
    sheet: DataFrame, ids: Sequence[str], blocks: Mapping[str, Sequence[str]], months: Sequence[str], products: DataFrame,
    key: str, kinds: Mapping[str, str], stock_kinds: Sequence[str], total: str = "Total",
) -> DataFrame:
    """Side-by-side channel blocks to rows; cells cleaned, stock kept for the total only, kinds side by side."""
    long = unpivot_blocks(sheet, ids, blocks, "channel", months)
    cells = unpivot_long(long, [*ids, "channel"], ticked(months), "month", "cell")
    numbers = cells.withColumn("number", C.cell_to_number("cell")).dropna(subset=["number"])
    kept = numbers.filter(~F.col("kind").isin(*stock_kinds) | (F.col("channel") == total))
    named = lookup(kept.withColumn("kind", C.map_values("kind", kinds)), products, key, "inner")
    return named.groupBy("sku", "channel", "month").pivot("kind", list(kinds.values())).agg(F.sum("number")).fillna(0.0)
