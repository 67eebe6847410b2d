"""Unified view of the whole label: stage volumes and sell-in spread over products and channels.

A stage's volume is dealt by what its products sold per channel: in the same month, else
in the same year, else at any time, else in equal parts. All levels come from one
aggregate of the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from demandtide.functions import cleaning as C
from demandtide.operators.aggregating import group_sum
from demandtide.operators.joining import dealt_lookup, lookup
from demandtide.operators.panel import fill_down
from demandtide.operators.reshaping import unpivot_long
from demandtide.session import written

MONTH, YEAR, EVER, EQUAL = 1, 2, 3, 4


def backoff_shares(wanted: DataFrame, history: DataFrame, members: DataFrame, group: Sequence[str], member: Sequence[str], month: str, value: str) -> DataFrame:
    """``group``, ``month``, ``member``, share, level for every group and month of ``wanted``; the shares of a group and month sum to one.

    ``history`` holds ``group``, ``member``, ``month`` (yyyymm) and ``value``; ``members``
    all members of a group. The level is the first of month, year and all time whose
    values in the group sum to more than zero, else equal parts of all members. Rows of
    history whose member is not among ``members`` are left out, null and negative values
    count as zero. A group without members has no shares.

    One pass sums the history by level and bucket with partial sums; what is wanted, a row a
    group and month, then picks its level, and only rows of that level are fetched. Members
    are never broadcast.
    """
    keys, who = list(group), list(member)
    known = members.select(*keys, *who).dropna().distinct()
    levels = F.array(
        F.struct(F.lit(MONTH).alias("level"), F.col(month).alias("bucket")), F.struct(F.lit(YEAR).alias("level"), F.floor(F.col(month) / 100).cast("int").alias("bucket")),
        F.struct(F.lit(EVER).alias("level"), F.lit(0).alias("bucket")),
    )
    sold = history.select(*keys, *who, F.col(month).cast("int").alias(month), F.greatest(F.coalesce(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("v")).filter("v > 0")
    spread = sold.select(*keys, *who, "v", F.explode(levels).alias("l")).select(*keys, *who, "v", "l.level", "l.bucket")
    cube = spread.groupBy(*keys, *who, "level", "bucket").agg(F.sum("v").alias("v")).join(known.hint("merge"), [*keys, *who], "left_semi")
    cube = written(cube, "share-levels")
    totals = cube.groupBy(*keys, "level", "bucket").agg(F.sum("v").alias("total"))
    asked = wanted.select(*keys, F.col(month).cast("int").alias(month)).dropna().distinct()
    found = asked.select("*", F.explode(levels).alias("l")).select(*keys, month, "l.level", "l.bucket").join(totals, [*keys, "level", "bucket"])
    best = found.groupBy(*keys, month).agg(F.min(F.struct("level", "bucket", "total")).alias("b")).select(*keys, month, "b.*")
    dealt = best.join(cube, [*keys, "level", "bucket"]).select(*keys, month, *who, (F.col("v") / F.col("total")).alias("share"), "level")
    sizes = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rest = asked.join(best.select(*keys, month), [*keys, month], "left_anti").join(sizes, keys).join(known.hint("merge"), keys)
    equal = rest.select(*keys, month, *who, (F.lit(1.0) / F.col("_n")).alias("share"), F.lit(EQUAL).alias("level"))
    return dealt.unionByName(equal)


def stage_volumes(sheet: DataFrame, sheet_key: str, months: Sequence[str], value: str = "offtake") -> DataFrame:
    """section, stage, ym, value of a sheet whose stage rows stand below a row that names their section."""
    filled = fill_down(sheet, sheet_key, "row_no", "section_name", "section").filter(F.col("stage").isNotNull())
    long = unpivot_long(filled, ["section", "stage"], [f"`{c}`" for c in months], "ym", value, drop_null=True)
    return long.withColumn("ym", F.col("ym").cast("int"))


def described_sellin(sheet: DataFrame, months: Sequence[str]) -> DataFrame:
    """description, ym, sellin: text cells as numbers, rows of one description summed, others' dropped where it is null."""
    long = unpivot_long(sheet.filter(F.col("description").isNotNull()), ["description"], [f"`{c}`" for c in months], "ym", "cell")
    numbers = long.select("description", F.col("ym").cast("int").alias("ym"), C.coalesce_zero(C.cell_to_number("cell")).alias("sellin"))
    return group_sum(numbers, ["description", "ym"], ["sellin"])


def unified_il(offtake: DataFrame, sellin: DataFrame, products: DataFrame, channels: Sequence[str], history: DataFrame, uplift: DataFrame) -> DataFrame:
    """section, stage, sku, country, channel, ym, offtake, sellin, total_offtake, level.

    ``offtake``: section, stage, ym, offtake. ``products``: section, stage, sku, country,
    description (of the stage in the sell-in sheet). ``history``: section, stage, sku,
    channel, ym, volume. ``uplift``: country, channel, ym, uplift; none counts as zero, and the
    total is the offtake raised by it. Stages without sell-in get zero. Stages that no product has are dropped.
    """
    keys = ["section", "stage"]
    stages = products.groupBy(*keys).agg(F.min("description").alias("description"))
    volumes = lookup(lookup(offtake, stages, keys, "inner"), sellin, ["description", "ym"], "left").withColumn("sellin", C.coalesce_zero("sellin"))
    members = products.select(*keys, "sku", F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"))
    shares = backoff_shares(volumes, history, members, keys, ["sku", "channel"], "ym", "volume")
    spread = lookup(shares, volumes.drop("description"), [*keys, "ym"], "inner")
    raised = lookup(dealt_lookup(spread, products.select(*keys, "sku", "country"), [*keys, "sku"], "left"), uplift, ["country", "channel", "ym"], "left")
    own = F.col("offtake") * F.col("share")
    return raised.select(
        *keys, "sku", "country", "channel", "ym", own.alias("offtake"), (F.col("sellin") * F.col("share")).alias("sellin"),
        (own * (1 + C.coalesce_zero("uplift"))).alias("total_offtake"), "level",
    )
