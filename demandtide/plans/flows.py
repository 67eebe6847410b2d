"""The trade flow: ten feeds of two service providers in one long table.

What a feed contributes is a table of rules: by feed, state, party, plant and month a
rule says type, provider, status, month stamp, sign and default channel of a row, or
that the row is dropped. All feeds are stacked and meet the rules in one pass; a row
that several rules claim follows the one of the highest priority.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.functions import cleaning as C
from demandtide.operators.aggregating import group_sum
from demandtide.operators.joining import dealt_lookup, lookup

#: Rules are broadcast by feed; more than this many are refused.
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """Months count from the cycle, both ends included; empty lists and None stand for any. ``kind`` None drops the row.

    ``stamp`` is the month, from the cycle, that the row is moved to. The smallest
    ``priority`` wins; of equal ones the rule that stands first.
    """

    feed: str
    kind: str | None
    provider: str | None = None
    status: str = "actual"
    first: int | None = None
    last: int | None = None
    states: tuple[str, ...] = ()
    parties: tuple[str, ...] = ()
    other_parties: tuple[str, ...] = ()
    plants: tuple[str, ...] = ()
    other_plants: tuple[str, ...] = ()
    stamp: int | None = None
    channel: str = "Total"
    sign: float = 1.0
    priority: int = 100


# States, parties and plants as the feeds spell them, and the channels of retailers without a mapping.
SHIPPED = "已发货"
GOOD = "正品"
SCRAP = ("待销毁", "待销毁冻结", "废品", "残次品", "临期冻结")
TOTAL_STATE = "TTL"
PLANT = "Aintree"
OWN_STOCK = "pop"
REPLACED = "YUNJI"
DEFAULT_CHANNEL = {"U1": "BBC", "Yuou": "Distribution"}
CHANNEL_NAMES = {"ALI": "Ali", "New channel": "NewChannel"}


def di_rules(lag: int = 0) -> list[Rule]:
    """Rules of the ten feeds. ``lag`` is the cycle's lag in months: actuals run from two to one month before it, plans up to four after it."""
    recent, oldest = lag - 1, lag - 2
    near, far = 3 - lag, 4 - lag
    rules = []
    for provider, feed in (("U1", "u1"), ("Yuou", "yuou")):
        base = Rule("", None, provider, channel=DEFAULT_CHANNEL[provider])
        shipped = () if feed == "u1" else (SHIPPED,)
        rules += [
            replace(base, feed=f"{feed}_sellout", kind="sellout", first=oldest, last=oldest, states=(SHIPPED,)),
            replace(base, feed=f"{feed}_offtake", kind="offtake", first=oldest, last=recent, states=shipped),
            replace(base, feed=f"{feed}_retailer_inv", kind="retailer_inv", first=oldest, last=oldest, channel="Total"),
        ]
        plan = replace(base, feed=f"{feed}_sellin", kind="sellin", states=(TOTAL_STATE,), channel="Total")
        rules += [
            replace(plan, first=oldest, last=oldest),
            replace(plan, status="forecasted", first=oldest + 1, last=near, plants=(PLANT,)),
            replace(plan, status="forecasted", first=oldest + 1, last=far, other_plants=(PLANT,)),
        ]
    stock = Rule("", "sp_inv", stamp=oldest)
    rules += [
        replace(stock, feed="u1_sp_inv", provider="U1", states=(GOOD,), other_parties=(OWN_STOCK,)),
        replace(stock, feed="yuou_sp_inv", provider="Yuou", states=SCRAP),
        # one retailer's rows come from a feed of their own
        Rule("yuou_offtake", None, parties=(REPLACED,), priority=1),
        Rule("yuou_replaced", "offtake", "Yuou", first=oldest, last=recent, states=(SHIPPED,), channel=DEFAULT_CHANNEL["Yuou"]),
    ]
    return rules


_RULE = (
    "priority int, place int, feed string, kind string, provider string, status string, first int, last int, states array<string>, parties array<string>,"
    " other_parties array<string>, plants array<string>, other_plants array<string>, stamp int, channel string, sign double"
)


def _fits(rule: Column, distance: Column) -> Column:
    """Null cells fit lists that are empty and lists of what is left out."""

    def among(column: str, names: Column) -> Column:
        return (F.size(names) == 0) | F.coalesce(F.array_contains(names, F.col(column)), F.lit(False))

    def outside(column: str, names: Column) -> Column:
        return ~F.coalesce(F.array_contains(names, F.col(column)), F.lit(False))

    timely = (rule["first"].isNull() | F.coalesce(distance >= rule["first"], F.lit(False))) & (rule["last"].isNull() | F.coalesce(distance <= rule["last"], F.lit(False)))
    named = among("state", rule["states"]) & among("party", rule["parties"]) & outside("party", rule["other_parties"])
    return timely & named & among("plant", rule["plants"]) & outside("plant", rule["other_plants"])


def ruled(rows: DataFrame, rules: Sequence[Rule], cycle: int) -> DataFrame:
    """``rows`` (feed, state, party, plant, m, quantity and more) that a rule keeps, with its type, sp, status, default_channel, month and sign applied.

    The rules of a feed travel as one list that is broadcast, so the rows are neither
    sorted nor shuffled, and a feed with most of the rows stays spread out. Rows that
    no rule claims go.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES}")
    cells = [{**asdict(r), "place": k} for k, r in enumerate(rules)]
    frame = rows.sparkSession.createDataFrame([{**c, **{n: list(v) for n, v in c.items() if isinstance(v, tuple)}} for c in cells], _RULE)
    by_feed = frame.groupBy("feed").agg(F.array_sort(F.collect_list(F.struct(*[c for c in frame.columns if c != "feed"]))).alias("rules"))
    met = rows.join(F.broadcast(by_feed), "feed")
    # sorted by priority and place, so the first that fits decides
    claimed = met.withColumn("rule", F.get(F.filter("rules", lambda r: _fits(r, F.col("m") - cycle)), F.lit(0))).filter(F.col("rule.kind").isNotNull())
    kept = [c for c in rows.columns if c not in ("m", "quantity", "status")]
    return claimed.select(
        *kept, F.coalesce(F.col("rule.stamp") + F.lit(cycle), F.col("m")).alias("m"), (F.col("quantity") * F.col("rule.sign")).alias("quantity"),
        F.col("rule.kind").alias("type"), F.col("rule.provider").alias("sp"), F.col("rule.status").alias("status"), F.col("rule.channel").alias("default_channel"),
    )


def unmapped_parties(rows: DataFrame, channels: DataFrame) -> DataFrame:
    """Distinct (feed, party) that the channel mapping does not know, for the report beside the job."""
    return rows.select("feed", "party").dropna().distinct().join(channels, ["feed", "party"], "left_anti")


def trade_flow(rows: DataFrame, rules: Sequence[Rule], cycle: int, channels: DataFrame, names: DataFrame, products: DataFrame, grams: DataFrame) -> DataFrame:
    """sku, sp, type, channel, status, m and the columns of ``products``, quantity in tons.

    ``rows``: feed, sku (as the feed spells it), party, plant, state, m, quantity.
    ``channels`` (feed, party, channel) names a retailer's channel, ``names``
    (feed, feed_sku, sku) the standard product; feeds without a party in the mapping fall to
    their rule's channel, rows without a standard product go. ``products`` (sku, ...) and ``grams``
    (sku, grams) may lack a product: its attributes, and its tons, are null then.
    Sums come before the lookups of products, which then meet one row per key. Mappings with
    rows per product (names, products, grams) are never broadcast.
    """
    known = ruled(rows.withColumnRenamed("sku", "feed_sku"), rules, cycle)
    # partial sums by what the lookups need, so that a busy retailer or product meets them as few rows
    sums = known.groupBy("feed", "feed_sku", "party", "sp", "type", "status", "default_channel", "m").agg(F.sum("quantity").alias("quantity"))
    named = dealt_lookup(lookup(sums, channels, ["feed", "party"], "left"), names, ["feed", "feed_sku"], "inner")
    channel = C.map_values(F.coalesce("channel", "default_channel"), CHANNEL_NAMES)
    flow = group_sum(named.withColumn("channel", channel), ["sku", "sp", "type", "channel", "status", "m"], ["quantity"])
    full = dealt_lookup(dealt_lookup(flow, products, "sku", "left"), grams, "sku", "left")
    return full.withColumn("quantity", C.tins_to_tons("quantity", "grams")).drop("grams")
