"""Rules of the trade flow against a plain loop over rows and rules."""

import random

from demandtide.plans import flows

ROWS = "feed string, sku string, party string, plant string, state string, m int, quantity double, status string"


def claimed(row, rules, cycle):
    feed, _, party, plant, state, m, _, _ = row
    best = None
    for k, r in enumerate(rules):
        fits = r.feed == feed and (not r.states or state in r.states) and (not r.parties or party in r.parties) and party not in r.other_parties
        fits = fits and (not r.plants or plant in r.plants) and plant not in r.other_plants
        fits = fits and (r.first is None or (m is not None and m - cycle >= r.first)) and (r.last is None or (m is not None and m - cycle <= r.last))
        if fits and (best is None or (r.priority, k) < best[0]):
            best = (r.priority, k), r
    return best[1] if best and best[1].kind else None


def test_rows_follow_the_first_rule_that_fits(spark):
    rng, cycle = random.Random(4), 24000
    rules = flows.di_rules() + [flows.Rule("u1_sellin", "returns", "U1", sign=-1.0, states=("back",)), flows.Rule("u1_sellin", "late", states=("back",), priority=100)]
    feeds = sorted({r.feed for r in rules}) + ["unknown", None]
    states = [flows.SHIPPED, flows.GOOD, flows.SCRAP[2], flows.TOTAL_STATE, "back", None]
    rows = [
        (rng.choice(feeds), f"s{rng.randrange(5)}", rng.choice(["YUNJI", "pop", "a", None]), rng.choice([flows.PLANT, "x", None]), rng.choice(states), rng.choice([None, *range(cycle - 4, cycle + 6)]), float(rng.randrange(1, 50)), "raw")
        for _ in range(4000)
    ]
    got = flows.ruled(spark.createDataFrame(rows, ROWS), rules, cycle).collect()
    want = [(row, r) for row in rows if (r := claimed(row, rules, cycle))]
    assert len(want) > 300 and {r.kind for _, r in want} >= {"sellin", "offtake", "sp_inv", "returns"} and all(r.kind != "late" for _, r in want)
    key = lambda t: tuple(map(str, t))
    assert sorted(((g.feed, g.sku, g.party, g.plant, g.state, g.m, g.quantity, g.type, g.sp, g.status, g.default_channel) for g in got), key=key) == sorted(
        ((f, s, p, pl, st, cycle + r.stamp if r.stamp is not None else m, q * r.sign, r.kind, r.provider, r.status, r.channel) for (f, s, p, pl, st, m, q, _), r in want), key=key
    )


def test_lags_move_all_windows():
    now, before = flows.di_rules(0), flows.di_rules(1)
    actual = [(r.feed, r.first, r.last) for r in now if r.kind == "offtake"]
    assert [(f, a + 1, b + 1) for f, a, b in actual] == [(r.feed, r.first, r.last) for r in before if r.kind == "offtake"]
    plans = lambda rules: {(r.plants, r.last) for r in rules if r.status == "forecasted"}
    assert plans(now) == {((flows.PLANT,), 3), ((), 4)} and plans(before) == {((flows.PLANT,), 2), ((), 3)}
    assert len({r.feed for r in now if r.kind}) == 11  # ten feeds and the one that replaces a retailer


def test_channels_names_and_tons(spark):
    rows = [("u1_offtake", "A", "ali", "x", None, 23999, 10.0, ""), ("u1_offtake", "A", None, "x", None, 23999, 5.0, ""), ("u1_offtake", "B", "ali", "x", None, 23998, 7.0, ""), ("u1_offtake", "A", "ali", "x", None, 24000, 99.0, "")]
    frame = spark.createDataFrame(rows, ROWS)
    channels = spark.createDataFrame([("u1_offtake", "ali", "ALI")], "feed string, party string, channel string")
    names = spark.createDataFrame([("u1_offtake", "A", "s")], "feed string, feed_sku string, sku string")
    products = spark.createDataFrame([("other", "name")], "sku string, name string")
    grams = spark.createDataFrame([("s", 1e6)], "sku string, grams double")
    out = flows.trade_flow(frame, flows.di_rules(), 24000, channels, names, products, grams).collect()
    assert {(r.channel, r.quantity, r.name, r.m) for r in out} == {("Ali", 10.0, None, 23999), ("BBC", 5.0, None, 23999)}
    assert {tuple(r) for r in flows.unmapped_parties(frame, channels).collect()} == set()
    assert flows.trade_flow(frame.limit(0), flows.di_rules(), 24000, channels, names, products, grams).count() == 0
