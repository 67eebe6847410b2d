"""Sheets as cells, row numbers and back-off shares against plain versions."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from demandtide.plans import sheets, unified

CELLS = "sheet string, row long, col long, text string"


def frame(spark, grids):
    return spark.createDataFrame([(s, r, c, t) for s, grid in grids.items() for r, line in enumerate(grid) for c, t in enumerate(line) if t is not None], CELLS).repartition(3)


TWO = [
    ["made by hand", None, None, None, None, None, None],
    [None, "Absolute", None, "Share", None, "Absolute", None],
    ["brand", "2001", "2002", "2001", "2002", "2001", " 2002 "],
    ["A", "9", "9", "1%", "2%", "1,200.5", "x"],
    ["Total", "9", "9", "1%", "2%", "7", "7"],
    ["B", "9", "9", "1%", "2%", None, "30"],
]


def test_last_block_of_merged_headers(spark):
    mapping = spark.createDataFrame([("t", 4, "A"), ("t", 6, "B"), ("t", 99, "C"), ("u", 4, "D"), ("t", None, "E")], "sheet string, row_no int, brand string")
    got = {(r.brand, r.month, r.value) for r in sheets.brand_sheets(frame(spark, {"t": TWO, "empty": [["x"]]}), mapping).collect()}
    assert got == {("A", 202001, 1200.5), ("A", 202002, 0.0), ("B", 202002, 30.0)}
    heads = {(r.col, r.upper, r.lower) for r in sheets.filled_headers(frame(spark, {"t": TWO})).collect()}
    assert heads == {(0, None, "brand"), (1, "Absolute", "2001"), (2, "Absolute", "2002"), (3, "Share", "2001"), (4, "Share", "2002"), (5, "Absolute", "2001"), (6, "Absolute", "2002")}
    assert sheets.brand_sheets(frame(spark, {"t": TWO}).limit(0), mapping).count() == 0


def test_date_row_is_found_and_ends_at_its_first_gap(spark):
    grid = [["x", "43831", None, None, None, None], [None] * 6, ["name", "43831", "43862", "43891", None, "43922"], ["A", "1", "-", None, "5", "6"], ["B", "2", "3", "4", "5", "6"]]
    mapping = spark.createDataFrame([("s", 4, "A"), ("s", 5, "B")], "sheet string, row_no int, brand string")
    got = {(r.brand, r.month, r.value) for r in sheets.serial_sheets(frame(spark, {"s": grid}), mapping, F.col("serial")).collect()}
    assert got == {("A", 43831, 1.0), ("A", 43862, 0.0), ("B", 43831, 2.0), ("B", 43862, 3.0), ("B", 43891, 4.0)}


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_numbers_do_not_depend_on_the_dealing(spark, parts):
    rng = random.Random(9)
    values = [(rng.choice([None, *"abc"]), rng.randrange(20)) for _ in range(300)]
    df = spark.createDataFrame(values, "k string, v int").repartition(parts)
    got = [(r.row, r.k, r.v) for r in sheets.numbered_rows(df, ["k"]).orderBy("row").collect()]
    want = sorted(values, key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    assert got == [(k, *t) for k, t in enumerate(want)]
    assert sheets.numbered_rows(df.limit(0), ["k"]).count() == 0


def test_unmatched_sides_stay_as_asked(spark):
    sheet = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "row long, text string")
    mapping = spark.createDataFrame([(2, "B"), (9, "Z"), (None, "N")], "row_no int, name string")
    rows = lambda keep: {(r.text, r.name) for r in sheets.rows_by_number(sheet, mapping, keep=keep).collect()}
    assert rows("matched") == {("b", "B")}
    assert rows("mapping") == {("b", "B"), (None, "Z"), (None, "N")}
    assert rows("sheet") == {("a", None), ("b", "B"), ("c", None)}
    assert rows("both") == {("a", None), ("b", "B"), ("c", None), (None, "Z"), (None, "N")}


def test_shares_back_off_and_sum_to_one(spark):
    rng = random.Random(6)
    members = [(g, m) for g in "abcd" for m in range(1 + "abcd".index(g) * 2)]
    history = [(g, m, ym, rng.choice([0.0, None, -3.0, float(rng.randrange(1, 9))])) for g, m in members if g != "d" for ym in (201901, 201902, 202001) if rng.random() < 0.6]
    history += [("a", 77, 201901, 50.0), ("b", 0, 201812, 4.0), ("b", 0, 201812, 2.0)]  # no member any more; only in another year
    asked = [(g, ym) for g in "abcde" for ym in (201901, 201903, 202001, 202105)] + [("a", None), (None, 201901), ("a", 201901)]
    got = unified.backoff_shares(
        spark.createDataFrame(asked, "g string, ym int"), spark.createDataFrame(history, "g string, m int, ym int, v double"), spark.createDataFrame(members + [("c", 0)], "g string, m int"), ["g"], ["m"], "ym", "v"
    ).collect()
    sums = defaultdict(float)
    for r in got:
        sums[r.g, r.ym] += r.share
        own = lambda fits: sum(max(v or 0, 0) for g, m, ym, v in history if g == r.g and m != 77 and fits(ym))
        levels = [own(lambda ym: ym == r.ym), own(lambda ym: ym // 100 == r.ym // 100), own(lambda ym: True), 1.0]
        level = next(k for k, total in enumerate(levels) if total > 0) + 1
        assert r.level == level
        if level == 4:
            assert r.share == pytest.approx(1 / sum(g == r.g for g, _ in members))
    assert set(sums) == {(g, ym) for g in "abcd" for ym in (201901, 201903, 202001, 202105)} and all(v == pytest.approx(1) for v in sums.values())
