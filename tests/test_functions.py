import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandtide.functions import cleaning as C, periods as P


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_period_range_has_no_gap(spark):
    (months,) = one(spark, P.ym_range(F.lit(201601), F.lit(202012)))
    assert len(months) == 60 and months[0] == 201601 and months[12] == 201701 and months[-1] == 202012


@pytest.mark.parametrize("start,step,end", [(201912, 1, 202001), (202001, -1, 201912), (201801, 25, 202002), (202012, -12, 201912), (202012, 0, 202012)])
def test_shift(spark, start, step, end):
    shifted, h = one(spark, P.shift_ym(F.lit(start), step), P.horizon(F.lit(start), F.lit(end)))
    assert (shifted, h) == (end, step)


def test_month_index_round_trip(spark):
    out = one(spark, P.month_idx(F.lit("2019-12-31").cast("date")), P.idx_to_ym(F.lit(2019 * 12 + 12)), P.idx_to_date(F.lit(2019 * 12 + 12)), P.year_start_idx(F.lit(2019 * 12 + 12)))
    assert out == (2019 * 12 + 12, 201912, dt.date(2019, 12, 1), 2019 * 12 + 1)


def test_serial_dates_differ_by_two_days(spark):
    a, b = one(spark, P.serial_to_date(F.lit(43831), P.SERIAL_BASE_1900), P.serial_to_date(F.lit(43831), P.SERIAL_BASE_1899))
    assert (a - b).days == 2 and b == dt.date(2020, 1, 1)


def test_lunar_month_moves_past_the_24th(spark):
    assert one(spark, *[P.lunar_month(F.lit(y)) for y in (2018, 2019, 2020, 2023, 2026, 2028)]) == (2, 2, 2, 1, 2, 2)
    assert one(spark, P.lunar_month(F.lit(None).cast("int"))) == (None,)
    with pytest.raises(PySparkException):
        one(spark, P.lunar_month(F.lit(1900)))


# Week counts of months: a week belongs to the month of its Monday, week 1 to January.
@pytest.mark.parametrize("month,weeks", [("2018-01-01", [1, 2, 3, 4, 5]), ("2018-12-01", [49, 50, 51, 52]), ("2019-01-01", [1, 2, 3, 4, 5]), ("2020-12-01", [50, 51, 52, 53]), ("2021-01-01", [1, 2, 3, 4])])
def test_iso_weeks(spark, month, weeks):
    (found,) = one(spark, F.transform(P.iso_week_mondays(F.lit(month).cast("date")), F.weekofyear))
    assert found == weeks


def test_cycle_rules(spark):
    day = lambda s: F.lit(s).cast("date")
    assert one(spark, P.cycle_lag(day("2020-01-25")), P.cycle_lag(day("2020-01-26"))) == (0, 1)
    inside = P.in_cycle_window(day("2019-12-31"), day("2020-02-15"), -2, -1)
    outside = P.in_cycle_window(day("2020-02-01"), day("2020-02-15"), -2, -1)
    assert one(spark, inside, outside) == (True, False)


@pytest.mark.parametrize("text,day", [("March 2019", "2019-03-01"), ("Mar 2019", "2019-03-01"), ("201903", "2019-03-01"), ("3/7/2019", "2019-03-01"), ("2019-03-31", "2019-03-01"), ("soon", None)])
def test_parse_month(spark, text, day):
    (found,) = one(spark, P.parse_month(F.lit(text)))
    assert (found and found.isoformat()) == day


def test_numbers(spark):
    out = one(spark, C.to_number(F.lit(" 1,234.5 ")), C.to_number(F.lit("x")), C.cell_to_number(F.lit(" - ")), C.cell_to_number(F.lit("#DIV/0!")), C.cell_to_number(F.lit(None).cast("string")))
    assert out == (1234.5, None, 0.0, 0.0, None)


def test_ratio_and_sink(spark):
    out = one(spark, C.ratio(F.lit(1.0), F.lit(0.0)), C.ratio(F.lit(1.0), F.lit(0.0), 1), C.sink_number(F.lit(-1e-7)), C.sink_number(F.lit(-0.12345678)), C.round_half_even(F.lit(0.00125), 4))
    assert out == (None, 1.0, 0.0, -0.123457, 0.0012)


def test_keywords_first_and_last(spark):
    words = {"gold": "A", "silver": "B"}
    text = F.lit("silver gold")
    assert one(spark, C.first_keyword(text, words), C.last_keyword(text, words), C.first_keyword(F.lit("tin"), words, "none"), C.last_token(text, ["silver", "gold"])) == ("A", "B", "none", "gold")


def test_keys_and_maps(spark):
    out = one(spark, C.concat_key(F.lit("a"), F.lit("b")), C.concat_key(F.lit("a"), F.lit(None)), C.map_values(F.lit("x"), {"x": "y"}), C.map_values(F.lit("q"), {"x": "y"}), C.map_values(F.lit("q"), {"x": "y"}, keep_unmapped=False), C.strip_leading_zeros(F.lit("0070")))
    assert out == ("a_b", None, "y", "q", None, "70")


def test_return_sign(spark):
    assert one(spark, C.signed_quantity(F.lit(3.0), F.lit("ZRE"), ["ZRE"]), C.signed_quantity(F.lit(3.0), F.lit("OR"), ["ZRE"])) == (-3.0, 3.0)
