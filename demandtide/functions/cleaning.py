"""Text and number cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Cell contents that mean "no number".
EMPTY_CELLS = ("-", "#DIV/0!", "")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_number(text: Column | str) -> Column:
    """Number from text with thousands commas; null when it is not a number."""
    return F.regexp_replace(F.trim(_c(text)), ",", "").try_cast("double")


def cell_to_number(text: Column | str) -> Column:
    """As ``to_number``, with placeholder cells read as zero."""
    trimmed = F.trim(_c(text))
    return F.when(trimmed.isin(*EMPTY_CELLS), F.lit(0.0)).otherwise(to_number(trimmed))


def ratio(num: Column | str, den: Column | str, default: float | None = None) -> Column:
    """Division that yields ``default`` (or null) on a zero or missing denominator."""
    out = F.try_divide(_c(num), _c(den))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def round_places(value: Column | str, places: int = 4) -> Column:
    """Half-up rounding by plain arithmetic, equal on any engine with IEEE doubles."""
    scale = float(10**places)
    return F.floor(_c(value) * scale + 0.5) / F.lit(scale)


def round_half_even(value: Column | str, places: int = 4) -> Column:
    return F.bround(_c(value), places)


def sink_number(value: Column | str) -> Column:
    """Number as written to the warehouse: six places, and tiny negatives as zero."""
    value = _c(value)
    return F.when((value < 0) & (value > -1e-6), F.lit(0.0)).otherwise(round_places(value, 6))


def first_keyword(text: Column | str, keywords: Mapping[str, str], default: str | None = None) -> Column:
    """Class of the first keyword (in mapping order) contained in the text."""
    text = _c(text)
    branches = [F.when(text.contains(word), F.lit(cls)) for word, cls in keywords.items()]
    return F.coalesce(*branches, F.lit(default).cast("string"))


def last_keyword(text: Column | str, keywords: Mapping[str, str], default: str | None = None) -> Column:
    """Class of the last keyword (in mapping order) contained in the text."""
    return first_keyword(text, dict(reversed(list(keywords.items()))), default)


def last_token(text: Column | str, tokens: Sequence[str], default: str | None = None) -> Column:
    return last_keyword(text, {token: token for token in tokens}, default)


def concat_key(*cols: Column | str, sep: str = "_") -> Column:
    """Key of joined parts; null when any part is null."""
    parts = [_c(col).cast("string") for col in cols]
    joined = [parts[0]] + [piece for part in parts[1:] for piece in (F.lit(sep), part)]
    return F.concat(*joined)


def strip_leading_zeros(text: Column | str) -> Column:
    return F.regexp_replace(F.trim(_c(text)), "^0+", "")


def map_values(col: Column | str, mapping: Mapping[str, str], keep_unmapped: bool = True) -> Column:
    """Replace by a short driver-side dictionary."""
    col = _c(col)
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    mapped = F.try_element_at(F.create_map(*pairs), col)
    return F.coalesce(mapped, col) if keep_unmapped else mapped


def signed_quantity(quantity: Column | str, order_type: Column | str, return_types: Sequence[str]) -> Column:
    """Quantity with the sign turned for return orders."""
    quantity = _c(quantity)
    return F.when(_c(order_type).isin(*return_types), -quantity).otherwise(quantity)


def tins_to_tons(quantity: Column | str, grams: Column | str) -> Column:
    return _c(quantity) * _c(grams) / F.lit(1e6)


def pick_by_key(key: Column | str, choices: Mapping[str, str]) -> Column:
    """Value of the column that the key names."""
    key = _c(key)
    return F.coalesce(*[F.when(key == value, F.col(col)) for value, col in choices.items()])


def coalesce_zero(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(0.0))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
