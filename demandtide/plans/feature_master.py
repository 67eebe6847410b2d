"""Feature masters: parameter lists over the panel operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from demandtide.functions.periods import idx_month
from demandtide.operators import panel as P
from demandtide.session import written


@dataclass(frozen=True)
class FeatureSpec:
    """Columns and parameters of a feature master."""

    keys: Sequence[str]
    measures: Sequence[str] = ()
    diffs: Sequence[int] = ()
    groups: Sequence[str] = ()
    lags: Sequence[int] = ()
    diff_lags: Sequence[int] = ()
    rolled: dict[str, Sequence[int]] = field(default_factory=dict)
    cumulated: Sequence[str] = ()
    deltas: Sequence[tuple[str, str, str]] = ()
    first_sale: bool = False
    shares: bool = False
    codes: Sequence[str] = ()


# Window sizes, lags and difference periods of the two masters.
IL_DIFFS = (1, 12, 11, 10, 9, 8, 7, 6, 5, 4)
IL_LAGS = (0, 1, 2)
IL_DIFF_LAGS = (3, 4, 5, 6, 7, 8, 9, 10, 11)
IL_WINDOWS = (3, 6, 9, 12)
DC_WINDOWS = {"offtake_dc": (3, 6, 9), "anp": (3, 6), "sellin_dc": (3, 6), "sellout": (3, 6), "sellout_revenue": (3, 6), "sellout_price": (3, 6)}


def il_spec(
    keys: Sequence[str],
    labels: Sequence[str] = ("di", "eib", "il"),
    groups: Sequence[str] = ("stage", "tier", "brand", "country"),
    codes: Sequence[str] = (),
    diffs: Sequence[int] = IL_DIFFS,
    windows: Sequence[int] = IL_WINDOWS,
    diff_lags: Sequence[int] = IL_DIFF_LAGS,
) -> FeatureSpec:
    offtake = [f"offtake_{label}" for label in labels]
    sellin = [f"sellin_{label}" for label in labels]
    measures = [*offtake, *sellin]
    rolled = {m: windows for m in measures}
    rolled |= {f"share_of_total_{m}": windows for m in offtake}
    rolled |= {f"{kind}_diff1_{m}": windows for m in offtake for kind in ("abs", "rel")}
    rolled |= {f"offtake_sellin_delta_{label}": windows for label in labels}
    return FeatureSpec(
        keys=keys, measures=measures, diffs=diffs, groups=groups, lags=IL_LAGS, diff_lags=diff_lags, rolled=rolled,
        cumulated=measures, deltas=[(f"sellin_{x}", f"offtake_{x}", f"offtake_sellin_delta_{x}") for x in labels],
        first_sale=True, shares=True, codes=codes,
    )


def dc_spec(keys: Sequence[str], codes: Sequence[str] = ()) -> FeatureSpec:
    return FeatureSpec(keys=keys, rolled=DC_WINDOWS, cumulated=("offtake_dc", "sellin_dc", "sellout"), codes=codes)


def feature_master(df: DataFrame, month: str, spec: FeatureSpec) -> DataFrame:
    """All features of a specification on a panel of one row per series and month.

    The panel is stored first, as every total and code list reads it again. The
    joins with month and group totals come next and are stored as well; the
    ordered windows after them share one partitioning and one sort order.
    """
    keys = list(spec.keys)
    out = written(df, "panel") if spec.shares or spec.codes else df
    if spec.shares:
        out = P.date_totals(out, month, spec.measures)
        out = P.share_of_total(out, month, spec.measures)
        out = P.share_of_group(out, month, spec.groups, spec.measures)
    if spec.codes:
        out = P.encode_categories(out, spec.codes)
    if spec.shares or spec.codes:
        out = written(out, "panel")
    if spec.first_sale:
        out = P.months_since_first(out, keys, month, spec.measures)
    if spec.diffs:
        out = P.diff_features(out, keys, month, spec.measures, spec.diffs)
    for minuend, subtrahend, name in spec.deltas:
        out = P.cumulative_delta(out, keys, month, minuend, subtrahend, name)
    if spec.lags:
        out = P.lagged_features(out, keys, month, spec.measures, spec.lags)
    if spec.diff_lags:
        out = P.lagged_features(out, keys, month, [f"abs_diff1_{m}" for m in spec.measures], spec.diff_lags)
    for sizes in sorted(set(map(tuple, spec.rolled.values()))):
        columns = [c for c, s in spec.rolled.items() if tuple(s) == sizes]
        out = P.rolled_values(out, keys, month, columns, sizes)
    if spec.cumulated:
        out = P.cumulative_minmax(out, keys, month, spec.cumulated)
    return out.withColumn("month_int", idx_month(month)).withColumn("month_cat", idx_month(month) - 1)
