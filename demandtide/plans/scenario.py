"""Scenarios: actuals and forecasts under warehouse names, without overlap, stamped with their version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.functions.periods import idx_to_date
from demandtide.operators.aggregating import duplicate_keys
from demandtide.operators.joining import require_unique

# Warehouse column names and units per umbrella.
WAREHOUSE_NAMES = {
    "label": "lv3_pdt_brd_cod", "country": "cry_cod", "brand": "lv4_pdt_fam_cod", "tier": "lv5_pdt_sfm_cod", "stage": "lv6_pdt_nat_cod",
    "sku_wo_pkg": "mat_cod", "package": "pck_sku_cod", "channel": "dis_chl_cod", "offtake": "oft_trk_val", "sellin": "sal_ins_val",
    "sellout": "sal_out_val", "retailer_inv": "rtl_ivt_val", "sp_inv": "sup_ivt_val", "horizon": "frc_mth_nbr",
}
UNITS = {"IL": "tons", "DC": "tins"}
MEASURES = ("oft_trk_val", "sal_ins_val", "sal_out_val", "rtl_ivt_val", "sup_ivt_val")


def build_scenario(forecasts: DataFrame, actuals: DataFrame, granularity: Sequence[str], month: str = "m") -> DataFrame:
    """Forecasts from the first forecast month on, actuals before it; fails on a repeated key.

    Measures other than offtake are delivered as zero.
    """
    cut = forecasts.agg(F.min(month).alias("cut")).scalar()
    made = forecasts.withColumn("frc_flg", F.lit(True)).filter(F.col(month) >= cut)
    known = actuals.withColumn("frc_flg", F.lit(False)).filter(F.col(month) < cut)
    both = known.unionByName(made, allowMissingColumns=True)
    named = both.withColumnsRenamed({old: new for old, new in WAREHOUSE_NAMES.items() if old in both.columns})
    keys = [WAREHOUSE_NAMES.get(k, k) for k in granularity]
    filled = named.withColumn("oft_trk_val", F.coalesce("oft_trk_val", F.lit(0.0))).withColumns(
        {m: F.lit(0.0) for m in MEASURES if m != "oft_trk_val"}
    )
    return require_unique(filled, [*keys, month])


def scenario_duplicates(df: DataFrame, granularity: Sequence[str], month: str = "m") -> DataFrame:
    return duplicate_keys(df, [*[WAREHOUSE_NAMES.get(k, k) for k in granularity], month])


def stamp_scenario(df: DataFrame, umbrella: str, user: str, created_on: Column, month: str = "m") -> DataFrame:
    """Cycle date (the month before the first forecast horizon), unit, user and integer month date."""
    cycle = df.filter("frc_flg").agg(F.min(F.col(month) - F.col("frc_mth_nbr")).alias("cycle")).scalar()
    stamp = F.date_format(created_on, "yyyyMMdd").cast("int")
    return df.withColumns(
        {
            "cyc_dat": F.date_format(idx_to_date(cycle), "yyyyMMdd").cast("int"),
            "mea_dat": F.date_format(idx_to_date(month), "yyyyMMdd").cast("int"),
            "lv2_umb_brd_cod": F.lit(umbrella),
            "unit": F.lit(UNITS[umbrella]),
            "frc_usr_nam_dsc": F.lit(user),
            "frc_cre_dat": stamp,
        }
    ).drop(month)
