"""Feature layers: one registered query per layer (keys + the layer's columns)."""

from __future__ import annotations

from tillcast.catalog.queries_core import prepared
from tillcast.catalog.registry import register, rounded, sql_round
from tillcast.catalog.sqlbase import with_panel
from tillcast.catalog.sqlfeatures import features_cte
from tillcast.operators.features import DRIVER_CATALOG as CAT
from tillcast.operators.features import build_features

KEYS = ["store_id", "item_id", "date"]
TEXT = {"city", "state", "component_group"}

LAYERS = {
    "b01_structural_means": ["struct_rimdow", "struct_rim", "struct_cmdow", "q4_hist_ri",
                             "struct_rimdow_q4", "q4_cmdow"],
    "b06_holiday_lifts": ["holiday_mult", "cat_holiday_mult", "struct_x_holiday"],
    "b08_weather_layer": ["cat_temp_elasticity", "temp_deviation", "weather_impact", "cat_temp_interaction",
                          "temp_freezing", "temp_cold", "temp_mild", "has_precip", "heavy_precip"],
    "b13_event_mult": ["event_mult", "struct_x_event"],
    "b14_store_growth_mult": ["store_growth_mult"],
    "b15_promo_lift_cat": ["promo_lift_cat"],
    "w1_lags": ["lag_7", "lag_14", "lag_364", "lag_365", "lag_728", "lag_7_filled", "lag_14_filled",
                "yoy_growth", "yoy_ratio"],
    "w2_rolling_28": ["rolling_mean_28", "rolling_std_28"],
    "b20_calendar_fourier": ["day_of_year", "week_of_year", "day_of_month", "days_from_thanksgiving",
                             "days_from_christmas", "is_thanksgiving_week", "is_black_friday",
                             "is_christmas_week", "is_new_year_period", "dow_x_month", "days_from_payday",
                             "is_payday_window", "is_month_start", "is_month_end",
                             "sin_1", "cos_1", "sin_2", "cos_2", "sin_3", "cos_3"],
    "b23_season_trend": ["q4_trend_ratio", "struct_rimdow_trended"],
    "b28_target_encoding": ["target_enc_rim", "target_enc_ridow"],
    "b30_weather_memory": ["temp_lag1", "temp_rolling3"],
    "b32_promo_count_cat": ["promo_count_cat"],
    "b33_item_cv": ["item_cv"],
    "b34_label_codes": ["restaurant_enc", "menu_item_enc", "category_enc", "precip_type_enc"],
    "c01_store_dims": ["city", "state", "city_enc", "state_enc", "n_restaurants_city", "n_restaurants_state"],
    "c02_demand_indexes": ["city_demand_idx", "state_demand_idx", "cat_chain_demand_idx",
                           "component_demand_idx", "state_item_demand_idx"],
    "c04_shares": ["rest_city_share", "item_category_share", "cat_rest_share", "item_component_share"],
    "c09_component_group": ["component_group", "component_group_enc"],
    "c12_pair_ratios": CAT.size_ratio_names() + CAT.combo_ratio_names(),
    "c15_rest_vs_state_ratio": ["rest_vs_state_ratio"],
    "c16_price_position": ["price_vs_cat_avg", "price_tier"],
}


_MEMO: dict = {}


def features(spark, sf):
    """The staged feature table, built once per session and scale directory.

    ``build_features`` checkpoints its result into the shared checkpoint
    folder; the registered queries all read that one written table.
    """
    key = (id(spark), spark.sparkContext.applicationId, sf)
    if key not in _MEMO:
        _MEMO[key] = build_features(prepared(spark, sf))
    return _MEMO[key]


def _make(key, cols):
    sql = with_panel(features_cte(CAT) + sql_round(
        f"SELECT {', '.join(KEYS + cols)} FROM FEATS", [c for c in cols if c not in TEXT]))

    @register(key, sql)
    def q(spark, sf):
        return rounded(features(spark, sf).select(*KEYS, *cols))
    q.__name__ = key
    return q


for _k, _cols in LAYERS.items():
    _make(_k, _cols)
