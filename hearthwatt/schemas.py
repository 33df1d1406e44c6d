"""Declared schemas and parameter defaults.

Every timestamp is a TIMESTAMP_NTZ that holds UTC, so no result depends on the session time zone. A ``site_id``
(or ``zone``) leads every key.
"""

from __future__ import annotations

from pyspark.sql import types as T

MEASURED = [
    "temperature_c", "dew_point_c", "relative_humidity", "pressure_hpa", "wind_speed_ms", "wind_direction_deg",
    "precip_mmph", "energy_today_wh", "pv_feed_in_w", "battery_soc_pct", "active_power_pcc_w", "bat_charge_w",
    "bat_discharge_w",
]
# Columns the averaging request may name; anything else is rejected.
ALLOWED_AVERAGES = [*MEASURED, "registers"]
# Averaged with plain means; wind speed and direction need the vector mean instead.
SCALARS = [c for c in MEASURED if not c.startswith("wind_")]
# Inverter register number of each typed column (fixed values).
REGISTER_COLUMNS = {
    "energy_today_wh": "30517",
    "pv_feed_in_w": "30775",
    "battery_soc_pct": "30845",
    "active_power_pcc_w": "31249",
    "bat_charge_w": "31393",
    "bat_discharge_w": "31395",
}
FORECAST_COLUMNS = [
    "temperature_c", "wind_speed_ms", "wind_direction_deg", "cloud_cover_pct", "shortwave_radiation_w_m2",
]
# Parameter names of the hourly weather document and the columns they become (fixed values).
FORECAST_PARAMETERS = {
    "Temperature": "temperature_c",
    "WindSpeedMS": "wind_speed_ms",
    "WindDirection": "wind_direction_deg",
    "TotalCloudCover": "cloud_cover_pct",
    "RadiationGlobal": "shortwave_radiation_w_m2",
    "RadiationGlobalAccumulation": "radiation_accum_j_m2",
}
# Wide-series name of each measured column. None marks a column of the 22-column contract that no source fills.
STATION_FUSION_COLUMNS = {
    "temperature_c": "temperature_c",
    "dew_point_c": "dew_point_c",
    "humidity_pct": "relative_humidity",
    "pressure_hpa": "pressure_hpa",
    "wind_speed_ms": "wind_speed_ms",
    "wind_direction_deg": "wind_direction_deg",
    "wind_gust_ms": None,
    "precipitation_mm_h": "precip_mmph",
    "pv_feed_in_w": "pv_feed_in_w",
    "pv_generation_w": None,
    "grid_import_w": None,
    "active_power_pcc_w": "active_power_pcc_w",
    "battery_soc_pct": "battery_soc_pct",
    "load_power_w": None,
}
FUSION_COLUMNS = (
    ["ts", "price_eur_per_mwh", "price_updated_at"]
    + [f"fc_{c}" for c in FORECAST_COLUMNS]
    + [f"station_{c}" for c in STATION_FUSION_COLUMNS]
)
DISPLAY_COLUMNS = [
    "fc_temperature_c", "station_temperature_c", "fc_wind_speed_ms", "station_wind_speed_ms",
    "fc_wind_direction_deg", "station_wind_direction_deg", "fc_cloud_cover_pct", "fc_shortwave_radiation_w_m2",
    "station_pv_feed_in_w", "station_active_power_pcc_w", "station_battery_soc_pct",
]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, D, L, N = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()

WEATHER_DOC = _struct(("site_id", S), ("ts", N), *[(c, D) for c in MEASURED[:7]])
INVERTER_DOC = _struct(("site_id", S), ("ts", N), ("registers_json", S))
TELEMETRY = _struct(
    ("site_id", S), ("ts", N), *[(c, D) for c in MEASURED[:7]], *[(c, L) for c in MEASURED[7:]],
    ("registers", T.MapType(S, D)), ("merged_at", N), ("pushed_at", N),
)
STATION_15MIN = _struct(
    ("site_id", S), ("ts", N), *[(c, D) for c in MEASURED], ("registers", T.MapType(S, D)),
    ("created_at", N), ("updated_at", N),
)
PRICES = _struct(("zone", S), ("ts", N), ("price_eur_per_mwh", D), ("created_at", N), ("updated_at", N))
FORECAST_HOURLY = _struct(("site_id", S), ("ts", N), *[(c, D) for c in FORECAST_COLUMNS], ("radiation_accum_j_m2", D))
FORECAST_RUN = _struct(
    ("run_id", S), ("site_id", S), ("model_name", S), ("model_version", S), ("issued_at", N), ("ratio_source", S),
    ("notes", S),
)
FORECAST_VALUE = _struct(
    ("run_id", S), ("site_id", S), ("target", S), ("target_ts", N), ("yhat_p50", D), ("yhat_p10", D), ("yhat_p90", D),
)
COMMANDS = _struct(("site_id", S), ("ts", N), ("command", S))
MANIFEST = _struct(
    ("kind", S), ("version", S), ("path", S), ("created_at", N), ("size_bytes", L), ("row_count", L), ("status", S),
)
RECOMMENDATION_LOG = _struct(
    ("timestamp", N), ("recommendation_id", S), ("type", S), ("payload_json", S), ("accepted", T.BooleanType()),
    ("action_timestamp", N),
)
OUTCOME_LOG = _struct(
    ("recommendation_id", S), ("actual_sauna", T.BooleanType()), ("actual_dishwasher", T.BooleanType()),
    ("actual_grid_import_wh", D), ("actual_cost_eur", D),
)
USER_FEEDBACK_LOG = _struct(
    ("timestamp", N), ("feedback_type", S), ("event_description", S), ("deferral_window_affected", S),
    ("recommendation_id", S),
)

# Solar forecast: code defaults, then the tuned values that run in production (fixed values).
PV_DEFAULTS = {
    "cutoff": "2026-02-01 00:00:00",
    "train_days": 120,
    "min_radiation": 20.0,
    "min_train_samples": 32,
    "bootstrap_ratio": 85.0,
    "cloud_floor": 0.25,
    "cloud_exp": 0.8,
    "panel_tilt_deg": 11.0,
    "panel_azimuth_deg": 90.0,
    "diffuse_floor": 0.15,
    "min_elevation_deg": -3.0,
    "max_pv_w": 41900.0,
    "lat": 60.0,
    "lon": 25.0,
    "band_base": 0.15,
    "band_cloud": 0.35,
    "model_name": "pv_radiation_cloud_ratio",
    "model_version": "v3_aoi_roof_cap",
}
PV_PRODUCTION = {
    **PV_DEFAULTS,
    "train_days": 60,
    "min_radiation": 5.0,
    "min_train_samples": 24,
    "bootstrap_ratio": 35.0,
    "cloud_floor": 0.70,
    "model_version": "v3_aoi_roof_cap_tuned",
}
BASELINE_DEFAULTS = {
    "train_days": 14,
    "alpha": 1.0,
    "tz": "Europe/Helsinki",
    "model_name": "baseline_consumption",
    "model_version": "baseline-v1",
}
# Excess over the reference load, in watts, that marks an event (fixed values).
COMPONENT_DEFAULTS = {
    "ev_min_w": 4500.0, "ev_max_w": 8500.0,
    "sauna_min_w": 9000.0, "sauna_max_w": 13000.0,
    "other_min_w": 2500.0,
    "half_window_hours": 24,
}
HEALTH_DEFAULTS = {
    "station_ok_min": 20, "station_warn_min": 60,
    "forecast_horizon_hours": 6,
    "baseline_ok_min": 30, "baseline_warn_min": 60, "baseline_full_rows": 24, "baseline_min_rows": 20,
    "backup_max_hours": 26, "backup_min_bytes": 100_000,
    "export_max_min": 30,
    "archive_max_hours": 24,
    "tz": "Europe/Helsinki",
    "price_strict": False,
}
