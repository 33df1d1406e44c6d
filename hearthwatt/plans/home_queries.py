"""Queries on consumption, forecasts and control."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.solar import cos_incidence, sun_position
from ..functions.timeparts import ts_lit, with_slot
from ..operators.baseline import baseline_forecast, fit_ridge, gram, normal_residual, residual_std, training_rows
from ..operators.consumption import (
    component_energy, consumption_components, daily_kpi, event_islands, event_summary,
    home_consumption, keyed_events, reference_load,
)
from ..operators.control import (
    command_intervals, command_state, decisions_as_commands, heat_pump_decision, rejected_commands,
)
from ..operators.grid import span_grid
from ..operators.keyed import newest_per_target, run_values
from ..operators.pv import effective_radiation, fit_ratio, pv_forecast, roof_radiation
from ..operators.scoring import (
    actual_and_forecast, consumption_page, forecast_error, forecast_error_windows, forecast_vs_actual, rolling_error,
)
from ..schemas import BASELINE_DEFAULTS, PV_PRODUCTION
from . import adapters as a
from .adapters import FUSION, SQL, STATION, ctes
from .registry import query, rounded, sql_round as r
from .series_queries import wide_series

TZ = "Europe/Helsinki"
ISSUE = "2024-01-28 00:00:00"
PV_P = {**PV_PRODUCTION, "cutoff": "2024-01-05 00:00:00"}


def _local(ts: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {ts}))"


# ---- consumption -------------------------------------------------------------------------------------------------

@query("home_consumption", ctes(*STATION) + f"""
SELECT site_id, ts, {r('pv_feed_in_w - active_power_pcc_w + bat_discharge_w - bat_charge_w', 4)} AS home_consumption_raw_w,
  {r('greatest(0.0, pv_feed_in_w - active_power_pcc_w + bat_discharge_w - bat_charge_w)', 4)} AS home_consumption_actual_w
FROM station""")
def home(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["pv_feed_in_w", "active_power_pcc_w", "bat_charge_w", "bat_discharge_w"]
    out = home_consumption(a.station(spark, sf_dir, cols))
    return rounded(out, {"home_consumption_raw_w": 4, "home_consumption_actual_w": 4})


SQL["ref"] = """
SELECT site_id, ts, total_actual_w, quantile_cont(total_actual_w, 0.5) OVER (PARTITION BY site_id ORDER BY ts
  RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND INTERVAL 24 HOURS FOLLOWING) AS reference_w FROM load"""
SQL["excess"] = "SELECT *, greatest(total_actual_w - reference_w, 0.0) AS x FROM ref"
SQL["classed"] = """
SELECT site_id, ts, total_actual_w, x, CASE WHEN x BETWEEN 4500 AND 8500 THEN 'ev' WHEN x BETWEEN 9000 AND 13000
  THEN 'sauna' WHEN x > 2500 THEN 'other' ELSE 'none' END AS event_class FROM excess"""
SQL["flagged"] = """
SELECT *, CASE WHEN lag(event_class) OVER w = event_class AND ts - lag(ts) OVER w <= INTERVAL 15 MINUTES
  THEN 0 ELSE 1 END AS starts FROM classed WINDOW w AS (PARTITION BY site_id ORDER BY ts)"""
SQL["components"] = """
SELECT site_id, ts, total_actual_w, total_actual_w - CASE WHEN event_class = 'none' THEN 0 ELSE x END AS baseline_actual_w,
  CASE WHEN event_class = 'ev' THEN x ELSE 0 END AS ev_actual_w,
  CASE WHEN event_class = 'sauna' THEN x ELSE 0 END AS sauna_actual_w,
  CASE WHEN event_class = 'other' THEN x ELSE 0 END AS other_actual_w, event_class,
  CAST(sum(starts) OVER (PARTITION BY site_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS event_id FROM flagged"""
COMPONENTS = ("load", "ref", "excess", "classed", "flagged", "components")
_PARTS = ["total_actual_w", "baseline_actual_w", "ev_actual_w", "sauna_actual_w", "other_actual_w"]


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumption_components(a.load(spark, sf_dir))


@query("reference_load", ctes("load", "ref") + f"""
SELECT site_id, ts, {r('total_actual_w', 4)} AS total_actual_w, {r('reference_w', 4)} AS reference_w FROM ref""")
def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reference_load(a.load(spark, sf_dir)), {"total_actual_w": 4, "reference_w": 4})


@query("consumption_components", ctes(*COMPONENTS) + "SELECT site_id, ts, event_class, event_id, " + ", ".join(
    f"{r(c, 4)} AS {c}" for c in _PARTS) + " FROM components")
def component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(components(spark, sf_dir), {c: 4 for c in _PARTS})


@query("event_islands", ctes("load") + """, cls AS (
  SELECT site_id, ts, CASE WHEN total_actual_w > 3000 THEN 'high' ELSE 'low' END AS event_class FROM load),
f AS (SELECT *, CASE WHEN lag(event_class) OVER w = event_class AND ts - lag(ts) OVER w <= INTERVAL 15 MINUTES
  THEN 0 ELSE 1 END AS starts FROM cls WINDOW w AS (PARTITION BY site_id ORDER BY ts))
SELECT site_id, ts, event_class, CAST(sum(starts) OVER (PARTITION BY site_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS event_id FROM f""")
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = F.when(F.col("total_actual_w") > 3000, "high").otherwise("low").alias("event_class")
    return event_islands(a.load(spark, sf_dir).select("site_id", "ts", high))


@query("event_summary", ctes(*COMPONENTS) + f"""
SELECT site_id, event_class, event_id, min(ts) AS start_ts, max(ts) + INTERVAL 15 MINUTES AS end_ts, count(*) AS n_slots,
  {r('sum(ev_actual_w + sauna_actual_w + other_actual_w) * 0.25 / 1000.0::DOUBLE', 6)} AS energy_kwh,
  {r('max(ev_actual_w + sauna_actual_w + other_actual_w)', 4)} AS peak_w
FROM components WHERE event_class <> 'none' GROUP BY 1, 2, 3""")
def events_summed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(event_summary(components(spark, sf_dir)), {"energy_kwh": 6, "peak_w": 4})


@query("daily_kpi", ctes("load") + f"""
SELECT site_id, CAST({_local('ts')} AS DATE) AS local_date, count(total_actual_w) AS points,
  96 - count(total_actual_w) AS missing, {r('avg(total_actual_w)', 4)} AS avg_w, {r('max(total_actual_w)', 4)} AS peak_w,
  {r('sum(total_actual_w) * 0.25 / 1000.0::DOUBLE', 5)} AS energy_kwh FROM load GROUP BY 1, 2""")
def kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily_kpi(a.load(spark, sf_dir), "total_actual_w", TZ), {"avg_w": 4, "peak_w": 4, "energy_kwh": 5})


@query("daily_kpi_on_grid", ctes("load") + f""", grid AS (
  SELECT site_id, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTES)) AS ts FROM load GROUP BY site_id)
SELECT site_id, CAST({_local('g.ts')} AS DATE) AS local_date, count(total_actual_w) AS points,
  count(*) - count(total_actual_w) AS missing, {r('avg(total_actual_w)', 4)} AS avg_w,
  {r('max(total_actual_w)', 4)} AS peak_w, {r('sum(total_actual_w) * 0.25 / 1000.0::DOUBLE', 5)} AS energy_kwh
FROM grid g LEFT JOIN load USING (site_id, ts) GROUP BY 1, 2""")
def kpi_on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = a.load(spark, sf_dir)
    out = daily_kpi(load, "total_actual_w", TZ, span_grid(load, ["site_id"]))
    return rounded(out, {"avg_w": 4, "peak_w": 4, "energy_kwh": 5})


@query("component_energy", ctes(*COMPONENTS) + f"SELECT site_id, CAST({_local('ts')} AS DATE) AS local_date, " + ", ".join(
    f"{r(f'sum({c}) * 0.25 / 1000.0::DOUBLE', 5)} AS {c.replace('_actual_w', '_kwh')}" for c in _PARTS)
    + " FROM components GROUP BY 1, 2")
def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(component_energy(components(spark, sf_dir), TZ), {c.replace("_actual_w", "_kwh"): 5 for c in _PARTS})


# ---- forecast runs and scores ------------------------------------------------------------------------------------

SQL["best"] = """
SELECT v.site_id, v.target, v.target_ts, v.run_id, r.issued_at, v.yhat_p50, v.yhat_p10, v.yhat_p90
FROM run_values v JOIN runs r USING (run_id)
QUALIFY row_number() OVER (PARTITION BY v.site_id, v.target, v.target_ts ORDER BY r.issued_at DESC, v.run_id DESC) = 1"""
SQL["pairs"] = """
SELECT coalesce(l.site_id, b.site_id) AS site_id, coalesce(l.ts, b.target_ts) AS ts, l.total_actual_w AS actual, b.yhat_p50
FROM load l FULL JOIN best b ON b.site_id = l.site_id AND b.target_ts = l.ts"""
PAIRS = ("load", "runs", "run_values", "best", "pairs")
_BANDS = {"yhat_p50": 4, "yhat_p10": 4, "yhat_p90": 4}
_BANDS_SQL = ", ".join(f"{r(c, d)} AS {c}" for c, d in _BANDS.items())


def best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_per_target(a.run_values(spark, sf_dir), a.runs(spark, sf_dir))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual = a.load(spark, sf_dir).withColumnRenamed("total_actual_w", "actual")
    return actual_and_forecast(actual, best(spark, sf_dir).select("site_id", "target_ts", "yhat_p50"))


@query("newest_per_target", ctes("runs", "run_values", "best") + f"""
SELECT site_id, target, target_ts, run_id, issued_at, {_BANDS_SQL} FROM best""")
def best_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best(spark, sf_dir), _BANDS)


@query("latest_run_values", ctes("runs", "run_values") + f"""
SELECT run_id, site_id, target, target_ts, {_BANDS_SQL} FROM run_values
WHERE run_id = (SELECT run_id FROM runs ORDER BY issued_at DESC, run_id DESC LIMIT 1) ORDER BY target_ts LIMIT 20""")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(run_values(a.run_values(spark, sf_dir), a.runs(spark, sf_dir), limit=20), _BANDS)


@query("one_run_values", ctes("runs", "run_values") + f"""
SELECT run_id, site_id, target, target_ts, {_BANDS_SQL} FROM run_values WHERE run_id = 'click-3'""")
def one_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(run_values(a.run_values(spark, sf_dir), a.runs(spark, sf_dir), "click-3"), _BANDS)


@query("actual_and_forecast", ctes(*PAIRS) + f"SELECT site_id, ts, {r('actual', 4)} AS actual, {r('yhat_p50', 4)} AS yhat_p50 FROM pairs")
def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_pairs(spark, sf_dir), {"actual": 4, "yhat_p50": 4})


def _metric_sql(filter_: str = "", suffix: str = "") -> str:
    e = "(yhat_p50 - actual)"
    f = f" FILTER (WHERE {filter_})" if filter_ else ""
    return (f"count({e}){f} AS n_pairs{suffix}, {r(f'avg(abs({e})){f}', 4)} AS mae{suffix}, "
            f"{r(f'sqrt(avg({e} * {e}){f})', 4)} AS rmse{suffix}, {r(f'avg({e}){f}', 4)} AS bias{suffix}")


_METRICS = {"mae": 4, "rmse": 4, "bias": 4}


@query("forecast_error", ctes(*PAIRS) + f"SELECT site_id, {_metric_sql()} FROM pairs GROUP BY 1")
def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast_error(_pairs(spark, sf_dir)), _METRICS)


@query("forecast_error_windows", ctes(*PAIRS) + f"""
SELECT site_id, {_metric_sql("ts > TIMESTAMP '2024-01-30 00:00:00'", '_24h')},
  {_metric_sql("ts > TIMESTAMP '2024-01-24 00:00:00'", '_168h')}
FROM pairs WHERE ts > TIMESTAMP '2024-01-24 00:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1""")
def error_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = forecast_error_windows(_pairs(spark, sf_dir), ts_lit(a.NOW))
    return rounded(out, {f"{m}_{h}h": 4 for m in _METRICS for h in (24, 168)})


def _rolling_sql(hours: int) -> str:
    e = "(yhat_p50 - actual)"
    return ctes(*PAIRS) + f"""SELECT site_id, ts, count({e}) OVER w AS n_pairs, {r(f'avg(abs({e})) OVER w', 3)} AS mae,
  {r(f'sqrt(avg({e} * {e}) OVER w)', 3)} AS rmse, {r(f'avg({e}) OVER w', 3)} AS bias FROM pairs
  WINDOW w AS (PARTITION BY site_id ORDER BY ts RANGE BETWEEN INTERVAL {hours} HOURS PRECEDING AND CURRENT ROW)"""


@query("forecast_error_rolling", _rolling_sql(24))
def rolling_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rolling_error(_pairs(spark, sf_dir), 24), {m: 3 for m in _METRICS})


@query("forecast_error_rolling_week", _rolling_sql(168))
def rolling_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rolling_error(_pairs(spark, sf_dir), 168), {m: 3 for m in _METRICS})


_DAY_GRID = """grid AS (SELECT site_id, unnest(generate_series(TIMESTAMP '2024-01-09 22:00:00',
  TIMESTAMP '2024-01-10 21:45:00', INTERVAL 15 MINUTES)) AS ts FROM sites)"""


@query("forecast_vs_actual", ctes("sites", "load", "runs", "run_values", "best") + f""", {_DAY_GRID}
SELECT g.site_id, g.ts, strftime({_local('g.ts')}, '%H:%M') AS local_time, {_BANDS_SQL},
  {r('total_actual_w', 4)} AS actual, {r('yhat_p50 - total_actual_w', 4)} AS error
FROM grid g LEFT JOIN best b ON b.site_id = g.site_id AND b.target_ts = g.ts
LEFT JOIN load l ON l.site_id = g.site_id AND l.ts = g.ts""")
def versus(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual = a.load(spark, sf_dir).withColumnRenamed("total_actual_w", "actual")
    out = forecast_vs_actual(a.run_values(spark, sf_dir), a.runs(spark, sf_dir), actual, a.sites(spark, sf_dir),
                             "2024-01-10", TZ, "baseline_w")
    return rounded(out, {**_BANDS, "actual": 4, "error": 4})


@query("consumption_page", ctes("sites", *COMPONENTS, "runs", "run_values", "best") + f""", {_DAY_GRID}
SELECT g.site_id, g.ts, strftime({_local('g.ts')}, '%H:%M') AS local_time, {_BANDS_SQL}, """ + ", ".join(
    f"{r(c, 4)} AS {c}" for c in _PARTS) + """
FROM grid g LEFT JOIN best b ON b.site_id = g.site_id AND b.target_ts = g.ts
LEFT JOIN components c ON c.site_id = g.site_id AND c.ts = g.ts""")
def page(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = consumption_page(components(spark, sf_dir), a.run_values(spark, sf_dir), a.runs(spark, sf_dir),
                           a.sites(spark, sf_dir), "2024-01-10", TZ)
    return rounded(out, {**_BANDS, **{c: 4 for c in _PARTS}})


@query("residual_spread", ctes(*PAIRS) + f"""
SELECT site_id, {r('stddev_samp(actual - yhat_p50)', 4)} AS residual_std FROM pairs GROUP BY 1""")
def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(residual_std(_pairs(spark, sf_dir).withColumnRenamed("yhat_p50", "yhat")), {"residual_std": 4})


# ---- sun and solar forecast --------------------------------------------------------------------------------------

def _sun_sql(source: str, ts: str, keep: str, lat: str = f"{PV_P['lat']!r}::DOUBLE", lon: str = f"{PV_P['lon']!r}::DOUBLE",
             tilt: str = f"{PV_P['panel_tilt_deg']!r}::DOUBLE", azimuth: str = f"{PV_P['panel_azimuth_deg']!r}::DOUBLE") -> str:
    """Sun elevation and incidence on the panel, as further columns of ``source``."""
    lat, tilt, gamma = f"radians({lat})", f"radians({tilt})", f"radians({azimuth} - 180.0)"
    return f"""
SELECT {keep}, degrees(asin(greatest(-1.0, least(1.0, sin({lat}) * sin(d) + cos({lat}) * cos(d) * cos(w))))) AS elevation_deg,
  sin(d) * sin({lat}) * cos({tilt}) - sin(d) * cos({lat}) * sin({tilt}) * cos({gamma})
  + cos(d) * cos({lat}) * cos({tilt}) * cos(w) + cos(d) * sin({lat}) * sin({tilt}) * cos({gamma}) * cos(w)
  + cos(d) * sin({tilt}) * sin({gamma}) * sin(w) AS cos_aoi
FROM (SELECT *, radians(15.0 * ((m + 4.0 * {lon} + 9.87::DOUBLE * sin(2.0 * b) - 7.53::DOUBLE * cos(b)
    - 1.5 * sin(b)) / 60.0 - 12.0)) AS w
  FROM (SELECT *, radians(360e0 / 365 * (dayofyear({ts}) - 81)) AS b,
      radians(23.45::DOUBLE) * sin(radians(360e0 / 365 * (284 + dayofyear({ts})))) AS d,
      hour({ts}) * 60.0::DOUBLE + minute({ts}) + second({ts}) / 60.0::DOUBLE AS m FROM {source}))"""


@query("sun_position", "SELECT event_id, " + r("elevation_deg", 5) + " AS elevation_deg, " + r("cos_aoi", 6) + f"""
 AS cos_aoi FROM ({_sun_sql('events', 'ts', 'event_id')})""")
def sun(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = sun_position("ts", PV_P["lat"], PV_P["lon"])
    aoi = cos_incidence(position["declination"], position["hour_angle"], PV_P["lat"], PV_P["panel_tilt_deg"],
                        PV_P["panel_azimuth_deg"])
    out = a.telemetry(spark, sf_dir).select("event_id", position["elevation_deg"].alias("elevation_deg"), aoi.alias("cos_aoi"))
    return rounded(out, {"elevation_deg": 5, "cos_aoi": 6})


SQL["mid"] = "SELECT *, ts + INTERVAL 450 SECONDS AS mid FROM fusion"
SQL["lit"] = _sun_sql("mid", "mid", "site_id, ts, fc_shortwave_radiation_w_m2 AS rad, fc_cloud_cover_pct AS cloud, "
                      "station_pv_feed_in_w AS pv")
SQL["eff"] = f"""
SELECT *, rad * ({PV_P['cloud_floor']}::DOUBLE + (1.0 - {PV_P['cloud_floor']}::DOUBLE)
  * pow(CASE WHEN cloud IS NOT NULL THEN greatest(1.0 - cloud / 100.0, 0.0) END, {PV_P['cloud_exp']}::DOUBLE))
  * ({PV_P['diffuse_floor']}::DOUBLE + (1.0 - {PV_P['diffuse_floor']}::DOUBLE) * greatest(0.0, cos_aoi)) AS effective_rad FROM lit"""
SQL["ratio"] = f"""
SELECT site_id, n AS n_samples, CASE WHEN n >= {PV_P['min_train_samples']} THEN q ELSE {PV_P['bootstrap_ratio']} END AS ratio,
  CASE WHEN n >= {PV_P['min_train_samples']} THEN 'learned' ELSE 'bootstrap' END AS ratio_source
FROM (SELECT site_id, count(*) AS n, quantile_cont(pv / effective_rad, 0.5) AS q FROM eff
  WHERE ts >= TIMESTAMP '{PV_P['cutoff']}' AND ts < TIMESTAMP '{ISSUE}' AND rad >= {PV_P['min_radiation']}
    AND effective_rad > 0 AND pv IS NOT NULL GROUP BY site_id)"""
SOLAR = (*FUSION, "mid", "lit", "eff", "ratio")


@query("pv_effective_radiation", ctes(*SOLAR) + f"""
SELECT site_id, ts, {r('elevation_deg', 5)} AS elevation_deg, {r('cos_aoi', 6)} AS cos_aoi,
  {r('effective_rad', 4)} AS effective_rad FROM eff""")
def effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = effective_radiation(wide_series(spark, sf_dir), PV_P).select("site_id", "ts", "elevation_deg", "cos_aoi", "effective_rad")
    return rounded(out, {"elevation_deg": 5, "cos_aoi": 6, "effective_rad": 4})


@query("pv_ratio", ctes(*SOLAR) + f"SELECT site_id, n_samples, {r('ratio', 5)} AS ratio, ratio_source FROM ratio")
def ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fit_ratio(effective_radiation(wide_series(spark, sf_dir), PV_P), PV_P, ts_lit(ISSUE), a.sites(spark, sf_dir))
    return rounded(out, {"ratio": 5})


@query("pv_forecast", ctes(*SOLAR) + f""", p50 AS (
  SELECT site_id, ts, cloud, CASE WHEN rad < {PV_P['min_radiation']} OR elevation_deg < {PV_P['min_elevation_deg']} THEN 0.0
    WHEN effective_rad IS NOT NULL THEN least(ratio * effective_rad, {PV_P['max_pv_w']}) END AS p50
  FROM eff JOIN ratio USING (site_id)
  WHERE ts > TIMESTAMP '{ISSUE}' AND ts <= TIMESTAMP '{ISSUE}' + INTERVAL 24 HOURS)
SELECT md5(site_id || '|{PV_P['model_name']}|{PV_P['model_version']}|20240128_000000') AS run_id, site_id,
  'pv_feed_in_w' AS target, ts AS target_ts, {r('p50', 3)} AS yhat_p50,
  {r(f"CASE WHEN p50 IS NOT NULL THEN greatest(0.0, p50 * (1.0 - (0.15::DOUBLE + 0.35::DOUBLE * coalesce(cloud, 100.0) / 100.0))) END", 3)} AS yhat_p10,
  {r(f"CASE WHEN p50 IS NOT NULL THEN least({PV_P['max_pv_w']}, p50 * (1.0 + (0.15::DOUBLE + 0.35::DOUBLE * coalesce(cloud, 100.0) / 100.0))) END", 3)} AS yhat_p90
FROM p50""")
def solar(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, values = pv_forecast(wide_series(spark, sf_dir), PV_P, ISSUE)
    return rounded(values, {c: 3 for c in _BANDS})


@query("pv_run_header", ctes(*SOLAR) + f"""
SELECT md5(site_id || '|{PV_P['model_name']}|{PV_P['model_version']}|20240128_000000') AS run_id, site_id,
  '{PV_P['model_name']}' AS model_name, '{PV_P['model_version']}' AS model_version, TIMESTAMP '{ISSUE}' AS issued_at,
  ratio_source FROM ratio
WHERE site_id IN (SELECT site_id FROM eff WHERE ts > TIMESTAMP '{ISSUE}' AND ts <= TIMESTAMP '{ISSUE}' + INTERVAL 24 HOURS)""")
def solar_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pv_forecast(wide_series(spark, sf_dir), PV_P, ISSUE)[0].drop("notes")


# Sites with an even name have two roofs, of which one gets another tilt in the middle of the month; the others have one, from the 5th on.
_ROOFS = [(0, "2024-01-01 00:00:00", "2024-01-17 12:00:00", 11.0, 90.0, 0.5), (0, "2024-01-17 12:00:00", None, 35.0, 90.0, 0.5),
          (0, "2024-01-01 00:00:00", None, 20.0, 250.0, 0.75), (1, "2024-01-05 00:00:00", None, 45.0, 180.0, 1.25)]
SQL["roofs"] = """
SELECT site_id, valid_from, valid_to, 60.0::DOUBLE + length(site_id) / 10.0::DOUBLE AS lat, 25.0::DOUBLE - length(site_id) / 10.0::DOUBLE AS lon,
  tilt, azimuth, share, share * 30000 AS max_w FROM sites JOIN (VALUES """ + ", ".join(
    f"({odd}, TIMESTAMP '{start}', {f'TIMESTAMP {end!r}' if end else 'NULL'}, {tilt}::DOUBLE, {azimuth}::DOUBLE, {share}::DOUBLE)"
    for odd, start, end, tilt, azimuth, share in _ROOFS) + ") t(odd, valid_from, valid_to, tilt, azimuth, share) ON length(site_id) % 2 = odd"


def _roofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.struct(
        F.lit(odd).alias("odd"), ts_lit(start).alias("valid_from"), F.lit(end).cast("timestamp_ntz").alias("valid_to"), F.lit(tilt).alias("panel_tilt_deg"),
        F.lit(azimuth).alias("panel_azimuth_deg"), F.lit(share).alias("share"), F.lit(share * 30000).alias("max_w")) for odd, start, end, tilt, azimuth, share in _ROOFS])
    named = a.sites(spark, sf_dir).select("site_id", F.inline(kinds)).filter("length(site_id) % 2 = odd").drop("odd")
    offset = F.length("site_id") / F.lit(10.0)
    return named.withColumns({"lat": F.lit(60.0) + offset, "lon": F.lit(25.0) - offset})


_LIGHT = f"""fc_shortwave_radiation_w_m2 * ({PV_P['cloud_floor']}::DOUBLE + (1.0 - {PV_P['cloud_floor']}::DOUBLE)
  * pow(CASE WHEN fc_cloud_cover_pct IS NOT NULL THEN greatest(1.0 - fc_cloud_cover_pct / 100.0, 0.0) END, {PV_P['cloud_exp']}::DOUBLE))"""


@query("pv_roofs", ctes(*FUSION, "mid", "roofs") + f""", on_roof AS (
  SELECT m.*, lat, lon, tilt, azimuth, share, max_w FROM mid m JOIN roofs f ON f.site_id = m.site_id AND m.ts >= valid_from AND (valid_to IS NULL OR m.ts < valid_to)),
lit_roof AS ({_sun_sql('on_roof', 'mid', 'site_id, ts, share, max_w', 'lat', 'lon', 'tilt', 'azimuth')}),
gain AS (SELECT site_id, ts, max(elevation_deg) AS elevation_deg, sum(max_w) AS max_pv_w,
  sum(share * ({PV_P['diffuse_floor']}::DOUBLE + (1.0 - {PV_P['diffuse_floor']}::DOUBLE) * greatest(0.0, cos_aoi))) AS gain FROM lit_roof GROUP BY 1, 2)
SELECT site_id, ts, {r('elevation_deg', 5)} AS elevation_deg, max_pv_w, {r(f'{_LIGHT} * gain', 4)} AS effective_rad
FROM mid LEFT JOIN gain USING (site_id, ts)""")
def several_roofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = roof_radiation(wide_series(spark, sf_dir), _roofs(spark, sf_dir), PV_P).select("site_id", "ts", "elevation_deg", "max_pv_w", "effective_rad")
    return rounded(out, {"elevation_deg": 5, "effective_rad": 4})


# ---- baseline forecast -------------------------------------------------------------------------------------------

_BASE_P = {**BASELINE_DEFAULTS, "train_days": 14}
_W = ["fc_temperature_c", "fc_wind_speed_ms", "fc_cloud_cover_pct", "fc_shortwave_radiation_w_m2"]


SQL["train"] = f"""
SELECT * FROM (SELECT c.site_id, c.baseline_actual_w AS t, {_local('c.ts')} AS l, {", ".join(f"f.{w} AS x{i}" for i, w in enumerate(_W))}
  FROM components c JOIN fusion f ON f.site_id = c.site_id AND f.ts = c.ts
  WHERE c.ts >= TIMESTAMP '{ISSUE}' - INTERVAL 14 DAYS AND c.ts < TIMESTAMP '{ISSUE}')
WHERE t IS NOT NULL AND """ + " AND ".join(f"x{i} IS NOT NULL" for i in range(4))
TRAIN = tuple(dict.fromkeys((*COMPONENTS, *FUSION, "train")))


@query("baseline_gram", ctes(*TRAIN) + """
SELECT site_id, CAST(hour(l) AS INTEGER) AS hour_of_day, CAST(dayofweek(l) + 1 AS INTEGER) AS day_of_week, count(*) AS n,
""" + ", ".join([f"{r('sum(t)', 2)} AS y", f"{r('sum(t * t)', 0)} AS yy"]
                + [f"{r(f'sum(x{i})', 3)} AS x{i}" for i in range(4)]
                + [f"{r(f'sum(x{i} * t)', 1)} AS x{i}y" for i in range(4)]
                + [f"{r(f'sum(x{i} * x{j})', 2)} AS x{i}x{j}" for i in range(4) for j in range(i, 4)])
    + " FROM train GROUP BY 1, 2, 3")
def gram_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(components(spark, sf_dir), wide_series(spark, sf_dir), _BASE_P, ISSUE)
    digits = {"y": 2, "yy": 0, **{f"x{i}": 3 for i in range(4)}, **{f"x{i}y": 1 for i in range(4)},
              **{f"x{i}x{j}": 2 for i in range(4) for j in range(i, 4)}}
    return rounded(gram(rows).drop("is_holiday"), digits)


def _design(x: list[str], local: str) -> str:
    """The features of a row: weather, hours, days of the week, weekend, holiday (none is known here)."""
    return (f"[{', '.join(x)}] || list_transform(range(1, 24), lambda h: CAST(hour({local}) = h AS DOUBLE)) || list_transform(range(2, 8), "
            f"lambda d: CAST(dayofweek({local}) + 1 = d AS DOUBLE)) || [CAST(dayofweek({local}) IN (0, 6) AS DOUBLE), 0.0::DOUBLE]")


_P = 35
SQL["design"] = f"SELECT site_id, t, {_design([f'x{i}' for i in range(4)], 'l')} AS z FROM train"
SQL["totals"] = "SELECT site_id, count(*) AS n, avg(t) AS mean_y, sum(t * t) - count(*) * avg(t) * avg(t) AS cyy FROM design GROUP BY 1"
SQL["sums"] = f"""
SELECT site_id, i, avg(z[i]) AS m, sum(z[i] * t) - count(*) * avg(z[i]) * avg(t) AS cy,
  sqrt(greatest((sum(z[i] * z[i]) - count(*) * avg(z[i]) * avg(z[i])) / count(*), 0.0)) AS s
FROM design, (SELECT unnest(range(1, {_P + 1})) AS i) GROUP BY 1, 2"""
SQL["crossed"] = f"""
SELECT site_id, i, j, sum(z[i] * z[j]) - count(*) * avg(z[i]) * avg(z[j]) AS c
FROM design, (SELECT unnest(range(1, {_P + 1})) AS i), (SELECT unnest(range(1, {_P + 1})) AS j) GROUP BY 1, 2, 3"""
# The normal equations of the standardised features: a row for each, its last entry the right side. A feature without
# spread has a unit row, so its coefficient is zero.
SQL["equations"] = f"""
SELECT site_id, list(r ORDER BY i) AS m FROM (
  SELECT x.site_id, x.i, list(CASE WHEN a.s > 1e-9 AND b.s > 1e-9 THEN c / (a.s * b.s) ELSE 0.0 END
      + CASE WHEN x.i <> x.j THEN 0.0 WHEN a.s > 1e-9 THEN {_BASE_P['alpha']} ELSE 1.0 END ORDER BY x.j)
    || [CASE WHEN first(a.s) > 1e-9 THEN first(a.cy) / first(a.s) ELSE 0.0 END] AS r
  FROM crossed x JOIN sums a ON a.site_id = x.site_id AND a.i = x.i JOIN sums b ON b.site_id = x.site_id AND b.i = x.j
  GROUP BY x.site_id, x.i) GROUP BY site_id"""
# Elimination: step k divides equation k by its pivot and takes it from all others.
SQL["solving"] = f"""
SELECT site_id, 1 AS k, m FROM equations
UNION ALL
SELECT site_id, k + 1, list_transform(range(1, {_P + 1}), lambda i: list_transform(range(1, {_P + 2}), lambda j:
  CASE WHEN i = k THEN m[k][j] / m[k][k] ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END))
FROM solving WHERE k <= {_P}"""
SQL["beta"] = f"""
SELECT g.site_id, i, s, mean, cy, CASE WHEN s > 1e-9 THEN g.m[i][{_P + 1}] / s ELSE 0.0 END AS b
FROM (SELECT site_id, m FROM solving WHERE k = {_P + 1}) g JOIN (SELECT site_id, i, s, m AS mean, cy FROM sums) USING (site_id)"""
SQL["quadratic"] = """
SELECT x.site_id, sum(a.b * c * d.b) AS q FROM crossed x JOIN beta a ON a.site_id = x.site_id AND a.i = x.i
JOIN beta d ON d.site_id = x.site_id AND d.i = x.j GROUP BY 1"""
SQL["model"] = """
SELECT site_id, n, cyy, mean_y - bm AS intercept, betas, sqrt(greatest(cyy - 2 * bc + q, 0.0) / (n - 1)) AS std, greatest(cyy - 2 * bc + q, 0.0) AS sse
FROM totals JOIN quadratic USING (site_id)
JOIN (SELECT site_id, sum(b * mean) AS bm, sum(b * cy) AS bc, list(b ORDER BY i) AS betas FROM beta GROUP BY 1) USING (site_id)"""
MODEL = (*TRAIN, "design", "totals", "sums", "crossed", "equations", "solving", "beta", "quadratic", "model")


def _model_ctes() -> str:
    return ctes(*MODEL).replace("WITH ", "WITH RECURSIVE ", 1)


_BASE_ID = f"md5(site_id || '|{_BASE_P['model_name']}|{_BASE_P['model_version']}|20240128_000000')"


@query("baseline_forecast", _model_ctes() + f""", future AS (
  SELECT site_id, ts, {" + ".join(_W)} IS NOT NULL AS known, {_design(_W, _local('ts'))} AS z FROM fusion
  WHERE ts > TIMESTAMP '{ISSUE}' AND ts <= TIMESTAMP '{ISSUE}' + INTERVAL 48 HOURS),
p50 AS (SELECT site_id, ts, std, CASE WHEN known THEN intercept + list_dot_product(betas, list_transform(z, lambda v: coalesce(v, 0.0))) END AS p50 FROM future JOIN model USING (site_id))
SELECT {_BASE_ID} AS run_id, site_id, 'baseline_w' AS target, ts AS target_ts, {r('p50', 2)} AS yhat_p50,
  {r('p50 - 1.2816::DOUBLE * std', 2)} AS yhat_p10, {r('p50 + 1.2816::DOUBLE * std', 2)} AS yhat_p90 FROM p50""")
def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, values = baseline_forecast(components(spark, sf_dir), wide_series(spark, sf_dir), _BASE_P, ISSUE)
    return rounded(values, {c: 2 for c in _BANDS})


@query("baseline_run_header", _model_ctes() + f"""
SELECT {_BASE_ID} AS run_id, site_id, '{_BASE_P['model_name']}' AS model_name, '{_BASE_P['model_version']}' AS model_version,
  TIMESTAMP '{ISSUE}' AS issued_at, CAST(NULL AS VARCHAR) AS ratio_source, 'n=' || n || ' residual_std=' || round(std, 1) AS notes FROM model""")
def baseline_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_forecast(components(spark, sf_dir), wide_series(spark, sf_dir), _BASE_P, ISSUE)[0]


@query("baseline_normal_equations", _model_ctes() + f""", errors AS (
  SELECT site_id, t - intercept - list_dot_product(betas, z) AS e, z FROM design JOIN model USING (site_id)),
slopes AS (
  SELECT site_id, max(abs(g)) AS largest FROM (
    SELECT e.site_id, CASE WHEN first(s) > 1e-9 THEN sum((z[i] - mean) * e) / first(s) - {_BASE_P['alpha']} * first(b) * first(s) ELSE 0.0 END AS g
    FROM errors e JOIN beta b ON b.site_id = e.site_id GROUP BY e.site_id, i) GROUP BY 1)
SELECT site_id, n AS n_samples, {r('std', 2)} AS residual_std, {r('1.0 - sse / cyy', 5)} AS r2,
  {r('mean_e', 4)} AS mean_error, {r('largest / n', 4)} AS largest_slope
FROM model JOIN slopes USING (site_id) JOIN (SELECT site_id, avg(e) AS mean_e FROM errors GROUP BY 1) USING (site_id)""")
def normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = training_rows(components(spark, sf_dir), wide_series(spark, sf_dir), _BASE_P, ISSUE)
    out = normal_residual(train, fit_ridge(gram(train), _BASE_P["alpha"]), _BASE_P["alpha"])
    return rounded(out, {"residual_std": 2, "r2": 5, "mean_error": 4, "largest_slope": 4})


_READ_FROM, _SHOWN_FROM = "2024-01-12 00:00:00", "2024-01-14 00:00:00"


@query("event_keys", ctes(*COMPONENTS) + f""", events_of AS (
  SELECT site_id, event_class, event_id, min(ts) AS start_ts, count(*) AS n_slots, sum(ev_actual_w + sauna_actual_w + other_actual_w) * 0.25 / 1000.0 AS energy_kwh
  FROM components WHERE event_class <> 'none' GROUP BY 1, 2, 3)
SELECT site_id || '|' || event_class || '|' || strftime(start_ts, '%Y-%m-%dT%H:%M') AS event_key, site_id, event_class, start_ts, n_slots,
  {r('energy_kwh', 5)} AS energy_kwh FROM events_of WHERE start_ts >= TIMESTAMP '{_SHOWN_FROM}'""")
def event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a part of the load, with the keys that they have in the whole."""
    part = consumption_components(a.load(spark, sf_dir).filter(F.col("ts") >= ts_lit(_READ_FROM)))
    events = keyed_events(part).filter(F.col("start_ts") >= ts_lit(_SHOWN_FROM))
    return rounded(events.select("event_key", "site_id", "event_class", "start_ts", "n_slots", "energy_kwh"), {"energy_kwh": 5})


# ---- control -----------------------------------------------------------------------------------------------------

@query("command_intervals", ctes("commands", "valid_commands") + """
SELECT site_id, ts AS start_ts, least(lead(ts) OVER (PARTITION BY site_id ORDER BY ts),
  CASE WHEN minutes IS NOT NULL THEN ts + INTERVAL 1 MINUTE * minutes END) AS end_ts, command, mode FROM valid_commands""")
def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return command_intervals(a.commands(spark, sf_dir))


@query("command_state", ctes("commands", "valid_commands") + """, grid AS (
  SELECT site_id, unnest(generate_series(time_bucket(INTERVAL 15 MINUTES, min(ts)),
    time_bucket(INTERVAL 15 MINUTES, max(ts)), INTERVAL 15 MINUTES)) AS ts FROM commands GROUP BY site_id)
SELECT g.site_id, g.ts, CASE WHEN c.mode IS NULL OR (c.minutes IS NOT NULL AND c.ts + INTERVAL 1 MINUTE * c.minutes <= g.ts)
  THEN 'ALLOW' ELSE c.mode END AS mode, c.ts AS since_ts
FROM grid g ASOF LEFT JOIN valid_commands c ON c.site_id = g.site_id AND g.ts >= c.ts""")
def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = a.commands(spark, sf_dir)
    slots = with_slot(given, "ts", "15 minutes", "slot").select("site_id", F.col("slot").alias("ts"))
    return command_state(given, span_grid(slots, ["site_id"]))


@query("rejected_commands", ctes("commands") + """
SELECT * FROM commands WHERE TRY_CAST(NULLIF(regexp_extract(command, '^PROHIBIT_([0-9]+)$', 1), '') AS INTEGER) > 720""")
def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_commands(a.commands(spark, sf_dir))


_DECISION = """decision AS (SELECT site_id, ts, price_eur_per_mwh, fc_temperature_c,
  CASE WHEN price_eur_per_mwh > 25 AND fc_temperature_c >= -6 THEN 'PROHIBIT' ELSE 'ALLOW' END AS decision FROM fusion)"""


@query("heat_pump_decision", ctes(*FUSION) + f""", {_DECISION}
SELECT site_id, ts, {r('price_eur_per_mwh', 5)} AS price_eur_per_mwh, {r('fc_temperature_c', 5)} AS fc_temperature_c, decision
FROM decision""")
def decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(heat_pump_decision(wide_series(spark, sf_dir), 25.0, -6.0), {"price_eur_per_mwh": 5, "fc_temperature_c": 5})


@query("decision_changes", ctes(*FUSION) + f""", {_DECISION}
SELECT site_id, ts, decision AS command FROM decision
QUALIFY lag(decision) OVER (PARTITION BY site_id ORDER BY ts) IS DISTINCT FROM decision""")
def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions_as_commands(heat_pump_decision(wide_series(spark, sf_dir), 25.0, -6.0))
