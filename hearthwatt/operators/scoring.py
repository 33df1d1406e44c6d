"""Forecasts against measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timeparts import between_dates, hour_minute
from .chunked import CHUNK, DAY, home_rows, with_halo
from .grid import local_day_grid, on_grid
from .keyed import newest_per_target


def actual_and_forecast(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Full join at the target time: future slots keep the forecast alone, unforecast ones the measurement alone.

    ``actual`` has ``site_id, ts, actual``; ``forecast`` one row per ``site_id, target_ts``.
    """
    return actual.join(forecast.withColumnRenamed("target_ts", "ts"), ["site_id", "ts"], "full")


def error(yhat: str = "yhat_p50", actual: str = "actual") -> Column:
    """Positive when the forecast is too high; NULL unless both are known."""
    return F.col(yhat) - F.col(actual)


def _metrics(e: Column, suffix: str = "") -> list[Column]:
    return [
        F.count(e).alias(f"n_pairs{suffix}"), F.avg(F.abs(e)).alias(f"mae{suffix}"),
        F.sqrt(F.avg(e * e)).alias(f"rmse{suffix}"), F.avg(e).alias(f"bias{suffix}")]


def forecast_error(pairs: DataFrame, by: Sequence[str] = ("site_id",)) -> DataFrame:
    return pairs.groupBy(*by).agg(*_metrics(error()))


def forecast_error_windows(pairs: DataFrame, now: Column, hours: Sequence[int] = (24, 168),
                           by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Errors over the last hours before ``now``, all windows in one pass over the longest."""
    recent = pairs.filter((F.col("ts") > F.timestamp_add("HOUR", F.lit(-max(hours)), now)) & (F.col("ts") <= now))
    columns = []
    for h in hours:
        inside = F.col("ts") > F.timestamp_add("HOUR", F.lit(-h), now)
        columns += _metrics(F.when(inside, error()), f"_{h}h")
    return recent.groupBy(*by).agg(*columns)


def rolling_error(pairs: DataFrame, hours: int = 24, by: Sequence[str] = ("site_id",), length: int = 7 * DAY) -> DataFrame:
    """Trailing error at every slot, over the ``hours`` up to and including it. One row per slot and site."""
    copies = with_halo(pairs.withColumn("_e", error()), "ts", hours * 3600, 0, length)
    frame = (f"OVER (PARTITION BY {', '.join([*by, CHUNK])} ORDER BY ts "
             f"RANGE BETWEEN INTERVAL {hours} HOURS PRECEDING AND CURRENT ROW)")
    rolled = copies.withColumns({
        "n_pairs": F.expr(f"count(_e) {frame}"), "mae": F.expr(f"avg(abs(_e)) {frame}"),
        "rmse": F.expr(f"sqrt(avg(_e * _e) {frame})"), "bias": F.expr(f"avg(_e) {frame}")})
    return home_rows(rolled).select(*by, "ts", "n_pairs", "mae", "rmse", "bias")


def forecast_vs_actual(values: DataFrame, runs: DataFrame, actual: DataFrame, sites: DataFrame, day: str, tz: str,
                       target: str) -> DataFrame:
    """Every slot of a local day with the newest forecast for it and the measurement, each NULL until known."""
    grid = local_day_grid(sites, day, tz)
    wanted = values.filter((F.col("target") == target) & between_dates("target_ts", day, day, tz))
    forecast = newest_per_target(wanted, runs).select(
        "site_id", F.col("target_ts").alias("ts"), "yhat_p50", "yhat_p10", "yhat_p90")
    measured = actual.filter(between_dates("ts", day, day, tz)).select("site_id", "ts", "actual")
    rows = on_grid(measured, on_grid(forecast, grid))
    return rows.select("site_id", "ts", hour_minute("ts", tz).alias("local_time"), "yhat_p50", "yhat_p10", "yhat_p90",
                       "actual", error().alias("error"))


def consumption_page(components: DataFrame, values: DataFrame, runs: DataFrame, sites: DataFrame, day: str,
                     tz: str) -> DataFrame:
    """Every slot of a local day with the measured components and the newest baseline forecast."""
    total = components.select("site_id", "ts", F.col("baseline_actual_w").alias("actual"))
    rows = forecast_vs_actual(values, runs, total, sites, day, tz, "baseline_w")
    parts = components.filter(between_dates("ts", day, day, tz)).select(
        "site_id", "ts", "total_actual_w", "ev_actual_w", "sauna_actual_w", "other_actual_w")
    return on_grid(parts, rows.withColumnRenamed("actual", "baseline_actual_w")).select(
        "site_id", "ts", "local_time", "total_actual_w", "baseline_actual_w", "ev_actual_w", "sauna_actual_w",
        "other_actual_w", "yhat_p50", "yhat_p10", "yhat_p90")
