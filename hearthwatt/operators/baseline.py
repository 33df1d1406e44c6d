"""Baseline load forecast: ridge regression per site on weather and calendar.

The rows are reduced to sums per site and calendar cell (hour, weekday, holiday) before anything reaches Python: at
most 336 small rows per site, whatever the history holds. The solve is the only Python step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timeparts import calendar_features, ts_lit
from .pv import horizon_filter, run_header, run_id, training_window

WEATHER = ["fc_temperature_c", "fc_wind_speed_ms", "fc_cloud_cover_pct", "fc_shortwave_radiation_w_m2"]
CELL = ["hour_of_day", "day_of_week", "is_holiday"]
Z_P90 = 1.2816
MODEL_SCHEMA = (
    "site_id string, n_samples bigint, intercept double, weather_coef array<double>, hour_coef array<double>, "
    "weekday_coef array<double>, weekend_coef double, holiday_coef double, residual_std double"
)


def gram(df: DataFrame, features: Sequence[str] = tuple(WEATHER), target: str = "baseline_actual_w") -> DataFrame:
    """Sums and cross products of features and target per site and calendar cell; incomplete rows are left out."""
    complete = df.dropna(subset=[*features, target])
    pairs = [(i, j) for i in range(len(features)) for j in range(i, len(features))]
    return complete.groupBy("site_id", *CELL).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(target).alias("y"), F.sum(F.col(target) * F.col(target)).alias("yy"),
        *[F.sum(f).alias(f"x{i}") for i, f in enumerate(features)],
        *[F.sum(F.col(f) * F.col(target)).alias(f"x{i}y") for i, f in enumerate(features)],
        *[F.sum(F.col(features[i]) * F.col(features[j])).alias(f"x{i}x{j}") for i, j in pairs],
    )


def _solve_site(cells: pd.DataFrame, alpha: float, k: int) -> dict[str, Any]:
    """Ridge on standardised features from cell sums; the intercept is not penalised."""
    n = cells["n"].to_numpy(float)
    hour, day = cells["hour_of_day"].to_numpy(), cells["day_of_week"].to_numpy()
    flags = np.column_stack([
        *[hour == h for h in range(1, 24)], *[day == d for d in range(2, 8)],
        np.isin(day, (1, 7)), cells["is_holiday"].to_numpy(bool)]).astype(float)
    sums = cells[[f"x{i}" for i in range(k)]].to_numpy(float)
    p = k + flags.shape[1]
    total = n.sum()
    xx = np.zeros((p, p))
    for i in range(k):
        for j in range(i, k):
            xx[i, j] = xx[j, i] = cells[f"x{i}x{j}"].sum()
    xx[:k, k:] = sums.T @ flags
    xx[k:, :k] = xx[:k, k:].T
    xx[k:, k:] = (flags * n[:, None]).T @ flags
    mean_x = np.concatenate([sums.sum(axis=0), (flags * n[:, None]).sum(axis=0)]) / total
    mean_y = cells["y"].sum() / total
    xy = np.concatenate([
        cells[[f"x{i}y" for i in range(k)]].to_numpy(float).sum(axis=0), flags.T @ cells["y"].to_numpy(float)])
    centred = xx - total * np.outer(mean_x, mean_x)
    cxy = xy - total * mean_x * mean_y
    cyy = cells["yy"].sum() - total * mean_y**2
    scale = np.sqrt(np.clip(np.diag(centred), 0.0, None) / total)
    used = scale > 1e-9
    beta = np.zeros(p)
    if used.any():
        s = scale[used]
        lhs = centred[np.ix_(used, used)] / np.outer(s, s) + alpha * np.eye(used.sum())
        beta[used] = np.linalg.solve(lhs, cxy[used] / s) / s
    sse = max(cyy - 2.0 * beta @ cxy + beta @ centred @ beta, 0.0)
    return {
        "n_samples": int(total), "intercept": mean_y - beta @ mean_x, "weather_coef": beta[:k].tolist(),
        "hour_coef": [0.0, *beta[k:k + 23]], "weekday_coef": [0.0, *beta[k + 23:k + 29]],
        "weekend_coef": beta[k + 29], "holiday_coef": beta[k + 30],
        "residual_std": float(np.sqrt(sse / (total - 1))) if total > 1 else None,
    }


def fit_ridge(cells: DataFrame, alpha: float = 1.0, k: int = len(WEATHER)) -> DataFrame:
    """One model per site from its calendar cells."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"site_id": pdf["site_id"].iloc[0], **_solve_site(pdf, alpha, k)}])

    return cells.groupBy("site_id").applyInPandas(solve, MODEL_SCHEMA)


def predict(features: Sequence[str] = tuple(WEATHER)) -> Column:
    """Model value of a row that carries the model columns and the calendar columns."""
    yhat = F.col("intercept")
    for i, name in enumerate(features):
        yhat = yhat + F.element_at("weather_coef", i + 1) * F.col(name)
    yhat = yhat + F.element_at("hour_coef", F.col("hour_of_day") + 1) + F.element_at("weekday_coef", F.col("day_of_week"))
    yhat = yhat + F.when(F.col("is_weekend"), F.col("weekend_coef")).otherwise(0.0)
    return yhat + F.when(F.col("is_holiday"), F.col("holiday_coef")).otherwise(0.0)


def _feature_columns(features: Sequence[str]) -> list[tuple[Column, Column]]:
    """Every feature of a row, as a number, with its coefficient in the model columns."""
    weather = [(F.col(name), F.element_at("weather_coef", i + 1)) for i, name in enumerate(features)]
    flags = [*((F.col("hour_of_day") == h, F.element_at("hour_coef", h + 1)) for h in range(1, 24)),
             *((F.col("day_of_week") == d, F.element_at("weekday_coef", d)) for d in range(2, 8)),
             (F.col("is_weekend"), F.col("weekend_coef")), (F.col("is_holiday"), F.col("holiday_coef"))]
    return weather + [(flag.cast("double"), coef) for flag, coef in flags]


def normal_residual(train: DataFrame, models: DataFrame, alpha: float, features: Sequence[str] = tuple(WEATHER)) -> DataFrame:
    """How well each site's model solves its normal equations over the rows it was fitted on.

    The slope of the penalised squared error is zero in every coefficient at the solution. ``largest_slope`` is the largest of
    them per sample and standard deviation of the feature, ``mean_error`` the slope of the intercept. One pass of sums per site.
    """
    rows = train.dropna(subset=[*features, "baseline_actual_w"]).join(models, "site_id")
    error = F.col("baseline_actual_w") - predict(features)
    parts = _feature_columns(features)
    sums = rows.groupBy("site_id").agg(
        F.first("n_samples").alias("n_samples"), F.first("residual_std").alias("residual_std"), F.avg(error).alias("mean_error"),
        F.sum(error * error).alias("_sse"), (F.var_pop("baseline_actual_w") * F.count("*")).alias("_total"),
        *[F.struct(F.sum(x * error).alias("xe"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.first(coef).alias("coef")).alias(f"_f{i}")
          for i, (x, coef) in enumerate(parts)])
    slope = [F.when(F.col(f"_f{i}.std") > 1e-9, F.abs(
        (F.col(f"_f{i}.xe") - F.col(f"_f{i}.mean") * F.col("mean_error") * F.col("n_samples")) / F.col(f"_f{i}.std")
        - F.lit(alpha) * F.col(f"_f{i}.coef") * F.col(f"_f{i}.std"))).otherwise(0.0) for i in range(len(parts))]
    return sums.select("site_id", "n_samples", "residual_std", (1 - F.col("_sse") / F.col("_total")).alias("r2"), "mean_error",
                       (F.greatest(*slope) / F.col("n_samples")).alias("largest_slope"))


def residual_std(pairs: DataFrame, by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Spread of ``actual - yhat`` over the rows that have both."""
    return pairs.groupBy(*by).agg(F.stddev_samp(F.col("actual") - F.col("yhat")).alias("residual_std"))


def training_rows(components: DataFrame, weather: DataFrame, p: Mapping[str, Any], issue_ts: str,
                  holidays: DataFrame | None = None) -> DataFrame:
    """Measured baseline with the weather of its slot, inside the training window."""
    inside = training_window("ts", ts_lit(issue_ts), None, p["train_days"])
    actual = components.filter(inside).select("site_id", "ts", "baseline_actual_w")
    joined = actual.join(weather.filter(inside).select("site_id", "ts", *WEATHER), ["site_id", "ts"])
    return calendar_features(joined, p["tz"], holidays=holidays)


def baseline_forecast(components: DataFrame, weather: DataFrame, p: Mapping[str, Any], issue_ts: str,
                      horizon: int = 192, holidays: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Run header and values of the baseline load for the ``horizon`` slots after ``issue_ts``."""
    issued = ts_lit(issue_ts)
    models = fit_ridge(gram(training_rows(components, weather, p, issue_ts, holidays)), p["alpha"])
    future = weather.filter(horizon_filter("ts", issued, horizon)).select("site_id", "ts", *WEATHER)
    scored = calendar_features(future, p["tz"], holidays=holidays).join(models, "site_id").withColumn("yhat_p50", predict())
    half = F.lit(Z_P90) * F.col("residual_std")
    values = scored.select(
        run_id(F.col("site_id"), p, issued).alias("run_id"), "site_id", F.lit("baseline_w").alias("target"),
        F.col("ts").alias("target_ts"), "yhat_p50", (F.col("yhat_p50") - half).alias("yhat_p10"),
        (F.col("yhat_p50") + half).alias("yhat_p90"))
    notes = F.concat(F.lit("n="), F.col("n_samples").cast("string"), F.lit(" residual_std="),
                     F.round("residual_std", 1).cast("string"))
    return run_header(models.withColumn("ratio_source", F.lit(None).cast("string")), p, issued, notes), values
