"""Solar feed-in forecast: effective radiation, a fitted ratio per site, bands."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.solar import cloud_factor, cos_incidence, panel_gain, sun_position
from ..functions.timeparts import file_stamp, shift, ts_lit
from ..schemas import PV_PRODUCTION
from .chunked import spread_join

RAD, CLOUD, PV = "fc_shortwave_radiation_w_m2", "fc_cloud_cover_pct", "station_pv_feed_in_w"
HALF_SLOT_SECONDS = 450


def effective_radiation(df: DataFrame, p: Mapping[str, Any] = PV_PRODUCTION) -> DataFrame:
    """Add ``elevation_deg``, ``cos_aoi`` and ``effective_rad``, with the sun taken at the middle of the slot."""
    sun = sun_position(shift("ts", HALF_SLOT_SECONDS), p["lat"], p["lon"])
    cos_aoi = cos_incidence(sun["declination"], sun["hour_angle"], p["lat"], p["panel_tilt_deg"], p["panel_azimuth_deg"])
    light = F.col(RAD) * cloud_factor(CLOUD, p["cloud_floor"], p["cloud_exp"])
    return df.withColumns({"elevation_deg": sun["elevation_deg"], "cos_aoi": cos_aoi}).withColumn(
        "effective_rad", light * panel_gain(F.col("cos_aoi"), p["diffuse_floor"]))


def roof_radiation(df: DataFrame, roofs: DataFrame, p: Mapping[str, Any] = PV_PRODUCTION) -> DataFrame:
    """Add ``elevation_deg``, ``effective_rad`` and ``max_pv_w`` from the roofs that a site has at the time of each slot.

    ``roofs`` has ``site_id, valid_from, valid_to, lat, lon, panel_tilt_deg, panel_azimuth_deg, share, max_w``: a row per roof and
    time for which it stands like this, the end left out, a null end open. The light of several roofs is added up by ``share``,
    their caps too. A slot without a roof has no effective radiation. The few rows of a site travel as one array, so no row of
    ``df`` is multiplied, and the position of the sun is that of the site's first roof.
    """
    known = roofs.groupBy("site_id").agg(F.sort_array(F.collect_list(F.struct(
        "valid_from", "valid_to", "lat", "lon", "panel_tilt_deg", "panel_azimuth_deg", "share", "max_w"))).alias("_roofs"))
    standing = F.filter("_roofs", lambda r: (F.col("ts") >= r["valid_from"]) & (r["valid_to"].isNull() | (F.col("ts") < r["valid_to"])))
    rows = spread_join(df, known, ["site_id"], ["ts"]).withColumn("_roofs", standing)
    first = F.try_element_at("_roofs", F.lit(1))
    sun = sun_position(shift("ts", HALF_SLOT_SECONDS), first["lat"], first["lon"])
    rows = rows.withColumns({"elevation_deg": F.when(F.size("_roofs") > 0, sun["elevation_deg"]), "_declination": sun["declination"], "_hour_angle": sun["hour_angle"]})
    gains = F.transform("_roofs", lambda r: r["share"] * panel_gain(
        cos_incidence(F.col("_declination"), F.col("_hour_angle"), r["lat"], r["panel_tilt_deg"], r["panel_azimuth_deg"]), p["diffuse_floor"]))
    light = F.col(RAD) * cloud_factor(CLOUD, p["cloud_floor"], p["cloud_exp"])

    def total(parts: Column) -> Column:
        return F.when(F.size("_roofs") > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))

    caps = F.transform("_roofs", lambda r: r["max_w"].cast("double"))
    return rows.withColumns({"effective_rad": light * total(gains), "max_pv_w": total(caps)}).drop("_roofs", "_declination", "_hour_angle")


def training_window(ts: str, now: Column, cutoff: str | None, days: int) -> Column:
    """Rows before ``now``, not before the cutoff and at most ``days`` old."""
    oldest = F.timestamp_add("DAY", F.lit(-days), now)
    start = oldest if cutoff is None else F.greatest(ts_lit(cutoff), oldest)
    return (F.col(ts) >= start) & (F.col(ts) < now)


def fit_ratio(df: DataFrame, p: Mapping[str, Any], now: Column, sites: DataFrame) -> DataFrame:
    """Median of feed-in over effective radiation for each of ``sites``, or the bootstrap ratio when samples are few.

    Only the training window is read, so a median sees at most ``train_days * 96`` slots of a site.
    """
    usable = ((F.col(RAD) >= p["min_radiation"]) & (F.col("effective_rad") > 0) & F.col(PV).isNotNull())
    history = df.filter(training_window("ts", now, p["cutoff"], p["train_days"]) & usable)
    ratio = F.col(PV) / F.col("effective_rad")
    fits = history.groupBy("site_id").agg(F.count(ratio).alias("_n"), F.percentile(ratio, 0.5).alias("_learned"))
    enough = F.coalesce("_n", F.lit(0)) >= p["min_train_samples"]
    return sites.select("site_id").distinct().join(fits, "site_id", "left").select(
        "site_id", F.coalesce("_n", F.lit(0)).alias("n_samples"),
        F.when(enough, F.col("_learned")).otherwise(F.lit(p["bootstrap_ratio"])).alias("ratio"),
        F.when(enough, F.lit("learned")).otherwise(F.lit("bootstrap")).alias("ratio_source"))


def predict_pv(df: DataFrame, p: Mapping[str, Any]) -> DataFrame:
    """``yhat_p50/p10/p90`` from ``ratio`` and ``effective_rad``: zero at night and in faint light, capped, wider
    under cloud."""
    dark = (F.col(RAD) < p["min_radiation"]) | (F.col("elevation_deg") < p["min_elevation_deg"])
    raw = F.col("ratio") * F.col("effective_rad")
    p50 = F.when(dark, F.lit(0.0)).when(raw.isNotNull(), F.least(raw, F.lit(p["max_pv_w"])))
    spread = F.lit(p["band_base"]) + F.lit(p["band_cloud"]) * F.coalesce(F.col(CLOUD), F.lit(100.0)) / 100.0
    known = F.col("yhat_p50").isNotNull()
    return df.withColumn("yhat_p50", p50).withColumns({
        "yhat_p10": F.when(known, F.greatest(F.lit(0.0), F.col("yhat_p50") * (F.lit(1.0) - spread))),
        "yhat_p90": F.when(known, F.least(F.lit(p["max_pv_w"]), F.col("yhat_p50") * (F.lit(1.0) + spread))),
    })


def run_id(site: Column | str, p: Mapping[str, Any], issued: Column) -> Column:
    """Same site, model and issue time give the same id, so a repeated run replaces itself."""
    return F.md5(F.concat_ws("|", site, F.lit(p["model_name"]), F.lit(p["model_version"]), file_stamp(issued)))


def run_header(sites: DataFrame, p: Mapping[str, Any], issued: Column, notes: Column) -> DataFrame:
    return sites.select(
        run_id(F.col("site_id"), p, issued).alias("run_id"), "site_id", F.lit(p["model_name"]).alias("model_name"),
        F.lit(p["model_version"]).alias("model_version"), issued.alias("issued_at"),
        "ratio_source", notes.alias("notes"))


def horizon_filter(ts: str, issued: Column, slots: int) -> Column:
    """The next ``slots`` quarter hours after the issue time."""
    return (F.col(ts) > issued) & (F.col(ts) <= F.timestamp_add("MINUTE", F.lit(15 * slots), issued))


def pv_forecast(fusion: DataFrame, p: Mapping[str, Any], issue_ts: str, horizon: int = 96,
                roofs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Run header and values for the ``horizon`` slots after ``issue_ts``. With ``roofs`` (see :func:`roof_radiation`) panels and
    cap are those of each site at the time of the slot, and not those of ``p``."""
    issued, slots = ts_lit(issue_ts), fusion.select("site_id", "ts", RAD, CLOUD, PV)
    lit = effective_radiation(slots, p) if roofs is None else roof_radiation(slots, roofs, p)
    if roofs is not None:
        p = {**p, "max_pv_w": F.col("max_pv_w")}
    future = lit.filter(horizon_filter("ts", issued, horizon))
    ratios = fit_ratio(lit, p, issued, future)
    values = predict_pv(future.join(ratios, "site_id"), p).select(
        run_id(F.col("site_id"), p, issued).alias("run_id"), "site_id", F.lit("pv_feed_in_w").alias("target"),
        F.col("ts").alias("target_ts"), "yhat_p50", "yhat_p10", "yhat_p90")
    notes = F.concat(F.lit("ratio="), F.round("ratio", 4).cast("string"), F.lit(" n="), F.col("n_samples").cast("string"))
    return run_header(ratios, p, issued, notes), values
