"""Forecast jobs do not depend on published prices."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.schemas import FORECAST_COLUMNS, MEASURED
from hearthwatt.sources import imports, tables

NOW = datetime(2026, 3, 29, 6, 7)


def test_whole_horizon_without_prices(spark, tmp_path):
    root, start = str(tmp_path), datetime(2026, 3, 23)
    sites = spark.createDataFrame([("a", "Z"), ("b", "none")], "site_id string, zone string")
    hourly = sites.crossJoin(spark.range(24 * 9)).select(
        "site_id", F.timestamp_add("HOUR", F.col("id"), ts_lit(start)).alias("ts"),
        *[(F.col("id") % (24 + i) * 20).cast("double").alias(c) for i, c in enumerate(FORECAST_COLUMNS)])
    station = sites.crossJoin(spark.range(96 * 6)).select(
        "site_id", F.timestamp_add("MINUTE", 15 * F.col("id"), ts_lit(start)).alias("ts"),
        *[(F.col("id") % (90 + i)).cast("double").alias(c) for i, c in enumerate(MEASURED)])
    tables.upsert_stored(spark, hourly, f"{root}/forecast_hourly", ["site_id", "ts"], ts_lit(NOW))
    tables.upsert_stored(spark, station, f"{root}/station_15min", ["site_id", "ts"], ts_lit(NOW))
    # Before the afternoon: zone Z is priced until the end of the day, and not at all before it.
    prices = spark.range(96).select(F.lit("Z").alias("zone"), F.timestamp_add("MINUTE", 15 * F.col("id"), ts_lit(datetime(2026, 3, 29))).alias("ts"),
                                    F.lit(50.0).alias("price_eur_per_mwh"))
    tables.upsert_stored(spark, prices, f"{root}/prices", ["zone", "ts"], ts_lit(NOW))

    imports.run_pv_forecast(spark, root, sites, NOW)
    imports.run_baseline_forecast(spark, root, sites, NOW)
    values = spark.read.parquet(f"{root}/forecast_value").join(spark.read.parquet(f"{root}/forecast_run").select("run_id", "notes"), "run_id")
    got = {(r.site_id, r.target): r for r in values.groupBy("site_id", "target").agg(
        F.count("yhat_p50").alias("n"), F.min("target_ts").alias("first"), F.max("target_ts").alias("last"), F.first("notes").alias("notes")).collect()}
    first = datetime(2026, 3, 29, 6, 15)
    for site in "ab":
        for target, slots in (("pv_feed_in_w", 96), ("baseline_w", 192)):
            row = got[site, target]
            assert (row.n, row.first, row.last) == (slots, first, first + timedelta(minutes=15 * (slots - 1)))
    # Past slots without a price are used for training.
    assert "n=0" not in got["b", "pv_feed_in_w"].notes and got["a", "pv_feed_in_w"].notes == got["b", "pv_feed_in_w"].notes
