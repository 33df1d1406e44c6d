"""The scheduled jobs one after another on two days of one site."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.operators.keyed import newest_per_target
from hearthwatt.operators.quality import health_report, readable
from hearthwatt.schemas import FUSION_COLUMNS, MEASURED, TELEMETRY
from hearthwatt.sources import imports, snapshots

NOW = datetime(2026, 3, 29, 6, 0)


def price_document(start: datetime, slots: int) -> str:
    points = "".join(f"<Point><position>{i + 1}</position><price.amount>{50 + i % 7}</price.amount></Point>" for i in range(slots) if i % 5)
    end = start + timedelta(minutes=15 * slots)
    return (f'<Publication_MarketDocument><TimeSeries><in_Domain.mRID codingScheme="A01">Z</in_Domain.mRID><Period><timeInterval>'
            f"<start>{start:%Y-%m-%dT%H:%MZ}</start><end>{end:%Y-%m-%dT%H:%MZ}</end></timeInterval><resolution>PT15M</resolution>{points}</Period></TimeSeries></Publication_MarketDocument>")


def weather_document(start: datetime, hours: int) -> str:
    rows = ""
    for h in range(hours):
        for name, value in (("Temperature", h % 9), ("WindSpeedMS", 3), ("WindDirection", 90), ("TotalCloudCover", 50), ("RadiationGlobalAccumulation", 360000 * (h % 24))):
            rows += (f"<b:BsWfsElement><b:Time>{start + timedelta(hours=h):%Y-%m-%dT%H:%M:%SZ}</b:Time><b:ParameterName>{name}</b:ParameterName>"
                     f"<b:ParameterValue>{value}</b:ParameterValue></b:BsWfsElement>")
    return f'<w:FeatureCollection xmlns:w="w" xmlns:b="b">{rows}</w:FeatureCollection>'


def test_jobs(spark, tmp_path):
    root, inbox = str(tmp_path / "tables"), str(tmp_path / "inbox")
    start = NOW - timedelta(hours=24)
    minute = spark.range(24 * 60).select(F.lit("a").alias("site_id"), F.timestamp_add("MINUTE", F.col("id"), ts_lit(start)).alias("ts"), "id")
    raw = minute.withColumns({
        **{c: (F.col("id") % (10 + i)).cast("double") for i, c in enumerate(MEASURED[:7])}, **{c: F.col("id") % (100 + i) for i, c in enumerate(MEASURED[7:])},
        "registers": F.create_map(F.lit("30517"), F.col("id").cast("double")), "merged_at": F.col("ts"), "pushed_at": F.lit(None).cast("timestamp_ntz")})
    raw = raw.select([F.col(f.name).cast(f.dataType) for f in TELEMETRY])
    raw.write.parquet(inbox)
    sites = spark.createDataFrame([("a", "Z")], "site_id string, zone string")
    (tmp_path / "prices.xml").write_text(price_document(start, 96 * 3))
    (tmp_path / "weather" / "site_id=a").mkdir(parents=True)
    (tmp_path / "weather" / "site_id=a" / "f.xml").write_text(weather_document(start, 74))

    for _ in range(2):  # every job twice: nothing is stored twice
        imports.import_archives(spark, inbox, root)
        assert imports.import_station_means(spark, root, NOW).count() == 0
        assert imports.import_dayahead(spark, str(tmp_path / "prices.xml"), root, NOW).count() == 0
        imports.import_forecast(spark, str(tmp_path / "weather"), root, NOW, allow_accumulation=True)
    assert spark.read.parquet(f"{root}/telemetry_raw").count() == 24 * 60
    assert spark.read.parquet(f"{root}/station_15min").count() == 96
    assert spark.read.parquet(f"{root}/prices").count() == 96 * 3
    prices = spark.read.parquet(f"{root}/prices").filter("price_eur_per_mwh IS NULL")
    assert prices.count() == 1  # only the first slot has nothing before it

    series = imports.stored_fusion(spark, root, sites)
    assert series.columns[1:] == FUSION_COLUMNS and series.count() == 96 * 3
    assert series.filter("fc_temperature_c IS NULL").count() == 0
    assert series.filter("station_temperature_c IS NOT NULL").count() == 96

    for i in range(3):
        version = imports.export_fusion(spark, root, sites, NOW + timedelta(minutes=15 * i), keep=2)
    assert snapshots.latest_version(spark, f"{root}/exports") == version
    assert len([p for p in Path(root, "exports").iterdir() if p.name.startswith("weather_fusion")]) == 2

    imports.run_pv_forecast(spark, root, sites, NOW)
    imports.run_baseline_forecast(spark, root, sites, NOW)
    runs, values = spark.read.parquet(f"{root}/forecast_run"), spark.read.parquet(f"{root}/forecast_value")
    best = newest_per_target(values, runs)
    assert {r["target"]: r["count"] for r in best.groupBy("target").count().collect()} == {"pv_feed_in_w": 96, "baseline_w": 192}

    report = {r["check"]: r["status"] for r in health_report({
        "sites": sites, "station": spark.read.parquet(f"{root}/station_15min"), "forecast": spark.read.parquet(f"{root}/forecast_hourly"),
        "values": values, "runs": runs, "prices": spark.read.parquet(f"{root}/prices")}, NOW).collect()}
    assert report == {"station_freshness": "ok", "forecast_horizon": "ok", "baseline_forecast": "ok", "price_coverage": "ok"}
    assert readable(spark, "prices", lambda: spark.read.parquet(f"{root}/prices")).first()["status"] == "ok"
    assert readable(spark, "none", lambda: spark.read.parquet(f"{root}/none")).first()["status"] == "error"

    # An archive that lands three days late is averaged as well, once.
    late = raw.withColumn("ts", F.timestamp_add("DAY", F.lit(-3), F.col("ts"))).filter(F.col("ts") < ts_lit(start - timedelta(days=3) + timedelta(hours=2)))
    late.write.mode("append").parquet(inbox)
    for _ in range(2):
        imports.import_archives(spark, inbox, root)
        imports.import_station_means(spark, root, NOW)
        assert spark.read.parquet(f"{root}/station_15min").count() == 96 + 8
