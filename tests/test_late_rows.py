"""Raw rows that land late are averaged, whatever their age and whatever is stored of their day."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.schemas import TELEMETRY
from hearthwatt.sources import imports

NOW = datetime(2026, 3, 29, 6, 0)


def archive(spark, first: datetime, minutes: int, step: int = 1, value: float = 1.0):
    rows = spark.range(0, minutes, step).withColumns({
        "site_id": F.lit("a"), "ts": F.timestamp_add("MINUTE", F.col("id"), ts_lit(first)), "temperature_c": F.lit(value)})
    return rows.select([(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TELEMETRY])


def test_late_rows(spark, tmp_path):
    root, inbox = str(tmp_path / "tables"), str(tmp_path / "inbox")

    def land(now: datetime, *archives):
        for frame in archives:
            frame.write.mode("append").parquet(inbox)
        imports.import_archives(spark, inbox, root)
        imports.import_station_means(spark, root, now).count()  # readable after the log has changed
        stored = spark.read.parquet(f"{root}/station_15min")
        return {r.ts: (r.temperature_c, r.updated_at) for r in stored.collect()}

    day = datetime(2026, 3, 26)
    means = land(day + timedelta(hours=12), archive(spark, day, 720, step=2))
    assert len(means) == 48
    # Three days later: the second half of that day, and the odd minutes of its first two hours.
    means = land(NOW, archive(spark, day + timedelta(hours=12), 720), archive(spark, day + timedelta(minutes=1), 120, 2, 3.0))
    assert len(means) == 96 and max(means) == day + timedelta(days=1)
    assert means[day + timedelta(minutes=30)][0] == (7 * 1.0 + 8 * 3.0) / 15
    # Older than any window.
    old = datetime(2025, 12, 1)
    means = land(NOW + timedelta(minutes=15), archive(spark, old, 60))
    assert len(means) == 100 and old + timedelta(minutes=15) in means
    # Averaged once: the next run leaves those days as they are.
    assert land(NOW + timedelta(minutes=30)) == means
    # A day that is not over stays in the log: rows ahead of the run, and no run for two days.
    means = land(NOW + timedelta(minutes=45), archive(spark, NOW, 120))
    assert len(means) == 103
    means = land(NOW + timedelta(days=3))
    assert len(means) == 108


def test_rows_from_before_the_log(spark, tmp_path):
    root = str(tmp_path / "tables")
    old = archive(spark, datetime(2025, 12, 1), 60)
    old.withColumn("dt", F.col("ts").cast("date")).write.partitionBy("dt").parquet(f"{root}/telemetry_raw")
    imports.import_station_means(spark, root, NOW)
    assert spark.read.parquet(f"{root}/station_15min").count() == 4
