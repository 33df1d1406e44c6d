"""The scheduled jobs from end to end: read, compute, store. Each may be run again without changing the outcome.

Any scheduler can start them; nothing in here waits or repeats. ``root`` is a folder of tables on shared storage:
``telemetry_raw``, ``landed_days``, ``station_15min``, ``prices``, ``forecast_hourly``, ``forecast_run``,
``forecast_value``, ``exports``; with versioned tables also ``station_partials``, ``dayahead_known`` and ``forecast_known``.

Jobs that upsert write versioned tables (see :mod:`.versions`) where :func:`prepare_versioned` has made them, and plain
partitioned ones otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.timeparts import ts_lit
from ..operators.averaging import avg_15min
from ..operators.baseline import baseline_forecast
from ..operators.consumption import consumption_components, home_consumption
from ..operators.fusion import power_from_accumulation, weather_fusion, with_weather
from ..operators.grid import split_aligned, time_grid
from ..operators.partials import add_partials, means_of_partials, slot_partials
from ..operators.pv import pv_forecast
from ..schemas import ALLOWED_AVERAGES, BASELINE_DEFAULTS, FORECAST_COLUMNS, PV_PRODUCTION, TELEMETRY
from . import landing, models, revisions, snapshots, tables, versions
from .shared import checkpoint_id, remove, run_folder, sweep

UPSERTED = ("station_15min", "prices", "forecast_hourly")


def prepare_versioned(spark: SparkSession, root: str, names: Sequence[str] = UPSERTED) -> None:
    """Make tables that jobs upsert into versioned: readers keep what they began to read, and an upsert that dies shows nothing."""
    for name in names:
        versions.create(spark, f"{root}/{name}")


def _upsert(spark: SparkSession, rows: DataFrame, path: str, key: Sequence[str], now: datetime) -> None:
    store = versions.upsert_versioned if versions.is_versioned(spark, path) else tables.upsert_stored
    store(spark, rows, path, key, ts_lit(now))


def stored_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of either kind; of a versioned one the newest version, whatever is committed while the frame is in use."""
    path = f"{root}/{name}"
    return versions.read(spark, path) if versions.is_versioned(spark, path) else spark.read.parquet(path)


def import_archives(spark: SparkSession, inbox: str, root: str, processed: str | None = None,
                    averaged: Sequence[str] | None = None) -> None:
    """Nightly: raw archives from the inbox, rows that are already there ignored.

    With ``averaged`` the sums of these columns over the new rows are added to the pieces of their slots in ``station_partials``, from
    which :func:`publish_station_means` takes means without reading raw rows. A batch that is repeated after a crash is
    added once: its number is part of the version that holds its sums.
    """
    checkpoint = f"{root}/_checkpoints/archives"

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession

        def add(new: DataFrame) -> None:
            versions.merge(session, f"{root}/station_partials", slot_partials(new, averaged),
                           lambda old, pieces: pieces if old is None else add_partials(old, pieces),
                           (checkpoint_id(session, checkpoint), batch_id))

        tables.insert_ignore_stored(session, batch, f"{root}/telemetry_raw", ["site_id", "ts"], ["merged_at"], add if averaged else None)
        # After the rows, and from all rows of the batch: a batch that is repeated after a crash logs its days then.
        _log_days(tables.with_day(batch).select("site_id", "dt").distinct(), root, "landed")

    (landing.read_archive(spark, inbox, TELEMETRY, processed).writeStream.foreachBatch(store)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def publish_station_means(spark: SparkSession, root: str, now: datetime, cols: Sequence[str] = tuple(ALLOWED_AVERAGES)) -> list[str]:
    """Every quarter hour: means of all complete slots whose pieces have changed, upserted. Returns the days that were read.

    These are the days that differ between the version of ``station_partials`` that was published last and the newest one, and
    those whose last slots were not complete then. What is read is bounded by what has landed, however old it is.
    """
    source, target = f"{root}/station_partials", f"{root}/station_15min"
    end = now.replace(minute=now.minute - now.minute % 15, second=0, microsecond=0)
    pieces, shown = versions.load(spark, source), versions.create(spark, target)
    if pieces is None:
        return []
    days = set(versions.changed_days(versions.known(spark, source, shown.sources.get("partials")), pieces))
    until = shown.sources.get("until")
    if until is not None:
        first = (datetime(1970, 1, 1) + timedelta(seconds=until)).date().isoformat()
        days |= {day for day in pieces.days if first <= day <= end.date().isoformat()}
    rows = means_of_partials(versions.read(spark, source, pieces, days), cols).filter(F.col("ts") <= ts_lit(end)).drop("rows_used")
    notes = {"partials": pieces.number, "until": int((end - datetime(1970, 1, 1)).total_seconds())}
    versions.upsert_versioned(spark, rows, target, ["site_id", "ts"], ts_lit(now), notes=notes)
    return sorted(days)


def _log_days(days: DataFrame, root: str, kind: str) -> None:
    """One entry of site-days to average, as one file, so that a reader finds all of it or nothing."""
    entry = days.coalesce(1).withColumn("entry", F.lit(f"{kind}-{uuid.uuid4().hex}"))
    entry.write.mode("append").partitionBy("entry").parquet(f"{root}/landed_days")


def import_station_means(spark: SparkSession, root: str, now: datetime, cols: Sequence[str] = tuple(ALLOWED_AVERAGES),
                         hours: int = 24) -> DataFrame:
    """Every quarter hour: means of the complete slots of the last hours, upserted. Returns the rows off the grid.

    Site-days that archives landed rows for are averaged whole again, however old they are. A day stays in the log until
    it is over, so none of its slots is forgotten. The first run finds no log of its own and averages all raw rows.
    """
    start = now.replace(minute=0, second=0, microsecond=0) - timedelta(hours=hours)
    end = now.replace(minute=now.minute - now.minute % 15, second=0, microsecond=0)
    raw = spark.read.parquet(f"{root}/telemetry_raw").filter(F.col("ts") < ts_lit(end))
    log = tables.read_stored(spark, f"{root}/landed_days")
    entries = [] if log is None else [row["entry"] for row in log.select("entry").distinct().collect()]
    if any(entry.startswith("kept-") for entry in entries):
        landed = log.filter(F.col("entry").isin(entries)).select("site_id", "dt")
    else:
        landed = spark.read.parquet(f"{root}/telemetry_raw").select("site_id", "dt")
    folder = run_folder(spark, "landed-days")  # kept: the rows off the grid are read after the log has changed
    landed.filter("dt IS NOT NULL").distinct().write.parquet(folder)
    landed = spark.read.schema("site_id string, dt date").parquet(folder)
    # Two reads with literal days, so that no other day is listed: the last hours, and older rows of the landed site-days.
    days = [row["dt"] for row in landed.select("dt").distinct().collect()]
    recent = raw.filter((F.col("dt") >= F.lit(start.date())) & (F.col("ts") >= ts_lit(start)))
    older = raw.filter(F.col("dt").isin(days) & (F.col("ts") < ts_lit(start))).join(landed, ["site_id", "dt"], "left_semi")
    good, quarantine = split_aligned(avg_15min(recent.unionByName(older), cols).drop("rows_used"))
    _upsert(spark, good, f"{root}/station_15min", ["site_id", "ts"], now)
    mark = spark.createDataFrame([(None, None)], landed.schema)  # an entry without rows would leave no file
    _log_days(landed.filter(F.col("dt") >= F.lit(end.date())).unionByName(mark), root, "kept")
    for entry in entries:
        remove(spark, f"{root}/landed_days/entry={entry}")
    return quarantine


def import_dayahead(spark: SparkSession, documents: str, root: str, now: datetime) -> DataFrame:
    """Prices of the landed documents, gaps filled forward, upserted. Returns the rows off the grid."""
    filled = landing.fill_dayahead(*landing.read_dayahead_xml(spark, documents))
    good, quarantine = split_aligned(filled.select("zone", "ts", "price_eur_per_mwh"))
    _upsert(spark, good, f"{root}/prices", ["zone", "ts"], now)
    return quarantine


def import_dayahead_documents(spark: SparkSession, inbox: str, root: str, now: datetime) -> DataFrame:
    """Prices of the documents that have come in since the last run; returns the rows off the grid.

    Every document is read once, into ``dayahead_known``. The days on which something new is known are filled forward, each with the
    day before it at hand, and upserted into ``prices``, which is a versioned table.
    """
    known, target = f"{root}/dayahead_known", f"{root}/prices"
    revisions.store_dayahead(spark, inbox, known, f"{root}/_checkpoints/dayahead")
    rows, days, notes = _new_days(spark, known, target, back=1)
    filled = revisions.known_prices(rows).filter(F.col("ts").cast("date").isin(days)).select("zone", "ts", "price_eur_per_mwh")
    good, quarantine = split_aligned(filled)
    versions.upsert_versioned(spark, good, target, ["zone", "ts"], ts_lit(now), notes=notes)
    return quarantine


def import_forecast_documents(spark: SparkSession, inbox: str, root: str, now: datetime, allow_accumulation: bool = False,
                              mode: str = "hourly") -> None:
    """Weather forecast of the documents that have come in since the last run, by way of ``forecast_known``."""
    known, target = f"{root}/forecast_known", f"{root}/forecast_hourly"
    revisions.store_forecast(spark, inbox, known, f"{root}/_checkpoints/forecast")
    rows, days, notes = _new_days(spark, known, target, back=1)
    hours = revisions.known_forecast(rows)
    hours = (power_from_accumulation(hours, mode) if allow_accumulation else hours).filter(F.col("ts").cast("date").isin(days))
    versions.upsert_versioned(spark, hours.select("site_id", "ts", *FORECAST_COLUMNS), target, ["site_id", "ts"], ts_lit(now), notes=notes)


def _new_days(spark: SparkSession, source: str, target: str, back: int) -> tuple[DataFrame, list[date], dict[str, int]]:
    """Rows of the days of ``source`` that ``target`` has not taken in yet and of ``back`` days before each, these days, and a note
    of how far ``target`` will be."""
    name, newest, shown = source.rsplit("/", 1)[-1], versions.load(spark, source), versions.create(spark, target)
    if newest is None:
        raise ValueError(f"nothing has been read into {source} yet")
    before = versions.known(spark, source, shown.sources.get(name))
    days = [date.fromisoformat(day) for day in versions.changed_days(before, newest) if day != versions.NO_DAY]
    near = {day - timedelta(days=i) for day in days for i in range(back + 1)}
    return versions.read(spark, source, newest, near), days, {name: newest.number}


def import_forecast(spark: SparkSession, documents: str, root: str, now: datetime, allow_accumulation: bool = False,
                    mode: str = "hourly") -> None:
    """Hourly weather forecast, upserted. Accumulated radiation stands in for the missing power only if allowed."""
    rows = landing.read_forecast_xml(spark, documents)
    rows = power_from_accumulation(rows, mode) if allow_accumulation else rows
    _upsert(spark, rows.select("site_id", "ts", *FORECAST_COLUMNS), f"{root}/forecast_hourly", ["site_id", "ts"], now)


def stored_fusion(spark: SparkSession, root: str, sites: DataFrame) -> DataFrame:
    """The wide series over the stored tables; a plan, nothing to refresh."""
    prices, forecast, station = (stored_table(spark, root, name) for name in ("prices", "forecast_hourly", "station_15min"))
    return weather_fusion(prices, forecast, station, sites)


def stored_components(spark: SparkSession, root: str, since: datetime | None = None) -> DataFrame:
    """Consumption components over the stored quarter hours; ``since`` reads only the days that are needed."""
    station = stored_table(spark, root, "station_15min")
    if since is not None:
        station = station.filter((F.col("dt") >= ts_lit(since).cast("date")) & (F.col("ts") >= ts_lit(since)))
    return consumption_components(home_consumption(station).select(
        "site_id", "ts", F.col("home_consumption_actual_w").alias("total_actual_w")))


def export_fusion(spark: SparkSession, root: str, sites: DataFrame, now: datetime, keep: int = 30) -> str:
    """Snapshot of the wide series: write, compare with the source, publish, drop all but the newest."""
    exports, series = f"{root}/exports", stored_fusion(spark, root, sites)
    version = snapshots.export_verified(series, exports, now)
    snapshots.publish_latest(spark, exports, version, now)
    published = snapshots.published(spark, exports).select(
        F.lit("export").alias("kind"), "version", F.col("published_at").alias("created_at"), "size_bytes")
    old = snapshots.retention(published, keep, min_bytes=1).select("version").distinct()
    snapshots.drop_versions(spark, exports, (row["version"] for row in old.toLocalIterator()))
    return version


def clean_up(spark: SparkSession, root: str, keep: int = 96, min_age_seconds: float = 86400.0) -> int:
    """Nightly: forget all but the newest ``keep`` versions of each table, and remove what they and finished or killed runs have left
    behind and nobody can be reading any more. Returns how many folders went."""
    tables_of = ["station_partials", "dayahead_known", "forecast_known", models.MODEL, models.LOG, *UPSERTED]
    gone = sum(versions.expire(spark, f"{root}/{name}", keep, min_age_seconds) for name in tables_of if versions.is_versioned(spark, f"{root}/{name}"))
    return gone + sweep(spark, min_age_seconds)


def stored_slots(spark: SparkSession, root: str, sites: DataFrame, now: datetime, train_days: int, horizon: int) -> DataFrame:
    """Forecast and measurement of every quarter hour of training and horizon, whether it has a price or not."""
    start = now.replace(minute=now.minute - now.minute % 15, second=0, microsecond=0) - timedelta(days=train_days)
    end = now.replace(microsecond=0) + timedelta(minutes=15 * horizon, seconds=1)
    grid = time_grid(sites.select("site_id").distinct(), ts_lit(start), ts_lit(end))
    hour = timedelta(hours=1)  # the slots of an hour need the hour before and after them
    near = F.col("dt").between(ts_lit(start - hour).cast("date"), ts_lit(end + hour).cast("date"))
    return with_weather(grid, stored_table(spark, root, "forecast_hourly").filter(near),
                        stored_table(spark, root, "station_15min").filter(near))


def run_pv_forecast(spark: SparkSession, root: str, sites: DataFrame, now: datetime,
                    p: Mapping[str, Any] = PV_PRODUCTION, horizon: int = 96) -> None:
    slots = stored_slots(spark, root, sites, now, p["train_days"], horizon)
    run, values = pv_forecast(slots, p, now.strftime("%Y-%m-%d %H:%M:%S"), horizon)
    tables.append_forecast_run(run, values, root)


def run_baseline_forecast(spark: SparkSession, root: str, sites: DataFrame, now: datetime,
                          p: Mapping[str, Any] = BASELINE_DEFAULTS, holidays: DataFrame | None = None, horizon: int = 192) -> None:
    """The reference load looks a day around each slot, so the components start a day before the training window."""
    components = stored_components(spark, root, now - timedelta(days=p["train_days"] + 1))
    slots = stored_slots(spark, root, sites, now, p["train_days"], horizon)
    run, values = baseline_forecast(components, slots, p, now.strftime("%Y-%m-%d %H:%M:%S"), horizon, holidays)
    tables.append_forecast_run(run, values, root)
