"""Streaming queries: the events table read as a stream to its end; the SQL is the batch form of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.timeparts import ts_lit
from ..schemas import SCALARS
from ..sources.shared import run_folder
from ..streaming.jobs import (
    EVENT_TIME, command_states, read_retained, read_rows, start_batches, start_files, start_upserts, stored, stream_avg_15min, stream_avg_registers,
    stream_command_state, stream_dedupe, stream_retained, stream_stale_alerts, with_event_time, with_rocksdb,
)
from . import adapters as a
from .adapters import SQL, STATION, ctes, table
from .registry import query, rounded, sql_round as r

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rows(spark, f"{sf_dir}/events.parquet*", table(spark, sf_dir, "events").schema)


def as_table(spark: SparkSession, name: str, stream: DataFrame) -> DataFrame:
    """Run a stream over what is there and return what it wrote."""
    folder = run_folder(spark, name)
    start_files(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def as_upserts(spark: SparkSession, name: str, stream: DataFrame, key: list[str]) -> DataFrame:
    """Run a stream of updated rows over what is there and return the table that they were upserted into."""
    folder = run_folder(spark, name)
    start_upserts(stream, f"{folder}/out", f"{folder}/checkpoint", key, now=a.NOW).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("dt")


def with_custom_state(spark: SparkSession, run: Callable[[], DataFrame]) -> DataFrame:
    before = with_rocksdb(spark)
    try:
        return run()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


_CLOSED = "time_bucket(INTERVAL 1 SECOND, (SELECT max(ts) FROM events))"
_ROUND = {**{c: 4 for c in SCALARS}, "wind_speed_ms": 4, "wind_direction_deg": 4}


@query("stream_avg_15min", ctes(*STATION) + "SELECT site_id, ts, rows_used, " + ", ".join(
    f"{r(c, d)} AS {c}" for c, d in _ROUND.items()) + " FROM station")
def averaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.telemetry_from(streamed(spark, sf_dir))
    means = as_upserts(spark, "avg", stream_avg_15min(rows, "1 hour"), ["site_id", "ts"])
    return rounded(means.drop("created_at", "updated_at"), _ROUND)


@query("stream_avg_registers", ctes("telemetry") + f"""
SELECT site_id, ts, register, {r('mean', 5)} AS mean FROM (
  SELECT site_id, time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES AS ts, '30775' AS register, avg(r30775) AS mean FROM telemetry GROUP BY 1, 2
  UNION ALL SELECT site_id, time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES, '30517', avg(r30517) FROM telemetry GROUP BY 1, 2)""")
def averaged_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.telemetry_from(streamed(spark, sf_dir))
    means = as_upserts(spark, "registers", stream_avg_registers(rows, "1 hour"), ["site_id", "ts", "register"])
    return rounded(means.drop("created_at", "updated_at"), {"mean": 5})


@query("stream_dedupe", "SELECT DISTINCT event_type AS site_id, time_bucket(INTERVAL 15 MINUTES, ts) AS ts FROM events")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.window("ts", "15 minutes").start
    rows = streamed(spark, sf_dir).select(F.col("event_type").alias("site_id"), slot.alias("ts"))
    return as_table(spark, "dedupe", stream_dedupe(rows))


@query("stream_upsert", ctes("prices") + f"""
SELECT zone, ts, {r('price_eur_per_mwh', 5)} AS price_eur_per_mwh, TIMESTAMP '{a.NOW}' AS created_at, TIMESTAMP '{a.NOW}' AS updated_at FROM prices""")
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.concat(F.lit("Z"), (F.col("user_id") % 2).cast("string")).alias("zone")
    means = with_event_time(streamed(spark, sf_dir), "1 day").groupBy(zone, F.window(EVENT_TIME, "15 minutes").alias("slot")).agg(
        F.avg("value").alias("price_eur_per_mwh")).select("zone", stored(F.col("slot.start")).alias("ts"), "price_eur_per_mwh")
    return rounded(as_upserts(spark, "upsert", means, ["zone", "ts"]), {"price_eur_per_mwh": 5})


@query("stream_retained", ctes("commands") + """
SELECT site_id, max(ts) AS ts, arg_max(command, ts) AS command FROM commands GROUP BY 1""")
def retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "retained")
    stream = stream_retained(a.commands_from(streamed(spark, sf_dir)))
    start_batches(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_retained(spark, f"{folder}/out")


@query("stream_command_state", ctes("commands", "valid_commands") + f""", following AS (
  SELECT *, lead(ts) OVER (PARTITION BY site_id ORDER BY ts) AS next_ts, ts + INTERVAL 1 MINUTE * minutes AS until FROM valid_commands)
SELECT site_id, ts, mode, 'command' AS cause FROM following
UNION ALL SELECT site_id, until, 'ALLOW', 'timeout' FROM following
WHERE until <= next_ts OR (next_ts IS NULL AND until <= {_CLOSED} - INTERVAL 10 MINUTES)""")
def command_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.commands_from(streamed(spark, sf_dir))
    return with_custom_state(spark, lambda: as_table(spark, "commands", stream_command_state(rows)))


_RESTART = "2024-01-16 00:00:00"


@query("stream_restart", ctes("commands", "valid_commands") + f""", following AS (
  SELECT *, lead(ts) OVER (PARTITION BY site_id ORDER BY ts) AS next_ts, ts + INTERVAL 1 MINUTE * minutes AS until FROM valid_commands)
SELECT site_id, ts, mode, 'command' AS cause FROM following WHERE ts >= TIMESTAMP '{_RESTART}'
UNION ALL SELECT site_id, until, 'ALLOW', 'timeout' FROM following
WHERE until > TIMESTAMP '{_RESTART}' AND (until <= next_ts OR (next_ts IS NULL AND until <= {_CLOSED} - INTERVAL 10 MINUTES))""")
def restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command stream of the second half, started without a checkpoint from what the first half has left."""
    first = a.commands(spark, sf_dir).filter(F.col("ts") < ts_lit(_RESTART))
    rows = a.commands_from(streamed(spark, sf_dir).filter(F.col("ts") >= ts_lit(_RESTART)))
    changes = lambda: stream_command_state(rows, history=command_states(first, _RESTART))
    return with_custom_state(spark, lambda: as_table(spark, "restart", changes()))


@query("stream_stale_alerts", f"""
WITH t AS (SELECT event_type AS site_id, ts FROM events),
n AS (SELECT site_id, ts, lead(ts) OVER (PARTITION BY site_id ORDER BY ts) AS next_ts FROM t)
SELECT site_id, ts + INTERVAL 60 MINUTES AS ts, ts AS last_seen_ts FROM n
WHERE next_ts - ts > INTERVAL 60 MINUTES OR (next_ts IS NULL AND ts + INTERVAL 60 MINUTES <= {_CLOSED} - INTERVAL 10 MINUTES)""")
def stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streamed(spark, sf_dir).select(F.col("event_type").alias("site_id"), "ts")
    return with_custom_state(spark, lambda: as_table(spark, "stale", stream_stale_alerts(rows, 60)))
