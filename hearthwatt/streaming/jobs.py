"""Streams over files or any other source with the right columns.

Stored times are UTC without a zone; watermarks need an instant, so each job derives ``event_time`` from ``ts``
without going through the session zone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.quantities import wind_components, wind_from_components
from ..functions.timeparts import epoch_seconds, from_epoch_seconds, ts_lit
from ..operators.control import parse_commands
from ..operators.keyed import dedupe
from ..operators.partials import add_partials, slot_partials
from ..schemas import ALLOWED_AVERAGES, SCALARS
from ..sources.shared import checkpoint_id
from ..sources.tables import upsert_stored
from ..sources.versions import merge, upsert_versioned
from .stateful import AutoRevert, StaleAlerts

EVENT_TIME = "event_time"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
QUARTER_HOUR = "15 minutes"


def read_rows(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the Parquet files under ``path``; the batch size is bounded in files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def instant(ts: Column | str) -> Column:
    """Event time of a UTC time."""
    return F.timestamp_micros(micros(ts))


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a UTC time."""
    return epoch_seconds(ts) * 1_000_000 + F.date_format(ts, "SSSSSS").cast("bigint")


def stored(at: Column) -> Column:
    return from_epoch_seconds(F.unix_seconds(at))


def from_micros(us: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(us), ts_lit("1970-01-01 00:00:00"))


def with_event_time(stream: DataFrame, lateness: str) -> DataFrame:
    return stream.withColumn(EVENT_TIME, instant("ts")).withWatermark(EVENT_TIME, lateness)


def stream_avg_15min(stream: DataFrame, lateness: str = "1 hour", cols: Sequence[str] = tuple(SCALARS)) -> DataFrame:
    """Quarter-hour means with the vector mean of the wind. In update mode with an upsert every slot is there from its
    first row on; in append mode a slot is emitted once, when it can no longer change."""
    east, north = wind_components("wind_speed_ms", "wind_direction_deg")
    sums = with_event_time(stream, lateness).groupBy("site_id", F.window(EVENT_TIME, QUARTER_HOUR)).agg(
        F.count(F.lit(1)).alias("rows_used"), *[F.avg(c).alias(c) for c in cols],
        F.avg(east).alias("_east"), F.avg(north).alias("_north"))
    speed, direction = wind_from_components(F.col("_east"), F.col("_north"))
    return sums.select("site_id", stored(F.col("window.end")).alias("ts"), "rows_used", *cols,
                       speed.alias("wind_speed_ms"), direction.alias("wind_direction_deg"))


def stream_avg_registers(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Quarter-hour mean of each register, one row per register; for the modes see ``stream_avg_15min``."""
    entries = with_event_time(stream, lateness).select("site_id", EVENT_TIME, F.explode("registers").alias("register", "value"))
    means = entries.groupBy("site_id", "register", F.window(EVENT_TIME, QUARTER_HOUR)).agg(F.avg("value").alias("mean"))
    return means.select("site_id", stored(F.col("window.end")).alias("ts"), "register", "mean")


def stream_dedupe(stream: DataFrame, key: Sequence[str] = ("site_id", "ts"), lateness: str = "1 hour") -> DataFrame:
    """First row of each key among those that arrive within the lateness."""
    return with_event_time(stream, lateness).dropDuplicatesWithinWatermark(list(key)).drop(EVENT_TIME)


def stream_retained(stream: DataFrame) -> DataFrame:
    """Newest command of each site; run in update mode."""
    return stream.groupBy("site_id").agg(F.max("ts").alias("ts"), F.max_by("command", "ts").alias("command"))


def command_states(commands: DataFrame, reported_until: datetime | str) -> DataFrame:
    """State that a batch of older commands leaves for each site: its newest command, and when that runs out unless it has before
    ``reported_until``, up to which a return to ALLOW has been reported already."""
    newest = parse_commands(commands).groupBy("site_id").agg(F.max_by(F.struct("ts", "minutes"), F.struct("ts", "command")).alias("c"))
    until = F.when(F.col("c.minutes").isNotNull(), micros("c.ts") + F.col("c.minutes").cast("bigint") * 60_000_000)
    return newest.select("site_id", micros("c.ts").alias("us"), F.when(until > micros(ts_lit(reported_until)), until).alias("until"))


def stream_command_state(stream: DataFrame, lateness: str = "10 minutes", history: DataFrame | None = None) -> DataFrame:
    """Mode changes of each site, with the return to ALLOW when a timed prohibition runs out without a new command.

    Rows are ``site_id, ts, mode, cause`` with cause ``command`` or ``timeout``. Of the commands of one microsecond a
    prohibition counts. A late command is reported, but neither mode nor timer goes back behind a newer one. ``history`` (see
    :func:`command_states`) is where the sites stand when the stream starts without a checkpoint. Append mode; needs RocksDB state.
    """
    rows = with_event_time(stream, lateness).select("site_id", EVENT_TIME, micros("ts").alias("us"), "command")
    changes = rows.groupBy("site_id").transformWithStateInPandas(
        AutoRevert(), outputStructType="site_id string, us bigint, mode string, cause string", outputMode="append",
        timeMode="eventTime", initialState=None if history is None else history.groupBy("site_id"))
    return changes.select("site_id", from_micros("us").alias("ts"), "mode", "cause")


def stream_stale_alerts(stream: DataFrame, minutes: int, lateness: str = "10 minutes") -> DataFrame:
    """One row when a site has sent nothing for ``minutes``, at the time that became true."""
    rows = with_event_time(stream, lateness).select("site_id", EVENT_TIME, micros("ts").alias("us"))
    alerts = rows.groupBy("site_id").transformWithStateInPandas(
        StaleAlerts(minutes), outputStructType="site_id string, us bigint, since_us bigint", outputMode="append",
        timeMode="eventTime")
    return alerts.select("site_id", from_micros("us").alias("ts"), from_micros("since_us").alias("last_seen_ts"))


def with_rocksdb(spark: SparkSession) -> str | None:
    """Select the state store that custom state needs; returns the setting to restore."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    return before


def start_files(stream: DataFrame, out: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Append the rows of a stream to Parquet files, exactly once through the sink's log."""
    return (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())


def start_upserts(stream: DataFrame, table: str, checkpoint: str, key: Sequence[str], now: datetime | str | None = None,
                  order: Sequence[str] = (), output_mode: str = "update", versioned: bool = False, **trigger: object) -> StreamingQuery:
    """Upsert every batch into a table partitioned by day, so late rows correct what was stored.

    A batch that is repeated after a failure writes the same values again. With ``versioned`` every batch is a version of the table:
    readers see none of it or all of it, and a repeated batch is left out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        at, session = ts_lit(now if now is not None else datetime.now(timezone.utc).replace(tzinfo=None)), batch.sparkSession
        if versioned:
            upsert_versioned(session, batch, table, key, at, order, (checkpoint_id(session, checkpoint), batch_id))
        else:
            upsert_stored(session, batch, table, key, at, order)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(output_mode)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_partials(stream: DataFrame, table: str, checkpoint: str, cols: Sequence[str] = tuple(ALLOWED_AVERAGES),
                   **trigger: object) -> StreamingQuery:
    """Add every batch of raw rows to the stored pieces of their slots, however late the rows are.

    No watermark and no state: what is read again are the pieces of the days that a batch touches. A repeated batch is left out.
    The stream must not hold a row twice (see ``stream_dedupe``).
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        merge(session, table, slot_partials(batch, cols), lambda old, new: new if old is None else add_partials(old, new),
              (checkpoint_id(session, checkpoint), batch_id))

    return (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_batches(stream: DataFrame, out: str, checkpoint: str, output_mode: str = "update", **trigger: object) -> StreamingQuery:
    """Write every batch of updated rows to a folder of its own; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(output_mode)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_retained(spark: SparkSession, out: str) -> DataFrame:
    """Newest command of each site over all batches written so far."""
    return dedupe(spark.read.parquet(out).select("site_id", "ts", "command"), ["site_id"], ["ts"])


def start_outbox(stream: DataFrame, push, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Hand every batch of new rows to ``push(batch)``; the checkpoint records what was handed over."""
    return (stream.writeStream.foreachBatch(lambda batch, _: push(batch)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
