"""Household consumption: total, reference load, components, events and daily figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.timeparts import epoch_seconds, local_date
from ..schemas import COMPONENT_DEFAULTS
from .chunked import CHUNK, DAY, home_rows, placed, with_chunk, with_halo

COMPONENTS = ("total_actual_w", "baseline_actual_w", "ev_actual_w", "sauna_actual_w", "other_actual_w")
SLOT_HOURS = 0.25


def consumption_expr(pv: str, pcc: str, charge: str, discharge: str) -> Column:
    """Power balance; a positive value at the coupling point is export. A missing reading gives NULL, not zero."""
    return F.col(pv) - F.col(pcc) + F.col(discharge) - F.col(charge)


def home_consumption(station: DataFrame) -> DataFrame:
    raw = consumption_expr("pv_feed_in_w", "active_power_pcc_w", "bat_charge_w", "bat_discharge_w")
    return station.select("site_id", "ts", raw.alias("home_consumption_raw_w")).withColumn(
        "home_consumption_actual_w",
        F.when(F.col("home_consumption_raw_w").isNotNull(), F.greatest(F.lit(0.0), "home_consumption_raw_w")))


def reference_load(df: DataFrame, col: str = "total_actual_w", half_window_hours: int = 24,
                   by: Sequence[str] = ("site_id",), length: int = 8 * DAY) -> DataFrame:
    """Median load within ``half_window_hours`` on either side of each slot, as ``reference_w``.

    The frame is in time, so on a full grid it is the same number of slots on either side and a hole in the data
    does not make it reach further. At most 193 quarter hours enter a median by default. A row without a site or a time
    has no reference.
    """
    half = half_window_hours * 3600
    copies = with_halo(df, "ts", half, half, length, keep_untimed=True)
    reach = f"INTERVAL {half_window_hours} HOURS"
    frame = f"PARTITION BY {', '.join([*by, CHUNK])} ORDER BY ts RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING"
    median = F.expr(f"percentile({col}, 0.5D) OVER ({frame})")
    return home_rows(copies.withColumn("reference_w", F.when(placed(by, "ts"), median)))


def classify_excess(df: DataFrame, p: Mapping[str, Any] = COMPONENT_DEFAULTS) -> DataFrame:
    """Split the load over its reference into one of the event classes; the rest is baseline.

    The first matching class takes the whole excess, so the parts always add up to the total. Without a reference they are unknown.
    """
    excess = F.greatest(F.col("total_actual_w") - F.col("reference_w"), F.lit(0.0))
    event = (F.when(excess.between(p["ev_min_w"], p["ev_max_w"]), F.lit("ev"))
             .when(excess.between(p["sauna_min_w"], p["sauna_max_w"]), F.lit("sauna"))
             .when(excess > p["other_min_w"], F.lit("other"))
             .otherwise(F.lit("none")))
    known = F.col("total_actual_w").isNotNull() & F.col("reference_w").isNotNull()
    out = df.withColumn("_excess", F.when(known, excess)).withColumn("event_class", F.when(known, event))

    def part(name: str) -> Column:
        return F.when(known, F.when(F.col("event_class") == name, F.col("_excess")).otherwise(F.lit(0.0)))

    return out.withColumns({f"{name}_actual_w": part(name) for name in ("ev", "sauna", "other")}).withColumn(
        "baseline_actual_w",
        F.col("total_actual_w") - F.col("ev_actual_w") - F.col("sauna_actual_w") - F.col("other_actual_w")
    ).drop("_excess")


def event_islands(df: DataFrame, cls: str = "event_class", by: Sequence[str] = ("site_id",), step_seconds: int = 900,
                  length: int = 8 * DAY) -> DataFrame:
    """Number runs of consecutive slots of one class, per site from 1, as ``event_id``.

    A run ends when the class changes or a slot is missing. Runs are counted per chunk; a row per chunk carries its
    first and last slot and its count across the border. A row without a site or a time is in no run.
    """
    key = [*by, CHUNK]
    inside = Window.partitionBy(*key).orderBy("ts")
    seconds = epoch_seconds("ts")
    chunked = with_chunk(df, "ts", length)
    changed = (~F.lag(cls).over(inside).eqNullSafe(F.col(cls))) | (seconds - F.lag(seconds).over(inside) > step_seconds)
    local = chunked.withColumn("_breaks", F.when(F.lag("ts").over(inside).isNull(), 0).otherwise(changed.cast("int")))

    edges = local.filter(placed(by, "ts")).groupBy(*key).agg(
        F.sum("_breaks").alias("_inner"), F.min("ts").alias("_from"), F.max("ts").alias("_to"),
        F.min_by(cls, "ts").alias("_first"), F.max_by(cls, "ts").alias("_last"))
    across = Window.partitionBy(*by).orderBy(CHUNK)
    joins_on = (F.lag("_last").over(across).eqNullSafe(F.col("_first"))
                & (epoch_seconds("_from") - F.lag(epoch_seconds("_to")).over(across) <= step_seconds))
    edges = edges.withColumn("_starts", F.when(F.coalesce(joins_on, F.lit(False)), 0).otherwise(1))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*key, (F.coalesce(F.sum(F.col("_inner") + F.col("_starts")).over(before), F.lit(0))
                                + F.col("_starts")).alias("_base"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    number = (F.col("_base") + F.sum("_breaks").over(so_far)).cast("bigint")
    return local.join(edges, key, "left").select(*df.columns, F.when(placed(by, "ts"), number).alias("event_id"))


def consumption_components(df: DataFrame, p: Mapping[str, Any] = COMPONENT_DEFAULTS) -> DataFrame:
    """``site_id, ts, total_actual_w`` split into baseline, car charging, sauna and other load, with event ids."""
    referenced = reference_load(df.select("site_id", "ts", "total_actual_w"), half_window_hours=p["half_window_hours"])
    return event_islands(classify_excess(referenced, p)).select("site_id", "ts", *COMPONENTS, "event_class", "event_id")


def event_summary(components: DataFrame) -> DataFrame:
    """One row per event: start, end of the last slot, slots, energy and peak."""
    watts = F.col("ev_actual_w") + F.col("sauna_actual_w") + F.col("other_actual_w")
    events = components.filter("event_class <> 'none'").groupBy("site_id", "event_class", "event_id")
    return events.agg(
        F.min("ts").alias("start_ts"), F.timestamp_add("MINUTE", F.lit(15), F.max("ts")).alias("end_ts"),
        F.count(F.lit(1)).alias("n_slots"), (F.sum(watts) * SLOT_HOURS / 1000.0).alias("energy_kwh"),
        F.max(watts).alias("peak_w"))


def keyed_events(components: DataFrame) -> DataFrame:
    """``event_summary`` with an ``event_key`` of site, class and start. Unlike ``event_id``, which counts from the first row that was read, it
    is the same whatever else was read, as long as the event and the day before it were."""
    key = F.concat_ws("|", "site_id", "event_class", F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm"))
    return event_summary(components).drop("event_id").withColumn("event_key", key)


def energy_kwh(col: str) -> Column:
    return F.sum(col) * SLOT_HOURS / 1000.0


def daily_kpi(df: DataFrame, col: str, tz: str, expected: DataFrame | None = None) -> DataFrame:
    """Points, missing points, mean and peak power and energy per site and local day.

    ``expected`` is a grid of slots; without one a day is missing what 96 slots lack, or 92 or 100 on days with a
    clock change.
    """
    day = local_date("ts", tz).alias("local_date")
    kpi = df.groupBy("site_id", day).agg(
        F.count(col).alias("points"), F.avg(col).alias("avg_w"), F.max(col).alias("peak_w"),
        energy_kwh(col).alias("energy_kwh"))
    if expected is not None:
        slots = expected.groupBy("site_id", day).agg(F.count(F.lit(1)).alias("_slots"))
        kpi = slots.join(kpi, ["site_id", "local_date"], "left").withColumn("points", F.coalesce("points", F.lit(0)))
    else:
        kpi = kpi.withColumn("_slots", day_slots(F.col("local_date"), tz))
    return kpi.select("site_id", "local_date", "points", (F.col("_slots") - F.col("points")).alias("missing"),
                      "avg_w", "peak_w", "energy_kwh")


def day_slots(date: Column, tz: str) -> Column:
    """Quarter hours in a local day."""
    midnight = date.cast("timestamp_ntz")
    start = F.convert_timezone(F.lit(tz), F.lit("UTC"), midnight)
    end = F.convert_timezone(F.lit(tz), F.lit("UTC"), F.timestamp_add("DAY", F.lit(1), midnight))
    return ((epoch_seconds(end) - epoch_seconds(start)) / 900).cast("bigint")


def component_energy(components: DataFrame, tz: str) -> DataFrame:
    """Energy per component, site and local day."""
    return components.groupBy("site_id", local_date("ts", tz).alias("local_date")).agg(
        *[energy_kwh(c).alias(c.replace("_actual_w", "_kwh")) for c in COMPONENTS])
