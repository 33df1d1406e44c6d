"""Time grids, gap filling and gap reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.timeparts import aligned_15min, epoch_seconds, from_epoch_seconds, local_day_bounds, shift, with_slot
from .chunked import CHUNK, fill_forward, neighbours, placed, with_chunk

QUARTER_HOUR = 900
# Slots of a chunk when whole spans are filled: a day of quarter hours, 96 days of days.
CHUNK_SLOTS = 96


def slots_between(bounds: DataFrame, by: Sequence[str], first: str, last: str, step_seconds: int = QUARTER_HOUR) -> DataFrame:
    """One row per slot from ``first`` to ``last`` inclusive, per row of ``bounds``.

    Built in two steps, days and then the slots of a day, so no row ever holds an array longer than one day's slots.
    """
    days = with_slot(bounds.select(*by, first, last), first, "1 day", "_day0")
    days = days.withColumn("_day", F.explode(F.sequence("_day0", last, F.expr("INTERVAL 1 DAY"))))
    offset = F.pmod(epoch_seconds(first), F.lit(step_seconds))
    step = F.expr(f"INTERVAL '{step_seconds}' SECOND")
    day_end = shift("_day", 86400 - 1)
    slots = days.withColumn("_start", F.timestamp_add("SECOND", F.pmod(
        offset - epoch_seconds("_day"), F.lit(step_seconds)), F.col("_day")))
    slots = slots.filter(F.col("_start") <= day_end)
    return slots.select(
        *by, first, last, F.explode(F.sequence(F.col("_start"), day_end, step)).alias("ts")
    ).filter((F.col("ts") >= F.col(first)) & (F.col("ts") <= F.col(last))).select(*by, "ts")


def time_grid(sites: DataFrame, start: Column, end: Column, step_seconds: int = QUARTER_HOUR,
              by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Grid of all slots in ``[start, end)`` for every row of ``sites``."""
    bounds = sites.select(*by, start.alias("_first"), shift(end, -1).alias("_last"))
    return slots_between(bounds, by, "_first", "_last", step_seconds)


def span_grid(df: DataFrame, by: Sequence[str], ts: str = "ts", step_seconds: int = QUARTER_HOUR) -> DataFrame:
    """Grid from the first to the last row of each site."""
    bounds = df.groupBy(*by).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    return slots_between(bounds, by, "_first", "_last", step_seconds)


def local_day_grid(sites: DataFrame, day: str, tz: str, by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Quarter hours of one local day: 96 slots, 92 or 100 when the clock changes."""
    return time_grid(sites, *local_day_bounds(day, tz), by=by)


def on_grid(df: DataFrame, grid: DataFrame, by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Every grid slot with the data that exists for it; absent points stay as NULL."""
    return grid.join(df, [*by, "ts"], "left")


def missing_slots(df: DataFrame, grid: DataFrame, by: Sequence[str] = ("site_id",)) -> DataFrame:
    return grid.join(df.select(*by, "ts"), [*by, "ts"], "left_anti")


def find_gaps(df: DataFrame, by: Sequence[str] = ("site_id",), step_seconds: int = QUARTER_HOUR) -> DataFrame:
    """Holes in slot-aligned data: last slot before, first slot after, number of slots missing between."""
    nxt = neighbours(df.select(*by, "ts"), by, "ts", following={"to_ts": "ts"})
    steps = ((epoch_seconds("to_ts") - epoch_seconds("ts")) / step_seconds).cast("bigint")
    return nxt.select(*by, F.col("ts").alias("from_ts"), "to_ts", (steps - 1).alias("n_missing")).filter("n_missing > 0")


def forward_fill(df: DataFrame, col: str, by: Sequence[str] = ("zone",), step_seconds: int = QUARTER_HOUR,
                 grid: DataFrame | None = None) -> DataFrame:
    """Give each slot without a value the newest earlier one.

    The grid ends with the data unless one is passed. Slots before the first value stay NULL. ``is_filled`` marks
    the slots that were filled and ``source_ts`` tells from where. Without a passed grid only the rows are shuffled, and
    each then writes the slots up to the next one.
    """
    if grid is None:
        return _fill_span(df, col, by, step_seconds)
    full = on_grid(df.select(*by, "ts", col), grid, by)
    full = full.withColumn("_at", F.when(F.col(col).isNotNull(), F.col("ts")))
    filled = fill_forward(full, by, "ts", {"_value": col, "source_ts": "_at"})
    return filled.select(
        *by, "ts", F.col("_value").alias(col),
        (F.col(col).isNull() & F.col("_value").isNotNull()).alias("is_filled"), "source_ts")


def _fill_span(df: DataFrame, col: str, by: Sequence[str], step_seconds: int) -> DataFrame:
    """``forward_fill`` on the grid of :func:`span_grid`.

    Chunks hold at most ``CHUNK_SLOTS`` slots of a site. Its first row sets the grid; only rows on it give values, while
    all rows divide the slots among them. Edges are kept apart by their place between slots until the first row is known.
    """
    rows = df.select(*by, "ts", F.col(col).alias("_value"))
    seconds = epoch_seconds("ts")
    whole = F.col("ts") == from_epoch_seconds(seconds)
    chunked = with_chunk(rows.filter(placed(by, "ts")), "ts", CHUNK_SLOTS * step_seconds).withColumn(
        "_phase", F.when(whole, F.pmod(seconds, F.lit(step_seconds)))).repartition(*by, CHUNK)
    known = F.when(F.col("_value").isNotNull(), F.col("ts"))

    site = Window.partitionBy(*by)
    in_order = site.orderBy(CHUNK)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    edges = chunked.groupBy(*by, CHUNK, "_phase").agg(
        F.min("ts").alias("_from"), F.max_by("_value", known).alias("_last"), F.max(known).alias("_last_at"))
    edges = edges.withColumn("_grid", F.pmod(epoch_seconds(F.min("_from").over(site)), F.lit(step_seconds)))
    last_at = F.when(F.col("_phase") == F.col("_grid"), F.col("_last_at"))
    edges = edges.groupBy(*by, CHUNK).agg(
        F.min("_grid").alias("_grid"), F.min("_from").alias("_from"), F.max_by("_last", last_at).alias("_last"),
        F.max(last_at).alias("_last_at"))
    edges = edges.select(
        *by, CHUNK, "_grid", F.lead("_from").over(in_order).alias("_after"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_carry"),
        F.last("_last_at", ignorenulls=True).over(earlier).alias("_carry_at"))

    inside = Window.partitionBy(*by, CHUNK).orderBy("ts")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    on = F.coalesce(F.col("_phase") == F.col("_grid"), F.lit(False))
    line = chunked.join(edges, [*by, CHUNK]).withColumns({
        "_on": on, "_given": F.when(on, F.col("_value")), "_given_at": F.when(on, known)})
    # Slots are counted in seconds: from the first one at or after the row to the last one before the next row.
    up = lambda ts: epoch_seconds(ts) + F.when(F.col(ts) == from_epoch_seconds(epoch_seconds(ts)), 0).otherwise(1)
    line = line.select(
        *by, "_on", F.col("_given_at").isNotNull().alias("_own"), up("ts").alias("_at"), "_grid",
        F.coalesce(F.lead("ts").over(inside), "_after").alias("_next"), "ts",
        F.coalesce(F.last("_given", ignorenulls=True).over(so_far), "_carry").alias("_value"),
        F.coalesce(F.last("_given_at", ignorenulls=True).over(so_far), "_carry_at").alias("source_ts"))
    line = line.withColumn("_slot", F.col("_at") + F.pmod(F.col("_grid") - F.col("_at"), F.lit(step_seconds)))
    end = F.coalesce(up("_next"), epoch_seconds("ts") + 1)
    slots = F.ceil((end - F.col("_slot")) / F.lit(float(step_seconds)))
    line = line.withColumn("_slots", F.greatest(slots, F.col("_on").cast("bigint"))).filter("_slots > 0")
    # A long gap is written in parts, so no row holds an array longer than a chunk.
    parts = line.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_slots") - 1) / CHUNK_SLOTS))))
    done = F.col("_part") * CHUNK_SLOTS
    every = parts.withColumn("_nth", F.explode(F.sequence(done, F.least(done + CHUNK_SLOTS, F.col("_slots")) - 1)))
    filled = every.select(
        *by, from_epoch_seconds(F.col("_slot") + F.col("_nth") * step_seconds).alias("ts"), F.col("_value").alias(col),
        (F.col("source_ts").isNotNull() & ~(F.col("_own") & (F.col("_nth") == 0))).alias("is_filled"), "source_ts")

    nowhere = span_grid(df.filter(~placed(by, "ts")), by, step_seconds=step_seconds)
    return filled.unionByName(nowhere.select(
        *by, "ts", F.lit(None).cast(df.schema[col].dataType).alias(col), F.lit(False).alias("is_filled"),
        F.lit(None).cast("timestamp_ntz").alias("source_ts")))


def split_aligned(df: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Rows on quarter-hour boundaries, and the rest for quarantine (rows without a time included)."""
    ok = F.coalesce(aligned_15min(ts), F.lit(False))
    return df.filter(ok), df.filter(~ok)
