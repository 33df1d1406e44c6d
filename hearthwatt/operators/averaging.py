"""Quarter-hour means of one-minute rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.quantities import wind_components, wind_from_components
from ..functions.timeparts import with_slot
from ..schemas import ALLOWED_AVERAGES, SCALARS
from .chunked import RAW, fill_forward
from .keyed import newest_n

WIND = ("wind_speed_ms", "wind_direction_deg")


def check_allowed(cols: Sequence[str]) -> list[str]:
    bad = [c for c in cols if c not in ALLOWED_AVERAGES]
    if bad:
        raise ValueError(f"columns not allowed: {', '.join(bad)}")
    return list(cols)


def select_allowed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select("site_id", "ts", *check_allowed(cols))


def _wind_aggregates(ws: str, wd: str) -> list[Column]:
    east, north = wind_components(ws, wd)
    return [F.avg(east).alias("_east"), F.avg(north).alias("_north")]


def _with_wind(df: DataFrame, ws: str, wd: str) -> DataFrame:
    speed, direction = wind_from_components(F.col("_east"), F.col("_north"))
    return df.withColumns({ws: speed, wd: direction}).drop("_east", "_north")


def wind_vector_avg(df: DataFrame, ws: str = WIND[0], wd: str = WIND[1], by: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """Mean wind vector as speed and direction. Rows without both readings count in neither sum."""
    return _with_wind(df.groupBy(*by).agg(*_wind_aggregates(ws, wd)), ws, wd)


def avg_json_keys(df: DataFrame, map_col: str = "registers", by: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """Mean of every map key over the rows that have it, in a map again.

    Aggregation is per key, so a group of any size combines before the shuffle; the map rebuilt at the end holds
    one entry per register number.
    """
    # The outer form, because the planner guards the plain one with a filter that would parse a derived map twice.
    entries = df.select(*by, F.explode_outer(map_col).alias("_key", "_value")).filter(F.col("_key").isNotNull())
    means = entries.groupBy(*by, "_key").agg(F.avg("_value").alias("_mean"))
    pairs = F.sort_array(F.collect_list(F.struct("_key", "_mean")))
    return means.groupBy(*by).agg(F.map_from_entries(pairs).alias(map_col))


def grouped_average(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Means of any allowed columns per group, with ``rows_used``: plain, vector for wind, per key for registers."""
    cols = check_allowed(cols)
    scalars = [c for c in cols if c in SCALARS]
    wind = any(c in WIND for c in cols)
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_used"), *[F.avg(c).alias(c) for c in scalars],
        *(_wind_aggregates(*WIND) if wind else []))
    if wind:
        out = _with_wind(out, *WIND)
    if "registers" in cols:
        out = out.join(avg_json_keys(df, "registers", by), list(by), "left")
    return out.select(*by, "rows_used", *cols)


def avg_15min(df: DataFrame, cols: Sequence[str], label: str = "end", by: Sequence[str] = ("site_id",),
              length: str = "15 minutes") -> DataFrame:
    """Quarter-hour rows from raw rows, labelled with the end of the interval they measure."""
    slotted = with_slot(df, "ts", length, "_slot", label)
    return grouped_average(slotted, cols, [*by, "_slot"]).withColumnRenamed("_slot", "ts")


def avg_newest_n(df: DataFrame, n: int, cols: Sequence[str], by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Means over the newest ``n`` rows of each site; ``n`` counts rows, so 15 is a quarter hour of minutes."""
    check_allowed(cols)
    out = grouped_average(newest_n(df, by, ["ts"], n), cols, by)
    return out.select(*by, F.lit(n).alias("n"), "rows_used", *cols)


def to_api_json(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One ``{n, rows_used, data}`` document per site."""
    record = F.struct("n", "rows_used", F.struct(*cols).alias("data"))
    return df.select("site_id", F.to_json(record).alias("json"))


def merge_latest(left: DataFrame, right: DataFrame, max_age_seconds: int, by: Sequence[str] = ("site_id",),
                 lengths: Sequence[int] = RAW) -> DataFrame:
    """Each left row with the newest right row at or before it and at most ``max_age_seconds`` old.

    An as-of join as one union and a fill along the time line, so a busy site is cut up like any other. ``right_ts``
    is the time of the right row used. Both sides hold one row per ``(by, ts)``.
    """
    payload = [c for c in right.columns if c not in [*by, "ts"]]
    own = [c for c in left.columns if c not in [*by, "ts"]]
    lhs = left.select(*by, "ts", F.struct(F.lit(1).alias("_one"), *own).alias("_left"), F.lit(1).alias("_side"))
    rhs = right.select(*by, "ts", F.struct(F.col("ts").alias("right_ts"), *payload).alias("_right"), F.lit(0).alias("_side"))
    both = lhs.unionByName(rhs, allowMissingColumns=True)
    held = fill_forward(both, by, "ts", {"_held": "_right"}, lengths, tie="_side").filter("_side = 1")
    fresh = F.col("_held.right_ts") >= F.timestamp_add("SECOND", F.lit(-max_age_seconds), F.col("ts"))
    return held.select(
        *by, "ts", *[F.col(f"_left.{c}").alias(c) for c in own],
        *[F.when(fresh, F.col(f"_held.{c}")).alias(c) for c in ["right_ts", *payload]])
