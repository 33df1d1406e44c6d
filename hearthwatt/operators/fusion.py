"""The wide series: price, interpolated forecast and measured means per quarter hour."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.quantities import cents_per_kwh, display_number, watts_from_joules
from ..functions.timeparts import between_dates, hour_minute, shift
from ..schemas import DISPLAY_COLUMNS, FORECAST_COLUMNS, STATION_FUSION_COLUMNS
from .chunked import DAY, halo_window, home_rows, neighbours, spread_join, with_halo


def prefix_columns(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})


def interpolate(first: Column, second: Column, minute: Column, circular: bool = False) -> Column:
    """Value at ``minute`` of the hour. On the hour the second value is not needed; elsewhere NULL without it.

    A direction is interpolated as a plain number unless ``circular``, which takes the shorter arc.
    """
    share = minute / F.lit(60.0)
    if circular:
        arc = F.pmod(second - first + F.lit(540.0), F.lit(360.0)) - F.lit(180.0)
        between = F.pmod(first + arc * share + F.lit(360.0), F.lit(360.0))
    else:
        between = first + (second - first) * share
    return F.when(minute == 0, first).otherwise(between)


def interp_hourly(hourly: DataFrame, cols: Sequence[str] = tuple(FORECAST_COLUMNS), circular: Collection[str] = (),
                  by: Sequence[str] = ("site_id",), length: int = 4 * DAY) -> DataFrame:
    """Quarter-hour rows from hourly rows.

    The next hour comes from one window over day-long chunks with an hour of overlap, in place of a second join to
    the same table, and only counts when it is exactly one hour later.
    """
    copies = with_halo(hourly.select(*by, "ts", *cols), "ts", 0, 3600, length)
    w = halo_window(by, "ts")
    adjacent = F.lead("ts").over(w) == shift("ts", 3600)
    hours = home_rows(copies.withColumns({f"_next_{c}": F.when(adjacent, F.lead(c).over(w)) for c in cols}))
    quarters = hours.withColumn("_minute", F.explode(F.array(*[F.lit(m) for m in (0, 15, 30, 45)])))
    return quarters.select(
        *by, F.timestamp_add("MINUTE", F.col("_minute"), F.col("ts")).alias("ts"),
        *[interpolate(F.col(c), F.col(f"_next_{c}"), F.col("_minute"), c in circular).alias(c) for c in cols])


def price_spine(prices: DataFrame, sites: DataFrame) -> DataFrame:
    """Prices of each site's zone. A zone with very many sites is spread over tasks."""
    slim = prices.select("zone", "ts", "price_eur_per_mwh", F.col("updated_at").alias("price_updated_at"))
    return spread_join(sites.select("site_id", "zone"), slim, ["zone"], ["site_id"], "inner").drop("zone")


def with_weather(spine: DataFrame, hourly: DataFrame, station: DataFrame, circular: Collection[str] = (),
                 keep_unsourced: bool = True) -> DataFrame:
    """The slots of ``spine`` with forecast (``fc_``) and measurement (``station_``) where they exist."""
    forecast = prefix_columns(interp_hourly(hourly, circular=circular), FORECAST_COLUMNS, "fc_")
    sourced = {new: old for new, old in STATION_FUSION_COLUMNS.items() if old is not None}
    measured = station.select("site_id", "ts", *[F.col(old).alias(f"station_{new}") for new, old in sourced.items()])
    joined = spine.join(forecast, ["site_id", "ts"], "left").join(measured, ["site_id", "ts"], "left")
    measured_columns = [
        F.col(f"station_{new}") if old is not None else F.lit(None).cast("double").alias(f"station_{new}")
        for new, old in STATION_FUSION_COLUMNS.items() if old is not None or keep_unsourced]
    return joined.select(*spine.columns, *[f"fc_{c}" for c in FORECAST_COLUMNS], *measured_columns)


def weather_fusion(prices: DataFrame, hourly: DataFrame, station: DataFrame, sites: DataFrame,
                   circular: Collection[str] = (), keep_unsourced: bool = True) -> DataFrame:
    """Price slots of every site with forecast (``fc_``) and measurement (``station_``) where they exist.

    Rows pair the price of the quarter hour that starts at ``ts`` with the mean of the one that ended there. All
    joins use ``(site_id, ts)``, so the spine is shuffled once. Not sorted: sort at the sink if at all.
    """
    return with_weather(price_spine(prices, sites), hourly, station, circular, keep_unsourced)


def display_projection(fusion: DataFrame, tz: str, margin: float, vat: float = 0.255,
                       start: str | None = None, end: str | None = None) -> DataFrame:
    """The 13 shown columns as text, for the local days asked for: one decimal, whole numbers, a dash if missing."""
    whole = ("direction", "pct", "_w")
    shown = {c: 0 if c.endswith(whole) or "direction" in c else 1 for c in DISPLAY_COLUMNS}
    shown["fc_shortwave_radiation_w_m2"] = 1
    rows = fusion.filter(between_dates("ts", start, end, tz))
    return rows.select(
        "site_id", "ts", hour_minute("ts", tz).alias("local_time"),
        display_number(cents_per_kwh("price_eur_per_mwh", margin, vat), 1).alias("price_cents_per_kwh"),
        *[display_number(c, digits).alias(c) for c, digits in shown.items()])


def power_from_accumulation(df: DataFrame, mode: str = "hourly", col: str = "radiation_accum_j_m2",
                            out: str = "shortwave_radiation_w_m2", by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Radiation power where only accumulated energy was sent; an instantaneous value always wins.

    ``hourly``: the energy of the past hour. ``cumulative``: a running sum, so the difference to the row before, or
    the value itself after a reset and in a site's first row.
    """
    if mode == "hourly":
        return df.withColumn(out, F.coalesce(F.col(out), watts_from_joules(col)))
    if mode != "cumulative":
        raise ValueError(f"unknown mode: {mode}")
    stepped = neighbours(df, by, "ts", prev={"_before": col})
    gained = F.col(col) - F.col("_before")
    energy = F.when(F.col("_before").isNull() | (gained < 0), F.col(col)).otherwise(gained)
    return stepped.withColumn(out, F.coalesce(F.col(out), watts_from_joules(energy))).drop("_before")


def backfill_units(df: DataFrame, predicate: Column, col: str = "shortwave_radiation_w_m2",
                   flag: str = "unit_fixed") -> DataFrame:
    """Rewrite stored joules as watts where ``predicate`` holds. The flag makes a second run change nothing."""
    if flag not in df.columns:
        df = df.withColumn(flag, F.lit(False))
    fix = predicate & ~F.col(flag)
    return df.withColumns({
        col: F.when(fix, watts_from_joules(col)).otherwise(F.col(col)),
        flag: F.coalesce(F.col(flag) | fix, F.col(flag)),
    })
