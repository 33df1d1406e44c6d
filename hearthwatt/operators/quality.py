"""Data quality checks and the health report.

Every check takes ``now`` as an argument. Health rows are ``scope, check, status, observed, threshold, detail``,
where the scope is a site, a price zone or a kind of file.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timeparts import aligned_15min, epoch_seconds, local_day_bounds, parse_file_stamp
from ..schemas import HEALTH_DEFAULTS
from .averaging import avg_15min
from .consumption import COMPONENTS, day_slots
from .grid import on_grid

SEVERITY = {"ok": 0, "warn": 1, "error": 2}
MAX_RADIATION = 1400.0


# ---- descriptions of a table -------------------------------------------------------------------------------------

def span(df: DataFrame, ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def null_count(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean per column, one row each, in one pass."""
    stats = df.agg(*[F.struct(F.lit(c).alias("column"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
                              F.avg(c).cast("double").alias("avg")).alias(f"s{i}") for i, c in enumerate(cols)])
    return stats.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))


def freshness(df: DataFrame, now: Column, ts: str = "ts", by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Newest time and its age in minutes."""
    newest = df.groupBy(*by).agg(F.max(ts).alias("newest_ts"))
    return newest.withColumn("age_min", _age_minutes(now, "newest_ts"))


def _age_minutes(now: Column, ts: str) -> Column:
    return (epoch_seconds(now) - epoch_seconds(ts)) / F.lit(60.0)


def coverage(df: DataFrame, grid: DataFrame, groups: Mapping[str, Sequence[str]], by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Expected slots, slots present, and per column group the slots where all its columns have a value."""
    marked = on_grid(df.withColumn("_present", F.lit(True)), grid, by)

    def complete(cols: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])

    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("expected"), F.count("_present").alias("present"),
        *[F.count_if(complete(cols)).alias(f"{name}_complete") for name, cols in groups.items()])


def recent_completeness(df: DataFrame, now: Column, cols: Sequence[str], hours: Sequence[int] = (6, 24)) -> DataFrame:
    """Rows of the last hours per site against four an hour, and NULLs in core columns, in one pass."""
    recent = df.filter((F.col("ts") > F.timestamp_add("HOUR", F.lit(-max(hours)), now)) & (F.col("ts") <= now))
    aggregates = []
    for h in hours:
        inside = F.col("ts") > F.timestamp_add("HOUR", F.lit(-h), now)
        gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        aggregates += [F.count_if(inside).alias(f"rows_{h}h"), F.lit(4 * h).alias(f"expected_{h}h"),
                       F.count_if(inside & gap).alias(f"null_rows_{h}h")]
    return recent.groupBy("site_id").agg(*aggregates)


# ---- rules -------------------------------------------------------------------------------------------------------

def alignment_violations(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.filter(~F.coalesce(aligned_15min(ts), F.lit(False)))


def implausible_radiation(df: DataFrame, col: str = "shortwave_radiation_w_m2", limit: float = MAX_RADIATION) -> DataFrame:
    """Power no panel at the ground can see: a sign of energy stored as power."""
    return df.filter((F.col(col) < 0) | (F.col(col) > limit))


def identity_violations(components: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    total, *parts = [F.col(c) for c in COMPONENTS]
    return components.filter(F.abs(total - reduce(lambda a, b: a + b, parts)) > tolerance)


def reconcile(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Compare two tables key by key and column by column: ``match``, ``differ``, ``left_only`` or ``right_only``."""
    left = a.select(*key, F.lit(True).alias("_in_a"), *[F.col(c).alias(f"_a_{c}") for c in cols])
    right = b.select(*key, F.lit(True).alias("_in_b"), *[F.col(c).alias(f"_b_{c}") for c in cols])
    both = left.join(right, list(key), "full")

    def verdict(c: str) -> Column:
        x, y = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        same = (x.isNull() & y.isNull()) | F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))
        return (F.when(F.col("_in_b").isNull(), F.lit("left_only")).when(F.col("_in_a").isNull(), F.lit("right_only"))
                .when(same, F.lit("match")).otherwise(F.lit("differ")))

    cells = [F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").cast("double").alias("a"),
                      F.col(f"_b_{c}").cast("double").alias("b"),
                      F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}")).cast("double").alias("diff"),
                      verdict(c).alias("class")) for c in cols]
    return both.select(*key, F.inline(F.array(*cells)))


def reconcile_summary(cells: DataFrame) -> DataFrame:
    return cells.groupBy("column", "class").agg(F.count(F.lit(1)).alias("n"), F.max("diff").alias("max_diff"))


def row_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: both counts, and whether counts and column lists (names and order) agree."""
    counts = a.agg(F.count(F.lit(1)).alias("rows_a")).withColumn("rows_b", b.agg(F.count(F.lit(1))).scalar())
    same = a.columns == b.columns
    return counts.select("rows_a", "rows_b", F.lit(same).alias("columns_equal"),
                         ((F.col("rows_a") == F.col("rows_b")) & F.lit(same)).alias("parity"))


def averaging_lineage(raw: DataFrame, station: DataFrame, cols: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """Recompute the quarter-hour rows from raw rows and compare with those stored."""
    return reconcile(avg_15min(raw, cols), station, ["site_id", "ts"], list(cols), tolerance)


# ---- health ------------------------------------------------------------------------------------------------------

def graded(observed: Column, ok: float, warn: float) -> Column:
    """ok up to the first limit, warn up to the second, error beyond, before now, and when there is nothing to observe."""
    return (F.when(observed < 0, F.lit("error")).when(observed <= ok, F.lit("ok")).when(observed <= warn, F.lit("warn")).otherwise(F.lit("error")))


def _rows(df: DataFrame, scope: Column, check: str, status: Column, observed: Column, threshold: float | Column,
          detail: Column) -> DataFrame:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.select(
        scope.cast("string").alias("scope"), F.lit(check).alias("check"), status.alias("status"),
        observed.cast("double").alias("observed"), limit.cast("double").alias("threshold"), detail.cast("string").alias("detail"))


def station_check(station: DataFrame, sites: DataFrame, now: Column, p: Mapping[str, Any]) -> DataFrame:
    aged = sites.select("site_id").join(freshness(station, now), "site_id", "left")
    age = F.col("age_min")
    return _rows(aged, F.col("site_id"), "station_freshness", graded(age, p["station_ok_min"], p["station_warn_min"]),
                 age, p["station_ok_min"], F.lit("minutes since the newest quarter-hour row"))


def forecast_check(forecast: DataFrame, sites: DataFrame, now: Column, p: Mapping[str, Any]) -> DataFrame:
    reach = sites.select("site_id").join(forecast.groupBy("site_id").agg(F.max("ts").alias("_end")), "site_id", "left")
    hours = -_age_minutes(now, "_end") / 60.0
    need = p["forecast_horizon_hours"]
    return _rows(reach, F.col("site_id"), "forecast_horizon",
                 F.when(hours >= need, F.lit("ok")).otherwise(F.lit("error")), hours, need, F.lit("hours covered ahead"))


def baseline_check(values: DataFrame, runs: DataFrame, sites: DataFrame, now: Column, p: Mapping[str, Any]) -> DataFrame:
    """Age of the newest baseline run of each site and its rows in the next six hours; errors are ruled out first."""
    ahead = values.filter((F.col("target") == "baseline_w") & (F.col("target_ts") > now)
                          & (F.col("target_ts") <= F.timestamp_add("HOUR", F.lit(6), now)))
    rows = ahead.groupBy("run_id").agg(F.count_distinct("target_ts").alias("_rows"))
    newest = runs.filter(F.col("model_name") == p.get("baseline_model", "baseline_consumption")).groupBy("site_id").agg(
        F.max_by("run_id", F.struct("issued_at", "run_id")).alias("run_id"), F.max("issued_at").alias("_issued"))
    state = sites.select("site_id").join(newest, "site_id", "left").join(rows, "run_id", "left")
    state = state.withColumn("_rows", F.coalesce("_rows", F.lit(0))).withColumn("_age", _age_minutes(now, "_issued"))
    age, n = F.col("_age"), F.col("_rows")
    failed = age.isNull() | (age > p["baseline_warn_min"]) | (n < p["baseline_min_rows"])
    good = (age <= p["baseline_ok_min"]) & (n >= p["baseline_full_rows"])
    status = F.when(failed, F.lit("error")).when(good, F.lit("ok")).otherwise(F.lit("warn"))
    return _rows(state, F.col("site_id"), "baseline_forecast", status, age, p["baseline_ok_min"],
                 F.concat(n.cast("string"), F.lit(f"/{p['baseline_full_rows']} rows in the next 6 h")))


def price_check(prices: DataFrame, sites: DataFrame, today: str, p: Mapping[str, Any]) -> DataFrame:
    start, end = local_day_bounds(today, p["tz"])
    known = prices.filter((F.col("ts") >= start) & (F.col("ts") < end) & F.col("price_eur_per_mwh").isNotNull())
    zones = sites.select("zone").distinct().join(known.groupBy("zone").agg(F.count(F.lit(1)).alias("_n")), "zone", "left")
    n = F.coalesce("_n", F.lit(0))
    need = day_slots(F.lit(today).cast("date"), p["tz"]) if p["price_strict"] else F.lit(1)
    return _rows(zones, F.col("zone"), "price_coverage", F.when(n >= need, F.lit("ok")).otherwise(F.lit("error")),
                 n, need, F.lit("price rows of the local day"))


def file_check(manifest: DataFrame, kind: str, now: Column, max_age_min: float, min_bytes: int = 0) -> DataFrame:
    """Newest successful file of a kind: young enough and not truncated. No file at all is an error."""
    good = manifest.filter((F.col("kind") == kind) & (F.col("status") == "ok"))
    newest = good.agg(F.max("created_at").alias("_at"), F.max_by("size_bytes", F.struct("created_at", "version")).alias("_size"))
    age = _age_minutes(now, "_at")
    valid = (age <= max_age_min) & (F.col("_size") >= min_bytes)
    return _rows(newest, F.lit(kind), f"{kind}_freshness", F.when(valid, F.lit("ok")).otherwise(F.lit("error")), age,
                 max_age_min, F.concat(F.coalesce(F.col("_size").cast("string"), F.lit("no")), F.lit(" bytes")))


def readable(spark: SparkSession, name: str, open_table: Callable[[], DataFrame]) -> DataFrame:
    """One health row: can the table be opened and a row be read."""
    try:
        open_table().limit(1).count()
        status, detail = "ok", "readable"
    except PySparkException as failure:
        status, detail = "error", type(failure).__name__
    one = spark.range(1)
    return _rows(one, F.lit(name), "readable", F.lit(status), F.lit(None), 0.0, F.lit(detail))


def health_report(tables: Mapping[str, DataFrame], now: datetime, p: Mapping[str, Any] = HEALTH_DEFAULTS,
                  stores: Mapping[str, Callable[[], DataFrame]] | None = None) -> DataFrame:
    """All checks for which a table was passed.

    ``sites`` (site_id, zone) is required, so that a site that sends nothing is reported. Others: ``station``,
    ``forecast``, ``values`` with ``runs``, ``prices``, ``manifest``. Each of ``stores`` opens a stored table and is reported as readable
    or not; open it there and not before, so that one that can't be read becomes a row and not the end of the report.
    """
    at = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    sites = tables["sites"]
    parts = [readable(sites.sparkSession, name, open_table) for name, open_table in (stores or {}).items()]
    if "station" in tables:
        parts.append(station_check(tables["station"], sites, at, p))
    if "forecast" in tables:
        parts.append(forecast_check(tables["forecast"], sites, at, p))
    if "values" in tables:
        parts.append(baseline_check(tables["values"], tables["runs"], sites, at, p))
    if "prices" in tables:
        today = now.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(p["tz"])).strftime("%Y-%m-%d")
        parts.append(price_check(tables["prices"], sites, today, p))
    if "manifest" in tables:
        manifest = tables["manifest"]
        parts += [file_check(manifest, "dump", at, p["backup_max_hours"] * 60, p["backup_min_bytes"]),
                  file_check(manifest, "export", at, p["export_max_min"]),
                  file_check(manifest, "archive", at, p["archive_max_hours"] * 60)]
    return reduce(DataFrame.unionByName, parts)


def worst(status: Column) -> Column:
    """Worst of a group of statuses."""
    rank = F.max(reduce(lambda acc, s: acc.when(status == s, SEVERITY[s]), ["ok", "warn"], F.when(status == "error", 2)))
    return F.when(rank == 2, F.lit("error")).when(rank == 1, F.lit("warn")).otherwise(F.lit("ok"))


def overall_status(report: DataFrame, now: Column, by: Sequence[str] = ()) -> DataFrame:
    """Worst status, when it was checked and which checks failed with how many scopes."""
    failures = F.sort_array(F.collect_set(F.when(F.col("status") != "ok", F.col("check"))))
    return report.groupBy(*by).agg(
        worst(F.col("status")).alias("overall_status"), F.count_if(F.col("status") != "ok").alias("n_failures"),
        failures.alias("failures")).withColumn("checked_at", now)


def require_fresh(version: str, now: datetime, minutes: int = 30) -> None:
    """Raise unless the 14 digits that end the version's name are a time at most ``minutes`` before ``now``."""
    digits = "".join(c for c in version if c in "0123456789")[-14:]
    try:
        made = datetime.strptime(digits, "%Y%m%d%H%M%S") if len(digits) == 14 else None
    except ValueError:
        made = None
    if made is None:
        raise ValueError(f"{version}: its name does not end in the time at which it was made")
    age = (now - made).total_seconds() / 60.0
    if age > minutes:
        raise ValueError(f"{version}: made {age:.2f} min ago, at most {minutes} min are allowed")


def fresh_versions(manifest: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """Versions whose name holds a time at most ``minutes`` before ``now``."""
    made = parse_file_stamp("version")
    return manifest.filter(made >= F.timestamp_add("MINUTE", F.lit(-minutes), now))
