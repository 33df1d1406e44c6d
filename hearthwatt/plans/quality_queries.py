"""Queries on data quality, health, retention and the outbox."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.timeparts import file_stamp, parse_file_stamp, ts_lit
from ..operators.averaging import avg_15min
from ..operators.grid import span_grid
from ..operators.quality import (
    averaging_lineage, coverage, freshness, fresh_versions, health_report, identity_violations, implausible_radiation,
    null_count, null_rows, overall_status, profile, recent_completeness, reconcile, reconcile_summary, row_parity, span,
)
from ..schemas import HEALTH_DEFAULTS
from ..sources.snapshots import prune_older_than, retention
from ..sources.tables import outbox_mark, outbox_pending
from . import adapters as a
from .adapters import FUSION, STATION, ctes, table
from .home_queries import COMPONENTS, components
from .registry import query, rounded, sql_round as r
from .series_queries import wide_series

NOW = datetime(2024, 1, 31)
AT = f"TIMESTAMP '{a.NOW}'"


@query("table_span", "SELECT event_type AS site_id, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1")
def table_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span(a.telemetry(spark, sf_dir), by=["site_id"])


_CORE = ["fc_temperature_c", "station_temperature_c", "station_wind_direction_deg"]


@query("null_counts", ctes(*FUSION) + "SELECT site_id, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in _CORE) + " FROM fusion GROUP BY 1")
def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_count(wide_series(spark, sf_dir), _CORE, by=["site_id"])


@query("null_rows", ctes(*FUSION) + "SELECT site_id, ts FROM fusion WHERE fc_temperature_c IS NULL")
def unknown_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_rows(wide_series(spark, sf_dir), "fc_temperature_c").select("site_id", "ts")


_PROFILED = ["temperature_c", "wind_speed_ms", "shortwave_radiation_w_m2"]


@query("table_profile", ctes("hourly") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r(f'min({c})', 4)} AS min, {r(f'max({c})', 4)} AS max, {r(f'avg({c})', 4)} AS avg FROM hourly"
    for c in _PROFILED))
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile(a.hourly(spark, sf_dir), _PROFILED), {"min": 4, "max": 4, "avg": 4})


@query("coverage", ctes("load", *STATION) + """, grid AS (
  SELECT site_id, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTES)) AS ts FROM load GROUP BY site_id)
SELECT site_id, count(*) AS expected, count(temperature_c) AS present, count(wind_direction_deg) AS wind_complete,
  count(temperature_c) AS core_complete FROM grid LEFT JOIN station USING (site_id, ts) GROUP BY 1""")
def slot_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = a.station(spark, sf_dir, ["temperature_c", "pressure_hpa", "wind_speed_ms", "wind_direction_deg"])
    groups = {"wind": ["wind_speed_ms", "wind_direction_deg"], "core": ["temperature_c", "pressure_hpa"]}
    return coverage(measured, span_grid(a.load(spark, sf_dir), ["site_id"]), groups)


@query("freshness", f"""
SELECT event_type AS site_id, max(ts) AS newest_ts, (epoch({AT}) - floor(epoch(max(ts)))) / 60.0::DOUBLE AS age_min
FROM events GROUP BY 1""")
def ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness(a.telemetry(spark, sf_dir), ts_lit(a.NOW))


@query("recent_completeness", ctes(*FUSION) + f"""
SELECT site_id, count(*) FILTER (WHERE ts > {AT} - INTERVAL 6 HOURS) AS rows_6h, CAST(24 AS INTEGER) AS expected_6h,
  count(*) FILTER (WHERE ts > {AT} - INTERVAL 6 HOURS AND (fc_temperature_c IS NULL OR station_temperature_c IS NULL)) AS null_rows_6h,
  count(*) AS rows_24h, CAST(96 AS INTEGER) AS expected_24h,
  count(*) FILTER (WHERE fc_temperature_c IS NULL OR station_temperature_c IS NULL) AS null_rows_24h
FROM fusion WHERE ts > {AT} - INTERVAL 24 HOURS AND ts <= {AT} GROUP BY 1""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_completeness(wide_series(spark, sf_dir), ts_lit(a.NOW), ["fc_temperature_c", "station_temperature_c"])


@query("implausible_radiation", ctes("hourly") + f"""
SELECT site_id, ts, {r('shortwave_radiation_w_m2', 4)} AS shortwave_radiation_w_m2 FROM hourly
WHERE shortwave_radiation_w_m2 < 0 OR shortwave_radiation_w_m2 > 400""")
def implausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.hourly(spark, sf_dir).select("site_id", "ts", "shortwave_radiation_w_m2")
    return rounded(implausible_radiation(rows, limit=400.0), {"shortwave_radiation_w_m2": 4})


@query("identity_violations", ctes(*COMPONENTS) + "SELECT site_id, ts, event_class FROM components WHERE event_class = 'sauna'")
def broken_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = components(spark, sf_dir).withColumn("sauna_actual_w", F.col("sauna_actual_w") * 2)
    return identity_violations(damaged).select("site_id", "ts", "event_class")


_RECONCILED = """left_side AS (SELECT site_id, ts, total_actual_w AS w FROM load WHERE minute(ts) < 45),
right_side AS (SELECT site_id, ts, total_actual_w + CASE WHEN minute(ts) = 30 THEN 1 ELSE 0 END AS w FROM load WHERE minute(ts) > 0),
cells AS (SELECT coalesce(l.site_id, q.site_id) AS site_id, coalesce(l.ts, q.ts) AS ts, 'w' AS "column", l.w AS a, q.w AS b,
  abs(l.w - q.w) AS diff, CASE WHEN q.w IS NULL THEN 'left_only' WHEN l.w IS NULL THEN 'right_only'
    WHEN abs(l.w - q.w) <= 0.001 THEN 'match' ELSE 'differ' END AS class
  FROM left_side l FULL JOIN right_side q ON l.site_id = q.site_id AND l.ts = q.ts)"""


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = a.load(spark, sf_dir).withColumnRenamed("total_actual_w", "w")
    minute = F.minute("ts")
    right = load.filter(minute > 0).withColumn("w", F.col("w") + F.when(minute == 30, 1).otherwise(0))
    return reconcile(load.filter(minute < 45), right, ["site_id", "ts"], ["w"], 0.001)


@query("reconcile_sources", ctes("load") + f""", {_RECONCILED}
SELECT site_id, ts, "column", {r('a', 4)} AS a, {r('b', 4)} AS b, {r('diff', 4)} AS diff, class FROM cells""")
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_reconciled(spark, sf_dir), {"a": 4, "b": 4, "diff": 4})


@query("reconcile_summary", ctes("load") + f""", {_RECONCILED}
SELECT "column", class, count(*) AS n, {r('max(diff)', 4)} AS max_diff FROM cells GROUP BY 1, 2""")
def reconciled_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reconcile_summary(_reconciled(spark, sf_dir)), {"max_diff": 4})


@query("row_parity", """
SELECT (SELECT count(*) FROM orders) AS rows_a, (SELECT count(*) FROM orders WHERE o_totalprice > 1000) AS rows_b,
  TRUE AS columns_equal, (SELECT count(*) FROM orders) = (SELECT count(*) FROM orders WHERE o_totalprice > 1000) AS parity""")
def parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return row_parity(orders, orders.filter("o_totalprice > 1000"))


@query("averaging_lineage", ctes(*STATION) + """, stored AS (
  SELECT site_id, ts, temperature_c + CASE WHEN minute(ts) = 15 THEN 0.5 ELSE 0 END AS t FROM station WHERE minute(ts) <> 30)
SELECT 'temperature_c' AS "column", CASE WHEN s.ts IS NULL THEN 'left_only' WHEN abs(m.temperature_c - s.t) <= 1e-6 THEN 'match'
  ELSE 'differ' END AS class, count(*) AS n
FROM station m LEFT JOIN stored s ON s.site_id = m.site_id AND s.ts = m.ts GROUP BY 1, 2""")
def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = a.telemetry(spark, sf_dir)
    shifted = F.col("temperature_c") + F.when(F.minute("ts") == 15, 0.5).otherwise(0.0)
    stored = avg_15min(raw, ["temperature_c"]).filter(F.minute("ts") != 30).withColumn("temperature_c", shifted)
    cells = averaging_lineage(raw, stored, ["temperature_c"])
    return reconcile_summary(cells).drop("max_diff")


# ---- health ------------------------------------------------------------------------------------------------------

SITES_PLUS = "all_sites AS (SELECT site_id, zone FROM sites UNION ALL SELECT 'silent', 'Z9')"
_HEALTH = f"""
aged AS (SELECT s.site_id, (epoch({AT}) - epoch(max(m.ts))) / 60.0::DOUBLE AS age FROM all_sites s
  LEFT JOIN station m ON m.site_id = s.site_id GROUP BY 1),
reach AS (SELECT s.site_id, (epoch(max(h.ts)) - epoch({AT})) / 60.0::DOUBLE / 60.0 AS hours FROM all_sites s
  LEFT JOIN hourly h ON h.site_id = s.site_id GROUP BY 1),
newest AS (SELECT site_id, run_id, issued_at FROM runs
  QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY issued_at DESC, run_id DESC) = 1),
ahead AS (SELECT run_id, count(DISTINCT target_ts) AS n FROM run_values
  WHERE target_ts > {AT} AND target_ts <= {AT} + INTERVAL 6 HOURS GROUP BY 1),
base AS (SELECT s.site_id, (epoch({AT}) - epoch(w.issued_at)) / 60.0::DOUBLE AS age, coalesce(h.n, 0) AS n
  FROM all_sites s LEFT JOIN newest w ON w.site_id = s.site_id LEFT JOIN ahead h USING (run_id)),
today AS (SELECT z.zone, count(p.price_eur_per_mwh) AS n FROM (SELECT DISTINCT zone FROM all_sites) z
  LEFT JOIN prices p ON p.zone = z.zone AND p.ts >= TIMESTAMP '2024-01-30 22:00:00' AND p.ts < TIMESTAMP '2024-01-31 22:00:00'
  GROUP BY 1),
files AS (SELECT k.kind, k.age_limit, k.min_bytes, (epoch({AT}) - epoch(max(b.created_at))) / 60.0::DOUBLE AS age,
    arg_max(b.size_bytes, b.created_at) AS size
  FROM (VALUES ('dump', 1560.0::DOUBLE, 100000), ('export', 30.0::DOUBLE, 0), ('archive', 1440.0::DOUBLE, 0)) k(kind, age_limit, min_bytes)
  LEFT JOIN backups b ON b.kind = k.kind AND b.status = 'ok' GROUP BY 1, 2, 3),
health AS (
SELECT site_id AS scope, 'station_freshness' AS "check", CASE WHEN age <= 20 THEN 'ok' WHEN age <= 60 THEN 'warn' ELSE 'error' END AS status,
  age AS observed, 20.0::DOUBLE AS threshold, 'minutes since the newest quarter-hour row' AS detail FROM aged
UNION ALL SELECT site_id, 'forecast_horizon', CASE WHEN hours >= 6 THEN 'ok' ELSE 'error' END, hours, 6.0::DOUBLE, 'hours covered ahead' FROM reach
UNION ALL SELECT site_id, 'baseline_forecast', CASE WHEN age IS NULL OR age > 60 OR n < 20 THEN 'error'
  WHEN age <= 30 AND n >= 24 THEN 'ok' ELSE 'warn' END, age, 30.0::DOUBLE, n || '/24 rows in the next 6 h' FROM base
UNION ALL SELECT zone, 'price_coverage', CASE WHEN n >= 1 THEN 'ok' ELSE 'error' END, CAST(n AS DOUBLE), 1.0::DOUBLE, 'price rows of the local day' FROM today
UNION ALL SELECT kind, kind || '_freshness', CASE WHEN age <= age_limit AND size >= min_bytes THEN 'ok' ELSE 'error' END, age, age_limit,
  coalesce(CAST(size AS VARCHAR), 'no') || ' bytes' FROM files)"""
_HEALTH_CTES = (*STATION, "prices", "sites", "hourly", "runs", "run_values", "backups")


def _health(spark: SparkSession, sf_dir: str, stores: dict[str, Callable[[], DataFrame]] | None = None) -> DataFrame:
    known = a.sites(spark, sf_dir)
    silent = spark.range(1).select(F.lit("silent").alias("site_id"), F.lit("Z9").alias("zone"))
    tables = {
        "sites": known.unionByName(silent), "station": a.station(spark, sf_dir, ["temperature_c"]),
        "forecast": a.hourly(spark, sf_dir), "values": a.run_values(spark, sf_dir), "runs": a.runs(spark, sf_dir),
        "prices": a.prices(spark, sf_dir), "manifest": a.backups(spark, sf_dir)}
    return health_report(tables, NOW, HEALTH_DEFAULTS, stores)


@query("health_report", ctes(*_HEALTH_CTES) + f""", {SITES_PLUS}, {_HEALTH}
SELECT scope, "check", status, {r('observed', 4)} AS observed, threshold, detail FROM health""")
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_health(spark, sf_dir), {"observed": 4})


@query("health_stores", ctes(*_HEALTH_CTES) + f""", {SITES_PLUS}, {_HEALTH}
SELECT scope, "check", status, {r('observed', 4)} AS observed, threshold, detail FROM health
UNION ALL SELECT 'events', 'readable', 'ok', NULL, 0.0::DOUBLE, 'readable' UNION ALL SELECT 'lost', 'readable', 'error', NULL, 0.0::DOUBLE, 'AnalysisException'""")
def health_with_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report with a stored table that can and one that can't be opened."""
    stores = {"events": lambda: table(spark, sf_dir, "events"), "lost": lambda: table(spark, sf_dir, "lost")}
    return rounded(_health(spark, sf_dir, stores), {"observed": 4})


@query("overall_status", ctes(*_HEALTH_CTES) + f""", {SITES_PLUS}, {_HEALTH}
SELECT scope, CASE WHEN bool_or(status = 'error') THEN 'error' WHEN bool_or(status = 'warn') THEN 'warn' ELSE 'ok' END AS overall_status,
  count(*) FILTER (WHERE status <> 'ok') AS n_failures,
  coalesce(string_agg("check", ',' ORDER BY "check") FILTER (WHERE status <> 'ok'), '') AS failures, {AT} AS checked_at FROM health GROUP BY 1""")
def overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = overall_status(_health(spark, sf_dir), ts_lit(a.NOW), by=["scope"])
    return out.withColumn("failures", F.array_join("failures", ","))


# ---- files -------------------------------------------------------------------------------------------------------

@query("retention_list", ctes("manifest") + """, kept AS (SELECT kind, version FROM manifest WHERE size_bytes >= 100000
  QUALIFY row_number() OVER (PARTITION BY kind ORDER BY created_at DESC, version DESC) <= 7)
SELECT kind, version, size_bytes, created_at FROM manifest ANTI JOIN kept USING (kind, version)""")
def to_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention(a.manifest(spark, sf_dir), 7, 100_000)


@query("prune_older_than", f"SELECT event_id, event_type AS site_id, ts FROM events WHERE ts >= {AT} - INTERVAL 24 HOURS")
def pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune_older_than(a.telemetry(spark, sf_dir), ts_lit(a.NOW)).select("event_id", "site_id", "ts")


@query("file_stamps", ctes("manifest") + """
SELECT version, 'weather_fusion_' || strftime(created_at, '%Y%m%d_%H%M%S') AS name, date_trunc('second', created_at) AS made_at,
  created_at >= TIMESTAMP '2024-01-01 06:00:00' AS is_fresh FROM manifest""")
def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = a.manifest(spark, sf_dir).select(
        F.col("version").alias("id"), F.concat(F.lit("weather_fusion_"), file_stamp("created_at")).alias("version"))
    fresh = fresh_versions(named, ts_lit("2024-01-01 06:30:00")).select("id", F.lit(True).alias("_fresh"))
    return named.join(fresh, "id", "left").select(
        F.col("id").alias("version"), F.col("version").alias("name"), parse_file_stamp("version").alias("made_at"),
        F.coalesce("_fresh", F.lit(False)).alias("is_fresh"))


_SENT = "(event_id % 3 = 0)"


@query("outbox_pending", f"SELECT event_type AS site_id, ts, value FROM events WHERE NOT {_SENT}")
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.telemetry(spark, sf_dir)
    sent = outbox_mark(rows.filter(_SENT), ts_lit(a.NOW))
    return outbox_pending(rows.select("site_id", "ts", "value"), sent)


@query("outbox_mark", f"SELECT event_type AS site_id, ts, {AT} AS pushed_at FROM events WHERE {_SENT}")
def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox_mark(a.telemetry(spark, sf_dir).filter(_SENT), ts_lit(a.NOW))
