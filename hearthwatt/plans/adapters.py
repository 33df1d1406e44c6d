"""Domain tables derived from the driver's tables, in Spark and, with the same arithmetic, in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.quantities import parse_registers
from ..functions.timeparts import ts_lit, with_slot
from ..operators.averaging import avg_15min
from ..schemas import MEASURED

NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fragments of SQL; `ctes` strings together the ones a query needs.
SQL: dict[str, str] = {}


def ctes(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"


SQL["telemetry"] = """
SELECT event_id, event_type AS site_id, ts, value,
  value / 5 - 10 AS temperature_c, value / 8 - 12 AS dew_point_c,
  CAST(40 + event_id % 60 AS DOUBLE) AS relative_humidity, CAST(980 + event_id % 50 AS DOUBLE) AS pressure_hpa,
  value / 10 AS wind_speed_ms, CAST((event_id * 37) % 360 AS DOUBLE) AS wind_direction_deg,
  (event_id % 7) / 10.0::DOUBLE AS precip_mmph,
  CAST(event_id % 40000 AS DOUBLE) AS energy_today_wh, value * 100 AS pv_feed_in_w,
  CAST(event_id % 101 AS DOUBLE) AS battery_soc_pct, CAST(event_id % 2001 - 1000 AS DOUBLE) AS active_power_pcc_w,
  CAST(event_id % 300 AS DOUBLE) AS bat_charge_w, CAST(event_id % 500 AS DOUBLE) AS bat_discharge_w,
  CAST(json_extract(props, '$.k') AS DOUBLE) AS r30775, CAST(event_id % 1000 AS DOUBLE) AS r30517
FROM events"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows: a site per event type, readings by arithmetic on value and id, registers as JSON text."""
    return telemetry_from(table(spark, sf_dir, "events"))


def telemetry_from(ev: DataFrame) -> DataFrame:
    i, v = F.col("event_id"), F.col("value")
    registers = F.concat(F.lit('{"30775":'), F.get_json_object("props", "$.k"), F.lit(',"30517":'),
                         (i % 1000).cast("string"), F.lit(',"label":"x"}'))
    return ev.select(
        "event_id", F.col("event_type").alias("site_id"), "ts", "value",
        (v / 5 - 10).alias("temperature_c"), (v / 8 - 12).alias("dew_point_c"),
        (40 + i % 60).cast("double").alias("relative_humidity"), (980 + i % 50).cast("double").alias("pressure_hpa"),
        (v / 10).alias("wind_speed_ms"), (i * 37 % 360).cast("double").alias("wind_direction_deg"),
        (i % 7 / F.lit(10.0)).alias("precip_mmph"),
        (i % 40000).cast("double").alias("energy_today_wh"), (v * 100).alias("pv_feed_in_w"),
        (i % 101).cast("double").alias("battery_soc_pct"), (i % 2001 - 1000).cast("double").alias("active_power_pcc_w"),
        (i % 300).cast("double").alias("bat_charge_w"), (i % 500).cast("double").alias("bat_discharge_w"),
        parse_registers(registers).alias("registers"))


_means = ", ".join(f"avg({c}) AS {c}" for c in MEASURED if not c.startswith("wind_"))
SQL["station_sums"] = f"""
SELECT site_id, time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES AS ts, count(*) AS rows_used, {_means},
  avg(wind_speed_ms * sin(radians(wind_direction_deg))) AS east,
  avg(wind_speed_ms * cos(radians(wind_direction_deg))) AS north
FROM telemetry GROUP BY 1, 2"""
SQL["station"] = """
SELECT * EXCLUDE (east, north), sqrt(east * east + north * north) AS wind_speed_ms,
  CASE WHEN sqrt(east * east + north * north) > 1e-9
    THEN (degrees(atan2(east, north)) + 360.0) % 360.0 END AS wind_direction_deg
FROM station_sums"""
STATION = ("telemetry", "station_sums", "station")


def station(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """Quarter-hour means per site, labelled with the end of the interval."""
    return avg_15min(telemetry(spark, sf_dir), MEASURED if cols is None else cols)


SQL["prices"] = """
SELECT 'Z' || (user_id % 2) AS zone, time_bucket(INTERVAL 15 MINUTES, ts) AS ts, avg(value) AS price_eur_per_mwh,
  max(ts) AS updated_at
FROM events GROUP BY 1, 2"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_slot(table(spark, sf_dir, "events"), "ts", "15 minutes", "slot")
    zone = F.concat(F.lit("Z"), (F.col("user_id") % 2).cast("string")).alias("zone")
    return ev.groupBy(zone, F.col("slot").alias("slot_ts")).agg(
        F.avg("value").alias("price_eur_per_mwh"), F.max("ts").alias("updated_at")).withColumnRenamed("slot_ts", "ts")


SQL["sites"] = """
SELECT DISTINCT event_type AS site_id, 'Z' || (length(event_type) % 2) AS zone FROM events"""


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.concat(F.lit("Z"), (F.length("event_type") % 2).cast("string"))
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("site_id"), zone.alias("zone")).distinct()


SQL["hourly"] = """
SELECT event_type AS site_id, time_bucket(INTERVAL 1 HOUR, ts) AS ts,
  avg(value) / 5 - 10 AS temperature_c, avg(value) / 10 AS wind_speed_ms,
  avg((event_id * 37) % 360) AS wind_direction_deg, least(100.0, avg(value) * 2) AS cloud_cover_pct,
  avg(value) * 10 AS shortwave_radiation_w_m2, avg(value) * 36000 AS radiation_accum_j_m2
FROM events GROUP BY 1, 2"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_slot(table(spark, sf_dir, "events"), "ts", "1 hour", "hour")
    mean = F.avg("value")
    return ev.groupBy(F.col("event_type").alias("site_id"), F.col("hour")).agg(
        (mean / 5 - 10).alias("temperature_c"), (mean / 10).alias("wind_speed_ms"),
        F.avg(F.col("event_id") * 37 % 360).alias("wind_direction_deg"),
        F.least(F.lit(100.0), mean * 2).alias("cloud_cover_pct"), (mean * 10).alias("shortwave_radiation_w_m2"),
        (mean * 36000).alias("radiation_accum_j_m2")).withColumnRenamed("hour", "ts")


_FC = ["temperature_c", "wind_speed_ms", "wind_direction_deg", "cloud_cover_pct", "shortwave_radiation_w_m2"]
SQL["spine"] = """
SELECT s.site_id, p.ts, p.price_eur_per_mwh, p.updated_at AS price_updated_at FROM prices p JOIN sites s USING (zone)"""
SQL["fusion"] = "SELECT p.site_id, p.ts, p.price_eur_per_mwh, p.price_updated_at, " + ", ".join(
    f"CASE WHEN minute(p.ts) = 0 THEN f1.{c} ELSE f1.{c} + (f2.{c} - f1.{c}) * (minute(p.ts) / 60.0::DOUBLE) END AS fc_{c}"
    for c in _FC) + """,
  m.temperature_c AS station_temperature_c, m.dew_point_c AS station_dew_point_c,
  m.relative_humidity AS station_humidity_pct, m.pressure_hpa AS station_pressure_hpa,
  m.wind_speed_ms AS station_wind_speed_ms, m.wind_direction_deg AS station_wind_direction_deg,
  CAST(NULL AS DOUBLE) AS station_wind_gust_ms, m.precip_mmph AS station_precipitation_mm_h,
  m.pv_feed_in_w AS station_pv_feed_in_w, CAST(NULL AS DOUBLE) AS station_pv_generation_w,
  CAST(NULL AS DOUBLE) AS station_grid_import_w, m.active_power_pcc_w AS station_active_power_pcc_w,
  m.battery_soc_pct AS station_battery_soc_pct, CAST(NULL AS DOUBLE) AS station_load_power_w
FROM spine p
LEFT JOIN hourly f1 ON f1.site_id = p.site_id AND f1.ts = date_trunc('hour', p.ts)
LEFT JOIN hourly f2 ON f2.site_id = p.site_id AND f2.ts = date_trunc('hour', p.ts) + INTERVAL 1 HOUR
LEFT JOIN station m ON m.site_id = p.site_id AND m.ts = p.ts"""
FUSION = (*STATION, "prices", "sites", "hourly", "spine", "fusion")

SQL["load"] = """
SELECT event_type AS site_id, time_bucket(INTERVAL 15 MINUTES, ts) AS ts, avg(value) * 100 AS total_actual_w
FROM events GROUP BY 1, 2"""


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load per site and quarter hour; the scale reaches the bands of every event class."""
    ev = with_slot(table(spark, sf_dir, "events"), "ts", "15 minutes", "slot")
    return ev.groupBy(F.col("event_type").alias("site_id"), F.col("slot")).agg(
        (F.avg("value") * 100).alias("total_actual_w")).withColumnRenamed("slot", "ts")


SQL["runs"] = """
SELECT DISTINCT event_type || '-' || (user_id % 5) AS run_id, event_type AS site_id,
  'baseline_consumption' AS model_name, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (user_id % 5) AS issued_at FROM events"""
SQL["run_values"] = """
SELECT event_type || '-' || (user_id % 5) AS run_id, event_type AS site_id, 'baseline_w' AS target,
  time_bucket(INTERVAL 15 MINUTES, ts) AS target_ts, avg(value) * 90 AS yhat_p50, avg(value) * 70 AS yhat_p10,
  avg(value) * 110 AS yhat_p90
FROM events GROUP BY 1, 2, 3, 4"""


def _run_id() -> Column:
    return F.concat(F.col("event_type"), F.lit("-"), (F.col("user_id") % 5).cast("string")).alias("run_id")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    issued = F.timestamp_add("HOUR", F.col("user_id") % 5, ts_lit("2024-01-01 00:00:00"))
    return table(spark, sf_dir, "events").select(
        _run_id(), F.col("event_type").alias("site_id"), F.lit("baseline_consumption").alias("model_name"),
        issued.alias("issued_at")).distinct()


def run_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs per site that overlap in the slots they cover."""
    ev = with_slot(table(spark, sf_dir, "events"), "ts", "15 minutes", "target_ts")
    mean = F.avg("value")
    return ev.groupBy(_run_id(), F.col("event_type").alias("site_id"), F.lit("baseline_w").alias("target"), "target_ts").agg(
        (mean * 90).alias("yhat_p50"), (mean * 70).alias("yhat_p10"), (mean * 110).alias("yhat_p90"))


SQL["commands"] = """
SELECT event_type AS site_id, ts, CASE event_id % 3 WHEN 0 THEN 'PROHIBIT_' || (event_id % 750 + 1)
  WHEN 1 THEN 'PROHIBIT' ELSE 'ALLOW' END AS command FROM events"""
SQL["valid_commands"] = """
SELECT site_id, ts, command, CASE WHEN command = 'ALLOW' THEN 'ALLOW' ELSE 'PROHIBIT' END AS mode,
  TRY_CAST(NULLIF(regexp_extract(command, '^PROHIBIT_([0-9]+)$', 1), '') AS INTEGER) AS minutes
FROM commands
WHERE NOT coalesce(TRY_CAST(NULLIF(regexp_extract(command, '^PROHIBIT_([0-9]+)$', 1), '') AS INTEGER) > 720, FALSE)"""


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three kinds of command; some timed ones are longer than 720 minutes and so not valid."""
    return commands_from(table(spark, sf_dir, "events"))


def commands_from(ev: DataFrame) -> DataFrame:
    i = F.col("event_id")
    text = (F.when(i % 3 == 0, F.concat(F.lit("PROHIBIT_"), (i % 750 + 1).cast("string")))
            .when(i % 3 == 1, F.lit("PROHIBIT")).otherwise(F.lit("ALLOW")))
    return ev.select(F.col("event_type").alias("site_id"), "ts", text.alias("command"))


SQL["manifest"] = """
SELECT source AS kind, 'v' || doc_id AS version, n_chars * 100 AS size_bytes,
  TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * doc_id AS created_at FROM documents"""
SQL["backups"] = """
SELECT CASE doc_id % 3 WHEN 0 THEN 'dump' WHEN 1 THEN 'export' ELSE 'archive' END AS kind, 'v' || doc_id AS version,
  n_chars * 100 AS size_bytes, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * doc_id AS created_at,
  CASE WHEN n_chars > 50 THEN 'ok' ELSE 'failed' END AS status FROM documents"""


def _files(spark: SparkSession, sf_dir: str, kind: Column) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        kind.alias("kind"), F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("version"),
        (F.col("n_chars") * 100).alias("size_bytes"),
        F.timestamp_add("MINUTE", F.col("doc_id"), ts_lit("2024-01-01 00:00:00")).alias("created_at"),
        F.when(F.col("n_chars") > 50, "ok").otherwise("failed").alias("status"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version per document, its kind from the source."""
    return _files(spark, sf_dir, F.col("source")).drop("status")


def backups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same versions as dumps, exports and archives."""
    r = F.col("doc_id") % 3
    return _files(spark, sf_dir, F.when(r == 0, "dump").when(r == 1, "export").otherwise("archive"))


SQL["recommendations"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS recommendation_id, o_orderdate AS timestamp, o_orderpriority AS type,
  CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS accepted,
  floor(o_totalprice) / 1000 AS saving, floor(o_totalprice) / 400 AS baseline,
  CAST(o_custkey % 24 AS VARCHAR) AS window_start FROM orders"""
SQL["outcomes"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS recommendation_id, sum(l_quantity) AS actual_cost_eur FROM lineitem GROUP BY 1"""
SQL["complaints"] = """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS recommendation_id FROM lineitem WHERE l_returnflag = 'R'"""


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    payload = F.to_json(F.struct(
        (F.floor("o_totalprice") / 1000).alias("predicted_saving_eur"),
        (F.floor("o_totalprice") / 400).alias("baseline_cost_eur"),
        (F.col("o_custkey") % 24).cast("string").alias("window_start")))
    accepted = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    return o.select(F.col("o_orderkey").cast("string").alias("recommendation_id"), F.col("o_orderdate").alias("timestamp"),
                    F.col("o_orderpriority").alias("type"), accepted.alias("accepted"), payload.alias("payload_json"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").cast("string").alias("recommendation_id")).agg(
        F.sum("l_quantity").alias("actual_cost_eur"))


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return li.select(F.lit("discomfort").alias("feedback_type"), F.col("l_orderkey").cast("string").alias("recommendation_id")).distinct()
