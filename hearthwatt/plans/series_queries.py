"""Queries on grids, gaps, averages, keys and the wide series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.quantities import cents_per_kwh, max_deferral_hours, register
from ..functions.timeparts import between_dates, calendar_features, hour_minute, local_date, ts_lit, with_slot
from ..operators.averaging import avg_15min, avg_json_keys, avg_newest_n, merge_latest, to_api_json, wind_vector_avg
from ..operators.chunked import fill_forward, neighbours
from ..operators.fusion import (
    backfill_units, display_projection, interp_hourly, power_from_accumulation, weather_fusion,
)
from ..operators.grid import find_gaps, forward_fill, local_day_grid, missing_slots, span_grid, split_aligned
from ..operators.keyed import dedupe, insert_ignore, key_violations, latest_rows, newest_n, upsert
from ..schemas import FORECAST_COLUMNS, MEASURED
from . import adapters as a
from .adapters import FUSION, STATION, ctes, table
from .registry import query, rounded, sql_round as r

FUSION_ROUND = {"price_eur_per_mwh": 5, **{f"fc_{c}": 5 for c in FORECAST_COLUMNS}}
STATION_ROUND = {
    "station_temperature_c": 5, "station_dew_point_c": 5, "station_humidity_pct": 5, "station_pressure_hpa": 5,
    "station_wind_speed_ms": 5, "station_wind_direction_deg": 4, "station_precipitation_mm_h": 5,
    "station_pv_feed_in_w": 4, "station_active_power_pcc_w": 5, "station_battery_soc_pct": 5,
}


def wide_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_fusion(a.prices(spark, sf_dir), a.hourly(spark, sf_dir), a.station(spark, sf_dir), a.sites(spark, sf_dir))


def _fusion_sql() -> str:
    kept = {**FUSION_ROUND, **STATION_ROUND}
    cols = ", ".join(f"{r(c, d)} AS {c}" for c, d in kept.items())
    empty = ", ".join(f"station_{c}" for c in ("wind_gust_ms", "pv_generation_w", "grid_import_w", "load_power_w"))
    return ctes(*FUSION) + f"SELECT site_id, ts, price_updated_at, {cols}, {empty} FROM fusion"


@query("fusion_interpolated", _fusion_sql())
def fusion_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(wide_series(spark, sf_dir), {**FUSION_ROUND, **STATION_ROUND})


@query("forecast_interpolated", ctes("hourly") + f"""
SELECT h.site_id, h.ts + INTERVAL 1 MINUTE * m AS ts, """ + ", ".join(
    r(f"CASE WHEN m = 0 THEN h.{c} ELSE h.{c} + (n.{c} - h.{c}) * (m / 60.0::DOUBLE) END", 5) + f" AS {c}"
    for c in FORECAST_COLUMNS) + """
FROM hourly h CROSS JOIN (VALUES (0), (15), (30), (45)) q(m)
LEFT JOIN hourly n ON n.site_id = h.site_id AND n.ts = h.ts + INTERVAL 1 HOUR""")
def forecast_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(interp_hourly(a.hourly(spark, sf_dir)), {c: 5 for c in FORECAST_COLUMNS})


@query("direction_interpolated_circular", ctes("hourly") + f"""
SELECT h.site_id, h.ts + INTERVAL 1 MINUTE * m AS ts,
  {r('''CASE WHEN m = 0 THEN h.wind_direction_deg ELSE (h.wind_direction_deg
    + ((((n.wind_direction_deg - h.wind_direction_deg + 540.0) % 360.0) + 360.0) % 360.0 - 180.0) * (m / 60.0::DOUBLE)
    + 360.0) % 360.0 END''', 4)} AS wind_direction_deg
FROM hourly h CROSS JOIN (VALUES (0), (15), (30), (45)) q(m)
LEFT JOIN hourly n ON n.site_id = h.site_id AND n.ts = h.ts + INTERVAL 1 HOUR""")
def direction_interpolated_circular(spark: SparkSession, sf_dir: str) -> DataFrame:
    only = ("wind_direction_deg",)
    return rounded(interp_hourly(a.hourly(spark, sf_dir), only, circular=only), {"wind_direction_deg": 4})


@query("display_rows", ctes(*FUSION) + """
SELECT site_id, ts, strftime(timezone('Europe/Helsinki', timezone('UTC', ts)), '%H:%M') AS local_time,
""" + ",\n".join(
    f"coalesce(CAST(round(CAST({e} AS DECIMAL(28, 9)), {d}) AS VARCHAR), '-') AS {n}" for n, e, d in [
        ("price_cents_per_kwh", "(price_eur_per_mwh / 10.0::DOUBLE + 0.5::DOUBLE) * 1.255::DOUBLE", 1),
        ("fc_temperature_c", "fc_temperature_c", 1), ("station_temperature_c", "station_temperature_c", 1),
        ("fc_wind_speed_ms", "fc_wind_speed_ms", 1), ("station_wind_speed_ms", "station_wind_speed_ms", 1),
        ("fc_wind_direction_deg", "fc_wind_direction_deg", 0), ("station_wind_direction_deg", "station_wind_direction_deg", 0),
        ("fc_cloud_cover_pct", "fc_cloud_cover_pct", 0), ("fc_shortwave_radiation_w_m2", "fc_shortwave_radiation_w_m2", 1),
        ("station_pv_feed_in_w", "station_pv_feed_in_w", 0), ("station_active_power_pcc_w", "station_active_power_pcc_w", 0),
        ("station_battery_soc_pct", "station_battery_soc_pct", 0)]) + """
FROM fusion WHERE ts >= TIMESTAMP '2024-01-09 22:00:00' AND ts < TIMESTAMP '2024-01-11 22:00:00'""")
def display_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display_projection(wide_series(spark, sf_dir), "Europe/Helsinki", 0.5, start="2024-01-10", end="2024-01-11")


@query("price_with_vat", ctes("prices") + f"""
SELECT zone, ts, {r('(price_eur_per_mwh / 10.0::DOUBLE + 0.5::DOUBLE) * 1.255::DOUBLE', 5)} AS price_cents_per_kwh,
  strftime(timezone('Europe/Helsinki', timezone('UTC', ts)), '%H:%M') AS local_time FROM prices""")
def price_with_vat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = a.prices(spark, sf_dir).select(
        "zone", "ts", cents_per_kwh("price_eur_per_mwh", 0.5).alias("price_cents_per_kwh"),
        hour_minute("ts", "Europe/Helsinki").alias("local_time"))
    return rounded(out, {"price_cents_per_kwh": 5})


_GRID = """price_grid AS (SELECT zone, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTES)) AS ts
  FROM prices GROUP BY zone)"""


@query("price_forward_fill", ctes("prices") + f""", {_GRID}
SELECT g.zone, g.ts,
  {r('last_value(p.price_eur_per_mwh IGNORE NULLS) OVER w', 6)} AS price_eur_per_mwh,
  p.price_eur_per_mwh IS NULL AND last_value(p.price_eur_per_mwh IGNORE NULLS) OVER w IS NOT NULL AS is_filled,
  last_value(CASE WHEN p.price_eur_per_mwh IS NOT NULL THEN g.ts END IGNORE NULLS) OVER w AS source_ts
FROM price_grid g LEFT JOIN prices p USING (zone, ts)
WINDOW w AS (PARTITION BY g.zone ORDER BY g.ts ROWS UNBOUNDED PRECEDING)""")
def price_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forward_fill(a.prices(spark, sf_dir), "price_eur_per_mwh"), {"price_eur_per_mwh": 6})


@query("missing_slots", ctes("load") + """, grid AS (
  SELECT site_id, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTES)) AS ts FROM load GROUP BY site_id)
SELECT site_id, ts FROM grid ANTI JOIN load USING (site_id, ts)""")
def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = a.load(spark, sf_dir)
    return missing_slots(slots, span_grid(slots, ["site_id"]))


@query("gap_report", ctes("load") + """
SELECT * FROM (SELECT site_id, ts AS from_ts, lead(ts) OVER w AS to_ts,
  CAST((epoch(lead(ts) OVER w) - epoch(ts)) / 900 AS BIGINT) - 1 AS n_missing
  FROM load WINDOW w AS (PARTITION BY site_id ORDER BY ts)) WHERE n_missing > 0""")
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_gaps(a.load(spark, sf_dir))


@query("local_day_slots", ctes("sites") + """
SELECT site_id, unnest(generate_series(TIMESTAMP '2026-03-28 22:00:00', TIMESTAMP '2026-03-29 20:45:00',
  INTERVAL 15 MINUTES)) AS ts FROM sites""")
def local_day_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_day_grid(a.sites(spark, sf_dir), "2026-03-29", "Europe/Helsinki")


@query("order_day_gaps", """
WITH days AS (SELECT DISTINCT o_orderpriority || '/' || (o_custkey % 50) AS site_id, o_orderdate AS ts FROM orders)
SELECT * FROM (SELECT site_id, ts AS from_ts, lead(ts) OVER w AS to_ts,
  CAST((epoch(lead(ts) OVER w) - epoch(ts)) / 86400 AS BIGINT) - 1 AS n_missing
  FROM days WINDOW w AS (PARTITION BY site_id ORDER BY ts)) WHERE n_missing > 0""")
def order_day_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.concat(F.col("o_orderpriority"), F.lit("/"), (F.col("o_custkey") % 50).cast("string"))
    days = table(spark, sf_dir, "orders").select(group.alias("site_id"), F.col("o_orderdate").alias("ts")).distinct()
    return find_gaps(days, step_seconds=86400)


@query("shipped_day_fill", f"""
WITH days AS (SELECT l_returnflag || '/' || l_suppkey AS zone, l_shipdate AS ts, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2),
grid AS (SELECT zone, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM days GROUP BY zone)
SELECT g.zone, g.ts, last_value(d.quantity IGNORE NULLS) OVER w AS quantity, d.quantity IS NULL AS is_filled,
  last_value(CASE WHEN d.quantity IS NOT NULL THEN g.ts END IGNORE NULLS) OVER w AS source_ts
FROM grid g LEFT JOIN days d USING (zone, ts)
WINDOW w AS (PARTITION BY g.zone ORDER BY g.ts ROWS UNBOUNDED PRECEDING)""")
def shipped_day_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.concat(F.col("l_returnflag"), F.lit("/"), F.col("l_suppkey").cast("string")).alias("zone")
    days = table(spark, sf_dir, "lineitem").groupBy(zone, F.col("l_shipdate").alias("ts")).agg(F.sum("l_quantity").alias("quantity"))
    return forward_fill(days, "quantity", step_seconds=86400)


@query("alignment_split", """
WITH t AS (SELECT event_type AS site_id, time_bucket(INTERVAL 5 MINUTES, ts) AS ts FROM events)
SELECT site_id, count(*) FILTER (WHERE minute(ts) IN (0, 15, 30, 45)) AS aligned,
  count(*) FILTER (WHERE minute(ts) NOT IN (0, 15, 30, 45)) AS quarantined FROM t GROUP BY 1""")
def alignment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_slot(table(spark, sf_dir, "events"), "ts", "5 minutes", "slot").select(
        F.col("event_type").alias("site_id"), F.col("slot").alias("ts"))
    good, bad = split_aligned(rows)
    marked = good.withColumn("ok", F.lit(True)).unionByName(bad.withColumn("ok", F.lit(False)))
    return marked.groupBy("site_id").agg(F.count_if("ok").alias("aligned"), F.count_if(~F.col("ok")).alias("quarantined"))


@query("alignment_violations", """
SELECT event_type AS site_id, ts FROM events
WHERE NOT (date_trunc('minute', ts) = ts AND minute(ts) IN (0, 15, 30, 45))""")
def alignment_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_aligned(a.telemetry(spark, sf_dir).select("site_id", "ts"))[1]


@query("key_violations", "SELECT o_custkey, o_orderdate, count(*) AS n_rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("avg_15min", ctes(*STATION) + "SELECT site_id, ts, rows_used, " + ", ".join(
    f"{r(c, 4)} AS {c}" for c in MEASURED) + " FROM station")
def station_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(a.station(spark, sf_dir), {c: 4 for c in MEASURED})


@query("wind_vector_15min", ctes(*STATION) + f"""
SELECT site_id, ts, {r('wind_speed_ms', 5)} AS wind_speed_ms, {r('wind_direction_deg', 4)} AS wind_direction_deg FROM station""")
def wind_vector_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_slot(a.telemetry(spark, sf_dir), "ts", "15 minutes", "slot_end", "end")
    out = wind_vector_avg(rows, by=["site_id", "slot_end"]).withColumnRenamed("slot_end", "ts")
    return rounded(out, {"wind_speed_ms": 5, "wind_direction_deg": 4})


@query("avg_json_registers", ctes("telemetry") + f"""
SELECT site_id, time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES AS ts, {r('avg(r30517)', 6)} AS r30517,
  {r('avg(r30775)', 6)} AS r30775, CAST(2 AS INTEGER) AS n_keys
FROM telemetry GROUP BY 1, 2""")
def avg_json_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = avg_15min(a.telemetry(spark, sf_dir), ["registers"]).select(
        "site_id", "ts", F.element_at("registers", "30517").alias("r30517"),
        F.element_at("registers", "30775").alias("r30775"), F.size("registers").alias("n_keys"))
    return rounded(out, {"r30517": 6, "r30775": 6})


@query("avg_registers_by_site", ctes("telemetry") + f"""
SELECT site_id, {r('avg(r30517)', 6)} AS r30517, {r('avg(r30775)', 6)} AS r30775 FROM telemetry GROUP BY 1""")
def avg_registers_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = avg_json_keys(a.telemetry(spark, sf_dir), by=["site_id"]).select(
        "site_id", F.element_at("registers", "30517").alias("r30517"), F.element_at("registers", "30775").alias("r30775"))
    return rounded(out, {"r30517": 6, "r30775": 6})


_NEWEST = """newest AS (SELECT * FROM telemetry
  QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY ts DESC) <= {n})"""
_NEWEST_COLS = ["temperature_c", "pressure_hpa", "wind_speed_ms", "wind_direction_deg", "pv_feed_in_w"]


def _newest_sql(n: int) -> str:
    return ctes("telemetry") + ", " + _NEWEST.format(n=n) + f""",
sums AS (SELECT site_id, count(*) AS rows_used, avg(temperature_c) AS t, avg(pressure_hpa) AS p, avg(pv_feed_in_w) AS v,
  avg(wind_speed_ms * sin(radians(wind_direction_deg))) AS e, avg(wind_speed_ms * cos(radians(wind_direction_deg))) AS n
  FROM newest GROUP BY 1)
SELECT site_id, CAST({n} AS INTEGER) AS n, rows_used, {r('t', 5)} AS temperature_c, {r('p', 5)} AS pressure_hpa,
  {r('sqrt(e * e + n * n)', 5)} AS wind_speed_ms, {r('(degrees(atan2(e, n)) + 360.0) % 360.0', 4)} AS wind_direction_deg,
  {r('v', 4)} AS pv_feed_in_w FROM sums"""


_NEWEST_ROUND = {"temperature_c": 5, "pressure_hpa": 5, "wind_speed_ms": 5, "wind_direction_deg": 4, "pv_feed_in_w": 4}


@query("avg_newest_n", _newest_sql(15))
def newest_15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(avg_newest_n(a.telemetry(spark, sf_dir), 15, _NEWEST_COLS), _NEWEST_ROUND)


@query("avg_newest_900", _newest_sql(900))
def newest_900(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(avg_newest_n(a.telemetry(spark, sf_dir), 900, _NEWEST_COLS), _NEWEST_ROUND)


@query("api_json", ctes("telemetry") + ", " + _NEWEST.format(n=60) + f"""
SELECT site_id, CAST(60 AS INTEGER) AS n, count(*) AS rows_used, {r('avg(temperature_c)', 5)} AS temperature_c,
  {r('avg(r30517)', 5)} AS r30517 FROM newest GROUP BY 1""")
def api_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["temperature_c", "registers"]
    documents = to_api_json(avg_newest_n(a.telemetry(spark, sf_dir), 60, cols), cols)
    parsed = F.from_json("json", "n int, rows_used bigint, data struct<temperature_c double, registers map<string,double>>")
    out = documents.select("site_id", parsed.alias("j")).select(
        "site_id", "j.n", "j.rows_used", F.col("j.data.temperature_c").alias("temperature_c"),
        F.element_at("j.data.registers", "30517").alias("r30517"))
    return rounded(out, {"temperature_c": 5, "r30517": 5})


@query("typed_registers", ctes("telemetry") + """
SELECT event_id, site_id, CAST(r30775 AS BIGINT) AS pv_feed_in_w, CAST(r30517 AS BIGINT) AS energy_today_wh,
  CAST(0 AS BIGINT) AS battery_soc_pct FROM telemetry""")
def typed_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.telemetry(spark, sf_dir).select(
        "event_id", "site_id", register("registers", "30775").alias("pv_feed_in_w"),
        register("registers", "30517").alias("energy_today_wh"), register("registers", "30845").alias("battery_soc_pct"))


_SITE10 = "'s' || (user_id % 10)"


@query("merge_latest_documents", f"""
WITH l AS (SELECT {_SITE10} AS site_id, ts, value / 5 - 10 AS temperature_c FROM events WHERE event_type <> 'click'),
rr AS (SELECT {_SITE10} AS site_id, ts, value * 100 AS pv_feed_in_w FROM events WHERE event_type = 'click')
SELECT l.site_id, l.ts, {r('l.temperature_c', 6)} AS temperature_c,
  CASE WHEN rr.ts >= l.ts - INTERVAL 2 HOURS THEN rr.ts END AS right_ts,
  {r('CASE WHEN rr.ts >= l.ts - INTERVAL 2 HOURS THEN rr.pv_feed_in_w END', 6)} AS pv_feed_in_w
FROM l ASOF LEFT JOIN rr ON l.site_id = rr.site_id AND l.ts >= rr.ts""")
def merge_latest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("site_id", F.concat(F.lit("s"), (F.col("user_id") % 10).cast("string")))
    weather = ev.filter("event_type <> 'click'").select("site_id", "ts", (F.col("value") / 5 - 10).alias("temperature_c"))
    inverter = ev.filter("event_type = 'click'").select("site_id", "ts", (F.col("value") * 100).alias("pv_feed_in_w"))
    return rounded(merge_latest(weather, inverter, 7200), {"temperature_c": 6, "pv_feed_in_w": 6})


@query("dedupe_last", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1""")
def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"]
    return dedupe(table(spark, sf_dir, "orders").select(*cols), cols[:2], ["o_orderkey"])


@query("dedupe_first", """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedupe(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], keep="first")


_UPSERT = """
target AS (SELECT zone, ts, price_eur_per_mwh, updated_at AS created_at, updated_at FROM prices WHERE minute(ts) < 30),
updates AS (SELECT zone, ts, price_eur_per_mwh + 1 AS price_eur_per_mwh FROM prices WHERE minute(ts) > 0)"""


def _stored_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = a.prices(spark, sf_dir)
    stored = rows.filter(F.minute("ts") < 30).select("zone", "ts", "price_eur_per_mwh",
                                                     F.col("updated_at").alias("created_at"), "updated_at")
    new = rows.filter(F.minute("ts") > 0).select("zone", "ts", (F.col("price_eur_per_mwh") + 1).alias("price_eur_per_mwh"))
    return stored, new


@query("upsert", ctes("prices") + f""", {_UPSERT}
SELECT zone, ts, {r('coalesce(u.price_eur_per_mwh, t.price_eur_per_mwh)', 6)} AS price_eur_per_mwh,
  coalesce(t.created_at, TIMESTAMP '{a.NOW}') AS created_at,
  CASE WHEN u.zone IS NOT NULL THEN TIMESTAMP '{a.NOW}' ELSE t.updated_at END AS updated_at
FROM target t FULL JOIN updates u USING (zone, ts)""")
def upsert_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, new = _stored_and_new(spark, sf_dir)
    return rounded(upsert(stored, new, ["zone", "ts"], ts_lit(a.NOW)), {"price_eur_per_mwh": 6})


@query("insert_ignore", ctes("prices") + f""", {_UPSERT}
SELECT zone, ts, {r('price_eur_per_mwh', 6)} AS price_eur_per_mwh FROM target
UNION ALL SELECT zone, ts, {r('price_eur_per_mwh', 6)} FROM updates ANTI JOIN target USING (zone, ts)""")
def insert_ignore_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, new = _stored_and_new(spark, sf_dir)
    merged = insert_ignore(stored.select("zone", "ts", "price_eur_per_mwh"), new, ["zone", "ts"], ["price_eur_per_mwh"])
    return rounded(merged, {"price_eur_per_mwh": 6})


@query("latest_n_rows", """
SELECT event_id, ts, timezone('Europe/Helsinki', timezone('UTC', ts)) AS local_ts, value FROM events
ORDER BY ts DESC LIMIT 96""")
def latest_n_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.convert_timezone(F.lit("UTC"), F.lit("Europe/Helsinki"), "ts").alias("local_ts"), "value")
    return latest_rows(ev, ["ts"], 96)


@query("newest_n_per_group", """
SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
  l_partkey DESC, l_extendedprice DESC) <= 3""")
def newest_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", *cols)
    return newest_n(rows, ["l_suppkey"], cols, 3).select("l_suppkey", *cols[:3])


@query("radiation_from_hourly_energy", ctes("hourly") + f"""
SELECT site_id, ts, {r('''coalesce(CASE WHEN hour(ts) % 2 = 0 THEN shortwave_radiation_w_m2 END,
  radiation_accum_j_m2 / 3600.0::DOUBLE)''', 5)} AS shortwave_radiation_w_m2 FROM hourly""")
def radiation_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.hourly(spark, sf_dir).select(
        "site_id", "ts", "radiation_accum_j_m2",
        F.when(F.hour("ts") % 2 == 0, F.col("shortwave_radiation_w_m2")).alias("shortwave_radiation_w_m2"))
    return rounded(power_from_accumulation(rows).drop("radiation_accum_j_m2"), {"shortwave_radiation_w_m2": 5})


@query("radiation_from_running_energy", ctes("hourly") + f"""
SELECT site_id, ts, {r('''CASE WHEN radiation_accum_j_m2 - lag(radiation_accum_j_m2) OVER w >= 0
  THEN radiation_accum_j_m2 - lag(radiation_accum_j_m2) OVER w ELSE radiation_accum_j_m2 END / 3600.0::DOUBLE''', 4)}
  AS shortwave_radiation_w_m2
FROM hourly WINDOW w AS (PARTITION BY site_id ORDER BY ts)""")
def radiation_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.hourly(spark, sf_dir).select(
        "site_id", "ts", "radiation_accum_j_m2", F.lit(None).cast("double").alias("shortwave_radiation_w_m2"))
    out = power_from_accumulation(rows, mode="cumulative").drop("radiation_accum_j_m2")
    return rounded(out, {"shortwave_radiation_w_m2": 4})


@query("backfill_units", ctes("hourly") + f"""
SELECT site_id, ts, {r('''CASE WHEN ts < TIMESTAMP '2024-01-15' THEN radiation_accum_j_m2 / 3600.0::DOUBLE
  ELSE radiation_accum_j_m2 END''', 4)} AS shortwave_radiation_w_m2, ts < TIMESTAMP '2024-01-15' AS unit_fixed FROM hourly""")
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = a.hourly(spark, sf_dir).select("site_id", "ts", F.col("radiation_accum_j_m2").alias("shortwave_radiation_w_m2"))
    old = F.col("ts") < ts_lit("2024-01-15 00:00:00")
    return rounded(backfill_units(backfill_units(stored, old), old), {"shortwave_radiation_w_m2": 4})


@query("csv_range", """
SELECT ts, event_type AS site_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08'""")
def csv_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.telemetry(spark, sf_dir).filter(between_dates("ts", "2024-01-05", "2024-01-07")).select("ts", "site_id", "value")


@query("deferral_limit", ctes("hourly") + f"""
SELECT site_id, ts, {r('1.0 + 0.1::DOUBLE * (least(greatest(temperature_c, -20.0), 20.0) + 20.0)', 6)} AS max_delay_hours FROM hourly""")
def deferral_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = a.hourly(spark, sf_dir).select("site_id", "ts", max_deferral_hours("temperature_c").alias("max_delay_hours"))
    return rounded(out, {"max_delay_hours": 6})


@query("calendar_cells", """
WITH t AS (SELECT timezone('Europe/Helsinki', timezone('UTC', ts)) AS l, value FROM events)
SELECT CAST(hour(l) AS INTEGER) AS hour_of_day, CAST(dayofweek(l) + 1 AS INTEGER) AS day_of_week,
  dayofweek(l) IN (0, 6) AS is_weekend, CAST(l AS DATE) IN (DATE '2024-01-06') AS is_holiday, count(*) AS n
FROM t GROUP BY ALL""")
def calendar_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    holidays = a.telemetry(spark, sf_dir).select(local_date("ts", "Europe/Helsinki").alias("date")).filter(
        F.col("date") == F.lit("2024-01-06").cast("date")).distinct()
    rows = calendar_features(a.telemetry(spark, sf_dir).select("ts"), "Europe/Helsinki", holidays=holidays)
    return rows.groupBy("hour_of_day", "day_of_week", "is_weekend", "is_holiday").agg(F.count(F.lit(1)).alias("n"))


@query("rows_without_place", """
WITH t AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS site_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS ts,
                  CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events),
placed AS (SELECT *, lag(value) OVER w AS value_before, lead(value) OVER w AS value_after,
                  last_value(value IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value_held
           FROM t WHERE site_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY site_id ORDER BY ts))
SELECT event_id, site_id, ts, value, value_before, value_after, value_held FROM placed
UNION ALL SELECT event_id, site_id, ts, value, NULL, NULL, value FROM t WHERE site_id IS NULL OR ts IS NULL""")
def rows_without_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, some without a site, a time or a value: as many rows come out as go in."""
    known = lambda column, of: F.when(F.col("event_id") % of != 0, F.col(column))
    rows = table(spark, sf_dir, "events").select(
        "event_id", known("event_type", 7).alias("site_id"), known("ts", 5).alias("ts"), known("value", 3).alias("value"))
    beside = neighbours(rows, ["site_id"], "ts", {"value_before": "value"}, {"value_after": "value"})
    return fill_forward(beside, ["site_id"], "ts", {"value_held": "value"})
