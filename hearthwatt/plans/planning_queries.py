"""Queries on planning: battery, events, comfort, import risk, start times, deferral, feedback."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timeparts import ts_lit
from ..operators.chunked import spread_join
from ..operators.fusion import interp_hourly
from ..operators.grid import forward_fill, local_day_grid
from ..operators.planning import (
    BATTERY_DEFAULTS, COMFORT_DEFAULTS, GOLDEN, battery_forecast, comfort_class, confidence, deferral, discomfort_factor, ev_start,
    event_forecast, event_probability, event_scores, feedback_metrics, net_import, retrain_gate, savings_summary,
)
from ..operators.scenarios import ev_start_confidence, import_backtest
from . import adapters as a
from .adapters import SQL, ctes, table
from .home_queries import COMPONENTS, ISSUE, TZ, best, components
from .registry import query, rounded, sql_round as r

SQL["load_grid"] = """
SELECT site_id, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTES)) AS ts FROM load GROUP BY site_id"""
SQL["filled_load"] = """
SELECT g.site_id, g.ts, last_value(l.total_actual_w IGNORE NULLS) OVER (PARTITION BY g.site_id ORDER BY g.ts
  ROWS UNBOUNDED PRECEDING) AS total_actual_w FROM load_grid g LEFT JOIN load l USING (site_id, ts)"""
SQL["price_grid"] = """
SELECT zone, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTES)) AS ts FROM prices GROUP BY zone"""
SQL["filled_price"] = """
SELECT g.zone, g.ts, last_value(p.price_eur_per_mwh IGNORE NULLS) OVER (PARTITION BY g.zone ORDER BY g.ts
  ROWS UNBOUNDED PRECEDING) AS price_eur_per_mwh FROM price_grid g LEFT JOIN prices p USING (zone, ts)"""
SQL["temps"] = """
SELECT h.site_id, h.ts + INTERVAL 1 MINUTE * m AS ts, CASE WHEN m = 0 THEN h.temperature_c
  ELSE h.temperature_c + (n.temperature_c - h.temperature_c) * (m / 60.0::DOUBLE) END AS temperature_c
FROM hourly h CROSS JOIN (VALUES (0), (15), (30), (45)) q(m)
LEFT JOIN hourly n ON n.site_id = h.site_id AND n.ts = h.ts + INTERVAL 1 HOUR"""
SQL["net"] = """
SELECT l.site_id, l.ts, l.total_actual_w - 2500 AS net_import_w, p.price_eur_per_mwh, t.temperature_c,
  CASE WHEN l.total_actual_w > 8000 THEN 'high' WHEN l.total_actual_w > 4000 THEN 'medium' ELSE 'low' END AS comfort_level
FROM filled_load l JOIN sites s USING (site_id) JOIN filled_price p ON p.zone = s.zone AND p.ts = l.ts
LEFT JOIN temps t ON t.site_id = l.site_id AND t.ts = l.ts"""
NET = ("load", "load_grid", "filled_load", "prices", "price_grid", "filled_price", "sites", "hourly", "temps", "net")


def filled_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forward_fill(a.load(spark, sf_dir), "total_actual_w", by=["site_id"]).select("site_id", "ts", "total_actual_w")


def net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import, price, temperature and comfort of every site on a full grid."""
    price = forward_fill(a.prices(spark, sf_dir), "price_eur_per_mwh").select("zone", "ts", "price_eur_per_mwh")
    by_site = spread_join(a.sites(spark, sf_dir), price, ["zone"], ["site_id"], "inner").drop("zone")
    total = F.col("total_actual_w")
    level = F.when(total > 8000, "high").when(total > 4000, "medium").otherwise("low")
    joined = filled_load(spark, sf_dir).join(by_site, ["site_id", "ts"]).join(
        interp_hourly(a.hourly(spark, sf_dir), ["temperature_c"]), ["site_id", "ts"], "left")
    return joined.select("site_id", "ts", (total - 2500).alias("net_import_w"), "price_eur_per_mwh", "temperature_c",
                         level.alias("comfort_level"))


@query("ev_start", ctes(*NET) + f""", priced AS (
  SELECT site_id, ts, greatest(0.0, least(net_import_w + 6500, 6500)) * price_eur_per_mwh * 0.25e0 / 1e6 AS cost,
    greatest(0.0, least(net_import_w + 6500, 6500)) * 0.25e0 / 1e3 AS kwh FROM net),
starts AS (SELECT site_id, ts, sum(cost) OVER w AS cost_eur, sum(kwh) OVER w AS grid_kwh, count(cost) OVER w AS n FROM priced
  WINDOW w AS (PARTITION BY site_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL 210 MINUTES FOLLOWING)),
local_starts AS (SELECT *, timezone('{TZ}', timezone('UTC', ts)) AS l, {r('cost_eur', 5)} AS cost_r FROM starts WHERE n = 15)
SELECT site_id, CAST(l AS DATE) AS local_date, CAST(row_number() OVER (PARTITION BY site_id, CAST(l AS DATE) ORDER BY cost_eur, ts) AS INTEGER) AS rank,
  ts AS start_ts, cost_r AS cost_eur, {r('grid_kwh', 5)} AS grid_kwh,
  CASE WHEN 1.0 - grid_kwh / 24.375::DOUBLE >= 0.5 THEN 'solar-first' ELSE 'grid-price-first' END AS rationale
FROM local_starts WHERE strftime(l, '%H:%M') BETWEEN '06:30' AND '22:30' QUALIFY rank <= 3""")
def charging_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev_start(net(spark, sf_dir)), {"cost_eur": 5, "grid_kwh": 5})


@query("heat_pump_deferral", ctes(*NET) + f""", slot_cost AS (
  SELECT *, greatest(0.0, least(net_import_w + 3000, 3000)) * price_eur_per_mwh * 0.25e0 / 1e6 AS cost FROM net),
runs_from AS (SELECT *, CASE WHEN count(cost) OVER w = 4 THEN sum(cost) OVER w END AS run FROM slot_cost
  WINDOW w AS (PARTITION BY site_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL 45 MINUTES FOLLOWING)),
limits AS (SELECT *, CASE WHEN temperature_c IS NOT NULL THEN least(
    1.0 + 0.1::DOUBLE * (least(greatest(temperature_c, -20.0), 20.0) + 20.0),
    CASE comfort_level WHEN 'low' THEN 3.0 WHEN 'medium' THEN 1.5 ELSE 0.0 END) ELSE 0.0 END AS limit_hours,
  min(CASE WHEN comfort_level = 'high' THEN ts END) OVER (PARTITION BY site_id ORDER BY ts
    RANGE BETWEEN CURRENT ROW AND INTERVAL 5 HOURS FOLLOWING) AS stop FROM runs_from),
options AS (SELECT n.site_id, n.ts, n.run, o.ts AS start_at, o.run AS option_cost FROM limits n JOIN runs_from o
  ON o.site_id = n.site_id AND o.ts >= n.ts AND o.ts <= n.ts + INTERVAL 5 HOURS
  WHERE n.run IS NOT NULL AND o.run IS NOT NULL AND (o.ts = n.ts OR (
    o.ts <= n.ts + INTERVAL 1 MINUTE * CAST(floor(n.limit_hours * 60.0) AS BIGINT) AND (n.stop IS NULL OR o.ts <= n.stop)))),
best AS (SELECT * FROM options QUALIFY row_number() OVER (PARTITION BY site_id, ts ORDER BY option_cost, start_at) = 1)
SELECT n.site_id, n.ts, n.comfort_level, {r('n.limit_hours', 6)} AS limit_hours, coalesce(b.start_at, n.ts) AS restart_ts,
  CAST((epoch(coalesce(b.start_at, n.ts)) - epoch(n.ts)) / 60 AS INTEGER) AS delay_min,
  {r('coalesce(n.run - b.option_cost, 0.0)', 5)} AS saving_eur
FROM limits n LEFT JOIN best b USING (site_id, ts)""")
def heat_pump_deferral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(deferral(net(spark, sf_dir)), {"limit_hours": 6, "saving_eur": 5})


_WEEKLY = f"""local_components AS (SELECT *, timezone('{TZ}', timezone('UTC', ts)) AS l,
  ev_actual_w + sauna_actual_w + other_actual_w AS w FROM components WHERE ts >= TIMESTAMP '{a.NOW}' - INTERVAL 56 DAYS AND ts < TIMESTAMP '{a.NOW}'),
seen AS (SELECT site_id, CAST(dayofweek(l) + 1 AS INTEGER) AS weekday, CAST(hour(l) * 4 + minute(l) // 15 AS INTEGER) AS slot,
  event_class, count(*) AS n, avg(w) AS expected_power_w FROM local_components GROUP BY 1, 2, 3, 4),
shares AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY site_id, weekday, slot) AS probability_pct FROM seen),
lengths AS (SELECT site_id, event_class, quantile_cont(n * 15.0::DOUBLE, 0.5) AS typical_duration_min FROM (
  SELECT site_id, event_class, event_id, (epoch(max(ts)) - epoch(min(ts))) / 900 + 1 AS n FROM local_components
  WHERE event_class <> 'none' GROUP BY 1, 2, 3) GROUP BY 1, 2),
probability AS (SELECT site_id, event_class AS event_type, weekday, slot, probability_pct, expected_power_w, typical_duration_min
  FROM shares JOIN lengths USING (site_id, event_class) WHERE event_class <> 'none')"""
_PROB = {"probability_pct": 5, "expected_power_w": 3, "typical_duration_min": 3}
_PROB_SQL = ", ".join(f"{r(c, d)} AS {c}" for c, d in _PROB.items())


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_probability(components(spark, sf_dir), a.NOW, tz=TZ)


@query("event_probability", ctes(*COMPONENTS) + f", {_WEEKLY} SELECT site_id, event_type, weekday, slot, {_PROB_SQL} FROM probability")
def weekly_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(probabilities(spark, sf_dir), _PROB)


@query("event_forecast", ctes(*COMPONENTS, "sites") + f""", {_WEEKLY}, grid AS (
  SELECT site_id, unnest(generate_series(TIMESTAMP '2024-01-31 22:00:00', TIMESTAMP '2024-02-01 21:45:00', INTERVAL 15 MINUTES)) AS ts FROM sites)
SELECT g.site_id, g.ts AS target_ts, event_type, {_PROB_SQL} FROM grid g JOIN probability p ON p.site_id = g.site_id
  AND p.weekday = dayofweek(timezone('{TZ}', timezone('UTC', g.ts))) + 1
  AND p.slot = hour(timezone('{TZ}', timezone('UTC', g.ts))) * 4 + minute(g.ts) // 15""")
def coming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = local_day_grid(a.sites(spark, sf_dir), "2024-02-01", TZ)
    return rounded(event_forecast(probabilities(spark, sf_dir), grid, TZ), _PROB)


@query("comfort_class", ctes("load", "hourly") + f""", factors AS (
  SELECT event_type AS site_id, 1.0::DOUBLE + 0.0001::DOUBLE * count(*) AS factor FROM events GROUP BY 1),
inputs AS (SELECT h.site_id, h.ts, h.temperature_c, least(100.0, l.total_actual_w / 100) AS prob, coalesce(f.factor, 1.0) AS factor
  FROM hourly h LEFT JOIN load l USING (site_id, ts) LEFT JOIN factors f USING (site_id)),
risks AS (SELECT *, factor * (prob / 100.0::DOUBLE
  + CASE WHEN hour(timezone('{TZ}', timezone('UTC', ts))) IN (6, 7, 8, 18, 19, 20, 21) THEN 0.2::DOUBLE ELSE 0.0 END
  + CASE WHEN temperature_c < -6.0 THEN 0.2::DOUBLE ELSE 0.0 END) AS risk FROM inputs),
levels AS (SELECT *, CASE WHEN risk < 0.3 THEN 'low' WHEN risk < 0.6 THEN 'medium' ELSE 'high' END AS comfort_level FROM risks)
SELECT site_id, ts, comfort_level, CASE comfort_level WHEN 'low' THEN 3.0::DOUBLE WHEN 'medium' THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END AS max_defer_hours FROM levels""")
def comfort(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("site_id"), F.lit("discomfort").alias("feedback_type"))
    probability = F.least(F.lit(100.0), F.col("total_actual_w") / 100).alias("hot_water_prob_pct")
    rows = a.hourly(spark, sf_dir).join(a.load(spark, sf_dir), ["site_id", "ts"], "left").select(
        "site_id", "ts", "temperature_c", probability)
    inputs = spread_join(rows, discomfort_factor(reports, {"report_step": 0.0001}), ["site_id"], ["ts"]).withColumn("factor", F.coalesce("factor", F.lit(1.0)))
    return comfort_class(inputs, {**COMFORT_DEFAULTS, "cold_below_c": -6.0}).select("site_id", "ts", "comfort_level", "max_defer_hours")


_GOLDEN, _ROOT2, _ROOT3 = GOLDEN, math.sqrt(2) - 1, math.sqrt(3) - 1


SQL["bands"] = """
SELECT site_id, target_ts AS ts, yhat_p10 AS b10, yhat_p50 AS b50, yhat_p90 AS b90, yhat_p50 * 0.25 AS s10, yhat_p50 * 0.5 AS s50, yhat_p50 * 0.75 AS s90 FROM best"""


def _draws_sql(n: int, bands: str = "bands") -> str:
    """Each row in ``n`` draws, which have the same ranks in every slot."""
    return f"""
SELECT x.*, i, b50 + (b90 - b10) / 2.5632::DOUBLE * radius * cos(angle)
    - greatest(0.0, s50 + (s90 - s10) / 2.5632::DOUBLE * radius * sin(angle)) - 500
    + CASE WHEN ((i * {_ROOT2!r}::DOUBLE) % 1.0) * 100.0 < 30 THEN 6500 ELSE 0 END
    + CASE WHEN ((i * {_ROOT3!r}::DOUBLE) % 1.0) * 100.0 < 10 THEN 11000 ELSE 0 END AS w
  FROM {bands} x CROSS JOIN (SELECT i, sqrt(-2.0 * ln((i + 0.5) / {n}.0::DOUBLE)) AS radius,
    2.0 * pi() * ((i * {_GOLDEN!r}::DOUBLE) % 1.0) AS angle FROM range({n}) t(i))"""


SQL["draws"] = _draws_sql(1000)
SQL["risk"] = """
SELECT site_id, ts, quantile_cont(w, 0.1) AS p10, quantile_cont(w, 0.5) AS p50, quantile_cont(w, 0.9) AS p90 FROM draws GROUP BY 1, 2"""
RISK = ("runs", "run_values", "best", "bands", "draws", "risk")


def _risk_inputs(p50: Column, p10: Column, p90: Column) -> list[Column]:
    kinds = F.array(*[F.struct(F.lit(share).alias("probability_pct"), F.lit(watts).alias("power_w"))
                      for share, watts in ((30.0, 6500.0), (10.0, 11000.0))])
    return [p10.alias("baseline_p10"), p50.alias("baseline_p50"), p90.alias("baseline_p90"), (p50 * 0.25).alias("pv_p10"),
            (p50 * 0.5).alias("pv_p50"), (p50 * 0.75).alias("pv_p90"), F.lit(500.0).alias("battery_w"), kinds.alias("events")]


def _risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = _risk_inputs(F.col("yhat_p50"), F.col("yhat_p10"), F.col("yhat_p90"))
    return net_import(best(spark, sf_dir).select("site_id", F.col("target_ts").alias("ts"), *bands))


@query("net_import_mc", ctes(*RISK) + f"""
SELECT site_id, ts AS target_ts, {r('p10', 3)} AS import_p10_w, {r('p50', 3)} AS import_p50_w, {r('p90', 3)} AS import_p90_w FROM risk""")
def import_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_risk(spark, sf_dir), {f"import_p{q}_w": 3 for q in (10, 50, 90)})


_BACKTEST = {"rmse_w": 2, "bias_w": 2, "coverage_pct": 4, "loss_p10_w": 2, "loss_p50_w": 2, "loss_p90_w": 2}


@query("net_import_backtest", ctes(*RISK, "load") + f""", tried AS (
  SELECT site_id, ts, x, x - p10 AS e10, x - p50 AS e50, x - p90 AS e90
  FROM risk JOIN (SELECT site_id, ts, total_actual_w - 2500 AS x FROM load) USING (site_id, ts)
  WHERE ts >= TIMESTAMP '{a.NOW}' - INTERVAL 30 DAYS AND ts < TIMESTAMP '{a.NOW}')
SELECT site_id, count(*) AS n, {r('sqrt(avg(e50 * e50))', 2)} AS rmse_w, {r('avg(e50)', 2)} AS bias_w,
  {r('100.0 * avg(CASE WHEN e10 >= 0 AND e90 <= 0 THEN 1 ELSE 0 END)', 4)} AS coverage_pct,
  {r('avg(greatest(0.1::DOUBLE * e10, -0.9::DOUBLE * e10))', 2)} AS loss_p10_w, {r('avg(greatest(0.5::DOUBLE * e50, -0.5::DOUBLE * e50))', 2)} AS loss_p50_w,
  {r('avg(greatest(0.9::DOUBLE * e90, -0.1::DOUBLE * e90))', 2)} AS loss_p90_w, sqrt(avg(e50 * e50)) < 500 AS acceptable FROM tried GROUP BY 1""")
def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual = a.load(spark, sf_dir).select("site_id", "ts", (F.col("total_actual_w") - 2500).alias("net_import_w"))
    return rounded(import_backtest(_risk(spark, sf_dir), actual, a.NOW), _BACKTEST)


SQL["charging_bands"] = """
SELECT site_id, ts, price_eur_per_mwh, 0.8::DOUBLE * x AS b10, x AS b50, 1.2::DOUBLE * x AS b90, x * 0.25 AS s10, x * 0.5 AS s50, x * 0.75 AS s90
FROM (SELECT site_id, ts, price_eur_per_mwh, (net_import_w + 2500) * 0.25::DOUBLE AS x FROM net)"""
_START = {"expected_eur": 5, "cost_p10_eur": 5, "cost_p50_eur": 5, "cost_p90_eur": 5, "confidence_pct": 3}


@query("ev_start_confidence", ctes(*NET, "charging_bands") + f""", drawn AS ({_draws_sql(100, "charging_bands")}),
costs AS (SELECT site_id, ts, i, greatest(0.0, least(w + 6500, 6500)) * price_eur_per_mwh * 0.25e0 / 1e6 AS cost FROM drawn),
runs_from AS (SELECT site_id, ts, i, sum(cost) OVER w AS cost, count(cost) OVER w AS n, timezone('{TZ}', timezone('UTC', ts)) AS l FROM costs
  WINDOW w AS (PARTITION BY site_id, i ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL 210 MINUTES FOLLOWING)),
starts AS (SELECT *, CAST(l AS DATE) AS local_date, min(cost) OVER (PARTITION BY site_id, CAST(l AS DATE), i) AS cheapest
  FROM runs_from WHERE n = 15 AND strftime(l, '%H:%M') BETWEEN '06:30' AND '22:30'),
rated AS (SELECT site_id, local_date, ts, round(avg(cost), 9) AS expected, quantile_cont(cost, 0.1) AS p10, quantile_cont(cost, 0.5) AS p50,
  quantile_cont(cost, 0.9) AS p90, 100.0 * avg(CASE WHEN cost <= cheapest * 1.05::DOUBLE + 0.005::DOUBLE THEN 1 ELSE 0 END) AS sure FROM starts GROUP BY 1, 2, 3)
SELECT site_id, local_date, CAST(row_number() OVER (PARTITION BY site_id, local_date ORDER BY expected, ts) AS INTEGER) AS rank, ts AS start_ts,
  {r('expected', 5)} AS expected_eur, {r('p10', 5)} AS cost_p10_eur, {r('p50', 5)} AS cost_p50_eur, {r('p90', 5)} AS cost_p90_eur, {r('sure', 3)} AS confidence_pct
FROM rated QUALIFY rank <= 3""")
def charging_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = (F.col("net_import_w") + 2500) * 0.25
    bands = _risk_inputs(level, level * 0.8, level * 1.2)
    return rounded(ev_start_confidence(net(spark, sf_dir).select("site_id", "ts", "price_eur_per_mwh", *bands)), _START)


_B = BATTERY_DEFAULTS
_ONE_WAY = math.sqrt(_B["round_trip"])


@query("battery_forecast", "WITH RECURSIVE " + ctes("load", "load_grid", "filled_load", "telemetry")[5:] + f""",
soc AS (SELECT site_id, arg_max(battery_soc_pct, ts) AS soc_pct FROM telemetry WHERE ts <= TIMESTAMP '{ISSUE}' GROUP BY 1),
steps AS (SELECT site_id, ts, row_number() OVER (PARTITION BY site_id ORDER BY ts) AS i,
  CASE WHEN x >= 0 THEN -least(x, 5000) / {_ONE_WAY!r}::DOUBLE ELSE least(-x, 5000) * {_ONE_WAY!r}::DOUBLE END * 0.25e0 AS d
  FROM (SELECT site_id, ts, total_actual_w - 2500 AS x FROM filled_load
    WHERE ts > TIMESTAMP '{ISSUE}' AND ts <= TIMESTAMP '{ISSUE}' + INTERVAL 24 HOURS)),
levels AS (SELECT site_id, CAST(0 AS BIGINT) AS i, soc_pct * 200.0::DOUBLE AS wh FROM soc
  UNION ALL SELECT s.site_id, s.i, least(greatest(v.wh + s.d, least(3000.0::DOUBLE, v.wh)), 20000.0::DOUBLE)
  FROM levels v JOIN steps s ON s.site_id = v.site_id AND s.i = v.i + 1)
SELECT s.site_id, s.ts AS target_ts, {r('v.wh / 200.0::DOUBLE', 5)} AS soc_p50,
  {r(f'least(5000.0::DOUBLE, greatest(0.0, v.wh - 3000.0) * {_ONE_WAY / 0.25!r}::DOUBLE)', 4)} AS discharge_power_w, 0.93::DOUBLE AS efficiency_ratio
FROM levels v JOIN steps s USING (site_id, i)""")
def battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = filled_load(spark, sf_dir).select("site_id", "ts", (F.col("total_actual_w") - 2500).alias("net_load_w"))
    soc = a.telemetry(spark, sf_dir).filter(F.col("ts") <= ts_lit(ISSUE)).groupBy("site_id").agg(
        F.max_by("battery_soc_pct", "ts").alias("soc_pct"))
    return rounded(battery_forecast(loads, soc, BATTERY_DEFAULTS, ISSUE), {"soc_p50": 5, "discharge_power_w": 4})


# ---- confidence and feedback -------------------------------------------------------------------------------------

@query("recommendation_confidence", f"""
WITH recs AS (SELECT o_orderkey, o_totalprice AS p50, o_orderstatus <> 'P' AS price_available, o_custkey % 101 AS cover,
  o_orderkey % 60 AS age, (o_orderkey % 7 - 1)::DOUBLE AS s, (o_orderkey % 5)::DOUBLE AS p, (o_orderkey % 3)::DOUBLE + 0.25 AS b FROM orders),
shares AS (SELECT o_orderkey, unnest([100.0::DOUBLE * abs(s) / (abs(s) + p + b), 100.0::DOUBLE * p / (abs(s) + p + b),
  100.0::DOUBLE * b / (abs(s) + p + b)]) AS share, unnest(['solar', 'price', 'battery']) AS driver FROM recs),
ranked AS (SELECT o_orderkey, arg_max(driver, (share, driver)) AS top_driver, max(share) AS top_share FROM shares GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS recommendation_id, top_driver, {r('top_share', 4)} AS top_share_pct, {r('''100.0::DOUBLE * (
  0.4::DOUBLE * greatest(0.0, 1.0 - 0.2::DOUBLE) + 0.2::DOUBLE * CASE WHEN price_available THEN 1.0 ELSE 0.0 END
  + 0.2::DOUBLE * (cover / 100.0::DOUBLE) + 0.2::DOUBLE * CASE WHEN age < 30 THEN 1.0 ELSE 0.5 END)''', 4)} AS confidence,
  {r('s + p + b', 4)} AS saving_eur, {r('(s + p + b) * 0.85::DOUBLE', 4)} AS saving_low_eur, {r('(s + p + b) * 1.15::DOUBLE', 4)} AS saving_high_eur
FROM recs JOIN ranked USING (o_orderkey)""")
def recommendation_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    recs = o.select(
        key.cast("string").alias("recommendation_id"), (F.col("o_totalprice") * 0.8).alias("solar_p10"),
        F.col("o_totalprice").alias("solar_p50"), (F.col("o_totalprice") * 1.2).alias("solar_p90"),
        (F.col("o_orderstatus") != "P").alias("price_available"), (F.col("o_custkey") % 101).alias("event_coverage_pct"),
        (key % 60).alias("soc_age_min"), (key % 7 - 1).cast("double").alias("saving_solar_eur"),
        (key % 5).cast("double").alias("saving_price_eur"), (key % 3 + F.lit(0.25)).alias("saving_battery_eur"))
    out = confidence(recs).select(
        "recommendation_id", F.col("drivers")[0]["driver"].alias("top_driver"), F.col("drivers")[0]["share_pct"].alias("top_share_pct"),
        "confidence", "saving_eur", "saving_low_eur", "saving_high_eur")
    return rounded(out, {c: 4 for c in out.columns[2:]})


def _scored(spark: SparkSession, sf_dir: str, predicted_mod: int) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("site_id"), F.window("ts", "15 minutes").start.alias("ts"),
        F.concat(F.lit("e"), (F.col("user_id") % 3).cast("string")).alias("event_type"), "event_id")
    key = ["site_id", "ts", "event_type"]
    return event_scores(ev.filter(F.col("event_id") % predicted_mod != 0).select(*key).distinct(),
                        ev.filter(F.col("event_id") % 3 != 0).select(*key).distinct())


def _scores_sql(name: str, mod: int) -> str:
    return f"""{name} AS (SELECT event_type, count(*) FILTER (WHERE p AND a) AS tp, count(*) FILTER (WHERE p AND NOT a) AS fp,
  count(*) FILTER (WHERE a AND NOT p) AS fn FROM (SELECT event_type AS s, time_bucket(INTERVAL 15 MINUTES, ts) AS ts, 'e' || (user_id % 3) AS event_type,
    bool_or(event_id % {mod} <> 0) AS p, bool_or(event_id % 3 <> 0) AS a FROM events GROUP BY 1, 2, 3) GROUP BY 1)"""


@query("event_scores", f"""
WITH {_scores_sql('c', 2)} SELECT event_type, tp, fp, fn, {r('tp / (tp + fp)', 6)} AS precision, {r('tp / (tp + fn)', 6)} AS recall,
  {r('2 * tp / (2 * tp + fp + fn)', 6)} AS f1 FROM c""")
def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scored(spark, sf_dir, 2), {"precision": 6, "recall": 6, "f1": 6})


@query("retrain_gate", f"""
WITH {_scores_sql('o', 2)}, {_scores_sql('n', 5)},
f AS (SELECT n.event_type, 2 * n.tp / (2 * n.tp + n.fp + n.fn) AS new_f1, 2 * o.tp / (2 * o.tp + o.fp + o.fn) AS old_f1
  FROM n LEFT JOIN o USING (event_type))
SELECT event_type, {r('new_f1', 6)} AS new_f1, {r('old_f1', 6)} AS old_f1, old_f1 IS NULL OR new_f1 >= old_f1 AS publish FROM f""")
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(retrain_gate(_scored(spark, sf_dir, 2), _scored(spark, sf_dir, 5)), {"new_f1": 6, "old_f1": 6})


@query("feedback_metrics", ctes("recommendations", "outcomes", "complaints") + f""", m AS (
SELECT type, count(*) AS n, count(*) FILTER (WHERE accepted) AS n_accepted,
  sum(saving) FILTER (WHERE accepted AND actual_cost_eur IS NOT NULL) AS predicted, sum(baseline - actual_cost_eur) FILTER (WHERE accepted) AS realised,
  count(*) FILTER (WHERE accepted AND c.recommendation_id IS NOT NULL) AS n_discomfort, count(DISTINCT window_start) AS distinct_windows
FROM recommendations r LEFT JOIN outcomes o USING (recommendation_id) LEFT JOIN complaints c USING (recommendation_id) GROUP BY 1)
SELECT type, n, n_accepted, {r('predicted', 3)} AS predicted_saving_eur, {r('realised', 3)} AS realised_saving_eur, n_discomfort, distinct_windows,
  {r('n_accepted / n', 6)} AS acceptance_rate, {r('realised / predicted', 6)} AS realised_share, {r('n_discomfort / n_accepted', 6)} AS discomfort_rate FROM m""")
def feedback_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feedback_metrics(a.recommendations(spark, sf_dir), a.outcomes(spark, sf_dir), a.feedback(spark, sf_dir))
    return rounded(out, {"predicted_saving_eur": 3, "realised_saving_eur": 3, "acceptance_rate": 6, "realised_share": 6, "discomfort_rate": 6})


@query("savings_summary", ctes("recommendations", "outcomes") + f"""
SELECT CAST(timezone('{TZ}', timezone('UTC', timestamp)) AS DATE) AS local_date, count(*) AS proposed, count(*) FILTER (WHERE accepted) AS accepted,
  count(*) FILTER (WHERE NOT accepted) AS rejected, count(*) FILTER (WHERE accepted IS NULL) AS unanswered,
  {r('sum(saving)', 3)} AS expected_saving_eur, {r('sum(baseline - actual_cost_eur) FILTER (WHERE accepted)', 3)} AS realised_saving_eur
FROM recommendations LEFT JOIN outcomes USING (recommendation_id) GROUP BY 1""")
def savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = savings_summary(a.recommendations(spark, sf_dir), a.outcomes(spark, sf_dir), TZ)
    return rounded(out, {"expected_saving_eur": 3, "realised_saving_eur": 3})
