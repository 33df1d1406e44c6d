"""Joint scenarios, confidence of charging starts, backtests, roofs per site, and how well a baseline model solves its equations."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import calendar_features, ts_lit
from hearthwatt.operators import baseline, planning, pv, scenarios
from hearthwatt.operators.quality import health_report, require_fresh
from hearthwatt.schemas import PV_DEFAULTS
from test_models import history, weather, wide

T0 = datetime(2026, 6, 10)
SCHEMA = ("site_id string, ts timestamp_ntz, baseline_p10 double, baseline_p50 double, baseline_p90 double, pv_p10 double, pv_p50 double, pv_p90 double, "
          "battery_w double, events array<struct<probability_pct:double,power_w:double>>, price_eur_per_mwh double")


def slots(n, seed=1, site="a", gaps=()):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        base, sun = rng.uniform(300, 4000), max(0.0, 6000 * math.sin((i % 96 - 20) / 60 * math.pi))
        events = [(30.0, 6500.0), (10.0, 3000.0)] if i % 3 else ([] if i % 2 else None)
        out.append((site, T0 + timedelta(minutes=15 * i), base * 0.8, None if i in gaps else base, base * 1.3, sun * 0.6, sun, sun * 1.4, 200.0, events,
                    float(rng.uniform(-10, 120)) if i % 50 else None if i == 100 else 40.0))
    return out


def draws(row, n):
    """Net import in each scenario, with the library's ranks."""
    i = np.arange(n)
    radius, angle = np.sqrt(-2 * np.log((i + 0.5) / n)), 2 * np.pi * (i * planning.GOLDEN % 1.0)
    if row[3] is None:
        return None
    total = row[3] + (row[4] - row[2]) / 2.5632 * radius * np.cos(angle) - np.maximum(0, row[6] + (row[7] - row[5]) / 2.5632 * radius * np.sin(angle)) - row[8]
    for (share, power), step in zip(row[9] or [], planning.event_steps(scenarios.KINDS)):
        total = total + np.where(i * step % 1.0 * 100 < share, power, 0.0)
    return total


def test_scenarios_are_the_draws(spark):
    rows = slots(12, gaps={4})
    got = spark.createDataFrame(rows, SCHEMA).select("ts", scenarios.import_scenarios(40).alias("w")).orderBy("ts").collect()
    for row, r in zip(rows, got):
        want = draws(row, 40)
        assert r["w"] is None if want is None else np.allclose(r["w"], want, atol=1e-6)
    crowded = [(*rows[0][:9], [(1.0, 1.0)] * (scenarios.KINDS + 1), 1.0)]
    with pytest.raises(Exception, match="events in one slot"):
        spark.createDataFrame(crowded, SCHEMA).select(scenarios.import_scenarios(3)).collect()


def test_confidence_of_starts(spark):
    n, p = 25, {**planning.EV_DEFAULTS, "tz": "UTC", "energy_kwh": 6.5, "power_w": 6500.0}
    rows = slots(96 * 2, gaps={60, 130}) + slots(96, 2, "b")
    got = scenarios.ev_start_confidence(spark.createDataFrame(rows, SCHEMA), p, k=3, n=n).collect()
    want = {}
    for site in "ab":
        mine = [r for r in rows if r[0] == site]
        cost = [None if draws(r, n) is None or r[10] is None else np.clip(draws(r, n) + 6500, 0, 6500) * r[10] * 0.25 / 1e6 for r in mine]
        days = {}
        for i, r in enumerate(mine):
            if f"{r[1]:%H:%M}" >= "06:30" and f"{r[1]:%H:%M}" <= "22:30" and i + 4 <= len(mine) and all(c is not None for c in cost[i:i + 4]):
                days.setdefault(r[1].date(), []).append((round(float(sum(cost[i:i + 4]).mean()), 9), r[1], sum(cost[i:i + 4])))
        for day, starts in days.items():
            least = np.min([c for *_, c in starts], axis=0)
            for k, (mean, ts, c) in enumerate(sorted(starts, key=lambda s: s[:2])[:3]):
                want[site, day, k + 1] = (ts, mean, *np.quantile(c, [0.1, 0.5, 0.9]), 100 * np.mean(c <= least * 1.05 + 0.005))
    assert {(r["site_id"], r["local_date"], r["rank"]) for r in got} == set(want) and len(want) == 9
    for r in got:
        start, *numbers = want[r["site_id"], r["local_date"], r["rank"]]
        assert r["start_ts"] == start and np.allclose([r["expected_eur"], r["cost_p10_eur"], r["cost_p50_eur"], r["cost_p90_eur"], r["confidence_pct"]], numbers, atol=1e-6)
    # Scenarios hold together over the charge: the spread of the sum is not that of independent slots.
    assert any(r["cost_p90_eur"] - r["cost_p10_eur"] > 0.05 for r in got)
    with pytest.raises(ValueError, match="time allowed"):
        scenarios.ev_start_confidence(spark.createDataFrame(rows[:1], SCHEMA), {**p, "max_hours": 0.5})


def test_backtest(spark):
    made = [("a", T0 + timedelta(hours=i), 100.0, 200.0, 300.0) for i in range(10)] + [("a", T0 + timedelta(hours=10), None, None, None), ("b", T0, 0.0, 0.0, 0.0)]
    seen = [("a", T0 + timedelta(hours=i), x) for i, x in enumerate([200.0, 250.0, 150.0, 301.0, 99.0, 100.0, 300.0, None, 200.0])] + [("c", T0, 1.0), ("a", T0 - timedelta(days=40), 9.0)]
    forecast = spark.createDataFrame(made, "site_id string, target_ts timestamp_ntz, import_p10_w double, import_p50_w double, import_p90_w double")
    actual = spark.createDataFrame(seen, "site_id string, ts timestamp_ntz, net_import_w double")
    rows = scenarios.import_backtest(forecast, actual, "2026-06-20 00:00:00").collect()
    x = np.array([200.0, 250, 150, 301, 99, 100, 300, 200])
    loss = {q: np.mean(np.maximum(q * (x - b), (q - 1) * (x - b))) for q, b in ((0.1, 100), (0.5, 200), (0.9, 300))}
    assert len(rows) == 1 and (rows[0]["n"], rows[0]["coverage_pct"], rows[0]["acceptable"]) == (8, 75.0, True)
    assert np.allclose([rows[0][c] for c in ("rmse_w", "bias_w", "loss_p10_w", "loss_p50_w", "loss_p90_w")],
                       [np.sqrt(np.mean((x - 200) ** 2)), np.mean(x - 200), loss[0.1], loss[0.5], loss[0.9]])
    assert scenarios.import_backtest(forecast, actual, "2026-06-20 00:00:00", rmse_limit_w=50.0).first()["acceptable"] is False


ROOFS = "site_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, lat double, lon double, panel_tilt_deg double, panel_azimuth_deg double, share double, max_w double"


def test_roofs_add_up_and_change(spark):
    frame, p = wide(spark, 3).select("site_id", "ts", pv.RAD, pv.CLOUD, pv.PV), PV_DEFAULTS
    first = frame.agg(F.min("ts")).first()[0]
    change = first + timedelta(days=1)
    place = (p["lat"], p["lon"])
    data = [("a", first, change, *place, 11.0, 90.0, 0.4, 1000.0), ("a", change, None, *place, 40.0, 90.0, 0.4, 2000.0), ("a", first, None, *place, 30.0, 250.0, 0.6, 3000.0)]
    out = pv.roof_radiation(frame, spark.createDataFrame(data, ROOFS), p)
    of = lambda tilt, azimuth: {(r["site_id"], r["ts"]): r for r in pv.effective_radiation(
        frame, {**p, "panel_tilt_deg": tilt, "panel_azimuth_deg": azimuth}).collect()}
    early, late, other = of(11.0, 90.0), of(40.0, 90.0), of(30.0, 250.0)
    rows = out.collect()
    assert len(rows) == frame.count() and out.columns == [*frame.columns, "elevation_deg", "effective_rad", "max_pv_w"]
    for r in rows:
        key = r["site_id"], r["ts"]
        if key[0] != "a":
            assert r["effective_rad"] is None and r["max_pv_w"] is None and r["elevation_deg"] is None
            continue
        one = (early if r["ts"] < change else late)[key]
        assert r["max_pv_w"] == (4000.0 if r["ts"] < change else 5000.0) and abs(r["elevation_deg"] - one["elevation_deg"]) < 1e-9
        want = one["effective_rad"]
        assert r["effective_rad"] is None if want is None else abs(r["effective_rad"] - 0.4 * want - 0.6 * other[key]["effective_rad"]) < 1e-6


def test_one_roof_like_the_parameters_gives_the_same_forecast(spark):
    frame, p = wide(spark, 12), {**PV_DEFAULTS, "cutoff": "2020-01-01 00:00:00", "min_train_samples": 5}
    last = frame.agg(F.max("ts")).first()[0]
    issue = (last - timedelta(days=1)).strftime("%Y-%m-%d %H:%M:%S")
    sites = [r[0] for r in frame.select("site_id").distinct().collect()]
    roofs = spark.createDataFrame([(s, datetime(2000, 1, 1), None, p["lat"], p["lon"], p["panel_tilt_deg"], p["panel_azimuth_deg"], 1.0, p["max_pv_w"]) for s in sites], ROOFS)
    plain, own = (sorted((r["site_id"], r["target_ts"], *(x if x is None else round(x, 6) for x in (r["yhat_p10"], r["yhat_p50"], r["yhat_p90"]))) for r in values.collect())
                  for _, values in (pv.pv_forecast(frame, p, issue), pv.pv_forecast(frame, p, issue, roofs=roofs)))
    assert plain == own and any(row[3] for row in own)
    capped = pv.pv_forecast(frame, p, issue, roofs=roofs.withColumn("max_w", F.lit(10.0)))[1]
    assert capped.agg(F.max("yhat_p90")).first()[0] <= 10.0


def test_normal_equations(spark):
    frame = weather(spark, 700)
    train = calendar_features(history(spark, frame).join(frame, ["site_id", "ts"]), "Europe/Helsinki")
    models = baseline.fit_ridge(baseline.gram(train), 1.0)
    for r in baseline.normal_residual(train, models, 1.0).collect():
        assert r["largest_slope"] < 1e-6 and abs(r["mean_error"]) < 1e-6 and 0.9 < r["r2"] <= 1.0 and r["n_samples"] == 700
    worse = models.withColumn("weekend_coef", F.col("weekend_coef") + 50.0)
    assert all(r["largest_slope"] > 1.0 for r in baseline.normal_residual(train, worse, 1.0).collect())


def test_readable_stores_are_part_of_the_report(spark, tmp_path):
    sites = spark.createDataFrame([("a", "Z")], "site_id string, zone string")
    frame = spark.createDataFrame([("a", T0)], "site_id string, ts timestamp_ntz")
    frame.write.parquet(f"{tmp_path}/t")
    rows = health_report({"sites": sites, "station": frame}, T0, stores={
        "there": lambda: spark.read.parquet(f"{tmp_path}/t"), "lost": lambda: spark.read.parquet(f"{tmp_path}/lost")}).collect()
    assert {(r["scope"], r["check"], r["status"]) for r in rows} == {("there", "readable", "ok"), ("lost", "readable", "error"), ("a", "station_freshness", "ok")}


@pytest.mark.parametrize("name", ["weather_fusion", "", "v20261399_000000", "20260101"])
def test_names_without_a_time(name):
    with pytest.raises(ValueError, match="does not end in the time"):
        require_fresh(name, T0)


def test_ts_literals_do_not_depend_on_the_zone(spark):
    assert spark.range(1).select(ts_lit(T0)).first()[0] == T0
