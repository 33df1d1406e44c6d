"""Forecast and planning models against plain computations."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import calendar_features, ts_lit
from hearthwatt.operators import baseline, planning, pv, scoring
from hearthwatt.operators.keyed import newest_per_target
from hearthwatt.schemas import BASELINE_DEFAULTS, PV_DEFAULTS, PV_PRODUCTION

T0 = datetime(2026, 3, 20)


def weather(spark, slots, sites=("a", "b")):
    rng = np.random.default_rng(5)
    data = [(s, T0 + timedelta(minutes=15 * i), *(float(x) for x in rng.normal([3, 5, 60, 100], [4, 2, 20, 80])))
            for s in sites for i in range(slots)]
    return spark.createDataFrame(data, "site_id string, ts timestamp_ntz, " + ", ".join(f"{w} double" for w in baseline.WEATHER))


def history(spark, frame):
    hours = F.hour("ts")
    load = 800 + 30 * F.col("fc_temperature_c") - 2 * F.col("fc_wind_speed_ms") + 50 * hours + 10 * (F.col("fc_cloud_cover_pct") % 7)
    return frame.select("site_id", "ts", (load + F.when(F.col("site_id") == "b", 100).otherwise(0)).alias("baseline_actual_w"))


def brute_ridge(rows, alpha):
    """Closed form on the full design matrix."""
    x = np.array([[*(r[w] for w in baseline.WEATHER), *(r["hour_of_day"] == h for h in range(1, 24)),
                   *(r["day_of_week"] == d for d in range(2, 8)), r["is_weekend"], r["is_holiday"]] for r in rows], float)
    y = np.array([r["baseline_actual_w"] for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    used = scale > 1e-9
    z = (x[:, used] - mean[used]) / scale[used]
    beta = np.linalg.solve(z.T @ z + alpha * np.eye(used.sum()), z.T @ (y - y.mean()))
    fitted = y.mean() + z @ beta
    return fitted, float(np.std(y - fitted, ddof=1))


def test_ridge_from_cells_is_ridge_from_rows(spark):
    frame = weather(spark, 900)
    issue = (T0 + timedelta(minutes=15 * 900)).isoformat(sep=" ")
    holidays = spark.createDataFrame([(datetime(2026, 3, 24).date(),)], "date date")
    train = baseline.training_rows(history(spark, frame), frame, BASELINE_DEFAULTS, issue, holidays)
    models = baseline.fit_ridge(baseline.gram(train), 1.0)
    scored = train.join(models, "site_id").withColumn("yhat", baseline.predict())
    for site in ("a", "b"):
        rows = train.filter(F.col("site_id") == site).orderBy("ts").collect()
        assert any(r["is_holiday"] for r in rows)
        fitted, spread = brute_ridge(rows, 1.0)
        got = [r["yhat"] for r in scored.filter(F.col("site_id") == site).orderBy("ts").collect()]
        assert got == pytest.approx(fitted, rel=1e-8)
        model = models.filter(F.col("site_id") == site).first()
        assert (model["n_samples"], model["residual_std"]) == (900, pytest.approx(spread, rel=1e-6))


def test_baseline_forecast_covers_the_horizon(spark):
    frame = weather(spark, 900)
    issue = (T0 + timedelta(minutes=15 * 600)).isoformat(sep=" ")
    run, values = baseline.baseline_forecast(history(spark, frame).filter(F.col("ts") < ts_lit(issue)), frame, BASELINE_DEFAULTS, issue)
    rows = values.collect()
    assert len(rows) == 2 * 192 and run.count() == 2 and {r["target"] for r in rows} == {"baseline_w"}
    assert all(r["yhat_p10"] <= r["yhat_p50"] <= r["yhat_p90"] for r in rows)
    assert min(r["target_ts"] for r in rows) > datetime.fromisoformat(issue)
    assert {r["run_id"] for r in rows} == {r["run_id"] for r in run.collect()}


def wide(spark, days):
    data = []
    for i in range(96 * days):
        ts = T0 + timedelta(minutes=15 * i)
        sun = max(0.0, 600 * math.sin(math.pi * (ts.hour + ts.minute / 60 - 5) / 14))
        data.append(("a", ts, sun, float(i % 101), 30 * sun))
    data += [("new", ts, rad, cloud, None) for _, ts, rad, cloud, _ in data]
    return spark.createDataFrame(data, f"site_id string, ts timestamp_ntz, {pv.RAD} double, {pv.CLOUD} double, {pv.PV} double")


def test_solar_forecast(spark):
    issue = (T0 + timedelta(days=5)).isoformat(sep=" ")
    run, values = pv.pv_forecast(wide(spark, 7), PV_PRODUCTION, issue)
    sources = {r["site_id"]: r["ratio_source"] for r in run.collect()}
    assert sources == {"a": "learned", "new": "bootstrap"}
    rows = values.collect()
    assert len(rows) == 2 * 96 and all(0 <= r["yhat_p10"] <= r["yhat_p50"] <= r["yhat_p90"] <= 41900 for r in rows)
    dark = {r["ts"] for r in wide(spark, 7).filter(F.col(pv.RAD) < 5).collect()}
    assert all(r["yhat_p50"] == 0 for r in rows if r["target_ts"] in dark)
    assert any(r["yhat_p50"] > 1000 for r in rows if r["site_id"] == "a")
    again = pv.pv_forecast(wide(spark, 7), PV_PRODUCTION, issue)[0]
    assert {r["run_id"] for r in again.collect()} == {r["run_id"] for r in run.collect()}


def test_solar_cutoff_limits_the_history(spark):
    late = {**PV_DEFAULTS, "cutoff": (T0 + timedelta(days=4, hours=23)).isoformat(sep=" ")}
    run, _ = pv.pv_forecast(wide(spark, 7), late, (T0 + timedelta(days=5)).isoformat(sep=" "))
    assert {r["ratio_source"] for r in run.collect()} == {"bootstrap"}


def test_newest_run_per_target_not_one_run(spark):
    runs = spark.createDataFrame([("r1", T0), ("r2", T0 + timedelta(hours=1))], "run_id string, issued_at timestamp_ntz")
    at = [T0 + timedelta(hours=h) for h in (2, 3)]
    values = spark.createDataFrame([("r1", "a", "pv", at[0], 1.0), ("r1", "a", "pv", at[1], 1.0), ("r2", "a", "pv", at[1], 2.0)],
                                   "run_id string, site_id string, target string, target_ts timestamp_ntz, yhat_p50 double")
    full = values.withColumns({"yhat_p10": F.col("yhat_p50"), "yhat_p90": F.col("yhat_p50")})
    got = newest_per_target(full, runs).orderBy("target_ts").collect()
    assert [(r["run_id"], r["yhat_p50"]) for r in got] == [("r1", 1.0), ("r2", 2.0)]


def test_errors_use_only_complete_pairs(spark):
    pairs = spark.createDataFrame([("a", 3.0, 1.0), ("a", 1.0, 4.0), ("a", None, 4.0), ("a", 1.0, None)], "site_id string, yhat_p50 double, actual double")
    [row] = scoring.forecast_error(pairs).collect()
    assert tuple(row)[1:] == (2, 2.5, pytest.approx(math.sqrt(6.5)), -0.5)


def test_import_quantiles(spark):
    schema = ("site_id string, ts timestamp_ntz, baseline_p10 double, baseline_p50 double, baseline_p90 double, pv_p10 double, pv_p50 double, "
              "pv_p90 double, battery_w double, events array<struct<probability_pct: double, power_w: double>>")
    sure, half = [(100.0, 2000.0)], [(50.0, 1000.0)]
    data = [("a", T0, 900.0, 1000.0, 1100.0, 0.0, 0.0, 0.0, 0.0, []), ("b", T0, 1000.0, 1000.0, 1000.0, 300.0, 300.0, 300.0, 200.0, sure),
            ("c", T0, None, None, None, 0.0, 0.0, 0.0, 0.0, half), ("d", T0, 1000.0, 1000.0, 1000.0, 0.0, 0.0, 0.0, 0.0, half)]
    out = {r["site_id"]: tuple(r)[2:] for r in planning.net_import(spark.createDataFrame(data, schema), 2000, seed=3).collect()}
    assert out["a"] == pytest.approx((900, 1000, 1100), abs=4)
    assert out["b"] == pytest.approx((2500, 2500, 2500))
    assert out["c"] == (None, None, None)
    assert (out["d"][0], out["d"][2]) == (1000.0, 2000.0)


def slots(spark, values, name, start=T0, **constant):
    frame = spark.createDataFrame([("a", start + timedelta(minutes=15 * i), float(v)) for i, v in enumerate(values)], f"site_id string, ts timestamp_ntz, {name} double")
    return frame.withColumns({k: F.lit(v) for k, v in constant.items()})


def test_battery_stops_at_floor_and_full(spark):
    load = [4000.0] * 30 + [-5000.0] * 40
    net = slots(spark, load, "net_load_w", T0 + timedelta(minutes=15))
    soc = spark.createDataFrame([("a", 50.0)], "site_id string, soc_pct double")
    out = planning.battery_forecast(net, soc, planning.BATTERY_DEFAULTS, T0.isoformat(sep=" ")).orderBy("target_ts").collect()
    level, one_way, want = 10000.0, math.sqrt(0.93), []
    for x in load:
        level += (-x / one_way if x >= 0 else -x * one_way) * 0.25
        level = min(max(level, 3000.0), 20000.0)
        want.append(level / 200)
    assert [r["soc_p50"] for r in out] == pytest.approx(want)
    assert min(want) == 15.0 and max(want) == 100.0
    assert all(r["discharge_power_w"] == 0 for r in out if r["soc_p50"] == pytest.approx(15.0))


def test_cheapest_start(spark):
    day = datetime(2026, 5, 9, 21)  # local midnight
    prices = [100.0] * 96
    for i in range(52, 67):
        prices[i] = 10.0
    net = slots(spark, [500.0] * 96, "net_import_w", day).join(slots(spark, prices, "price_eur_per_mwh", day), ["site_id", "ts"])
    out = planning.ev_start(net).orderBy("rank").collect()
    assert [r["rank"] for r in out] == [1, 2, 3] and out[0]["start_ts"] == day + timedelta(minutes=15 * 52)
    assert out[0]["cost_eur"] == pytest.approx(15 * 6500 * 0.25 / 1e6 * 10) and out[0]["rationale"] == "grid-price-first"
    first = day + timedelta(hours=6, minutes=30)
    assert all(first <= r["start_ts"] <= day + timedelta(hours=22, minutes=30) for r in out)
    with pytest.raises(ValueError):
        planning.ev_start(net, {**planning.EV_DEFAULTS, "max_hours": 2.0})


def test_start_needs_every_slot(spark):
    net = slots(spark, [500.0] * 14, "net_import_w", datetime(2026, 5, 10, 9), price_eur_per_mwh=1.0)
    assert planning.ev_start(net).count() == 0


def test_deferral_respects_limits(spark):
    prices = [100.0] * 8 + [1.0] * 24
    base = slots(spark, prices, "price_eur_per_mwh", net_import_w=0.0, temperature_c=20.0)
    for level, delay in (("low", 120), ("medium", 90), ("high", 0)):
        first = planning.deferral(base.withColumn("comfort_level", F.lit(level))).orderBy("ts").first()
        assert first["delay_min"] == delay and (first["saving_eur"] > 0) == (delay > 0)
    cold = planning.deferral(base.withColumn("comfort_level", F.lit("low")).withColumn("temperature_c", F.lit(-20.0))).orderBy("ts").first()
    assert cold["limit_hours"] == 1.0 and cold["delay_min"] <= 60
    unknown = planning.deferral(base.withColumn("comfort_level", F.lit("low")).withColumn("temperature_c", F.lit(None).cast("double"))).orderBy("ts").first()
    assert unknown["delay_min"] == 0
    risky_at = ts_lit(T0 + timedelta(minutes=30))
    blocked = base.withColumn("comfort_level", F.when(F.col("ts") == risky_at, "high").otherwise("low"))
    assert planning.deferral(blocked).orderBy("ts").first()["delay_min"] <= 30


def test_comfort(spark):
    data = [("a", T0 + timedelta(hours=10), 5.0, 10.0, 1.0), ("b", T0 + timedelta(hours=10), 5.0, 40.0, 1.0), ("c", T0 + timedelta(hours=10), 5.0, 40.0, 2.0),
            ("d", T0 + timedelta(hours=10), None, 0.0, 1.0)]
    frame = spark.createDataFrame(data, "site_id string, ts timestamp_ntz, temperature_c double, hot_water_prob_pct double, factor double")
    got = {r["site_id"]: (r["comfort_level"], r["max_defer_hours"]) for r in planning.comfort_class(frame).collect()}
    assert got == {"a": ("low", 3.0), "b": ("medium", 1.5), "c": ("high", 0.0), "d": ("high", 0.0)}


def test_event_probability(spark):
    data = []
    for week in range(4):
        for i in range(96):
            ts = T0 + timedelta(days=7 * week, minutes=15 * i)
            on = week < 3 and 40 <= i < 44
            data.append(("a", ts, 11000.0 if on else 0.0, "sauna" if on else "none", week * 3 + (2 if on else 1 if i < 40 else 3)))
    frame = spark.createDataFrame(data, "site_id string, ts timestamp_ntz, sauna_actual_w double, event_class string, event_id bigint").withColumns(
        {"ev_actual_w": F.lit(0.0), "other_actual_w": F.lit(0.0)})
    out = planning.event_probability(frame, (T0 + timedelta(days=28)).isoformat(sep=" "), tz="UTC").collect()
    assert len(out) == 4
    assert all((r["probability_pct"], r["expected_power_w"], r["typical_duration_min"]) == (75.0, 11000.0, 60.0) for r in out)
    grid = spark.createDataFrame([("a", T0 + timedelta(days=35, hours=10))], "site_id string, ts timestamp_ntz")
    assert planning.event_forecast(planning.event_probability(frame, (T0 + timedelta(days=28)).isoformat(sep=" "), tz="UTC"), grid, "UTC").first()["probability_pct"] == 75.0


def test_confidence_and_drivers(spark):
    frame = spark.createDataFrame([("r", 80.0, 100.0, 120.0, True, 90.0, 10, 0.9, 0.7, 0.4)],
                                  "recommendation_id string, solar_p10 double, solar_p50 double, solar_p90 double, price_available boolean, "
                                  "event_coverage_pct double, soc_age_min int, saving_solar_eur double, saving_price_eur double, saving_battery_eur double")
    row = planning.confidence(frame).first()
    assert row["confidence"] == pytest.approx(100 * (0.4 * 0.8 + 0.2 + 0.2 * 0.9 + 0.2))
    assert [(d["driver"], round(d["share_pct"])) for d in row["drivers"]] == [("solar", 45), ("price", 35), ("battery", 20)]
    assert (row["saving_eur"], row["saving_low_eur"], row["saving_high_eur"]) == (pytest.approx(2.0), pytest.approx(1.7), pytest.approx(2.3))


def test_feedback(spark):
    payload = '{"predicted_saving_eur": 2.0, "baseline_cost_eur": 5.0, "window_start": "%s"}'
    recs = spark.createDataFrame([(T0, "1", "ev", payload % "10:00", True), (T0, "2", "ev", payload % "11:00", True), (T0, "3", "ev", payload % "11:00", False),
                                  (T0, "4", "ev", payload % "11:00", None)],
                                 "timestamp timestamp_ntz, recommendation_id string, type string, payload_json string, accepted boolean")
    outcomes = spark.createDataFrame([("1", 3.5), ("2", 3.0)], "recommendation_id string, actual_cost_eur double")
    complaints = spark.createDataFrame([("discomfort", "1"), ("discomfort", "1"), ("discomfort", None), ("other", "2")], "feedback_type string, recommendation_id string")
    row = planning.feedback_metrics(recs, outcomes, complaints).first()
    assert (row["n"], row["n_accepted"], row["n_discomfort"], row["distinct_windows"]) == (4, 2, 1, 2)
    assert (row["acceptance_rate"], row["realised_share"], row["discomfort_rate"]) == (0.5, 3.5 / 4.0, 0.5)
    day = planning.savings_summary(recs, outcomes).first()
    assert (day["proposed"], day["accepted"], day["rejected"], day["unanswered"], day["realised_saving_eur"]) == (4, 2, 1, 1, 3.5)


def test_retrain_gate(spark):
    old = spark.createDataFrame([("ev", 0.5), ("sauna", 0.9), ("gone", 0.1)], "event_type string, f1 double")
    new = spark.createDataFrame([("ev", 0.5), ("sauna", 0.8), ("first", 0.2)], "event_type string, f1 double")
    got = {r["event_type"]: r["publish"] for r in planning.retrain_gate(old, new).collect()}
    assert got == {"ev": True, "sauna": False, "gone": False, "first": True}


def test_calendar(spark):
    frame = spark.createDataFrame([(datetime(2026, 3, 27, 23, 0),)], "ts timestamp_ntz")
    row = calendar_features(frame, "Europe/Helsinki").first()
    assert (row["hour_of_day"], row["day_of_week"], row["is_weekend"], row["is_holiday"]) == (1, 7, True, False)
