"""Worked examples, one small frame each."""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthwatt.functions import quantities as q, timeparts as t
from hearthwatt.functions.solar import cloud_factor, cos_incidence, panel_gain, sun_position
from hearthwatt.operators import averaging, consumption, control, fusion, grid, keyed, planning, pv, quality
from hearthwatt.schemas import DISPLAY_COLUMNS, FUSION_COLUMNS, PV_PRODUCTION


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def values(frame, *cols, sort="ts"):
    return [tuple(row) for row in frame.orderBy(sort).select(*cols).collect()]


def test_forward_fill_takes_the_slot_before(rows):
    prices = rows("zone string, ts timestamp, price double", ("FI", "2026-03-01 14:30:00", 130.0), ("FI", "2026-03-01 15:00:00", 130.01))
    out = grid.forward_fill(prices, "price")
    assert values(out, "price", "is_filled", "source_ts") == [
        (130.0, False, at("2026-03-01 14:30")), (130.0, True, at("2026-03-01 14:30")), (130.01, False, at("2026-03-01 15:00"))]


def test_forward_fill_leaves_a_leading_gap(rows, spark):
    prices = rows("zone string, ts timestamp, price double", ("FI", "2026-03-01 14:30:00", 130.0))
    slots = grid.time_grid(spark.createDataFrame([("FI",)], "zone string"), t.ts_lit("2026-03-01 14:15:00"),
                           t.ts_lit("2026-03-01 15:00:00"), by=["zone"])
    assert values(grid.forward_fill(prices, "price", grid=slots), "price", "is_filled") == [(None, False), (130.0, False), (130.0, True)]


def test_forward_fill_crosses_empty_days(rows):
    prices = rows("zone string, ts timestamp, price double", ("FI", "2026-03-01 14:30:00", 1.0), ("FI", "2026-03-05 00:00:00", 2.0))
    out = values(grid.forward_fill(prices, "price"), "price", "source_ts")
    assert len(out) == 3 * 96 + 38 + 1 and set(out[:-1]) == {(1.0, at("2026-03-01 14:30"))} and out[-1][0] == 2.0


@pytest.mark.parametrize("f2, circular, want", [
    (14.0, False, [10.0, 11.0, 12.0, 13.0]), (None, False, [10.0, None, None, None])])
def test_interpolation(rows, f2, circular, want):
    data = [("a", "2026-03-01 10:00:00", 10.0)] + ([("a", "2026-03-01 11:00:00", f2)] if f2 is not None else [])
    out = fusion.interp_hourly(rows("site_id string, ts timestamp, x double", *data), ["x"])
    assert [v for (v,) in values(out, "x")][:4] == want


@pytest.mark.parametrize("circular, want", [(False, 180.0), (True, 0.0)])
def test_direction_interpolation(rows, circular, want):
    hourly = rows("site_id string, ts timestamp, d double", ("a", "2026-03-01 23:00:00", 350.0), ("a", "2026-03-02 00:00:00", 10.0))
    out = fusion.interp_hourly(hourly, ["d"], circular=["d"] if circular else [])
    assert values(out.filter(F.col("ts") == t.ts_lit("2026-03-01 23:30:00")), "d") == [(want,)]


def test_interpolation_needs_the_very_next_hour(rows):
    hourly = rows("site_id string, ts timestamp, x double", ("a", "2026-03-01 10:00:00", 10.0), ("a", "2026-03-01 12:00:00", 20.0))
    assert [v for (v,) in values(fusion.interp_hourly(hourly, ["x"]), "x")] == [10.0, None, None, None, 20.0, None, None, None]


def test_wind_vector_mean(rows):
    wind = rows("site_id string, ts timestamp, wind_speed_ms double, wind_direction_deg double",
                ("a", "2026-03-01 10:00:00", 5.0, 350.0), ("a", "2026-03-01 10:00:00", 5.0, 10.0), ("a", "2026-03-01 10:00:00", 5.0, None))
    [(speed, direction)] = values(averaging.wind_vector_avg(wind), "wind_speed_ms", "wind_direction_deg")
    assert speed == pytest.approx(4.924, abs=1e-3) and min(direction, 360 - direction) == pytest.approx(0, abs=1e-6)


def test_opposite_winds_have_no_direction(rows):
    wind = rows("site_id string, ts timestamp, wind_speed_ms double, wind_direction_deg double",
                ("a", "2026-03-01 10:00:00", 5.0, 0.0), ("a", "2026-03-01 10:00:00", 5.0, 180.0))
    [(speed, direction)] = values(averaging.wind_vector_avg(wind), "wind_speed_ms", "wind_direction_deg")
    assert speed == pytest.approx(0, abs=1e-9) and direction is None


def telemetry(rows, *data):
    frame = rows("site_id string, ts timestamp, temperature_c double, json string", *data)
    return frame.withColumn("registers", q.parse_registers("json"))


def test_register_means(rows):
    raw = telemetry(rows, ("a", "2026-03-01 10:00:00", 1.0, '{"30517": 1000}'),
                    ("a", "2026-03-01 10:14:59", 2.0, '{"30517": 1468, "30775": 456, "name": "x"}'))
    [(ts, used, temp, registers)] = values(averaging.avg_15min(raw, ["temperature_c", "registers"]), "ts", "rows_used", "temperature_c", "registers")
    assert (ts, used, temp, registers) == (at("2026-03-01 10:15"), 2, 1.5, {"30517": 1234.0, "30775": 456.0})


def test_newest_n_counts_rows(rows):
    raw = telemetry(rows, *[("a", f"2026-03-01 10:{m:02d}:00", float(m), "{}") for m in range(40)])
    [few] = averaging.avg_newest_n(raw, 60, ["temperature_c"]).collect()
    [quarter] = averaging.avg_newest_n(raw, 15, ["temperature_c"]).collect()
    assert (few["n"], few["rows_used"]) == (60, 40)
    # 15 rows are a quarter hour; a larger n gives an older, different mean.
    assert quarter["rows_used"] == 15 and quarter["temperature_c"] == 32.0 and few["temperature_c"] == 19.5


def test_columns_outside_the_allow_list_are_rejected(rows):
    with pytest.raises(ValueError, match="merged_at"):
        averaging.avg_newest_n(telemetry(rows, ("a", "2026-03-01 10:00:00", 1.0, "{}")), 15, ["temperature_c", "merged_at"])


def test_registers(rows):
    frame = rows("j string", ('{"30517": 1, "name": "x", "30775": "12.7", "31249": "junk"}',), ("not json",), (None,))
    out = frame.select(q.parse_registers("j").alias("m")).select(
        "m", q.register("m", "30775").alias("pv"), q.register("m", "30845").alias("soc"), q.register("m", "31249").alias("pcc"),
        q.bad_registers("m").alias("bad")).collect()
    assert out[0]["m"] == {"30517": 1.0, "30775": 12.7, "31249": None} and tuple(out[0][1:]) == (12, 0, 0, ["31249"])
    assert [tuple(r[1:4]) for r in out[1:]] == [(0, 0, 0), (0, 0, 0)]


def test_accumulated_energy(rows):
    schema = "site_id string, ts timestamp, radiation_accum_j_m2 double, shortwave_radiation_w_m2 double"
    data = rows(schema, ("a", "2026-03-01 10:00:00", 3_600_000.0, None), ("a", "2026-03-01 11:00:00", 5_400_000.0, None),
                ("a", "2026-03-02 00:00:00", 720_000.0, None), ("a", "2026-03-02 01:00:00", 1.0, 77.0))
    assert [v for (v,) in values(fusion.power_from_accumulation(data), "shortwave_radiation_w_m2")] == [1000.0, 1500.0, 200.0, 77.0]
    running = fusion.power_from_accumulation(data, mode="cumulative")
    assert [v for (v,) in values(running, "shortwave_radiation_w_m2")] == [1000.0, 500.0, 200.0, 77.0]


def test_backfill_twice_is_backfill_once(rows):
    data = rows("ts timestamp, shortwave_radiation_w_m2 double", ("2026-03-01 10:00:00", 3600.0), ("2026-03-02 10:00:00", 3600.0))
    old = F.col("ts") < t.ts_lit("2026-03-02 00:00:00")
    once = fusion.backfill_units(data, old)
    assert values(once, "shortwave_radiation_w_m2", "unit_fixed") == [(1.0, True), (3600.0, False)]
    assert values(fusion.backfill_units(once, old), "shortwave_radiation_w_m2") == [(1.0,), (3600.0,)]


@pytest.mark.parametrize("pv_w, pcc, charge, discharge, raw, shown", [
    (1000.0, -500.0, 0.0, 200.0, 1700.0, 1700.0), (0.0, 100.0, 0.0, 0.0, -100.0, 0.0), (1000.0, None, 0.0, 0.0, None, None)])
def test_home_consumption(rows, pv_w, pcc, charge, discharge, raw, shown):
    station = rows("site_id string, ts timestamp, pv_feed_in_w double, active_power_pcc_w double, bat_charge_w double, bat_discharge_w double",
                   ("a", "2026-03-01 10:00:00", pv_w, pcc, charge, discharge))
    assert values(consumption.home_consumption(station), "home_consumption_raw_w", "home_consumption_actual_w") == [(raw, shown)]


def test_solar_factors(spark):
    row = spark.range(1).select(
        cloud_factor(F.lit(100.0), 0.70, 0.8).alias("full"), cloud_factor(F.lit(0.0), 0.70, 0.8).alias("clear"),
        cloud_factor(F.lit(None).cast("double"), 0.70, 0.8).alias("unknown"), panel_gain(F.lit(-0.5), 0.15).alias("behind")).first()
    assert row["full"] == pytest.approx(0.70) and row["clear"] == pytest.approx(1.0)
    assert row["unknown"] is None and row["behind"] == pytest.approx(0.15)


def test_sun_at_the_site(spark):
    p = PV_PRODUCTION
    day = spark.range(24 * 4).select((F.timestamp_add("MINUTE", (F.col("id") * 15), t.ts_lit("2026-06-21 00:00:00"))).alias("ts"))
    sun = sun_position("ts", p["lat"], p["lon"])
    east = cos_incidence(sun["declination"], sun["hour_angle"], p["lat"], 11.0, 90.0)
    west = cos_incidence(sun["declination"], sun["hour_angle"], p["lat"], 11.0, 270.0)
    out = day.select("ts", sun["elevation_deg"].alias("e"), east.alias("east"), west.alias("west")).collect()
    assert max(r["e"] for r in out) == pytest.approx(90 - p["lat"] + 23.45, abs=0.1)
    morning = next(r for r in out if r["ts"] == at("2026-06-21 06:00"))
    assert morning["east"] > morning["west"]


def pv_rows(rows, rad, cloud=0.0):
    return rows("site_id string, ts timestamp, fc_shortwave_radiation_w_m2 double, fc_cloud_cover_pct double, ratio double, "
                "effective_rad double, elevation_deg double", ("a", "2026-06-21 10:00:00", rad, cloud, 35.0, rad, 40.0))


@pytest.mark.parametrize("rad, want", [(4.0, 0.0), (100.0, 3500.0), (2000.0, 41900.0), (None, None)])
def test_solar_forecast_rules(rows, rad, want):
    [(p50, p10, p90)] = values(pv.predict_pv(pv_rows(rows, rad), PV_PRODUCTION), "yhat_p50", "yhat_p10", "yhat_p90")
    assert p50 == want
    assert (p10 is None) == (want is None) and (want is None or p10 <= p50 <= p90 <= 41900.0)


def test_bands_are_wider_under_cloud(rows):
    widths = []
    for cloud in (0.0, 100.0):
        [(p10, p90)] = values(pv.predict_pv(pv_rows(rows, 100.0, cloud), PV_PRODUCTION), "yhat_p10", "yhat_p90")
        widths.append(p90 - p10)
    assert widths[1] > widths[0]


def test_deferral_line(spark):
    temps = spark.createDataFrame([(-20.0,), (0.0,), (20.0,), (30.0,), (-30.0,), (None,)], "t double")
    assert [r[0] for r in temps.select(q.max_deferral_hours("t")).collect()] == [1.0, 3.0, 5.0, 5.0, 1.0, None]


def test_commands(spark):
    texts = ["ALLOW", "PROHIBIT", "PROHIBIT_30", "PROHIBIT_0", "PROHIBIT_721", "PROHIBIT_99999999999", "prohibit", None]
    frame = spark.createDataFrame([(x,) for x in texts], "c string")
    out = frame.select(q.command_mode("c").alias("m"), q.command_minutes("c").alias("n")).collect()
    assert [tuple(r) for r in out] == [("ALLOW", None), ("PROHIBIT", None), ("PROHIBIT", 30)] + [(None, None)] * 5


def test_timed_prohibition_ends_by_itself(rows, spark):
    commands = rows("site_id string, ts timestamp, command string", ("a", "2026-03-01 10:00:00", "PROHIBIT_30"))
    slots = grid.time_grid(spark.createDataFrame([("a",)], "site_id string"), t.ts_lit("2026-03-01 09:45:00"), t.ts_lit("2026-03-01 11:00:00"))
    assert [m for (m,) in values(control.command_state(commands, slots), "mode")] == ["ALLOW", "PROHIBIT", "PROHIBIT", "ALLOW", "ALLOW"]
    [interval] = control.command_intervals(commands).collect()
    assert (interval["start_ts"], interval["end_ts"]) == (at("2026-03-01 10:00"), at("2026-03-01 10:30"))


def test_a_new_command_ends_the_old_one(rows):
    commands = rows("site_id string, ts timestamp, command string", ("a", "2026-03-01 10:00:00", "PROHIBIT_60"), ("a", "2026-03-01 10:20:00", "ALLOW"))
    out = values(control.command_intervals(commands), "end_ts", "mode", sort="start_ts")
    assert out == [(at("2026-03-01 10:20"), "PROHIBIT"), (None, "ALLOW")]


def test_decision_fails_safe(rows):
    frame = rows("site_id string, ts timestamp, price_eur_per_mwh double, fc_temperature_c double",
                 ("a", "2026-03-01 10:00:00", 200.0, 5.0), ("a", "2026-03-01 10:15:00", 200.0, -20.0), ("a", "2026-03-01 10:30:00", None, 5.0),
                 ("a", "2026-03-01 10:45:00", 200.0, None))
    out = control.heat_pump_decision(frame, 100.0, 0.0)
    assert [d for (d,) in values(out, "decision")] == ["PROHIBIT", "ALLOW", "ALLOW", "ALLOW"]
    assert values(control.decisions_as_commands(out), "ts", "command") == [
        (at("2026-03-01 10:00"), "PROHIBIT"), (at("2026-03-01 10:15"), "ALLOW")]


def test_file_stamps(spark):
    names = ["weather_fusion_20260218_204423", "weather_20260329_033000.db", "weather_2026-02-18.db", "latest", "x_20261399_000000"]
    out = spark.createDataFrame([(n,) for n in names], "n string").select(t.parse_file_stamp("n")).collect()
    # 03:30 does not exist on that day in the session zone; the stamp is UTC.
    assert [r[0] for r in out] == [at("2026-02-18 20:44:23"), at("2026-03-29 03:30"), at("2026-02-18"), None, None]


def test_gap_report(rows, spark):
    slots = grid.time_grid(spark.createDataFrame([("a",)], "site_id string"), t.ts_lit("2026-02-13 23:00:00"), t.ts_lit("2026-03-08 22:00:00"))
    assert slots.count() == 2204
    kept = slots.filter(~F.col("ts").between(t.ts_lit("2026-02-20 00:00:00"), t.ts_lit("2026-02-20 23:45:00")))
    assert kept.count() == 2108
    [gap] = grid.find_gaps(kept).collect()
    assert (gap["from_ts"], gap["to_ts"], gap["n_missing"]) == (at("2026-02-19 23:45"), at("2026-02-21 00:00"), 96)
    assert grid.missing_slots(kept, slots).count() == 96


@pytest.mark.parametrize("day, n", [("2026-03-29", 92), ("2026-10-25", 100), ("2026-05-10", 96)])
def test_local_days(spark, day, n):
    slots = grid.local_day_grid(spark.createDataFrame([("a",)], "site_id string"), day, "Europe/Helsinki")
    assert slots.distinct().count() == n
    length = spark.range(1).select(consumption.day_slots(F.lit(day).cast("date"), "Europe/Helsinki")).first()[0]
    assert length == n


def test_alignment(rows):
    frame = rows("ts timestamp", ("2026-03-01 10:15:00",), ("2026-03-01 10:15:00.000001",), ("2026-03-01 10:15:01",), ("2026-03-01 10:20:00",), (None,))
    good, bad = grid.split_aligned(frame)
    assert (good.count(), bad.count()) == (1, 4)


def test_between_dates_is_inclusive_and_open(rows):
    frame = rows("ts timestamp", ("2026-03-01 00:00:00",), ("2026-03-02 23:59:59",), ("2026-03-03 00:00:00",))
    assert frame.filter(t.between_dates("ts", "2026-03-01", "2026-03-02")).count() == 2
    assert frame.filter(t.between_dates("ts", None, "2026-03-02")).count() == 2
    assert frame.filter(t.between_dates("ts", "2026-03-02", None)).count() == 2
    assert frame.filter(t.between_dates("ts", None, None)).count() == 3


def test_display_and_price(spark):
    row = spark.range(1).select(
        q.display_number(F.lit(12.25), 1), q.display_number(F.lit(None).cast("double"), 1), q.display_number(F.lit(271.5), 0),
        q.display_number(F.lit(-0.04), 1), q.cents_per_kwh(F.lit(100.0), 0.5)).first()
    assert tuple(row)[:4] == ("12.3", "-", "272", "0.0") and row[4] == pytest.approx(10.5 * 1.255)


def test_wide_series_has_the_agreed_columns(rows, spark):
    prices = rows("zone string, ts timestamp, price_eur_per_mwh double, updated_at timestamp", ("Z", "2026-03-01 10:30:00", 50.0, "2026-03-01 09:00:00"),
                  ("Z", "2026-03-01 10:45:00", 51.0, "2026-03-01 09:00:00"))
    hourly = rows("site_id string, ts timestamp, temperature_c double, wind_speed_ms double, wind_direction_deg double, cloud_cover_pct double, "
                  "shortwave_radiation_w_m2 double", ("a", "2026-03-01 10:00:00", 10.0, 1.0, 2.0, 3.0, 4.0), ("a", "2026-03-01 11:00:00", 14.0, 1.0, 2.0, 3.0, 4.0))
    station = rows("site_id string, ts timestamp, temperature_c double, dew_point_c double, relative_humidity double, pressure_hpa double, "
                   "wind_speed_ms double, wind_direction_deg double, precip_mmph double, pv_feed_in_w double, active_power_pcc_w double, battery_soc_pct double",
                   ("a", "2026-03-01 10:45:00", *[float(i) for i in range(10)]))
    sites = spark.createDataFrame([("a", "Z"), ("b", "Z")], "site_id string, zone string")
    out = fusion.weather_fusion(prices, hourly, station, sites)
    assert out.columns == ["site_id", *FUSION_COLUMNS] and len(FUSION_COLUMNS) == 22
    got = values(out.filter("site_id = 'a'"), "fc_temperature_c", "station_temperature_c", "station_battery_soc_pct", "station_load_power_w")
    assert got == [(12.0, None, None, None), (13.0, 0.0, 9.0, None)]
    assert out.filter("site_id = 'b' AND fc_temperature_c IS NULL").count() == 2
    slim = fusion.weather_fusion(prices, hourly, station, sites, keep_unsourced=False)
    assert len(slim.columns) == 19
    shown = fusion.display_projection(out, "Europe/Helsinki", 0.0)
    assert len(shown.columns) == 2 + 13 and set(DISPLAY_COLUMNS) < set(shown.columns)
    assert values(shown.filter("site_id = 'a'"), "local_time", "fc_temperature_c", "station_temperature_c")[0] == ("12:30", "12.0", "-")


@pytest.mark.parametrize("age, want", [(20, "ok"), (21, "warn"), (60, "warn"), (61, "error"), (None, "error")])
def test_station_grades(spark, age, want):
    assert spark.range(1).select(quality.graded(F.lit(age).cast("double"), 20, 60)).first()[0] == want


@pytest.mark.parametrize("age, n, want", [(25, 24, "ok"), (25, 22, "warn"), (61, 24, "error"), (10, 19, "error"), (31, 24, "warn")])
def test_baseline_grades(rows, spark, age, n, want):
    now = datetime(2026, 3, 1, 12, 0)
    issued = f"2026-03-01 {(now.hour * 60 - age) // 60:02d}:{(now.hour * 60 - age) % 60:02d}:00"
    runs = rows("run_id string, site_id string, model_name string, issued_at timestamp", ("r", "a", "baseline_consumption", issued),
                ("old", "a", "baseline_consumption", "2026-03-01 01:00:00"))
    data = [("r", "baseline_w", f"2026-03-01 {12 + i // 4:02d}:{i % 4 * 15:02d}:00") for i in range(1, n + 1)]
    report = quality.health_report({
        "sites": spark.createDataFrame([("a", "Z")], "site_id string, zone string"), "runs": runs,
        "values": rows("run_id string, target string, target_ts timestamp", *data)}, now)
    assert [r["status"] for r in report.collect()] == [want]


def test_stale_snapshot_is_refused():
    quality.require_fresh("weather_fusion_20260218_204423", datetime(2026, 2, 18, 21, 14, 23))
    with pytest.raises(ValueError, match="at most 30"):
        quality.require_fresh("weather_fusion_20260218_204423", datetime(2026, 2, 18, 21, 14, 24))


def test_daily_kpi(rows):
    load = rows("site_id string, ts timestamp, w double", ("a", "2026-05-09 21:00:00", 1000.0), ("a", "2026-05-09 21:15:00", 3000.0), ("a", "2026-05-10 21:00:00", 9.0))
    [first, _] = consumption.daily_kpi(load, "w", "Europe/Helsinki").orderBy("local_date").collect()
    assert tuple(first)[1:] == (date(2026, 5, 10), 2, 94, 2000.0, 3000.0, 1.0)


def test_upsert_is_idempotent(rows):
    schema = "zone string, ts timestamp, price double, created_at timestamp, updated_at timestamp"
    stored = rows(schema, ("Z", "2026-03-01 10:00:00", 1.0, "2026-02-01 00:00:00", "2026-02-01 00:00:00"), ("Z", "2026-03-01 10:15:00", 2.0, "2026-02-01 00:00:00", "2026-02-01 00:00:00"))
    new = rows("zone string, ts timestamp, price double", ("Z", "2026-03-01 10:15:00", 5.0), ("Z", "2026-03-01 10:30:00", 6.0))
    now = t.ts_lit("2026-03-01 00:00:00")
    once = keyed.upsert(stored, new, ["zone", "ts"], now)
    got = values(once, "price", "created_at", "updated_at")
    assert got == [(1.0, at("2026-02-01"), at("2026-02-01")), (5.0, at("2026-02-01"), at("2026-03-01")), (6.0, at("2026-03-01"), at("2026-03-01"))]
    assert values(keyed.upsert(once, new, ["zone", "ts"], now), "price", "created_at", "updated_at") == got
    ignored = keyed.insert_ignore(stored.select("zone", "ts", "price"), new, ["zone", "ts"], ["price"])
    assert [p for (p,) in values(ignored, "price")] == [1.0, 2.0, 6.0]


def test_empty_inputs(rows):
    empty = rows("site_id string, ts timestamp, w double", ("a", "2026-03-01 10:00:00", 1.0)).filter("false")
    assert grid.find_gaps(empty).count() == 0
    assert grid.forward_fill(empty, "w", by=["site_id"]).count() == 0
    assert consumption.reference_load(empty, "w").count() == 0
    assert keyed.newest_n(empty, ["site_id"], ["ts"], 3).count() == 0


def test_unknown_import_gives_no_advice(rows):
    net = rows("site_id string, ts timestamp, net_import_w double, price_eur_per_mwh double, temperature_c double, comfort_level string",
               *[("a", f"2026-03-01 {8 + i // 4:02d}:{i % 4 * 15:02d}:00", None, 50.0 - i, 5.0, "low") for i in range(40)])
    assert planning.ev_start(net).count() == 0
    assert {(r["delay_min"], r["saving_eur"]) for r in planning.deferral(net).collect()} == {(0, 0.0)}


def test_unknown_load_makes_the_rest_unknown(rows, spark):
    load = rows("site_id string, ts timestamp, net_load_w double",
                *[("a", f"2026-03-01 {i // 4:02d}:{i % 4 * 15:02d}:00", None if i == 4 else 1000.0) for i in range(1, 9)])
    soc = spark.createDataFrame([("a", 50.0)], "site_id string, soc_pct double")
    got = planning.battery_forecast(load, soc, planning.BATTERY_DEFAULTS, "2026-03-01 00:00:00").orderBy("target_ts").collect()
    assert all(r["soc_p50"] < 50.0 for r in got[:3]) and all(r["soc_p50"] is None and r["discharge_power_w"] is None for r in got[3:])


def test_draws_of_events_are_independent():
    steps, i = planning.event_steps(4), np.arange(1000)
    hits = [(i * step) % 1.0 < 0.2 for step in steps]
    for a in range(4):
        assert abs(hits[a].mean() - 0.2) < 0.01
        for b in range(a):
            assert abs((hits[a] & hits[b]).mean() - 0.04) < 0.015
