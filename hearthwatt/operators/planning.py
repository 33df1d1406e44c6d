"""Planning on top of the forecasts: battery, events, comfort, import risk, start times, deferral, feedback.

A site's horizon is at most a few hundred slots, so arrays here have a length fixed by parameters, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import count, islice
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.quantities import max_deferral_hours
from ..functions.timeparts import epoch_seconds, local_date, to_local, ts_lit
from .chunked import CHUNK, home_rows, with_halo
from .consumption import event_summary
from .pv import horizon_filter

SLOT_H = 0.25
GOLDEN = (math.sqrt(5) - 1) / 2
BATTERY_DEFAULTS = {
    "capacity_wh": 20_000.0, "floor_pct": 15.0, "round_trip": 0.93, "max_charge_w": 5000.0, "max_discharge_w": 5000.0,
    "horizon": 96,
}
COMFORT_DEFAULTS = {
    "tz": "Europe/Helsinki", "low_below": 0.3, "medium_below": 0.6, "cold_below_c": -10.0, "cold_weight": 0.2,
    "peak_hours": (6, 7, 8, 18, 19, 20, 21), "peak_weight": 0.2, "report_step": 0.1,
}
COMFORT_HOURS = {"low": 3.0, "medium": 1.5, "high": 0.0}
EV_DEFAULTS = {
    "tz": "Europe/Helsinki", "first": "06:30", "last": "22:30", "energy_kwh": 24.0, "power_w": 6500.0, "max_hours": 8.0,
}
DEFERRAL_DEFAULTS = {"pump_w": 3000.0, "run_slots": 4, "max_hours": 5}
CONFIDENCE_DEFAULTS = {
    "weights": {"solar": 0.4, "price": 0.2, "events": 0.2, "battery": 0.2}, "soc_max_age_min": 30, "band": 0.15,
}


# ---- battery -----------------------------------------------------------------------------------------------------

def battery_forecast(net: DataFrame, soc: DataFrame, p: Mapping[str, Any], issue_ts: str) -> DataFrame:
    """State of charge after each slot of the horizon, and the power that may still be drawn.

    ``net`` has ``net_load_w`` (use minus sun), ``soc`` the charge in percent at the issue time. The level stops at
    the reserve floor and when full, which makes each slot depend on the one before: a fold over one day's array.
    From the first slot with an unknown load on, the level is unknown.
    """
    one_way = math.sqrt(p["round_trip"])
    load = F.col("net_load_w")
    drawn = F.least(load, F.lit(p["max_discharge_w"])) / F.lit(one_way)
    stored = F.least(-load, F.lit(p["max_charge_w"])) * F.lit(one_way)
    # least() skips NULLs: an unknown load must not look like the largest one.
    delta_wh = F.when(load.isNotNull(), F.when(load >= 0, -drawn).otherwise(stored)) * SLOT_H
    floor_wh = p["capacity_wh"] * p["floor_pct"] / 100.0
    steps = (net.filter(horizon_filter("ts", ts_lit(issue_ts), p["horizon"])).groupBy("site_id")
             .agg(F.sort_array(F.collect_list(F.struct("ts", delta_wh.alias("d")))).alias("_steps")))
    start = F.col("soc_pct") * F.lit(p["capacity_wh"] / 100.0)
    levels = F.aggregate(
        "_steps", F.array(start.cast("double")),
        lambda acc, s: F.concat(acc, F.array(_saturate(F.element_at(acc, -1), s["d"], floor_wh, p["capacity_wh"]))))
    out = steps.join(soc.select("site_id", "soc_pct"), "site_id").withColumn("_levels", levels)
    slots = out.select("site_id", F.posexplode("_steps").alias("_i", "_s"), "_levels")
    wh = F.element_at("_levels", F.col("_i") + 2)
    spare = F.when(wh.isNotNull(), F.greatest(F.lit(0.0), wh - F.lit(floor_wh)) * F.lit(one_way / SLOT_H))
    return slots.select(
        "site_id", F.col("_s.ts").alias("target_ts"), (wh * F.lit(100.0 / p["capacity_wh"])).alias("soc_p50"),
        F.when(spare.isNotNull(), F.least(F.lit(p["max_discharge_w"]), spare)).alias("discharge_power_w"),
        F.lit(float(p["round_trip"])).alias("efficiency_ratio"))


def _saturate(level: Column, delta: Column, floor: float, full: float) -> Column:
    """Level after a slot. A battery found below the floor may charge but not be drawn further."""
    lowest = F.least(F.lit(floor), level)
    return F.when(level.isNotNull() & delta.isNotNull(), F.least(F.greatest(level + delta, lowest), F.lit(full)))


# ---- events ------------------------------------------------------------------------------------------------------

def _weekday_slot(ts: str, tz: str) -> dict[str, Column]:
    local = to_local(ts, tz)
    return {"weekday": F.dayofweek(local), "slot": (F.hour(local) * 4 + F.floor(F.minute(local) / 15)).cast("int")}


def event_probability(components: DataFrame, now: str, weeks: int = 8, tz: str = "Europe/Helsinki") -> DataFrame:
    """How often each event class is on at each weekday and quarter hour, its mean power and usual length."""
    at = ts_lit(now)
    recent = components.filter((F.col("ts") >= F.timestamp_add("WEEK", F.lit(-weeks), at)) & (F.col("ts") < at))
    power = F.col("ev_actual_w") + F.col("sauna_actual_w") + F.col("other_actual_w")
    cells = recent.withColumns(_weekday_slot("ts", tz)).groupBy("site_id", "weekday", "slot", "event_class").agg(
        F.count(F.lit(1)).alias("_n"), F.avg(power).alias("expected_power_w"))
    observed = F.sum("_n").over(Window.partitionBy("site_id", "weekday", "slot"))
    cells = cells.withColumn("probability_pct", F.lit(100.0) * F.col("_n") / observed).filter("event_class <> 'none'")
    minutes = (epoch_seconds("end_ts") - epoch_seconds("start_ts")) / F.lit(60.0)
    usual = event_summary(recent).groupBy("site_id", "event_class").agg(
        F.percentile(minutes, 0.5).alias("typical_duration_min"))
    return cells.join(usual, ["site_id", "event_class"]).select(
        "site_id", F.col("event_class").alias("event_type"), "weekday", "slot", "probability_pct", "expected_power_w",
        "typical_duration_min")


def event_forecast(probability: DataFrame, grid: DataFrame, tz: str = "Europe/Helsinki") -> DataFrame:
    """The probabilities laid onto coming slots."""
    slots = grid.select("site_id", F.col("ts").alias("target_ts")).withColumns(_weekday_slot("target_ts", tz))
    return slots.join(probability, ["site_id", "weekday", "slot"]).select(
        "site_id", "target_ts", "event_type", "probability_pct", "expected_power_w", "typical_duration_min")


# ---- comfort -----------------------------------------------------------------------------------------------------

def discomfort_factor(feedback: DataFrame, p: Mapping[str, Any] = COMFORT_DEFAULTS) -> DataFrame:
    """Every reported shortage of hot water makes a site's later classes more careful."""
    reports = feedback.filter("feedback_type = 'discomfort'").groupBy("site_id").agg(F.count(F.lit(1)).alias("_n"))
    return reports.select("site_id", (F.lit(1.0) + F.lit(p["report_step"]) * F.col("_n")).alias("factor"))


def comfort_class(df: DataFrame, p: Mapping[str, Any] = COMFORT_DEFAULTS) -> DataFrame:
    """Risk class of deferring hot water at each slot, from ``temperature_c``, ``hot_water_prob_pct`` and ``factor``.

    Unknown inputs count as high risk.
    """
    peak = F.hour(to_local("ts", p["tz"])).isin(*p["peak_hours"])
    cold = F.col("temperature_c") < p["cold_below_c"]
    risk = F.col("factor") * (F.col("hot_water_prob_pct") / 100.0 + F.when(peak, p["peak_weight"]).otherwise(0.0)
                              + F.when(cold, p["cold_weight"]).otherwise(0.0))
    known = risk.isNotNull() & F.col("temperature_c").isNotNull()
    level = (F.when(known & (risk < p["low_below"]), F.lit("low")).when(known & (risk < p["medium_below"]), F.lit("medium"))
             .otherwise(F.lit("high")))
    return df.withColumn("comfort_level", level).withColumn("max_defer_hours", comfort_hours(F.col("comfort_level")))


def comfort_hours(level: Column) -> Column:
    return (F.when(level == "low", COMFORT_HOURS["low"]).when(level == "medium", COMFORT_HOURS["medium"])
            .otherwise(COMFORT_HOURS["high"]))


# ---- import risk -------------------------------------------------------------------------------------------------

def event_steps(kinds: int) -> list[float]:
    """One irrational step per event: fractions of the roots of primes but 5, whose root turns the normal draws.

    Multiples of different ones spread evenly over all combinations, so the draws of two events are independent.
    """
    primes = (n for n in count(2) if n != 5 and all(n % d for d in range(2, math.isqrt(n) + 1)))
    return [math.sqrt(prime) % 1.0 for prime in islice(primes, kinds)]


def _quantiles(pdf: pd.DataFrame, n: int, seed: int) -> pd.DataFrame:
    """p10, p50 and p90 over the same ``n`` draws for every row, a block of rows at a time."""
    i = np.arange(n)
    shift = (seed * GOLDEN) % 1.0
    radius, angle = np.sqrt(-2.0 * np.log((i + 0.5) / n)), 2.0 * np.pi * ((i * GOLDEN + shift) % 1.0)
    z_base, z_sun = radius * np.cos(angle), radius * np.sin(angle)
    kinds = max((len(x) for x in pdf["probs"] if x is not None), default=0)
    lots = [(i * step + shift) % 1.0 * 100.0 for step in event_steps(kinds)]
    numbers = pdf[["base", "base_sigma", "sun", "sun_sigma", "battery"]].to_numpy(float)
    out = np.empty((len(pdf), 3))
    for lo in range(0, len(pdf), 256):
        base, base_sigma, sun, sun_sigma, battery = (column[:, None] for column in numbers[lo:lo + 256].T)
        draws = base + base_sigma * z_base - np.maximum(0.0, sun + sun_sigma * z_sun) - battery
        for k in range(kinds):
            prob, power = (np.array([x[k] if x is not None and len(x) > k else 0.0 for x in pdf[c].iloc[lo:lo + 256]], float)
                           for c in ("probs", "powers"))
            draws += np.where(lots[k] < prob[:, None], power[:, None], 0.0)
        out[lo:lo + 256] = np.quantile(draws, (0.1, 0.5, 0.9), axis=1).T
    return pd.DataFrame(out, columns=["p10", "p50", "p90"])


def net_import(df: DataFrame, n: int = 1000, seed: int = 0) -> DataFrame:
    """p10, p50 and p90 of grid import per slot from ``n`` draws over the forecast bands.

    Columns: ``baseline_p10/p50/p90``, ``pv_p10/p50/p90``, ``battery_w`` and ``events``, an array of
    ``(probability_pct, power_w)``. The draws follow a fixed low-discrepancy sequence that ``seed`` shifts, so a slot
    always gives the same answer. A thousand draws per row are array arithmetic inside the task: no row is multiplied
    and nothing is shuffled. A slot with an unknown input has no quantiles.
    """

    @F.pandas_udf("p10 double, p50 double, p90 double")
    def quantiles(inputs: pd.DataFrame) -> pd.DataFrame:
        return _quantiles(inputs, n, seed)

    def sigma(name: str) -> Column:
        return (F.col(f"{name}_p90") - F.col(f"{name}_p10")) / F.lit(2 * 1.2816)

    numbers = {"base": F.col("baseline_p50"), "base_sigma": sigma("baseline"), "sun": F.col("pv_p50"), "sun_sigma": sigma("pv"),
               "battery": F.col("battery_w")}
    known = reduce(lambda x, y: x & y, [c.isNotNull() for c in numbers.values()])
    fields = [c.cast("double").alias(name) for name, c in numbers.items()]
    events = [F.transform("events", lambda e: e["probability_pct"].cast("double")).alias("probs"),
              F.transform("events", lambda e: e["power_w"].cast("double")).alias("powers")]
    drawn = df.withColumn("_q", quantiles(F.struct(*fields, *events)))
    return drawn.select("site_id", F.col("ts").alias("target_ts"), *[
        F.when(known, F.col(f"_q.{q}")).alias(f"import_{q}_w") for q in ("p10", "p50", "p90")])


# ---- price-aware start times -------------------------------------------------------------------------------------

def import_caused(power_w: float) -> Column:
    """Part of a load that is drawn from the grid; unknown where the net import is."""
    with_load = F.col("net_import_w") + F.lit(power_w)
    return F.when(with_load.isNotNull(), F.greatest(F.lit(0.0), F.least(with_load, F.lit(power_w))))


def ev_start(net: DataFrame, p: Mapping[str, Any] = EV_DEFAULTS, k: int = 3) -> DataFrame:
    """Cheapest ``k`` charging starts per site and local day.

    ``net`` has ``net_import_w`` and ``price_eur_per_mwh`` per slot. A start counts only if every slot until the
    energy is delivered is known. The cost is the import that charging causes at the price of its slot; the window
    sum reaches over the following slots, which are copied across chunk borders.
    """
    slots = math.ceil(p["energy_kwh"] * 1000.0 / (p["power_w"] * SLOT_H))
    if slots * SLOT_H > p["max_hours"]:
        raise ValueError("the energy cannot be charged in the time allowed")
    caused = import_caused(p["power_w"])
    priced = net.select("site_id", "ts", (caused * F.col("price_eur_per_mwh") * F.lit(SLOT_H / 1e6)).alias("_cost"),
                        (caused * F.lit(SLOT_H / 1e3)).alias("_grid_kwh"))
    reach = (slots - 1) * 15
    copies = with_halo(priced, "ts", 0, reach * 60)
    frame = f"OVER (PARTITION BY site_id, {CHUNK} ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL {reach} MINUTES FOLLOWING)"
    windows = home_rows(copies.withColumns({
        "cost_eur": F.expr(f"sum(_cost) {frame}"), "grid_kwh": F.expr(f"sum(_grid_kwh) {frame}"),
        "_known": F.expr(f"count(_cost) {frame}")})).filter(F.col("_known") == slots)
    clock = F.date_format(to_local("ts", p["tz"]), "HH:mm")
    starts = windows.filter((clock >= p["first"]) & (clock <= p["last"])).withColumn("local_date", local_date("ts", p["tz"]))
    rank = F.row_number().over(Window.partitionBy("site_id", "local_date").orderBy("cost_eur", "ts"))
    own_share = F.lit(1.0) - F.col("grid_kwh") / F.lit(slots * SLOT_H * p["power_w"] / 1e3)
    return starts.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "site_id", "local_date", "rank", F.col("ts").alias("start_ts"), "cost_eur", "grid_kwh",
        F.when(own_share >= 0.5, F.lit("solar-first")).otherwise(F.lit("grid-price-first")).alias("rationale"))


def deferral(df: DataFrame, p: Mapping[str, Any] = DEFERRAL_DEFAULTS) -> DataFrame:
    """Best delay of a heat pump run from every slot, as minutes, restart time and saving.

    ``df`` has ``net_import_w``, ``price_eur_per_mwh``, ``temperature_c`` and ``comfort_level``. The delay may not
    exceed the limits by temperature and by comfort class, nor pass a slot of high risk. No delay where nothing is
    saved or the outlook is incomplete.
    """
    pump, run = p["pump_w"], p["run_slots"]
    caused = import_caused(pump)
    slots = df.withColumn("_cost", caused * F.col("price_eur_per_mwh") * F.lit(SLOT_H / 1e6))
    reach = (run - 1) * 15
    copies = with_halo(slots, "ts", 0, p["max_hours"] * 3600 + reach * 60)
    part = f"PARTITION BY site_id, {CHUNK} ORDER BY ts RANGE BETWEEN CURRENT ROW AND"
    run_frame = f"OVER ({part} INTERVAL {reach} MINUTES FOLLOWING)"
    delay_frame = f"OVER ({part} INTERVAL {p['max_hours']} HOURS FOLLOWING)"
    costs = copies.withColumn("_run", F.expr(f"CASE WHEN count(_cost) {run_frame} = {run} THEN sum(_cost) {run_frame} END"))
    options = home_rows(costs.withColumns({
        "_options": F.expr(f"collect_list(CASE WHEN _run IS NOT NULL THEN struct(_run AS cost, ts AS at) END) {delay_frame}"),
        "_stop": F.expr(f"min(CASE WHEN comfort_level = 'high' THEN ts END) {delay_frame}")}))
    limit = F.least(max_deferral_hours("temperature_c"), comfort_hours(F.col("comfort_level")))
    latest = F.timestamp_add("MINUTE", F.floor(F.col("limit_hours") * 60.0).cast("bigint"), F.col("ts"))
    allowed = F.filter("_options", lambda o: (o["at"] == F.col("ts")) | (
        (o["at"] <= F.col("_latest")) & (F.col("_stop").isNull() | (o["at"] <= F.col("_stop")))))
    known_limit = F.when(F.col("temperature_c").isNotNull(), limit).otherwise(F.lit(0.0))
    best = options.withColumn("limit_hours", known_limit).withColumn("_latest", latest).withColumn(
        "_best", F.when(F.col("_run").isNotNull(), F.array_min(allowed)))
    restart = F.coalesce(F.col("_best.at"), F.col("ts"))
    return best.select(
        "site_id", "ts", "comfort_level", "limit_hours", restart.alias("restart_ts"),
        ((epoch_seconds(restart) - epoch_seconds("ts")) / 60).cast("int").alias("delay_min"),
        F.coalesce(F.col("_run") - F.col("_best.cost"), F.lit(0.0)).alias("saving_eur"))


# ---- confidence and feedback -------------------------------------------------------------------------------------

def confidence(recs: DataFrame, p: Mapping[str, Any] = CONFIDENCE_DEFAULTS) -> DataFrame:
    """Confidence 0-100, the three strongest drivers with their share, and the saving with its band.

    Columns: ``solar_p10/p50/p90``, ``price_available``, ``event_coverage_pct``, ``soc_age_min`` and
    ``saving_solar_eur``, ``saving_price_eur``, ``saving_battery_eur``.
    """
    w = p["weights"]
    width = (F.col("solar_p90") - F.col("solar_p10")) / (F.lit(2.0) * F.col("solar_p50"))
    solar = F.when(F.col("solar_p50") > 0, F.greatest(F.lit(0.0), F.lit(1.0) - width)).otherwise(F.lit(0.0))
    price = F.when(F.col("price_available"), 1.0).otherwise(0.0)
    events = F.coalesce(F.col("event_coverage_pct") / 100.0, F.lit(0.0))
    battery = F.when(F.col("soc_age_min") < p["soc_max_age_min"], 1.0).otherwise(0.5)
    score = F.lit(100.0) * (w["solar"] * solar + w["price"] * price + w["events"] * events + w["battery"] * battery)
    names = ("solar", "price", "battery")
    parts = {name: F.coalesce(F.col(f"saving_{name}_eur"), F.lit(0.0)) for name in names}
    total = parts["solar"] + parts["price"] + parts["battery"]
    weight = F.abs(parts["solar"]) + F.abs(parts["price"]) + F.abs(parts["battery"])
    shares = F.array(*[F.struct(
        F.when(weight > 0, F.lit(100.0) * F.abs(parts[name]) / weight).otherwise(F.lit(0.0)).alias("share_pct"),
        F.lit(name).alias("driver")) for name in names])
    return recs.withColumns({
        "confidence": score, "drivers": F.slice(F.sort_array(shares, asc=False), 1, 3), "saving_eur": total,
        "saving_low_eur": total * F.lit(1.0 - p["band"]), "saving_high_eur": total * F.lit(1.0 + p["band"])})


def event_scores(predicted: DataFrame, actual: DataFrame, key: Sequence[str] = ("site_id", "ts", "event_type")) -> DataFrame:
    """Precision, recall and F1 per event type. Both sides hold one row per event slot."""
    both = predicted.select(*key, F.lit(1).alias("_p")).join(actual.select(*key, F.lit(1).alias("_a")), list(key), "full")
    counts = both.groupBy("event_type").agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_a").isNotNull()).alias("tp"),
        F.count_if(F.col("_a").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": F.when(tp + fp > 0, tp / (tp + fp)), "recall": F.when(tp + fn > 0, tp / (tp + fn)),
        "f1": F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn))})


def with_payload(recs: DataFrame) -> DataFrame:
    """The fields of ``payload_json`` that the reports use, in one parse."""
    fields = F.from_json("payload_json", "predicted_saving_eur double, baseline_cost_eur double, window_start string")
    return recs.withColumn("_p", fields).withColumns({
        "_saving": F.col("_p.predicted_saving_eur"), "_baseline": F.col("_p.baseline_cost_eur"), "_window": F.col("_p.window_start")}).drop("_p")


def feedback_metrics(recs: DataFrame, outcomes: DataFrame, feedback: DataFrame) -> DataFrame:
    """Per type of recommendation: acceptance, realised over predicted saving, discomfort and variety of windows.

    The payload holds ``predicted_saving_eur``, ``baseline_cost_eur`` and ``window_start``.
    """
    parsed = with_payload(recs)
    complaints = feedback.filter("feedback_type = 'discomfort' AND recommendation_id IS NOT NULL").select(
        "recommendation_id", F.lit(1).alias("_complaint")).distinct()
    rows = (parsed.join(outcomes.select("recommendation_id", "actual_cost_eur"), "recommendation_id", "left")
            .join(complaints, "recommendation_id", "left"))
    taken = F.coalesce(F.col("accepted"), F.lit(False))
    realised = F.when(taken, F.col("_baseline") - F.col("actual_cost_eur"))
    expected = F.when(taken & F.col("actual_cost_eur").isNotNull(), F.col("_saving"))
    return rows.groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(taken).alias("n_accepted"), F.sum(expected).alias("predicted_saving_eur"),
        F.sum(realised).alias("realised_saving_eur"),
        F.count_if(taken & F.col("_complaint").isNotNull()).alias("n_discomfort"),
        F.count_distinct("_window").alias("distinct_windows"),
    ).withColumns({
        "acceptance_rate": F.col("n_accepted") / F.col("n"),
        "realised_share": F.when(F.col("predicted_saving_eur") != 0, F.col("realised_saving_eur") / F.col("predicted_saving_eur")),
        "discomfort_rate": F.when(F.col("n_accepted") > 0, F.col("n_discomfort") / F.col("n_accepted")),
    })


def retrain_gate(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per event type whether the new score is at least the old one; a type scored for the first time passes."""
    both = new.select("event_type", F.col("f1").alias("new_f1")).join(
        old.select("event_type", F.col("f1").alias("old_f1")), "event_type", "full")
    passes = F.col("old_f1").isNull() | F.coalesce(F.col("new_f1") >= F.col("old_f1"), F.lit(False))
    return both.withColumn("publish", passes)


def savings_summary(recs: DataFrame, outcomes: DataFrame, tz: str = "Europe/Helsinki") -> DataFrame:
    """Per local day: what was proposed, accepted, rejected or left, and the saving expected and realised."""
    rows = with_payload(recs).join(
        outcomes.select("recommendation_id", "actual_cost_eur"), "recommendation_id", "left")
    return rows.groupBy(local_date("timestamp", tz).alias("local_date")).agg(
        F.count(F.lit(1)).alias("proposed"), F.count_if(F.col("accepted")).alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"), F.count_if(F.col("accepted").isNull()).alias("unanswered"),
        F.sum("_saving").alias("expected_saving_eur"),
        F.sum(F.when(F.col("accepted"), F.col("_baseline") - F.col("actual_cost_eur"))).alias("realised_saving_eur"))
