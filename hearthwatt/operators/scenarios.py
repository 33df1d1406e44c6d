"""Joint scenarios of the grid import, the spread of charging costs that follows from them, and how forecasts have done.

A scenario keeps its ranks over all slots: where it has much sun in one slot it has much in the next, and an event that is on in
one is on in every slot that finds it as likely. So sums over consecutive slots have the spread they should, which independent
draws per slot would average away. The scenarios are literals; rows are neither multiplied nor shuffled for them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timeparts import local_date, to_local, ts_lit
from .chunked import CHUNK, home_rows, with_halo
from .planning import EV_DEFAULTS, GOLDEN, SLOT_H, event_steps

#: Events of one slot that scenarios tell apart.
KINDS = 6
CONFIDENCE = {"share": 0.05, "eur": 0.005}


def scenarios(n: int, seed: int = 0) -> Column:
    """``n`` scenarios as an array of ``(base, sun, lots)``: two standard normal ranks, and a percentage per event."""
    i, shift = np.arange(n), (seed * GOLDEN) % 1.0
    radius, angle = np.sqrt(-2.0 * np.log((i + 0.5) / n)), 2.0 * np.pi * ((i * GOLDEN + shift) % 1.0)
    lots = np.array([(i * step + shift) % 1.0 * 100.0 for step in event_steps(KINDS)]).T
    return F.array(*[F.struct(F.lit(float(b)).alias("base"), F.lit(float(s)).alias("sun"), F.array(*[F.lit(float(x)) for x in own]).alias("lots"))
                     for b, s, own in zip(radius * np.cos(angle), radius * np.sin(angle), lots)])


def import_scenarios(n: int = 100, seed: int = 0) -> Column:
    """Net import of a slot in each scenario, from the columns that ``net_import`` takes; null where one of them is unknown."""
    sigma = {name: (F.col(f"{name}_p90") - F.col(f"{name}_p10")) / F.lit(2 * 1.2816) for name in ("baseline", "pv")}
    inputs = [F.col("baseline_p50"), F.col("pv_p50"), F.col("battery_w"), *sigma.values()]
    known = reduce(lambda x, y: x & y, [c.isNotNull() for c in inputs])
    events = F.coalesce("events", F.array())
    counted = F.when(F.size(events) > KINDS, F.raise_error(F.lit(f"more than {KINDS} events in one slot")).cast("int")).otherwise(F.size(events))

    def drawn(s: Column) -> Column:
        on = F.transform(F.slice(events, F.lit(1), counted), lambda e, k: F.when(
            F.element_at(s["lots"], k + 1) < e["probability_pct"], e["power_w"].cast("double")).otherwise(F.lit(0.0)))
        draw = F.col("baseline_p50") + sigma["baseline"] * s["base"] - F.greatest(F.lit(0.0), F.col("pv_p50") + sigma["pv"] * s["sun"]) - F.col("battery_w")
        return draw + F.aggregate(on, F.lit(0.0), lambda total, x: total + x)

    return F.when(known, F.transform(scenarios(n, seed), drawn))


def _added(arrays: Column, n: int) -> Column:
    return F.aggregate(arrays, F.array_repeat(F.lit(0.0), n), lambda total, x: F.zip_with(total, x, lambda a, b: a + b))


def _quantile(ordered: Column, q: float, n: int) -> Column:
    """Of a sorted array, linear between its neighbours."""
    at = q * (n - 1)
    low, part = int(at), at - int(at)
    first = F.element_at(ordered, low + 1)
    return first if part == 0 else first + (F.element_at(ordered, low + 2) - first) * F.lit(part)


def ev_start_confidence(df: DataFrame, p: Mapping[str, Any] = EV_DEFAULTS, k: int = 3, n: int = 100, seed: int = 0,
                        near: Mapping[str, float] = CONFIDENCE) -> DataFrame:
    """The ``k`` charging starts of a site and local day with the lowest expected cost, with its spread and a confidence.

    ``df`` has the columns of ``net_import`` and ``price_eur_per_mwh``, one row per slot. A start counts only if every slot until the
    energy is delivered is known. ``confidence_pct`` is the share of scenarios in which the start costs at most a little more
    (``near``) than the day's cheapest start of that scenario.
    """
    slots = math.ceil(p["energy_kwh"] * 1000.0 / (p["power_w"] * SLOT_H))
    if slots * SLOT_H > p["max_hours"]:
        raise ValueError("the energy cannot be charged in the time allowed")
    power, price = F.lit(float(p["power_w"])), F.col("price_eur_per_mwh")
    cost = F.transform("_import", lambda w: F.greatest(F.lit(0.0), F.least(w + power, power)) * price * F.lit(SLOT_H / 1e6))
    priced = df.withColumn("_import", import_scenarios(n, seed)).select("site_id", "ts", F.when(price.isNotNull(), cost).alias("_costs"))
    reach = (slots - 1) * 15
    frame = f"OVER (PARTITION BY site_id, {CHUNK} ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL {reach} MINUTES FOLLOWING)"
    windows = home_rows(with_halo(priced, "ts", 0, reach * 60).withColumn("_run", F.expr(f"collect_list(_costs) {frame}")))
    clock = F.date_format(to_local("ts", p["tz"]), "HH:mm")
    starts = windows.filter((F.size("_run") == slots) & (clock >= p["first"]) & (clock <= p["last"])).select(
        "site_id", local_date("ts", p["tz"]).alias("local_date"), "ts", _added(F.col("_run"), n).alias("costs"))
    # A day has at most a start per slot, so its arrays are bounded by the parameters.
    days = starts.groupBy("site_id", "local_date").agg(F.collect_list(F.struct("ts", "costs")).alias("_starts"))
    cheapest = F.aggregate("_starts", F.element_at("_starts", 1)["costs"], lambda least, s: F.zip_with(least, s["costs"], lambda x, y: F.least(x, y)))
    mean = lambda costs: F.aggregate(costs, F.lit(0.0), lambda a, x: a + x) / F.lit(float(n))
    ranked = days.withColumn("_cheapest", cheapest).withColumn("_ranked", F.slice(F.array_sort(F.transform("_starts", lambda s: F.struct(
        F.round(mean(s["costs"]), 9).alias("expected"), s["ts"].alias("ts"), s["costs"].alias("costs")))), 1, k))
    each = ranked.select("site_id", "local_date", "_cheapest", F.posexplode("_ranked").alias("_i", "s")).withColumn("_sorted", F.array_sort("s.costs"))
    limit = lambda c: c * F.lit(1.0 + near["share"]) + F.lit(near["eur"])
    good = F.size(F.filter(F.zip_with("s.costs", "_cheapest", lambda own, c: own <= limit(c)), lambda x: x))
    return each.select("site_id", "local_date", (F.col("_i") + 1).cast("int").alias("rank"), F.col("s.ts").alias("start_ts"),
                       F.col("s.expected").alias("expected_eur"), *[_quantile(F.col("_sorted"), q, n).alias(f"cost_p{round(100 * q)}_eur") for q in (0.1, 0.5, 0.9)],
                       (good * F.lit(100.0 / n)).alias("confidence_pct"))


def import_backtest(forecast: DataFrame, actual: DataFrame, now: str, days: int = 30, rmse_limit_w: float = 500.0,
                    by: Sequence[str] = ("site_id",)) -> DataFrame:
    """How the import quantiles of the last ``days`` have done: error of the median, coverage of the band, quantile losses.

    ``forecast`` is what ``net_import`` gives, ``actual`` has ``site_id, ts, net_import_w``. Slots that lack either are not counted. A
    band of p10 to p90 should cover 80 percent. The loss of quantile q weighs a shortfall by q and an excess by 1 - q.
    """
    end = ts_lit(now)
    inside = (F.col("ts") >= F.timestamp_add("DAY", F.lit(-days), end)) & (F.col("ts") < end)
    bands = {q: F.col(f"import_p{round(100 * q)}_w") for q in (0.1, 0.5, 0.9)}
    made = forecast.withColumnRenamed("target_ts", "ts").filter(inside).dropna(subset=[f"import_p{round(100 * q)}_w" for q in bands])
    rows = made.join(actual.filter(inside & F.col("net_import_w").isNotNull()).select("site_id", "ts", "net_import_w"), ["site_id", "ts"])
    error = {q: F.col("net_import_w") - band for q, band in bands.items()}
    loss = {q: F.greatest(F.lit(q) * e, F.lit(q - 1.0) * e) for q, e in error.items()}
    covered = (F.col("net_import_w") >= bands[0.1]) & (F.col("net_import_w") <= bands[0.9])
    out = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(error[0.5] * error[0.5])).alias("rmse_w"), F.avg(error[0.5]).alias("bias_w"),
        (F.lit(100.0) * F.avg(covered.cast("int"))).alias("coverage_pct"), *[F.avg(x).alias(f"loss_p{round(100 * q)}_w") for q, x in loss.items()])
    return out.withColumn("acceptable", F.col("rmse_w") < rmse_limit_w)
