"""Weekly retraining: what is promoted, what is kept, repeated and killed runs."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import epoch_seconds
from hearthwatt.sources import models, versions

MONDAY = datetime(2026, 3, 2)


def week(spark, start, hours):
    """Quarter hours of one week at site a, with an ev event in these local hours (UTC here) of each day."""
    data = []
    for i in range(7 * 96):
        ts = start + timedelta(minutes=15 * i)
        on = ts.hour in hours
        data.append(("a", ts, "ev" if on else "none", 6000.0 if on else 0.0))
    rows = spark.createDataFrame(data, "site_id string, ts timestamp_ntz, event_class string, ev_actual_w double")
    island = F.floor(epoch_seconds("ts") / 86400)
    return rows.withColumns({"sauna_actual_w": F.lit(0.0), "other_actual_w": F.lit(0.0), "total_actual_w": F.col("ev_actual_w"), "baseline_actual_w": F.lit(0.0),
                             "event_id": F.when(F.col("event_class") == "ev", island).otherwise(-island).cast("bigint")})


def weeks(spark, *hours):
    out = None
    for k, some in enumerate(hours):
        one = week(spark, MONDAY + timedelta(weeks=k), some)
        out = one if out is None else out.unionByName(one)
    return out


def run(spark, root, parts, k, **options):
    """The run after week ``k`` (from 1)."""
    log = models.retrain(spark, root, parts, MONDAY + timedelta(weeks=k), "UTC", **options)
    return {r["event_type"]: (r["f1"] and round(r["f1"], 6), r["current_f1"] and round(r["current_f1"], 6), r["promoted"]) for r in log.collect()}


def in_force(spark, root):
    return {r["event_type"]: r["version"] for r in models.current_versions(models.model_log(spark, root)).collect()}


def name(k):
    return models.version_of(MONDAY + timedelta(weeks=k))


def test_a_worse_model_never_becomes_current(spark, tmp_path):
    root = str(tmp_path)
    # Events move for one week: the model trained on that week alone would miss those of the week after it.
    parts = weeks(spark, {18}, {18}, {3, 4, 5}, {18}, {18}).cache()
    assert run(spark, root, parts, 2, weeks=1) == {"ev": (1.0, None, True)}
    assert run(spark, root, parts, 3, weeks=1)["ev"][2]  # as wrong as the current one
    assert in_force(spark, root) == {"ev": name(3)}
    assert run(spark, root, parts, 4, weeks=1) == {"ev": (0.0, 1.0, False)}
    assert in_force(spark, root) == {"ev": name(3)}
    model = models.current_model(spark, root)
    assert {r["slot"] // 4 for r in model.collect()} == {18} and {r["version"] for r in model.collect()} == {name(3)}
    assert run(spark, root, parts, 5, weeks=1) == {"ev": (1.0, 1.0, True)}
    assert models.model_log(spark, root).count() == 4


def test_repeated_and_killed_runs(spark, tmp_path, monkeypatch):
    root, parts = str(tmp_path), weeks(spark, {18}, {18}, {18}).cache()
    first = run(spark, root, parts, 2)
    number = versions.load(spark, f"{root}/{models.LOG}").number
    assert run(spark, root, parts, 2) == first and versions.load(spark, f"{root}/{models.LOG}").number == number

    with monkeypatch.context() as m:  # killed between the model and its promotion
        m.setattr(models, "retrain_gate", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            run(spark, root, parts, 3)
    assert in_force(spark, root) == {"ev": name(2)} and {r["version"] for r in models.current_model(spark, root).collect()} == {name(2)}
    assert run(spark, root, parts, 3) == {"ev": (1.0, 1.0, True)}
    stored = versions.read(spark, f"{root}/{models.MODEL}")
    assert stored.groupBy("version", "weekday", "slot", "event_type").count().filter("count > 1").count() == 0


def test_weeks_without_events(spark, tmp_path):
    root, parts = str(tmp_path), weeks(spark, {18}, set(), {18}).cache()
    with pytest.raises(ValueError, match="no model"):
        models.current_model(spark, root)
    assert run(spark, root, parts, 2, weeks=1) == {"ev": (0.0, None, True)}  # false alarms only, but there is no other
    assert run(spark, root, parts, 3, weeks=1) == {"ev": (0.0, 1.0, False)}
    assert in_force(spark, root) == {"ev": name(2)}
