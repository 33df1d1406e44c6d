"""Event models with versions: retrained weekly, scored on the week they have not seen, promoted only if not worse.

``event_model`` holds the probabilities of every version, ``event_model_log`` how each did and whether it was promoted. Both are
versioned tables. The log is committed after the model, in one step: a version is current for an event type from then on, and
a run that dies before that has changed nothing a reader can see.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timeparts import ts_lit
from ..operators.planning import event_forecast, event_probability, event_scores, retrain_gate
from . import versions

MODEL, LOG = "event_model", "event_model_log"
#: Weeks of training before the week of validation, and the probability from which an event counts as predicted.
WEEKS, THRESHOLD_PCT = 8, 50.0
LOG_SCHEMA = "version string, ts timestamp_ntz, event_type string, f1 double, current_version string, current_f1 double, promoted boolean"


def version_of(now: datetime) -> str:
    return f"events_{now:%Y%m%d_%H%M%S}"


def _window(ts: str, start: datetime, end: datetime) -> Column:
    return (F.col(ts) >= ts_lit(start)) & (F.col(ts) < ts_lit(end))


def validated(probability: DataFrame, week: DataFrame, tz: str, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """Scores per event type of a model on the classified slots of a week. Slots without a reading are not scored."""
    predicted = event_forecast(probability, week.select("site_id", "ts"), tz).filter(F.col("probability_pct") >= threshold_pct)
    actual = week.filter("event_class <> 'none'").select("site_id", "ts", F.col("event_class").alias("event_type"))
    return event_scores(predicted.select("site_id", F.col("target_ts").alias("ts"), "event_type"), actual)


def model_log(spark: SparkSession, root: str) -> DataFrame:
    """All scores so far, oldest first to last by ``ts``."""
    path = f"{root}/{LOG}"
    if versions.load(spark, path) is None:
        return spark.createDataFrame([], LOG_SCHEMA)
    return versions.read(spark, path).drop(versions.DT)


def current_versions(log: DataFrame) -> DataFrame:
    """``event_type, version``: the version promoted last for each type."""
    return log.filter("promoted").groupBy("event_type").agg(F.max_by("version", F.struct("ts", "version")).alias("version"))


def current_model(spark: SparkSession, root: str) -> DataFrame:
    """The probabilities in force, of each event type those of its current version."""
    path, current = f"{root}/{MODEL}", current_versions(model_log(spark, root))
    if versions.load(spark, path) is None:
        raise ValueError(f"no model in {path}")
    return versions.read(spark, path).drop(versions.DT, "ts").join(current, ["event_type", "version"])


def retrain(spark: SparkSession, root: str, components: DataFrame, now: datetime, tz: str = "Europe/Helsinki",
            weeks: int = WEEKS, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """Weekly: train on the ``weeks`` before the last one, score candidate and current model on the last one, promote what is not worse.

    Event types are promoted one by one; a type that has no current model takes the candidate. Returns the rows of the log that this
    run has written; a run that is repeated writes none and finds those of the first.
    """
    version, start = version_of(now), now - timedelta(days=7)
    number = int((now - datetime(1970, 1, 1)).total_seconds())
    done = versions.load(spark, f"{root}/{LOG}")
    if done is None or done.sources.get("retrain", -1) < number:
        stamp = {"version": F.lit(version), "ts": ts_lit(now)}
        candidate = event_probability(components, start.strftime("%Y-%m-%d %H:%M:%S"), weeks, tz).withColumns(stamp)
        versions.merge(spark, f"{root}/{MODEL}", candidate, lambda old, new: new if old is None else old.filter(F.col("version") != version).unionByName(new))
        model = versions.read(spark, f"{root}/{MODEL}").drop(versions.DT)
        week, log = components.filter(_window("ts", start, now)), model_log(spark, root)
        new = validated(model.filter(F.col("version") == version), week, tz, threshold_pct)
        current = current_versions(log)
        old = validated(model.join(current, ["event_type", "version"]), week, tz, threshold_pct)
        # A current model without a score has neither missed nor invented an event in that week, so the candidate can't do better.
        gate = retrain_gate(old, new).join(current.withColumnRenamed("version", "current_version"), "event_type", "left")
        first = F.col("current_version").isNull()
        rows = gate.withColumns(stamp).select(
            "version", "ts", "event_type", F.col("new_f1").alias("f1"), "current_version", F.when(~first, F.col("old_f1")).alias("current_f1"),
            (F.col("new_f1").isNotNull() & (first | F.col("old_f1").isNotNull() & F.col("publish"))).alias("promoted"))
        versions.merge(spark, f"{root}/{LOG}", rows, lambda old, new: new if old is None else old.unionByName(new), ("retrain", number))
    return model_log(spark, root).filter(F.col("version") == version)
