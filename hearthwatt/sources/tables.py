"""Stored tables: partitioned upserts, forecast runs, outbox, CSV, databases."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timeparts import between_dates
from ..operators.keyed import dedupe, upsert
from .shared import remove, run_folder

DT = "dt"


def with_day(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Partition column: UTC date."""
    return df.withColumn(DT, F.col(ts).cast("date"))


def write_partitioned(df: DataFrame, path: str, mode: str = "append") -> None:
    """Files per UTC day, in key order so that row-group statistics cut range reads.

    Rows are placed by sampled ranges of day, key and time, so neither a big day nor a big site ends up in one task.
    """
    day = with_day(df)
    keys = [DT, *[c for c in ("site_id", "zone", "ts") if c in df.columns]]
    (day.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy(DT).parquet(path))


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing.getCondition()) or "UNABLE_TO_INFER_SCHEMA" in str(missing.getCondition()):
            return None
        raise


def _replace_days(spark: SparkSession, merged: DataFrame, path: str) -> None:
    """Put the rebuilt days in place. They are written aside first: a folder cannot be read and replaced in one job."""
    staging, rebuilt = _aside(spark, merged)
    try:
        write_partitioned(rebuilt.drop(DT), path, mode="overwrite")
    finally:
        remove(spark, staging)


def _aside(spark: SparkSession, df: DataFrame) -> tuple[str, DataFrame]:
    """A copy in the shared folder, so that what it is made of is computed once; to be removed after use."""
    folder = run_folder(spark, "staging")
    df.write.parquet(folder)
    return folder, spark.read.schema(df.schema).parquet(folder)


def _touched(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored rows of the days that the updates reach. The days are literals, so only their partitions and that of rows without a
    time are listed and read."""
    days = with_day(updates).select(F.col(DT).alias("_day")).distinct()
    named = sorted(row["_day"] for row in days.collect() if row["_day"] is not None)
    near = F.col(DT).isNull()
    if named:
        reach = F.col(DT).between(F.lit(named[0]), F.lit(named[-1]))
        near = near | (reach & F.col(DT).isin(named) if len(named) > 1 else reach)
    return stored.filter(near).join(days, F.col(DT).eqNullSafe(F.col("_day")), "left_semi")


def upsert_stored(spark: SparkSession, updates: DataFrame, path: str, key: Sequence[str], now: Column,
                  order: Sequence[str] = ()) -> None:
    """Last write wins, in place. ``order`` picks among several updates of one key."""
    if "ts" not in key:
        raise ValueError("the key must hold ts: only the days of the updates are looked at")
    staging, updates = _aside(spark, dedupe(updates, key, order) if order else updates)
    try:
        if not order and updates.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1").limit(1).count():
            raise ValueError("several updates of one key: name the order that picks one")
        stored = read_stored(spark, path)
        if stored is None:
            write_partitioned(updates.withColumns({"created_at": now, "updated_at": now}), path)
        else:
            _replace_days(spark, upsert(_touched(stored, updates).drop(DT), updates, key, now), path)
    finally:
        remove(spark, staging)


def insert_ignore_stored(spark: SparkSession, updates: DataFrame, path: str, key: Sequence[str], order: Sequence[str],
                         before: Callable[[DataFrame], None] | None = None) -> None:
    """First write wins: append only the keys that are not stored yet. ``before`` is handed these rows before they are."""
    staging, updates = _aside(spark, updates)
    try:
        stored = read_stored(spark, path)
        new = updates if stored is None else updates.join(_touched(stored, updates).select(*key), list(key), "left_anti")
        new = dedupe(new, key, order, keep="first")
        if before is not None:
            folder, new = _aside(spark, new)
            try:
                before(new)
                write_partitioned(new, path)
            finally:
                remove(spark, folder)
        else:
            write_partitioned(new, path)
    finally:
        remove(spark, staging)


def append_forecast_run(run: DataFrame, values: DataFrame, root: str) -> None:
    """Keep a run: values first, then the header that makes them visible to readers that join on it.

    What is stored of a run already stays as it is, so a repeated run adds nothing.
    """
    spark, dated = run.sparkSession, values.withColumn(DT, F.col("target_ts").cast("date"))
    kept, known = read_stored(spark, f"{root}/forecast_value"), read_stored(spark, f"{root}/forecast_run")
    if kept is not None:  # the days of the run are literals, so no other partition is read
        days = [row[0] for row in dated.select(DT).distinct().collect()]
        dated = dated.join(kept.filter(F.col(DT).isin(days)).select(DT, "run_id").distinct(), [DT, "run_id"], "left_anti")
    if known is not None:
        run = run.join(known.select("run_id"), "run_id", "left_anti").select(*run.columns)
    dated.select(*values.columns, DT).write.mode("append").partitionBy(DT).parquet(f"{root}/forecast_value")
    run.write.mode("append").parquet(f"{root}/forecast_run")


def outbox_pending(df: DataFrame, sent: DataFrame, key: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """Rows that were not sent yet."""
    return df.join(sent.select(*key), list(key), "left_anti")


def outbox_mark(ids: DataFrame, now: Column, key: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """Rows for the sent log after a successful push."""
    return ids.select(*key, now.alias("pushed_at"))


def export_csv(df: DataFrame, path: str, start: str | None = None, end: str | None = None) -> None:
    """CSV with ``ts`` first, for inclusive UTC dates; without dates everything."""
    rows = df.filter(between_dates("ts", start, end))
    rest = [c for c in df.columns if c != "ts"]
    rows.select("ts", *rest).write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, url: str, table: str, ts_lo: str, ts_hi: str, n: int, **options: str) -> DataFrame:
    """Table of an existing database, read in ``n`` ranges of ``ts``. Needs the database's driver on the class path."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table).option("partitionColumn", "ts")
            .option("lowerBound", ts_lo).option("upperBound", ts_hi).option("numPartitions", n).options(**options).load())


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()
