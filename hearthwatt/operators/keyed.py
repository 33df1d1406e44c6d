"""Operators on keys: duplicates, upserts, newest rows.

One key may own a large group of copies, so duplicates are resolved with aggregates that combine before the
shuffle, never with a window over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .chunked import spread_join


def _rank_payload(df: DataFrame, order: Sequence[Column]) -> Column:
    """Ordering by ``order``, then by content, so that equal order values give the same winner in every run."""
    parts = [F.map_entries(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema]
    return F.struct(*order, F.xxhash64(*parts))


def dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the first or the last by ``order``."""
    rest = [c for c in df.columns if c not in key]
    pick = F.max_by if keep == "last" else F.min_by
    chosen = pick(F.struct(*rest), _rank_payload(df, [F.col(c) for c in order])).alias("_row")
    return df.groupBy(*key).agg(chosen).select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str], now: Column) -> DataFrame:
    """Target after ``updates``: an updated key takes the new values and keeps its ``created_at``.

    ``updates`` holds one row per key (see :func:`dedupe`). ``updated_at`` is ``now`` where the key was updated.
    """
    values = [c for c in target.columns if c not in [*key, "created_at", "updated_at"]]
    new = updates.select(*key, F.lit(True).alias("_new"), *[F.col(c).alias(f"_u_{c}") for c in values])
    joined = target.withColumn("_old", F.lit(True)).join(new, list(key), "full")
    touched = F.col("_new").isNotNull()
    return joined.select(
        *key,
        *[F.when(touched, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) for c in values],
        F.when(F.col("_old").isNotNull(), F.col("created_at")).otherwise(now).alias("created_at"),
        F.when(touched, now).otherwise(F.col("updated_at")).alias("updated_at"),
    ).select(*target.columns)


def insert_ignore(target: DataFrame, updates: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Target plus those updates whose key it does not have yet; of several new ones the first wins."""
    fresh = updates.select(*target.columns).join(target.select(*key), list(key), "left_anti")
    return target.unionByName(dedupe(fresh, key, order, keep="first"))


def newest_n(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, salts: int = 64) -> DataFrame:
    """Newest ``n`` rows per group, in two rounds.

    The first round ranks within a salted part of the group, so no task sorts a whole group; the second sees at
    most ``salts * n`` rows of it. A hash of the whole row decides between rows of one time, so runs agree.
    """
    content = F.xxhash64(*[F.map_entries(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema])
    newest_first = [*(F.col(c).desc() for c in order), F.col("_content")]
    salted = df.withColumn("_content", content).withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    part = Window.partitionBy(*by, "_salt").orderBy(*newest_first)
    whole = Window.partitionBy(*by).orderBy(*newest_first)
    return (salted.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= n)
            .withColumn("_rank", F.row_number().over(whole)).filter(F.col("_rank") <= n)
            .drop("_rank", "_salt", "_content"))


def latest_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Newest ``n`` rows overall, planned as a top-k."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def newest_per_target(values: DataFrame, runs: DataFrame) -> DataFrame:
    """For every target time the value of the newest run that covers it, not the rows of one newest run.

    ``run_id`` is unique in ``runs``; the aggregate combines before the shuffle.
    """
    issued = spread_join(values, runs.select("run_id", "issued_at"), ["run_id"], ["site_id", "target_ts"], "inner")
    rest = ["run_id", "issued_at", "yhat_p50", "yhat_p10", "yhat_p90"]
    return issued.groupBy("site_id", "target", "target_ts").agg(
        F.max_by(F.struct(*rest), F.struct("issued_at", "run_id")).alias("_best")
    ).select("site_id", "target", "target_ts", *[F.col(f"_best.{c}").alias(c) for c in rest])


def run_values(values: DataFrame, runs: DataFrame, run_id: str | None = None, limit: int | None = None) -> DataFrame:
    """Values of one run, by default the newest; ``limit`` gives its first rows in time order."""
    if run_id is None:
        newest = runs.select(F.max_by("run_id", F.struct("issued_at", "run_id"))).scalar()
        rows = values.filter(F.col("run_id") == newest)
    else:
        rows = values.filter(F.col("run_id") == run_id)
    return rows if limit is None else rows.orderBy("target_ts").limit(limit)


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


