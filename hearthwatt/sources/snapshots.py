"""Versioned snapshots: export, pointer to the newest, retention."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.timeparts import ts_lit
from ..operators.chunked import spread_join
from ..operators.digest import DIGEST, digest, digest_columns
from ..operators.keyed import newest_n
from ..operators.quality import require_fresh
from .shared import remove, stored_bytes

POINTER = "_latest"


def version_name(now: datetime, prefix: str = "weather_fusion") -> str:
    return f"{prefix}_{now:%Y%m%d_%H%M%S}"


def export_snapshot(df: DataFrame, root: str, now: datetime, prefix: str = "weather_fusion") -> str:
    """Write the whole result as a new version. Readers do not see it until it is published."""
    version = version_name(now, prefix)
    df.write.mode("errorifexists").parquet(f"{root}/{version}")
    return version


def export_verified(df: DataFrame, root: str, now: datetime, prefix: str = "weather_fusion") -> str:
    """Write the whole result as a new version and compare the files with what went into them, by number of rows and digest.

    The digest of the result is taken while it is written, so it is computed once. A version that differs is removed and refused; a
    write that had to repeat tasks may be refused too, and is then simply made again.
    """
    spark, version, seen = df.sparkSession, version_name(now, prefix), Observation(f"export-{uuid.uuid4().hex}")
    df.observe(seen, *digest_columns(df)).write.mode("errorifexists").parquet(f"{root}/{version}")
    files = spark.read.schema(df.schema).parquet(f"{root}/{version}")
    kept, made = digest(files).first().asDict(), seen.get
    if spark.read.parquet(f"{root}/{version}").columns != df.columns or any(kept[c] != made[c] for c in DIGEST):
        remove(spark, f"{root}/{version}")
        raise ValueError(f"snapshot {version} differs from its source and is not published: {kept}, not {made}")
    return version


def publish_latest(spark: SparkSession, root: str, version: str, now: datetime) -> None:
    """Make a version the newest. The pointer is a log of one row per publication, so no reader finds it missing; the
    rows of a version lie in a folder of their own and go with it."""
    size = stored_bytes(spark, f"{root}/{version}")
    one = spark.range(1).select(F.lit(version).alias("version"), ts_lit(now).alias("published_at"), F.lit(size).cast("long").alias("size_bytes"))
    one.coalesce(1).write.mode("append").partitionBy("version").parquet(f"{root}/{POINTER}")


def published(spark: SparkSession, root: str) -> DataFrame:
    """The log: ``version, published_at, size_bytes``. Rows of versions that are dropped meanwhile are left out."""
    return spark.read.schema("version string, published_at timestamp_ntz, size_bytes long") \
        .option("ignoreMissingFiles", True).parquet(f"{root}/{POINTER}")


def latest_version(spark: SparkSession, root: str) -> str:
    row = published(spark, root).agg(F.max_by("version", F.struct("published_at", "version"))).first()
    return row[0]


def read_latest(spark: SparkSession, root: str, now: datetime | None = None, max_age_minutes: int = 30) -> DataFrame:
    """Newest published version; with ``now`` an old one is refused."""
    version = latest_version(spark, root)
    if now is not None:
        require_fresh(version, now, max_age_minutes)
    return spark.read.parquet(f"{root}/{version}")


def retention(manifest: DataFrame, keep_n: int, min_bytes: int = 0, kind: str | None = None) -> DataFrame:
    """Versions to drop: those too small to be valid, and all but the newest ``keep_n`` valid ones of each kind.

    Only the newest rows of a kind are ranked, to find the oldest one kept; the rest is a comparison with it.
    """
    rows = manifest if kind is None else manifest.filter(F.col("kind") == kind)
    valid = F.col("size_bytes") >= min_bytes
    kept = newest_n(rows.filter(valid).select("kind", "created_at", "version"), ["kind"], ["created_at", "version"], keep_n)
    oldest = kept.groupBy("kind").agg(F.min(F.struct("created_at", "version")).alias("_oldest"))
    age = F.struct("created_at", "version")
    with_oldest = spread_join(rows, oldest, ["kind"], ["version"])
    return with_oldest.filter(~F.coalesce(valid, F.lit(False)) | (age < F.col("_oldest"))).drop("_oldest")


def prune_older_than(df: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Raw rows that stay after a confirmed upload."""
    return df.filter(F.col("ts") >= F.timestamp_add("HOUR", F.lit(-hours), now))


def drop_versions(spark: SparkSession, root: str, versions: Iterable[str]) -> int:
    """Delete version folders and what the log says of them, except the one that is published."""
    current = latest_version(spark, root)
    dropped = 0
    for version in versions:
        if version != current:
            remove(spark, f"{root}/{POINTER}/version={version}")
            dropped += remove(spark, f"{root}/{version}")
    return dropped
