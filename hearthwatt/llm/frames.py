"""Small DataFrame helpers: tables, results kept in the shared folder, the remainder that marks held-out rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthwatt.sources.shared import run_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later jobs neither repeat its work nor depend on an executor."""
    spark, folder = df.sparkSession, run_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """For the jobs that run inside, Python gets at most ``rows`` rows at once; then the session's own setting holds again.

    Executor and worker hold each batch whole, and Arrow doubles its buffers: 10,000 texts of 3 kB, or pairs of sets, take
    hundreds of MB beside the heap. Results do not depend on the cut.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remainder(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``; a missing key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % of


def per_partition(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to as many partitions as tasks can run at once, unless it has as many anyway."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def free_names(df: DataFrame, names: Iterable[str], avoid: Iterable[str] = ()) -> dict[str, str]:
    """For each of ``names`` one that neither ``df`` has a column of nor ``avoid`` lists, whatever the case of its letters."""
    taken, out = {c.lower() for c in [*df.columns, *avoid]}, {}
    for name in names:
        free = name
        while free.lower() in taken:
            free = f"_{free}"
        taken.add(free.lower())
        out[name] = free
    return out


def beside(df: DataFrame, names: Iterable[str], column: str, work: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What ``work`` keeps of ``df``, with all its own columns, also those that are named like the columns that ``work`` adds.

    These are renamed in the meantime; ``work`` gets the frame and the name of ``column`` in it.
    """
    added = {name.lower() for name in names}
    moved = free_names(df, [c for c in df.columns if c.lower() in added], names)
    out = work(df.withColumnsRenamed(moved), moved.get(column, column))
    return out.select(*(F.col(f"`{moved.get(c, c)}`").alias(c) for c in df.columns))
