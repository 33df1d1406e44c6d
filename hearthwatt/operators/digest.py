"""Digests of contents that do not depend on the order of rows, as a tree over days: equal parts are told apart from changed ones
without comparing rows.

A digest is the number of rows, the sum of their hashes and the combination of a second hash of each. Digests of parts add up
to that of the whole, so one pass over the rows gives the days, and the days give months, years and everything.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .quality import reconcile

DIGEST = ("n_rows", "hash_sum", "hash_mix")
#: Characters of a day that name everything, a year, a month and the day; the day of rows without a time.
LENGTHS, NO_DAY = (0, 4, 7, 10), "0000-01-01"


def row_hash(df: DataFrame, salt: int = 0) -> Column:
    """Hash of a whole row; entries of a map count whatever their order."""
    parts = [F.sort_array(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema]
    return F.xxhash64(F.lit(salt), *parts)


def digest_columns(df: DataFrame) -> list[Column]:
    """Aggregates that make up a digest, also as metrics to observe while rows are written."""
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(row_hash(df).cast("decimal(38,0)")).alias("hash_sum"),
            F.bit_xor(row_hash(df, 1)).alias("hash_mix")]


def digest(df: DataFrame) -> DataFrame:
    """One row; null sums where there are no rows."""
    return df.agg(*digest_columns(df))


def digest_tree(df: DataFrame, ts: str = "ts") -> DataFrame:
    """``level, node, parent`` and the digest of everything (level 0) and of each UTC year, month and day, named as in ``2024-01-17``.

    Rows without a time are a day of their own, ``0000-01-01``. One pass over the rows; the rest is sums of a row per day.
    """
    day = F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(NO_DAY))
    days = df.groupBy(day.alias("_day")).agg(*digest_columns(df))
    nodes = days.select(*DIGEST, F.posexplode(F.array(*[F.substring("_day", 1, n) for n in LENGTHS])).alias("level", "node"))
    tree = nodes.groupBy("level", "node").agg(F.sum("n_rows").alias("n_rows"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_mix").alias("hash_mix"))
    parent = F.substring("node", 1, F.element_at(F.array(*map(F.lit, (0, *LENGTHS))), F.col("level") + 1))
    return tree.select("level", "node", F.when(F.col("level") > 0, parent).alias("parent"), *DIGEST)


def changed_days(left: DataFrame, right: DataFrame) -> list[str]:
    """Days whose digests differ between two trees, from the top down: below a node that is equal nothing is looked at."""
    changed: list[str] = []
    for level in range(len(LENGTHS)):
        one, two = (tree.filter((F.col("level") == level) & (F.lit(True) if level == 0 else F.col("parent").isin(changed)))
                    .select("node", F.struct(*DIGEST).alias(name)) for tree, name in ((left, "_a"), (right, "_b")))
        differ = one.join(two, "node", "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
        changed = sorted(row["node"] for row in differ.select("node").collect())
        if not changed:
            break
    return changed


def content_differences(left: DataFrame, right: DataFrame, key: Sequence[str], cols: Sequence[str], trees: tuple[DataFrame, DataFrame] | None = None,
                        ts: str = "ts", day: str | None = None) -> DataFrame:
    """Cells that two tables do not have alike, as ``reconcile`` gives them, found by reading the changed days only.

    ``trees`` are the digest trees of both, if they are kept; otherwise they are made here. ``day`` names the partition column of
    dates, if there is one, so that no other partition is read.
    """
    own, other = trees or (digest_tree(left.select(*key, *cols), ts), digest_tree(right.select(*key, *cols), ts))
    days = changed_days(own, other)
    dated = [date.fromisoformat(name) for name in days if name != NO_DAY]
    at = F.col(day) if day else F.col(ts).cast("date")
    inside = at.isin(dated) | (at.isNull() if NO_DAY in days else F.lit(False))
    cells = reconcile(left.filter(inside), right.filter(inside), key, cols)
    return cells.filter("class <> 'match'")
