"""Ordered operations over one site's time line without putting that site into one task.

A window partitioned by ``site_id`` alone sends a whole site through one task, which fails when one site holds a
large share of all rows. Here the time line is cut into chunks of fixed length and the window runs per
``(site, chunk)``. What must cross a chunk border is carried in one of two ways:

* *edges*: a partially aggregated row per chunk (its first, last or total). The edges of a site are a time line
  again and may be cut once more by a longer length; at the top a small window runs over the chunks of a site, whose
  number follows the calendar, not the data.
* *halo*: rows near a border are copied into the neighbouring chunk. Used when the frame has a bounded length.

Both are exact. Rows are expected to be unique per ``(by, ts)``; see ``keyed.dedupe``.

A row without a site or without a time has no place on any time line: it is kept, gets NULL for what others would give
it, and gives nothing to others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.timeparts import epoch_seconds, ts_lit

CHUNK = "_chunk"
AT = "_at"
HOUR, DAY = 3600, 86400
# Chunk lengths in seconds, fine to coarse. A day holds at most 96 slots of a site. Raw rows have no such bound, but an
# hour of a site's rows fits a task, and one edge an hour is few against the rows of the hour.
SLOTS = (DAY,)
RAW = (HOUR,)
# Rows without a time are dealt to so many days from the year 1 on, so that they do not meet in one task.
UNTIMED = 4096


def placed(by: Sequence[str], ts: str) -> Column:
    """Whether a row has a place on a time line."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, ts)])


def _dealt(df: DataFrame) -> Column:
    """A number below ``UNTIMED`` out of a row's columns; maps cannot be hashed."""
    return F.pmod(F.xxhash64(*[f.name for f in df.schema if "map<" not in f.dataType.simpleString()]), F.lit(UNTIMED))


def with_chunk(df: DataFrame, ts: str, length: int = DAY) -> DataFrame:
    """Add the chunk a row lies in; ``length`` is in seconds."""
    at = F.coalesce(F.col(ts), F.timestamp_add("DAY", _dealt(df), ts_lit("0001-01-01 00:00:00")))
    return df.withColumn(CHUNK, F.window(at, f"{length} seconds").getField("start"))


def neighbours(df: DataFrame, by: Sequence[str], ts: str, prev: Mapping[str, str] | None = None,
               following: Mapping[str, str] | None = None, lengths: Sequence[int] = SLOTS) -> DataFrame:
    """Add values of the previous and the following row of the same site.

    ``prev`` and ``following`` map new column names to source columns.
    """
    prev, following = dict(prev or {}), dict(following or {})
    if not lengths:
        whole = Window.partitionBy(*by, F.col(ts).isNull()).orderBy(ts)
        return df.select(*df.columns, *[F.when(placed(by, ts), F.lag(src).over(whole)).alias(name) for name, src in prev.items()],
                         *[F.when(placed(by, ts), F.lead(src).over(whole)).alias(name) for name, src in following.items()])
    key = [*by, CHUNK]
    chunked = with_chunk(df, ts, lengths[0])
    edges = chunked.filter(placed(by, ts)).groupBy(*key).agg(
        F.min(ts).alias("_min_ts"),
        *[F.max_by(src, ts).alias(f"_last_{name}") for name, src in prev.items()],
        *[F.min_by(src, ts).alias(f"_first_{name}") for name, src in following.items()],
    ).withColumnRenamed(CHUNK, AT)
    edges = neighbours(edges, by, AT, {f"_before_{name}": f"_last_{name}" for name in prev},
                       {f"_after_{name}": f"_first_{name}" for name in following}, lengths[1:])
    edges = edges.select(*by, F.col(AT).alias(CHUNK), *[f"_before_{name}" for name in prev], *[f"_after_{name}" for name in following])
    inside = Window.partitionBy(*key).orderBy(ts)
    has_prev = F.lag(ts).over(inside).isNotNull()
    has_next = F.lead(ts).over(inside).isNotNull()
    return chunked.join(edges, key, "left").select(
        *df.columns,
        *[F.when(placed(by, ts), F.when(has_prev, F.lag(src).over(inside)).otherwise(F.col(f"_before_{name}"))).alias(name)
          for name, src in prev.items()],
        *[F.when(placed(by, ts), F.when(has_next, F.lead(src).over(inside)).otherwise(F.col(f"_after_{name}"))).alias(name)
          for name, src in following.items()],
    )


def last_before(df: DataFrame, by: Sequence[str], ts: str, cols: Mapping[str, str], lengths: Sequence[int] = SLOTS,
                tie: str | None = None) -> DataFrame:
    """Newest non-NULL value of earlier rows, the row itself left out."""
    order = [ts] if tie is None else [ts, tie]
    if not lengths:
        earlier = Window.partitionBy(*by, F.col(ts).isNull()).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(*df.columns, *[F.when(placed(by, ts), F.last(src, ignorenulls=True).over(earlier)).alias(name)
                                        for name, src in cols.items()])
    key = [*by, CHUNK]
    chunked = with_chunk(df, ts, lengths[0])
    edges = chunked.filter(placed(by, ts)).groupBy(*key).agg(*[
        F.max_by(src, F.when(F.col(src).isNotNull(), F.col(ts))).alias(f"_last_{name}") for name, src in cols.items()
    ]).withColumnRenamed(CHUNK, AT)
    edges = last_before(edges, by, AT, {f"_carry_{name}": f"_last_{name}" for name in cols}, lengths[1:])
    edges = edges.select(*by, F.col(AT).alias(CHUNK), *[f"_carry_{name}" for name in cols])
    earlier = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return chunked.join(edges, key, "left").select(
        *df.columns,
        *[F.when(placed(by, ts), F.coalesce(F.last(src, ignorenulls=True).over(earlier), F.col(f"_carry_{name}"))).alias(name)
          for name, src in cols.items()],
    )


def fill_forward(df: DataFrame, by: Sequence[str], ts: str, cols: Mapping[str, str], lengths: Sequence[int] = SLOTS,
                 tie: str | None = None) -> DataFrame:
    """Newest non-NULL value at or before each row. ``cols`` maps new names to source columns.

    ``tie`` orders rows of equal time, for unions of a grid with the rows to be found on it.
    """
    before = last_before(df, by, ts, {f"_prior_{name}": src for name, src in cols.items()}, lengths, tie)
    return before.select(*df.columns, *[F.coalesce(src, f"_prior_{name}").alias(name) for name, src in cols.items()])


def total_before(df: DataFrame, by: Sequence[str], ts: str, cols: Mapping[str, str], lengths: Sequence[int] = SLOTS) -> DataFrame:
    """Sum over earlier rows, the row itself left out; NULL in the first row."""
    if not lengths:
        earlier = Window.partitionBy(*by, F.col(ts).isNull()).orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(*df.columns, *[F.when(placed(by, ts), F.sum(src).over(earlier)).alias(name) for name, src in cols.items()])
    key = [*by, CHUNK]
    chunked = with_chunk(df, ts, lengths[0])
    edges = chunked.filter(placed(by, ts)).groupBy(*key).agg(*[F.sum(src).alias(f"_total_{name}") for name, src in cols.items()]).withColumnRenamed(CHUNK, AT)
    edges = total_before(edges, by, AT, {f"_carry_{name}": f"_total_{name}" for name in cols}, lengths[1:])
    edges = edges.select(*by, F.col(AT).alias(CHUNK), *[f"_carry_{name}" for name in cols])
    earlier = Window.partitionBy(*key).orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)

    def added(name: str, src: str) -> Column:
        inner, carry = F.sum(src).over(earlier), F.col(f"_carry_{name}")
        return F.when(placed(by, ts), F.coalesce(inner + carry, inner, carry)).alias(name)

    return chunked.join(edges, key, "left").select(*df.columns, *[added(name, src) for name, src in cols.items()])


def running_total(df: DataFrame, by: Sequence[str], ts: str, cols: Mapping[str, str], lengths: Sequence[int] = SLOTS) -> DataFrame:
    """Cumulative sum up to and including each row. ``cols`` maps new names to source columns."""
    before = total_before(df, by, ts, {f"_prior_{name}": src for name, src in cols.items()}, lengths)
    zero = F.lit(0)
    return before.select(*df.columns, *[
        (F.coalesce(f"_prior_{name}", zero) + F.coalesce(src, zero)).alias(name) for name, src in cols.items()])


def with_halo(df: DataFrame, ts: str, before_seconds: int, after_seconds: int, length: int = DAY,
              keep_untimed: bool = False) -> DataFrame:
    """Copy each row into every chunk whose rows can see it.

    A row at ``u`` sees ``[u - before, u + after]``. The column ``_home`` is true on the one copy that lies in the
    row's own chunk; keep only those after the window. With chunks longer than the frame a row has two or three
    copies at most, and most have one. A row without a time sees nothing; it goes unless ``keep_untimed`` is set.
    """
    seconds = epoch_seconds(ts)

    def chunk_of(at: Column) -> Column:
        return F.floor(at / F.lit(float(length)))

    reached, own = F.sequence(chunk_of(seconds - after_seconds), chunk_of(seconds + before_seconds)), chunk_of(seconds)
    if keep_untimed:
        nowhere = F.lit(-1 << 40) - _dealt(df)
        reached, own = F.coalesce(reached, F.array(nowhere)), F.coalesce(own, nowhere)
    rows = df if keep_untimed else df.filter(F.col(ts).isNotNull())
    spread = rows.select(*df.columns, own.alias("_own"), F.explode(reached).alias(CHUNK))
    return spread.select(*df.columns, CHUNK, (F.col(CHUNK) == F.col("_own")).alias("_home"))


def home_rows(df: DataFrame) -> DataFrame:
    return df.filter("_home").drop("_home", CHUNK)


def halo_window(by: Sequence[str], ts: str) -> Window:
    return Window.partitionBy(*by, CHUNK).orderBy(ts)


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "left",
                salts: int = 32) -> DataFrame:
    """Join rows to a table with few rows per key when a key may be hot on the left.

    The left side is spread over ``salts`` tasks per key by a hash of ``spread_by`` and the right side is copied as
    often. A right side small enough to be broadcast is still broadcast by the planner, which knows its size.
    """
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
