"""Means in pieces that can be added up: late rows join what is known of their slot, and no raw row is read again.

A piece is ``site_id, ts, measure, total, n``: the sum and the number of the values of one measure in one slot. Pieces of one
slot are added in any order. Wind is kept as the sums of its east and north parts, each register under its number, and
``rows`` counts the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.quantities import wind_components, wind_from_components
from ..functions.timeparts import with_slot
from ..schemas import SCALARS
from .averaging import WIND, check_allowed

ROWS, EAST, NORTH, REGISTER = "rows", "wind.east", "wind.north", "register."


def slot_partials(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",), label: str = "end",
                  length: str = "15 minutes") -> DataFrame:
    """Pieces of raw rows, which are summed up before they are shuffled. A row counts once for each time it stands there."""
    cols = check_allowed(cols)
    slotted, group = with_slot(df, "ts", length, "_slot", label), [*by, "_slot"]
    values = {ROWS: F.lit(1.0), **{c: F.col(c).cast("double") for c in cols if c in SCALARS}}
    if any(c in WIND for c in cols):
        values[EAST], values[NORTH] = wind_components(*WIND)
    sums = slotted.groupBy(*group).agg(*[F.struct(F.sum(v).alias("total"), F.count(v).alias("n")).alias(f"_{i}")
                                         for i, v in enumerate(values.values())])
    pieces = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(f"_{i}.total"), F.col(f"_{i}.n")) for i, name in enumerate(values)])
    out = sums.select(*by, F.col("_slot").alias("ts"), F.inline(pieces)).filter("n > 0")
    if "registers" in cols:
        entries = slotted.select(*group, F.explode_outer("registers").alias("_key", "_value")).filter(F.col("_key").isNotNull())
        out = out.unionByName(entries.groupBy(*group, "_key").agg(F.sum("_value").alias("total"), F.count("_value").alias("n")).select(
            *by, F.col("_slot").alias("ts"), F.concat(F.lit(REGISTER), "_key").alias("measure"), "total", "n"))
    return out


def add_partials(known: DataFrame, new: DataFrame, by: Sequence[str] = ("site_id",)) -> DataFrame:
    """One piece per slot and measure out of both."""
    return known.unionByName(new).groupBy(*by, "ts", "measure").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def means_of_partials(partials: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",)) -> DataFrame:
    """``rows_used`` and the means of each slot, as ``avg_15min`` gives them. One piece per slot and measure is expected."""
    cols = check_allowed(cols)
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    of = lambda name: F.max(F.when(F.col("measure") == name, mean))
    number = F.substring("measure", len(REGISTER) + 1, 1 << 20)
    listed = F.sort_array(F.collect_list(F.when(F.col("measure").startswith(REGISTER), F.struct(number.alias("k"), mean.alias("v")))))
    out = partials.groupBy(*by, "ts").agg(
        F.max(F.when(F.col("measure") == ROWS, F.col("n"))).alias("rows_used"), *[of(c).alias(c) for c in cols if c in SCALARS],
        of(EAST).alias("_east"), of(NORTH).alias("_north"), listed.alias("_registers"))
    speed, direction = wind_from_components(F.col("_east"), F.col("_north"))
    made = {WIND[0]: speed, WIND[1]: direction,
            "registers": F.when(F.size("_registers") > 0, F.map_from_entries("_registers"))}
    return out.select(*by, "ts", "rows_used", *[made[c].alias(c) if c in made else c for c in cols])
