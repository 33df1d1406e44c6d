"""Heat pump decisions and the commands in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.quantities import command_minutes, command_mode, is_command
from .chunked import RAW, fill_forward, neighbours


def parse_commands(commands: DataFrame) -> DataFrame:
    """Valid commands with their ``mode`` and, for timed ones, ``minutes``."""
    return commands.filter(is_command("command")).withColumns({"mode": command_mode("command"), "minutes": command_minutes("command")})


def rejected_commands(commands: DataFrame) -> DataFrame:
    """Text that is not a command, or a length out of range."""
    return commands.filter(~F.coalesce(is_command("command"), F.lit(False)))


def command_intervals(commands: DataFrame) -> DataFrame:
    """How long each valid command holds: until the next one, or until its own time is up if that is sooner.

    One command per site and instant. An open end is NULL.
    """
    valid = parse_commands(commands).select("site_id", "ts", "command", "mode", "minutes")
    following = neighbours(valid, ["site_id"], "ts", following={"_next": "ts"}, lengths=RAW)
    own_end = F.timestamp_add("MINUTE", F.col("minutes"), F.col("ts"))
    return following.select("site_id", F.col("ts").alias("start_ts"), F.least("_next", own_end).alias("end_ts"),
                            "command", "mode")


def command_state(commands: DataFrame, grid: DataFrame) -> DataFrame:
    """Mode at every grid slot. Before any command and after a timed prohibition it is ALLOW."""
    valid = parse_commands(commands)
    given = valid.select("site_id", "ts", F.col("ts").alias("_since"), F.col("mode").alias("_mode"),
                         F.coalesce("minutes", F.lit(-1)).alias("_minutes"), F.lit(0).alias("_side"))
    slots = grid.select("site_id", "ts", F.lit(1).alias("_side"))
    line = slots.unionByName(given, allowMissingColumns=True)
    held = fill_forward(line, ["site_id"], "ts", {"since_ts": "_since", "_held": "_mode", "_for": "_minutes"}, RAW, tie="_side")
    expired = (F.col("_for") > 0) & (F.timestamp_add("MINUTE", F.col("_for"), F.col("since_ts")) <= F.col("ts"))
    return held.filter("_side = 1").select(
        "site_id", "ts", F.when(expired | F.col("_held").isNull(), F.lit("ALLOW")).otherwise(F.col("_held")).alias("mode"),
        "since_ts")


def heat_pump_decision(fusion: DataFrame, price_max: float, temp_min: float) -> DataFrame:
    """PROHIBIT when power is dear and it is warm enough outside; ALLOW otherwise and whenever an input is missing.

    Check the input with ``quality.require_fresh`` first.
    """
    dear = (F.col("price_eur_per_mwh") > price_max) & (F.col("fc_temperature_c") >= temp_min)
    return fusion.select("site_id", "ts", "price_eur_per_mwh", "fc_temperature_c",
                         F.when(dear, F.lit("PROHIBIT")).otherwise(F.lit("ALLOW")).alias("decision"))


def decisions_as_commands(decisions: DataFrame) -> DataFrame:
    """Only the slots where the decision changes, as commands."""
    changes = neighbours(decisions.select("site_id", "ts", "decision"), ["site_id"], "ts", prev={"_before": "decision"})
    return changes.filter(~F.col("_before").eqNullSafe(F.col("decision"))).select(
        "site_id", "ts", F.col("decision").alias("command"))
