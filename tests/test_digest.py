"""Digests: order and partitioning play no part, a changed value is found, and only its day is read."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.operators.digest import DIGEST, changed_days, content_differences, digest, digest_tree
from hearthwatt.sources import snapshots, tables

T0 = datetime(2025, 12, 30)


@pytest.fixture(scope="module")
def frame(spark):
    data = [(f"s{i % 3}", T0 + timedelta(hours=i), float(i % 11) if i % 7 else None, {"a": 1.0, "b": float(i)}) for i in range(24 * 40)]
    return spark.createDataFrame([*data, ("s0", None, 1.0, None)], "site_id string, ts timestamp_ntz, x double, registers map<string,double>")


def tree(df):
    return {(r["level"], r["node"]): (r["parent"], *(r[c] for c in DIGEST)) for r in digest_tree(df).collect()}


def test_tree_adds_up(spark, frame):
    nodes = tree(frame)
    assert nodes == tree(frame.repartition(7, "x").orderBy(F.desc("x")))
    assert nodes[0, ""][1:] == tuple(digest(frame).first()) and nodes[0, ""][1] == 24 * 40 + 1
    for (level, name), (parent, n, *_) in nodes.items():
        assert level == 0 or nodes[level - 1, parent][1] >= n
    assert {name for level, name in nodes if level == 1} == {"0000", "2025", "2026"} and nodes[3, "2026-01-01"][0] == "2026-01"
    assert sum(v[2] for (level, _), v in nodes.items() if level == 3) == nodes[0, ""][2]


@pytest.mark.parametrize("change, days", [
    ("false", []), ("ts = TIMESTAMP_NTZ'2026-01-03 05:00:00'", ["2026-01-03"]), ("ts IS NULL", ["0000-01-01"]),
    ("ts IN (TIMESTAMP_NTZ'2025-12-31 05:00:00', TIMESTAMP_NTZ'2026-02-01 01:00:00')", ["2025-12-31", "2026-02-01"])])
def test_changed_days(frame, change, days):
    other = frame.withColumn("x", F.when(F.expr(change), F.lit(99.0)).otherwise(F.col("x")))
    assert changed_days(digest_tree(frame), digest_tree(other)) == days


def test_copies_and_missing_days(spark, frame):
    """A row that stands there twice, a day that is gone, two values that have changed places."""
    one = frame.filter(F.col("ts") == ts_lit(datetime(2026, 1, 5, 3)))
    assert changed_days(digest_tree(frame), digest_tree(frame.unionByName(one))) == ["2026-01-05"]
    assert changed_days(digest_tree(frame), digest_tree(frame.unionByName(one).unionByName(one))) == ["2026-01-05"]
    assert changed_days(digest_tree(frame), digest_tree(frame.filter("ts IS NULL OR ts >= '2025-12-31'"))) == ["2025-12-30"]
    hours = [datetime(2026, 1, 7, 1), datetime(2026, 1, 7, 2)]
    swapped = frame.withColumn("x", F.when(F.col("ts") == ts_lit(hours[0]), 2.0).when(F.col("ts") == ts_lit(hours[1]), 1.0).otherwise(F.col("x")))
    plain = frame.withColumn("x", F.when(F.col("ts") == ts_lit(hours[0]), 1.0).when(F.col("ts") == ts_lit(hours[1]), 2.0).otherwise(F.col("x")))
    assert changed_days(digest_tree(plain), digest_tree(swapped)) == ["2026-01-07"]
    empty = frame.limit(0)
    assert changed_days(digest_tree(empty), digest_tree(empty)) == [] and len(changed_days(digest_tree(empty), digest_tree(frame))) == 41


def test_only_the_changed_day_is_read(spark, frame, tmp_path):
    rows = frame.filter("ts IS NOT NULL").drop("registers")
    tables.write_partitioned(rows, f"{tmp_path}/a")
    changed = rows.withColumn("x", F.when(F.col("ts") == ts_lit(datetime(2026, 1, 3, 5)), 99.0).otherwise(F.col("x")))
    tables.write_partitioned(changed, f"{tmp_path}/b")
    a, b = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    kept = (spark.createDataFrame(digest_tree(rows).collect(), digest_tree(rows).schema), digest_tree(changed))
    found = content_differences(a, b, ["site_id", "ts"], ["x"], kept, day="dt")
    assert [(r["ts"], r["b"], r["class"]) for r in found.collect()] == [(datetime(2026, 1, 3, 5), 99.0, "differ")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"PartitionFilters: \[[^\]]*2026-01-03", plan) or "dt#" in plan and "2026-01-03" in plan
    assert "2026-01-04" not in plan


def test_export_is_verified_by_what_was_written(spark, frame, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows = frame.drop("registers")
    once = rows.mapInArrow(counted, rows.schema)
    version = snapshots.export_verified(once, str(tmp_path), T0)
    assert calls.value == rows.count()  # the result was computed once
    assert changed_days(digest_tree(spark.read.parquet(f"{tmp_path}/{version}")), digest_tree(rows)) == []
    unsteady = rows.limit(0)
    assert snapshots.export_verified(unsteady, str(tmp_path), T0 + timedelta(seconds=1)).endswith("000001")
