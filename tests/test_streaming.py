"""Streams in several batches against their batch form."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.operators.averaging import avg_15min
from hearthwatt.operators.control import command_intervals
from hearthwatt.plans.stream_queries import with_custom_state
from hearthwatt.schemas import SCALARS
from hearthwatt.streaming import jobs

T0 = datetime(2026, 3, 29, 0, 0)


def land(spark, frame, folder, parts):
    """Write files that a stream with one file per batch reads in time order."""
    for i, (lo, hi) in enumerate(parts):
        frame.filter((F.col("minute") >= lo) & (F.col("minute") < hi)).drop("minute").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return jobs.read_rows(spark, f"{folder}/in", frame.drop("minute").schema, files_per_batch=1)


def run(spark, stream, folder):
    jobs.start_files(stream, f"{folder}/out", f"{folder}/cp").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def minutes(spark, n=600):
    base = spark.range(n).select(F.col("id").alias("minute"), F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("site_id"),
                                 F.timestamp_add("MINUTE", F.col("id"), ts_lit(T0)).alias("ts"))
    numbers = {c: (F.col("minute") % (7 + i)).cast("double") for i, c in enumerate(SCALARS)}
    return base.withColumns({**numbers, "wind_speed_ms": F.lit(3.0), "wind_direction_deg": (F.col("minute") % 360).cast("double"),
                             "registers": F.create_map(F.lit("30517"), F.col("minute").cast("double"))})


def test_stream_means_equal_batch_means(spark, tmp_path):
    frame = minutes(spark)
    stream = land(spark, frame, tmp_path, [(0, 200), (200, 400), (400, 600)])
    cols = [*SCALARS, "wind_speed_ms", "wind_direction_deg"]
    got = run(spark, jobs.stream_avg_15min(stream, "30 minutes"), tmp_path)
    want = avg_15min(frame, cols).filter(F.col("ts") <= ts_lit(T0 + timedelta(minutes=599 - 30)))
    key = lambda df: sorted((r["site_id"], r["ts"], r["rows_used"], *(round(r[c], 6) for c in cols)) for r in df.collect())
    assert key(got) == key(want) and got.count() > 50


def test_stream_register_means(spark, tmp_path):
    frame = minutes(spark, 120)
    got = run(spark, jobs.stream_avg_registers(land(spark, frame, tmp_path, [(0, 60), (60, 120)]), "10 minutes"), tmp_path)
    first = got.filter("site_id = 's0'").orderBy("ts").first()
    assert (first["ts"], first["register"], first["mean"]) == (T0 + timedelta(minutes=15), "30517", 7.0)


def test_stream_dedupe(spark, tmp_path):
    frame = minutes(spark, 60).select("minute", "site_id", ts_lit(T0).alias("ts"))
    got = run(spark, jobs.stream_dedupe(land(spark, frame, tmp_path, [(0, 30), (30, 60)])), tmp_path)
    assert got.count() == 2


def commands(spark):
    texts = ["PROHIBIT_30", "ALLOW", "PROHIBIT_10", "PROHIBIT", "PROHIBIT_20", "nonsense", "PROHIBIT_720"]
    data = [(i * 17, f"s{i % 2}", T0 + timedelta(minutes=i * 17), texts[i % len(texts)]) for i in range(60)]
    # A late site moves the watermark past all open prohibitions.
    data.append((60 * 17 + 2000, "end", T0 + timedelta(minutes=60 * 17 + 2000), "ALLOW"))
    return spark.createDataFrame(data, "minute int, site_id string, ts timestamp_ntz, command string")


@pytest.mark.parametrize("parts", [[(0, 10**6)], [(0, 300), (300, 310), (310, 700), (700, 10**6)]])
def test_auto_revert_equals_intervals(spark, tmp_path, parts):
    frame = commands(spark)
    stream = land(spark, frame, tmp_path, parts)
    got = with_custom_state(spark, lambda: run(spark, jobs.stream_command_state(stream), tmp_path))
    out = sorted((r["site_id"], r["ts"], r["mode"], r["cause"]) for r in got.collect())
    want = []
    for r in command_intervals(frame.drop("minute")).collect():
        want.append((r["site_id"], r["start_ts"], r["mode"], "command"))
        timed = r["command"].startswith("PROHIBIT_")
        if timed and r["end_ts"] == r["start_ts"] + timedelta(minutes=int(r["command"][9:])):
            want.append((r["site_id"], r["end_ts"], "ALLOW", "timeout"))
    assert out == sorted(want)
    assert any(c == "timeout" for *_, c in out)


@pytest.mark.parametrize("parts", [[(0, 10**6)], [(0, 100), (100, 220), (220, 10**6)]])
def test_stale_alerts(spark, tmp_path, parts):
    at = [("a", m) for m in (0, 10, 20, 200, 210)] + [("b", m) for m in range(0, 1000, 50)]
    frame = spark.createDataFrame([(m, s, T0 + timedelta(minutes=m)) for s, m in at], "minute int, site_id string, ts timestamp_ntz")
    stream = land(spark, frame, tmp_path, parts)
    got = with_custom_state(spark, lambda: run(spark, jobs.stream_stale_alerts(stream, 60), tmp_path))
    out = sorted((r["site_id"], r["ts"], r["last_seen_ts"]) for r in got.collect())
    assert out == [("a", T0 + timedelta(minutes=m + 60), T0 + timedelta(minutes=m)) for m in (20, 210)]


def test_late_rows_correct_what_was_stored(spark, tmp_path):
    frame = spark.createDataFrame([(0, "Z", T0, 1.0), (1, "Z", T0 + timedelta(minutes=15), 2.0), (2, "Z", T0, 3.0)],
                                  "minute int, zone string, ts timestamp_ntz, price double")
    stream = land(spark, frame, tmp_path, [(0, 2), (2, 3)])
    means = stream.groupBy("zone", "ts").agg(F.avg("price").alias("price"))
    for _ in range(2):
        jobs.start_upserts(means, f"{tmp_path}/t", f"{tmp_path}/cp2", ["zone", "ts"], now="2026-04-01 00:00:00").awaitTermination()
    assert [r["price"] for r in spark.read.parquet(f"{tmp_path}/t").orderBy("ts").collect()] == [2.0, 2.0]


def test_retained_command_over_batches(spark, tmp_path):
    frame = commands(spark)
    stream = jobs.stream_retained(land(spark, frame, tmp_path, [(0, 300), (300, 10**6)]))
    jobs.start_batches(stream, f"{tmp_path}/r", f"{tmp_path}/cp3").awaitTermination()
    got = {r["site_id"]: (r["ts"], r["command"]) for r in jobs.read_retained(spark, f"{tmp_path}/r").collect()}
    assert got == {r["site_id"]: (r["ts"], r["command"]) for r in frame.groupBy("site_id").agg(
        F.max("ts").alias("ts"), F.max_by("command", "ts").alias("command")).collect()}


def test_outbox_hands_over_each_row_once(spark, tmp_path):
    frame, sent = minutes(spark, 40).select("minute", "site_id", "ts"), []
    stream = land(spark, frame, tmp_path, [(0, 20), (20, 40)])
    for _ in range(2):
        jobs.start_outbox(stream, lambda batch: sent.append(batch.count()), f"{tmp_path}/cp4").awaitTermination()
    assert sent == [20, 20]


def test_a_late_command_does_not_go_back(spark, tmp_path):
    at = lambda m, ms=0: T0 + timedelta(minutes=m, milliseconds=ms)
    data = [(0, "a", at(60), "PROHIBIT_30"), (1, "a", at(58), "ALLOW"), (0, "b", at(60, 100), "PROHIBIT"), (0, "b", at(60, 200), "ALLOW"),
            (1, "b", at(59), "PROHIBIT_5"), (2, "end", at(300), "ALLOW")]
    frame = spark.createDataFrame(data, "minute int, site_id string, ts timestamp_ntz, command string")
    stream = land(spark, frame, tmp_path, [(0, 1), (1, 2), (2, 3)])
    got = with_custom_state(spark, lambda: run(spark, jobs.stream_command_state(stream), tmp_path)).collect()
    assert sorted((r["ts"], r["mode"], r["cause"]) for r in got if r["site_id"] == "a") == [
        (at(58), "ALLOW", "command"), (at(60), "PROHIBIT", "command"), (at(90), "ALLOW", "timeout")]
    assert [(r["ts"], r["mode"]) for r in sorted(got, key=lambda r: r["ts"]) if r["site_id"] == "b"] == [
        (at(59), "PROHIBIT"), (at(60, 100), "PROHIBIT"), (at(60, 200), "ALLOW")]


def test_commands_of_one_millisecond(spark, tmp_path):
    """Order counts to the microsecond, as in the intervals."""
    at = lambda us: T0 + timedelta(minutes=60, microseconds=us)
    data = [(0, "a", at(100), "PROHIBIT"), (0, "a", at(300), "ALLOW"), (0, "b", at(300), "PROHIBIT_1"), (0, "b", at(100), "ALLOW"), (0, "c", at(7), "PROHIBIT_1"),
            (1, "end", T0 + timedelta(minutes=300), "ALLOW")]
    frame = spark.createDataFrame(data, "minute int, site_id string, ts timestamp_ntz, command string")
    got = with_custom_state(spark, lambda: run(spark, jobs.stream_command_state(land(spark, frame, tmp_path, [(0, 1), (1, 2)])), tmp_path)).collect()
    of = lambda site: [(r["ts"], r["mode"], r["cause"]) for r in sorted(got, key=lambda r: r["ts"]) if r["site_id"] == site]
    assert of("a") == [(at(100), "PROHIBIT", "command"), (at(300), "ALLOW", "command")]
    assert of("b") == [(at(100), "ALLOW", "command"), (at(300), "PROHIBIT", "command"), (at(300 + 60_000_000), "ALLOW", "timeout")]
    assert of("c")[1] == (at(7 + 60_000_000), "ALLOW", "timeout")


def test_restart_from_the_log_equals_intervals(spark, tmp_path):
    frame, split = commands(spark), T0 + timedelta(minutes=500)
    later = land(spark, frame.filter(F.col("ts") >= ts_lit(split)), tmp_path, [(0, 700), (700, 10**6)])
    history = jobs.command_states(frame.filter(F.col("ts") < ts_lit(split)).drop("minute"), split)
    got = with_custom_state(spark, lambda: run(spark, jobs.stream_command_state(later, history=history), tmp_path))
    want = []
    for r in command_intervals(frame.drop("minute")).collect():
        want.append((r["site_id"], r["start_ts"], r["mode"], "command"))
        if r["command"].startswith("PROHIBIT_") and r["end_ts"] == r["start_ts"] + timedelta(minutes=int(r["command"][9:])):
            want.append((r["site_id"], r["end_ts"], "ALLOW", "timeout"))
    out = sorted((r["site_id"], r["ts"], r["mode"], r["cause"]) for r in got.collect())
    assert out == sorted(x for x in want if x[1] >= split) and len({x[0] for x in out if x[3] == "timeout"}) == 2
