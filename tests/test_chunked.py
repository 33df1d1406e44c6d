"""Chunked operators against plain loops, with one hot site, gaps longer than a chunk and tiny chunks."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import slot_floor
from hearthwatt.operators import averaging, chunked, consumption, control, grid, keyed, scoring

START = datetime(2026, 3, 27)
HOUR, DAY = 3600, 86400
LENGTHS = [(), (HOUR,), (7 * HOUR, 3 * DAY), (DAY,), (HOUR, 5 * HOUR, 10 * DAY)]


def series(seed: int, n: int = 260) -> list[tuple]:
    """Slots of three sites, two thirds of them of one; some missing, some with a NULL value."""
    rng = random.Random(seed)
    out = []
    for site, share in (("hot", 0.67), ("b", 0.2), ("c", 0.13)):
        slot = 0
        for _ in range(int(n * share)):
            slot += rng.choice([1, 1, 1, 1, 2, 3, 40]) if rng.random() < 0.95 else 300
            value = None if rng.random() < 0.3 else round(rng.random() * 9000, 2)
            out.append((site, START + timedelta(minutes=15 * slot), value, rng.choice(["x", "x", "y"])))
    rng.shuffle(out)
    return out


@pytest.fixture(params=[1, 2])
def data(request):
    return series(request.param)


def frame(spark, data):
    return spark.createDataFrame(data, "site_id string, ts timestamp_ntz, w double, cls string")


def by_site(data):
    out: dict[str, list] = {}
    for row in sorted(data, key=lambda r: (r[0], r[1])):
        out.setdefault(row[0], []).append(row)
    return out


def collected(df, *cols):
    return sorted(tuple(r) for r in df.select("site_id", "ts", *cols).collect())


@pytest.mark.parametrize("lengths", LENGTHS)
def test_neighbours(spark, data, lengths):
    out = chunked.neighbours(frame(spark, data), ["site_id"], "ts", {"pw": "w", "pt": "ts"}, {"nc": "cls", "nt": "ts"}, lengths)
    want = []
    for site, rows in by_site(data).items():
        for i, row in enumerate(rows):
            before, after = rows[i - 1] if i else None, rows[i + 1] if i + 1 < len(rows) else None
            want.append((site, row[1], before and before[2], before and before[1], after and after[3], after and after[1]))
    key = repr
    assert sorted(map(key, collected_raw(out, "pw", "pt", "nc", "nt"))) == sorted(map(key, want))


def collected_raw(df, *cols):
    return [tuple(r) for r in df.select("site_id", "ts", *cols).collect()]


@pytest.mark.parametrize("lengths", LENGTHS)
def test_fill_forward(spark, data, lengths):
    out = chunked.fill_forward(frame(spark, data), ["site_id"], "ts", {"filled": "w"}, lengths)
    want = []
    for site, rows in by_site(data).items():
        last = None
        for row in rows:
            last = row[2] if row[2] is not None else last
            want.append((site, row[1], last))
    assert sorted(map(repr, collected_raw(out, "filled"))) == sorted(map(repr, want))


@pytest.mark.parametrize("lengths", LENGTHS)
def test_running_total(spark, data, lengths):
    out = chunked.running_total(frame(spark, data).withColumn("y", (F.col("cls") == "y").cast("int")), ["site_id"], "ts", {"n": "y"}, lengths)
    want = []
    for site, rows in by_site(data).items():
        total = 0
        for row in rows:
            total += row[3] == "y"
            want.append((site, row[1], total))
    assert collected(out, "n") == sorted(want)


@pytest.mark.parametrize("length", [HOUR, 7 * HOUR, DAY, 30 * DAY])
def test_event_islands(spark, data, length):
    out = consumption.event_islands(frame(spark, data), "cls", length=length)
    want = []
    for site, rows in by_site(data).items():
        number = 0
        for i, row in enumerate(rows):
            same = i and rows[i - 1][3] == row[3] and row[1] - rows[i - 1][1] <= timedelta(minutes=15)
            number += not same
            want.append((site, row[1], number))
    assert collected(out, "event_id") == sorted(want)


@pytest.mark.parametrize("length", [DAY, 3 * DAY, 30 * DAY])
def test_reference_load(spark, data, length):
    out = consumption.reference_load(frame(spark, data), "w", 24, length=length)
    want = {}
    for site, rows in by_site(data).items():
        for row in rows:
            near = [r[2] for r in rows if abs(r[1] - row[1]) <= timedelta(hours=24) and r[2] is not None]
            want[site, row[1]] = statistics.median(near) if near else None
    got = {(r["site_id"], r["ts"]): r["reference_w"] for r in out.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == (None if want[k] is None else pytest.approx(want[k])) for k in want)


@pytest.mark.parametrize("hours, length", [(24, DAY), (24, 7 * DAY), (168, 7 * DAY)])
def test_rolling_error(spark, data, hours, length):
    pairs = frame(spark, data).select("site_id", "ts", F.col("w").alias("yhat_p50"), F.lit(100.0).alias("actual"))
    got = {(r["site_id"], r["ts"]): r for r in scoring.rolling_error(pairs, hours, length=length).collect()}
    assert len(got) == len(data)
    for site, rows in by_site(data).items():
        for row in rows:
            e = [r[2] - 100 for r in rows if timedelta(0) <= row[1] - r[1] <= timedelta(hours=hours) and r[2] is not None]
            assert got[site, row[1]]["n_pairs"] == len(e)
            if e:
                assert got[site, row[1]]["mae"] == pytest.approx(sum(map(abs, e)) / len(e))
                assert got[site, row[1]]["bias"] == pytest.approx(sum(e) / len(e))


@pytest.mark.parametrize("lengths", [(60, DAY), (6 * HOUR,)])
def test_merge_latest(spark, data, lengths):
    left = frame(spark, [r for i, r in enumerate(data) if i % 2]).select("site_id", "ts", "cls")
    right = frame(spark, [r for i, r in enumerate(data) if i % 3]).select("site_id", "ts", "w")
    out = averaging.merge_latest(left, right, 7200, lengths=lengths)
    rights = by_site([r for i, r in enumerate(data) if i % 3])
    want = []
    for site, ts, _, cls in (r for i, r in enumerate(data) if i % 2):
        found = [r for r in rights.get(site, []) if timedelta(0) <= ts - r[1] <= timedelta(hours=2)]
        want.append((site, ts, cls, found[-1][1] if found else None, found[-1][2] if found else None))
    assert sorted(map(repr, collected_raw(out, "cls", "right_ts", "w"))) == sorted(map(repr, want))


def test_command_state(spark, data):
    text = F.when(F.col("cls") == "y", F.lit("PROHIBIT_50")).when(F.col("w") > 4000, F.lit("PROHIBIT")).otherwise(F.lit("ALLOW"))
    commands = frame(spark, data).select("site_id", F.timestamp_add("MINUTE", F.lit(7), F.col("ts")).alias("ts"), text.alias("command"))
    slots = grid.span_grid(commands.select("site_id", slot_floor("ts").alias("ts")), ["site_id"])
    given = by_site([(r["site_id"], r["ts"], None, r["command"]) for r in commands.collect()])
    for row in control.command_state(commands, slots).collect():
        earlier = [r for r in given[row["site_id"]] if r[1] <= row["ts"]]
        mode = "ALLOW"
        if earlier:
            _, since, _, command = earlier[-1]
            over = command == "PROHIBIT_50" and since + timedelta(minutes=50) <= row["ts"]
            mode = "ALLOW" if over or command == "ALLOW" else "PROHIBIT"
        assert row["mode"] == mode


@pytest.mark.parametrize("salts", [1, 7])
def test_newest_n(spark, data, salts):
    got = collected(keyed.newest_n(frame(spark, data), ["site_id"], ["ts"], 5, salts))
    assert got == sorted((site, r[1]) for site, rows in by_site(data).items() for r in rows[-5:])


def test_spread_join_is_a_join(spark, data):
    left = frame(spark, data)
    right = spark.createDataFrame([("hot", 1), ("b", 2)], "site_id string, k int")
    for how in ("left", "inner"):
        plain = left.join(right, "site_id", how)
        assert collected(chunked.spread_join(left, right, ["site_id"], ["ts"], how, 5), "k") == collected(plain, "k")


def test_dedupe_picks_one_row_of_many_copies(spark):
    copies = spark.range(20000).select(F.lit("hot").alias("site_id"), (F.col("id") % 3).alias("k"), (F.col("id") % 100).alias("at"),
                                       F.create_map(F.lit("r"), F.col("id")).alias("m"))
    out = keyed.dedupe(copies, ["site_id", "k"], ["at"])
    assert [r["at"] for r in out.orderBy("k").collect()] == [99, 99, 99]
    again = keyed.dedupe(copies.repartition(13), ["site_id", "k"], ["at"])
    assert sorted(map(repr, out.collect())) == sorted(map(repr, again.collect()))


def test_coverage_and_missing_add_up(spark, data):
    rows = frame(spark, data)
    slots = grid.span_grid(rows, ["site_id"])
    missing = grid.missing_slots(rows, slots).count()
    assert missing + rows.count() == slots.count()
    assert missing == grid.find_gaps(rows).agg(F.sum("n_missing")).first()[0]


def test_components_add_up(spark, data):
    load = frame(spark, data).select("site_id", "ts", F.col("w").alias("total_actual_w"))
    for row in consumption.consumption_components(load).collect():
        parts = [row[c] for c in consumption.COMPONENTS[1:]]
        if row["total_actual_w"] is None:
            assert parts == [None] * 4
        else:
            assert sum(parts) == pytest.approx(row["total_actual_w"]) and all(p >= 0 for p in parts)


@pytest.mark.parametrize("lengths", LENGTHS)
def test_rows_without_site_or_time_stay_and_give_nothing(spark, data, lengths):
    lost = [("hot", None, 7.0, "x"), ("hot", None, 8.0, "x"), (None, START, 9.0, "y"), (None, START + timedelta(minutes=15), None, "y"), (None, None, 5.0, None)]
    clean, mixed = frame(spark, data), frame(spark, data + lost)
    for run, column in ((lambda df: chunked.neighbours(df, ["site_id"], "ts", {"out": "w"}, {"after": "w"}, lengths), "out"),
                        (lambda df: chunked.last_before(df, ["site_id"], "ts", {"out": "w"}, lengths), "out"),
                        (lambda df: chunked.total_before(df, ["site_id"], "ts", {"out": "w"}, lengths), "out")):
        got, want = (sorted(repr((r["site_id"], r["ts"], r["w"], r["out"] and round(r["out"], 4))) for r in run(df).collect())
                     for df in (mixed, clean))
        assert got == sorted(want + [repr((site, ts, w, None)) for site, ts, w, _ in lost])
    filled = chunked.fill_forward(mixed, ["site_id"], "ts", {"out": "w"}, lengths).filter("site_id IS NULL OR ts IS NULL")
    assert sorted(repr(r["out"]) for r in filled.collect()) == sorted(repr(w) for _, _, w, _ in lost)


def test_components_keep_rows_without_site_or_time(spark, data):
    lost = [("hot", None, 7.0, "x"), (None, START, 9.0, "y"), (None, None, 5.0, None)]
    loads = lambda rows: frame(spark, rows).withColumnRenamed("w", "total_actual_w")
    got, want = (consumption.consumption_components(loads(rows)).collect() for rows in (data + lost, data))
    unplaced = [r for r in got if r["site_id"] is None or r["ts"] is None]
    assert len(got) == len(want) + len(lost) and len(unplaced) == len(lost)
    assert all(r["total_actual_w"] and r["event_id"] is None and r["baseline_actual_w"] is None for r in unplaced)
    assert sorted(map(repr, (r for r in got if r not in unplaced))) == sorted(map(repr, want))
