"""Versioned days: pinned readers, killed and competing writers, repeated batches, expiry; sums of late rows."""

from __future__ import annotations

import random
import time
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.operators.averaging import avg_15min
from hearthwatt.operators.partials import add_partials, means_of_partials, slot_partials
from hearthwatt.schemas import ALLOWED_AVERAGES, TELEMETRY
from hearthwatt.sources import imports, shared, versions
from hearthwatt.streaming.jobs import start_partials, start_upserts

KEY = ["zone", "ts"]
T0, T1 = "2026-03-01 00:00:00", "2026-03-02 00:00:00"


def prices(spark, *data):
    return spark.createDataFrame([("Z", *row) for row in data], "zone string, ts timestamp_ntz, price double")


def at(day: int, hour: int = 10) -> datetime:
    return datetime(2026, 3, day, hour)


def state(frame):
    return sorted((r["ts"].day, r["ts"].hour, r["price"]) for r in frame.collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "prices")
    versions.upsert_versioned(spark, prices(spark, (at(1), 1.0), (at(2), 2.0), (at(3), 3.0)), path, KEY, ts_lit(T0))
    return path


def test_pinned_reader_sees_old_days_whole(spark, table):
    before = versions.read(spark, table)
    old_files = {p for p in Path(table).rglob("*.parquet")}
    versions.upsert_versioned(spark, prices(spark, (at(2), 5.0), (at(2, 11), 6.0)), table, KEY, ts_lit(T1))
    assert state(before) == [(1, 10, 1.0), (2, 10, 2.0), (3, 10, 3.0)]
    after = versions.read(spark, table)
    assert state(after) == [(1, 10, 1.0), (2, 10, 5.0), (2, 11, 6.0), (3, 10, 3.0)]
    rows = {(r["ts"], r["created_at"], r["updated_at"]) for r in after.filter("dt = '2026-03-02'").collect()}
    assert rows == {(at(2), at(1, 0), at(2, 0)), (at(2, 11), at(2, 0), at(2, 0))}
    # Copy on write: no file was changed, and only the touched day was written again.
    new = {p for p in Path(table).rglob("*.parquet")} - old_files
    assert old_files <= {p for p in Path(table).rglob("*.parquet")} and {p.parent.name for p in new} == {"dt=2026-03-02"}
    assert state(versions.read(spark, table, versions.load(spark, table, 0))) == state(before)


def test_only_named_days_are_read(spark, table):
    assert {Path(f).parent.name for f in versions.read(spark, table, days=[date(2026, 3, 2), date(2026, 3, 9)]).inputFiles()} == {"dt=2026-03-02"}
    assert versions.read(spark, table, days=[]).count() == 0
    assert versions.read(spark, table, days=[date(2026, 3, 9)]).columns == ["zone", "ts", "price", "created_at", "updated_at", "dt"]


def test_killed_writer_shows_nothing(spark, table):
    before = state(versions.read(spark, table))
    versions.stage(spark, versions.read(spark, table).drop("dt").withColumn("price", F.lit(0.0)), table)  # killed before its commit
    Path(table, "versions", "draft-1").write_text("{")  # killed while it wrote the version
    assert versions.load(spark, table).number == 0 and state(versions.read(spark, table)) == before
    versions.upsert_versioned(spark, prices(spark, (at(3), 9.0)), table, KEY, ts_lit(T1))
    assert versions.expire(spark, table) == 0  # young: a writer may be about to commit it
    assert versions.expire(spark, table, keep=5, min_age_seconds=0, now=time.time() + 5) == 1
    assert not list(Path(table, "versions").glob("draft-*"))
    assert state(versions.read(spark, table)) == [(1, 10, 1.0), (2, 10, 2.0), (3, 10, 9.0)]
    assert state(versions.read(spark, table, versions.load(spark, table, 0))) == before


def test_failed_upsert_cleans_up(spark, table):
    files = set(Path(table).rglob("*.parquet"))
    broken = prices(spark, (at(1), 7.0)).withColumn("price", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        versions.upsert_versioned(spark, broken, table, KEY, ts_lit(T1))
    with pytest.raises(ValueError, match="several updates"):
        versions.upsert_versioned(spark, prices(spark, (at(1), 7.0), (at(1), 8.0)), table, KEY, ts_lit(T1))
    with pytest.raises(ValueError, match="other columns"):
        versions.merge(spark, table, prices(spark, (at(1), 7.0)), lambda old, new: new.withColumn("more", F.lit(1)))
    assert set(Path(table).rglob("*.parquet")) == files and versions.load(spark, table).number == 0
    assert not list(Path(shared.shared_root(spark), "hearthwatt").glob("changes-*/*.parquet"))


def test_two_writers(spark, table):
    """Both read version 0. The second finds version 1 and works on it, so neither update is lost."""
    overtaken = []

    def slow(old, new):
        if not overtaken:
            overtaken.append(versions.upsert_versioned(spark, prices(spark, (at(1), 8.0)), table, KEY, ts_lit(T1)).number)
        return old.drop("price").join(new.select(*KEY, "price"), KEY).select(old.columns)

    made = versions.merge(spark, table, prices(spark, (at(1), 4.0)), slow)
    assert overtaken == [1] and made.number == 2
    assert [tuple(r) for r in versions.read(spark, table, days=[date(2026, 3, 1)]).select("price", "updated_at").collect()] == [(4.0, at(2, 0))]
    assert len(list(Path(table, "data").iterdir())) == 3  # the days built on version 0 are gone
    with pytest.raises(versions.Conflict):
        versions.commit(spark, table, versions.load(spark, table, 1), versions.Staged("x", ("2026-03-01",), made.schema))


def test_repeated_batches(spark, table):
    for batch, price in ((0, 4.0), (1, 5.0), (1, 99.0), (0, 99.0), (2, 6.0)):
        versions.upsert_versioned(spark, prices(spark, (at(1), price)), table, KEY, ts_lit(T1), source=("s", batch))
    assert state(versions.read(spark, table))[0] == (1, 10, 6.0) and versions.load(spark, table).number == 3
    empty = prices(spark, (at(1), 1.0)).filter("false")
    assert versions.upsert_versioned(spark, empty, table, KEY, ts_lit(T1)).number == 3
    assert versions.upsert_versioned(spark, empty, table, KEY, ts_lit(T1), source=("s", 3)).sources == {"s": 3}
    assert len(state(versions.read(spark, table))) == 3


def test_rows_without_a_time_and_first_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    for price in (1.0, 2.0):
        versions.insert_versioned(spark, prices(spark, (None, price), (at(1), price)), path, KEY, ["price"])
    rows = sorted((r["ts"], r["price"]) for r in versions.read(spark, path).collect() if r["ts"])
    assert rows == [(at(1), 1.0)] and None in {r["dt"] for r in versions.read(spark, path, days=[None]).collect()}


def test_streamed_upserts_are_versions(spark, tmp_path):
    for i, rows in enumerate(([(at(1), 1.0), (at(2), 2.0)], [(at(1), 3.0)])):
        prices(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("zone string, ts timestamp_ntz, price double").parquet(str(tmp_path / "in"))
        for _ in range(2):
            start_upserts(stream, str(tmp_path / "t"), str(tmp_path / "c"), KEY, now=T0, versioned=True).awaitTermination()
        assert versions.load(spark, str(tmp_path / "t")).number == i
    assert state(versions.read(spark, str(tmp_path / "t"))) == [(1, 10, 3.0), (2, 10, 2.0)]


# ---- sums of late rows -------------------------------------------------------------------------------------------

def raw(spark, times, value=lambda i: float(i % 17)):
    """Rows of two sites with some missing readings and registers."""
    data = [(f"s{i % 2}", t, None if i % 5 == 0 else value(i), 3.0 + i % 4, None if i % 7 == 0 else float(i * 37 % 360),
             None if i % 6 == 0 else {"30775": float(i), "1": None if i % 4 else 2.0}) for i, t in enumerate(times)]
    frame = spark.createDataFrame(data, "site_id string, ts timestamp_ntz, temperature_c double, wind_speed_ms double, "
                                        "wind_direction_deg double, registers map<string,double>")
    return frame.select([(F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TELEMETRY])


def means(frame):
    out = {}
    for r in frame.collect():
        out[r["site_id"], r["ts"]] = {
            k: ({n: v if v is None else round(v, 7) for n, v in r[k].items()} if k == "registers" and r[k] is not None
                else round(r[k], 7) if isinstance(r[k], float) else r[k]) for k in frame.columns if k in ("rows_used", *ALLOWED_AVERAGES)}
    return out


def test_pieces_in_any_order_give_the_means(spark):
    times = [at(1, 0) + timedelta(minutes=7 * i) for i in range(300)]
    rows = raw(spark, times)
    pieces = None
    for part in range(4):
        new = slot_partials(rows.filter(F.pmod(F.xxhash64("ts"), F.lit(4)) == part), ALLOWED_AVERAGES)
        pieces = new if pieces is None else add_partials(pieces, new)
    assert means(means_of_partials(pieces, ALLOWED_AVERAGES)) == means(avg_15min(rows, ALLOWED_AVERAGES))
    empty = rows.filter("false")
    assert means_of_partials(slot_partials(empty, ALLOWED_AVERAGES), ALLOWED_AVERAGES).count() == 0


def test_late_batches_through_the_jobs(spark, tmp_path):
    """Random late archives: the published means equal a full recompute, and a run reads the days that have changed only."""
    root, inbox, rng = str(tmp_path / "root"), str(tmp_path / "inbox"), random.Random(3)
    start, now = at(1, 0), at(4, 12) + timedelta(minutes=7)
    times = [start + timedelta(minutes=11 * i) for i in range(500)]
    rows = raw(spark, times).cache()
    rng.shuffle(times)
    landed = []
    for first in range(0, 500, 170):
        some = times[first:first + 170]
        landed += some
        rows.filter(F.col("ts").isin([ts_lit(t) for t in (some + landed[:20])])).coalesce(1).write.mode("append").parquet(inbox)
        imports.import_archives(spark, inbox, root, averaged=ALLOWED_AVERAGES)
        imports.publish_station_means(spark, root, now)
        whole = avg_15min(rows.filter(F.col("ts").isin([ts_lit(t) for t in landed])), ALLOWED_AVERAGES).filter(F.col("ts") <= ts_lit(at(4, 12)))
        assert means(imports.stored_table(spark, root, "station_15min")) == means(whole.drop("rows_used"))
    assert imports.publish_station_means(spark, root, now) == ["2026-03-04"]  # its slots were not complete
    late = raw(spark, [at(2, 3) + timedelta(seconds=5)])
    late.coalesce(1).write.mode("append").parquet(inbox)
    imports.import_archives(spark, inbox, root, averaged=ALLOWED_AVERAGES)
    assert imports.publish_station_means(spark, root, now) == ["2026-03-02", "2026-03-04"]
    # Half an hour later the day in progress has more complete slots, though nothing has landed.
    count = imports.stored_table(spark, root, "station_15min").count()
    imports.publish_station_means(spark, root, now + timedelta(hours=9))
    assert imports.stored_table(spark, root, "station_15min").count() > count


def test_streamed_pieces(spark, tmp_path):
    rows = raw(spark, [at(1, 0) + timedelta(minutes=3 * i) for i in range(200)])
    rows.repartition(3, "ts").write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(TELEMETRY).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        start_partials(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert versions.load(spark, str(tmp_path / "t")).number == 2
    got = means_of_partials(versions.read(spark, str(tmp_path / "t")), ALLOWED_AVERAGES)
    assert means(got) == means(avg_15min(rows, ALLOWED_AVERAGES))


def test_versioned_jobs(spark, tmp_path):
    """The jobs find versioned tables by themselves; a plain table stays what it is."""
    root = str(tmp_path / "root")
    imports.prepare_versioned(spark, root)
    rows = prices(spark, (at(1), 1.0))
    imports._upsert(spark, rows, f"{root}/prices", KEY, at(1, 0))
    assert imports.stored_table(spark, root, "prices").count() == 1 and versions.load(spark, f"{root}/prices").number == 1
    rows.write.parquet(f"{root}/plain")
    with pytest.raises(ValueError, match="no versions"):
        versions.create(spark, f"{root}/plain")
    assert imports.stored_table(spark, root, "plain").count() == 1


def test_clean_up(spark, table, tmp_path, monkeypatch):
    """Runs leave folders in the shared folder, which go by their age; old versions go with what only they name."""
    monkeypatch.setattr(shared, "shared_root", lambda _: str(tmp_path / "shared"))  # other tests still read theirs
    root = tmp_path / "shared" / "hearthwatt"
    imports._upsert(spark, prices(spark, (at(1), 7.0)), table, KEY, at(2, 0))
    folder = Path(shared.run_folder(spark, "left-behind"))
    prices(spark, (at(1), 1.0)).write.parquet(str(folder))
    assert folder.exists() and imports.clean_up(spark, str(tmp_path), keep=1) == 0 and folder.exists()
    later = time.time() + 5
    assert shared.sweep(spark, 0, later) >= 1 and not list(root.iterdir()) and shared.sweep(spark, 0, later) == 0
    assert versions.expire(spark, table, 1, 0, later) == 1  # the first state of the day that was upserted
    assert state(versions.read(spark, table)) == [(1, 10, 7.0), (2, 10, 2.0), (3, 10, 3.0)]
