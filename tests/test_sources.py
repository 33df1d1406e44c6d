"""Readers and writers on small files."""

from __future__ import annotations

import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.schemas import COMMANDS, FORECAST_PARAMETERS, INVERTER_DOC, WEATHER_DOC
from hearthwatt.sources import landing, shared, snapshots, tables

PRICES_XML = """<?xml version="1.0" encoding="UTF-8"?>
<Publication_MarketDocument xmlns="urn:iec62325.351:tc57wg16:451-3:publicationdocument:7:3">
  <type>A44</type>
  <TimeSeries>
    <mRID>1</mRID>
    <in_Domain.mRID codingScheme="A01">10Y-TEST</in_Domain.mRID>
    <Period>
      <timeInterval><start>2026-03-01T14:15Z</start><end>2026-03-01T15:30Z</end></timeInterval>
      <resolution>PT15M</resolution>
      <Point><position>2</position><price.amount>130.00</price.amount></Point>
      <Point><position>4</position><price.amount>130.01</price.amount></Point>
    </Period>
  </TimeSeries>
  <TimeSeries>
    <mRID>2</mRID>
    <in_Domain.mRID codingScheme="A01">10Y-OTHER</in_Domain.mRID>
    <Period>
      <timeInterval><start>2026-03-01T14:00Z</start><end>2026-03-01T16:00Z</end></timeInterval>
      <resolution>PT60M</resolution>
      <Point><position>1</position><price.amount>10</price.amount></Point>
      <Point><position>2</position><price.amount>-20.5</price.amount></Point>
    </Period>
  </TimeSeries>
</Publication_MarketDocument>
"""


def element(time: str, name: str, value: str) -> str:
    return (f'<wfs:member><BsWfs:BsWfsElement gml:id="x"><BsWfs:Location><gml:Point><gml:pos>60.3 24.8 </gml:pos></gml:Point></BsWfs:Location>'
            f"<BsWfs:Time>{time}</BsWfs:Time><BsWfs:ParameterName>{name}</BsWfs:ParameterName>"
            f"<BsWfs:ParameterValue>{value}</BsWfs:ParameterValue></BsWfs:BsWfsElement></wfs:member>")


def test_dayahead_documents(spark, tmp_path):
    (tmp_path / "a.xml").write_text(PRICES_XML)
    points, periods = landing.read_dayahead_xml(spark, str(tmp_path))
    got = sorted((r["zone"], r["ts"], r["price_eur_per_mwh"]) for r in points.collect())
    assert got == [("10Y-OTHER", datetime(2026, 3, 1, 14), 10.0), ("10Y-OTHER", datetime(2026, 3, 1, 15), -20.5),
                   ("10Y-TEST", datetime(2026, 3, 1, 14, 30), 130.0), ("10Y-TEST", datetime(2026, 3, 1, 15), 130.01)]
    filled = landing.fill_dayahead(points, periods).orderBy("zone", "ts").collect()
    assert [r["price_eur_per_mwh"] for r in filled] == [10.0] * 4 + [-20.5] * 4 + [None, 130.0, 130.0, 130.01, 130.01]
    assert [r["is_filled"] for r in filled][-5:] == [False, False, True, False, True]


def test_forecast_documents(spark, tmp_path):
    folder = tmp_path / "site_id=a"
    folder.mkdir()
    body = "".join([element("2026-03-01T10:00:00Z", "Temperature", "1.5"), element("2026-03-01T10:00:00Z", "RadiationGlobal", "250.0"),
                    element("2026-03-01T10:00:00Z", "WindSpeedMS", "NaN"), element("2026-03-01T11:00:00Z", "TotalCloudCover", "80")])
    (folder / "f.xml").write_text('<?xml version="1.0"?><wfs:FeatureCollection xmlns:wfs="w" xmlns:BsWfs="b" xmlns:gml="g">' + body + "</wfs:FeatureCollection>")
    rows = landing.read_forecast_xml(spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r["site_id"], r["ts"].hour, r["temperature_c"], r["wind_speed_ms"], r["cloud_cover_pct"], r["shortwave_radiation_w_m2"]) for r in rows] == [
        ("a", 10, 1.5, None, None, 250.0), ("a", 11, None, None, 80.0, None)]


def test_json_landing_keeps_bad_records_apart(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"site_id":"a","ts":"2026-03-01 10:00:00","command":"ALLOW"}\n{"site_id": oops\n')
    good, bad = landing.read_json_landing(spark, str(tmp_path), COMMANDS)
    assert [tuple(r) for r in good.collect()] == [("a", datetime(2026, 3, 1, 10), "ALLOW")]
    assert [r["record"] for r in bad.collect()] == ['{"site_id": oops']


def test_station_and_inverter(spark):
    weather = spark.createDataFrame([("a", datetime(2026, 3, 1, 10, 1), 1.0, 0.0, 50.0, 1000.0, 2.0, 90.0, 0.0),
                                     ("a", datetime(2026, 3, 1, 11, 0), 2.0, 0.0, 50.0, 1000.0, 2.0, 90.0, 0.0)], WEATHER_DOC)
    inverter = spark.createDataFrame([("a", datetime(2026, 3, 1, 10, 0), '{"30775": 500, "30845": "bad", "name": 3}')], INVERTER_DOC)
    near, far = landing.merge_station_and_inverter(weather, inverter).orderBy("ts").collect()
    assert (near["pv_feed_in_w"], near["battery_soc_pct"], near["energy_today_wh"], near["bad_registers"]) == (500, 0, 0, ["30845"])
    assert (far["pv_feed_in_w"], far["inverter_ts"]) == (0, None)


def rows(spark, *data):
    return spark.createDataFrame(list(data), "zone string, ts timestamp_ntz, price double")


def test_stored_upsert(spark, tmp_path):
    path, now = str(tmp_path / "prices"), ts_lit("2026-03-02 00:00:00")
    first = rows(spark, ("Z", datetime(2026, 3, 1, 10), 1.0), ("Z", datetime(2026, 3, 2, 10), 2.0))
    tables.upsert_stored(spark, first, path, ["zone", "ts"], ts_lit("2026-03-01 00:00:00"))
    untouched = {f.name for f in Path(path, "dt=2026-03-01").glob("*.parquet")}
    change = rows(spark, ("Z", datetime(2026, 3, 2, 10), 5.0), ("Z", datetime(2026, 3, 2, 11), 6.0))
    for _ in range(2):
        tables.upsert_stored(spark, change, path, ["zone", "ts"], now)
        got = [(r["ts"], r["price"], r["created_at"], r["updated_at"]) for r in spark.read.parquet(path).orderBy("ts").collect()]
        assert got == [
            (datetime(2026, 3, 1, 10), 1.0, datetime(2026, 3, 1), datetime(2026, 3, 1)),
            (datetime(2026, 3, 2, 10), 5.0, datetime(2026, 3, 1), datetime(2026, 3, 2)),
            (datetime(2026, 3, 2, 11), 6.0, datetime(2026, 3, 2), datetime(2026, 3, 2))]
    assert {f.name for f in Path(path, "dt=2026-03-01").glob("*.parquet")} == untouched
    with pytest.raises(ValueError, match="key"):
        tables.upsert_stored(spark, change, path, ["zone"], now)


def test_stored_insert_ignore(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.insert_ignore_stored(spark, rows(spark, ("Z", datetime(2026, 3, 1, 10), 1.0)), path, ["zone", "ts"], ["price"])
    again = rows(spark, ("Z", datetime(2026, 3, 1, 10), 9.0), ("Z", datetime(2026, 3, 1, 11), 4.0), ("Z", datetime(2026, 3, 1, 11), 3.0))
    tables.insert_ignore_stored(spark, again, path, ["zone", "ts"], ["price"])
    assert [r["price"] for r in spark.read.parquet(path).orderBy("ts").collect()] == [1.0, 3.0]


def test_snapshots(spark, tmp_path):
    root, frame = str(tmp_path), rows(spark, ("Z", datetime(2026, 3, 1, 10), 1.0))
    made = [datetime(2026, 3, 1, 10, m) for m in (0, 15, 30)]
    for i, now in enumerate(made):
        version = snapshots.export_snapshot(frame.withColumn("i", F.lit(i)), root, now)
        if i < 2:
            snapshots.publish_latest(spark, root, version, now)
    assert version == "weather_fusion_20260301_103000"
    assert snapshots.read_latest(spark, root).first()["i"] == 1
    assert snapshots.read_latest(spark, root, now=datetime(2026, 3, 1, 10, 45)).count() == 1
    with pytest.raises(ValueError, match="at most"):
        snapshots.read_latest(spark, root, now=datetime(2026, 3, 1, 10, 46))
    names = [snapshots.version_name(m) for m in made[:2]]
    assert snapshots.drop_versions(spark, root, names) == 1
    assert not Path(root, names[0]).exists() and Path(root, names[1]).exists()


def test_retention_counts_valid_versions_only(spark):
    files = [("dump", f"v{i}", datetime(2026, 3, 1 + i), 0 if i == 4 else 200_000) for i in range(9)]
    manifest = spark.createDataFrame(files, "kind string, version string, created_at timestamp_ntz, size_bytes bigint")
    assert sorted(r["version"] for r in snapshots.retention(manifest, 7, 100_000).collect()) == ["v0", "v4"]
    assert snapshots.retention(manifest, 7, 100_000, kind="export").count() == 0


def test_prune(spark):
    frame = spark.createDataFrame([(datetime(2026, 3, 1, h),) for h in (9, 10, 11)], "ts timestamp_ntz")
    assert snapshots.prune_older_than(frame, ts_lit("2026-03-02 10:00:00")).count() == 2


def test_csv(spark, tmp_path):
    frame = rows(spark, *[("Z", datetime(2026, 3, d, 23), float(d)) for d in (1, 2, 3)])
    tables.export_csv(frame, str(tmp_path / "csv"), "2026-03-01", "2026-03-02")
    lines = sorted(line for f in (tmp_path / "csv").glob("*.csv") for line in f.read_text().splitlines())
    assert lines[0].startswith("2026-03-01") and "ts,zone,price" in lines and sum(not x.startswith("ts") for x in lines) == 2


def test_outbox(spark):
    frame = rows(spark, *[("Z", datetime(2026, 3, d), 1.0) for d in (1, 2, 3)])
    sent = tables.outbox_mark(frame.filter("day(ts) < 3"), ts_lit("2026-03-04 00:00:00"), key=["zone", "ts"])
    assert [r["ts"].day for r in tables.outbox_pending(frame, sent, key=["zone", "ts"]).collect()] == [3]


def test_forecast_runs_are_kept(spark, tmp_path):
    for i in range(2):
        run = spark.createDataFrame([(f"r{i}", "a")], "run_id string, site_id string")
        values = spark.createDataFrame([(f"r{i}", datetime(2026, 3, 1, 10), 1.0)], "run_id string, target_ts timestamp_ntz, yhat_p50 double")
        tables.append_forecast_run(run, values, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "forecast_value")).join(spark.read.parquet(str(tmp_path / "forecast_run")), "run_id").count() == 2


def test_a_repeated_run_adds_nothing(spark, tmp_path):
    run = spark.createDataFrame([("r", "a")], "run_id string, site_id string")
    values = spark.createDataFrame([("r", datetime(2026, 3, 1, h), 1.0) for h in range(4)], "run_id string, target_ts timestamp_ntz, yhat_p50 double")
    for _ in range(2):
        tables.append_forecast_run(run, values, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "forecast_value")).count() == 4
    assert spark.read.parquet(str(tmp_path / "forecast_run")).count() == 1


def test_upsert_refuses_two_updates_of_a_key(spark, tmp_path):
    twice = rows(spark, ("Z", datetime(2026, 3, 1), 1.0), ("Z", datetime(2026, 3, 1), 2.0))
    with pytest.raises(ValueError, match="several updates"):
        tables.upsert_stored(spark, twice, str(tmp_path / "t"), ["zone", "ts"], ts_lit("2026-03-04 00:00:00"))


def test_durations(spark):
    texts = ["PT15M", "PT60M", "PT1H", "P1D", "PT1H30M", "P1DT2H", "PT7M", "P", "PT", "P1M", "x", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(landing.duration_seconds(F.col("t")).alias("s")).collect()
    assert [r["s"] for r in got] == [900, 3600, 3600, 86400, 5400, 93600, 420, None, None, None, None, None]


def test_the_newest_document_counts(spark, tmp_path):
    import os

    for age, name, price, wind in ((200, "z", 9.0, 5.0), (100, "a", 3.0, 3.0)):
        day = tmp_path / "price" / f"{name}.xml"
        day.parent.mkdir(exist_ok=True)
        day.write_text(f"""<D><TimeSeries><in_Domain.mRID>Z</in_Domain.mRID><Period><timeInterval><start>2026-03-01T00:00Z</start>
<end>2026-03-01T01:00Z</end></timeInterval><resolution>PT1H</resolution><Point><position>1</position><price.amount>{price}</price.amount></Point>
</Period></TimeSeries></D>""")
        hour = tmp_path / "weather" / "site_id=a" / f"{name}.xml"
        hour.parent.mkdir(parents=True, exist_ok=True)
        parameter = next(iter(FORECAST_PARAMETERS))
        hour.write_text(f"""<C><BsWfsElement><Time>2026-03-01T00:00:00Z</Time><ParameterName>{parameter}</ParameterName>
<ParameterValue>{wind}</ParameterValue></BsWfsElement></C>""")
        for path in (day, hour):
            os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))
    points, periods = landing.read_dayahead_xml(spark, str(tmp_path / "price"))
    assert [r["price_eur_per_mwh"] for r in points.collect()] == [3.0]
    assert [r["price_eur_per_mwh"] for r in landing.fill_dayahead(points, periods).collect()] == [3.0] * 4
    [forecast] = landing.read_forecast_xml(spark, str(tmp_path / "weather")).collect()
    assert forecast[FORECAST_PARAMETERS[next(iter(FORECAST_PARAMETERS))]] == 3.0


def test_commands_round_trip(spark, tmp_path):
    path = str(tmp_path / "commands")
    sent = spark.createDataFrame([("a", datetime(2026, 3, 29, 3, 30), "ALLOW")], COMMANDS)
    landing.write_commands(sent, path)
    query = landing.read_commands(spark, path).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", datetime(2026, 3, 29, 3, 30), "ALLOW")]


def test_archives_are_moved_when_imported(spark, tmp_path):
    inbox, done = tmp_path / "inbox", tmp_path / "processed"
    schema = rows(spark, ("Z", datetime(2026, 3, 1, 10), 1.0)).schema
    for day in (1, 2, 3):
        rows(spark, ("Z", datetime(2026, 3, day), float(day))).coalesce(1).write.mode("append").parquet(str(inbox))
        query = landing.read_archive(spark, str(inbox), schema, str(done)).writeStream.foreachBatch(
            lambda batch, _: tables.insert_ignore_stored(batch.sparkSession, batch, str(tmp_path / "raw"), ["zone", "ts"], ["price"])
        ).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 3
    assert list(done.rglob("*.parquet"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_upserts_read_only_the_days_around_the_updates(spark, tmp_path):
    path, now = str(tmp_path / "t"), ts_lit("2026-03-09 00:00:00")
    first = rows(spark, *[("Z", datetime(2026, 3, d), float(d)) for d in range(1, 9)], ("Z", None, 0.5))
    tables.upsert_stored(spark, first, path, ["zone", "ts"], now)
    change = rows(spark, ("Z", datetime(2026, 3, 4), 40.0), ("Z", None, 0.7))
    touched = tables._touched(spark.read.parquet(path), change)
    scan = next(x for x in touched._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    assert "PartitionFilters: [(isnull(dt" in scan and " >= 2026-03-04" in scan and " <= 2026-03-04" in scan
    assert touched.count() == 2
    tables.upsert_stored(spark, change, path, ["zone", "ts"], now)
    assert sorted(r["price"] for r in spark.read.parquet(path).collect()) == [0.5, 0.7, 1.0, 2.0, 3.0, 5.0, 6.0, 7.0, 8.0, 40.0]
    assert not list(Path(shared.shared_root(spark)).glob("hearthwatt/staging-*"))


def test_the_log_of_versions_stays_short(spark, tmp_path):
    root, frame = str(tmp_path), rows(spark, ("Z", datetime(2026, 3, 1, 10), 1.0))
    for minute in range(6):
        now = datetime(2026, 3, 1, 10, minute)
        snapshots.publish_latest(spark, root, snapshots.export_snapshot(frame, root, now), now)
        logged = snapshots.published(spark, root).select(F.lit("export").alias("kind"), "version", F.col("published_at").alias("created_at"), "size_bytes")
        old = snapshots.retention(logged, 2, min_bytes=1).collect()
        assert len(old) <= 1 and snapshots.drop_versions(spark, root, [r["version"] for r in old]) == len(old)
    left = snapshots.published(spark, root).collect()
    assert sorted(r["version"][-2:] for r in left) == ["00", "00"] and len(left) == 2 and all(r["size_bytes"] > 0 for r in left)
    assert sorted(p.name for p in tmp_path.iterdir()) == [snapshots.POINTER, *[snapshots.version_name(datetime(2026, 3, 1, 10, m)) for m in (4, 5)]]


def test_a_row_a_year_late_does_not_read_the_year(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [datetime(2025, 3, 4), *(datetime(2025, 3 + m, 1) for m in range(1, 9)), datetime(2026, 3, 4)]
    tables.upsert_stored(spark, rows(spark, *[("Z", d, 1.0) for d in days]), path, ["zone", "ts"], ts_lit("2026-03-09 00:00:00"))
    change = rows(spark, ("Z", days[0], 40.0), ("Z", days[-1], 50.0))
    touched = tables._touched(spark.read.parquet(path), change)
    assert {r["ts"] for r in touched.collect()} == {days[0], days[-1]}
    kept = touched._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"IN \(2025-03-04, ?2026-03-04\)", kept), kept
