"""What was known when: revisions of price and weather documents, copies of old ones, documents that are read once."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hearthwatt.functions.timeparts import ts_lit
from hearthwatt.sources import imports, revisions, versions

DAY = datetime(2026, 3, 2)


def prices(name, revision, made, points, day=DAY, zone="Z", resolution="PT15M", hours=2):
    made = f"<createdDateTime>{made:%Y-%m-%dT%H:%M:%SZ}</createdDateTime>" if made else ""
    listed = "".join(f"<Point><position>{i}</position><price.amount>{p}</price.amount></Point>" for i, p in points.items())
    return (f'<?xml version="1.0" encoding="UTF-8"?>\n<Publication_MarketDocument xmlns="urn:x"><mRID>{name}</mRID><revisionNumber>{revision}</revisionNumber>{made}'
            f'<TimeSeries><in_Domain.mRID codingScheme="A01">{zone}</in_Domain.mRID><Period><timeInterval><start>{day:%Y-%m-%dT%H:%MZ}</start>'
            f"<end>{day + timedelta(hours=hours):%Y-%m-%dT%H:%MZ}</end></timeInterval><resolution>{resolution}</resolution>{listed}</Period></TimeSeries>"
            "</Publication_MarketDocument>")


def store(spark, tmp_path):
    revisions.store_dayahead(spark, str(tmp_path / "in"), str(tmp_path / "known"), str(tmp_path / "checkpoint"))
    return versions.read(spark, str(tmp_path / "known"))


def as_known(rows, at=None):
    return [r["price_eur_per_mwh"] for r in revisions.known_prices(rows, at).orderBy("ts").collect()]


def test_newest_document_decides(spark, tmp_path):
    (tmp_path / "in").mkdir()
    first, second = prices("a", 1, DAY - timedelta(hours=12), {1: 10, 2: 11, 5: 14}), prices("a", 2, DAY - timedelta(hours=6), {1: 20, 8: 27})
    (tmp_path / "in" / "2.xml").write_text(second)
    rows = store(spark, tmp_path)
    assert as_known(rows) == [20.0] * 7 + [27.0]
    (tmp_path / "in" / "1.xml").write_text(first)  # the older document lands later
    rows = store(spark, tmp_path)
    assert rows.count() == 16 and as_known(rows) == [20.0] * 7 + [27.0]
    assert as_known(rows, DAY - timedelta(hours=7)) == [10.0, 11.0, 11.0, 11.0, 14.0, 14.0, 14.0, 14.0]
    assert as_known(rows, DAY - timedelta(hours=13)) == []


def test_copies_change_nothing_and_nothing_is_read_twice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    first, second = prices("a", 1, DAY - timedelta(hours=12), {1: 10}), prices("a", 2, DAY - timedelta(hours=6), {1: 20})
    (tmp_path / "in" / "1.xml").write_text(first)
    (tmp_path / "in" / "2.xml").write_text(second)
    before = sorted(map(tuple, store(spark, tmp_path).collect()), key=repr)
    number = versions.load(spark, str(tmp_path / "known")).number
    store(spark, tmp_path)  # nothing has landed: no batch, no version
    assert versions.load(spark, str(tmp_path / "known")).number == number
    (tmp_path / "in" / "copy.xml").write_text(first)
    os.utime(tmp_path / "in" / "copy.xml")
    after = store(spark, tmp_path)
    assert sorted(map(tuple, after.collect()), key=repr) == before and as_known(after) == [20.0] * 8


def test_ties_hours_and_odd_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    made = DAY - timedelta(hours=12)
    for name, text in {"hour": prices("h", 1, made, {1: 1, 2: 2}, zone="H", resolution="PT60M"), "r1": prices("t", 1, made, {1: 1}), "r2": prices("t", 2, made, {1: 5}),
                       "twice": prices("d", 1, made, {1: 3}, zone="D").replace("</Point>", "</Point><Point><position>1</position><price.amount>9</price.amount></Point>", 1),
                       "month": prices("m", 1, made, {1: 1}, zone="M", resolution="P1M"), "none": prices("n", 1, made, {}, zone="N"),
                       "empty": prices("e", 1, made, {1: 1}, zone="E", hours=0)}.items():
        (tmp_path / "in" / f"{name}.xml").write_text(text)
    rows = store(spark, tmp_path)
    assert as_known(rows.filter("zone = 'H'")) == [1.0] * 4 + [2.0] * 4
    assert as_known(rows.filter("zone = 'Z'")) == [5.0] * 8
    assert as_known(rows.filter("zone = 'D'")) == [3.0] * 8
    assert as_known(rows.filter("zone = 'N'")) == [None] * 8
    assert rows.filter("ts IS NULL").select("zone").distinct().count() == 2 and as_known(rows.filter("zone IN ('M', 'E')")) == []


def test_document_without_a_time_counts_from_its_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(prices("a", 1, None, {1: 10}))
    at = datetime(2026, 3, 1, 12)
    os.utime(tmp_path / "in" / "a.xml", (at.timestamp(), at.timestamp()))
    seconds = store(spark, tmp_path).select(F.unix_seconds(F.convert_timezone(F.lit("UTC"), F.current_timezone(), "known_from").cast("timestamp"))).first()[0]
    assert seconds == int(at.timestamp())


def test_price_job(spark, tmp_path):
    """The job upserts the days on which something new is known, and fills a gap at midnight from the day before."""
    root, inbox = str(tmp_path / "root"), tmp_path / "in"
    inbox.mkdir()
    run = lambda at: imports.import_dayahead_documents(spark, str(inbox), root, at).count()
    (inbox / "1.xml").write_text(prices("a", 1, DAY - timedelta(hours=36), {1: 1, 96: 96}, day=DAY - timedelta(days=1), hours=24))
    assert run(DAY - timedelta(hours=30)) == 0
    (inbox / "2.xml").write_text(prices("b", 1, DAY - timedelta(hours=12), {3: 7}))
    assert run(DAY) == 0
    got = {r["ts"]: (r["price_eur_per_mwh"], r["updated_at"]) for r in imports.stored_table(spark, root, "prices").collect()}
    assert len(got) == 96 + 8 and [got[DAY + timedelta(minutes=15 * i)][0] for i in range(4)] == [96.0, 96.0, 7.0, 7.0]
    assert got[DAY - timedelta(hours=1)][1] == DAY - timedelta(hours=30)  # the day before was read, not written
    number = versions.load(spark, f"{root}/prices").number
    run(DAY + timedelta(hours=1))
    assert versions.load(spark, f"{root}/prices").number == number


def test_weather_documents(spark, tmp_path):
    root, inbox = str(tmp_path / "root"), tmp_path / "in" / "site_id=a"
    inbox.mkdir(parents=True)

    def document(made, values, member=True):
        listed = "".join(f"<b:BsWfsElement><b:Time>{t:%Y-%m-%dT%H:%M:%SZ}</b:Time><b:ParameterName>{n}</b:ParameterName><b:ParameterValue>{v}</b:ParameterValue></b:BsWfsElement>"
                         for t, n, v in values)
        listed = listed.replace("<b:BsWfsElement>", "<w:member><b:BsWfsElement>").replace("</b:BsWfsElement>", "</b:BsWfsElement></w:member>") if member else listed
        return f'<?xml version="1.0"?><w:FeatureCollection xmlns:w="w" xmlns:b="b" timeStamp="{made:%Y-%m-%dT%H:%M:%S.123Z}">{listed}</w:FeatureCollection>'

    hour = DAY + timedelta(hours=5)
    (inbox / "new.xml").write_text(document(DAY, [(hour, "Temperature", 2), (hour, "WindSpeedMS", "NaN"), (hour, "Other", 1)]))
    (inbox / "old.xml").write_text(document(DAY - timedelta(hours=6), [(hour, "Temperature", 1), (hour, "WindSpeedMS", 4), (hour + timedelta(hours=1), "Temperature", 9)], member=False))
    imports.import_forecast_documents(spark, str(tmp_path / "in"), root, DAY)
    rows = imports.stored_table(spark, root, "forecast_hourly").orderBy("ts").collect()
    assert [(r["site_id"], r["ts"], r["temperature_c"], r["wind_speed_ms"], r["cloud_cover_pct"]) for r in rows] == [
        ("a", hour, 2.0, 4.0, None), ("a", hour + timedelta(hours=1), 9.0, None, None)]
    (inbox / "copy.xml").write_text((inbox / "old.xml").read_text())
    imports.import_forecast_documents(spark, str(tmp_path / "in"), root, DAY + timedelta(hours=1))
    again = imports.stored_table(spark, root, "forecast_hourly").orderBy("ts").collect()
    assert [r[:-2] for r in map(tuple, again)] == [r[:-2] for r in map(tuple, rows)]
    known = versions.read(spark, f"{root}/forecast_known")
    assert known.count() == 3 and revisions.known_forecast(known, DAY - timedelta(hours=1)).filter(F.col("ts") == ts_lit(hour)).first()["temperature_c"] == 1.0
