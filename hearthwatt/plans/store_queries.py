"""Queries that go through stored tables: versions, revisions of documents, sums of late rows, models, round trips."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timeparts import ts_lit, with_slot
from ..operators.averaging import select_allowed
from ..operators.digest import content_differences
from ..operators.keyed import newest_per_target
from ..operators.partials import means_of_partials
from ..schemas import ALLOWED_AVERAGES, COMMANDS, FORECAST_COLUMNS, FORECAST_PARAMETERS, MEASURED, TELEMETRY
from ..sources import imports, landing, models, revisions, snapshots, tables, versions
from ..sources.shared import run_folder
from ..streaming.jobs import start_partials
from . import adapters as a
from .adapters import SQL, STATION, ctes, table
from .home_queries import COMPONENTS, TZ, components
from .registry import query, rounded, sql_round as r

NOW = datetime(2024, 1, 31)


# ---- versions ----------------------------------------------------------------------------------------------------

_EARLY, _LATE = "2024-01-30 00:00:00", "2024-01-31 00:00:00"
SQL["first_prices"] = """
SELECT 'Z' || (user_id % 2) AS zone, time_bucket(INTERVAL 15 MINUTES, ts) AS ts, avg(value) AS price FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2"""
SQL["later_prices"] = """
SELECT 'Z' || (user_id % 2) AS zone, time_bucket(INTERVAL 15 MINUTES, ts) AS ts, avg(value) AS price FROM events
WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1, 2"""


def _prices(ev: DataFrame) -> DataFrame:
    zone = F.concat(F.lit("Z"), (F.col("user_id") % 2).cast("string")).alias("zone")
    return with_slot(ev, "ts", "15 minutes", "slot").groupBy(zone, "slot").agg(F.avg("value").alias("price")).withColumnRenamed("slot", "ts")


@query("versioned_upsert", ctes("first_prices", "later_prices") + f"""
SELECT 'before' AS reader, zone, ts, {r('price', 5)} AS price, TIMESTAMP '{_EARLY}' AS created_at, TIMESTAMP '{_EARLY}' AS updated_at FROM first_prices
UNION ALL
SELECT 'after', zone, ts, {r('coalesce(l.price, f.price)', 5)}, CASE WHEN f.price IS NOT NULL THEN TIMESTAMP '{_EARLY}' ELSE TIMESTAMP '{_LATE}' END,
  CASE WHEN l.price IS NOT NULL THEN TIMESTAMP '{_LATE}' ELSE TIMESTAMP '{_EARLY}' END
FROM first_prices f FULL JOIN later_prices l USING (zone, ts)""")
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reader opens the table before an upsert and reads afterwards, one opens it after a writer that never commits."""
    path, ev = f"{run_folder(spark, 'versioned')}/prices", table(spark, sf_dir, "events")
    versions.upsert_versioned(spark, _prices(ev.filter("event_id % 2 = 0")), path, ["zone", "ts"], ts_lit(_EARLY))
    before = versions.read(spark, path)
    versions.upsert_versioned(spark, _prices(ev.filter("ts >= '2024-01-20'")), path, ["zone", "ts"], ts_lit(_LATE))
    versions.stage(spark, before.withColumn("price", F.lit(0.0)), path)
    both = before.withColumn("reader", F.lit("before")).unionByName(versions.read(spark, path).withColumn("reader", F.lit("after")))
    return rounded(both.drop(versions.DT), {"price": 5})


# ---- sums of late rows -------------------------------------------------------------------------------------------

SQL["registers_15min"] = """
SELECT site_id, time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES AS ts, avg(r30517) AS r30517, avg(r30775) AS r30775
FROM telemetry GROUP BY 1, 2"""
_MEANS = {**{c: 4 for c in MEASURED}, "r30517": 5, "r30775": 5}


def _raw(rows: DataFrame) -> DataFrame:
    """Telemetry as archives hold it."""
    return rows.select([(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TELEMETRY])


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.telemetry(spark, sf_dir).select("event_id", "site_id", "ts", *MEASURED, "registers")


def _with_registers(means: DataFrame) -> DataFrame:
    return means.select("site_id", "ts", "rows_used", *MEASURED, F.element_at("registers", "30517").alias("r30517"),
                        F.element_at("registers", "30775").alias("r30775"))


@query("incremental_means", ctes(*STATION, "registers_15min") + "SELECT site_id, ts, rows_used, " + ", ".join(
    f"{r(c, d)} AS {c}" for c, d in _MEANS.items()) + " FROM station JOIN registers_15min USING (site_id, ts)")
def incremental_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in four batches that each hold rows of every day, added to the pieces of their slots."""
    folder = run_folder(spark, "incremental")
    rows = _telemetry(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in MEASURED})
    rows.repartition(4, F.xxhash64("event_id")).drop("event_id").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.drop("event_id").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    start_partials(stream, f"{folder}/pieces", f"{folder}/checkpoint").awaitTermination()
    means = means_of_partials(versions.read(spark, f"{folder}/pieces"), ALLOWED_AVERAGES)
    return rounded(_with_registers(means), _MEANS)


# ---- revisions of documents --------------------------------------------------------------------------------------

#: Of a day's events the first document knows a third, the second two thirds, the third all. Each is made five hours after the one before.
_REVISIONS, _HOURS = 3, 5
_KNOWN_AT = ("2024-01-10 00:00:00", "2024-01-15 07:00:00", "2024-02-10 00:00:00")


def _document(content: Column, made: Column) -> Column:
    stamp = F.date_format(made, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat(F.lit("<Publication_MarketDocument><mRID>"), F.col("zone"), F.lit("-"), F.col("day").cast("string"), F.lit("</mRID><revisionNumber>"),
                    F.col("revision").cast("string"), F.lit("</revisionNumber><createdDateTime>"), stamp, F.lit("</createdDateTime>"), content,
                    F.lit("</Publication_MarketDocument>"))


def _price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``revision, value``: day-ahead documents of each zone and day, made of the events, with left-out points."""
    ev = with_slot(table(spark, sf_dir, "events"), "ts", "15 minutes", "slot")
    zone = F.concat(F.lit("Z"), (F.col("user_id") % 2).cast("string")).alias("zone")
    each = ev.withColumn("revision", F.explode(F.sequence((F.col("event_id") % _REVISIONS).cast("int"), F.lit(_REVISIONS - 1))))
    points = each.groupBy(zone, F.col("slot").cast("date").alias("day"), "revision", "slot").agg(F.avg("value").alias("price"))
    position = ((F.hour("slot") * 60 + F.minute("slot")) / 15 + 1).cast("int")
    days = points.groupBy("zone", "day", "revision").agg(F.sort_array(F.collect_list(F.struct(position.alias("position"), "price"))).alias("points"))
    listed = F.array_join(F.transform("points", lambda p: F.concat(
        F.lit("<Point><position>"), p["position"].cast("string"), F.lit("</position><price.amount>"), p["price"].cast("string"),
        F.lit("</price.amount></Point>"))), "")
    midnight = lambda days: F.concat(F.date_add("day", days).cast("string"), F.lit("T00:00Z"))
    body = F.concat(F.lit('<TimeSeries><in_Domain.mRID codingScheme="A01">'), F.col("zone"), F.lit("</in_Domain.mRID><Period><timeInterval><start>"),
                    midnight(0), F.lit("</start><end>"), midnight(1), F.lit("</end></timeInterval><resolution>PT15M</resolution>"), listed,
                    F.lit("</Period></TimeSeries>"))
    made = F.timestamp_add("HOUR", F.col("revision") * _HOURS, F.col("day").cast("timestamp_ntz"))
    return days.select("revision", _document(body, made).alias("value"))


def _landed_prices(spark: SparkSession, sf_dir: str, read) -> str:
    """Land all but the last revisions, read them, land these and copies of the first ones, read again; returns the folder."""
    folder, documents = run_folder(spark, "documents"), _price_documents(spark, sf_dir)
    for landed in (F.col("revision") < _REVISIONS - 1, F.col("revision") != 1):
        documents.filter(landed).select("value").write.mode("append").option("maxRecordsPerFile", 1).text(f"{folder}/inbox")
        read(f"{folder}/inbox", folder)
    return folder


SQL["price_days"] = f"""
SELECT 'Z' || (user_id % 2) AS zone, CAST(ts AS DATE) AS day, v.revision, time_bucket(INTERVAL 15 MINUTES, ts) AS ts, avg(value) AS price
FROM events JOIN (SELECT unnest(range({_REVISIONS})) AS revision) v ON event_id % {_REVISIONS} <= v.revision GROUP BY 1, 2, 3, 4"""
SQL["price_slots"] = """
SELECT d.zone, d.day, d.revision, d.day + INTERVAL 15 MINUTE * q.i AS ts, p.price
FROM (SELECT DISTINCT zone, day, revision FROM price_days) d CROSS JOIN (SELECT unnest(range(96)) AS i) q
LEFT JOIN price_days p ON p.zone = d.zone AND p.revision = d.revision AND p.ts = d.day + INTERVAL 15 MINUTE * q.i"""


def _known_sql(known_at: str) -> str:
    return f"""
SELECT TIMESTAMP '{known_at}' AS known_at, zone, ts, {r('last_value(price IGNORE NULLS) OVER (PARTITION BY zone ORDER BY ts)', 5)} AS price_eur_per_mwh
FROM (SELECT * FROM price_slots WHERE day + INTERVAL {_HOURS} HOUR * revision <= TIMESTAMP '{known_at}'
  QUALIFY row_number() OVER (PARTITION BY zone, ts ORDER BY revision DESC) = 1)"""


@query("dayahead_as_known", ctes("price_days", "price_slots") + " UNION ALL ".join(_known_sql(at) for at in _KNOWN_AT))
def dayahead_as_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as they were known at three moments."""
    folder = _landed_prices(spark, sf_dir, lambda inbox, root: revisions.store_dayahead(spark, inbox, f"{root}/known", f"{root}/checkpoint"))
    rows, out = versions.read(spark, f"{folder}/known"), None
    for at in _KNOWN_AT:
        one = revisions.known_prices(rows, at).select(ts_lit(at).alias("known_at"), "zone", "ts", "price_eur_per_mwh")
        out = one if out is None else out.unionByName(one)
    return rounded(out, {"price_eur_per_mwh": 5})


@query("dayahead_import", ctes("price_days", "price_slots") + f"""
SELECT zone, ts, {r('last_value(price IGNORE NULLS) OVER (PARTITION BY zone ORDER BY ts)', 5)} AS price_eur_per_mwh FROM price_slots
WHERE revision = {_REVISIONS - 1}""")
def dayahead_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prices that the job has stored after both landings."""
    folder = _landed_prices(spark, sf_dir, lambda inbox, root: imports.import_dayahead_documents(spark, inbox, root, NOW))
    return rounded(imports.stored_table(spark, folder, "prices").select("zone", "ts", "price_eur_per_mwh"), {"price_eur_per_mwh": 5})


_HOURLY = {"temperature_c": 5, "wind_speed_ms": 5, "wind_direction_deg": 5, "cloud_cover_pct": 5, "shortwave_radiation_w_m2": 4}
SQL["forecast_days"] = """
SELECT event_type AS site_id, CAST(ts AS DATE) AS day, v.revision, time_bucket(INTERVAL 1 HOUR, ts) AS ts, avg(value) AS m
FROM events JOIN (SELECT unnest(range(2)) AS revision) v ON event_id % 2 <= v.revision GROUP BY 1, 2, 3, 4"""


@query("forecast_import", ctes("forecast_days") + f"""
SELECT site_id, ts, {r('m', 5)} AS temperature_c, {r('m / 8', 5)} AS wind_speed_ms, {r('m * 3', 5)} AS wind_direction_deg, {r('m / 2', 5)} AS cloud_cover_pct,
  {r('first_m * 10', 4)} AS shortwave_radiation_w_m2
FROM (SELECT d.*, f.m AS first_m FROM forecast_days d LEFT JOIN forecast_days f ON f.site_id = d.site_id AND f.ts = d.ts AND f.revision = 0
  WHERE d.revision = 1)""")
def forecast_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents of two revisions per site and day; the second leaves out the radiation, of which the first one's stays."""
    folder = run_folder(spark, "weather")
    ev = with_slot(table(spark, sf_dir, "events"), "ts", "1 hour", "hour")
    each = ev.withColumn("revision", F.explode(F.sequence((F.col("event_id") % 2).cast("int"), F.lit(1))))
    hours = each.groupBy(F.col("event_type").alias("site_id"), F.col("hour").cast("date").alias("day"), "revision", "hour").agg(F.avg("value").alias("m"))
    scales = {"temperature_c": 1.0, "wind_speed_ms": 1 / 8, "wind_direction_deg": 3.0, "cloud_cover_pct": 0.5, "shortwave_radiation_w_m2": 10.0}
    stamp = F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def element(name: str, column: str) -> Column:
        text = F.concat(F.lit("<w:member><b:BsWfsElement><b:Time>"), stamp, F.lit(f"</b:Time><b:ParameterName>{name}</b:ParameterName><b:ParameterValue>"),
                        (F.col("m") * scales[column]).cast("string"), F.lit("</b:ParameterValue></b:BsWfsElement></w:member>"))
        return F.when(F.col("revision") == 0, text).otherwise("") if column == "shortwave_radiation_w_m2" else text

    parts = F.concat(*[element(name, column) for name, column in FORECAST_PARAMETERS.items() if column in scales])
    made = F.date_format(F.timestamp_add("HOUR", F.col("revision") * _HOURS, F.col("day").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    documents = hours.groupBy("site_id", "day", "revision").agg(F.array_join(F.sort_array(F.collect_list(parts)), "").alias("body")).select(
        "site_id", "revision", F.concat(F.lit('<w:FeatureCollection xmlns:w="w" xmlns:b="b" timeStamp="'), made, F.lit('">'), F.col("body"),
                                        F.lit("</w:FeatureCollection>")).alias("value"))
    for landed in (F.col("revision") == 1, F.col("revision") == 0):  # the older documents come last
        documents.filter(landed).select("site_id", "value").write.mode("append").option("maxRecordsPerFile", 1).partitionBy("site_id").text(f"{folder}/inbox")
        imports.import_forecast_documents(spark, f"{folder}/inbox", folder, NOW)
    return rounded(imports.stored_table(spark, folder, "forecast_hourly").select("site_id", "ts", *FORECAST_COLUMNS), _HOURLY)


# ---- models ------------------------------------------------------------------------------------------------------

_WEEKS = ("2024-01-15", "2024-01-22", "2024-01-29")


def _promotion_sql() -> str:
    ends = ", ".join(f"({k + 1}, TIMESTAMP '{end}')" for k, end in enumerate(_WEEKS))
    out = ctes(*COMPONENTS) + f""", ends AS (SELECT * FROM (VALUES {ends}) t(k, until)),
cells AS (SELECT site_id, ts, event_class, dayofweek(l) AS weekday, hour(l) * 4 + minute(l) // 15 AS slot
  FROM (SELECT *, timezone('{TZ}', timezone('UTC', ts)) AS l FROM components)),
model AS (SELECT k AS m, site_id, weekday, slot, event_class AS event_type FROM (
  SELECT k, site_id, weekday, slot, event_class, 100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY k, site_id, weekday, slot) AS pct
  FROM cells JOIN ends ON ts >= until - INTERVAL {7 * (models.WEEKS + 1)} DAYS AND ts < until - INTERVAL 7 DAYS GROUP BY 1, 2, 3, 4, 5)
  WHERE event_class <> 'none' AND pct >= {models.THRESHOLD_PCT}),
week AS (SELECT k AS v, cells.* FROM cells JOIN ends ON ts >= until - INTERVAL 7 DAYS AND ts < until),
predicted AS (SELECT m, v, site_id, ts, event_type FROM week JOIN model USING (site_id, weekday, slot) WHERE m <= v),
actual AS (SELECT e.k AS m, v, site_id, ts, event_class AS event_type FROM week JOIN ends e ON e.k <= v WHERE event_class <> 'none'),
score AS (SELECT m, v, event_type, 2 * count(*) FILTER (WHERE p AND q) / (2 * count(*) FILTER (WHERE p AND q) + count(*) FILTER (WHERE p IS NULL OR q IS NULL)) AS f1
  FROM (SELECT *, true AS p FROM predicted) FULL JOIN (SELECT *, true AS q FROM actual) USING (m, v, site_id, ts, event_type) GROUP BY 1, 2, 3),
force0 AS (SELECT CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS INTEGER) AS cur WHERE false)"""
    for k in range(1, len(_WEEKS) + 1):
        out += f""",
log{k} AS (SELECT {k} AS k, event_type, n.f1, cur, o.f1 AS cur_f1, n.f1 IS NOT NULL AND (cur IS NULL OR coalesce(n.f1 >= o.f1, false)) AS promoted
  FROM (SELECT * FROM score WHERE m = {k} AND v = {k}) n
  FULL JOIN (SELECT score.* FROM score JOIN force{k - 1} USING (event_type) WHERE m = cur AND v = {k}) o USING (event_type)
  LEFT JOIN force{k - 1} USING (event_type)),
force{k} AS (SELECT event_type, coalesce(max(CASE WHEN promoted THEN {k} END), max(cur)) AS cur FROM (
  SELECT event_type, promoted, CAST(NULL AS INTEGER) AS cur FROM log{k} UNION ALL SELECT event_type, false, cur FROM force{k - 1}) GROUP BY 1
  HAVING coalesce(max(CASE WHEN promoted THEN {k} END), max(cur)) IS NOT NULL)"""
    name = lambda k: f"'events_' || strftime(({k}), '%Y%m%d_%H%M%S')"
    logs = " UNION ALL ".join(f"SELECT * FROM log{k}" for k in range(1, len(_WEEKS) + 1))
    return out + f"""
SELECT {name('e.until')} AS version, e.until AS ts, l.event_type, {r('f1', 6)} AS f1, {name('c.until')} AS current_version, {r('cur_f1', 6)} AS current_f1,
  promoted, coalesce(f.cur = l.k, false) AS in_force
FROM ({logs}) l JOIN ends e ON e.k = l.k LEFT JOIN ends c ON c.k = l.cur LEFT JOIN force{len(_WEEKS)} f ON f.event_type = l.event_type"""


@query("model_promotion", _promotion_sql())
def model_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three weekly runs, the second of them twice, with the score of each candidate and of the model in force."""
    root, parts = run_folder(spark, "models"), components(spark, sf_dir)
    for end in (_WEEKS[0], _WEEKS[1], _WEEKS[1], _WEEKS[2]):
        models.retrain(spark, root, parts, datetime.fromisoformat(end), TZ)
    log = models.model_log(spark, root)
    force = models.current_versions(log).withColumn("in_force", F.lit(True))
    return rounded(log.join(force, ["event_type", "version"], "left").withColumn("in_force", F.coalesce("in_force", F.lit(False))),
                   {"f1": 6, "current_f1": 6})


# ---- contents ----------------------------------------------------------------------------------------------------

_CELLS = ["temperature_c", "pv_feed_in_w"]
_FLIPPED, _LOST = "CAST(ts AS DATE) = DATE '2024-01-17' AND site_id = 'click'", "CAST(ts AS DATE) = DATE '2024-01-20' AND hour(ts) = 5"


@query("content_parity", ctes(*STATION) + ", found AS (" + " UNION ALL ".join(f"""
SELECT site_id, ts, '{c}' AS "column", {r(c, 4)} AS a, CASE WHEN {_LOST} THEN NULL ELSE {r(f'{c} + 0.5', 4)} END AS b,
  CASE WHEN {_LOST} THEN 'left_only' ELSE 'differ' END AS class FROM station WHERE {_LOST}{f' OR {_FLIPPED}' if c == 'temperature_c' else ''}""" for c in _CELLS) + """)
SELECT * FROM found""")
def content_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table and a copy in which one reading of a site is changed on one day and an hour is missing on another."""
    folder = run_folder(spark, "parity")
    station = a.station(spark, sf_dir, _CELLS).select("site_id", "ts", *_CELLS)
    tables.write_partitioned(station, f"{folder}/left")
    left = spark.read.parquet(f"{folder}/left")
    flipped = F.when(F.expr(_FLIPPED), F.col("temperature_c") + 0.5).otherwise(F.col("temperature_c"))
    tables.write_partitioned(left.drop("dt").filter(f"NOT ({_LOST})").withColumn("temperature_c", flipped), f"{folder}/right")
    cells = content_differences(left, spark.read.parquet(f"{folder}/right"), ["site_id", "ts"], _CELLS, day="dt")
    return rounded(cells.drop("diff"), {"a": 4, "b": 4})


# ---- round trips -------------------------------------------------------------------------------------------------

@query("archive_import", ctes("telemetry") + f"""
SELECT site_id, ts, {r('temperature_c', 5)} AS temperature_c, CAST(energy_today_wh AS BIGINT) AS energy_today_wh, {r('r30517', 3)} AS r30517 FROM telemetry""")
def archive_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives that overlap, read twice: every raw row is stored once."""
    folder, rows = run_folder(spark, "archives"), _telemetry(spark, sf_dir)
    for part in (rows.filter("event_id % 3 < 2"), rows.filter("event_id % 3 > 0")):
        _raw(part).write.mode("append").parquet(f"{folder}/inbox")
        imports.import_archives(spark, f"{folder}/inbox", folder)
    return rounded(spark.read.parquet(f"{folder}/telemetry_raw").select(
        "site_id", "ts", "temperature_c", "energy_today_wh", F.element_at("registers", "30517").alias("r30517")), {"temperature_c": 5, "r30517": 3})


@query("json_landing", ctes("commands") + """
SELECT c.site_id, c.ts, c.command, CAST(NULL AS VARCHAR) AS record FROM commands c JOIN events e ON e.ts = c.ts AND e.event_type = c.site_id
WHERE event_id % 7 <> 0
UNION ALL SELECT NULL, NULL, NULL, '{"site_id": oops ' || event_id FROM events WHERE event_id % 7 = 0""")
def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted records, every seventh of them broken: what fits the schema, and the text of what does not."""
    folder, ev = run_folder(spark, "posted"), table(spark, sf_dir, "events")
    text = F.to_json(F.struct(F.col("site_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), F.col("command")))
    broken = ev.filter("event_id % 7 = 0").select(F.concat(F.lit('{"site_id": oops '), F.col("event_id").cast("string")).alias("value"))
    sound = a.commands_from(ev.filter("event_id % 7 <> 0")).select(text.alias("value"))
    sound.unionByName(broken).write.text(folder)
    good, bad = landing.read_json_landing(spark, folder, COMMANDS)
    return good.withColumn("record", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


@query("csv_round_trip", ctes("prices") + f"""
SELECT ts, zone, {r('price_eur_per_mwh', 5)} AS price_eur_per_mwh FROM prices WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV of a range of dates, read again."""
    folder = run_folder(spark, "csv")
    tables.export_csv(a.prices(spark, sf_dir).select("zone", "ts", "price_eur_per_mwh"), folder, "2024-01-05", "2024-01-12")
    return rounded(spark.read.option("header", True).schema("ts timestamp_ntz, zone string, price_eur_per_mwh double").csv(folder), {"price_eur_per_mwh": 5})


@query("snapshot_round_trip", ctes("prices") + f"""
SELECT zone, ts, {r('price_eur_per_mwh', 5)} AS price_eur_per_mwh, minutes, minutes > 30 AS refused
FROM prices CROSS JOIN (VALUES (10), (30), (31)) t(minutes)""")
def snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published version and not the newer one that is not published; one that is over half an hour old is refused."""
    root, rows = run_folder(spark, "snapshots"), a.prices(spark, sf_dir).select("zone", "ts", "price_eur_per_mwh")
    version = snapshots.export_snapshot(rows, root, NOW)
    snapshots.publish_latest(spark, root, version, NOW)
    snapshots.export_snapshot(rows.limit(1), root, NOW + timedelta(minutes=5))
    refused = []
    for minutes in (10, 30, 31):
        try:
            snapshots.read_latest(spark, root, NOW + timedelta(minutes=minutes))
            refused.append((minutes, False))
        except ValueError:
            refused.append((minutes, True))
    verdicts = spark.createDataFrame(refused, "minutes int, refused boolean")
    each = snapshots.read_latest(spark, root).withColumn("minutes", F.explode(F.array(*[F.lit(m) for m, _ in refused])))
    return rounded(each.join(verdicts, "minutes"), {"price_eur_per_mwh": 5})


@query("forecast_run_store", ctes("runs", "run_values") + f"""
SELECT site_id, target, target_ts, run_id, issued_at, {r('yhat_p50', 4)} AS yhat_p50, {r('yhat_p10', 4)} AS yhat_p10, {r('yhat_p90', 4)} AS yhat_p90
FROM run_values JOIN runs USING (site_id, run_id) QUALIFY row_number() OVER (PARTITION BY site_id, target, target_ts ORDER BY issued_at DESC, run_id DESC) = 1""")
def forecast_run_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that are stored one after another, some of them twice, and the newest value of each slot."""
    root, runs, values = run_folder(spark, "runs"), a.runs(spark, sf_dir), a.run_values(spark, sf_dir)
    for some in ("0 1 2", "2 3", "4 0"):
        mine = F.substring_index("run_id", "-", -1).isin(some.split())
        tables.append_forecast_run(runs.filter(mine), values.filter(mine), root)
    best = newest_per_target(spark.read.parquet(f"{root}/forecast_value").drop("dt"), spark.read.parquet(f"{root}/forecast_run"))
    return rounded(best, {"yhat_p50": 4, "yhat_p10": 4, "yhat_p90": 4})


@query("command_files", ctes("commands") + "SELECT * FROM commands")
def command_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands written as JSON files and read from them as a stream."""
    folder = run_folder(spark, "command-files")
    landing.write_commands(a.commands(spark, sf_dir), f"{folder}/in")
    (landing.read_commands(spark, f"{folder}/in").writeStream.format("parquet").option("path", f"{folder}/out")
     .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(COMMANDS).parquet(f"{folder}/out")


@query("allowed_columns", ctes("telemetry") + f"""
SELECT site_id, ts, {r('temperature_c', 5)} AS temperature_c, {r('wind_speed_ms', 5)} AS wind_speed_ms, {r('pv_feed_in_w', 4)} AS pv_feed_in_w FROM telemetry""")
def allowed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = select_allowed(a.telemetry(spark, sf_dir), ["temperature_c", "wind_speed_ms", "pv_feed_in_w"])
    return rounded(out, {"temperature_c": 5, "wind_speed_ms": 5, "pv_feed_in_w": 4})
