"""Landed files: raw archives, posted JSON, price and weather documents, commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.quantities import bad_registers, parse_registers, register
from ..functions.timeparts import shift
from ..operators.averaging import merge_latest
from ..operators.grid import forward_fill, slots_between
from ..schemas import COMMANDS, FORECAST_PARAMETERS, REGISTER_COLUMNS, TELEMETRY

CORRUPT = "_corrupt"


def read_archive(spark: SparkSession, inbox: str, schema: T.StructType = TELEMETRY, processed: str | None = None,
                 files_per_batch: int = 1000) -> DataFrame:
    """Stream of uploaded raw archives. With ``processed`` a file is moved there once it has been imported.

    Run it with ``trigger(availableNow=True)`` from any scheduler; the checkpoint remembers what was read.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if processed is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", processed)
    return reader.parquet(inbox)


def read_json_landing(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Posted JSON records that fit the schema, and the text of those that do not."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = spark.read.text(path).filter(F.trim("value") != "").select("value", F.from_json("value", full, options).alias("r"))
    bad = F.col(f"r.{CORRUPT}").isNotNull()
    return rows.filter(~bad).select("r.*").drop(CORRUPT), rows.filter(bad).select(F.col("value").alias("record"))


def merge_station_and_inverter(weather: DataFrame, inverter: DataFrame, max_age_seconds: int = 300) -> DataFrame:
    """Raw rows: each weather reading with the newest inverter document.

    ``inverter`` has ``registers_json``. Typed columns come from register numbers, a missing or unreadable register
    is 0; the digit keys are kept as ``registers`` and the unreadable ones listed in ``bad_registers``.
    """
    parsed = inverter.select("site_id", "ts", parse_registers("registers_json").alias("registers"))
    merged = merge_latest(weather, parsed, max_age_seconds)
    typed = {name: register("registers", number) for name, number in REGISTER_COLUMNS.items()}
    return merged.withColumns({**typed, "bad_registers": bad_registers("registers")}).withColumnRenamed("right_ts", "inverter_ts")


def _utc(text: Column) -> Column:
    """Timestamp of ``2026-02-18T13:30Z``; the zone is always Z in these documents."""
    return F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz")


_DAYAHEAD = (
    "`in_Domain.mRID` struct<_VALUE: string>, "
    "Period array<struct<timeInterval: struct<start: string, `end`: string>, resolution: string, "
    "Point: array<struct<position: int, `price.amount`: double>>>>"
)
#: Seconds of the units of an ISO 8601 duration that have a fixed length.
_UNITS = {"D": 86400, "H": 3600, "M": 60, "S": 1}


def duration_seconds(text: Column) -> Column:
    """Seconds of a duration such as PT15M, PT1H30M or P1D; null for anything else."""
    parts = [F.coalesce(F.regexp_extract(text, rf"{'T.*?' if unit != 'D' else 'P'}(\d+){unit}", 1).try_cast("bigint"), F.lit(0)) * n
             for unit, n in _UNITS.items()]
    return F.when(text.rlike(r"^P(?=.)(\d+D)?(T(?=.)(\d+H)?(\d+M)?(\d+S)?)?$"), parts[0] + parts[1] + parts[2] + parts[3])


def _written() -> list[Column]:
    """When and as what a row's document was written: the later file is the newer document."""
    return [F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file")]



def read_dayahead_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Points ``zone, ts, price_eur_per_mwh`` of day-ahead price documents, and the periods they cover.

    The place of a point is its position times the resolution of its period. Positions may be left out. Of several
    documents that hold a point the newest file counts. Points of a resolution without fixed length have no time.
    """
    series = spark.read.format("xml").schema(_DAYAHEAD).option("rowTag", "TimeSeries").load(path)
    periods = series.select(F.col("`in_Domain.mRID`._VALUE").alias("zone"), F.explode("Period").alias("p"), *_written()).select(
        "zone", "written", "file", _utc(F.col("p.timeInterval.start")).alias("start_ts"), _utc(F.col("p.timeInterval.end")).alias("end_ts"),
        F.col("p.resolution").alias("resolution"), F.col("p.Point").alias("points"))
    points = periods.select("zone", "written", "file", "start_ts", duration_seconds(F.col("resolution")).alias("step"),
                            F.explode("points").alias("pt")).select(
        "zone", "written", "file", shift("start_ts", ((F.col("pt.position") - 1) * F.col("step")).cast("bigint")).alias("ts"),
        F.col("pt.`price.amount`").alias("price_eur_per_mwh"))
    points = points.groupBy("zone", "ts").agg(
        F.max_by("price_eur_per_mwh", F.struct("written", "file", "price_eur_per_mwh")).alias("price_eur_per_mwh"))
    return points, periods.select("zone", "start_ts", "end_ts").distinct()


def fill_dayahead(points: DataFrame, periods: DataFrame) -> DataFrame:
    """Quarter-hour prices of the imported periods; a left-out slot takes the price before it."""
    last = periods.withColumn("_last", shift("end_ts", -1))
    grid = slots_between(last, ["zone"], "start_ts", "_last").distinct()
    return forward_fill(points, "price_eur_per_mwh", by=["zone"], grid=grid)


_WEATHER = "Time string, ParameterName string, ParameterValue string, site_id string"


def read_forecast_xml(spark: SparkSession, path: str) -> DataFrame:
    """Hourly forecast, one column per known parameter, from documents under ``site_id=<id>`` folders.

    Of several known values of an hour that of the newest file counts.
    """
    rows = (spark.read.format("xml").schema(_WEATHER).option("rowTag", "BsWfsElement")
            .option("ignoreNamespace", True).load(path)).select("*", *_written())
    value = F.col("ParameterValue").try_cast("double")
    known = F.when(~F.isnan(value), value)
    return rows.groupBy("site_id", _utc(F.col("Time")).alias("ts")).agg(*[
        F.max_by(known, F.when((F.col("ParameterName") == name) & known.isNotNull(), F.struct("written", "file", known))).alias(column) for name, column in FORECAST_PARAMETERS.items()])


def read_commands(spark: SparkSession, path: str) -> DataFrame:
    """Stream of control messages from files; the same columns can come from any message log."""
    return spark.readStream.schema(COMMANDS).json(path)


def write_commands(commands: DataFrame, path: str) -> None:
    """JSON lines with times to the microsecond, which decides between commands."""
    commands.select("site_id", "ts", "command").write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
