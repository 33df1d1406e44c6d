"""Documents that replace each other: what was known when.

Prices and forecasts are kept in two times: that of the slot a row is about, and that at which its document was made, which
the document itself says. Rows are only added. What was known at some moment is, for each slot, the row of the newest document
made until then. The time at which a file was copied plays no part, so an old document that is copied again changes nothing.
Streams read every file once; their checkpoint remembers which. A file that is overwritten in place is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from ..functions.timeparts import epoch_seconds, from_epoch_seconds, shift, ts_lit
from ..operators.chunked import fill_forward
from ..schemas import FORECAST_PARAMETERS
from . import versions
from .landing import _DAYAHEAD, _utc, duration_seconds
from .shared import checkpoint_id

QUARTER = 900
DAYAHEAD_KEY = ["zone", "ts", "known_from", "revision", "document_id"]
FORECAST_KEY = ["site_id", "ts", "known_from", "content"]

_MARKET_DOCUMENT = f"mRID string, revisionNumber int, createdDateTime string, TimeSeries array<struct<{_DAYAHEAD}>>"
_ELEMENT = "struct<Time: string, ParameterName: string, ParameterValue: string>"
_FEATURES = f"_timeStamp string, member array<struct<BsWfsElement: {_ELEMENT}>>, BsWfsElement array<{_ELEMENT}>, site_id string"


def _made(text: str) -> Column:
    """When a document was made, as it says; a document that doesn't say counts from the time of its file."""
    whole = F.regexp_replace(F.col(text), r"\.\d+", "")
    return F.coalesce(_utc(whole), from_epoch_seconds(F.unix_seconds(F.col("_metadata.file_modification_time"))))


def dayahead_rows(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """``zone, ts, price_eur_per_mwh, known_from, revision, document_id`` for each quarter hour of a document's periods.

    A slot has a price where a point stands; left-out and later slots of a point have none and take the price before them when
    they are filled. A period without a known length of its points gives one row without a time.
    """
    documents = reader.format("xml").schema(_MARKET_DOCUMENT).option("rowTag", "Publication_MarketDocument").load(path)
    periods = documents.select(
        F.col("mRID").alias("document_id"), F.coalesce("revisionNumber", F.lit(0)).alias("revision"), _made("createdDateTime").alias("known_from"),
        F.explode("TimeSeries").alias("s")).select(
        "document_id", "revision", "known_from", F.col("s.`in_Domain.mRID`._VALUE").alias("zone"), F.explode("s.Period").alias("p")).select(
        "document_id", "revision", "known_from", "zone", _utc(F.col("p.timeInterval.start")).alias("start_ts"),
        _utc(F.col("p.timeInterval.end")).alias("end_ts"), duration_seconds(F.col("p.resolution")).alias("step"), F.col("p.Point").alias("points"))
    quarters = F.floor((epoch_seconds("end_ts") - epoch_seconds("start_ts")) / QUARTER)
    usable = F.coalesce(F.col("step") > 0, F.lit(False)) & F.coalesce(quarters > 0, F.lit(False))
    slots = periods.withColumn("offset", F.explode(F.when(usable, F.transform(
        F.sequence(F.lit(0).cast("bigint"), quarters - 1), lambda q: q * QUARTER)).otherwise(F.array(F.lit(None).cast("bigint")))))
    position = F.floor(F.col("offset") / F.col("step")) + 1
    point = F.try_element_at(F.filter("points", lambda p: p["position"] == position), F.lit(1))
    price = F.when(F.col("offset") % F.col("step") == 0, point["price.amount"])
    return slots.select("zone", shift("start_ts", F.col("offset")).alias("ts"), price.alias("price_eur_per_mwh"),
                        "known_from", "revision", "document_id")


def forecast_rows(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """``site_id, ts``, a column per known parameter, ``known_from`` and ``content`` (a hash of the values) of each document's hours."""
    documents = reader.format("xml").schema(_FEATURES).option("rowTag", "FeatureCollection").option("ignoreNamespace", True).load(path)
    members = F.transform(F.coalesce("member", F.array()), lambda m: m["BsWfsElement"])
    elements = F.concat(F.filter(members, lambda e: e.isNotNull()), F.coalesce("BsWfsElement", F.array()))
    # One document is small: its elements are grouped by hour within its row, so a stream needs no state.
    hours = documents.select("site_id", _made("_timeStamp").alias("known_from"), elements.alias("elements")) \
        .withColumn("hour", F.explode(F.array_distinct(F.transform("elements", lambda e: e["Time"]))))

    def value(name: str) -> Column:
        mine = F.filter("elements", lambda e: (e["Time"] == F.col("hour")) & (e["ParameterName"] == name))
        number = F.transform(mine, lambda e: e["ParameterValue"].try_cast("double"))
        return F.try_element_at(F.filter(number, lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(1))

    values = {column: value(name) for name, column in FORECAST_PARAMETERS.items()}
    rows = hours.select("site_id", _utc(F.col("hour")).alias("ts"), *[v.alias(c) for c, v in values.items()], "known_from")
    return rows.withColumn("content", F.xxhash64(*values))


def known_prices(rows: DataFrame, known_at: datetime | str | None = None) -> DataFrame:
    """``zone, ts, price_eur_per_mwh`` as known at a moment (by default now), a missing price filled from the slot before it.

    For each slot the newest document decides, by the time it was made, then by its revision and its id.
    """
    seen = rows.filter(F.col("ts").isNotNull() if known_at is None else F.col("ts").isNotNull() & (F.col("known_from") <= ts_lit(known_at)))
    newest = F.max_by("price_eur_per_mwh", F.struct("known_from", "revision", "document_id", "price_eur_per_mwh"))
    slots = seen.groupBy("zone", "ts").agg(newest.alias("_price"))
    return fill_forward(slots, ["zone"], "ts", {"price_eur_per_mwh": "_price"}).select("zone", "ts", "price_eur_per_mwh")


def known_forecast(rows: DataFrame, known_at: datetime | str | None = None) -> DataFrame:
    """``site_id, ts`` and the parameters as known at a moment: of each the newest value that a document gave."""
    seen = rows if known_at is None else rows.filter(F.col("known_from") <= ts_lit(known_at))
    return seen.filter("ts IS NOT NULL").groupBy("site_id", "ts").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("known_from", "content"))).alias(c) for c in FORECAST_PARAMETERS.values()])


def store_documents(rows: DataFrame, path: str, checkpoint: str, key: Sequence[str]) -> None:
    """Add the rows of all documents that have not been read yet to a versioned table; those it holds already change nothing."""

    def add(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        versions.insert_versioned(session, batch, path, key, [c for c in batch.columns if c not in key], (checkpoint_id(session, checkpoint), batch_id))

    rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def store_dayahead(spark: SparkSession, inbox: str, path: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    store_documents(dayahead_rows(reader, inbox), path, checkpoint, DAYAHEAD_KEY)


def store_forecast(spark: SparkSession, inbox: str, path: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Documents under ``site_id=<id>`` folders."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    store_documents(forecast_rows(reader, inbox), path, checkpoint, FORECAST_KEY)
