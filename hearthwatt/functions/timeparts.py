"""Time columns: slots, local time, file stamps. All inputs are TIMESTAMP_NTZ holding UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

SLOT_MINUTES = (0, 15, 30, 45)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: datetime | str) -> Column:
    """A UTC literal. ``now`` is always passed in this way, never read from the clock."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a UTC timestamp, whatever the session zone is."""
    ts = as_col(ts)
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts_lit("1970-01-01 00:00:00"))


def shift(ts: Column | str, seconds: Column | int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds) if isinstance(seconds, int) else seconds, as_col(ts))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(60.0)


def slot_floor(ts: Column | str, minutes: int = 15) -> Column:
    """Start of the slot that holds ``ts``. For raw rows use :func:`with_slot`, which is plain long arithmetic."""
    step = minutes * 60
    return from_epoch_seconds(F.floor(epoch_seconds(ts) / step) * step)


def with_slot(df: DataFrame, ts: str, length: str, name: str, label: str = "start") -> DataFrame:
    """Add the start or end of the ``length`` slot around ``ts``; rows without a time have no slot and go."""
    return df.withColumn(name, F.window(F.col(ts), length).getField(label))


def truncate_hour(ts: Column | str) -> Column:
    return slot_floor(ts, 60)


def minute_of(ts: Column | str) -> Column:
    return F.minute(as_col(ts))


def aligned_15min(ts: Column | str) -> Column:
    """True on minutes 0, 15, 30 and 45 with no seconds; NULL for a NULL time."""
    ts = as_col(ts)
    whole = F.date_format(ts, "ss.SSSSSS") == "00.000000"
    return whole & F.minute(ts).isin(*SLOT_MINUTES)


def to_local(ts: Column | str, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), as_col(ts))


def to_utc(local: Column | str, tz: str) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), as_col(local))


def local_date(ts: Column | str, tz: str) -> Column:
    return to_local(ts, tz).cast("date")


def hour_minute(ts: Column | str, tz: str) -> Column:
    return F.date_format(to_local(ts, tz), "HH:mm")


def file_stamp(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "yyyyMMdd_HHmmss")


def parse_file_stamp(name: Column | str) -> Column:
    """Time in a name such as ``weather_20260218_204423`` or ``weather_2026-02-18``; NULL when there is none."""
    name = as_col(name)
    stamp = F.regexp_extract(name, r"(\d{8}_\d{6})", 1)
    spelled = F.regexp_replace(stamp, r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6")
    day = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1)
    return F.coalesce(*[F.nullif(text, F.lit("")).try_cast("timestamp_ntz") for text in (spelled, day)])


def local_day_bounds(day: str, tz: str) -> tuple[Column, Column]:
    """UTC start and end of a local calendar day; a day with a clock change has 23 or 25 hours."""
    midnight = ts_lit(f"{day} 00:00:00")
    return to_utc(midnight, tz), to_utc(F.timestamp_add("DAY", F.lit(1), midnight), tz)


def between_dates(ts: Column | str, start: str | None, end: str | None, tz: str = "UTC") -> Column:
    """Inclusive local dates as a range on the UTC column, so it reaches the scan. A missing bound is open."""
    ts = as_col(ts)
    test = F.lit(True)
    if start is not None:
        test = test & (ts >= local_day_bounds(start, tz)[0])
    if end is not None:
        test = test & (ts < local_day_bounds(end, tz)[1])
    return test


def calendar_features(df: DataFrame, tz: str, ts: str = "ts", holidays: DataFrame | None = None) -> DataFrame:
    """Local hour (0-23), day of week (1 = Sunday), weekend flag and, from an optional table of dates, holiday flag."""
    local = to_local(ts, tz)
    out = df.withColumns({
        "hour_of_day": F.hour(local),
        "day_of_week": F.dayofweek(local),
        "is_weekend": F.dayofweek(local).isin(1, 7),
    })
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    days = holidays.select(F.col("date").alias("_date"), F.lit(True).alias("_holiday")).distinct()
    # All sites share a date, so the rows of a day are spread over tasks.
    spread = [c for c in ("site_id", ts) if c in df.columns]
    salted = out.withColumns({"_date": local_date(ts, tz), "_salt": F.pmod(F.xxhash64(*spread), F.lit(64))})
    salts = days.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint"))))
    return salted.join(salts, ["_date", "_salt"], "left").withColumn(
        "is_holiday", F.col("_holiday").isNotNull()).drop("_date", "_salt", "_holiday")
