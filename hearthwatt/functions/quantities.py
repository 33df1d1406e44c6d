"""Units, register maps, commands and display formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .timeparts import as_col

# Group 1 is the mode, group 3 the minutes, 1 to 720 and only after PROHIBIT.
VALID_COMMAND = r"^(ALLOW(?=$)|PROHIBIT)(_0*([1-9][0-9]?|[1-6][0-9]{2}|7[01][0-9]|720))?$"


def watts_from_joules(joules: Column | str) -> Column:
    """Energy per square metre gathered in one hour, as mean power."""
    return as_col(joules) / F.lit(3600.0)


def cents_per_kwh(price: Column | str, margin: float, vat: float = 0.255) -> Column:
    """Consumer price from EUR/MWh: margin is in cents and carries VAT too."""
    return (as_col(price) / F.lit(10.0) + F.lit(float(margin))) * F.lit(1.0 + vat)


def display_number(value: Column | str, digits: int) -> Column:
    """Half-up rounded text with a fixed number of decimals, a dash for a missing value.

    Going through a decimal keeps binary noise in the last digits from deciding a tie.
    """
    exact = as_col(value).cast("decimal(28,9)")
    return F.coalesce(F.round(exact, digits).cast("string"), F.lit("-"))


def clamp(value: Column, low: float, high: float) -> Column:
    """NULL stays NULL; a bare greatest/least would skip it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def max_deferral_hours(temperature: Column | str) -> Column:
    """Linear from 1 h at -20 degrees to 5 h at +20 degrees; unknown temperature gives no limit value."""
    return F.lit(1.0) + F.lit(0.1) * (clamp(as_col(temperature), -20.0, 20.0) + F.lit(20.0))


def wind_components(speed: Column | str, direction: Column | str) -> tuple[Column, Column]:
    """East and north parts of the wind; both NULL when either reading is missing."""
    speed, angle = as_col(speed), F.radians(as_col(direction))
    return speed * F.sin(angle), speed * F.cos(angle)


def wind_from_components(east: Column, north: Column, calm: float = 1e-9) -> tuple[Column, Column]:
    """Speed and direction of a mean wind; a calm mean has no direction."""
    speed = F.hypot(east, north)
    bearing = F.pmod(F.degrees(F.atan2(east, north)) + F.lit(360.0), F.lit(360.0))
    return speed, F.when(speed > F.lit(calm), bearing)


def parse_registers(json: Column | str) -> Column:
    """Register map of a JSON document: digit keys only, values as doubles, junk values as NULL.

    The text is read as a map of strings first, because one bad value would blank a map of doubles.
    """
    texts = F.from_json(as_col(json), "map<string,string>")
    return F.transform_values(numeric_keys_only(texts), lambda _, v: v.try_cast("double"))


def numeric_keys_only(registers: Column | str) -> Column:
    return F.map_filter(as_col(registers), lambda k, _: k.rlike("^[0-9]+$"))


def register(registers: Column | str, number: str, default: int = 0) -> Column:
    """Integer value of one register, the default where it is missing or unreadable."""
    return F.coalesce(F.try_element_at(as_col(registers), F.lit(number)).try_cast("bigint"), F.lit(default).cast("bigint"))


def bad_registers(registers: Column | str) -> Column:
    """Numbers of the registers that were sent but could not be read."""
    return F.map_keys(F.map_filter(as_col(registers), lambda _, v: v.isNull()))


def is_command(command: Column | str) -> Column:
    """ALLOW, PROHIBIT, or PROHIBIT_n with n from 1 to 720.

    One pattern that names its input once, because a filter repeats every expression it is given.
    """
    return as_col(command).rlike(VALID_COMMAND)


def command_minutes(command: Column | str) -> Column:
    """Length of a timed prohibition; NULL when untimed or not a valid command.

    The empty text is removed before the cast: a cast that fails costs far more than one that succeeds.
    """
    return F.nullif(F.regexp_extract(as_col(command), VALID_COMMAND, 3), F.lit("")).cast("int")


def command_mode(command: Column | str) -> Column:
    """ALLOW or PROHIBIT; NULL for anything that is not a valid command."""
    return F.nullif(F.regexp_extract(as_col(command), VALID_COMMAND, 1), F.lit(""))
