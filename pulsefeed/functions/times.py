"""Time parsing and local-time expressions, independent of the session zone."""

from __future__ import annotations

import zoneinfo
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsefeed.settings import MICROS

HOUR_US = 3600 * MICROS
DAY_US = 24 * HOUR_US

# The usual form, which Spark's own cast reads once the comma is a point.
_DATE = r"\d{4}-\d{2}-\d{2}"
_OFFSET = r"(Z|[+-]\d{2}:\d{2})"
_FULL = rf"^{_DATE}[T ]\d{{2}}:\d{{2}}:\d{{2}}([.,]\d{{1,9}})?{_OFFSET}?$"
# All of ISO-8601 that the services read: calendar and week dates, extended or basic, times
# down to the fraction or cut off earlier, and offsets of hours, minutes and seconds.
# Groups: 1-3 date, 4-6 week date, 7 time with its offset, 8-10 time, 11 fraction, 12 offset, 13-16 its parts.
_ANY = (
    r"^(?:(\d{4})-?(\d{2})-?(\d{2})|(\d{4})-?W(\d{2})(?:-?([1-7]))?)"
    r"(?:[^0-9]((\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(Z|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.\d+)?)?)?)?))?$"
)


def _part(text: Column, group: int, default: str) -> Column:
    found = F.regexp_extract(text, _ANY, group)
    return F.when(found == "", F.lit(default)).otherwise(found)


def _local_date(text: Column) -> Column:
    """Date part of any form, as text in the extended form; NULL for a week that its year does not have."""
    number = lambda g, d: _part(text, g, d).cast("int")
    fourth = F.make_date(number(4, "1970"), F.lit(1), F.lit(4))
    day = F.date_add(fourth, (number(5, "1") - 1) * 7 + number(6, "1") - 1 - F.weekday(fourth))
    in_year = (F.extract(F.lit("YEAROFWEEK"), day) == number(4, "1970")) & (number(5, "1") >= 1)
    week = F.when(in_year, F.date_format(day, "yyyy-MM-dd"))
    calendar = F.concat_ws("-", *[F.regexp_extract(text, _ANY, g) for g in (1, 2, 3)])
    return F.when(F.regexp_extract(text, _ANY, 4) != "", week).otherwise(calendar)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, NULL if it does not parse. No offset means UTC.

    The usual full form costs two pattern matches; other forms are put into it first.
    """
    usual = F.concat(
        F.translate(text, ",", "."), F.when(text.rlike(rf"[T ].*{_OFFSET}$"), F.lit("")).otherwise(F.lit("Z"))
    )
    clock = F.concat_ws(":", *[_part(text, g, "00") for g in (8, 9, 10)])
    offset = F.concat(_part(text, 13, "+"), F.concat_ws(":", *[_part(text, g, "00") for g in (14, 15, 16)]))
    other = F.concat(_local_date(text), F.lit("T"), clock, F.lit("."), _part(text, 11, "0"), offset)
    return F.when(text.rlike(_FULL), usual).when(text.rlike(_ANY), other).try_cast("timestamp")


def parse_boundary_time(text: Column) -> Column:
    """What the boundary takes as a time: ISO-8601, or unix seconds (milliseconds beyond 2e10) as a number."""
    number = F.when(text.rlike(r"^[+-]?\d+(\.\d+)?$") & ~text.rlike(r"^\d{8}$"), text.try_cast("double"))
    seconds = F.when(F.abs(number) > 2e10, number / 1000.0).otherwise(number)
    return F.coalesce(parse_iso(text), F.timestamp_micros(F.round(seconds * float(MICROS)).cast("bigint")))


def iso_text(text: Column) -> Column:
    """A time that the boundary took, as extended ISO-8601 with the offset it came with (or none); unix times are in UTC.

    What it names is the same instant and the same local date, and the message parser reads it.
    """
    part = lambda g: F.regexp_extract(text, _ANY, g)
    seconds = F.when(part(16) == "", F.lit("")).otherwise(F.concat(F.lit(":"), part(16)))
    offset = F.when(part(12) == "Z", F.lit("Z")).when(
        part(12) != "", F.concat(part(13), part(14), F.lit(":"), _part(text, 15, "00"), seconds)
    ).otherwise(F.lit(""))
    fraction = F.when(part(11) == "", F.lit("")).otherwise(F.concat(F.lit("."), part(11)))
    clock = F.concat_ws(":", *[_part(text, g, "00") for g in (8, 9, 10)])
    other = F.concat(_local_date(text), F.lit("T"), clock, fraction, offset)
    at = epoch_us(parse_boundary_time(text))
    in_day = F.pmod(at, F.lit(DAY_US))
    two = lambda value: F.lpad(value.cast("string"), 2, "0")
    utc = F.concat(
        utc_date(at), F.lit("T"), two(floor_div(in_day, HOUR_US)), F.lit(":"), two(floor_div(in_day, HOUR_US // 60) % 60), F.lit(":"),
        two(floor_div(in_day, MICROS) % 60), F.lit("."), F.lpad((in_day % MICROS).cast("string"), 6, "0"), F.lit("+00:00"),
    )
    return F.when(text.rlike(_FULL), F.translate(text, ", ", ".T")).when(text.rlike(_ANY), other).otherwise(utc)


def local_event_date(text: Column) -> Column:
    """Calendar date of an ISO timestamp in its own offset (not in UTC)."""
    return F.when(text.rlike(_FULL), F.substring(text, 1, 10)).otherwise(_local_date(text))


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def us_to_seconds(us: Column) -> Column:
    return us / F.lit(float(MICROS))


def us_to_timestamp(us: Column) -> Column:
    return F.timestamp_micros(us)


def floor_div(value: Column, width: int) -> Column:
    """Floor division that also rounds negative times down, exact on BIGINT."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, w), w)


def utc_date(us: Column) -> Column:
    days = floor_div(us, DAY_US).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


@lru_cache(maxsize=1)
def known_zones() -> tuple[str, ...]:
    """IANA names of the driver's zone database that Spark reads as well; without a JVM to ask, less those it is known to lack.

    EST, MST and HST may be missing from the JVM's zones, but Spark takes them from its table of short names.
    """
    names = zoneinfo.available_timezones() - {"Factory", "localtime", "ROC"}
    context = SparkContext._active_spark_context
    if context is not None:
        zones = context._jvm.java.time.ZoneId
        names &= {*zones.getAvailableZoneIds().toArray(), *zones.SHORT_IDS.keySet().toArray()}
    return tuple(sorted(names))


def time_of_day(event_us: Column, tz: str) -> Column:
    """morning [6,12), afternoon [12,17), evening [17,21), else night, in local time.

    ``tz`` names the zone column; a null, empty or unknown zone means UTC. The
    allow-list is needed because the conversion raises on unknown names and
    accepts bare offsets. It is passed as SQL text: one parse instead of a call
    per name, and a hash set at run time.
    """
    names = ", ".join(f"'{z}'" for z in known_zones())
    zone = F.expr(f"CASE WHEN {tz} = 'ROC' THEN 'Asia/Taipei' WHEN {tz} IN ({names}) THEN {tz} ELSE 'UTC' END")
    local_us = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(event_us), zone))
    hour = floor_div(F.pmod(local_us, F.lit(DAY_US)), HOUR_US)
    return (
        F.when((hour >= 6) & (hour < 12), "morning")
        .when((hour >= 12) & (hour < 17), "afternoon")
        .when((hour >= 17) & (hour < 21), "evening")
        .otherwise("night")
    )
