"""Dates, datetimes and times of day read from text.

Values are wall-clock (``timestamp_ntz``) in ``zone``, so nothing depends on
the session time zone. The fixed forms are read leniently: month 13 is
January of the next year, 25 o'clock is one in the morning of the next day.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork.constants import (
    DATE,
    DATE_FORM,
    DATETIME,
    DATETIME_FORM,
    EPOCH_FORM,
    PATTERN_ZONE,
    TIME,
    TIME_FORM,
)

_ZONE_LETTERS = "XxZzOV"
_MAX_EPOCH_MILLIS = 9223371950454775  # what a timestamp can hold, less a day for the zone


def _number_at(parts: Column, position: int) -> Column:
    return F.get(parts, F.lit(position)).try_cast("int")


def _lenient_date(text: Column) -> Column:
    parts = F.split(text, "-")
    year = F.make_date(_number_at(parts, 0), F.lit(1), F.lit(1))
    month = F.add_months(year, _number_at(parts, 1) - 1)
    return F.date_add(month, _number_at(parts, 2) - 1)


def _lenient_seconds(text: Column) -> Column:
    parts = F.split(text, ":")
    return _number_at(parts, 0) * 3600 + _number_at(parts, 1) * 60 + _number_at(parts, 2)


def _plus_seconds(moment: Column, seconds: Column) -> Column:
    return moment + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def _date_part(text: Column) -> Column:
    return F.substring_index(F.regexp_replace(text, r"\s", " "), " ", 1)


def _time_part(text: Column) -> Column:
    return F.substring_index(F.regexp_replace(text, r"\s", " "), " ", -1)


def _lenient_datetime(text: Column) -> Column:
    midnight = _lenient_date(_date_part(text)).cast("timestamp_ntz")
    return _plus_seconds(midnight, _lenient_seconds(_time_part(text)))


def _time_of_day(seconds: Column) -> Column:
    within = F.pmod(seconds, F.lit(86400)).cast("int")
    pieces = [F.floor(within / 3600), F.pmod(F.floor(within / 60), F.lit(60)), F.pmod(within, F.lit(60))]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in pieces])


def _clock(moment: Column) -> Column:
    return F.nullif(F.regexp_extract(moment.cast("string"), r" (\d\d:\d\d:\d\d)", 1), F.lit(""))


def _to_seconds(moment: Column) -> Column:
    """The text of a moment without fractions; years beyond 9999 have more digits and no sign."""
    return F.regexp_replace(moment.cast("string"), r"^\+|\.\d+$", "")


def _from_epoch_millis(text: Column, zone: str) -> Column:
    millis = text.try_cast("bigint")
    held = F.when(millis.between(0, _MAX_EPOCH_MILLIS), millis)
    days = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(held / 86_400_000).cast("int"))
    moment = _plus_seconds(days.cast("timestamp_ntz"), F.floor((held % 86_400_000) / 1000))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), moment)


def _wall_clock(instant: Column) -> Column:
    """An instant as wall-clock in UTC, whatever the session zone is."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1000000)
    return _plus_seconds(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), seconds)


def _by_pattern(text: Column, pattern: str, zone: str) -> Column:
    if set(re.sub(r"'[^']*'", "", pattern)) & set(_ZONE_LETTERS):
        moment = _wall_clock(F.try_to_timestamp(text, F.lit(pattern)))
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), moment)
    return _wall_clock(F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(pattern + " XXX")))


def _by_patterns(text: Column, patterns: list[str], zone: str) -> Column:
    """First pattern that reads the text, where the text is exactly as long as the pattern."""
    tries = [F.when(F.length(text) == len(p), _by_pattern(text, p, zone)) for p in patterns]
    return F.coalesce(*tries) if tries else F.lit(None).cast("timestamp_ntz")


def parse_date(text: Column, patterns: list[str] = (), zone: str = PATTERN_ZONE) -> Column:
    """A ``date``: epoch milliseconds, ``y-M-d`` with or without a time, or a configured pattern."""
    return (
        F.when(text.rlike(EPOCH_FORM), _from_epoch_millis(text, zone).cast("date"))
        .when(text.rlike(DATE_FORM) | text.rlike(DATETIME_FORM), _lenient_date(_date_part(text)))
        .otherwise(_by_patterns(text, list(patterns), zone).cast("date"))
    )


def parse_datetime(text: Column, patterns: list[str] = (), zone: str = PATTERN_ZONE) -> Column:
    """A ``timestamp_ntz``; a bare date is midnight."""
    return (
        F.when(text.rlike(EPOCH_FORM), _from_epoch_millis(text, zone))
        .when(text.rlike(DATETIME_FORM), _lenient_datetime(text))
        .when(text.rlike(DATE_FORM), _lenient_date(text).cast("timestamp_ntz"))
        .otherwise(_by_patterns(text, list(patterns), zone))
    )


def parse_time(text: Column, patterns: list[str] = (), zone: str = PATTERN_ZONE) -> Column:
    """``HH:mm:ss`` text; of a full datetime, its time of day."""
    return (
        F.when(text.rlike(EPOCH_FORM), _clock(_from_epoch_millis(text, zone)))
        .when(text.rlike(TIME_FORM), _time_of_day(_lenient_seconds(text)))
        .when(text.rlike(DATETIME_FORM), _clock(_lenient_datetime(text)))
        .otherwise(_clock(_by_patterns(text, list(patterns), zone)))
    )


def convert_temporal(type_: str, text: Column, patterns: list[str] = (), zone: str = PATTERN_ZONE) -> Column:
    """Multi-pattern conversion of one property type, as normalised text; null when nothing reads it."""
    if type_ == DATE:
        return _to_seconds(parse_date(text, patterns, zone).cast("timestamp_ntz"))
    if type_ == DATETIME:
        return _to_seconds(parse_datetime(text, patterns, zone))
    if type_ == TIME:
        return parse_time(text, patterns, zone)
    raise ValueError(f"not a temporal type: {type_}")


def convert_fixed(type_: str, text: Column, zone: str = PATTERN_ZONE) -> Column:
    """Fixed-form conversion: empty text is null and text in no known form is kept unchanged.

    A ``date`` written with a time keeps its time here.
    """
    if type_ not in (DATE, DATETIME):
        return F.nullif(text, F.lit(""))
    moment = _from_epoch_millis(text, zone)
    if type_ == DATE:
        moment = moment.cast("date").cast("timestamp_ntz")
    converted = (
        F.when(text.rlike(EPOCH_FORM), moment)
        .when(text.rlike(DATETIME_FORM), _lenient_datetime(text))
        .when(text.rlike(DATE_FORM), _lenient_date(text).cast("timestamp_ntz"))
    )
    return F.coalesce(_to_seconds(converted), F.nullif(text, F.lit("")))
