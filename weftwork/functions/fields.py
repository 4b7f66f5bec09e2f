"""Typed dynamic search fields."""

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork.constants import (
    DATE,
    DATETIME,
    FIELD_PREFIXES,
    NUMBER,
    NUMBER_FORM,
    NUMBER_SENTINEL,
    PATTERN_ZONE,
    TIME,
)
from weftwork.functions.temporal import convert_fixed, convert_temporal


def is_number(text: Column) -> Column:
    return text.rlike(NUMBER_FORM)


def checked_number(text: Column, sentinel: str | None = NUMBER_SENTINEL) -> Column:
    """The text when it is a number, else the sentinel; empty text is null."""
    return F.when(F.length(text) == 0, F.lit(None).cast("string")).otherwise(
        F.when(is_number(text), text).otherwise(F.lit(sentinel).cast("string"))
    )


def number_value(text: Column, sentinel: float | None = -1.0) -> Column:
    """The number as a double, else the sentinel."""
    return F.when(is_number(text), text.try_cast("double")).otherwise(F.lit(sentinel).cast("double"))


def field_name(type_: Column, uuid: Column) -> Column:
    """Prefixed field name; null for a type that has no prefix."""
    prefixes = F.create_map(*[F.lit(x) for x in chain.from_iterable(FIELD_PREFIXES.items())])
    return F.concat(F.try_element_at(prefixes, type_), uuid)


def streamed_value(type_: Column, text: Column, patterns: dict[str, list[str]], zone: str = PATTERN_ZONE) -> Column:
    """Field value of a streamed record: trimmed, dates by the configured patterns."""
    trimmed = F.trim(text)
    return (
        F.when(type_ == DATE, convert_temporal(DATE, trimmed, patterns.get(DATE, []), zone))
        .when(type_ == DATETIME, convert_temporal(DATETIME, trimmed, patterns.get(DATETIME, []), zone))
        .when(type_ == TIME, convert_temporal(TIME, trimmed, patterns.get(TIME, []), zone))
        .when(type_ == NUMBER, checked_number(trimmed))
        .otherwise(trimmed)
    )


def batch_value(type_: Column, text: Column, zone: str = PATTERN_ZONE) -> Column:
    """Field value of a batch record: untrimmed, fixed date forms, times as written."""
    return (
        F.when(type_ == DATE, convert_fixed(DATE, text, zone))
        .when(type_ == DATETIME, convert_fixed(DATETIME, text, zone))
        .when(type_ == NUMBER, checked_number(text))
        .otherwise(text)
    )


def typed_fields(
    body: Column,
    patterns: dict[str, list[str]] | None = None,
    zone: str = PATTERN_ZONE,
) -> Column:
    """A body as ``map<field name, text>``; unknown types and unreadable values are left out.

    With ``patterns`` the streamed rules apply, without them the batch rules.
    """

    def field(entry: Column) -> Column:
        type_, text = entry["value"]["type"], entry["value"]["value"]
        value = batch_value(type_, text, zone) if patterns is None else streamed_value(type_, text, patterns, zone)
        return F.struct(field_name(type_, entry["key"]).alias("key"), value.alias("value"))

    fields = F.transform(F.map_entries(body), field)
    return F.map_from_entries(F.filter(fields, lambda f: f["key"].isNotNull() & f["value"].isNotNull()))
