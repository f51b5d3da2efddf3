"""Typed readings of attribute text. Column in, column out; a text that cannot be read gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from layerlint.functions.attributes import Attribute

# Spark's own casts accept more than we want ('1d', 'inf', a bare time), so texts are matched first.
NUMBER_PATTERN = r"^\s*([+-]?(Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?))?\s*$"
DAY_FIRST_PATTERN = r"^\d{2}/\d{2}/\d{4}$"
ISO_PATTERN = r"^\d{4}(-\d{2}(-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?)?)?$"
# Largest distance from the epoch a date may have, in milliseconds.
MAX_EPOCH_MILLIS = 8.64e15


def strip(text: Column) -> Column:
    """Trim every kind of white space; ``trim`` takes spaces only."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_csv_list(text: Column) -> Column:
    """Comma separated text to a list of its non-empty items; null and '' give an empty list."""
    items = F.filter(F.transform(F.split(text, ","), strip), lambda item: item != "")
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(items)


def flexible_date(text: Column) -> Column:
    """``DD/MM/YYYY`` or ISO 8601 text to a timestamp in the session time zone (UTC)."""
    return (
        F.when(text.rlike(DAY_FIRST_PATTERN), F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))
        .when(text.rlike(ISO_PATTERN), text.try_cast("timestamp"))
    )


def attribute_date(attribute: Attribute) -> Column:
    """Date of an attribute: null counts as the epoch, a number as milliseconds since then."""
    millis = attribute.text.try_cast("double")
    return (
        F.when(attribute.is_a("null"), F.timestamp_millis(F.lit(0)))
        .when(
            (attribute.is_a("number")) & (F.abs(millis) <= MAX_EPOCH_MILLIS),
            F.timestamp_millis(millis.try_cast("bigint")),
        )
        .when(attribute.is_a("boolean"), F.timestamp_millis((attribute.text == "true").cast("bigint")))
        .when(attribute.is_a("date"), attribute.text.try_cast("timestamp"))
        .when(attribute.is_a("string"), flexible_date(attribute.text))
    )


def text_number(text: Column) -> Column:
    """Text to double; blank text counts as 0. The cast trims white space and cannot read blank text."""
    return F.when(text.rlike(NUMBER_PATTERN), F.coalesce(text.try_cast("double"), F.lit(0.0)))


def attribute_number(attribute: Attribute) -> Column:
    """Number of an attribute: null counts as 0, a missing one is no number."""
    return (
        F.when(attribute.is_a("null"), F.lit(0.0))
        .when(attribute.is_a("number"), attribute.text.try_cast("double"))
        .when(attribute.is_a("boolean"), (attribute.text == "true").cast("double"))
        .when(attribute.is_a("string"), text_number(attribute.text))
    )


def optional_text(attribute: Attribute) -> Column:
    return F.when(attribute.is_a("string"), attribute.text)
