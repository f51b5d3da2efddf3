"""Attribute and shape checks of features.

A check is a list of ``Rule``s: a condition that is never NULL, and the issue it raises. Rules of one attribute exclude each
other. From the same rules come the full issue list (``metadata_issues``) and the cheap yes/no used for counting
(``is_valid``), which never builds a message.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from layerlint import constants as K
from layerlint.config import LIMITS, Bounds, Limits
from layerlint.functions.attributes import Attribute, attributes_of, properties_kind, variant_kind
from layerlint.functions.geometry import is_polygonal
from layerlint.functions.parsing import attribute_date, attribute_number, optional_text, parse_csv_list
from layerlint.functions.text import any_of, feature_id, format_issues

ISSUE_TYPE = "array<struct<path:string,message:string,code:string>>"


@dataclass(frozen=True)
class Rule:
    broken: Column
    path: str
    message: Column
    code: str

    def issue(self) -> Column:
        return F.when(
            self.broken,
            F.struct(F.lit(self.path).alias("path"), self.message.alias("message"), F.lit(self.code).alias("code")),
        )


def _number_text(value: float) -> str:
    return str(int(value)) if float(value).is_integer() else repr(float(value))


def _wrong_type(attribute: Attribute, path: str, allowed: list[str]) -> list[Rule]:
    wrong = ~attribute.is_a(*allowed)
    message = F.when(attribute.kind == "undefined", F.lit("Required")).otherwise(
        F.concat(F.lit("Expected string, received "), attribute.kind)
    )
    return [Rule(wrong, path, message, "invalid_type")]


def required_string(attribute: Attribute, path: str) -> list[Rule]:
    return _wrong_type(attribute, path, ["string"])


def optional_string(attribute: Attribute, path: str) -> list[Rule]:
    return _wrong_type(attribute, path, ["string", "null", "undefined"])


def csv_list(attribute: Attribute, path: str) -> list[Rule]:
    """A list attribute may be null or empty, but not missing."""
    return _wrong_type(attribute, path, ["string", "null"])


def valid_date(date: Column, path: str) -> list[Rule]:
    return [Rule(date.isNull(), path, F.lit(K.DATE_MESSAGE), "invalid_date")]


def bounded_number(number: Column, path: str, label: str, low: float, high: float) -> list[Rule]:
    return [
        Rule(number.isNull(), path, F.lit(f"{label} should be a number"), "invalid_type"),
        Rule(F.coalesce(number < low, F.lit(False)), path,
             F.lit(f"{label} should not be less than {_number_text(low)}"), "too_small"),
        Rule(F.coalesce(number > high, F.lit(False)), path,
             F.lit(f"{label} should not be larger than {_number_text(high)}"), "too_big"),
    ]


def optional_scale(attribute: Attribute, number: Column, path: str) -> list[Rule]:
    given = ~attribute.is_a("null", "undefined")
    return [
        Rule(given & number.isNull(), path, F.lit("Expected number, received nan"), "invalid_type"),
        Rule(given & F.coalesce(number < 1, F.lit(False)), path, F.lit(K.SCALE_MESSAGE), "too_small"),
    ]


# Readings of attributes that several rules or the mapped table use. They are columns of their own below the rules, so the
# text is matched and cast once per row however often the value is looked at.
PARSED = {
    "updateDate": "__update_date", "sourceRes": "__source_res", "ep90": "__ep90", "publishRes": "__publish_res", "scale": "__scale",
}


def with_parsed(features: DataFrame) -> DataFrame:
    """Add the date and number readings."""
    attributes = attributes_of(features)
    return features.withColumns({
        column: (attribute_date if name == "updateDate" else attribute_number)(attributes[name]) for name, column in PARSED.items()
    })


def property_rules(attributes: dict[str, Attribute], bounds: Bounds) -> list[Rule]:
    """Rules of all attributes of a frame with readings, in schema order."""

    def path(name: str) -> str:
        return f"properties.{name}"

    a = attributes
    v = {name: F.col(column) for name, column in PARSED.items()}
    resolution = (bounds.resolution_min, bounds.resolution_max)
    return [
        *required_string(a["id"], path("id")),
        *optional_string(a["sourceId"], path("sourceId")),
        *valid_date(v["updateDate"], path("updateDate")),
        *csv_list(a["sensors"], path("sensors")),
        *optional_string(a["desc"], path("desc")),
        *bounded_number(v["sourceRes"], path("sourceRes"), "Source resolution meter", *resolution),
        *bounded_number(v["ep90"], path("ep90"), "Horizontal accuracy CE90", bounds.ce90_min, bounds.ce90_max),
        *csv_list(a["cities"], path("cities")),
        *csv_list(a["countries"], path("countries")),
        *bounded_number(v["publishRes"], path("publishRes"), "Publish resolution meter", *resolution),
        *required_string(a["classify"], path("classify")),
        *required_string(a["sourceName"], path("sourceName")),
        *optional_scale(a["scale"], v["scale"], path("scale")),
    ]


def shape_rules(features: DataFrame, check_geometry: Column) -> list[Rule]:
    """Rules on the feature envelope. A frame without one of these columns is taken to hold the constant valid value."""
    columns = set(features.columns)
    rules = []
    if "type" in columns:
        not_feature = F.coalesce(F.col("type") != "Feature", F.lit(True))
        rules.append(Rule(not_feature, "type", F.lit('Invalid literal value, expected "Feature"'), "invalid_literal"))
    if "raw_id" in columns:
        rules.append(Rule(~variant_kind(F.col("raw_id")).isin("string", "number", "undefined"), "id", F.lit("Invalid input"), "invalid_union"))
    if "raw_bbox" in columns:
        # all elements are numbers, and four or six of them
        numbers = F.schema_of_variant("raw_bbox").rlike(r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))>$")
        size = F.size(F.try_variant_get("raw_bbox", "$", "array<double>"))
        rules.append(Rule(F.col("raw_bbox").isNotNull() & ~F.coalesce(numbers & size.isin(4, 6), F.lit(False)), "bbox", F.lit("Invalid input"), "invalid_union"))
    elif "bbox" in columns:
        bad_size = F.coalesce(~F.size("bbox").isin(4, 6) | F.exists("bbox", lambda n: n.isNull()), F.lit(False))
        rules.append(Rule(F.col("bbox").isNotNull() & bad_size, "bbox", F.lit("Invalid input"), "invalid_union"))
    if "geometry" in columns:
        rules.append(Rule(check_geometry & ~is_polygonal(F.col("geometry")), "geometry", F.lit("Invalid input"), "invalid_union"))
    return rules


def feature_shape_issues(features: DataFrame) -> DataFrame:
    """Envelope issues only, as column ``issues``."""
    return features.withColumn("issues", _issue_list(shape_rules(features, F.lit(True))))


def _issue_list(rules: list[Rule]) -> Column:
    if not rules:
        return F.array().cast(ISSUE_TYPE)
    return F.array_compact(F.array(*[rule.issue() for rule in rules]))


def is_skipped(features: DataFrame, limits: Limits = LIMITS) -> Column:
    """Over the vertex limit; such features are reported, not validated further."""
    return F.coalesce(F.col("vertices") > limits.max_vertices, F.lit(False))


def feature_rules(features: DataFrame, limits: Limits = LIMITS) -> list[Rule]:
    """All rules of a feature; the geometry of an over-limit feature is not looked at.

    ``properties`` that are missing or no object raise one issue, and none per attribute.
    """
    rules = property_rules(attributes_of(features), limits.bounds)
    kind = properties_kind(features)
    if kind is not None:
        there = kind == "object"
        message = F.when(kind == "undefined", F.lit("Required")).otherwise(F.concat(F.lit("Expected object, received "), kind))
        rules = [Rule(~there, "properties", message, "invalid_type"), *[replace(r, broken=there & r.broken) for r in rules]]
    return [*shape_rules(features, ~is_skipped(features, limits)), *rules]


def _checked(features: DataFrame, limits: Limits) -> tuple[DataFrame, list[Rule]]:
    """Features with readings, key, ``skipped`` and ``broken``, and the rules over them."""
    rules = feature_rules(features, limits)
    checked = with_parsed(features).withColumns({
        "feature_key": feature_id(attributes_of(features)["id"]),
        "skipped": is_skipped(features, limits),
        "broken": any_of([rule.broken for rule in rules]),
    })
    return checked, rules


def metadata_issues(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Add ``issues``: every issue of the row, in schema order. Rows that break no rule build no list."""
    checked, rules = _checked(features, limits)
    issues = F.when(F.col("broken"), _issue_list(rules)).otherwise(F.array().cast(ISSUE_TYPE))
    return checked.withColumn("issues", issues).drop(*PARSED.values(), "feature_key", "skipped", "broken")


def check_features(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Add ``feature_key``, ``skipped`` and ``broken`` (some rule is broken) without building messages."""
    return _checked(features, limits)[0].drop(*PARSED.values())


def parse_properties(features: DataFrame) -> dict[str, Column]:
    """Typed values of the attributes of a frame with readings, NULL where absent or unreadable."""
    a = attributes_of(features)
    v = {name: F.col(column) for name, column in PARSED.items()}
    return {
        "id": optional_text(a["id"]),
        "source_id": optional_text(a["sourceId"]),
        "update_date": v["updateDate"],
        "sensors": parse_csv_list(a["sensors"].text),
        "desc": optional_text(a["desc"]),
        "source_res": v["sourceRes"],
        "ep90": v["ep90"],
        "cities": parse_csv_list(a["cities"].text),
        "countries": parse_csv_list(a["countries"].text),
        "publish_res": v["publishRes"],
        "classify": optional_text(a["classify"]),
        "source_name": optional_text(a["sourceName"]),
        "scale": F.when(~a["scale"].is_a("null", "undefined"), v["scale"]),
    }


def split_over_limit(features: DataFrame, limits: Limits = LIMITS) -> tuple[DataFrame, DataFrame]:
    """(within the limit, skipped)."""
    skipped = is_skipped(features, limits)
    return features.filter(~skipped), features.filter(skipped)


def valid_features(features: DataFrame, limits: Limits = LIMITS, readings: bool = False) -> DataFrame:
    """Features within the vertex limit that break no rule; with ``readings``, what was read from their texts as well."""
    kept = [*features.columns, *(PARSED.values() if readings else ())]
    return _checked(features, limits)[0].filter("not skipped and not broken").select(*kept)


def feature_errors(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Vertex and metadata errors, one row each, in arrival order ``(phase, ordinal, item)``.

    Over-limit features come first in a chunk (phase 0): their metadata error, if any, then the vertices error. Metadata
    errors of the others follow (phase 1). Both kinds come out of one pass over the features.
    """
    checked, rules = _checked(features, limits)
    limit_text = F.lit(f", limit: {limits.max_vertices}")
    counted = F.when(F.col("vertices") > 0, F.col("vertices").cast("string")).otherwise("unknown")

    def error(item: int, error_type: str, message: Column) -> Column:
        column = {t: c for t, c, _ in K.ERROR_TYPES}[error_type]
        return F.struct(
            F.lit(item).cast("bigint").alias("item"), F.lit(error_type).alias("type"), F.lit(column).alias("column_name"), message.alias("message"),
        )

    metadata = F.when(F.col("broken"), error(0, K.METADATA, format_issues(_issue_list(rules))))
    vertices = F.when(F.col("skipped"), error(1, K.VERTICES, F.concat(F.lit("result:"), counted, limit_text)))
    return (
        checked.select(
            "job_id", "chunk_id", F.col("feature_key").alias("id"),
            F.when(F.col("skipped"), 0).otherwise(1).alias("phase"), "ordinal",
            F.when(F.col("broken") | F.col("skipped"), F.array(metadata, vertices)).alias("found"),
        )
        # the outer form keeps the engine from testing the list, and so every rule, once more in a filter below
        .select("*", F.explode_outer("found").alias("e")).filter("e is not null")
        .select(
            "job_id", "chunk_id", "id", "phase", "ordinal", "e.item", "e.type", "e.column_name", "e.message",
            F.col("ordinal").alias("feature_ordinal"), F.lit(None).cast("boolean").alias("is_exceeded"),
        )
    )


def metadata_errors(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """One metadata error per broken feature within the vertex limit, however many issues it has."""
    return feature_errors(split_over_limit(features, limits)[0], limits)


def vertices_errors(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Errors of the over-limit features: ``result:<vertices>, limit: <limit>``, after a metadata error if there is one."""
    return feature_errors(split_over_limit(features, limits)[1], limits)
