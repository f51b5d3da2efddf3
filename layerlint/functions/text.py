"""Names, links and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from layerlint import constants as K
from layerlint.functions.attributes import Attribute


def feature_id(attribute: Attribute) -> Column:
    """The id attribute if it is a text, else the placeholder id."""
    return F.when(attribute.is_a("string"), attribute.text).otherwise(F.lit(K.UNKNOWN_ID))


def format_issues(issues: Column) -> Column:
    """Issues of a feature as one text: ``path: message (code: code)``, joined in order."""
    texts = F.transform(
        issues,
        lambda i: F.concat(i["path"], F.lit(": "), i["message"], F.lit(" (code: "), i["code"], F.lit(")")),
    )
    return F.array_join(texts, K.MESSAGE_SEPARATOR)


def entity_name(resource_id: Column, product_type: Column) -> Column:
    return F.lower(F.concat_ws("_", resource_id, product_type))


def layer_name(resource_id: Column, product_type: Column) -> Column:
    return F.concat(resource_id, F.lit("-"), product_type, F.lit("_features"))


def report_title(resource_id: Column, product_type: Column, version: Column) -> Column:
    return F.concat(entity_name(resource_id, product_type), F.lit("_v"), version)


def build_url(base: Column, relative: Column) -> Column:
    """Append a relative path to the path of a base URL, with single slashes between the parts; a query or fragment stays last."""
    path = F.regexp_extract(base, "^([^?#]*)", 1)
    rest = F.regexp_extract(base, "^[^?#]*(.*)$", 1)
    return F.concat(F.regexp_replace(F.concat(path, F.lit("/"), relative), r"(?<!:)/{2,}", "/"), rest)


def repeat_joined(text: str, times: Column) -> Column:
    """``times`` copies of a fixed text joined by the message separator; NULL for none."""
    one_more = F.repeat(F.lit(text + K.MESSAGE_SEPARATOR), (times - 1).cast("int"))
    return F.when(times > 0, F.concat(one_more, F.lit(text)))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
