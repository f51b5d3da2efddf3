"""Attributes of a feature with their source type.

Uploaded attributes are loosely typed, and a missing attribute, a null and an empty text are three different things. An
``Attribute`` carries the text of a value together with its kind, whatever column layout the values arrive in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Attribute name in messages -> column name, in the order they are checked.
ATTRIBUTE_COLUMNS = {
    "id": "id",
    "sourceId": "source_id",
    "updateDate": "update_date",
    "sensors": "sensors",
    "desc": "desc",
    "sourceRes": "source_res",
    "ep90": "ep90",
    "cities": "cities",
    "countries": "countries",
    "publishRes": "publish_res",
    "classify": "classify",
    "sourceName": "source_name",
    "scale": "scale",
}

_VARIANT_KINDS = {
    "STRING": "string", "BOOLEAN": "boolean", "BIGINT": "number", "DOUBLE": "number", "FLOAT": "number", "VOID": "null",
}


@dataclass(frozen=True)
class Attribute:
    """``kind`` is one of undefined, null, string, number, boolean, date, array, object; ``text`` is the value as text.

    ``declared`` is the kind of all non-null values where the column type fixes it; kind tests are then null tests.
    """

    kind: Column
    text: Column
    declared: str | None = None

    def is_a(self, *kinds: str) -> Column:
        if self.declared is None:
            return self.kind.isin(*kinds)
        value, null = self.declared in kinds, "null" in kinds
        if self.declared == "undefined" or value == null:
            return F.lit(value)
        return self.text.isNotNull() if value else self.text.isNull()


def missing() -> Attribute:
    return Attribute(F.lit("undefined"), F.lit(None).cast("string"), "undefined")


def from_typed(column: Column, data_type: T.DataType) -> Attribute:
    """A column of a declared type: null values are nulls, all others have the column's kind."""
    if isinstance(data_type, T.NumericType):
        kind = "number"
    elif isinstance(data_type, T.BooleanType):
        kind = "boolean"
    elif isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        kind = "date"
    else:
        kind = "string"
    text = column if isinstance(data_type, T.StringType) else column.cast("string")
    return Attribute(F.when(column.isNull(), "null").otherwise(kind), text, kind)


def from_map(column: Column, name: str) -> Attribute:
    """An entry of a ``MAP<STRING, STRING>``: an absent key is missing, a null value is null."""
    text = F.try_element_at(column, F.lit(name))
    kind = F.when(F.coalesce(F.map_contains_key(column, name), F.lit(False)), F.when(text.isNull(), "null").otherwise("string"))
    return Attribute(kind.otherwise("undefined"), text)


def variant_kind(value: Column) -> Column:
    """Kind of a ``VARIANT`` value; NULL, as of a missing field, is undefined."""
    type_name = F.schema_of_variant(value)
    chain = F.when(type_name.isNull(), "undefined")
    for variant_type, kind in _VARIANT_KINDS.items():
        chain = chain.when(type_name == variant_type, kind)
    chain = chain.when(type_name.startswith("DECIMAL"), "number").when(type_name.startswith("ARRAY"), "array")
    return chain.otherwise("object")


def from_variant(column: Column, name: str) -> Attribute:
    """A field of a ``VARIANT`` object, which keeps the type each value had in its JSON text."""
    path = f"$.{name}"
    return Attribute(variant_kind(F.try_variant_get(column, path, "variant")), F.try_variant_get(column, path, "string"))


def properties_kind(features: DataFrame, properties: str = "properties") -> Column | None:
    """Kind of the ``properties`` of a feature as a whole; None where attributes are flat columns, which are always there."""
    types = {f.name: f.dataType for f in features.schema.fields}
    if isinstance(types.get(properties), T.VariantType):
        return variant_kind(F.col(properties))
    if isinstance(types.get(properties), T.MapType):
        return F.when(F.col(properties).isNull(), "undefined").otherwise("object")
    return None


def attributes_of(features: DataFrame, properties: str = "properties") -> dict[str, Attribute]:
    """All checked attributes of a feature table, from flat columns or from its ``properties`` map or variant."""
    types = {f.name: f.dataType for f in features.schema.fields}
    nested = types.get(properties)
    found = {}
    for name, column in ATTRIBUTE_COLUMNS.items():
        if column in types:
            found[name] = from_typed(F.col(column), types[column])
        elif isinstance(nested, T.MapType):
            found[name] = from_map(F.col(properties), name)
        elif isinstance(nested, T.VariantType):
            found[name] = from_variant(F.col(properties), name)
        else:
            found[name] = missing()
    return found
