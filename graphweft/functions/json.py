"""JSON access."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_get(value: Column, path: str) -> Column:
    """A key name or a full ``$`` path; the result as text."""
    return F.get_json_object(value, path if path.startswith("$") else f"$.{path}")


def json_keys(value: Column) -> Column:
    return F.json_object_keys(value)


def json_type(value: Column, path: str = "$") -> Column:
    """Type of a JSON value: object, array, integer, real, text, true, false or null."""
    picked = F.try_variant_get(F.parse_json(value), path, "variant")
    kind = F.schema_of_variant(picked)
    return (
        F.when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("BIGINT"), "integer")
        .when(kind.startswith("DOUBLE") | kind.startswith("DECIMAL") | kind.startswith("FLOAT"), "real")
        .when(kind == "STRING", "text")
        .when(kind == "BOOLEAN", F.try_variant_get(F.parse_json(value), path, "string"))
        .when(kind == "VOID", "null")
    )
