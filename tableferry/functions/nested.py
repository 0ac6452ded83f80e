"""Nested columns and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.ArrayType, T.StructType, T.MapType)
MICROSECOND_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, NESTED)


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def nested_to_json(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Every top-level array, struct or map column as one JSON text; other columns, names and order untouched.

    By default null struct fields are left out and times keep milliseconds.
    ``keep_nulls`` writes null fields and keeps microseconds.
    """
    options = {"ignoreNullFields": "false", **MICROSECOND_TEXT} if keep_nulls else {}
    return df.select(
        *[
            F.to_json(quoted(f.name), options).alias(f.name) if is_nested(f.dataType) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def json_to_nested(df: DataFrame, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """The inverse: text columns that ``schema`` declares nested are parsed, all others pass through."""
    wanted = {f.name: f.dataType for f in schema.fields if is_nested(f.dataType)}
    return df.select(
        *[
            parse_json_text(quoted(f.name), wanted[f.name], mode).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, T.StringType)
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def parse_json_text(text: Column, data_type: T.DataType, mode: str = "FAILFAST") -> Column:
    """JSON objects only have text keys, so maps are parsed with text keys and then cast."""
    readable = _with_text_keys(data_type)
    parsed = F.from_json(text, readable, {"mode": mode})
    return parsed if readable == data_type else parsed.cast(data_type)


def _with_text_keys(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.MapType):
        return T.MapType(T.StringType(), _with_text_keys(data_type.valueType), data_type.valueContainsNull)
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_with_text_keys(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _with_text_keys(f.dataType), f.nullable) for f in data_type.fields])
    return data_type


def _json_kind(text: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), path, "variant"))


def json_scalar(text: Column, path: str) -> Column:
    """Text of a JSON string, number or boolean; null for objects, arrays and absent paths.

    Only a result that looks like an object or array pays for a second parse,
    because a string value may start with a brace too.
    """
    found = F.get_json_object(text, path)
    return F.when(~found.rlike(r"^[\[{]") | (_json_kind(text, path) == "STRING"), found)


def json_fragment(text: Column, path: str = "$") -> Column:
    """JSON text at a path without padding; strings keep their quotes."""
    found = F.get_json_object(text, path)
    if path == "$":
        return F.when(F.ltrim(text).startswith('"'), F.trim(text)).otherwise(found)
    value = F.try_variant_get(F.try_parse_json(text), path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.to_json(value)).otherwise(found)
