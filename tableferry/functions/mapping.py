"""Mapping a source schema to the target's types, strictly or with rejected rows set aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.nested import is_nested, parse_json_text, quoted

REJECTS = "_rejects"
SOURCE = "_source"
# Names used in flat table definitions and their Spark types.
FLAT_TYPES = {
    "INTEGER": "bigint",
    "INT64": "bigint",
    "FLOAT": "double",
    "FLOAT64": "double",
    "NUMERIC": "decimal(38,9)",
    "BOOLEAN": "boolean",
    "BOOL": "boolean",
    "STRING": "string",
    "BYTES": "binary",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp_ntz",
}
HAS_ZONE = r"(Z|UTC|GMT|[+-]\d{2}:?\d{2}|[A-Za-z]+/[A-Za-z_/]+)$"
ONLY_DATE = r"^\d{4}-\d{2}-\d{2}$"


def flat_schema(definition: str) -> T.StructType:
    """Schema from a ``name:TYPE,name:TYPE`` list; a bare name is text."""
    fields = []
    for item in definition.split(","):
        name, _, kind = item.strip().partition(":")
        fields.append(f"`{name}` {FLAT_TYPES[kind.strip().upper() or 'STRING']}")
    return T.StructType.fromDDL(", ".join(fields))


def target_schema(source: T.StructType, dates: tuple[str, ...] = (), times: tuple[str, ...] = ()) -> T.StructType:
    """Warehouse types of a source schema: all whole numbers wide, named text columns as dates or times."""
    named = {**dict.fromkeys(dates, T.DateType()), **dict.fromkeys(times, T.TimestampType())}
    return T.StructType(
        [T.StructField(f.name, named.get(f.name, _widened(f.dataType)), f.nullable) for f in source.fields]
    )


def _widened(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(data_type, T.FloatType):
        return T.DoubleType()
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_widened(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _widened(f.dataType), f.nullable) for f in data_type.fields])
    if isinstance(data_type, T.MapType):
        return T.MapType(_widened(data_type.keyType), _widened(data_type.valueType), data_type.valueContainsNull)
    return data_type


def reject_intervals(schema: T.StructType) -> None:
    """Warehouse targets hold no intervals; say so before any job runs."""
    intervals = (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)

    def holds(data_type: T.DataType) -> bool:
        if isinstance(data_type, T.ArrayType):
            return holds(data_type.elementType)
        if isinstance(data_type, T.MapType):
            return holds(data_type.keyType) or holds(data_type.valueType)
        if isinstance(data_type, T.StructType):
            return any(holds(f.dataType) for f in data_type.fields)
        return isinstance(data_type, intervals)

    named = [f.name for f in schema.fields if holds(f.dataType)]
    if named:
        raise TypeError(f"interval columns cannot be loaded: {', '.join(named)}")


def convert(value: Column, source: T.DataType, target: T.DataType, zone: str = "UTC") -> Column:
    """``value`` in the target type, null where it cannot be represented; structures are converted part by part."""
    if source == target:
        return value
    if isinstance(source, T.StringType):
        if isinstance(target, T.DateType):
            # A cast parses faster than a pattern but takes other spellings, so those are ruled out first.
            return F.when(value.rlike(ONLY_DATE), value.try_cast(target))
        if isinstance(target, T.TimestampType):
            # Text without a zone is read in the stated zone, whatever the session's zone is.
            zoned = (
                F.when(value.rlike(ONLY_DATE), F.concat(value, F.lit("T00:00:00 " + zone)))
                .when(value.rlike(HAS_ZONE), value)
                .otherwise(F.concat(value, F.lit(" " + zone)))
            )
            return zoned.try_cast(target)
        if is_nested(target):
            return parse_json_text(value, target, "PERMISSIVE")
    if is_nested(source) and isinstance(target, T.StringType):
        return F.to_json(value)
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        present = {f.name: f.dataType for f in source.fields}
        parts = [
            (
                convert(value.getField(f.name), present[f.name], f.dataType, zone)
                if f.name in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda item: convert(item, source.elementType, target.elementType, zone))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return F.map_from_entries(
            F.transform(
                F.map_entries(value),
                lambda entry: F.struct(
                    convert(entry["key"], source.keyType, target.keyType, zone).alias("key"),
                    convert(entry["value"], source.valueType, target.valueType, zone).alias("value"),
                ),
            )
        )
    return value.try_cast(target)


def loses(value: Column, converted: Column, source: T.DataType, target: T.DataType) -> Column:
    """True where the conversion dropped a value, also one inside an array, struct or map."""
    whole = value.isNotNull() & converted.isNull()
    if source == target or not (is_nested(source) and is_nested(target)):
        return whole
    if isinstance(source, T.StructType):
        present = {f.name: f.dataType for f in source.fields}
        for f in target.fields:
            if f.name in present:
                whole = whole | loses(value.getField(f.name), converted.getField(f.name), present[f.name], f.dataType)
        return F.coalesce(whole, F.lit(False))
    if isinstance(source, T.ArrayType):
        pairs = F.arrays_zip(value.alias("a"), converted.alias("b"))
        inner = F.exists(pairs, lambda p: loses(p["a"], p["b"], source.elementType, target.elementType))
        return F.coalesce(whole | inner, whole)
    pairs = F.arrays_zip(F.map_entries(value).alias("a"), F.map_entries(converted).alias("b"))
    inner = F.exists(pairs, lambda p: loses(p["a"]["value"], p["b"]["value"], source.valueType, target.valueType))
    return F.coalesce(whole | inner, whole)


def _converted(df: DataFrame, target: T.StructType, zone: str) -> tuple[DataFrame, list[Column]]:
    """Source columns beside their converted forms ``__0, __1, ..``, and per target field when a row is bad.

    Conversion has its own projection: results are used both as values and to
    tell bad rows, and Spark keeps projections apart rather than compute twice.
    """
    sources = {f.name: f.dataType for f in df.schema.fields}
    converted, bad = [], []
    for position, field in enumerate(target.fields):
        name = f"__{position}"
        if field.name not in sources:
            converted.append(F.lit(None).cast(field.dataType).alias(name))
            bad.append(F.lit(not field.nullable))
            continue
        value, kind = quoted(field.name), sources[field.name]
        converted.append(convert(value, kind, field.dataType, zone).alias(name))
        wrong = F.lit(False) if kind == field.dataType else loses(value, F.col(name), kind, field.dataType)
        bad.append(wrong if field.nullable else wrong | value.isNull())
    return df.select(*[quoted(c) for c in df.columns], *converted), bad


def map_schema(df: DataFrame, target: T.StructType, zone: str = "UTC", allow_missing: bool = True) -> DataFrame:
    """Columns of ``target`` in its order and types; one value that does not fit fails the job.

    Columns the target does not have are an error, as are absent columns it
    requires; absent nullable ones become null unless ``allow_missing`` is off.
    """
    _check_names(df, target, allow_missing)
    both, bad = _converted(df, target, zone)
    columns = []
    for position, field in enumerate(target.fields):
        wanted = field.dataType.simpleString()
        complaint = F.raise_error(F.lit(f"column {field.name} holds a value that does not fit {wanted}"))
        good = F.when(bad[position], complaint.cast(field.dataType)).otherwise(F.col(f"__{position}"))
        columns.append(good.alias(field.name))
    return both.select(*columns)


def map_schema_flagged(
    df: DataFrame, target: T.StructType, zone: str = "UTC", keep_source: bool = False
) -> DataFrame:
    """Like ``map_schema`` but bad values become null and ``_rejects`` names their columns; it is null for a clean row.

    ``keep_source`` adds ``_source``, the row as it came as JSON text, for bad rows.
    """
    _check_names(df, target, True)
    both, bad = _converted(df, target, zone)
    named = F.array(*[F.when(wrong, F.lit(field.name)) for field, wrong in zip(target.fields, bad)])
    # Only a bad row pays for naming its columns and printing itself.
    any_bad = reduce(lambda left, right: left | right, bad)
    rejects = F.when(any_bad, F.array_compact(named))
    columns = [F.col(f"__{position}").alias(field.name) for position, field in enumerate(target.fields)]
    columns.append(rejects.alias(REJECTS))
    if keep_source:
        text = F.to_json(F.struct(*[quoted(c) for c in df.columns]), {"ignoreNullFields": "false"})
        columns.append(F.when(any_bad, text).alias(SOURCE))
    return both.select(*columns)


def split_rejects(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows without the flag, and rejected rows with it."""
    clean = F.col(REJECTS).isNull()
    return flagged.filter(clean).drop(REJECTS, SOURCE), flagged.filter(~clean)


def _check_names(df: DataFrame, target: T.StructType, allow_missing: bool) -> None:
    extra = [name for name in df.columns if name not in target.names]
    absent = [f.name for f in target.fields if f.name not in df.columns and not (allow_missing and f.nullable)]
    if extra or absent:
        raise ValueError(f"columns not in the target: {extra}; columns the source lacks: {absent}")


def schema_differences(source: T.StructType, target: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """``column, source type, target type, issue`` for every column that is not the same on both sides."""
    have = {f.name: f for f in source.fields}
    want = {f.name: f for f in target.fields}
    found = []
    for name in [*have, *[n for n in want if n not in have]]:
        left = have[name].dataType.simpleString() if name in have else None
        right = want[name].dataType.simpleString() if name in want else None
        if right is None:
            found.append((name, left, right, "only in source"))
        elif left is None:
            found.append((name, left, right, "only in target"))
        elif left != right:
            found.append((name, left, right, "type differs"))
        elif have[name].nullable and not want[name].nullable:
            found.append((name, left, right, "target requires a value"))
    return found
