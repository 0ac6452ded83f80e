"""Row size in bytes and ways to make rows smaller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.nested import is_nested, quoted

# Fixed widths in bytes; text and binary count their bytes, nested values their JSON text.
WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def row_bytes(schema: T.StructType) -> Column:
    """Bytes a row takes, from the length of its values; fixed-width values are not rendered."""

    def width(field: T.StructField) -> Column:
        column = quoted(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
        if is_nested(field.dataType):
            return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)).cast("bigint")
        size = F.lit(WIDTHS.get(type(field.dataType), 8)).cast("bigint")
        return F.when(column.isNotNull(), size).otherwise(F.lit(0).cast("bigint"))

    return reduce(lambda total, column: total + column, [width(f) for f in schema.fields])


def oversized(df: DataFrame, limit: int) -> DataFrame:
    """Rows larger than ``limit`` bytes, with their size as ``row_bytes``."""
    return df.withColumn("row_bytes", row_bytes(df.schema)).filter(F.col("row_bytes") > limit)


def truncate_text(df: DataFrame, limit: int, columns: list[str] | None = None) -> DataFrame:
    """Text columns cut to ``limit`` characters; by default all of them."""
    chosen = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(
        *[F.left(quoted(name), F.lit(limit)).alias(name) if name in chosen else quoted(name) for name in df.columns]
    )


def split_wide(df: DataFrame, key: list[str], wide: list[str]) -> tuple[DataFrame, DataFrame]:
    """The table without its wide columns, and a side table of key and wide columns."""
    narrow = df.select(*[quoted(name) for name in df.columns if name not in wide])
    return narrow, df.select(*[quoted(name) for name in [*key, *wide]])
