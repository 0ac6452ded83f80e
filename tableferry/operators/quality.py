"""Profiles, duplicates and orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions.nested import quoted


def profile(df: DataFrame, id_columns: list[str], flag_columns: list[str]) -> DataFrame:
    """One row: total rows, distinct values per id column, true and false counts per flag (nulls in neither)."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_distinct(quoted(c)).alias(f"unique_{c}") for c in id_columns],
        *[F.count_if(quoted(c)).alias(f"{c}_true") for c in flag_columns],
        *[F.count_if(~quoted(c)).alias(f"{c}_false") for c in flag_columns],
    )


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*[quoted(k) for k in key]).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def duplicate_summary(df: DataFrame, column: str) -> DataFrame:
    """One row: total rows, distinct ids (nulls not counted) and ids that repeat; one shuffle on the id."""
    groups = df.groupBy(quoted(column).alias("id")).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0).cast("bigint")).alias("total"),
        F.count("id").alias("unique_ids"),
        F.count_if((F.col("copies") > 1) & F.col("id").isNotNull()).alias("repeated_ids"),
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; a null key refers to nothing and is no orphan.

    The parent side is reduced to its distinct keys first; a hot child key is
    split by adaptive skew handling, which an anti join allows on this side.
    """
    keys = parent.select(quoted(parent_key).alias("__key")).distinct()
    return child.filter(quoted(child_key).isNotNull()).join(keys, quoted(child_key) == F.col("__key"), "left_anti")


def orphan_summary(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Orphaned keys with their number of rows. Rows are counted per key before the join, so no key is hot in it."""
    per_key = (
        child.filter(quoted(child_key).isNotNull())
        .groupBy(quoted(child_key).alias("orphan_key"))
        .agg(F.count("*").alias("row_count"))
    )
    keys = parent.select(quoted(parent_key).alias("__key")).distinct()
    return per_key.join(keys, F.col("orphan_key") == F.col("__key"), "left_anti")
