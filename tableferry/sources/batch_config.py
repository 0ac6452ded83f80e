"""Batch configurations: a JSON array with one object per table to move."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Field names of existing configuration files and the fields they fill.
LEGACY_FIELDS = {
    "gcs_delta_path": "source_path",
    "bq_project": "project",
    "bq_dataset": "schema",
    "bq_table": "table",
    "temp_bucket": "stage_root",
}
FIELDS = {
    "source_path": "string",
    "project": "string",
    "catalog": "string",
    "schema": "string",
    "table": "string",
    "stage_root": "string",
    "method": "string",
    "mode": "string",
    "nested": "string",
    "version": "bigint",
    "format": "string",
    "options": "map<string,string>",
    "partition_by": "array<string>",
    "cluster_by": "array<string>",
    "date_columns": "array<string>",
    "time_columns": "array<string>",
    "key": "array<string>",
    "incremental_column": "string",
    "since": "string",
    "keep_nulls": "boolean",
    "map_types": "boolean",
    "rejects": "string",
    "switch": "boolean",
}


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """One row per table in file order, read through Spark so the file may lie on any file system."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in FIELDS.items())
    schema += "".join(f", `{name}` string" for name in LEGACY_FIELDS)
    rows = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    legacy = {new: old for old, new in LEGACY_FIELDS.items()}

    def value(name: str):
        if name not in legacy:
            return F.col(name)
        old = F.col(legacy[name])
        if name == "stage_root":
            # A bare bucket name stands for a folder in that bucket.
            old = F.when(old.contains(":/") | old.startswith("/"), old).otherwise(F.concat(F.lit("gs://"), old))
        return F.coalesce(F.col(name), old)

    return rows.select(*[value(name).alias(name) for name in FIELDS])
