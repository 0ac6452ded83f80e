"""Target tables in the session catalog: definition, properties, partitions, views."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.mapping import reject_intervals
from tableferry.sources.files import decode_uri, delete_path

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

CLUSTER_PROPERTY = "tableferry.cluster_by"
BUCKET_PROPERTY = "tableferry.buckets"
EXPIRY_PROPERTY = "tableferry.expires"
# Set on tables that only a stream may append to.
STREAM_PROPERTY = "tableferry.stream"
# A pointer is a view that shows the loads 1..n of one table; its marks say how far each source has been read.
POINTER_TABLE = "tableferry.pointer.table"
POINTER_LOAD = "tableferry.pointer.load"
MARK_PREFIX = "tableferry.mark."
#: Partition column that numbers the loads of a table behind a pointer.
LOAD = "__load"


@dataclass(frozen=True)
class Definition:
    """How a table is laid out and described, apart from its columns."""

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    buckets: int = 0
    comment: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def fitting(self, columns: list[str]) -> Definition:
        """The same definition without layout columns that no longer exist."""
        cluster_by = tuple(c for c in self.cluster_by if c in columns)
        return Definition(
            tuple(c for c in self.partition_by if c in columns),
            cluster_by,
            self.buckets if cluster_by == self.cluster_by else 0,
            self.comment,
            self.properties,
        )


@dataclass(frozen=True)
class Pointer:
    """What readers of a pointer see: the loads up to ``load`` of ``table``."""

    table: str
    load: int
    marks: dict[str, str] = field(default_factory=dict)


def quote_name(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def quote_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(quote_name(name))


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, definition: Definition = Definition(), replace: bool = False
) -> None:
    """An empty Parquet table. ``cluster_by`` steers the layout of later loads; with ``buckets`` it also buckets."""
    reject_intervals(schema)
    if replace:
        drop_table(spark, name)
    columns = ", ".join(T.StructType([f]).toDDL() for f in schema.fields)
    statement = [f"CREATE TABLE {quote_name(name)} ({columns}) USING parquet"]
    properties = dict(definition.properties)
    if definition.partition_by:
        statement.append(f"PARTITIONED BY ({', '.join(quote_column(c) for c in definition.partition_by)})")
    if definition.cluster_by:
        properties[CLUSTER_PROPERTY] = ",".join(definition.cluster_by)
        if definition.buckets:
            names = ", ".join(quote_column(c) for c in definition.cluster_by)
            statement.append(f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {definition.buckets} BUCKETS")
            properties[BUCKET_PROPERTY] = str(definition.buckets)
    if definition.comment:
        statement.append(f"COMMENT {_text(definition.comment)}")
    if properties:
        pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        statement.append(f"TBLPROPERTIES ({pairs})")
    spark.sql(" ".join(statement))


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quote_name(name)}").collect()}


def read_pointer(spark: SparkSession, name: str) -> Pointer | None:
    """The pointer of that name, ``None`` for anything else."""
    if not table_exists(spark, name):
        return None
    properties = table_properties(spark, name)
    if POINTER_TABLE not in properties:
        return None
    marks = {k.removeprefix(MARK_PREFIX): v for k, v in properties.items() if k.startswith(MARK_PREFIX)}
    return Pointer(properties[POINTER_TABLE], int(properties[POINTER_LOAD]), marks)


def set_pointer(spark: SparkSession, name: str, pointer: Pointer, comment: str | None = None) -> None:
    """Create the view or let it show something else, marks included: one step of the catalog.

    Other properties of the view stay.
    """
    before = table_properties(spark, name) if table_exists(spark, name) else {}
    own = {k: v for k, v in before.items() if not k.startswith((POINTER_TABLE, POINTER_LOAD, MARK_PREFIX))}
    own.update({POINTER_TABLE: pointer.table, POINTER_LOAD: str(pointer.load), **{MARK_PREFIX + k: v for k, v in pointer.marks.items()}})
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in own.items())
    columns = ", ".join(quote_column(c) for c in spark.table(quote_name(pointer.table)).columns if c != LOAD)
    told = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {quote_name(name)}{told} TBLPROPERTIES ({pairs}) AS "
        f"SELECT {columns} FROM {quote_name(pointer.table)} WHERE {LOAD} <= {pointer.load}"
    )


def stored_table(spark: SparkSession, name: str) -> str:
    """The table that holds the rows: the one behind a pointer, else the table itself."""
    pointer = read_pointer(spark, name)
    return pointer.table if pointer else name


def drop_load(spark: SparkSession, table: str, load: int) -> None:
    """Remove a load that no pointer shows: its partitions in the catalog and the folder, which may hold files nobody registered."""
    found = [r.partition for r in spark.sql(f"SHOW PARTITIONS {quote_name(table)} PARTITION ({LOAD} = {load})").collect()]
    if found:
        specs = ", ".join(f"PARTITION ({_spec(p)})" for p in found)
        spark.sql(f"ALTER TABLE {quote_name(table)} DROP IF EXISTS {specs}")
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").filter("col_name = 'Location'").first().data_type
    delete_path(spark, f"{place}/{LOAD}={load}")


def table_definition(spark: SparkSession, name: str) -> Definition:
    """Layout and description of a table, or of the table behind a pointer."""
    pointer = read_pointer(spark, name)
    quoted = quote_name(pointer.table if pointer else name)
    properties = table_properties(spark, quoted)
    cluster_by = properties.pop(CLUSTER_PROPERTY, "")
    buckets = int(properties.pop(BUCKET_PROPERTY, "0"))
    return Definition(
        partition_by=tuple(c.name for c in spark.catalog.listColumns(quoted) if c.isPartition and not (pointer and c.name == LOAD)),
        cluster_by=tuple(c for c in cluster_by.split(",") if c),
        buckets=buckets,
        comment=spark.catalog.getTable(quoted).description,
        properties=properties,
    )


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table, or a pointer with the table behind it: first the view, so that nobody meets a view without rows."""
    pointer = read_pointer(spark, name)
    if pointer:
        spark.sql(f"DROP VIEW IF EXISTS {quote_name(name)}")
        name = pointer.table
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(name)}")


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_name(name)}{place}")


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {quote_name(name)} CASCADE")


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    kind = "VIEW" if read_pointer(spark, name) else "TABLE"
    spark.sql(f"ALTER {kind} {quote_name(name)} SET TBLPROPERTIES ({_text(key)} = {_text(value)})")


def create_view(spark: SparkSession, name: str, query: DataFrame | str) -> None:
    """A stored view from SQL text on catalog tables, or a session view from a frame."""
    if isinstance(query, str):
        spark.sql(f"CREATE OR REPLACE VIEW {quote_name(name)} AS {query}")
    else:
        query.createOrReplaceTempView(name)


def expire_partitions(spark: SparkSession, name: str, column: str, before: str) -> int:
    """Drop date or hour partitions older than ``before``; returns how many. Null partitions stay.

    Values are dates (``yyyy-MM-dd``) or hours (``yyyy-MM-dd-HH``); ``before`` is a
    date or a time. Any other value stops the run, so nothing is kept by mistake.
    Only partition names reach the driver; their number is that of the table's
    date partitions.
    """
    value = decode_uri(F.regexp_extract("partition", f"(?:^|/){re.escape(column)}=([^/]*)", 1))
    pattern = F.when(F.length(value) == len("yyyy-MM-dd-HH"), F.lit("yyyy-MM-dd-HH")).otherwise(F.lit("yyyy-MM-dd"))
    name = stored_table(spark, name)
    listed = spark.sql(f"SHOW PARTITIONS {quote_name(name)}").select("partition", value.alias("value"), F.try_to_timestamp(value, pattern).alias("moment"))
    listed = listed.filter(F.col("value") != NULL_PARTITION)
    unread = listed.filter("moment is null").select("value").first()
    if unread is not None:
        raise ValueError(f"partition value {unread.value!r} of {name} is neither a date nor an hour")
    old = listed.filter(F.col("moment") < F.lit(before).cast("timestamp")).collect()
    if old:
        # whole specs, as not every catalog takes a part of one
        specs = ", ".join(f"PARTITION ({_spec(r.partition)})" for r in old)
        spark.sql(f"ALTER TABLE {quote_name(name)} DROP IF EXISTS {specs}")
    return len({r.value for r in old})


def _spec(partition: str) -> str:
    """``a=1/b=2`` of a partition listing as a partition spec."""
    values = (part.split("=", 1) for part in partition.split("/"))
    return ", ".join(f"{quote_column(unquote(k))} = {'NULL' if v == NULL_PARTITION else _text(unquote(v))}" for k, v in values)


def set_expiry(spark: SparkSession, name: str, moment: str) -> None:
    """Let ``expire_tables`` drop a table, or a pointer with its rows, once ``moment`` (ISO date or time) has passed."""
    set_property(spark, name, EXPIRY_PROPERTY, datetime.fromisoformat(moment).isoformat())


def expire_tables(spark: SparkSession, schema: str, now: str) -> list[str]:
    """Drop the tables of a schema whose time has passed; returns their names. Tables without an expiry stay."""
    dropped = []
    for row in spark.sql(f"SHOW TABLES IN {quote_name(schema)}").filter("not isTemporary").collect():
        name = f"{schema}.{row.tableName}"
        if not table_exists(spark, name):  # went with its pointer
            continue
        expires = table_properties(spark, name).get(EXPIRY_PROPERTY)
        if expires and datetime.fromisoformat(expires) <= datetime.fromisoformat(now):
            drop_table(spark, name)
            dropped.append(name)
    return dropped


def rename_table(spark: SparkSession, name: str, new_name: str) -> None:
    """Rename within a catalog; the new name is stated without the catalog, as Spark expects."""
    new_name = ".".join(new_name.replace("`", "").split(".")[-2:])
    spark.sql(f"ALTER TABLE {quote_name(name)} RENAME TO {quote_name(new_name)}")
