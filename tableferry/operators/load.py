"""Loading a frame into a target table, directly or through a staged Parquet copy."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.mapping import SOURCE, map_schema_flagged, reject_intervals, schema_differences, split_rejects
from tableferry.functions.nested import nested_to_json, quoted
from tableferry.operators import pointer
from tableferry.operators.incremental import rows_not_in
from tableferry.operators.layout import arrange, shrink_partitions
from tableferry.operators.pointer import SWAP_PROPERTY, counting, plain_name
from tableferry.sources.catalog import (
    STREAM_PROPERTY,
    Definition,
    create_table,
    drop_table,
    quote_name,
    read_pointer,
    rename_table,
    set_property,
    table_definition,
    table_exists,
)
from tableferry.sources.files import delete_path

MODES = ("overwrite", "append", "partitions")
OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"
_replacing = threading.Lock()


@dataclass(frozen=True)
class LoadResult:
    rows: int
    staged_path: str | None = None
    rejected: int = 0


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(MODES)}")


def prepare(df: DataFrame, nested: str = "json", keep_nulls: bool = False) -> DataFrame:
    """Shape a frame for the target: nested columns as JSON text, or kept."""
    reject_intervals(df.schema)
    if nested not in ("json", "keep"):
        raise ValueError(f"unknown nested mode {nested!r}")
    return nested_to_json(df, keep_nulls) if nested == "json" else df


def stage_path(stage_root: str, target: str, moment: datetime | None = None) -> str:
    """``<root>/<schema>/<table>_<YYYYmmdd_HHMMSS>``."""
    moment = moment or datetime.now(timezone.utc)
    return f"{stage_root.rstrip('/')}/{target.replace('`', '').replace('.', '/')}_{moment:%Y%m%d_%H%M%S}"


def write_stage(df: DataFrame, path: str) -> int:
    """Snappy Parquet copy, always replacing what is at the path; returns the rows written."""
    counted, seen = counting(df)
    counted.write.option("compression", "snappy").mode("overwrite").parquet(path)
    return seen.get["rows"]


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    definition: Definition | None = None,
    shrink: str | None = None,
    switch: bool = False,
    marks: dict[str, str] | None = None,
) -> int:
    """Write to a catalog table and return the rows written.

    Mode ``partitions`` replaces the partitions that ``df`` has rows of and leaves
    the others alone (see ``replace_partitions``); a new target is simply filled.

    Append matches columns by name and keeps the table's layout. Overwrite writes
    a complete new table beside the old one and then takes its name, so a failed
    load leaves the old table readable and the source may be the table itself.
    A load that died between the two renames is put right by the next one.
    With ``switch`` a new target becomes a pointer, whose overwrites and appends
    show in one step (see ``pointer``); a target that is one stays one. Only
    pointers store ``marks``.
    Without a definition an existing table's layout, comment and properties are kept.
    ``shrink`` merges output files where the table has no layout of its own.
    """
    check_mode(mode)
    spark = df.sparkSession
    exists = table_exists(spark, target) or recover_table(spark, target)
    if exists and mode == "partitions":
        return replace_partitions(df, target)
    behind = read_pointer(spark, target) if exists else None
    if behind and mode == "append":
        return pointer.append(df, target, marks, shrink)
    if behind or (switch and not exists):
        return pointer.overwrite(df, target, definition, marks, shrink)
    if switch:
        raise ValueError(f"{target} is a table; put it behind a pointer with make_pointer first")
    if marks:
        raise ValueError("only a pointer stores marks")
    if exists and (mode == "append" or definition is None):
        definition = table_definition(spark, target).fitting(df.columns)
        if mode == "overwrite":
            definition.properties.pop(STREAM_PROPERTY, None)
            definition.properties.pop(SWAP_PROPERTY, None)
    definition = definition or Definition()
    if exists and mode == "append":
        if STREAM_PROPERTY in definition.properties:
            raise ValueError(f"{target} is written by a stream, which would hide rows added here")
        return _insert(df, target, definition, shrink)
    if not exists:
        return _fill(df, target, definition, shrink)
    # Names nobody else has; the property tells recover_table which table the old rows belong to.
    token = uuid.uuid4().hex
    incoming, previous = f"{target}__incoming_{token}", f"{target}__previous_{token}"
    rows = _fill(df, incoming, definition, shrink)
    set_property(spark, target, SWAP_PROPERTY, plain_name(target))
    rename_table(spark, target, previous)
    rename_table(spark, incoming, target)
    drop_table(spark, previous)
    return rows


def replace_partitions(df: DataFrame, target: str) -> int:
    """Replace the partitions of ``target`` that ``df`` has rows of; returns the rows written.

    Spark writes the rows beside the table and moves them in when all tasks are
    done, partition by partition, so a load that fails before that changes
    nothing, and repeating one that died while moving puts every partition right.
    Files of other partitions stay as they are. An empty frame replaces nothing.
    """
    spark = df.sparkSession
    definition = table_definition(spark, target)
    if read_pointer(spark, target):
        raise ValueError(f"{target} is a pointer, which shows whole loads; overwrite it")
    if STREAM_PROPERTY in definition.properties:
        raise ValueError(f"{target} is written by a stream, which would hide rows added here")
    if not definition.partition_by:
        raise ValueError(f"{target} has no partitions to replace")
    # The setting belongs to the session, whose other writes all insert or append.
    with _replacing:
        before = spark.conf.get(OVERWRITE_CONF, "static")
        spark.conf.set(OVERWRITE_CONF, "dynamic")
        try:
            return _insert(df, target, definition, None, overwrite=True)
        finally:
            spark.conf.set(OVERWRITE_CONF, before)


def _fill(df: DataFrame, name: str, definition: Definition, shrink: str | None) -> int:
    """Create a table and fill it; a failed load leaves none behind."""
    create_table(df.sparkSession, name, df.schema, definition)
    try:
        return _insert(df, name, definition, shrink)
    except BaseException:
        drop_table(df.sparkSession, name)
        raise


def recover_table(spark: SparkSession, target: str) -> bool:
    """Give a table its old rows back where a load died between the two renames; True if it did.

    Only a table that carries this package's mark for ``target`` is renamed.
    """
    if table_exists(spark, target):
        return False
    schema, _, table = plain_name(target).rpartition(".")
    places = f" IN {quote_name(schema)}" if schema else ""
    for row in spark.sql(f"SHOW TABLES{places} LIKE '{table}__previous_*'").collect():
        old = f"{schema}.{row.tableName}" if schema else row.tableName
        if table_definition(spark, old).properties.get(SWAP_PROPERTY) == plain_name(target):
            rename_table(spark, old, target)
            return True
    return False


def _insert(df: DataFrame, target: str, definition: Definition, shrink: str | None, overwrite: bool = False) -> int:
    table = df.sparkSession.table(quote_name(target))
    differing = [d for d in schema_differences(df.schema, table.schema) if d[3].startswith("only in")]
    if differing:
        raise ValueError(f"columns of the frame and of {target} differ: {differing}")
    placed = df.select(*[quoted(c) for c in table.columns])
    if definition.partition_by or definition.cluster_by:
        # The shuffle decides the files; merging partitions before it would only slow the scan.
        placed = arrange(placed, definition.partition_by, definition.cluster_by, definition.buckets > 0)
    elif shrink:
        placed = shrink_partitions(placed, how=shrink)
    counted, seen = counting(placed)
    counted.write.insertInto(quote_name(target), overwrite=overwrite)
    return seen.get["rows"]


def write_format(df: DataFrame, fmt: str, mode: str, options: dict[str, str]) -> int:
    """Write through any installed data source, such as a warehouse connector."""
    check_mode(mode)
    if mode == "partitions":
        raise ValueError("partitions can only be replaced in a catalog table")
    counted, seen = counting(df)
    counted.write.format(fmt).options(**options).mode(mode).save()
    return seen.get["rows"]


def load_direct(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    *,
    nested: str = "json",
    keep_nulls: bool = False,
    definition: Definition | None = None,
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    shrink: str = "rebalance",
    switch: bool = False,
    marks: dict[str, str] | None = None,
) -> LoadResult:
    """One pass from source to target; ``fmt`` names a connector, otherwise the session catalog is the target."""
    check_mode(mode)
    ready = prepare(df, nested, keep_nulls)
    if fmt:
        return LoadResult(write_format(shrink_partitions(ready, how=shrink), fmt, mode, options or {}))
    return LoadResult(write_table(ready, target, mode, definition, shrink, switch, marks))


def load_staged(
    df: DataFrame,
    target: str,
    stage_root: str,
    mode: str = "overwrite",
    *,
    nested: str = "json",
    keep_nulls: bool = False,
    definition: Definition | None = None,
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    shrink: str = "rebalance",
    path: str | None = None,
    switch: bool = False,
    marks: dict[str, str] | None = None,
) -> LoadResult:
    """Write a Parquet copy, then load that copy: the source is read once however often the load is repeated."""
    check_mode(mode)
    path = path or stage_path(stage_root, target)
    write_stage(shrink_partitions(prepare(df, nested, keep_nulls), how=shrink), path)
    staged = df.sparkSession.read.parquet(path)
    if fmt:
        rows = write_format(staged, fmt, mode, options or {})
    else:
        rows = write_table(staged, target, mode, definition, switch=switch, marks=marks)
    return LoadResult(rows, path)


def load_permissive(
    df: DataFrame,
    schema: T.StructType,
    target: str,
    rejects: str,
    stage_root: str,
    mode: str = "overwrite",
    *,
    nested: str = "json",
    keep_nulls: bool = False,
    definition: Definition | None = None,
    switch: bool = False,
    marks: dict[str, str] | None = None,
    skip_known: bool = False,
    shrink: str = "rebalance",
    path: str | None = None,
) -> tuple[LoadResult, int]:
    """Map to ``schema`` and load the rows that fit; rows that do not go to the table ``rejects``, in the same mode.

    Rejected rows keep their original values as JSON text. Both tables are
    loaded from one staged copy, so each row is converted once; a failed load
    removes the copy. An append with ``skip_known`` adds no rejected row that the
    table of rejects holds already. Returns the load and the number of rejected rows.
    """
    check_mode(mode)
    path = path or stage_path(stage_root, target)
    try:
        write_stage(shrink_partitions(map_schema_flagged(df, schema, keep_source=True), how=shrink), path)
        good, bad = split_rejects(df.sparkSession.read.parquet(path))
        # Rejects go first: a run that dies between the two sets nothing aside twice, and its rows come again.
        bad = prepare(bad, "json")
        if skip_known and mode == "append" and table_exists(df.sparkSession, rejects):
            bad = rows_not_in(bad, df.sparkSession.table(quote_name(rejects)), [SOURCE])
        rejected = write_table(bad, rejects, mode)
        rows = write_table(prepare(good, nested, keep_nulls), target, mode, definition, switch=switch, marks=marks)
    except BaseException:
        remove_stage(df.sparkSession, path)
        raise
    return LoadResult(rows, path, rejected), rejected


def remove_stage(spark: SparkSession, path: str) -> bool:
    """Delete a staged copy. A failure is reported as ``False``; it never fails the load."""
    try:
        return delete_path(spark, path)
    except Exception:
        return False
