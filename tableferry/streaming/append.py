"""Appending new source files to a target with Structured Streaming."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tableferry.operators.incremental import key_range, rows_not_in
from tableferry.operators.layout import cached
from tableferry.operators.load import prepare, write_table
from tableferry.session import scratch_root
from tableferry.sources.catalog import (
    STREAM_PROPERTY,
    Definition,
    create_table,
    quote_name,
    read_pointer,
    set_property,
    table_definition,
    table_exists,
    table_properties,
)

BATCH_PROPERTY = "tableferry.stream.batch."


def new_files(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_available(
    stream: DataFrame,
    target: str,
    checkpoint: str | None = None,
    key: list[str] | None = None,
    nested: str = "json",
) -> StreamingQuery:
    """Append everything not yet seen, then stop. Run it again to take what arrived since.

    Without a key the target belongs to the stream, whose file sink writes each
    batch exactly once. With a key batches go through the normal append, which
    other loads may use too; a batch repeated after a failure adds nothing.
    The checkpoint must outlive the run, so it lies in the shared folder.

    The target keeps a ledger of each stream's last batch, and a batch in it is
    skipped unread. A pointer stores the entry in the step that shows the rows;
    a plain table gets it after them, and the key covers the moment between.
    """
    spark = stream.sparkSession
    rows = prepare(stream, nested)
    checkpoint = checkpoint or f"{scratch_root(spark)}/streams/{target.replace('.', '/')}"
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if key:
        query = writer.foreachBatch(lambda batch, number: append_batch(batch, number, target, key, checkpoint)).start()
    else:
        _own_table(spark, target, rows.schema)
        query = writer.toTable(quote_name(target))
    query.awaitTermination()
    return query


def append_batch(batch: DataFrame, number: int, target: str, key: list[str], checkpoint: str) -> int:
    """Add the rows of a micro-batch whose key the target lacks; returns how many.

    Of the target only the range of the batch's first key column is read: keys
    that grow with time, as most do, prune its files.
    """
    spark = batch.sparkSession
    entry = _stream_id(spark, checkpoint)
    last = last_batch(spark, target, entry)
    if last is not None and number <= last:
        return 0
    if not table_exists(spark, target):
        rows = write_table(batch, target, "append")
    else:
        with cached(batch) as kept:  # read for its range, then joined
            rows = write_table(missing_rows(kept, spark.table(quote_name(target)), key), target, "append", marks=_marks(spark, target, entry, number))
    if not read_pointer(spark, target):
        set_property(spark, target, BATCH_PROPERTY + entry, str(number))
    return rows


def missing_rows(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key the target lacks, looked up within the batch's range of the first key column."""
    return rows_not_in(batch, key_range(batch, target, key[0]), key)


def last_batch(spark: SparkSession, target: str, entry: str) -> int | None:
    """The last batch of a stream that the target holds, as far as its ledger tells."""
    if not table_exists(spark, target):
        return None
    pointer = read_pointer(spark, target)
    found = pointer.marks.get(f"batch of {entry}") if pointer else table_properties(spark, target).get(BATCH_PROPERTY + entry)
    return None if found is None else int(found)


def _marks(spark: SparkSession, target: str, entry: str, number: int) -> dict[str, str] | None:
    return {f"batch of {entry}": str(number)} if read_pointer(spark, target) else None


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when it began this checkpoint; batch numbers count within it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def _own_table(spark: SparkSession, target: str, schema: T.StructType) -> None:
    """Readers of a stream's table see only what the stream committed, so it must not hold other loads."""
    if not table_exists(spark, target):
        create_table(spark, target, schema, Definition(properties={STREAM_PROPERTY: "true"}))
    elif STREAM_PROPERTY not in table_definition(spark, target).properties:
        raise ValueError(f"{target} is filled by loads; give a key to append to it")
