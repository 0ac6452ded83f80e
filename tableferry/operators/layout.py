"""How rows are spread over partitions and files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.nested import quoted
from tableferry.sources.files import list_files

TIE = "__part"
TARGET_BYTES = 256 << 20
FILES_PER_SCAN = 200_000
GRAINS = ("hour", "day", "month", "year")


def shrink_partitions(df: DataFrame, factor: int = 4, how: str = "rebalance") -> DataFrame:
    """Fewer, larger output files.

    ``rebalance`` is right for any frame: adaptive execution sizes the files and
    splits oversized partitions, for one shuffle. ``coalesce`` merges partitions
    in place, without one; it is for what a scan delivers, as asking a frame that
    joins, groups or sorts for its partition count would run the shuffles below
    it. Only the caller knows which it is. ``packed_scan`` gives files by size.
    """
    if how == "rebalance":
        return df.hint("rebalance")
    if how != "coalesce":
        raise ValueError(f"unknown way to shrink: {how!r}")
    partitions = df.rdd.getNumPartitions()
    if df.inputFiles():
        factor = max(1, min(factor, TARGET_BYTES // _scan_bytes(df.sparkSession)))
        return df.coalesce(max(1, -(-partitions // factor)))
    return df.coalesce(max(1, partitions // factor))


def _scan_bytes(spark: SparkSession) -> int:
    """Bytes of the largest partition that a scan makes."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return max(1, size(spark.conf.get("spark.sql.files.maxPartitionBytes")))


def packed_scan(spark: SparkSession, files: DataFrame, target_bytes: int = TARGET_BYTES, schema: T.StructType | None = None, base: str | None = None) -> Iterator[DataFrame]:
    """Scans of Parquet ``files`` (path, size) in which one task reads about ``target_bytes``, without a shuffle.

    Files that are large enough already are split by the scan; smaller ones are
    packed: Spark fills its read tasks with whole files, largest first, once it
    is told the size wanted and not to spread few bytes over many cores. Those
    settings live in a session of their own, which shares the catalog, so other
    reads keep theirs. Names go to the driver, 200,000 to a scan, as for any scan.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    reader = own.read if schema is None else own.read.schema(schema)
    if base:
        reader = reader.option("basePath", base)
    names = [r.path for r in files.select("path").orderBy("path").toLocalIterator()]
    for start in range(0, len(names), FILES_PER_SCAN):
        yield reader.parquet(*names[start : start + FILES_PER_SCAN])


def compact_files(spark: SparkSession, source: str, destination: str, target_bytes: int = TARGET_BYTES) -> int:
    """Write the Parquet files below ``source`` as fewer, even ones to the new folder ``destination``; returns how many rows.

    One file per read task and no shuffle. Files come out near ``target_bytes``
    as far as the data compresses alike: between half and one and a half of it,
    but for the last one of a scan and for files of one larger row group, which
    no scan divides. (Spark adds an empty file if the first task meets no row
    group.) Partition folders (``a=1``) become columns.
    """
    rows = 0
    for part in packed_scan(spark, list_files(spark, source), target_bytes, base=source):
        seen = Observation()
        part.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(destination)
        rows += seen.get["rows"]
    return rows


def arrange(
    df: DataFrame, partition_by: tuple[str, ...] = (), cluster_by: tuple[str, ...] = (), bucketed: bool = False
) -> DataFrame:
    """Rows placed for a partitioned and clustered write.

    Partitioned: one rebalancing shuffle, so each partition value meets in few
    tasks, and adaptive execution splits the value that holds a third of all rows.
    Clustered only: ranges of the cluster columns, so file statistics can skip.
    The number of the source partition breaks ties, so a hot value, or a group of
    identical rows, is spread over several ranges; it repeats on a retried task.
    Bucketed: rebalanced by the bucket columns, so a bucket comes from few tasks.
    """
    partition_columns, cluster_columns = [quoted(c) for c in partition_by], [quoted(c) for c in cluster_by]
    if partition_by:
        return df.hint("rebalance", *partition_columns).sortWithinPartitions(*partition_columns, *cluster_columns)
    if bucketed:
        return df.hint("rebalance", *cluster_columns)
    if cluster_by:
        return (
            df.withColumn(TIE, F.spark_partition_id())
            .repartitionByRange(*cluster_columns, TIE)
            .sortWithinPartitions(*cluster_columns)
            .drop(TIE)
        )
    return df


def with_partition_date(df: DataFrame, moment: str, name: str, grain: str = "day") -> DataFrame:
    """Add the partition column of a time column: its date, or its hour, month or year."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    if grain == "hour":
        return df.withColumn(name, F.date_format(F.date_trunc("hour", quoted(moment)), "yyyy-MM-dd-HH"))
    return df.withColumn(name, F.to_date(F.date_trunc(grain, quoted(moment))))


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that is used more than once, and release it whatever happens."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per partition of a frame."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("row_count"))


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type and fill of every column; one pass over the data."""
    fields = df.schema.fields
    counts = df.agg(F.count("*").alias("n"), *[F.count(quoted(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    rows: list[Column] = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("filled_rows"),
            (F.col("n") - F.col(f"c{i}")).alias("null_rows"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
