"""Paths and file listings on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import empty_frame

FILE_COLUMNS = "path string, size bigint, modified timestamp"


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, decoded, as file listings spell it."""
    fs, hadoop_path = _filesystem(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on its own file system; False when there was nothing to delete."""
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path) and fs.delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file, replacing what is there."""
    fs, hadoop_path = _filesystem(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def list_children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Name and modification time (milliseconds) of what lies directly in a folder; nothing for an absent one."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(hadoop_path))


def publish_single_file(spark: SparkSession, folder: str, target: str) -> None:
    """Rename the one part file of ``folder`` to ``target``, which must not exist yet; the folder goes either way."""
    fs, hadoop_folder = _filesystem(spark, folder)
    _, hadoop_target = _filesystem(spark, target)
    try:
        parts = [s.getPath() for s in fs.listStatus(hadoop_folder) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"{folder} holds {len(parts)} part files, expected one")
        if fs.exists(hadoop_target) or not fs.rename(parts[0], hadoop_target):
            raise FileExistsError(f"{target} was written by somebody else")
    finally:
        fs.delete(hadoop_folder, True)


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below ``path`` as ``path, size, modified``; hidden folders are skipped, content is not read.

    The listing is taken when this function is called, not when the frame is used.
    """
    if not path_exists(spark, path):
        return empty_frame(spark, FILE_COLUMNS)
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return listed.select(
        plain_location(F.col("path")).alias("path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def decode_uri(text: Column) -> Column:
    """Undo %XX escapes; unlike form decoding a plus sign stays a plus sign."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def encode_uri(text: Column) -> Column:
    """Escape a location for the log; separators stay readable."""
    escaped = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    for code, char in (("%2F", "/"), ("%3D", "="), ("%3A", ":")):
        escaped = F.replace(escaped, F.lit(code), F.lit(char))
    return escaped


def plain_location(text: Column) -> Column:
    """One spelling for local paths, which appear both as ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(text, "^file:/+", "file:/")


def row_location() -> Column:
    """The decoded location of the file a scanned row comes from."""
    return plain_location(decode_uri(F.col("_metadata.file_path")))


def read_plain(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of a folder, whatever a table log may say about them."""
    return spark.read.parquet(path)
